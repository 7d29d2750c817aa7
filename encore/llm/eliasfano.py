"""Elias-Fano sequences over memory-mapped words, with vectorised access and successor search."""

from __future__ import annotations

import json

import numpy as np

def packed(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits each, laid end to end in uint64 words (one spare word at the end)."""
    words = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width and len(values):
        bit = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        np.bitwise_or.at(words, word, values << shift)
        over = shift + np.uint64(width) > 64
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def unpacked(words: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.uint64) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return ((words[word] >> shift) | high) & np.uint64((1 << width) - 1)


def _nth_one(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the nth one (from 0) of each word, by halves."""
    left, place = nth.astype(np.uint8), np.zeros(len(words), np.uint64)
    for half in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(words & np.uint64((1 << half) - 1))
        above = left >= low
        left = left - np.where(above, low, np.uint8(0))
        step = above * np.uint64(half)
        place += step
        words = words >> step
    return place.astype(np.int64)


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of a non-decreasing sequence of integers below ``universe``.

    The low bits are packed; the high part is a bit vector with a one for each value and a zero after each bucket.
    """
    values = values.astype(np.uint64)
    n = len(values)
    width = min(62, max(0, (universe // n).bit_length() - 1)) if n else min(62, universe.bit_length())
    buckets = (universe >> width) + 1
    flags = np.zeros(-(-(n + buckets + 1) // 64) * 64, np.uint8)
    high = (values >> np.uint64(width)).astype(np.int64)
    flags[high + np.arange(n)] = 1
    upper = np.packbits(flags, bitorder="little").view(np.uint64)
    ones = np.r_[0, np.cumsum(np.bitwise_count(upper).astype(np.int64))]
    low = packed(values & np.uint64((1 << width) - 1), width)
    return {"head": np.array([n, width, buckets], np.int64), "upper": upper, "ones": ones.astype(np.uint32), "low": low}


class EliasFano:
    """A sequence made by :func:`encode`; its arrays may lie in a memory-mapped file."""

    def __init__(self, arrays: dict[str, np.ndarray], prefix: str = ""):
        self.n, self.width, self.buckets = (int(x) for x in arrays[prefix + "head"])
        self.upper, self.low = arrays[prefix + "upper"], arrays[prefix + "low"]
        self.ones = arrays[prefix + "ones"].astype(np.int64)
        self.zeros = 64 * np.arange(len(self.ones), dtype=np.int64) - self.ones

    def _select(self, counts: np.ndarray, nth: np.ndarray, flip: bool) -> np.ndarray:
        word = np.searchsorted(counts, nth, "right") - 1
        bits = self.upper[word]
        return 64 * word + _nth_one(~bits if flip else bits, nth - counts[word])

    def access(self, at: np.ndarray) -> np.ndarray:
        """Values at the places ``at``."""
        high = self._select(self.ones, at.astype(np.int64), False) - at
        return (high.astype(np.uint64) << np.uint64(self.width)) | unpacked(self.low, self.width, at)

    def _search(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the first value that is not below the key, end of the key's bucket, the key's low bits)."""
        keys = keys.astype(np.uint64)
        part = keys & np.uint64((1 << self.width) - 1)
        bucket = (keys >> np.uint64(self.width)).astype(np.int64)
        # the bucket's ones stand between its zero and the one before
        bit = np.where(bucket > 0, self._select(self.zeros, np.maximum(bucket - 1, 0), True) + 1, 0)
        low = bit - bucket
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        ahead = ~self.upper[word] >> shift
        gone = ahead & (~ahead + np.uint64(1))  # the first zero bit after the start, if it is in this word
        high = low + np.bitwise_count(gone - np.uint64(1)).astype(np.int64)
        far = np.flatnonzero(ahead == 0)
        if len(far):
            high[far] = self._select(self.zeros, bucket[far], True) - bucket[far]
        end = high.copy()
        low = low.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            below = unpacked(self.low, self.width, middle) < part[open_]
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        return low, end, part

    def successor(self, keys: np.ndarray) -> np.ndarray:
        """Place of the first value that is not below the key: its bucket by the zeros, then bisection in the low bits."""
        return self._search(keys)[0] if self.n else np.zeros(len(keys), np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it is absent."""
        out = np.full(len(keys), -1, np.int64)
        if self.n:
            place, end, part = self._search(keys)
            at = np.flatnonzero(place < end)
            at = at[unpacked(self.low, self.width, place[at]) == part[at]]
            out[at] = place[at]
        return out


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """All arrays in one block, each at a multiple of 64 bytes, behind a JSON head."""
    head, at = {}, 0
    for name, array in arrays.items():
        head[name] = [array.dtype.str, len(array), at]
        at += -(-array.nbytes // 64) * 64
    text = json.dumps(head).encode()
    start = -(-(8 + len(text)) // 64) * 64
    parts = [len(text).to_bytes(8, "little"), text, b"\0" * (start - 8 - len(text))]
    for array in arrays.values():
        parts += [array.tobytes(), b"\0" * (-array.nbytes % 64)]
    return b"".join(parts)


def from_file(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file written with :func:`to_bytes`, memory-mapped."""
    block = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(block[:8].tobytes(), "little")
    head = json.loads(block[8:8 + size].tobytes())
    start = -(-(8 + size) // 64) * 64
    out = {}
    for name, (kind, count, at) in head.items():
        kind = np.dtype(kind)
        out[name] = np.asarray(block[start + at: start + at + count * kind.itemsize]).view(kind)
    return out
