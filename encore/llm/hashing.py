"""Hashes of words and word runs with numpy, and tables of bits of a fixed size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.session import shuffle_partitions

TABLE_BITS = 1 << 26
_BLOCK = 1 << 17  # bytes hashed at once, give or take a word
_BASE = 0x5851F42D4C957F2D  # odd, 5 mod 8
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 9, 10, 11, 12, 13]] = True
_powers: dict = {}


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _codes() -> np.ndarray:
    """A fixed 64-bit number for every byte; A-Z have those of a-z."""
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    codes[65:91] = codes[97:123]
    return codes


_CODES = _codes()


def powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd number and of its inverse, ``size`` of them and more."""
    if size > _BLOCK:
        made = [np.cumprod(np.r_[np.uint64(1), np.full(size, x, np.uint64)]) for x in (_BASE, _INVERSE)]
        return made[0], made[1]
    if not _powers:
        _powers["both"] = [np.cumprod(np.r_[np.uint64(1), np.full(_BLOCK, x, np.uint64)]) for x in (_BASE, _INVERSE)]
    return _powers["both"]


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """64-bit hashes of the text's words in order, A-Z in lower case; words are parted by x20 and x09 to x0D.

    A word's hash sums its bytes' codes times powers of an odd number; the sums of all words are differences of one
    running sum, brought to the word's start by the inverse power. A text is taken in blocks that end at a space.
    """
    data = np.frombuffer(text if isinstance(text, bytes) else (text or "").encode(), np.uint8)
    out, start = [], 0
    while start < len(data):
        end = start + _BLOCK
        if end < len(data):
            spaces = np.flatnonzero(_SPACES[data[start:end]])
            if len(spaces):
                end = start + int(spaces[-1]) + 1
            else:
                after = np.flatnonzero(_SPACES[data[end:]])
                end = end + int(after[0]) + 1 if len(after) else len(data)
        block = data[start:end]
        start = end
        inside = np.zeros(len(block) + 2, np.int8)
        inside[1:-1] = ~_SPACES[block]
        edges = np.flatnonzero(np.diff(inside))
        first, last = edges[::2], edges[1::2]
        powers, inverse = powers_to(len(block))
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_CODES[block] * powers[: len(block)], out=sums[1:])
        out.append(mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)))
    return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.uint64)


def odd_factors(count: int, seed: int = 5) -> np.ndarray:
    """Fixed odd 64-bit numbers."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; a text with fewer has one, of all its words."""
    if len(hashes) == 0:
        return hashes
    factors = odd_factors(size)
    if len(hashes) < size:
        short = (hashes * factors[: len(hashes)]).sum(dtype=np.uint64) + np.uint64(len(hashes))
        return mixed(np.array([short], np.uint64))
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        total += hashes[i: i + len(total)] * factors[i]
    return mixed(total)


def bit_table(values: DataFrame, column: str, bits: int = TABLE_BITS) -> bytes:
    """Bits set at the values' remainders, put together by Spark stretch by stretch; its size is fixed by ``bits``."""
    slot = F.pmod(F.col(column), F.lit(bits)) + 1  # Spark's bitmaps count from 1
    placed = values.select(slot.alias("slot")).withColumn("bucket", F.bitmap_bucket_number("slot"))
    rows = (
        placed.repartition(shuffle_partitions(values.sparkSession), "bucket")
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("map"))
        .collect()  # at most bits / 32,768 rows of 4 KB
    )
    table = bytearray(bits // 8)
    for row in rows:
        at = (row.bucket - 1) * 4096
        table[at:at + 4096] = row.map[: len(table) - at]
    return bytes(table)


def in_table(table: np.ndarray, values: np.ndarray, bits: int = TABLE_BITS) -> np.ndarray:
    """Which values may be in the table of :func:`bit_table`; ``table`` is its bytes as uint8."""
    slot = values & np.uint64(bits - 1)
    return (table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
