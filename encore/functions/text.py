"""Text expressions: match keys and the fuzzy score."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def match_key(column: Column) -> Column:
    """Lower case without a leading article, a trailing company form, punctuation or spare blanks."""
    text = F.lower(F.trim(column))
    text = F.regexp_replace(text, r"^(the|a|an)\s+", "")
    text = F.regexp_replace(text, r"\s+(inc|llc|ltd|corp|corporation)\.?$", "")
    text = F.regexp_replace(text, r"(?U)[^\w\s]", " ")
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def _masks(a: str) -> dict[str, int]:
    """The positions of each character as bits."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def _common(masks: dict[str, int], size: int, b: str) -> int:
    full = (1 << size) - 1
    state = full
    for ch in b:
        hit = state & masks.get(ch, 0)
        state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation per character of ``b``."""
    return _common(_masks(a), len(a), b)


def ratio(a: str, b: str) -> int:
    """Percent of characters in common, rounded: 200 * common / (len(a) + len(b))."""
    total = len(a) + len(b)
    return round(200 * common_length(a, b) / total) if total else 0


def _best_stretch(short: str, long: str, best: int) -> int:
    """The best ratio of ``short`` with a stretch of ``long`` from any character on, if over ``best``.

    A stretch of which fewer characters occur in ``short`` than it takes to beat the best so far is not compared.
    """
    masks, size = _masks(short), len(short)
    # known[i]: how many of the first i characters of the longer text occur in the shorter one
    known = [0]
    for ch in long:
        known.append(known[-1] + (ch in masks))
    for i in range(len(long)):
        end = min(i + size, len(long))
        if round(200 * (end - i) / (size + end - i)) <= best:
            break  # later stretches are no longer than this one
        if round(200 * (known[end] - known[i]) / (size + end - i)) > best:
            best = max(best, round(200 * _common(masks, size, long[i:end]) / (size + end - i)))
    return best


def partial_ratio(a: str, b: str) -> int:
    """Best ratio of the shorter text with any stretch of the longer one of the same length.

    Of two texts of equal length either may be the longer one, so the order does not matter.
    """
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 0
    if short in long:
        return 100
    best = _best_stretch(short, long, 0)
    return _best_stretch(long, short, best) if len(a) == len(b) else best


def token_ratio(a: str, b: str) -> int:
    """The better of comparing the sorted words, and the shared words with and without the rest."""
    left, right = a.split(), b.split()
    best = ratio(" ".join(sorted(left)), " ".join(sorted(right)))
    shared = " ".join(sorted(set(left) & set(right)))
    rest_left = " ".join(sorted(set(left) - set(right)))
    rest_right = " ".join(sorted(set(right) - set(left)))
    with_left, with_right = f"{shared} {rest_left}".strip(), f"{shared} {rest_right}".strip()
    pairs = [(with_left, with_right)]
    if shared:
        pairs += [(shared, with_left), (shared, with_right)]
    return max([best, *(ratio(x, y) for x, y in pairs)])


def fuzzy_score(a: str | None, b: str | None) -> float:
    """0 to 1 for two match keys; 0 if one is blank."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    best = partial_ratio(a, b)
    return max(best, ratio(a, b), token_ratio(a, b)) / 100.0 if best < 100 else 1.0


@F.pandas_udf(T.DoubleType())
def fuzzy_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([fuzzy_score(a, b) for a, b in zip(left, right)], dtype="float64")
