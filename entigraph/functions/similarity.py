"""String similarities: the normalised indel ratio and its token set form (0 to 100)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine step per character of b (bits stand for places of a)."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """Of the words as sets: 100 if one side has no word of its own beside shared ones, else the best of three ratios."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = x & y, x - y, y - x
    if both and (not only_x or not only_y):
        return 100.0
    shared, left, right = (" ".join(sorted(s)) for s in (both, only_x, only_y))
    gap = 1 if shared else 0
    n_left, n_right = len(shared) + gap + len(left), len(shared) + gap + len(right)
    apart = len(left) + len(right) - 2 * lcs_length(left, right)
    best = 100.0 * (1 - apart / (n_left + n_right)) if n_left + n_right else 0.0
    if shared:
        best = max(best, *(100.0 * (1 - (gap + len(own)) / (2 * len(shared) + gap + len(own))) for own in (left, right)))
    return best


@F.pandas_udf(T.DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(T.DoubleType())
def token_set(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype=float)
