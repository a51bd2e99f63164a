"""Likeness of names by their sets of words, 0 to 100."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a whole row of the table at a time as bits of one number."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 less the share of characters to insert or delete."""
    total = len(a) + len(b)
    return 200.0 * common_subsequence(a, b) / total if total else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """100 if one set of words holds the other; else the best of the joined words, shared and own, against each other."""
    one, two = set(a.split()), set(b.split())
    if not one or not two:
        return 0.0
    shared, left, right = (" ".join(sorted(x)) for x in (one & two, one - two, two - one))
    if shared and not (left and right):
        return 100.0
    first, second = (f"{shared} {x}".strip() for x in (left, right))
    scores = [indel_ratio(first, second)]
    if shared:
        scores += [indel_ratio(shared, first), indel_ratio(shared, second)]
    return max(scores)


@F.pandas_udf(DoubleType())
def token_set_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")
