"""What tells rows apart by their content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key(df: DataFrame) -> Column:
    """96 bits of hash over all columns (maps as text), the same wherever and however often a plan computes the row; equal rows have equal keys.

    A running number would differ between the branches of a plan that come back together in a join.
    """
    columns = [F.to_json(c) if k.startswith("map") else F.col(f"`{c}`") for c, k in df.dtypes]
    return F.struct(F.xxhash64(*columns).alias("h"), F.hash(*columns).alias("i"))
