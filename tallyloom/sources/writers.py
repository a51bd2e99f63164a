"""Sinks: tables as CSV or Parquet without an index, and small documents as JSON or text."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def flat(df: DataFrame) -> DataFrame:
    """For CSV: maps and structs as JSON, lists joined by a pipe."""
    kinds = dict(df.dtypes)
    turned = {c: F.concat_ws("|", c) if k == "array<string>" else F.to_json(c) for c, k in kinds.items() if k.startswith(("array", "map", "struct"))}
    return df.withColumns(turned) if turned else df


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}.csv")


def write_document(spark: SparkSession, value: dict | str, path: str) -> None:
    """A small document of the driver's, as JSON or text, to any place that Spark can write to."""
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, indent=2, default=str)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def summary_text(title: str, tables: dict[str, DataFrame]) -> str:
    """Small tables as text."""
    lines = [title, "=" * len(title)]
    for name, df in tables.items():
        lines += ["", name]
        for row in df.collect():
            lines.append("  " + "  ".join(f"{v:,.0f}" if isinstance(v, float) else str(v) for v in row))
    return "\n".join(lines) + "\n"
