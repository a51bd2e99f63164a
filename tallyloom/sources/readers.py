"""Sources: registers, lists and documents as DataFrames. A path is any that Spark can read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import constants as K


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def resolve(spark: SparkSession, path: str) -> str:
    """path, or the same with .parquet or .csv, the first that exists; Parquet comes first."""
    stem = path.removesuffix(".parquet").removesuffix(".csv")
    found = next((p for p in (f"{stem}.parquet", f"{stem}.csv", path) if path_exists(spark, p)), None)
    if found is None:
        raise FileNotFoundError(path)
    return found


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """A Parquet or CSV table, in the columns that it has of those asked for; CSV values stay text."""
    df = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_csv(spark, path, multi_line)
    return df if columns is None else df.select(*(c for c in columns if c in df.columns))


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A CSV with a header, doubled quotes, and any byte-order mark taken off.

    multi_line: quoted fields may hold line ends, for which a file is read by one task. Without it a file is split among tasks, line by line.
    """
    df = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    return df.withColumnsRenamed({c: c.lstrip("﻿").strip() for c in df.columns})


def read_awards(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The register, in the columns that matching uses; amounts as numbers, with not-a-number as null. multi_line=False splits a CSV that has no line ends within fields."""
    df = read_table(spark, resolve(spark, path), K.AWARD_COLUMNS, multi_line)
    money = {c: F.when(~F.isnan(F.col(c).try_cast("double")), F.col(c).try_cast("double")) for c in ("amount_eur", "amount_gge_eur") if c in df.columns}
    return df.withColumns(money) if money else df


def read_company_list(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path)
    if "company_name" not in df.columns:
        raise ValueError(f"{path} has no column company_name, only {', '.join(df.columns)}")
    return df


def read_participants(spark: SparkSession, path: str) -> DataFrame:
    df = read_table(spark, path)
    return df.withColumns({"project_id": F.col("project_id").try_cast("bigint"), "ec_contribution": F.col("ec_contribution").try_cast("double")})


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table if it is there, else one without rows."""
    return read_table(spark, path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_zip_member(spark: SparkSession, path: str, member: str, columns: list[str]) -> DataFrame:
    """A CSV inside ZIP files: a file is opened on an executor and its lines read one by one, a thousand rows at a time."""

    def run(batches):
        import csv
        import io
        import zipfile

        import pyarrow as pa

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], pa.string()) for c in columns], columns)

        for batch in batches:
            for content in batch.column("content"):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z, z.open(member) as f:
                    rows = []
                    for row in csv.DictReader(io.TextIOWrapper(f, "utf-8-sig", newline="")):
                        rows.append(row)
                        if len(rows) == 1000:
                            yield out(rows)
                            rows = []
                    yield out(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, ", ".join(f"`{c}` string" for c in columns))


def read_allowances(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Installations and compliance rows of the emission register's archive."""
    installations = read_zip_member(spark, path, "installation.csv", ["id", "name", "registry_id", "nace_id", "city"])
    rows = read_zip_member(spark, path, "compliance.csv", ["installation_id", "year", "allocatedFree", "allocatedTotal", "verified"])
    return installations, rows.withColumns({"year": F.col("year").try_cast("int")} | {c: F.col(c).try_cast("double") for c in ("allocatedFree", "allocatedTotal", "verified")})


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path and content of the files of a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
