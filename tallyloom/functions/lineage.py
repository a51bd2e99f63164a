"""Cutting a plan where many steps would otherwise repeat what came before."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What was shuffled to compute a table goes as soon as the table is written, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; if it names none, in the warehouse, or a temporary folder where all runs on this machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and sc.master.startswith("local"):
            named = tempfile.mkdtemp(prefix="tallyloom-checkpoint-")
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tallyloom-checkpoint")
    return sc.getCheckpointDir()


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder until the driver ends, as Parquet, which later plans read only the columns of that they use; what Parquet can't hold, as a checkpoint."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    void = {c for c, k in df.dtypes if k == "void"}
    kept = [c for c in df.columns if c not in void]
    if len({c.lower() for c in df.columns}) < len(df.columns) or not kept or any("void" in k or "interval" in k or "variant" in k for c, k in df.dtypes if c not in void):
        return df.checkpoint()
    path = f"{folder}/settled-{uuid.uuid4().hex}"
    narrow = df.select(*(F.col(_quoted(c)) for c in kept))
    with _shuffles_go(spark):
        narrow.write.option("compression", "zstd").parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    read = spark.read.schema(narrow.schema).parquet(path)
    return read.select(*(F.lit(None).alias(c) if c in void else F.col(_quoted(c)) for c in df.columns))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
