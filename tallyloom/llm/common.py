"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space, \t, \n, \v, \f, \r.
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the one that the session names, else one in the warehouse; a temporary one only where all runs on this machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and sc.master.startswith("local"):
            named = tempfile.mkdtemp(prefix="tallyloom-checkpoint-")
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tallyloom-checkpoint")
    return sc.getCheckpointDir()


def discarded(spark: SparkSession, path: str, now: bool = False) -> None:
    """path, a written table that nothing needs any more (now), or not after the driver's end, goes."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if now:
        files.delete(place, True)
    else:
        files.deleteOnExit(place)


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed and kept in the shared checkpoint folder, so that no later stage depends on one executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared checkpoint folder, which goes when the driver ends; smaller than a checkpoint."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    discarded(spark, path)
    return spark.read.schema(df.schema).parquet(path)


#: A key with more than a share of 1 / PIECES of all rows is split, and a piece holds LEAST_PIECE rows at least.
PIECES, LEAST_PIECE = 1024, 100


def meet(rows: DataFrame, keyed: DataFrame, on: list[str], n: str = "n", how: str = "inner") -> DataFrame:
    """rows joined (inner or left) with keyed, a written table with one row a key and the number n of its rows among rows; keys that many rows share are split.

    Fewer than PIECES keys can have more than 1 / PIECES of all rows, so their list is small at any size and is broadcast: rows learn from it into
    how many pieces their key is split, and the key's row of keyed is copied to every piece. Other keys stay whole.
    """
    total, top = keyed.agg(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.max(n), F.lit(0))).first()
    most = max(LEAST_PIECE, int(total) // PIECES)
    if top <= most:
        return rows.join(keyed.drop(n), on, how)
    pieces = F.ceil(F.col(n) / most).cast("int")
    hot = keyed.filter(F.col(n) > most).select(*on, pieces.alias("_pieces"))
    dealt = rows.join(F.broadcast(hot), on, "left").withColumn("_piece", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("_pieces")), F.lit(0)).cast("int")).drop("_pieces")
    copied = keyed.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.when(F.col(n) > most, pieces - 1).otherwise(0)))).drop(n)
    return dealt.join(copied, [*on, "_piece"], how).drop("_piece")


def words_of(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value computed once a row, however often body's lambdas ask for it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lean(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """rows, a function for mapInArrow, after whose last batch the worker gives freed memory back: workers outlive their tasks, and what they keep counts against their executor."""

    @functools.wraps(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
                trim(0)

    return run


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut where the texts of a slice would exceed most_bytes; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin, total = 0, 0
        for i, n in enumerate(sizes):
            if i > begin and total + n > most_bytes:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        yield batch.slice(begin)
