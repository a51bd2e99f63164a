"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents, with their decisions in effect.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontamination, language_id, line_dedup, near_dedup, piece_lattice
from tallyloom.llm.common import discarded, ensure_checkpoint_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if it has a language whose spans hold at least this share of its letters.
LEAST_SHARE = 0.4
SHINGLE = 5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, or with no language that prevails; the others get the language found."""
    model = language_id.train(docs)
    found = language_id.annotate(docs.select(COLUMNS), model)
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.col("lang_pred")).select(COLUMNS)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later repeats of runs of lines; documents that lose all their words go."""
    cut = line_dedup.drop_later_runs(docs.select(COLUMNS)).filter((F.col("n_removed") == 0) | F.col("kept_text").rlike("[^\\x20\\x09-\\x0D]"))
    text = F.col("kept_text")
    return cut.withColumns({"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text).cast("bigint")).otherwise(F.col("n_chars"))}).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest doc_id stays; documents are told apart by doc_id and text."""
    return near_dedup.without_near_copies(docs.select(COLUMNS), SHINGLE)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontamination.without_leaks(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces: the best segmentation's ids, what the others of the n best change in them, and the scores."""
    return piece_lattice.encode_nbest(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", cut_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each result is written to the shared folder that the session names, and read from there.

    A stage's result goes when the next one's is written, the last one when the driver ends.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{ensure_checkpoint_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        discarded(spark, path)
        if before is not None:
            discarded(spark, before, now=True)
        docs, before = spark.read.parquet(path), path
    return docs


#: The stages learn, link and segment in ways that SQL has no words for; tests hold run() against a brute-force version.
ORACLE_SQL = None
