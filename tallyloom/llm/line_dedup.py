"""Line deduplication by winnowing over line hashes, in DataFrame expressions alone.

Lines are what stands between \\n; lines without a word are never compared and always stay. Of each MIN_LINES consecutive lines
of a document (blank ones left out) the one with the smallest hash, the rightmost on ties, is a fingerprint; so two equal runs
of MIN_LINES lines have an equal fingerprint at the same place. One row a fingerprint goes on, with the line hashes next to it on either side. Places whose
fingerprint stands elsewhere too are joined with the first place that has the same lines around it, for each way in which a run of MIN_LINES lines can lie around
the fingerprint; the match is then extended to the left and right, line by line, as far as both agree. Of a match of MIN_LINES lines or more the later place goes,
in the order of doc_id (null first), text hash and line. A longer run is cut by the matches of all its fingerprints, which overlap.

Nothing pairs up the places of a group: a place meets only the first one, and a fingerprint that a third of all documents share is dealt over many tasks.

A null or empty text has no lines and stays as it is. Rows that agree in doc_id and text are one document: none is a later copy of
the other. Documents shorter than MIN_LINES lines stay whole. A document's lines are looked at together, however long it is. Of equal runs the first place stays.
Other columns pass unchanged, whatever their names, but for kept_text, n_lines and n_removed, which are the result's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import let, meet, table, written

MIN_LINES = 3
_WORD = "[^\\x20\\x09-\\x0D]"


def _fingerprints(hashes: Column, n: int) -> Column:
    """mark (0-based place), print, and the up to n - 1 hashes before (nearest first) and after it, of each fingerprint of a document."""

    def marked(j):
        run = F.slice(hashes, j + 1, n)
        return (j + n - F.array_position(F.reverse(run), F.array_min(run))).cast("int")

    def of(k):
        before = F.reverse(F.slice(hashes, F.greatest(k + 2 - n, F.lit(1)), F.least(k, F.lit(n - 1))))
        return F.struct(k.alias("mark"), F.get(hashes, k).alias("print"), before.alias("before"), F.slice(hashes, k + 2, F.lit(n - 1)).alias("after"))

    marks = F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(hashes) - n), marked))
    return F.when(F.size(hashes) >= n, let(marks, lambda m: F.transform(m, of))).otherwise(F.array())


def _agreeing(a: Column, b: Column) -> Column:
    """How many values at the beginning of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return let(F.array_position(same, False), lambda k: F.when(k > 0, k - 1).otherwise(F.size(same))).cast("int")


def _cut(lines: Column, runs: Column) -> Column:
    """struct(kept, n_cut): the lines without those in the runs (first and last, counted among lines with a word)."""
    full = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(_WORD), i)), lambda i: i.isNotNull())

    def with_places(full):
        places = F.flatten(F.transform(runs, lambda r: F.slice(full, r["first"] + 1, r["last"] - r["first"] + 1)))

        def with_gone(gone):
            stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
            return F.struct(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n").alias("kept"), F.size(gone).alias("n_cut"))

        return let(F.array_distinct(places), with_gone)

    return let(full, with_places)


def later_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """doc_key, text_key, first and last (0-based, blank lines left out) of runs of min_lines lines or more that an earlier place has too; they overlap."""
    n = min_lines
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: x.rlike(_WORD))
    hashed = docs.filter(F.col("text").isNotNull()).select(*_keys(), F.transform(lines, lambda x: F.xxhash64(x)).alias("hashes"))
    prints = hashed.filter(F.size("hashes") >= n).select("doc_key", "text_key", F.explode(let(F.col("hashes"), lambda h: _fingerprints(h, n))).alias("p")).select("doc_key", "text_key", "p.*")
    place = F.xxhash64("doc_key", "text_key", "mark")
    counted = prints.groupBy("print").agg(F.count("*").alias("n"), F.min(place).alias("_low"), F.max(place).alias("_high"))
    shared = written(counted.filter("_low <> _high").select("print", "n"), "prints")

    ways = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: (j <= F.size("before")) & (n - 1 - j <= F.size("after")))  # j lines of the run lie before the fingerprint
    seeds = meet(prints, shared, ["print"]).withColumn("way", F.explode(ways))
    around = F.xxhash64(F.slice("before", F.lit(1), F.col("way")), F.lit(0), F.slice("after", F.lit(1), n - 1 - F.col("way")))
    seeds = written(seeds.withColumn("around", around), "seeds")
    at = F.struct("doc_key", "text_key", "mark", "before", "after")
    firsts = seeds.groupBy("print", "way", "around").agg(F.count("*").alias("n"), F.min(at).alias("origin")).filter("n > 1")
    matches = meet(seeds, written(firsts, "firsts"), ["print", "way", "around"])
    later = matches.filter(F.struct("doc_key", "text_key", "mark") != F.struct("origin.doc_key", "origin.text_key", "origin.mark"))
    left, right = _agreeing(F.col("before"), F.col("origin.before")), _agreeing(F.col("after"), F.col("origin.after"))
    runs = later.select("doc_key", "text_key", "mark", left.alias("left"), right.alias("right")).filter(F.col("left") + F.col("right") + 1 >= n)
    return runs.select("doc_key", "text_key", (F.col("mark") - F.col("left")).alias("first"), (F.col("mark") + F.col("right")).alias("last")).distinct()


def _keys() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("doc_key"), F.xxhash64("text").alias("text_key")]


def drop_later_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """The rows of docs with kept_text in place of the repeated runs, n_lines and n_removed."""
    own = docs.drop("kept_text", "n_lines", "n_removed")
    gone = later_runs(docs.select("doc_id", "text"), min_lines).groupBy("doc_key", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    joined = own.select(F.struct("*").alias("row"), F.col("text").alias("text"), *_keys()).join(gone, ["doc_key", "text_key"], "left")
    cut = let(F.split(F.col("text"), "\n"), lambda lines: _cut(lines, F.col("runs")))
    out = joined.select(
        "row", F.when(F.col("runs").isNotNull(), cut).alias("result"), "text",
        F.when(F.coalesce(F.col("text"), F.lit("")) == "", 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
    )
    kept = F.when(F.col("result").isNotNull(), F.col("result.kept")).otherwise(F.col("text"))
    return out.select("row.*", kept.alias("kept_text"), "n_lines", F.coalesce(F.col("result.n_cut"), F.lit(0)).cast("bigint").alias("n_removed"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_later_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = """
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL
), full_lines AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM split WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), runs AS (
  SELECT doc_id, k, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
  FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), ranked AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS nth FROM runs WHERE c IS NOT NULL
), cut AS (
  SELECT DISTINCT doc_id, k + d AS k FROM ranked, (SELECT unnest(range(3)) AS d) AS steps WHERE nth > 1
), cut_lines AS (
  SELECT f.doc_id, f.i FROM full_lines f JOIN cut c ON f.doc_id = c.doc_id AND f.k = c.k
), kept AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.i) AS kept_text, count(*) AS n_kept
  FROM split s LEFT JOIN cut_lines c ON s.doc_id = c.doc_id AND s.i = c.i WHERE c.i IS NULL GROUP BY s.doc_id
)
SELECT d.doc_id, CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
  CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE len(string_split(d.text, chr(10))) - coalesce(k.n_kept, 0) END AS n_removed,
  sha256(coalesce(k.kept_text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
