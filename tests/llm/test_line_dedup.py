import random

import pytest
from oracle import assert_same

from tallyloom.llm import line_dedup as D

DOCS = "doc_id bigint, text string"


def plain(rows, n):
    """Kept text by document: every run of n lines is looked up among all earlier ones."""
    seen, out = {}, {}
    full = {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        full[doc], cut = lines, set()
        for j in range(len(at) - n + 1):
            run = tuple(lines[i] for i in at[j : j + n])
            if run in seen:
                cut.update(at[j : j + n])
            seen.setdefault(run, (doc, j))
        out[doc] = (None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in cut), len(cut))
    return out


def kept(df, n):
    return {r.doc_id: (r.kept_text, r.n_removed) for r in D.drop_later_runs(df, n).collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_against_all_runs(spark, n):
    rng = random.Random(n)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " \t", "é"]) for _ in range(rng.randrange(0, 25)))) for i in range(150)]
    assert kept(spark.createDataFrame(rows, DOCS), n) == plain(rows, n)


def test_odd_rows(spark):
    run = "one\ntwo\nthree"
    long = "\n".join(f"line {i}" for i in range(20_000))
    rows = [(1, run), (2, f"x\n{run}\n\ny"), (3, run), (3, run), (4, None), (5, ""), (6, "one\ntwo"), (None, "p\n" + run), (8, long), (9, "z\n" + long), (10, "q\nq\nq\nq")]
    df = spark.createDataFrame([(*r, 0, "e") for r in rows], DOCS + ", begin int, kept_text string")
    got = {r.doc_id: r for r in D.drop_later_runs(df.drop("kept_text")).collect()}
    assert got[None].kept_text == "p\n" + run  # a null doc_id comes first
    assert got[1].kept_text == "" and got[2].kept_text == "x\n\ny" and got[3].kept_text == ""
    assert got[4].kept_text is None and (got[4].n_lines, got[5].n_lines) == (0, 0)
    assert got[6].kept_text == "one\ntwo" and got[8].n_removed == 0 and got[9].kept_text == "z"
    assert got[10].kept_text == "q" and D.drop_later_runs(df).filter("doc_id = 3").count() == 2


def test_empty(spark):
    assert D.drop_later_runs(spark.createDataFrame([], DOCS)).count() == 0


def test_query_against_sql(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    assert_same(D.op8_line_dedup(spark, path), path, D.OP8_SQL)


def test_nothing_goes_without_extension(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny")]
    assert kept(spark.createDataFrame(rows, DOCS), 3)[2] == ("x\ny", 4)
    monkeypatch.setattr(D, "_agreeing", lambda a, b: F.lit(0))
    assert all(n == 0 for _, n in kept(spark.createDataFrame(rows, DOCS), 3).values())


def test_one_row_a_fingerprint(spark):
    (r,) = spark.createDataFrame([([5, 3, 9, 1, 7, 7],)], "h array<bigint>").select(D._fingerprints(D.F.col("h"), 3).alias("p")).collect()
    assert [(p.mark, p.print, p.before, p.after) for p in r.p] == [(1, 3, [5], [9, 1]), (3, 1, [9, 3], [7, 7])]


def test_clashing_columns_pass(spark):
    rows = [(1, "a\nb\nc", 7, "t", 1.5, "r", "old"), (2, "a\nb\nc", 8, "u", 2.5, "s", "old")]
    df = spark.createDataFrame(rows, DOCS + ", doc_key int, text_key string, _result double, row string, kept_text string")
    got = sorted(tuple(r) for r in D.drop_later_runs(df).collect())
    assert got == [(1, "a\nb\nc", 7, "t", 1.5, "r", "a\nb\nc", 3, 0), (2, "a\nb\nc", 8, "u", 2.5, "s", "", 3, 3)]


@pytest.mark.parametrize("pieces", [4, 1000])
def test_split_keys_give_the_same(spark, monkeypatch, pieces):
    from tallyloom.llm import common

    monkeypatch.setattr(common, "PIECES", pieces)
    monkeypatch.setattr(common, "LEAST_PIECE", 2)
    rng = random.Random(5)
    rows = [(i, "\n".join(["same", "lines", "here"] * (i % 3 > 0) + [rng.choice("abcd") for _ in range(9)])) for i in range(90)]
    assert kept(spark.createDataFrame(rows, DOCS), 3) == plain(rows, 3)
