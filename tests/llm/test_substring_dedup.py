import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from oracle import assert_same
from pyspark.sql import functions as F

from tallyloom.llm import substring_dedup as S

DOCS = "doc_id bigint, text string"


def plain(texts, span):
    """The words kept of each text, by counting every window."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + span]) for w in words for i in range(len(w) - span + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - span + 1):
            if seen[tuple(w[i : i + span])] > 1:
                gone.update(range(i, i + span))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def found(spark, rows, span, gram):
    got = S.without_repeats(spark.createDataFrame(rows, DOCS), span, gram).collect()
    for r in got:
        assert sum(f.n for f in r.factors) >= r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str)


@pytest.mark.parametrize(("span", "gram", "hot"), [(5, 2, 500), (7, 3, 20), (9, 9, 3), (35, 12, 500), (35, 8, 0)])
def test_against_all_windows(spark, span, gram, hot, monkeypatch):
    monkeypatch.setattr(S, "HOT", hot)
    rng = random.Random(span)
    passages = [[f"w{rng.randrange(50)}" for _ in range(rng.randrange(span - 2, 4 * span))] for _ in range(6)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randrange(0, 4)):
            text += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 2 * span))]
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            text += p[a : a + rng.randrange(3 * span)] if rng.random() < 0.7 else ["x", "y"] * rng.randrange(span)
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [(200 + i, rows[i][1]) for i in range(10)]
    want = sorted(((d, *x) for (d, _), x in zip(rows, plain([t for _, t in rows], span), strict=True)), key=str)
    assert found(spark, rows, span, gram) == want and any(x[2] for x in want)


def test_query_on_whole_small_table(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    rows = spark.read.parquet(f"{path}/documents.parquet").collect()
    want = {r.doc_id: (n, k, hashlib.sha256(t.encode()).hexdigest()) for r, (n, k, t) in zip(rows, plain([r.text for r in rows], 35), strict=True)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.op9_substring_dedup(spark, path).collect()} == want


def test_odd_rows(spark):
    run = " ".join(f"w{i}" for i in range(35))
    long = " ".join(f"v{i}" for i in range(50_000))
    rows = [(1, None), (2, ""), (3, "few words"), (4, run), (5, f"a {run} b"), (6, "k " * 36), (7, "m " * 35), (8, long), (9, "z " + long), (10, run.replace("w34", "W34")), (11, "few words"), (12, run + " x"), (12, run + " x"), (None, f"n\n{run}")]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], DOCS + ", th int, hits string")
    got = sorted(((r.doc_id, r.n_removed, r.kept_text) for r in S.without_repeats(df).collect()), key=str)
    want = [(1, 0, ""), (2, 0, ""), (3, 0, "few words"), (4, 35, ""), (5, 35, "a b"), (6, 36, ""), (7, 0, ("m " * 35).strip()), (8, 50_000, ""), (9, 50_000, "z"), (10, 0, rows[9][1]), (11, 0, "few words"), (12, 36, ""), (12, 36, ""), (None, 35, "n")]
    assert got == sorted(want, key=str)
    assert S.without_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_anchors_are_in_every_window():
    rng = random.Random(1)
    texts = [" ".join(rng.choices("abc", k=rng.randrange(0, 90))) for _ in range(40)]
    p = S.Parsed(pa.array(texts), 12, 4)
    at = p.anchors()
    for b in p.begin:
        assert ((at >= b) & (at <= b + 8)).any()
    assert len(p.windows_of(at)) == len(p.begin) and len(p.windows_of(np.zeros(0, np.int64))) == 0


@pytest.mark.parametrize("cuts", [[], [1, 2, 3, 4], [2], [3]])
def test_blocks_over_any_batches(cuts):
    rows = [(1, 1, 0, [5, 6]), (2, 1, 3, [7]), (2, 2, 9, [7, 8]), (2, 3, 4, [6, 7, 8]), (3, 1, 0, [5])]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
    made = [pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*[(a, d, 0, s, w) for a, d, s, w in rows[i:j]]), kinds, strict=True)], ["anchor", "did", "th", "start", "windows"]) for i, j in zip([0, *cuts], [*cuts, 5], strict=True)]
    got = sorted(tuple(r.values()) for b in S._parsed(iter(made)) for r in b.to_pylist())
    assert got == [(1, 0, 3, 1, 2, 9), (2, 0, 9, 2, 3, 5), (3, 0, 5, 2, 2, 9)]


def test_block_against_all_places():
    """The longest match of each place with any other, by trying all; factors cover just the repeated windows."""
    rng = random.Random(3)
    for _ in range(60):
        rows = [[rng.randrange(4) for _ in range(rng.randrange(0, 12))] for _ in range(rng.randrange(1, 9))]
        kinds = np.array([rng.randrange(2) for _ in rows])
        bounds = np.cumsum([0, *map(len, rows)])
        block = S.Block(np.array([x for r in rows for x in r], np.int64), bounds, kinds)
        spots = [(i, j) for i, r in enumerate(rows) for j in range(len(r))]

        def common(a, b):
            (i, j), (k, m) = a, b
            x, y = rows[i][j:], rows[k][m:]
            n = next((q for q in range(min(len(x), len(y))) if x[q] != y[q]), min(len(x), len(y)))
            return n if kinds[i] == kinds[k] else 0

        longest = [max((common(a, b) for b in spots if b != a), default=0) for a in spots]
        assert block.long.tolist() == longest
        assert all(common(a, spots[block.source[p]]) == n and block.source[p] != p for p, (a, n) in enumerate(zip(spots, longest, strict=True)) if n)
        at, n = block.factors()
        covered = {p for a, k in zip(at.tolist(), n.tolist(), strict=True) for p in range(a, a + k)}
        assert covered == {p for p, k in enumerate(longest) if k}
        assert all(k == longest[a] and (a == 0 or a - 1 not in covered or longest[a - 1] == 0 or any(b + m == a for b, m in zip(at, n, strict=True))) for a, k in zip(at.tolist(), n.tolist(), strict=True))


def test_nothing_goes_without_factors(spark, monkeypatch):
    run = " ".join(f"w{i}" for i in range(60))
    rows = [(1, run), (2, "a " + run), (3, run)]
    assert [x[2] for x in found(spark, rows, 35, 8)] == [60, 60, 60]

    def no_factors(batches):
        for _ in batches:
            yield from ()

    monkeypatch.setattr(S, "_parsed", no_factors)
    assert [x[2] for x in found(spark, rows, 35, 8)] == [60, 0, 60]  # the equal texts alone, each of which is one factor


def test_factors_are_copies(spark):
    run = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(run)), (2, " ".join(["a", *run[:40], "b", *run[10:50]]))]
    got = {r.doc_id: r.factors for r in S.without_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert [tuple(f) for f in got[2]] == [(1, 40, 1, 0), (42, 40, 1, 10)]


def test_rows_of_one_id_with_equal_32_bit_hashes(spark):
    """Of two texts without doc_id whose 32-bit hashes agree, one repeats a passage; the other stays whole."""
    passage, other = (" ".join(f"{x}{i}" for i in range(40)) for x in "pq")
    kinds = [spark.range(200_000).select(F.concat(F.lit(x + " "), F.col("id").cast("string")).alias(n)).withColumn("h", F.hash(n)) for x, n in ((passage, "a"), (other, "b"))]
    a, b = kinds[0].join(kinds[1], "h").select("a", "b").first()
    got = found(spark, [(1, passage + " end"), (None, a), (None, b)], 35, 8)
    assert (None, 41, 0, b) in got and (None, 41, 40, a.split()[-1]) in got


def test_query_against_sql(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    assert_same(S.op9_substring_dedup(spark, path), path, S.OP9_SQL)
