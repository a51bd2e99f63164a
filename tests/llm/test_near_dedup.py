import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from oracle import assert_same

from tallyloom.llm import near_dedup as N
from tallyloom.llm.components import components

DOCS = "doc_id bigint, text string"


def plain_set(text, n):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def plain(rows, n):
    """All links by an inverted index over every shingle, then the smallest reachable id."""
    sets = {d: plain_set(t, n) for d, t in rows}
    by = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            by[g].append(d)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d, s in sets.items():
        same = defaultdict(int)
        for g in s:
            for e in by[g]:
                if e < d:
                    same[e] += 1
        for e, k in same.items():
            if 100 * k >= 80 * (len(s) + len(sets[e]) - k):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def found(spark, rows, n=2):
    got = N.near_duplicates(spark.createDataFrame(rows, DOCS), n).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def family(rng, words, size, sides, edits):
    base = [rng.choice(words) for _ in range(size)]
    out = []
    for _ in range(sides):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(size)] = rng.choice(words)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize(("n", "most"), [(2, 32), (5, 32), (2, 0)])
def test_against_all_pairs(spark, n, most, monkeypatch):
    monkeypatch.setattr(N, "MOST_BLOCKS", most)  # without blocks, hubs look cheaper than buckets
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "SET_BLOCK", 8)
    rng = random.Random(n)
    words = [f"w{i}" for i in range(400)]
    texts = [t for size in (1, 3, 5, 6, 9, 30, 80, 200, 300) for t in family(rng, words, size, 45, max(1, size // 9))]
    texts += [" ".join(rng.choices(["a", "b", "c"], k=rng.randrange(0, 7))) for _ in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(spark, rows, n) == plain(rows, n)


def test_query_on_whole_small_table(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = N.op10_near_dedup(spark, path).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain(rows, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, long), (7, long + " more"), (8, "a b"), (8, "a b"), (9, "b a")]
    df = spark.createDataFrame([*((*r, 1, "z") for r in rows), (None, "one", 1, "z")], DOCS + ", n bigint, sig string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in N.near_duplicates(df, 2).collect())
    assert got == [(0, 1, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 5000, 6), (7, 5001, 6), (8, 1, 8), (8, 1, 8), (9, 1, 9)]
    assert found(spark, []) == {}


def test_pigeonhole_key_for_every_pair_within_distance():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (300, N.SLOTS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(N.SLOTS, N.DISTANCE, replace=False)] ^= 1
    assert (N.distances(a, b) == N.DISTANCE).all() and (N.keys(a) == N.keys(b)).any(axis=1).all()


def test_set_links_connect_as_all_links():
    rng = random.Random(9)
    for _ in range(30):
        sets = [sorted(rng.sample(range(40), rng.randrange(1, 40))) for _ in range(25)]
        sets += [sorted({*s[1:], rng.randrange(40)}) for s in sets]
        bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
        want, got = list(range(len(sets))), list(range(len(sets)))

        def find(root, x):
            while root[x] != x:
                x = root[x]
            return x

        for x in range(len(sets)):
            for y in range(x):
                if 100 * len({*sets[x]} & {*sets[y]}) >= 80 * len({*sets[x]} | {*sets[y]}):
                    want[find(want, x)] = find(want, y)
        found = N.set_links((np.concatenate(sets), bounds), 80)
        for x, y in found:
            got[find(got, x)] = find(got, y)
        assert len(found) < len(sets)
        assert all((find(want, x) == find(want, y)) == (find(got, x) == find(got, y)) for x in range(len(sets)) for y in range(x))


@pytest.mark.parametrize("cuts", [[], [1, 2, 3, 4, 5, 6, 7, 8], [3], [5], [2, 6], [0, 9]])
def test_runs_over_any_batches(cuts):
    rows = [(1, 4), (2, 1), (2, 5), (3, 1), (3, 2), (3, 3), (3, 9), (4, 7), (5, 2), (5, 3)]
    batches = [pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows[a:b]], pa.int64()), pa.array([x for _, x in rows[a:b]], pa.int64())], ["key", "node"]) for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
    got = [tuple(r.values()) for x in N._runs(iter(batches)) for r in x.to_pylist()]
    assert got == [(2, 1, 1, False), (2, 5, 1, False), (3, 1, 1, True), (3, 2, 1, True), (3, 3, 1, True), (3, 9, 1, True), (5, 2, 2, False), (5, 3, 2, False)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(25)] + [(7, 7), (None, 1)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if x is not None and find(x) != x}


@pytest.mark.parametrize(("edges", "rounds"), [([], 0), ([(1, 2), (1, 3), (5, 4), (2, 1)], 0), ([(1, 2), (2, 3)], 1), ([(3, 1), (3, 2)], 1)])
def test_rounds_of_components(spark, monkeypatch, edges, rounds):
    from tallyloom.llm import components as C

    large, taken = C._large_star, []
    monkeypatch.setattr(C, "_large_star", lambda now: taken.append(1) or large(now))
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(taken) == rounds
    assert got == {0: {(2, 1), (3, 1), (5, 4)} if edges else set(), 1: {(2, 1), (3, 1)}}[rounds]


def test_each_large_star_is_computed_once(spark, monkeypatch):
    from tallyloom.llm import components as C

    small, plans = C._small_star, []
    monkeypatch.setattr(C, "_small_star", lambda large: plans.append(large._jdf.queryExecution().optimizedPlan().toString()) or small(large))
    hub = [(0, i) for i in range(1, 300)] + [(i, i + 300) for i in range(1, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(hub, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 600) if i != 300}
    assert plans and not any("Join" in p for p in plans)  # the small star reads it twice


def test_one_id_on_several_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b), (9, c), (9, b + " more"), (11, c)]
    got = sorted((r.doc_id, r.component_id) for r in N.near_duplicates(spark.createDataFrame(rows, DOCS), 2).collect())
    assert got == [(1, 1), (5, 1), (5, 1), (7, 1), (9, 1), (9, 1), (11, 1)]
    got = N.near_duplicates(spark.createDataFrame([(5, a), (5, b), (7, c)], DOCS), 2).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (7, 7)]


def test_without_near_copies_judges_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (None, c, "x"), (None, c, "y"), (None, c, "x"), (8, c + " more", "z"), (9, None, "x"), (9, None, "x"), (10, "", "x"), (11, a + " more", "x"), (12, "w", "x"), (12, "w", "x")]
    got = sorted((tuple(r) for r in N.without_near_copies(spark.createDataFrame(rows, DOCS + ", th string"), 5).collect()), key=str)
    want = [(1, a, "x"), (5, b, "x"), (8, c + " more", "z"), (9, None, "x"), (9, None, "x"), (10, "", "x"), (12, "w", "x")]
    assert got == sorted(want, key=str)
    assert N.without_near_copies(spark.createDataFrame([], DOCS)).count() == 0


def test_split_keys_give_the_same(spark, monkeypatch):
    from tallyloom.llm import common

    monkeypatch.setattr(common, "LEAST_PIECE", 2)
    monkeypatch.setattr(common, "PIECES", 8)
    rng = random.Random(2)
    rows = list(enumerate([*family(rng, [f"w{i}" for i in range(300)], 60, 60, 4), *["the same words here"] * 40, *["other words"] * 3]))
    assert found(spark, rows, 2) == plain(rows, 2)


def test_query_against_sql(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    assert_same(N.op10_near_dedup(spark, path), path, N.OP10_SQL)
