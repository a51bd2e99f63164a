import itertools
import random
import re

import numpy as np
import pyarrow as pa

from tallyloom.llm import decontamination as D

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def bare(text):
    found = (re.sub(r"[!-/:-@\[-`{-~]", "", w).translate({i: i + 32 for i in range(65, 91)}) for w in re.split(r"[\x20\x09-\x0D]+", text or ""))
    return [w for w in found if w]


def plain(docs, items):
    """The best window of every text, item and alignment."""
    out = {}
    for (doc, text), (item, passage) in itertools.product(docs, items):
        a, b = bare(text), bare(passage)
        n = min(D.WINDOW, len(b))
        if len(b) < D.LEAST_WORDS:
            continue
        for i in range(len(a) - n + 1):
            for j in range(len(b) - n + 1):
                same = sum(x == y for x, y in zip(a[i : i + n], b[j : j + n], strict=True))
                if same >= D.SHARE * n - 1e-9:
                    out[doc, item] = max(out.get((doc, item), 0), same)
    return out


def leaks(spark, docs, items):
    got = D.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert len({(r.doc_id, r.item_id) for r in got}) == len(got)
    return {(r.doc_id, r.item_id): r.n_equal for r in got}


def test_masks_find_every_tolerated_window():
    for size, wrong in ((20, 4), (15, 3)):
        for bad in itertools.combinations(range(size), wrong):
            assert any(all(p + i not in bad for i, c in enumerate(m) if c == "1") for m in D.MASKS for p in range(size - len(m) + 1))


def test_every_placement_in_items_of_every_length():
    for n in range(D.LEAST_WORDS, D.WINDOW + 1):
        item = [f"w{i}" for i in range(n)]
        bad = list(itertools.combinations(range(n), n - int(np.ceil(D.SHARE * n - 1e-9))))
        texts = [" ".join(["a", *("x" if i in b else w for i, w in enumerate(item)), "b"]) for b in bad]
        text, _, equal, *_ = D.overlaps(D.find_words(pa.array(texts, pa.large_string()), lower=True, bare=True), D.make_block(pa.array([1]), pa.array([" ".join(item)], pa.large_string())))
        assert text.tolist() == list(range(len(bad))) and set(equal.tolist()) == {n - len(bad[0])}


def test_against_all_alignments(spark, monkeypatch):
    monkeypatch.setattr(D, "CELLS", 64)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([3, 5, 6, 15, 20, 33, 50])))) for k in range(12)]
    docs = []
    for d in range(80):
        text = rng.choices(words, k=rng.randrange(0, 60))
        if d % 2:
            passage = items[rng.randrange(12)][1].split()
            for _ in range(rng.randrange(0, 6)):
                passage[rng.randrange(len(passage))] = "other"
            cut = rng.randrange(0, 6)
            text[10:10] = passage[cut:]
        docs.append((d, " ".join(w.upper() + rng.choice(["", ".", "%%%"]) for w in text)))
    want = plain(docs, items)
    long = {k: v for k, v in want.items() if len(items[k[1]][1].split()) >= 15 or v == len(items[k[1]][1].split())}
    got = leaks(spark, docs, items)
    assert {k: got.get(k) for k in long} == long and got.items() <= want.items() and len(long) > 8


def test_odd_rows(spark):
    passage = " ".join(f"word{i}" for i in range(25))
    docs = [(1, None), (2, ""), (3, passage), (3, passage), (4, "x " * 100_000 + passage), (5, "the the the the " * 500), (6, "word0 word1"), (None, passage), (7, "a b c d e")]
    items = [(1, passage), (1, passage), (2, None), (3, ""), (4, "the the the the the the"), (5, "a b c d"), (6, "A, b; c d e."), (None, "... !!")]
    assert leaks(spark, docs, items) == {(3, 1): 20, (4, 1): 20, (None, 1): 20, (5, 4): 6, (7, 6): 5}
    df = spark.createDataFrame([(*r, 1, "z") for r in docs], DOCS + ", item_id bigint, lang string")
    rest = D.without_leaks(df, spark.createDataFrame(items, ITEMS))
    assert rest.columns == df.columns and sorted(r.doc_id for r in rest.collect()) == [1, 2, 6]
    none = spark.createDataFrame([], ITEMS)
    assert D.without_leaks(df, none).count() == len(docs) and D.find_leaks(df, none).count() == 0
    assert D.find_leaks(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0


def test_blocks_agree(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "benchmark"))
    one = sorted(tuple(r) for r in D.find_leaks(docs, items).collect())
    monkeypatch.setattr(D, "BLOCK_WORDS", 200)
    assert sorted(tuple(r) for r in D.find_leaks(docs, items).collect()) == one and one


def test_query_against_all_alignments(spark, sf_dir):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf_dir}/{x}.parquet").select(y, "text").collect()] for x, y in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = {(r.doc_id, r.item_id): r.n_equal for r in D.op1_decontamination(spark, sf_dir).collect()}
    grams = {g for _, t in items for w in [bare(t)] for g in zip(*(w[i:] for i in range(4)))}
    near = [(d, t) for d, t in docs if any(g in grams for w in [bare(t)] for g in zip(*(w[i:] for i in range(4))))]  # a window with four replaced words of 20 keeps such a run
    assert got == {k: v for k, v in plain(near, items).items()}


def test_seeds_ignore_masked_words():
    a, b = (D.find_words(pa.array([t])) for t in ("a b c d e f", "a b x d e f"))
    assert np.array_equal(D.seeds_of(a.hash, "110111", 1), D.seeds_of(b.hash, "110111", 1))
    assert not np.array_equal(D.seeds_of(a.hash, "111101", 1), D.seeds_of(b.hash, "111101", 1))
