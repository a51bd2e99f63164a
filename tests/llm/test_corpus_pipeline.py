import zlib

import numpy as np
import pytest
import test_decontamination
import test_line_dedup
import test_near_dedup

import corpus_pipeline as C
from tallyloom.llm import language_id, piece_lattice


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Input and output rows of every stage."""
    path = sf_dir.replace("sf0.001", "sf0.01")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in C.STAGES:
        to = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, path).write.parquet(to)
        after = spark.read.parquet(to)
        out.append((docs, after))
        docs = after
    return path, out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for _, after in stages[1][:-1]:
        assert sorted(after.columns) == sorted(C.COLUMNS)


def test_language_stage(spark, stages):
    before, after = stages[1][0]
    known, kept = texts(before), {r.doc_id: r for r in after.collect()}
    model = language_id.train(before)
    for doc, text in known.items():
        words = [(lang, b - a) for lang, a, b in language_id.spans(text, model)]
        assert (doc in kept) or not any(x.isalpha() for x in text) or len({x for x, _ in words}) > 1
        if doc in kept:
            assert kept[doc].text == text and kept[doc].lang in {x for x, _ in words}
    assert len(kept) > 0.98 * len(known)


def test_line_stage(stages):
    before, after = (texts(x) for x in stages[1][1])
    want = {d: t for d, (t, n) in test_line_dedup.plain(list(before.items()), 3).items() if not n or t.strip(" \t\n\x0b\x0c\r")}
    assert after == want and len(after) < len(before)
    assert all(r.n_chars == len(r.text) for r in stages[1][1][1].collect())


def test_near_stage(stages):
    before, after = (texts(x) for x in stages[1][2])
    want = {d for d, (_, root) in test_near_dedup.plain(list(before.items()), 5).items() if root == d}
    assert set(after) == want and len(after) < len(before) and all(before[d] == t for d, t in after.items())


def test_leak_stage(spark, stages):
    before, after = (texts(x) for x in stages[1][3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{stages[0]}/benchmark.parquet").collect()]
    grams = {g for _, t in items for w in [test_decontamination.bare(t)] for g in zip(*(w[i:] for i in range(4)))}
    near = [(d, t) for d, t in before.items() if any(g in grams for w in [test_decontamination.bare(t)] for g in zip(*(w[i:] for i in range(4))))]
    assert set(before) - set(after) == {d for d, _ in test_decontamination.plain(near, items)}


def test_encoding_stage(stages):
    import public_tokenizers

    before, after = texts(stages[1][4][0]), stages[1][4][1].collect()
    lattice = piece_lattice.Lattice.load(public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id for r in after} == set(before) and all(r.round_trip for r in after)
    for r in after[:30]:
        ((score, ids),) = lattice.nbest("▁" + before[r.doc_id].replace(" ", "▁"), 1)
        assert round(r.scores[0] * piece_lattice.UNIT) == score and lattice.decode(ids) == before[r.doc_id]
        assert r.n_pieces > 0 and 0 <= r.ids_crc32 == r.ids_crc32 & 0xFFFFFFFF
    assert zlib.crc32(np.array([1], "<u4").tobytes()) > 0


def test_run_ends_with_the_encoded_corpus(stages):
    import public_tokenizers

    before, after = texts(stages[1][4][0]), stages[1][4][1].collect()
    lattice = piece_lattice.Lattice.load(public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: lattice.decode(r.ids) for r in after} == before
    assert all(len(r.changes) == len(r.scores) - 1 for r in after)


def test_run_and_odd_rows(spark, sf_dir, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "some words of a text", None, "s", 5), (None, "and more words of the text", "en", None, 3), (3, "12 34", "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("odd", rows), ("empty", [])):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
        got = C.run(spark, str(tmp_path / name))
        assert sorted((r.doc_id or 0) for r in got.collect()) == ([0, 2] if data else [])
    assert C.run(spark, sf_dir).count() > 0
