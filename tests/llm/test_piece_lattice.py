import random

import pyarrow as pa
import pytest

from tallyloom.llm import piece_lattice as P

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = {b: 1000 + b for b in range(256)}


@pytest.fixture(scope="module")
def small():
    spelled = ["▁", "▁▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "aa", "aaa", "▁▁a", "é"]
    return P.Lattice([(i, p, -0.37 * (i % 7) - 1.01 / (i + 1)) for i, p in enumerate(spelled)], BYTES)


@pytest.fixture(scope="module")
def model():
    return P.Lattice.load(MODEL)


def every_segmentation(lattice, text):
    """All paths, with their scores."""
    edges = lattice.edges(text)

    def to(end):
        if end == 0:
            yield 0, []
        for begin, score, ids in edges[end] if end else []:
            for s, path in to(begin):
                yield s + score, path + list(ids)

    return sorted(to(len(text)), key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["", "a", "abcabca", "▁abcaab", "▁▁▁a", "xaé", "aaaaaa", "€▁b"])
def test_a_star_against_all_paths(small, text):
    want = every_segmentation(small, text)
    for n in (1, 3, 8, 1000):
        got = small.nbest(text, n)
        assert [s for s, _ in got] == [s for s, _ in want[:n]]
        assert len({tuple(x) for _, x in got}) == len(got) and all((s, x) in want for s, x in got)


def rebuilt(ids, change):
    for c in sorted(change, key=lambda c: -c["piece"]):
        ids = ids[: c["piece"]] + c["ids"] + ids[c["piece"] + c["n"] :]
    return ids


def check(lattice, texts, n):
    got = P.encode_texts(lattice, pa.array(texts, pa.string()), n)
    for i, text in enumerate(texts):
        text = text or ""
        ids = got["ids"][got["bounds"][i] : got["bounds"][i + 1]].tolist()
        assert got["round_trip"][i] and lattice.decode(ids) == text
        if P.MARK in text:
            continue
        whole = lattice.nbest("▁" + text.replace(" ", "▁") if text else "", n)  # the lattice of the whole text at once
        assert [round(s * P.UNIT) for s in got["scores"][i]] == [s for s, _ in whole]
        paths = [rebuilt(ids, c) for c in ([], *got["changes"][i])]
        assert len({tuple(p) for p in paths}) == len(paths) and all(lattice.decode(p) == text for p in paths)


def test_texts_against_whole_lattice(small):
    rng = random.Random(3)
    texts = ["".join(rng.choices("aabbc  xé\n€", k=rng.randrange(0, 14))) for _ in range(300)]
    for n in (1, 2, 5):
        check(small, texts, n)


def test_real_model_and_odd_texts(model):
    rng = random.Random(5)
    odd = [None, "", " ", "  two", "▁", "a▁ b", "\n\n", "naïve Ünï 漢字 🙂", "x" * 300, "\t tab", "\x00", "the " * 50, " ".join(f"Wörter{i}" for i in range(40))]
    check(model, odd + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2000)])) for _ in range(20)) for _ in range(50)], 4)


def test_best_segmentation_uses_ranks(model):
    assert P.Lattice.units(__import__("numpy").array([0.0, -1.0, -2.0])).tolist() == sorted(P.Lattice.units(__import__("numpy").array([0.0, -1.0, -2.0])).tolist(), reverse=True)
    ((_, ids),) = model.nbest("▁the", 1)
    assert len(ids) == 1


def test_cache_bound_does_not_change_results(small, monkeypatch):
    texts = ["abc ab a", "ca bc abc aaa", "b b b aa"]
    whole = P.encode_texts(small, pa.array(texts), 3)
    monkeypatch.setattr(P, "CACHED_SEGMENTS", 2)
    fresh = P.Lattice([(i, b.decode().replace(" ", "▁"), 0.0) for i, b in small.bytes_of.items() if i < 1000], BYTES)
    fresh.hashes, fresh.piece_score, fresh.piece_id, fresh.score_of, fresh.worst, fresh.maybe = small.hashes, small.piece_score, small.piece_id, small.score_of, small.worst, small.maybe
    for k, t in enumerate(texts):
        got = P.encode_texts(fresh, pa.array([t]), 3)
        assert got["scores"][0] == whole["scores"][k] and got["ids"].tolist() == whole["ids"][whole["bounds"][k] : whole["bounds"][k + 1]].tolist()


def test_query_and_decoding(spark, sf_dir):
    got = P.op6_sentencepiece(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(got) == docs.count() and all(r.round_trip and r.scores == sorted(r.scores, reverse=True) for r in got)
    some = docs.filter("doc_id < 20")
    ids = P.encode_nbest(some, MODEL)
    assert {r.doc_id: r.text for r in P.decode_ids(ids, MODEL).collect()} == {r.doc_id: r.text for r in some.collect()}


def test_query_gives_every_segmentation(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    lattice = P.Lattice.load(MODEL)
    for r in P.op6_sentencepiece(spark, sf_dir).collect():
        assert len(r.ids) == r.n_pieces and lattice.decode(r.ids) == texts[r.doc_id] and len(r.changes) == len(r.scores) - 1
        paths = [rebuilt(r.ids, c) for c in ([], *r.changes)]
        assert len({tuple(x) for x in paths}) == len(paths) and all(lattice.decode(x) == texts[r.doc_id] for x in paths)


def test_rows(spark):
    df = spark.createDataFrame([(1, "the word", "x"), (1, "the word", "x"), (None, None, "x"), (2, "long " * 40_000, "x")], "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id or 0, r.n_pieces, r.round_trip, len(r.scores)) for r in P.encode_nbest(df, MODEL, 2).collect())
    assert [g[2] for g in got] == [True] * 4 and got[0][:2] == (0, 0) and got[1] == got[2]
    assert P.encode_nbest(spark.createDataFrame([], "doc_id bigint, text string"), MODEL).count() == 0


def test_many_ties_stay_cheap(small):
    got = small.nbest("a" * 400, 5)
    assert len(got) == 5 and got[0][0] >= got[4][0]
