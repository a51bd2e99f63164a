import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyloom.llm import language_id as L

DOCS = "doc_id bigint, text string, lang string"


def plain_path(scores, switch):
    """The best path by trying all."""
    best = max(itertools.product(range(scores.shape[1]), repeat=len(scores)), key=lambda p: sum(scores[i, s] for i, s in enumerate(p)) - switch * sum(a != b for a, b in itertools.pairwise(p)))
    return sum(scores[i, s] for i, s in enumerate(best)) - switch * sum(a != b for a, b in itertools.pairwise(best))


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    counts = [0, 1, 5, 3, 7, 0, 6]
    scores = rng.normal(size=(sum(counts), 3)).astype(np.float32)
    first = np.concatenate(([0], np.cumsum(counts)))
    path = L.viterbi(scores, first, switch=0.7)
    for a, b in itertools.pairwise(first):
        own, s = path[a:b], scores[a:b]
        value = sum(s[i, x] for i, x in enumerate(own)) - 0.7 * sum(x != y for x, y in itertools.pairwise(own))
        assert abs(value - (plain_path(s, 0.7) if b > a else 0)) < 1e-4


def test_held_out_accuracy_and_contract(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    known = {r.doc_id: r for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = L.op7_language_id(spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    out = [r.lang_pred == known[r.doc_id].lang for r in got if r.held_out]
    assert sum(out) / len(out) >= 0.97


def learn(spark):
    en, ru = "the weather of the whole country was fine and they thought that", "погода во всей стране была хорошая и они думали что"
    de = "das wetter im ganzen land war schön und sie dachten dass nichts"
    rows = [(i, t, x) for i in range(40) for t, x in ((en, "en"), (ru, "ru"), (de, "de"))]
    return L.train(spark.createDataFrame([*rows, (1, None, "en"), (2, "bonjour", None), (None, en, "en")], DOCS))


def test_spans_scripts_and_odd_texts(spark):
    model = learn(spark)
    assert model.languages == ["de", "en", "ru"]
    mixed = "the country was fine and they thought " + "das wetter im ganzen land war schön und sie dachten " + "погода в стране была хорошая"
    assert [x for x, _, _ in L.spans(mixed, model)] == ["en", "de", "ru"]
    assert [x for x, _, _ in L.spans("хорошая and погода they", model)] == ["ru", "en", "ru", "en"]
    rows = [(1, None, None), (2, "", "en"), (3, "12 ... 3", None), (4, "漢字 漢字", None), (5, "the fine weather", "ru"), (5, "the fine weather", "ru"), (6, "the weather was fine " * 50_000, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", score string")
    got = sorted(tuple(r) for r in L.predict(df, model).collect())
    assert [r[:2] for r in got] == [(1, "und"), (2, "und"), (3, "und"), (4, model.languages[model.commonest]), (5, "en"), (5, "en"), (6, "en")]
    assert [r[2] for r in got[:4]] == [0, 0, 0, 0] and got[4][2] == 1


def test_nothing_learnt_and_empty(spark):
    model = L.train(spark.createDataFrame([(1, "text", None)], DOCS))
    assert [tuple(r) for r in L.predict(spark.createDataFrame([(1, "text", "en")], DOCS), model).collect()] == [(1, "und", 0.0)]
    assert L.predict(spark.createDataFrame([], DOCS), learn(spark)).count() == 0


def test_runs_of_any_size_agree(spark, monkeypatch):
    model = learn(spark)
    texts = pa.array(["the fine land", None, "das wetter", "погода the"], pa.string())
    one = L.word_scores(texts, model)
    each = [L.word_scores(texts.slice(i, 1), model) for i in range(len(texts))]
    assert np.allclose(one[0], np.concatenate([x[0] for x in each]))


def invented(rng, letters):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(12)]


def test_300_languages_and_scripts(spark):
    """Languages of six scripts, many to a script, told apart by letters that a table of the commonest ones wouldn't hold."""
    rng = random.Random(7)
    scripts = ["abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x3B1, 0x3C9))), "".join(map(chr, range(0x5D0, 0x5EB))), "".join(map(chr, range(0x627, 0x63A))), "".join(map(chr, range(0x4E00, 0x5200)))]
    words = {f"l{k:03}": invented(rng, scripts[k % len(scripts)]) for k in range(300)}
    docs = [(i * 300 + k, " ".join(rng.choices(w, k=30)), lang) for i in range(4) for k, (lang, w) in enumerate(words.items())]
    model = L.train(spark.createDataFrame(docs, DOCS))
    assert len(model.languages) > 290
    got = {r.doc_id: r.lang_pred for r in L.predict(spark.createDataFrame(docs, DOCS), model).collect()}
    right = [got[i] == lang for i, _, lang in docs if lang in model.languages]
    assert sum(right) / len(right) > 0.98


def test_shares_below_a_millionth_and_rare_languages(spark):
    rows = spark.range(200_000).select("id", F.lit("x").alias("text"), F.when(F.col("id") < 50, "rare").otherwise("often").alias("lang"), F.col("id").alias("doc_id"))
    got = {r.lang: r.n for r in rows.filter(L._picked({"rare": 10.0, "often": 1e-4})).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert got["rare"] == 50 and 2 <= got["often"] <= 60
    few = L.train(spark.createDataFrame([*((i, "the fine weather of the land", "en") for i in range(400)), *((1000 + i, "das wetter im ganzen land", "de") for i in range(8))], DOCS), sample=40, least=20)
    assert few.languages == ["de", "en"]
    tiny = spark.range(1).select(F.lit(int(1e-12 * 2**64) - 2**63).alias("x")).first().x
    assert tiny > -(2**63)  # a share of a millionth of a millionth still picks hashes


def test_long_words_and_ties(spark):
    model = learn(spark)
    rows = [(1, "weather" * 3000, None), (2, "qqq", None), (3, "the weather " * 100_000 + "погода", None)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(spark.createDataFrame(rows, DOCS), model).collect()}
    assert got[1][0] == "en" and got[2] == ("de", 1.0) and got[3][0] == "en" and got[3][1] > 0.99
