import math
import random
import re
from collections import Counter

import pytest

from tallyloom.llm import quality_rules as Q


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            covered.update(range(i, i + 5))
    lines, dup, seen = text.split("\n"), 0, set()
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def measured(df):
    return {r.doc_id: (*(r[c] for c in Q.BASE), r.base_failed) for r in Q.statistics(df).collect()}


def test_statistics_of_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    assert measured(docs) == {r.doc_id: plain(r.text) for r in docs.collect()}


def test_statistics_of_odd_texts(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "a", "a b c d e a b c d e", "a " * 400, "x\n\nx\n x\nx", "é|<𝄞>", "a b c\u0085d", "a b c d e f " * 4 + "z"]
    texts += [" ".join(rng.choices("abc", k=rng.randrange(60))) for _ in range(80)] + [" ".join(f"w{i % 9000}" for i in range(30_000))]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, n_words int, w string")
    assert measured(df) == {i: plain(t) for i, t in enumerate(texts)}


LABELS = "doc_id bigint, quality int, toxic int"


def test_learns_planted_rule_and_order(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = rng.random() < 0.3
        words = [f"w{rng.randrange(5000)}" + ("***" if bad and rng.random() < 0.6 else "") for _ in range(rng.randrange(15, 60))]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), 0))
    labels += [(0, None, 0), (None, 0, 0), (99_999, 0, 0), (1, labels[1][1], 0)]
    stats = Q.statistics(spark.createDataFrame(rows, "doc_id bigint, text string")).cache()
    rules = Q.learn(stats, spark.createDataFrame(labels, LABELS))
    assert rules and all(1 <= len(r) <= Q.MAX_CONDITIONS for r in rules)
    kept = {r.doc_id: r.kept for r in Q.judge(stats, rules).collect()}
    right = [kept[i] == bool(q) for i, q, _ in labels[:600]]
    assert sum(right) / 600 > 0.97
    plan = Q.judge(stats, rules)._jdf.queryExecution().toString()
    assert "CASE WHEN" in plan and "Python" not in plan
    stats.unpersist()


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 0, 0)], [(1, None, 0)]])
def test_without_two_classes_the_list_is_empty(spark, labels):
    stats = Q.statistics(spark.createDataFrame([(1, "some words " * 3 + "and more of them here at last"), (2, "few")], "doc_id bigint, text string"))
    assert Q.learn(stats, spark.createDataFrame(labels, LABELS)) == []
    assert {r.doc_id: r.kept for r in Q.judge(stats, []).collect()} == {1: True, 2: False}


def test_first_rule_that_holds_decides(spark):
    rules = [(Q.Condition("n_words", True, 5), Q.Condition("dup_lines", False, 0)), (Q.Condition("n_words", True, 3),)]
    df = spark.createDataFrame([(6, 0), (6, 1), (4, 0), (3, 0)], "n_words bigint, dup_lines bigint")
    assert [r[0] for r in df.select(Q.verdict(rules)).collect()] == [1, 2, 2, None]
    assert str(rules[0][0]) == "n_words > 5"


def test_query_held_out_and_empty(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in Q.op2_quality_rules(spark, path).collect()}
    labels = spark.read.parquet(f"{path}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{path}/documents.parquet").count()
    good = [got[r.doc_id].kept or got[r.doc_id].base_failed for r in labels if r.quality == 1]
    bad = [not got[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) > 0.9
    assert Q.statistics(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def planted(spark, rng, bad_of, n=3000):
    """Statistics of invented documents; bad_of says from the features which are bad."""
    rows, labels = [], []
    for i in range(n):
        f = {x: rng.randrange(1000) for x in Q.FEATURES}
        rows.append((i, *f.values(), False))
        labels.append((i, int(not bad_of(f)), 0))
    stats = spark.createDataFrame(rows, "doc_id bigint, " + ", ".join(f"{x} bigint" for x in Q.FEATURES) + ", base_failed boolean")
    return stats, labels


def test_learns_two_planted_conjunctions(spark):
    def bad_of(f):
        return (f["symbols_per_10k_chars"] > 700 and f["letters_per_10k_chars"] <= 400) or (f["digits_per_10k_chars"] > 800 and f["distinct_words_per_10k"] <= 300)

    stats, labels = planted(spark, random.Random(8), bad_of)
    rules = Q.learn(stats, spark.createDataFrame(labels, LABELS))
    told = [{(c.feature, c.above) for c in r} for r in rules]
    assert {("symbols_per_10k_chars", True), ("letters_per_10k_chars", False)} in told and {("digits_per_10k_chars", True), ("distinct_words_per_10k", False)} in told
    for c in rules[0] + rules[1]:
        assert min(abs(c.bound - x) for x in (700, 400, 800, 300)) < 25
    kept = {r.doc_id: r.kept for r in Q.judge(stats, rules).collect()}
    assert sum(kept[i] == bool(q) for i, q, _ in labels) / len(labels) > 0.97


def test_best_first_threshold_against_all(spark):
    """The first condition grown has the highest gain of all that plain Python tries."""
    rng = random.Random(3)
    stats, labels = planted(spark, rng, lambda f: f["n_words"] <= 200 and rng.random() < 0.9, 600)
    rows = stats.join(spark.createDataFrame(labels, LABELS), "doc_id").select(*Q.FEATURES, (1 - Q.F.col("quality")).alias("bad"))
    steps = {f: list(range(0, 1000, 50)) for f in Q.FEATURES}
    got = Q._grow(rows, steps, Q.Settings(max_conditions=1))
    data = [r.asDict() for r in rows.collect()]
    bad, total = sum(r["bad"] for r in data), len(data)

    def gain(c):
        hit = [r["bad"] for r in data if (r[c.feature] > c.bound) == c.above]
        return sum(hit) * (math.log2(sum(hit) / len(hit)) - math.log2(bad / total)) if sum(hit) >= 5 else 0

    best = max(gain(Q.Condition(f, above, x)) for f in Q.FEATURES for x in steps[f] for above in (True, False))
    assert len(got) == 1 and abs(gain(got[0]) - best) < 1e-6


def test_pruning_takes_off_what_does_not_help(spark):
    rows = [(*[i % 100] * len(Q.FEATURES), int(i % 100 > 50), i % 3 > 0) for i in range(600)]
    df = spark.createDataFrame(rows, ", ".join(f"{x} bigint" for x in Q.FEATURES) + ", bad int, grow boolean")
    good, useless = Q.Condition("n_words", True, 50), Q.Condition("dup_lines", True, 10)
    assert Q._prune(df, (good, useless), Q.Settings()) == (good,)
    assert Q._prune(df, (Q.Condition("n_words", True, 20), good), Q.Settings()) == (Q.Condition("n_words", True, 20), good)
    assert Q._prune(df, (Q.Condition("n_words", True, 20),), Q.Settings()) == ()  # not precise enough
