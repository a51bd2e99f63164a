"""Quality rules: a decision list learnt by sequential covering, as ordered conditional expressions over text statistics.

Everything runs in DataFrame expressions; the driver sees only counts by feature and bin. Each rule is a conjunction of thresholds. It is grown
on two thirds of the labelled documents (by a hash of doc_id) by adding the threshold with the highest gain in information,
then pruned on the other third by taking off last conditions while (bad - good) / (bad + good) does not fall. A rule whose precision on
either part is under what is asked ends the search; otherwise the documents that it covers go and the next rule is grown. Thresholds
are the bounds of equal shares of the labelled documents, by feature. Settings holds what the learner can be told.

A null or empty text has no words and zero counts, and fails the base rules. Without labels, or with one class only, the list is
empty and the base rules decide. Labels of unknown documents and null labels count for nothing; of repeated labels of a document
the smallest counts. Of equally good thresholds the first by feature and bound is taken. Repeated rows are judged each for itself, a text of any length as a whole;
columns of other names are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import WHITE, checkpointed, let, table, words_of

SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What thresholds stand on: whole numbers, so that rules read plainly; shares are in 10,000.
FEATURES = ["n_words", "chars_per_1000_words", "symbols_per_10k_chars", "dup_lines", "dup_lines_per_10k", "repeat_words_per_10k", "same_next_per_10k", "distinct_words_per_10k", "letters_per_10k_chars", "digits_per_10k_chars"]
MAX_CONDITIONS = 3


@dataclass(frozen=True)
class Settings:
    """bins: equal shares whose bounds are tried as thresholds; max_rules and max_conditions: the size of the list and of a rule; precision: the least share of
    bad documents among those that a rule covers; least_cover: the least number of bad documents that a condition has to cover while a rule is grown.
    """

    bins: int = 64
    max_rules: int = 8
    max_conditions: int = MAX_CONDITIONS
    precision: float = 0.9
    least_cover: int = 5


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: int

    def column(self) -> Column:
        return F.col(self.feature) > self.bound if self.above else F.col(self.feature) <= self.bound

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule))


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1, as an ordered conditional expression; null if none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(holds(rule), i) if out is None else out.when(holds(rule), i)
    return F.lit(None).cast("int") if out is None else out


def _repeated(words: Column) -> Column:
    """Words in 5-word windows that occur twice or more in the text."""
    n = F.size(words)

    def counted(hashes):
        at = lambda i, k: F.get(hashes, i + k)
        return F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2), at(i, 3), at(i, 4)))

    def spread(grams):
        """Only for texts with a repeated window: windows sorted by hash, those with an equal neighbour, then their places in order."""
        order = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def marked(rows):
            same = lambda x, k: F.coalesce(F.get(rows, k)["g"] == x["g"], F.lit(False))
            twice = F.filter(rows, lambda x, k: same(x, k + 1) | ((k > 0) & same(x, F.greatest(k - 1, F.lit(0)))))
            places = F.sort_array(F.transform(twice, lambda x: x["i"]))
            none = F.struct(F.lit(0).alias("total"), F.lit(-5).alias("last"))
            return F.aggregate(places, none, lambda s, i: F.struct((s["total"] + F.least(i - s["last"], F.lit(5))).alias("total"), i.alias("last")), lambda s: s["total"])

        return let(order, marked)

    def total(grams):
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(spread(grams))

    return F.when(n >= 6, let(let(F.transform(words, lambda w: F.xxhash64(w)), counted), total)).otherwise(0)


def _same_next(words: Column) -> Column:
    return F.size(F.filter(words, lambda w, i: (i > 0) & (F.get(words, F.greatest(i - 1, F.lit(0))) == w)))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics and the features of each row of docs (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = lambda x, drop: F.length(F.translate(x, drop, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    by_words = let(words_of(text), lambda w: F.struct(F.size(w).alias("n_words"), _repeated(w).alias("n_repeat_words"), _same_next(w).alias("n_same_next"), F.size(F.array_distinct(w)).alias("n_distinct")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    counted = docs.select(
        "doc_id", by_words.alias("w"), by_lines.alias("x"), bare(text, WHITE).alias("word_chars"), (F.length(text) - bare(text, SYMBOLS)).alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^\p{L}]+", "")).alias("n_letters"), (F.length(text) - bare(text, "0123456789")).alias("n_digits"),
    )
    numbers = ["w.n_words", "word_chars", "n_symbols", "x.n_dup_lines", "w.n_repeat_words", "w.n_same_next", "w.n_distinct", "x.n_lines", "n_letters", "n_digits"]
    base = counted.select("doc_id", *(F.col(c).cast("bigint").alias(c.split(".")[-1]) for c in numbers))
    share = lambda c, of, scale=10_000: F.floor(scale * F.col(c) / F.greatest(F.col(of), F.lit(1)))
    return base.withColumns({
        "chars_per_1000_words": share("word_chars", "n_words", 1000), "symbols_per_10k_chars": share("n_symbols", "word_chars"), "dup_lines": F.col("n_dup_lines"), "dup_lines_per_10k": share("n_dup_lines", "n_lines"),
        "repeat_words_per_10k": share("n_repeat_words", "n_words"), "same_next_per_10k": share("n_same_next", "n_words"), "distinct_words_per_10k": share("n_distinct", "n_words"),
        "letters_per_10k_chars": share("n_letters", "word_chars"), "digits_per_10k_chars": share("n_digits", "word_chars"),
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    })


def learn(stats: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[Rule]:
    """The decision list for documents that pass the base rules; labels has doc_id and quality (0 is bad)."""
    told = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.min("quality").alias("_quality"))
    joined = stats.filter("NOT base_failed").join(told, stats["doc_id"].cast("bigint") == told["_id"])
    rows = checkpointed(joined.select(*FEATURES, (F.col("_quality") == 0).cast("int").alias("bad"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("grow")))
    bounds = rows.agg(*(F.percentile_approx(f, [i / settings.bins for i in range(settings.bins)], 10_000).alias(f) for f in FEATURES)).first()
    steps = {f: sorted(set(bounds[f] or [])) for f in FEATURES}
    rules: list[Rule] = []
    left = rows
    while len(rules) < settings.max_rules:
        rule = _prune(left, _grow(left.filter("grow"), steps, settings), settings)
        if not rule:
            break
        rules.append(rule)
        left = left.filter(~holds(rule))
    return rules


def _totals(rows: DataFrame) -> tuple[int, int]:
    r = rows.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.count("*")).first()
    return r[0], r[1] - r[0]


def _grow(rows: DataFrame, steps: dict[str, list[int]], settings: Settings) -> Rule:
    rule: Rule = ()
    bad, good = _totals(rows)
    while bad and good and len(rule) < settings.max_conditions:
        best = None
        for condition, p, n in _candidates(rows, steps, bad, good):
            if p >= settings.least_cover:
                gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, condition, p, n)
        if best is None or best[0] <= 1e-9:
            break
        _, condition, bad, good = best
        rule = (*rule, condition)
        rows = rows.filter(condition.column())
    return rule


def _candidates(rows: DataFrame, steps: dict[str, list[int]], bad: int, good: int) -> list[tuple[Condition, int, int]]:
    """All conditions with the bad and good rows that they cover, from one count by feature and bin."""
    bin_of = lambda f: F.size(F.filter(F.array(*map(F.lit, steps[f])), lambda b: F.col(f) > b))
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), bin_of(f).alias("b")) for f in FEATURES if steps[f]))).alias("x")
    counts = {(r.f, r.b): (r.bad, r.n - r.bad) for r in rows.select("bad", each).groupBy("x.f", "x.b").agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect()}
    out = []
    for f in FEATURES:
        low_bad = low_good = 0
        for i, bound in enumerate(steps[f]):
            p, n = counts.get((f, i), (0, 0))
            low_bad, low_good = low_bad + p, low_good + n
            out.append((Condition(f, False, int(bound)), low_bad, low_good))
            out.append((Condition(f, True, int(bound)), bad - low_bad, good - low_good))
    return out


def _prune(rows: DataFrame, rule: Rule, settings: Settings) -> Rule:
    """The best beginning of the rule on the pruning rows, or nothing if it isn't precise enough."""
    if not rule:
        return ()
    cuts = [rule[:i] for i in range(1, len(rule) + 1)]
    sums = [F.coalesce(F.sum(F.when(holds(c) & (F.col("grow") == g), x)), F.lit(0)) for c in cuts for g in (False, True) for x in (F.col("bad"), F.lit(1))]
    got = rows.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first()
    seen = [(c, *got[4 * i : 4 * i + 4]) for i, c in enumerate(cuts)]
    worth = lambda x: (2 * x[1] - x[2]) / x[2] if x[2] else -1.0
    best = max(seen, key=worth)  # of equals the shortest
    cut, bad, n, grown_bad, grown = best
    precise = n > 0 and bad >= settings.precision * n and grown_bad >= settings.precision * grown
    return cut if precise else ()


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """stats with rule (the number of the rule that rejects a document) and kept."""
    return stats.withColumn("rule", F.when(~F.col("base_failed"), verdict(rules))).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = checkpointed(statistics(table(spark, sf_dir, "documents")))
    judged = judge(stats, learn(stats, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *BASE, "base_failed", "kept", "rule")
