"""Language identification of mixed texts: script ranges narrow the candidates of each word, then Viterbi labels spans.

A word is a run of letters. Its score for a language is the sum of log odds of its letter trigrams (with word ends)
against the likeliest language, learnt from labelled documents. Only languages that use the script of the word's first
letter are candidates for it. A path through the languages pays a penalty at each switch, so a foreign word or two stay
inside a span while a foreign passage becomes one of its own. A document's language is the one whose spans hold most
letters; the score is their share (0 to 1).

Training uses about SAMPLE labelled documents, and about LEAST of a language that has fewer than that in this share; they are picked by
a 64-bit hash, so the share may be as small as it likes, and every word of those counts. Trigrams of all letters of all scripts are hashed into a
table of SLOTS places a language, so the model's size doesn't grow with the corpus; at most SAMPLE + LEAST * languages documents are summed up
for the driver.

Null text, or text without a letter: ``und`` and score 0. Nothing learnt: ``und`` and 0 for all. A word in a script that
no learnt language uses leaves all candidates equal; a document of only such words gets the commonest training language
with score 0. Ties go to the language that comes first by name. A text is never cut; a very long one takes six bytes a word and
language. Repeated rows are judged alike, each for itself; columns of other names are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyloom.llm.common import checkpointed, lean, table, text_slices
from tallyloom.llm.wordhash import mix

SAMPLE, LEAST = 20_000, 500
#: Places of the table of trigrams: a power of two.
SLOTS = 1 << 18
SWITCH = 12.0
#: One trigram speaks against a language by no more than this, so that no single rare one decides a word.
MOST_ODDS = 8.0
#: What each language is taken to have seen of every trigram, and of how many.
PRIOR, PRIOR_GRAMS = 0.5, 4096
#: No word speaks against a candidate by more than this, and none of another script by less than twice that.
MOST_WORD = 1000.0
#: A language uses a script if at least this share of its training letters is in it.
SCRIPT_SHARE = 0.005
#: Words times languages that one Viterbi run takes at once, in whole documents; letters times languages that are looked up at once.
RUN_CELLS, LETTER_CELLS = 4_000_000, 8_000_000

# First code points of Unicode ranges and the script that starts there (Unicode's block list).
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0x20000, "han"), (0x32000, "other"),
]
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(n) for _, n in SCRIPTS], np.int8)


@dataclass
class Model:
    """odds[slot, l]: trigrams of that slot in language l; uses[s, l]: script s is used by l."""

    languages: list[str]
    odds: np.ndarray
    uses: np.ndarray
    commonest: int


NOTHING = Model([], np.zeros((SLOTS, 0), np.float32), np.zeros((len(_NAMES), 0), bool), 0)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def train(docs: DataFrame, sample: int = SAMPLE, least: int = LEAST) -> Model:
    """Learns from text and non-null lang of the documents that aren't held out: about sample of them, and about least of a language that would have fewer."""
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    total = sum(known.values())
    if not total:
        return NOTHING
    shares = {lang: max(sample / total, least / n) for lang, n in known.items()}
    picked = rows.filter(_picked(shares)) if min(shares.values()) < 1 else rows
    counts = checkpointed(picked.select("lang", "text").mapInArrow(lean(_count), "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))).toArrow()
    if not counts.num_rows:
        if picked is not rows:
            raise RuntimeError(f"no letter in the sample of {total} labelled documents")
        return NOTHING
    languages = sorted(set(counts.column("lang").to_pylist()))
    code = pc.index_in(counts.column("lang"), pa.array(languages, pa.string())).to_numpy()
    slot, n = counts.column("slot").to_numpy(), counts.column("n").to_numpy()
    seen, uses = np.zeros((SLOTS, len(languages)), np.float32), np.zeros((len(_NAMES), len(languages)))
    gram = slot >= 0
    seen[slot[gram], code[gram]] = n[gram]
    uses[-1 - slot[~gram], code[~gram]] = n[~gram]
    letters = uses.sum(axis=0)
    odds = np.log((seen + np.float32(PRIOR)) / (letters + PRIOR * PRIOR_GRAMS).astype(np.float32))
    odds = np.maximum(odds - odds.max(axis=1, keepdims=True), -MOST_ODDS)
    return Model(languages, odds, uses / np.maximum(letters, 1) >= SCRIPT_SHARE, int(np.argmax(letters)))


def _picked(shares: dict[str, float]) -> Column:
    """Rows whose 64-bit hash lies in the share of their language; null ids are told apart by their texts."""
    at = {lang: min(2**63 - 1, int(share * 2**64) - 2**63) for lang, share in shares.items()}
    bound = F.try_element_at(F.create_map(*(F.lit(x) for pair in at.items() for x in pair)), F.col("lang"))
    return F.xxhash64("doc_id", "text") <= bound


def slots_of(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The place in the table of the trigram of code points a, b, c (blank: no letter)."""
    key = (a.astype(np.uint64) << np.uint64(42)) | (b.astype(np.uint64) << np.uint64(21)) | c.astype(np.uint64)
    return (mix(key + np.uint64(1)) & np.uint64(SLOTS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams with a letter in the middle by language and slot, and as -1 - script the letters of each script, summed over a slice."""
    for batch in text_slices(batches, "text"):
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            text = pc.utf8_lower(batch.column("text").filter(pc.equal(langs, lang)))
            points = _points("\n".join(text.to_pylist()))
            letter = _is_letter()[points]
            points = np.where(letter, points, 32)
            middle = np.flatnonzero(letter)
            slots, n = np.unique(slots_of(points[middle - 1], points[middle], points[middle + 1]), return_counts=True)
            scripts, m = np.unique(scripts_of(points[middle]), return_counts=True)
            slots, n = np.concatenate((slots, -1 - scripts.astype(np.int64))), np.concatenate((n, m))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slots), pa.string()), pa.array(slots.astype(np.int32)), pa.array(n, pa.int64())], ["lang", "slot", "n"])


def _points(text: str) -> np.ndarray:
    """Code points, with a blank at either end."""
    return np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32)


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def scripts_of(points: np.ndarray) -> np.ndarray:
    return _SCRIPT[np.searchsorted(_STARTS, points, side="right") - 1]


def word_scores(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of all words by language, 0 for the likeliest; their letters; and the bounds of each text's words."""
    lower = pc.utf8_lower(texts.fill_null("")).to_pylist()
    points = _points("\n".join(lower))
    ends = np.cumsum([len(x) + 1 for x in lower], dtype=np.int64)
    letter = _is_letter()[points]
    edge = np.diff(letter.astype(np.int8))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    first = np.concatenate(([0], np.searchsorted(start, ends, side="right")))
    scores = np.zeros((len(start), len(model.languages)), np.float32)
    letters = end - start
    inner = np.flatnonzero(letter)
    plain = np.where(letter, points, 32)
    slots = slots_of(plain[inner - 1], plain[inner], plain[inner + 1])
    heads = np.concatenate(([0], np.cumsum(letters)))
    a = 0
    while a < len(start):  # a block of words at a time; a longer word stands alone
        b = max(a + 1, int(np.searchsorted(heads, heads[a] + LETTER_CELLS // max(1, len(model.languages)), side="right")) - 1)
        scores[a:b] = np.add.reduceat(model.odds[slots[heads[a] : heads[b]]], heads[a:b] - heads[a], axis=0)
        a = b
    allowed = model.uses[scripts_of(points[start])]
    none = ~allowed.any(axis=1)
    scores[~allowed] = -np.inf
    scores = np.maximum(scores - scores.max(axis=1, initial=-np.inf, keepdims=True), -MOST_WORD) if len(start) else scores
    scores[~allowed] = -2 * MOST_WORD
    scores[none] = 0
    return scores, np.where(none, 0, letters), first


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word on the best path of its text. All texts go forward together, a word at a time."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, reach = first[:-1][order], counts[order]
    best = np.zeros((len(order), scores.shape[1]), np.float32)
    back = np.zeros(scores.shape, np.int16)
    longest = int(reach[0]) if len(reach) else 0
    active = np.searchsorted(-reach, -np.arange(longest), side="left")
    own = np.arange(scores.shape[1], dtype=np.int16)
    for t, n in enumerate(active.tolist()):
        at, now = begin[:n] + t, best[:n]
        top = now.argmax(axis=1)
        now = now - now[np.arange(n), top][:, None]  # the best path so far counts 0, so that long texts lose no digits
        stay = now >= -switch
        back[at] = np.where(stay, own, top[:, None])
        best[:n] = np.where(stay, now, -switch) + scores[at]
    path = np.zeros(len(scores), np.int16)
    state = best.argmax(axis=1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        n = int(active[t])
        at = begin[:n] + t
        path[at] = state[:n]
        state[:n] = back[at, state[:n]]
    return path


def spans(text: str, model: Model) -> list[tuple[str, int, int]]:
    """The spans of one text: language, first word and the word after the last."""
    scores, _, first = word_scores(pa.array([text], pa.string()), model)
    path = viterbi(scores, first)
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    return [(model.languages[path[a]], a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of each row of docs (doc_id, text)."""
    return annotate(docs.select("doc_id", F.col("text").cast("string").alias("text")), model).select("doc_id", "lang_pred", F.col("lang_score").alias("score"))


def annotate(docs: DataFrame, model: Model) -> DataFrame:
    """docs, which has a string column text, with lang_pred and lang_score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, waiting, n = shared.value, [], 0
        for batch in text_slices(batches, "text"):
            if not m.languages:
                yield _answer([batch], np.full(batch.num_rows, -1), np.zeros(batch.num_rows), m)
                continue
            waiting.append((batch, *word_scores(batch.column("text"), m)))
            n += len(waiting[-1][1])
            if n * len(m.languages) >= RUN_CELLS:
                yield _decide(waiting, m)
                waiting, n = [], 0
        if waiting:
            yield _decide(waiting, m)

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])
    return docs.mapInArrow(lean(run), schema)


def _decide(waiting: list[tuple], m: Model) -> pa.RecordBatch:
    batches, scores, letters, firsts = zip(*waiting, strict=True)
    shift = np.cumsum([0, *map(len, scores)])
    first = np.concatenate([[0], *(f[1:] + s for f, s in zip(firsts, shift, strict=False))])
    scores, letters = np.concatenate(scores), np.concatenate(letters)
    path = viterbi(scores, first)
    count = np.diff(first)
    text, n = np.repeat(np.arange(len(count)), count), len(m.languages)
    held = np.bincount(text * n + path.astype(np.int64), weights=letters, minlength=len(count) * n).reshape(-1, n)
    total = held.sum(axis=1)
    pick = np.where(total > 0, held.argmax(axis=1), m.commonest)
    share = held.max(axis=1, initial=0) / np.maximum(total, 1)
    return _answer(batches, np.where(count > 0, pick, -1), np.where(count > 0, share, 0.0), m)


def _answer(batches: list[pa.RecordBatch], pick: np.ndarray, score: np.ndarray, m: Model) -> pa.RecordBatch:
    names = pa.array([*m.languages, "und"], pa.string()).take(pa.array(np.where(pick < 0, len(m.languages), pick)))
    columns = [pa.concat_arrays([b.column(i) for b in batches]) for i in range(batches[0].num_columns)]
    return pa.RecordBatch.from_arrays([*columns, names, pa.array(score, pa.float64())], [*batches[0].schema.names, "lang_pred", "lang_score"])


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
