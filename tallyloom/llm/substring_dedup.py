"""Substring deduplication by relative Lempel-Ziv parsing against content-addressed reference blocks.

The corpus itself is the reference, cut into blocks by content: in every window of SPAN consecutive words the smallest hash of its runs of GRAM words is the
window's anchor, the same wherever the window stands, and a block holds all stretches of the corpus whose windows have one anchor. A copy of SPAN words or more
shares its windows' anchors with its source, so a document has to be parsed only against the blocks of its own anchors; no other block can give a factor of SPAN words.

Anchors are gathered by hash first; those that stand at one place of one text only have nothing to be parsed against and go no further. Then the stretches of each
block come together, are indexed (Block: their suffixes in sorted order, so that the longest match of any place is with a neighbour), and each is factored greedily: at the
first word where a match of SPAN words begins, the longest factor is taken; the windows that lie across the factor's end are checked in the index too, and the first of them that
is repeated begins the next factor. So every repeated window lies in a factor, and every window of a factor is repeated. A document's factors are put together from
its blocks: one that goes on with the same source in the next block becomes one factor. The words that go are those that factors cover.

Places of a block are never paired: an index entry is compared with its two neighbours. A block with more than HOT stretches would weigh on one task. It is split by
window: an entry is then a window's number of places and its first place, counted with partial sums, and its factors are of one window each before they are put together. Documents with equal texts are one
factor each; one of them stands for all in the blocks. Null, empty and short texts have no window and stay whole. Rows that agree in doc_id
and text are two documents with equal texts. Of equally long matches the source is the neighbour with the smaller doc_id, text hash and place. A text is looked at as a whole, however long it is. Other columns
are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import meet, table, text_slices, written
from tallyloom.llm.wordhash import find_words, grams

SPAN, GRAM = 35, 8
HOT = 500
_MOST = np.uint64(2**64 - 1)
PIECE = "did bigint, th bigint, start int, n int, source bigint, source_start int"
FACTORS = "array<struct<start: int, n: int, source: bigint, source_start: int>>"


def _sliding(x: np.ndarray, n: int, of) -> np.ndarray:
    """of (np.minimum or np.maximum) over each n consecutive values."""
    size, out = 1, x
    while size * 2 <= n:
        out = of(out[:-size], out[size:]) if len(out) > size else out[:0]
        size *= 2
    return of(out[: len(out) - (n - size)], out[n - size :]) if len(out) > n - size else out[:0]


class Parsed:
    """The words of some texts, the hashes of their runs, and the windows with their anchors."""

    def __init__(self, texts: pa.Array, span: int, gram: int):
        self.words = words = find_words(texts)
        total = len(words.hash)
        self.runs = np.full(total, _MOST)
        hashes, begin = grams(words.hash, words.first, gram)
        self.runs[begin] = hashes
        self.window, self.begin = grams(words.hash, words.first, span, seed=7)
        self.wide = span - gram + 1
        least = _sliding(self.runs, self.wide, np.minimum)
        self.least = least[self.begin] if len(self.begin) else np.zeros(0, np.uint64)

    def anchors(self) -> np.ndarray:
        """Places of words that some window selects: its smallest run, all of them on ties."""
        chosen = np.zeros(len(self.runs) + 2 * self.wide, np.uint64)
        chosen[self.begin + self.wide - 1] = self.least
        most = _sliding(chosen, self.wide, np.maximum)[: len(self.runs)]
        return np.flatnonzero((most == self.runs) & (self.runs != _MOST))

    def windows_of(self, flagged: np.ndarray) -> np.ndarray:
        """The windows (indices into begin) whose anchor is among the flagged words."""
        only = np.full(len(self.runs), _MOST)
        only[flagged] = self.runs[flagged]
        least = _sliding(only, self.wide, np.minimum)
        return np.flatnonzero(least[self.begin] == self.least) if len(self.begin) else np.zeros(0, np.int64)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the row that each is in; null lists are empty."""
    bounds = np.asarray(lists.offsets)
    return np.asarray(lists.values)[bounds[0] : bounds[-1]], np.repeat(np.arange(len(lists)), np.diff(bounds))


def _anchorer(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            p = Parsed(batch.column("text"), span, gram)
            at = p.anchors()
            row = np.searchsorted(p.words.first, at, side="right") - 1
            place = at - p.words.first[row]
            rows = pa.array(row)
            order = np.lexsort((p.runs[at], row))
            same = (np.diff(row[order]) == 0) & (np.diff(p.runs[at][order]) == 0)
            twice = np.zeros(len(at), bool)
            twice[order[1:][same]] = True
            yield pa.RecordBatch.from_arrays([pa.array(p.runs[at].view(np.int64)), batch.column("did").take(rows), batch.column("th").take(rows), pa.array(place.astype(np.int32)), pa.array(twice)], ["anchor", "did", "th", "place", "twice"])

    return run


def _windows(batch: pa.RecordBatch, span: int, gram: int, hot: bool) -> tuple[Parsed, np.ndarray, np.ndarray]:
    """The words of the texts, the windows whose anchor is among the places of that kind, and the row of each."""
    p = Parsed(batch.column("text"), span, gram)
    lists = batch.column("places")
    bounds, values = np.asarray(lists.offsets), lists.values
    row = np.repeat(np.arange(len(lists)), np.diff(bounds))
    values = values.slice(bounds[0], bounds[-1] - bounds[0])
    mine = np.asarray(values.field("hot").to_numpy(zero_copy_only=False)) == hot
    found = p.windows_of((p.words.first[row] + np.asarray(values.field("place")))[mine])
    return p, found, np.searchsorted(p.words.first, p.begin[found], side="right") - 1


def _window_runs(span: int, gram: int):
    """Windows that follow each other and have one anchor, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            p, found, row = _windows(batch, span, gram, False)
            begin, least = p.begin[found], p.least[found]
            new = np.ones(len(found), bool)
            new[1:] = (np.diff(begin) != 1) | (row[1:] != row[:-1]) | (least[1:] != least[:-1])
            head = np.flatnonzero(new)
            lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(found)).astype(np.int32)), pa.array(p.window[found].view(np.int64)))
            rows = pa.array(row[head])
            start = (begin[head] - p.words.first[row[head]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(least[head].view(np.int64)), batch.column("did").take(rows), batch.column("th").take(rows), pa.array(start), lists], ["anchor", "did", "th", "start", "windows"])

    return run


def _single_windows(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            p, found, row = _windows(batch, span, gram, True)
            rows = pa.array(row)
            start = (p.begin[found] - p.words.first[row]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.window[found].view(np.int64)), pa.array(p.least[found].view(np.int64)), batch.column("did").take(rows), batch.column("th").take(rows), pa.array(start)], ["window", "anchor", "did", "th", "start"]
            )

    return run


class Block:
    """An index of stretches of windows: of all suffixes of all stretches, the sorted order.

    values are the windows' hashes, bounds those of the stretches, and kinds numbers of the stretches whose windows may be equal. It holds, for each place, the
    longest match with any other place: long (windows) and source (a place). Stretches come in the order in which sources are preferred.
    """

    def __init__(self, values: np.ndarray, bounds: np.ndarray, kinds: np.ndarray):
        size = np.diff(bounds)
        self.row = row = np.repeat(np.arange(len(size)), size)
        self.left = left = bounds[1:][row] - np.arange(len(row))  # windows from here to the end of the stretch
        ranks = [_ranked(kinds[row], values)]
        step = 1
        while step < int(size.max(initial=0)):
            ahead = np.full(len(row), -1, np.int64)
            far = np.flatnonzero(left > step)
            ahead[far] = ranks[-1][far + step]
            ranks.append(_ranked(ranks[-1], ahead))
            step *= 2
        order = np.argsort(ranks[-1], kind="stable")
        a, b = order[:-1], order[1:]
        common = self._common(ranks, a, b)
        before, after = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        before[b], after[a] = common, common
        previous, following = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        previous[b], following[a] = a, b
        self.long = np.maximum(before, after)
        first = (before > after) | ((before == after) & (previous < following))
        self.source = np.where(first, previous, following)

    def _common(self, ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many windows agree from the places a and b on."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        room = np.minimum(self.left[a], self.left[b])
        for k in range(len(ranks) - 1, -1, -1):
            step = 1 << k
            on = np.flatnonzero(room - out >= step)
            on = on[ranks[k][a[on]] == ranks[k][b[on]]]
            out[on] += step
            on = on[out[on] < room[on]]  # others are at the end of a stretch
            a[on], b[on] = a[on] + step, b[on] + step
        return out

    def factors(self) -> tuple[np.ndarray, np.ndarray]:
        """The places and lengths (windows) of the factors of all stretches: greedily the longest, the next one from the first repeated window after it."""
        total = len(self.row)
        places = np.arange(total)
        hit = np.minimum.accumulate(np.where(self.long > 0, places, total)[::-1])[::-1]  # the first repeated window from each place on
        end = places + self.left
        now = np.flatnonzero(np.diff(self.row, prepend=-1))
        found: list[np.ndarray] = []
        while len(now):
            stop, now = end[now], hit[now]
            now = now[now < stop]
            found.append(now)
            ahead = now + self.long[now]
            now = ahead[ahead < end[now]]
        at = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return at, self.long[at]


def _ranked(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Numbers in the order of (major, minor), equal for equal pairs."""
    order = np.lexsort((minor, major))
    new = np.ones(len(order), bool)
    new[1:] = (major[order[1:]] != major[order[:-1]]) | (minor[order[1:]] != minor[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (stretches) come sorted by anchor, did, th, start. The factors of each, parsed against the block of its anchor; a block's rows are looked at together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = np.asarray(batch.column("anchor"))
        cut = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if anchor[0] != anchor[-1] else 0
        if cut:
            yield from _block_factors([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[-1].column("anchor")[0].as_py() != anchor[0]:
            yield from _block_factors(held)
            held = [batch]
        else:
            held.append(batch)
    yield from _block_factors(held)


def _block_factors(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not batches:
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    one = lambda c: rows.column(c).combine_chunks() if rows.column(c).num_chunks != 1 else rows.column(c).chunk(0)
    lists = one("windows")
    bounds = np.asarray(lists.offsets).astype(np.int64)
    values = np.asarray(lists.values)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    anchor, did, start = (np.asarray(one(c)) for c in ("anchor", "did", "start"))
    block = Block(values, bounds, anchor)
    at, n = block.factors()
    if not len(at):
        return
    place = start[block.row] + np.arange(len(block.row)) - bounds[block.row]
    source, take = block.source[at], pa.array(block.row[at])
    yield pa.RecordBatch.from_arrays(
        [one("did").take(take), one("th").take(take), pa.array(place[at].astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(did[block.row[source]]), pa.array(place[source].astype(np.int32))],
        ["did", "th", "start", "n", "source", "source_start"],
    )


def _factors(starts: np.ndarray, n: np.ndarray, source: np.ndarray, source_start: np.ndarray, span: int) -> list[dict]:
    """A document's factors (words), from those of its blocks (windows) in order: one that goes on in the next block with the same source is one."""
    out: list[dict] = []
    end = 0
    for a, k, doc, at in zip(starts.tolist(), n.tolist(), source.tolist(), source_start.tolist(), strict=True):
        last = out[-1] if out else None
        if last and a == end and doc == last["source"] and at - last["source_start"] == a - last["start"]:
            last["n"] += k
        else:
            out.append({"start": a, "n": k + span - 1, "source": doc, "source_start": at})
        end = a + k
    return out


def _cutter(span: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            words = find_words(batch.column("text"))
            count = words.counts
            texts = words.bytes.tobytes()
            repeated, own = batch.column("copies").to_pylist(), batch.column("did").to_pylist()
            lists = batch.column("hits")
            bounds, found = np.asarray(lists.offsets), lists.values
            hits = [np.asarray(found.field(x)) for x in ("start", "n", "source", "source_start")]
            out = {"n_removed": [], "kept": [], "factors": []}
            for i in range(batch.num_rows):
                factors: list[dict] = []
                if repeated[i] is not None and repeated[i]["n"] > 1 and count[i] >= span:
                    other = repeated[i]["first"] if repeated[i]["first"] != own[i] else repeated[i]["last"]
                    factors = [{"start": 0, "n": int(count[i]), "source": other, "source_start": 0}]
                elif bounds[i + 1] > bounds[i]:
                    order = np.argsort(hits[0][bounds[i] : bounds[i + 1]])
                    factors = _factors(*(x[bounds[i] : bounds[i + 1]][order] for x in hits), span)
                gone = np.zeros(count[i] + 1, np.int32)
                for f in factors:
                    gone[f["start"]] += 1
                    gone[f["start"] + f["n"]] -= 1
                stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0) + words.first[i]
                kept = b" ".join([texts[a:b] for a, b in zip(words.start[stay].tolist(), words.end[stay].tolist(), strict=True)])
                out["n_removed"].append(int(count[i]) - len(stay))
                out["kept"].append(kept.decode() if with_text else hashlib.sha256(kept).hexdigest())
                out["factors"].append(factors)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count.astype(np.int64)), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.string()), pa.array(out["factors"], kind)],
                ["doc_id", "n_words", "n_removed", "kept_text" if with_text else "kept_sha256", "factors"],
            )

    return run


def without_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and factors of each row of docs (doc_id, text).

    Every word goes that is covered by a window of span words whose words also stand, in order, anywhere else. Words that stay are joined by a
    blank. with_text=False gives kept_sha256 in place of kept_text. A factor is start and n (words), and another place where its words stand: source (a doc_id; the smallest bigint
    for none) and source_start.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id"), text.alias("text"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("did"), F.xxhash64(text).alias("th"))
    keys = ["did", "th"]
    anchors = written(rows.mapInArrow(_anchorer(span, gram), "anchor bigint, did bigint, th bigint, place int, twice boolean"), "anchors")
    # equal texts don't make an anchor shared: they are told by their hash below
    gathered = anchors.groupBy("anchor").agg(F.min("th").alias("_low"), F.max("th").alias("_high"), F.max("twice").alias("_twice"), F.count("*").alias("n"))
    shared = written(gathered.filter("_low <> _high OR _twice").select("anchor", "n", (F.col("n") > HOT).alias("hot")), "shared")
    flagged = meet(anchors.select("anchor", *keys, "place"), shared, ["anchor"]).groupBy(*keys).agg(F.collect_list(F.struct("place", "hot")).alias("places"), F.max("hot").alias("any_hot"), F.min("hot").alias("all_hot"))

    full, chars = rows.filter("text IS NOT NULL"), F.length("text").alias("chars")
    same = written(full.groupBy("th", chars).agg(F.count("*").alias("n"), F.min("did").alias("first"), F.max("did").alias("last")).filter("n > 1").withColumn("copies", F.struct("n", "first", "last")).select("th", "chars", "n", "copies"), "same")
    copies = written(meet(full.select(*keys, chars).distinct(), same, ["th", "chars"]).select(*keys, "copies"), "copies")
    first_only = written(flagged.join(copies, keys, "left").filter(F.col("copies").isNull() | (F.col("copies.first") == F.col("did"))).select(*keys, "places", "any_hot", "all_hot"), "places")  # two kinds of windows are made of it

    dealt = rows.select("doc_id", "text", *keys).repartition(*keys)
    looked = dealt.join(first_only, keys)  # repeated rows double their windows, which are repeated anyway
    stretches = looked.filter("NOT all_hot").select(*keys, "text", "places").mapInArrow(_window_runs(span, gram), "anchor bigint, did bigint, th bigint, start int, windows array<bigint>")
    pieces = stretches.repartition("anchor").sortWithinPartitions("anchor", *keys, "start").mapInArrow(_parsed, PIECE)
    singles = looked.filter("any_hot").select(*keys, "text", "places").mapInArrow(_single_windows(span, gram), "window bigint, anchor bigint, did bigint, th bigint, start int")
    often = singles.groupBy("window", "anchor").agg(F.count("*").alias("n"), F.min(F.struct("did", "start")).alias("low"), F.max(F.struct("did", "start")).alias("high")).filter("n > 1")
    first = F.when(F.struct("did", "start") == F.col("low"), F.col("high")).otherwise(F.col("low"))
    hot_pieces = meet(singles, written(often, "often"), ["window", "anchor"]).withColumn("from", first).select(*keys, "start", F.lit(1).alias("n"), F.col("from.did").alias("source"), F.col("from.start").alias("source_start"))
    hits = pieces.unionByName(hot_pieces).groupBy(*keys).agg(F.collect_list(F.struct("start", "n", "source", "source_start")).alias("hits"))
    placed = dealt.join(hits, keys, "left").join(copies, keys, "left").select("doc_id", "text", "did", "hits", "copies")
    kept = "kept_text" if with_text else "kept_sha256"
    return placed.mapInArrow(_cutter(span, with_text), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_removed bigint, {kept} string, factors {FACTORS}")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP9_SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM split
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS said FROM starts
), often AS (
  SELECT said FROM windows GROUP BY said HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + d AS k FROM windows JOIN often USING (said), (SELECT unnest(range(35)) AS d) AS steps
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM split
), kept AS (
  SELECT a.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY a.k) AS said FROM words a ANTI JOIN gone g ON a.doc_id = g.doc_id AND a.k = g.k GROUP BY a.doc_id
)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""
