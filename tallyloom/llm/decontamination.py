"""Benchmark decontamination with spaced seeds.

Words are lower-cased (A-Z) and lose ASCII punctuation; a word without letters or digits is none. Each mask ignores some
token positions, so a seed hash stays equal when words there are replaced. Seeds of the benchmark items are looked up for
every position of every text; each hit gives an alignment of text and item, and around it the words are compared: the
alignment counts if some window of min(WINDOW, words of the item) words has at least SHARE equal words in place. The masks
find every such window with up to four replaced words of 20, or three of 15; for the choices of replaced words that they miss in items of
5, 6, 7, 10, 11 and 12 words, there are masks as long as the item (tests try all placements, for every length).

Items are taken in blocks of at most BLOCK_WORDS words, and each block is read against all texts, so what an executor holds
is bounded whatever the size of the benchmark; nothing is shuffled, but each further block is one more pass over the texts. Items with fewer than LEAST_WORDS words say too little and are
not searched. A text shorter than the window (min(WINDOW, words of the item)) holds none and matches nothing, also if it is an excerpt of the item. Null or empty texts match nothing.
Rows with the same doc_id or item_id are judged each for itself and give one result row a pair, the best.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import lean, table, text_slices, words_of, written
from tallyloom.llm.wordhash import Words, find_words, mix

MASKS = ("111101", "110111")
WINDOW, SHARE, LEAST_WORDS = 20, 0.8, 5
BLOCK_WORDS = 1_000_000
#: Alignments' words compared at once.
CELLS = 1 << 21
_FILTER_BITS = 22
_MUL = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Block:
    """Items of one block: their ids, word hashes, and the sorted seeds with the places they come from."""

    ids: pa.Array
    hashes: np.ndarray
    first: np.ndarray
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    masks: tuple[str, ...]
    present: np.ndarray


def seeds_of(hashes: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """A seed for each position where the mask fits, whatever text it is in."""
    total = max(0, len(hashes) - len(mask) + 1)
    acc = np.full(total, salt, np.uint64)
    with np.errstate(over="ignore"):
        for i, c in enumerate(mask):
            if c == "1":
                acc = acc * _MUL + hashes[i : i + total]
    return mix(acc)


def _inside(first: np.ndarray, span: int, total: int) -> np.ndarray:
    """The positions at which span words stay in one text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.flatnonzero(text[:total] == text[span - 1 :]) if total else np.zeros(0, np.int64)


@functools.cache
def whole_masks(n: int) -> tuple[str, ...]:
    """Masks for items of n words, each as long as the item: one for each choice of tolerated words that MASKS don't find."""
    bad = itertools.combinations(range(n), n - math.ceil(SHARE * n - 1e-9))
    missed = [b for b in bad if not any(all(p + i not in b for i, c in enumerate(m) if c == "1") for m in MASKS for p in range(n - len(m) + 1))]
    return tuple("".join("0" if i in b else "1" for i in range(n)) for b in missed)


def make_block(ids: pa.Array, texts: pa.Array) -> Block:
    words = find_words(texts, lower=True, bare=True)
    count = words.counts
    short = sorted({int(n) for n in count if LEAST_WORDS <= n < WINDOW})
    masks = (*MASKS, *(m for n in short for m in whole_masks(n)))
    seeds, items, places = [], [], []
    owner = words.text
    for k, mask in enumerate(masks):
        found = seeds_of(words.hash, mask, k + 1)
        at = _inside(words.first, len(mask), len(found))
        at = at[(count[owner[at]] >= LEAST_WORDS) & ((count[owner[at]] == len(mask)) | (k < len(MASKS)))]
        seeds.append(found[at])
        items.append(owner[at])
        places.append(at - words.first[owner[at]])
    seeds, items, places = np.concatenate(seeds), np.concatenate(items), np.concatenate(places)
    order = np.argsort(seeds, kind="stable")
    present = np.zeros(1 << _FILTER_BITS, bool)
    present[seeds & np.uint64((1 << _FILTER_BITS) - 1)] = True
    return Block(ids, words.hash, words.first, seeds[order], items[order], places[order], masks, present)


def blocks_of(items: DataFrame) -> Iterator[Block]:
    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.size(words_of(F.col("text"))))).first()[0] or 0
    n = -(-int(total) // BLOCK_WORDS)
    for k in range(n):
        got = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toArrow()
        if got.num_rows:
            yield make_block(got.column("item_id").combine_chunks(), got.column("text").combine_chunks().cast(pa.large_string()))


def overlaps(words: Words, block: Block) -> tuple[np.ndarray, ...]:
    """text, item, equal words, window, first word in the text and in the item, of the best alignment of each pair."""
    pairs = []
    low = np.uint64((1 << _FILTER_BITS) - 1)
    for k, mask in enumerate(block.masks):
        seeds = seeds_of(words.hash, mask, k + 1)
        at = np.flatnonzero(block.present[seeds & low])
        if not len(at):
            continue
        left = np.searchsorted(block.seeds, seeds[at], side="left")
        n = np.searchsorted(block.seeds, seeds[at], side="right") - left
        at, left, n = at[n > 0], left[n > 0], n[n > 0]
        for a, b in _runs(n, CELLS):
            here = np.repeat(at[a:b], n[a:b])
            hit = _ranges(left[a:b], n[a:b])
            text = np.searchsorted(words.first, here, side="right") - 1
            pairs.append(np.unique(np.stack([text, block.item[hit], here - words.first[text] - block.place[hit]]), axis=1))
    if not pairs:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    text, item, shift = np.unique(np.concatenate(pairs, axis=1), axis=1)
    begin = np.maximum(0, -shift)
    size = np.minimum(np.diff(block.first)[item], words.counts[text] - shift) - begin
    window = np.minimum(WINDOW, np.diff(block.first)[item])
    keep = size >= window
    text, item, shift, begin, size, window = (x[keep] for x in (text, item, shift, begin, size, window))
    equal, best = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    for a, b in _runs(size, CELLS):
        in_text = _ranges(words.first[text[a:b]] + shift[a:b] + begin[a:b], size[a:b])
        in_item = _ranges(block.first[item[a:b]] + begin[a:b], size[a:b])
        sums = np.concatenate(([0], np.cumsum(words.hash[in_text] == block.hashes[in_item])))
        ends = np.cumsum(size[a:b])
        tries = size[a:b] - window[a:b] + 1
        starts = _ranges(ends - size[a:b], tries)
        got = sums[starts + np.repeat(window[a:b], tries)] - sums[starts]
        heads = np.cumsum(tries) - tries
        equal[a:b] = np.maximum.reduceat(got, heads)
        most = np.flatnonzero(got == np.repeat(equal[a:b], tries))
        best[a:b] = starts[most[np.searchsorted(most, heads)]] - (ends - size[a:b])
    good = equal >= np.ceil(SHARE * window - 1e-9)
    text, item, shift, begin, window, equal, best = (x[good] for x in (text, item, shift, begin, window, equal, best))
    order = np.lexsort((begin + best + shift, -equal, item, text))
    text, item, shift, begin, window, equal, best = (x[order] for x in (text, item, shift, begin, window, equal, best))
    lead = np.ones(len(text), bool)
    lead[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
    return text[lead], item[lead], equal[lead], window[lead], (begin + best + shift)[lead], (begin + best)[lead]


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... n[0] numbers, and so on."""
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - ends + n, n)


def _runs(n: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs whose sum stays under most, one at least in each."""
    ends, a = np.cumsum(n), 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_equal, n_window, doc_word and item_word (0-based begin of the best window): one row for each text and item that overlap."""
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}"
    schema = kinds + ", n_equal bigint, n_window bigint, doc_word bigint, item_word bigint"
    rows, out = docs.select("doc_id", F.col("text").cast("string").alias("text")), None
    for block in blocks_of(items):
        part = rows.mapInArrow(lean(_reporter(docs.sparkSession.sparkContext.broadcast(block))), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    best = F.max_by(F.struct("n_equal", "n_window", "doc_word", "item_word"), F.struct("n_equal", -F.col("doc_word"), -F.col("item_word"))).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def _reporter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in text_slices(batches, "text"):
            text, item, *numbers = overlaps(find_words(batch.column("text"), lower=True, bare=True), block)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(text)), block.ids.take(pa.array(item)), *map(pa.array, numbers)], ["doc_id", "item_id", "n_equal", "n_window", "doc_word", "item_word"])

    return run


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose text overlaps with no item. What one block leaves is written before the next one's turn, so no task holds two."""
    out = docs
    for k, block in enumerate(blocks_of(items)):
        out = (written(out, "unleaked") if k else out).mapInArrow(lean(_sieve(docs.sparkSession.sparkContext.broadcast(block))), docs.schema)
    return out


def _sieve(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            text, *_ = overlaps(find_words(batch.column("text"), lower=True, bare=True), shared.value)
            keep = np.ones(batch.num_rows, bool)
            keep[text] = False
            yield batch.filter(pa.array(keep))

    return run


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
