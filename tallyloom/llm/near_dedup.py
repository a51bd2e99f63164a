"""MinHash near-duplicates by a multi-index Hamming join.

A document's set is that of its distinct runs of n words (hashed to 64 bits); a shorter text is one run. Its signature has
CHUNKS * CHUNK slots, each the low BITS bits of a minimum of a hashed set. Two sets with a Jaccard similarity of 0.8 differ in a slot
with probability 0.2, so in more than DISTANCE of the 70 slots once in about 100,000 such pairs, less often the more alike they are.

Pairs up to that distance are found without fail: by the pigeonhole principle, one of the CHUNKS chunks has at most
ERRORS differing slots, so for some choice of ERRORS masked slots the others agree. Every choice gives a key, and pairs with a
key in common are candidates. Candidates meet the bounds of size and signature distance, then the full sets are compared.

Pairs are never written out. Documents with equal sets form one class, and one of them stands for it. In a bucket of one key, each
class is compared by signature with the bucket's first (in one of LEADS orders by hash, so that a large family is led by several of its members); pairs within the distance give groups of classes. Buckets that still hold several groups are
looked at again, in the bucket or where a group meets all its neighbours: classes of different groups are compared, a bounded block of them with another at a time, and only what joins two groups
goes on; so every pair within the distance that has a key in common ends in one group. Then the full sets of a group are compared, again a
block with another at a time. A class that is not yet linked to the largest component of its block meets all others there, so a large family of
near copies takes a few rounds and only its stragglers meet everyone; what goes on is at most one link for each class and block. What is kept between
steps is written to the checkpoint folder. Classes, groups and nodes that many rows share are split among tasks.

Null, empty and blank texts have no set and are linked with nothing. In near_duplicates() so are rows with a null doc_id, and rows with the same
doc_id are one node, whose texts' links it has all; without_near_copies() judges each row by its own text. A text is never cut, however long. Of a group the smallest doc_id stands for it,
null last. Columns of other names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import checkpointed, lean, meet, table, text_slices, written
from tallyloom.llm.components import components
from tallyloom.llm.wordhash import find_words, grams, mix, signed

CHUNKS, CHUNK, ERRORS, BITS = 10, 7, 2, 16
SLOTS = CHUNKS * CHUNK
#: The pigeonhole bound: one more, and every chunk could have more than ERRORS.
DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Orders in which buckets are led.
LEADS = 8
#: Classes of a bucket that are compared with as many others by signature at a time.
BLOCK = 2048
#: A group is cut into blocks of so many classes, but into no more than MOST_BLOCKS unless a block would hold more than BLOCK_SHINGLES.
SET_BLOCK, MOST_BLOCKS, BLOCK_SHINGLES = 128, 32, 1_000_000

_U = np.uint64
_FACTORS = mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)) | _U(1)
_STEP = _U(0x9E3779B97F4A7C15)
_MASKS = [[i for i in range(CHUNK) if i not in out] for out in combinations(range(CHUNK), ERRORS)]


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, and their bounds."""
    words = find_words(texts, lower=True)
    hashes, begin = grams(words.hash, words.first, n)
    owner = words.text[begin]
    if len(short := np.flatnonzero((words.counts > 0) & (words.counts < n))):
        whole = np.zeros(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n - 1):
                has = words.counts[short] > k
                whole[has] = whole[has] * _STEP + words.hash[words.first[short[has]] + k]
        hashes = np.concatenate((hashes, mix(whole + words.counts[short].astype(np.uint64))))
        owner = np.concatenate((owner, short))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SLOTS values of each non-empty set; zeros for an empty one."""
    out = np.zeros((len(first) - 1, SLOTS), np.uint16)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        with np.errstate(over="ignore"):
            for k, factor in enumerate(_FACTORS):
                out[full, k] = (mix(np.minimum.reduceat(hashes * factor, first[full])) & _U((1 << BITS) - 1)).astype(np.uint16)
    return out


def keys(sigs: np.ndarray) -> np.ndarray:
    """For each signature, a key for each chunk and choice of masked slots."""
    out = np.empty((len(sigs), CHUNKS * len(_MASKS)), np.uint64)
    wide = sigs.astype(np.uint64).reshape(len(sigs), CHUNKS, CHUNK)
    with np.errstate(over="ignore"):
        for c in range(CHUNKS):
            for m, slots in enumerate(_MASKS):
                k = c * len(_MASKS) + m
                acc = np.full(len(sigs), k + 1, np.uint64)
                for s in slots:
                    acc = mix(acc * _STEP + wide[:, c, s])
                out[:, k] = acc
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=-1)


def _sigs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), SLOTS)


def _sketcher(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            hashes, first = shingle_sets(batch.column("text"), n)
            sums = [np.concatenate(([_U(0)], np.cumsum(h)))[first] for h in (mix(hashes + _U(1)), mix(hashes + _U(2)))]
            set1, set2 = (x[1:] - x[:-1] for x in sums)
            sig = [x.tobytes() for x in signatures(hashes, first)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(np.diff(first)), signed(set1), signed(set2), pa.array(sig, pa.binary())], ["doc_id", "th", "n", "set1", "set2", "sig"])

    return run


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            found = keys(_sigs(part.column("sig")))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]), signed(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column("node"), lists], ["node", "keys"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and an order of their nodes. Those of keys with several nodes go on, with the key's first node and whether there are more than two.

    A run's first two rows wait for the third, everything else passes at once.
    """
    names = ["key", "node", "lead", "many"]
    key = lead = held = None
    size = 0
    for batch in batches:
        k, v = (np.asarray(batch.column(i)) for i in (0, 1))
        if not len(k):
            continue
        if key is not None:  # the rows before go on as if they stood in this batch
            k, v = np.concatenate((np.full(len(held), key, np.int64), k)), np.concatenate((held, v))
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, len(k)))
        leads = v[starts]
        prior = np.zeros(len(starts), np.int64)
        if key is not None and size > len(held) and k[0] == key:  # rows of the first run have gone on already
            leads[0], prior[0] = lead, size - len(held)
        run = np.repeat(np.arange(len(starts)), lengths)
        total = lengths + prior
        last = len(starts) - 1
        open_rows = int(lengths[last]) if total[last] <= 2 else 0
        done = len(k) - open_rows
        out = np.flatnonzero((total[run] > 1)[:done])
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(k[out]), pa.array(v[out]), pa.array(leads[run[out]]), pa.array(total[run[out]] > 2)], names)
        key, lead, size, held = k[-1], leads[last], int(total[last]), v[done:]
    if held is not None and size == 2 and len(held) == 2:
        yield pa.RecordBatch.from_arrays([pa.array([key] * 2, pa.int64()), pa.array(held), pa.array([held[0]] * 2, pa.int64()), pa.array([False] * 2)], names)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = distances(_sigs(batch.column("sig_a")), _sigs(batch.column("sig_b"))) <= DISTANCE
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            hashes, first = shingle_sets(batch.column("text"), n)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), signed(hashes))], ["node", "set"])

    return run


class _Union:
    """Sets of numbers that are joined step by step."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.above.get(x, x)) != x:
            self.above[x] = x = self.above.get(y, y)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
        return a != b


def _tiles(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each (by) together; they come sorted by it."""
    kept: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        at = [np.asarray(batch.column(x)) for x in by]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in at], axis=0)) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
            if a == b:
                continue
            here = tuple(int(x[a]) for x in at)
            if here != now and kept:
                yield pa.Table.from_batches(kept).combine_chunks()
                kept = []
            now = here
            kept.append(batch.slice(a, b - a))
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _bridges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes near enough by signature that join two groups which the task has not joined before."""
    joined = _Union()
    for rows in _tiles(batches, ("place", "left", "right")):
        node, group, n, half = (rows.column(x).to_numpy() for x in ("node", "group", "n", "half"))
        sig = _sigs(_one(rows.column("sig")))
        two = rows.column("left")[0].as_py() != rows.column("right")[0].as_py()
        out = []
        for i in np.flatnonzero(half == 0):
            others = np.flatnonzero((half == 1) if two else (np.arange(len(node)) > i))
            others = others[(group[others] != group[i]) & (100 * np.minimum(n[others], n[i]) >= 80 * np.maximum(n[others], n[i]))]
            others = others[distances(sig[others], sig[i]) <= DISTANCE]
            out += [(int(node[i]), int(node[j])) for j in others if joined.join(int(group[i]), int(group[j]))]
        if len(joined.above) > 1_000_000:
            joined = _Union()
        yield _pairs(out)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])


def set_links(sets: list[np.ndarray] | tuple[np.ndarray, np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the sets as all links would: of a flat array of values and bounds, pairs of places."""
    values, bounds = sets
    dense = np.unique(values, return_inverse=True)[1]
    size = np.diff(bounds)
    mark = np.zeros(int(dense.max()) + 1 if len(dense) else 0, bool)
    component, done, out = np.arange(len(size)), np.zeros(len(size), bool), []
    while True:
        count = np.bincount(component, minlength=len(size))
        waiting = np.flatnonzero(~done & (component != count.argmax()))
        if not len(waiting):
            return out
        x = int(waiting[0])
        done[x] = True
        own = dense[bounds[x] : bounds[x + 1]]
        mark[own] = True
        same = np.add.reduceat(mark[dense], bounds[:-1], dtype=np.int64)
        mark[own] = False
        for y in np.flatnonzero(100 * same >= percent * (size + size[x] - same)):
            if component[y] != component[x]:
                out.append((x, int(y)))
                component[component == component[y]] = component[x]


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tiles(batches, ("group", "left", "right")):
            node, lists = rows.column("node").to_numpy(), _one(rows.column("set"))
            bounds = np.asarray(lists.offsets).astype(np.int64)
            values = np.asarray(lists.values)[bounds[0] : bounds[-1]]
            yield _pairs([(int(node[x]), int(node[y])) for x, y in set_links((values, bounds - bounds[0]), percent)])

    return run


def _fits(na: Column, nb: Column, percent: int) -> Column:
    return 100 * F.least(na, nb) >= percent * F.greatest(na, nb)


def _tiled(rows: DataFrame, key: str, blocks: Column, *carried: str) -> DataFrame:
    """Rows of a key with each other, block by block: a row goes to each pair of blocks that its own is part of."""
    placed = rows.withColumn("blocks", F.greatest(blocks, F.lit(1)).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    every = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = [F.least("own", "other").cast("bigint").alias("left"), F.greatest("own", "other").cast("bigint").alias("right"), (F.col("own") > F.col("other")).cast("int").alias("half")]
    return every.select(key, *side, "node", *carried).repartition(key, "left", "right").sortWithinPartitions(key, "left", "right", "half", "node")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and its hash th."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))


def _sketch(rows: DataFrame, shingle: int) -> DataFrame:
    """Set size, set hashes and signature of each row, with node, the hash that its class goes by (null without a set)."""
    sketch = checkpointed(rows.mapInArrow(lean(_sketcher(shingle)), "doc_id bigint, th bigint, n bigint, set1 bigint, set2 bigint, sig binary"))
    return sketch.withColumn("node", F.when(F.col("n") > 0, F.xxhash64("n", "set1", "set2")))


def _classes(real: DataFrame) -> DataFrame:
    """One row a class of equal sets: its node, number of rows and first row (by doc_id, null last, and text)."""
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    return checkpointed(real.groupBy("node", "n", "set1", "set2").agg(F.min(at).alias("first"), F.first("sig").alias("sig"), F.count("*").alias("rows"))).drop("set1", "set2")


def _members(groups: DataFrame) -> DataFrame:
    """node and group of all nodes, roots too."""
    return groups.select("node", F.col("root").alias("group")).unionByName(groups.select(F.col("root").alias("node"), F.col("root").alias("group")).distinct())


def _firsts(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """node, the first row of its group, and the class's number of rows, as a written table; a class that is linked with nothing is its own group."""
    members = checkpointed(_members(roots).join(classes.select("node", "first"), "node"))
    least = written(members.groupBy("group").agg(F.min("first").alias("best"), F.count("*").alias("n")), "groups")
    linked = meet(members.select("node", "group"), least, ["group"]).select("node", "best")
    return written(classes.select("node", "first", "rows").join(linked, "node", "left").select("node", F.coalesce("best", "first").alias("best"), F.col("rows").alias("n")), "firsts")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that links reach, for each row of docs (doc_id, text).

    percent is at least 80, for which the signatures are made.
    """
    rows = _keyed(docs)
    sketch = _sketch(rows, shingle).withColumn("node", F.when(F.col("doc_id").isNotNull(), F.col("node")))
    real = sketch.filter("node IS NOT NULL")
    classes = _classes(real)
    several = real.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("_high")).filter("a <> _high").select("doc_id", "a")
    one_id = real.select("doc_id", F.col("node").alias("b")).join(several, "doc_id").select("a", "b")
    named = _firsts(classes, _roots(rows, classes, shingle, percent, one_id))
    placed = meet(sketch.select("doc_id", "n", "node").withColumnRenamed("n", "n_shingles"), named, ["node"], how="left")
    return placed.select("doc_id", "n_shingles", F.coalesce("best.doc_id", "doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs (whose columns can be ordered) without near copies: of each group one row stays, that with the smallest doc_id.

    Rows are judged by their texts: one doc_id on two texts doesn't link them. Of repeated rows (equal doc_id and text) one stays, the first by its other columns.
    """
    rows = _keyed(docs)
    sketch = _sketch(rows, shingle)
    real = sketch.filter("node IS NOT NULL")
    classes = _classes(real)
    named = _firsts(classes, _roots(rows, classes, shingle, percent))
    judged = meet(real.select("doc_id", "th", "node"), named, ["node"])
    stays = (F.col("best.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("best.th") == F.col("th"))
    told = judged.groupBy(_did(), "th").agg(F.max(stays).alias("stays"), F.count("*").alias("n"))
    odd = written(told.filter("NOT stays OR n > 1"), "copies")
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th")).select("row", _did(), "th")
    whole = keyed.join(odd.select("did", "th"), ["did", "th"], "left_anti").select("row.*")
    one = keyed.join(odd.filter("stays").select("did", "th"), ["did", "th"], "left_semi").groupBy("did", "th").agg(F.min("row").alias("row")).select("row.*")
    return whole.unionByName(one)


def _did() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("did")


def _roots(rows: DataFrame, classes: DataFrame, shingle: int, percent: int, more: DataFrame | None = None) -> DataFrame:
    """node and root of all classes that links of full sets, and the links more, join with others."""
    if percent < 80:
        raise ValueError("the signatures are made for a similarity of 0.8 or more")
    spelled = classes.filter("n >= 4").select("node", "sig").mapInArrow(lean(_spell), "node bigint, keys array<bigint>")
    dealt = spelled.select(F.explode("keys").alias("key"), "node").repartition("key").sortWithinPartitions("key", F.xxhash64("node", F.pmod("key", F.lit(LEADS))))
    buckets = written(dealt.mapInArrow(lean(_runs), "key bigint, node bigint, lead bigint, many boolean"), "buckets")
    sized = classes.select("node", "n", "sig")
    a, b = (sized.select(*(F.col(c).alias(f"{c}_{x}" if c != "node" else x) for c in sized.columns)) for x in "ab")
    stars = buckets.filter("node <> lead").select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
    fit = stars.join(a, "a").join(b, "b").filter(_fits(F.col("n_a"), F.col("n_b"), percent))
    near = fit.select("a", "b", "sig_a", "sig_b").mapInArrow(lean(_near), "a bigint, b bigint")
    groups = components(near)
    bridges = checkpointed(_between_groups(buckets, sized, groups))
    if not bridges.isEmpty():
        groups = components(bridges.unionByName(groups.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    links = _links(rows, classes, groups, shingle, percent)
    return components(links if more is None else links.unionByName(more))


def _between_groups(buckets: DataFrame, sized: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs (a, b) of different groups that share a bucket and are near enough by size and signature, as many as join the groups.

    Classes meet bucket by bucket, or at hubs: the largest group of each such bucket with all groups that it shares one with, where a pair meets
    once however many buckets it shares. Both compare all pairs that share a bucket; the one that deals out fewer rows is taken.
    """
    members = _members(groups)
    named = meet(members, written(members.groupBy("group").agg(F.count("*").alias("of")).withColumn("n", F.col("of")), "sizes"), ["group"])
    grouped = buckets.filter("many").select("key", "node").join(named, "node", "left").select("key", "node", F.coalesce("group", "node").alias("group"), F.coalesce("of", F.lit(1)).alias("of"))
    held = grouped.groupBy("key", "group", "of").agg(F.count("*").alias("rows"))
    most = held.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.max(F.struct("of", "group")).alias("most"), F.sum("rows").alias("size"))
    split = checkpointed(most.filter("low <> high").select("key", F.col("most.group").alias("hub"), "size"))
    partners = checkpointed(held.join(split, "key").groupBy("hub", "group").agg(F.max("of").alias("of")))
    sizes = partners.groupBy("hub").agg(F.sum("of").alias("size"))
    hub_blocks = F.greatest(F.least(F.ceil(F.col("size") / SET_BLOCK), F.lit(MOST_BLOCKS)), F.lit(1))
    by_bucket = split.agg(F.coalesce(F.sum(F.col("size") * F.ceil(F.col("size") / BLOCK)), F.lit(0))).first()[0]
    by_hub = sizes.agg(F.coalesce(F.sum(F.col("size") * hub_blocks), F.lit(0))).first()[0]
    if by_hub < by_bucket:
        classes = sized.join(named.drop("of"), "node", "left").withColumn("group", F.coalesce("group", "node"))
        mixed = classes.join(partners.select("hub", "group"), "group").join(sizes, "hub").withColumnRenamed("hub", "place")
        tiles = _tiled(mixed, "place", hub_blocks, "group", "n", "sig")
    else:
        mixed = grouped.join(split.select("key", "size"), "key").join(sized, "node").withColumnRenamed("key", "place")
        tiles = _tiled(mixed, "place", F.ceil(F.col("size") / BLOCK), "group", "n", "sig")
    return tiles.mapInArrow(lean(_bridges), "a bigint, b bigint")


def _links(docs: DataFrame, classes: DataFrame, groups: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between full sets, as many as connect what all links connect."""
    known = checkpointed(_members(groups).join(classes.select("node", "n", F.coalesce("first.doc_id", F.lit(-(2**63))).alias("did"), F.col("first.th").alias("th")), "node"))
    sizes = known.groupBy("group").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.least(F.ceil(F.col("size") / SET_BLOCK), F.lit(MOST_BLOCKS)), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    placed = meet(known.select("node", "group", "did", "th"), written(sizes.select("group", blocks.alias("cuts"), F.col("size").alias("n")), "cuts"), ["group"])
    texts = docs.select("text", _did(), "th").join(known.select("node", "did", "th"), ["did", "th"]).select("node", "text")
    sets = texts.mapInArrow(lean(_sets(shingle)), "node bigint, set array<bigint>")
    return _tiled(sets.join(placed.select("node", "group", "cuts"), "node"), "group", F.col("cuts"), "set").mapInArrow(lean(_verifier(percent)), "a bigint, b bigint")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


OP10_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM split
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS same FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
), linked AS (
  SELECT a, b FROM common WHERE 100 * same >= 80 * (na + nb - same)
), ways AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a
), roots AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM sets s JOIN roots r ON s.doc_id = r.doc_id
"""
