"""SentencePiece encoding and decoding: the N best segmentations of whole texts over the piece lattice.

A text's lattice has an edge for each stretch that is a piece. A space is written as the mark U+2581, and one mark stands before the text;
a character that no piece has becomes the byte pieces of its UTF-8 form, as does a mark that the text itself holds, so decoding
gives back every text. Forward Viterbi scores of all prefixes are exact heuristics for an A* search backward from the end, which yields
segmentations from the best on. Scores are log probabilities in units of 2**-20, whole numbers, so sums and ties are exact. If the model
ranks its pieces (byte-pair merges), a piece's probability falls with its rank by Zipf's law; otherwise its own score is used.

No piece goes on from another character into a mark (checked when a model is loaded), so the lattice of a text is a chain of
segments' lattices. Each distinct segment goes forward once, all of them together in numpy, with its best and second-best
score. The N best of the text differ from the best only in the N - 1 segments with the smallest gaps between the two; A* runs on
those, and a heap joins their segmentations to those of the text. Among equal scores, any may come first.

Null and empty texts have no pieces, one segmentation and score 0. Repeated rows are encoded alike; columns of other names are left out.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import lean, table, text_slices
from tallyloom.llm.wordhash import mix

MARK = "▁"
BEST = 4
UNIT = 1 << 20
#: Distinct segments whose pieces a Python worker keeps between batches.
CACHED_SEGMENTS = 1_000_000

_U = np.uint64
_FACTOR = 0x9E3779B97F4A7C15
_NONE = np.int64(-(1 << 60))
#: Stands for a mark that the text holds itself.
_OWN_MARK = 0x110000
#: Powers are added by so many.
_POWERS = 1 << 17
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the factor and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_FACTOR, pow(_FACTOR, -1, 1 << 64))):
            steps = np.full(-(-n // _POWERS) * _POWERS, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


class Prefixes:
    """Hashes of any stretch of a sequence of code points, equal for equal stretches anywhere."""

    def __init__(self, points: np.ndarray):
        up, self.down = _power(len(points) + 1)
        self.sums = np.concatenate(([_U(0)], np.cumsum(mix(points.astype(np.uint64) + _U(1)) * up[:-1], dtype=np.uint64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - ends + n, n)


class Lattice:
    """The pieces of a model, and the segments met so far."""

    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: dict[int, int]):
        """pieces: id, spelling and score of ordinary ones. byte_ids: the id of each byte."""
        if any(MARK in p.lstrip(MARK) for _, p, _ in pieces):
            raise ValueError("a piece spans words")
        ids = np.array([i for i, _, _ in pieces], np.int64)
        scores = self.units(np.array([s for _, _, s in pieces], float))
        self.worst = int(scores.min()) - 10 * UNIT
        self.bytes_of = {i: p.replace(MARK, " ").encode() for i, p, _ in pieces} | {i: bytes([b]) for b, i in byte_ids.items()}
        self.byte_ids, self.longest = byte_ids, max(len(p) for _, p, _ in pieces)
        self.score_of = {p: (int(s), int(i)) for (i, p, _), s in zip(pieces, scores, strict=True)}
        joined = _points("".join(p for _, p, _ in pieces))
        ends = np.cumsum([len(p) for _, p, _ in pieces])
        hashes = Prefixes(joined).of(ends - [len(p) for _, p, _ in pieces], ends)
        order = np.argsort(hashes)
        self.hashes, self.piece_score, self.piece_id = hashes[order], scores[order], ids[order]
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[hashes >> _U(46)] = True
        self.known_point = np.zeros(0x110001, bool)
        self.known_point[joined] = True
        self.wide = np.array([1, 2, 3, 4])[np.searchsorted([0x80, 0x800, 0x10000], np.arange(0x110001), side="right")]
        self.wide[_OWN_MARK] = 3
        size = max(self.bytes_of) + 1
        spelled = [self.bytes_of.get(i, b"") for i in range(size)]
        self.spell = np.frombuffer(b"".join(spelled), np.uint8)
        self.spell_start = np.concatenate(([0], np.cumsum([len(x) for x in spelled])))
        self.cache_keys, self.cache_place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.best, self.gap = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    @staticmethod
    def units(scores: np.ndarray) -> np.ndarray:
        """Log probabilities in whole units; ranks (0, -1, -2, ...) by Zipf's law."""
        if len(scores) > 1 and (scores == np.round(scores)).all():
            rank = -scores - (-scores).min()
            scores = -np.log(rank + 2) - np.log((1 / (rank + 2)).sum())
        return np.round(scores * UNIT).astype(np.int64)

    @classmethod
    def load(cls, model_file: str) -> Lattice:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        every = range(sp.get_piece_size())
        byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in every if sp.is_byte(i)}
        return cls([(i, sp.id_to_piece(i), sp.get_score(i)) for i in every if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))], byte_ids)

    # --- one segment, exactly -------------------------------------------------------------------------------

    def edges(self, segment: str) -> list[list[tuple[int, int, tuple[int, ...]]]]:
        """For each end, the edges that lead there: begin, score, ids."""
        out: list[list] = [[] for _ in range(len(segment) + 1)]
        for end in range(1, len(segment) + 1):
            for begin in range(end - 1, max(-1, end - 1 - self.longest), -1):
                if got := self.score_of.get(segment[begin:end]):
                    out[end].append((begin, got[0], (got[1],)))
            if segment[end - 1] not in self.score_of:
                raw = segment[end - 1].encode()
                out[end].append((end - 1, self.worst * len(raw), tuple(self.byte_ids[b] for b in raw)))
        return out

    def nbest(self, segment: str, n: int) -> list[tuple[int, list[int]]]:
        """Scores and ids of the n best segmentations of a text (spaces as marks), by A* from its end with the Viterbi scores of its prefixes."""
        edges = self.edges(segment)
        forward = [0] + [int(_NONE)] * len(segment)
        for end in range(1, len(segment) + 1):
            forward[end] = max(forward[begin] + score for begin, score, _ in edges[end])
        heap: list[tuple] = [(-forward[-1], len(segment), 0, 0, None)]
        out, count = [], 1
        while heap and len(out) < n:
            _, at, _, behind, path = heapq.heappop(heap)  # of equals the one nearest to the beginning, so ties don't all open up
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    ids.extend(path[0])
                    path = path[1]
                out.append((behind, ids))
                continue
            for begin, score, ids in edges[at]:
                heapq.heappush(heap, (-(behind + score + forward[begin]), begin, count, behind + score, (ids, path)))
                count += 1
        return out

    # --- many segments at once ------------------------------------------------------------------------------

    def _lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score, piece = np.full(len(hashes), _NONE), np.full(len(hashes), -1)
        likely = np.flatnonzero(self.maybe[hashes >> _U(46)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[likely]), len(self.hashes) - 1)
        found = self.hashes[at] == hashes[likely]
        score[likely[found]], piece[likely[found]] = self.piece_score[at[found]], self.piece_id[at[found]]
        return score, piece

    def forward(self, points: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best score, gap to the second best (or a huge one), and the best segmentation's ids with their bounds, of each segment points[start:start + size]."""
        order = np.argsort(-size, kind="stable")
        base, reach = start[order], size[order]
        longest = int(reach[0])
        prefixes = Prefixes(points)
        # one more place for each segment: that before its first character
        own = np.cumsum(reach + 1) - (reach + 1)
        first = np.full(int((reach + 1).sum()), _NONE)
        second, back, back_id = first.copy(), np.zeros(len(first), np.int32), np.zeros(len(first), np.int32)
        first[own] = 0
        active = np.searchsorted(-reach, -np.arange(1, longest + 1), side="right")
        for t, n in enumerate(active.tolist(), 1):
            end = base[:n] + t
            one, two = np.full(n, _NONE), np.full(n, _NONE)
            size_of, id_of = np.zeros(n, np.int32), np.zeros(n, np.int32)
            for k in range(1, min(t, self.longest) + 1):
                score, piece = self._lookup(prefixes.of(end - k, end))
                if k == 1:
                    lone = piece < 0
                    point = points[end[lone] - 1]
                    score[lone], piece[lone] = self.worst * self.wide[point], -1 - point.astype(np.int64)
                hit = np.flatnonzero(score != _NONE)
                before = own[hit] + t - k
                a, b = first[before] + score[hit], second[before] + score[hit]
                old = one[hit]
                two[hit] = np.maximum(np.maximum(two[hit], b), np.minimum(old, a))
                better = a > old
                one[hit] = np.maximum(old, a)
                size_of[hit[better]] = k
                id_of[hit[better]] = piece[hit[better]]
            first[own[:n] + t], second[own[:n] + t] = one, np.maximum(two, _NONE)
            back[own[:n] + t], back_id[own[:n] + t] = size_of, id_of
        last = own + reach
        best, gap = first[last], np.where(second[last] > _NONE // 2, first[last] - second[last], -_NONE)
        at, who = reach.copy(), np.arange(len(reach))
        owners, ids = [], []
        while len(who):
            place = own[who] + at[who]
            owners.append(who)
            ids.append(back_id[place])
            at[who] -= back[place]
            who = who[at[who] > 0]
        owner, flat = np.concatenate(owners)[::-1], np.concatenate(ids)[::-1].astype(np.int64)
        line = np.argsort(order[owner], kind="stable")
        owner, flat = order[owner][line], flat[line]
        owner, flat = self._as_bytes(owner, flat)
        out_best, out_gap = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        out_best[order], out_gap[order] = best, gap
        return out_best, out_gap, flat.astype(np.int32), np.searchsorted(owner, np.arange(len(order) + 1))

    def _as_bytes(self, owner: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Puts the byte pieces in the place of characters without a piece (negative ids)."""
        lone = np.flatnonzero(ids < 0)
        if not len(lone):
            return owner, ids
        points, which = np.unique(-1 - ids[lone], return_inverse=True)
        spelled = [(MARK if p == _OWN_MARK else chr(p)).encode() for p in points.tolist()]
        n = np.ones(len(ids), np.int64)
        n[lone] = np.array([len(x) for x in spelled])[which]
        out = np.repeat(ids, n)
        table = np.array([self.byte_ids[b] for x in spelled for b in x])
        heads = np.concatenate(([0], np.cumsum([len(x) for x in spelled])))[:-1]
        out[_ranges((np.cumsum(n) - n)[lone], n[lone])] = table[_ranges(heads[which], n[lone])]
        return np.repeat(owner, n), out

    def segments(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All code points (spaces as marks), start and size of the segments, and the bounds of each text's segments."""
        joined = "".join(" " + t if t else "" for t in texts)
        points = _points(joined).copy()
        points[points == ord(MARK)] = _OWN_MARK
        size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        offsets = np.concatenate(([0], np.cumsum(size)))
        points[points == 32] = ord(MARK)
        mark = points == ord(MARK)
        lone = ~self.known_point[points]
        cut = np.zeros(len(points) + 1, bool)
        cut[1:-1] = (mark[1:] & ~mark[:-1]) | lone[1:] | lone[:-1]
        cut[offsets] = True
        start = np.flatnonzero(cut[:-1])
        return points, start, np.diff(np.append(start, len(points))), np.searchsorted(start, offsets)

    def places(self, points: np.ndarray, start: np.ndarray, size: np.ndarray):
        """The place of each segment in (best, gap, ids, starts), which hold the cache and what is new."""
        hashes = mix(Prefixes(points).of(start, start + size) + size.astype(np.uint64))
        distinct, seen, which = np.unique(hashes, return_index=True, return_inverse=True)
        slot = np.searchsorted(self.cache_keys, distinct)
        old = slot < len(self.cache_keys)
        old[old] = self.cache_keys[slot[old]] == distinct[old]
        place = np.empty(len(distinct), np.int64)
        place[old] = self.cache_place[slot[old]]
        best, gap, ids, starts = self.best, self.gap, self.ids, self.starts
        if len(new := np.flatnonzero(~old)):
            got_best, got_gap, got_ids, bounds = self.forward(points, start[seen[new]], size[seen[new]])
            place[new] = len(best) + np.arange(len(new))
            best, gap, ids = (np.concatenate(x) for x in ((best, got_best), (gap, got_gap), (ids, got_ids)))
            starts = np.concatenate((starts, starts[-1] + bounds[1:]))
            if (room := CACHED_SEGMENTS - len(self.cache_keys)) > 0:
                kept = new[:room]
                self.cache_keys = np.insert(self.cache_keys, slot[kept], distinct[kept])
                self.cache_place = np.insert(self.cache_place, slot[kept], place[kept])
                n = int(place[kept[-1]]) + 1
                self.best, self.gap, self.starts = best[:n].copy(), gap[:n].copy(), starts[: n + 1].copy()
                self.ids = ids[: self.starts[-1]].copy()
        return place[which], best, gap, ids, starts

    def decode_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that the ids stand for, and where those of each id begin and end."""
        n = (self.spell_start[1:] - self.spell_start[:-1])[ids]
        return self.spell[_ranges(self.spell_start[ids], n)], np.concatenate(([0], np.cumsum(n)))

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids)[1:].decode("utf-8", "replace")


def joined_best(options: list[list[int]], n: int) -> list[tuple[int, tuple[int, ...]]]:
    """The n smallest sums of one loss from each list (ascending, from 0), with the places taken."""
    if any(not x for x in options):
        return []
    begin = (0,) * len(options)
    heap, seen, out = [(sum(x[0] for x in options), begin)], {begin}, []
    while heap and len(out) < n:
        total, at = heapq.heappop(heap)
        out.append((total, at))
        for j in range(len(options)):
            if at[j] + 1 < len(options[j]) and (after := (*at[:j], at[j] + 1, *at[j + 1 :])) not in seen:
                seen.add(after)
                heapq.heappush(heap, (total + options[j][after[j]] - options[j][at[j]], after))
    return out


_lattices: dict[str, Lattice] = {}
CHANGE = "array<struct<piece: int, n: int, ids: array<int>>>"


def encode_texts(lattice: Lattice, texts: pa.Array, n: int) -> dict[str, list | np.ndarray]:
    """For each text: bounds of its ids, total scores of the n best, the changes of each against the best, and whether decoding gives the text back."""
    strings = [t or "" for t in texts.to_pylist()]
    points, start, size, first = lattice.segments(strings)
    place, best, gap, ids, starts = lattice.places(points, start, size) if len(start) else (np.zeros(0, np.int64), lattice.best, lattice.gap, lattice.ids, lattice.starts)
    count = (starts[1:] - starts[:-1])[place]
    flat = ids[_ranges(starts[place], count)]
    piece_at = np.concatenate(([0], np.cumsum(count)))
    bounds = piece_at[first]
    totals = np.concatenate(([0], np.cumsum(best[place])))[first]
    gaps = gap[place]
    raw, byte_at = lattice.decode_bytes(flat)
    raw = raw.tobytes()
    memo: dict[int, list] = {}
    scores, changes, back = [], [], []
    for i, text in enumerate(strings):
        a, b = int(first[i]), int(first[i + 1])
        here, told = int(totals[i + 1] - totals[i]), text.encode()
        back.append(raw[byte_at[bounds[i]] + (b > a) : byte_at[bounds[i + 1]]] == told)
        own = gaps[a:b]
        few = np.arange(len(own)) if len(own) < n else np.argpartition(own, n - 2)[: n - 1] if n > 1 else np.zeros(0, np.int64)
        few = sorted((a + few[own[few] < -_NONE]).tolist())
        lists = []
        for s in few:
            p = int(place[s])
            if p not in memo:
                best_ids = ids[starts[p] : starts[p + 1]].tolist()
                found = lattice.nbest(points[start[s] : start[s] + size[s]].astype("<u4").tobytes().decode("utf-32-le"), n + 1)
                memo[p] = [(0, best_ids), *[(int(best[p]) - score, x) for score, x in found if x != best_ids][: n - 1]]
            lists.append(memo[p])
        combos = joined_best([[loss for loss, _ in x] for x in lists], n) if lists else [(0, ())]
        scores.append([(here - loss) / UNIT for loss, _ in combos])
        changes.append([[{"piece": int(piece_at[s] - bounds[i]), "n": int(count[s]), "ids": x[k][1]} for s, x, k in zip(few, lists, at, strict=True) if k] for _, at in combos[1:]])
    return {"ids": flat, "bounds": bounds, "scores": scores, "changes": changes, "round_trip": back}


def _encoder(model_file: str, n: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_file not in _lattices:
            _lattices[model_file] = Lattice.load(model_file)
        lattice = _lattices[model_file]
        for batch in text_slices(batches, "text"):
            got = encode_texts(lattice, batch.column("text"), n)
            bounds, ids = got["bounds"], got["ids"]
            wire = ids.astype("<u4")
            crc = [zlib.crc32(wire[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            columns = {
                "doc_id": batch.column("doc_id"), "n_pieces": pa.array(np.diff(bounds)), "ids_crc32": pa.array(crc, pa.int64()),
                "scores": pa.array(got["scores"], pa.list_(pa.float64())), "round_trip": pa.array(got["round_trip"], pa.bool_()),
            }
            if with_ids:
                kind = pa.list_(pa.list_(pa.struct([("piece", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])))
                columns |= {"ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)), "changes": pa.array(got["changes"], kind)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def encode_nbest(docs: DataFrame, model_file: str, n: int = BEST, with_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, scores (of the n best, descending) and round_trip of each row of docs (doc_id, text).

    with_ids adds ids, the best segmentation, and changes: for each of the others, the stretches of ids (from piece on, n of them) that others take the place of.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pieces bigint, ids_crc32 bigint, scores array<double>, round_trip boolean"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(_encoder(model_file, n, with_ids)), schema + (f", ids array<int>, changes array<{CHANGE}>" if with_ids else ""))


def decode_ids(rows: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text of each row of rows (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_file not in _lattices:
            _lattices[model_file] = Lattice.load(model_file)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([_lattices[model_file].decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_nbest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
