"""Token-ID output: Parquet files of token lists with page indexes, for reading single documents or only their lengths.

Each text is encoded whole, an end id is appended, and rows are written in ascending order of doc_id (null first; ties by
text) with the columns doc_id, part, local_start, n_tokens and ids. Integers are delta-encoded (Parquet's version 2
pages, no dictionary) or dictionary-encoded; row groups and pages have bounded sizes; the writer adds column and offset
indexes, so a reader that filters by doc_id skips pages, and one that asks for lengths never touches the ids.
A null or empty text has the end id alone; an empty table gives files without rows.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import discarded, ensure_checkpoint_dir, table, text_slices
from tallyloom.llm.wordhash import bytes_of, hash_spans

END_ID = 1
#: Distinct words whose ids a Python worker keeps between batches.
CACHED_WORDS = 2_000_000
FILE_COLUMNS = "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids array<int>"


#: The normalizer and splitter (as in the tokenizer's file) for which pieces can be cut on bytes.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

# Classes of bytes: 0 white space, 1 letter, 2 digit, 3 other ASCII.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_CLASS[48:58] = 2


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cut_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """bytes (with lower-case letters), original bytes, start and end of the pieces, whether a piece is a whole odd word, and the bounds of each text's pieces.

    A piece is a run of letters, one digit, or a run of other characters, as the splitter has it. That is plain for words of ASCII and of
    the letters U+00C0 to U+00FF; words with other characters, an apostrophe or ``<|`` are odd and left whole for the tokenizer.
    """
    raw, offsets = bytes_of(texts)
    kind = _CLASS[raw]
    before = np.concatenate(([np.uint8(0)], raw))[:-1]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    accented = (before == 0xC3) & ~cut[:-1] & (raw >= 0x80) & (raw < 0xC0) & (raw != 0x97) & (raw != 0xB7)
    after = np.concatenate((accented[1:], [False])) if len(raw) else accented
    odd = ((raw >= 0x80) & ~accented & ~((raw == 0xC3) & after)) | (raw == 0x27) | ((raw == 0x7C) & (before == 0x3C))
    inside = kind > 0
    kind_before = np.concatenate(([np.uint8(0)], kind))[:-1]
    word_start = inside & ((kind_before == 0) | cut[:-1])
    word = np.cumsum(word_start) - 1
    is_odd = np.zeros(int(word[-1]) + 1 if len(word) else 0, bool)
    is_odd[word[odd & inside]] = True
    in_odd = inside & is_odd[np.maximum(word, 0)] if len(is_odd) else np.zeros(len(raw), bool)
    start_here = word_start | (inside & ~in_odd & ((kind != kind_before) | (kind == 2)))
    start = np.flatnonzero(start_here)
    stops = np.concatenate((start_here | ~inside, [True]))
    stops[offsets] = True
    stop = np.flatnonzero(stops)
    end = stop[np.searchsorted(stop, start, side="right")]
    upper = ((raw >= 65) & (raw <= 90)) | (accented & (raw <= 0x9E))
    lower = raw + np.where(upper & ~in_odd, 32, 0).astype(np.uint8)
    return lower, raw, start, end, in_odd[start], np.searchsorted(start, offsets)


class WordEncoder:
    """Whole texts through a tokenizer that drops white space and splits as SPLITTER does: each distinct piece is encoded once.

    Other tokenizers, or whole=True, encode each text in one call. Ids of up to CACHED_WORDS pieces stay for later batches, as
    arrays sorted by the pieces' hashes; pieces beyond that are encoded anew in each batch.
    """

    def __init__(self, vocabulary: str, whole: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        about = json.loads(self.tokenizer.to_str())
        self.whole = whole or (about["normalizer"], about["pre_tokenizer"]) != (NORMALIZER, SPLITTER)
        self.letters = _byte_letters()
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _pieces(self, lower: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray, odd: np.ndarray) -> list[list[int]]:
        tokenize, low, letters = self.tokenizer.model.tokenize, lower.tobytes(), self.letters
        out = [[t.id for t in tokenize(low[a:b].decode("latin-1").translate(letters))] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        if len(at := np.flatnonzero(odd)):
            whole = raw.tobytes()
            for i, ids in zip(at.tolist(), self._plain([whole[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]), strict=True):
                out[i] = ids
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the bounds of each text's ids."""
        if self.whole:
            got = self._plain([x or "" for x in texts.to_pylist()])
            return np.fromiter(chain.from_iterable(got), np.int32), np.concatenate(([0], np.cumsum([len(x) for x in got], dtype=np.int64)))
        lower, raw, start, end, odd, first = cut_pieces(texts)
        hashes = hash_spans(lower, start, end) ^ odd.astype(np.uint64)
        distinct, seen, which = np.unique(hashes, return_index=True, return_inverse=True)
        slot = np.searchsorted(self.known, distinct)
        old = slot < len(self.known)
        old[old] = self.known[slot[old]] == distinct[old]
        place = np.empty(len(distinct), np.int64)
        place[old] = self.place[slot[old]]
        ids, starts = self.ids, self.starts
        if len(new := np.flatnonzero(~old)):
            at = seen[new]
            got = self._pieces(lower, raw, start[at], end[at], odd[at])
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            fresh = np.fromiter(chain.from_iterable(got), np.int32, int(sizes.sum()))
            place[new] = len(starts) - 1 + np.arange(len(new))
            ids, starts = np.concatenate((ids, fresh)), np.concatenate((starts, starts[-1] + np.cumsum(sizes)))
            if (room := CACHED_WORDS - len(self.known)) > 0:
                kept = new[:room]
                self.known = np.insert(self.known, slot[kept], distinct[kept])
                self.place = np.insert(self.place, slot[kept], place[kept])
                self.starts = starts[: int(place[kept[-1]]) + 2].copy()
                self.ids = ids[: self.starts[-1]].copy()
        each = place[which]
        size = (starts[1:] - starts[:-1])[each]
        ends = np.cumsum(size)
        flat = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[each] - ends + size, size)
        return ids[flat], np.concatenate(([0], ends))[first]


_encoders: dict[tuple, WordEncoder] = {}


def _encoding(vocabulary: str, whole: bool, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        if (vocabulary, whole) not in _encoders:
            _encoders[vocabulary, whole] = WordEncoder(vocabulary, whole)
        encoder, before = _encoders[vocabulary, whole], 0
        for batch in text_slices(batches, "text"):
            ids, bounds = encoder.encode(batch.column("text"))
            n = batch.num_rows
            out = np.insert(ids, bounds[1:], end_id).astype(np.int32)
            bounds = bounds + np.arange(n + 1)
            sizes = np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(n, part, np.int32)), pa.array(before + bounds[:-1]), pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(out))],
                ["doc_id", "part", "local_start", "n_tokens", "ids"],
            )
            before += int(bounds[-1])

    return run


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, whole: bool = False, encoding: str = "delta", row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10, page_rows: int = 2000
) -> None:
    """Encodes docs (doc_id, text) and writes the files. encoding: delta or dictionary."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (
        dealt.mapInArrow(_encoding(vocabulary, whole, end_id), FILE_COLUMNS)
        .write.mode("overwrite")
        .option("parquet.writer.version", "PARQUET_2_0" if encoding == "delta" else "PARQUET_1_0")
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id and ids, of the given documents alone if there are any; the filter reaches row groups and pages."""
    df = spark.read.schema(FILE_COLUMNS).parquet(path).select("doc_id", "ids")
    return df if doc_ids is None else df.filter(F.col("doc_id").isin([int(x) for x in doc_ids]))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and n_tokens, without reading any ids. start counts the ids of all documents before in the order of the files."""
    rows = spark.read.schema(FILE_COLUMNS).parquet(path).select("doc_id", "part", "local_start", "n_tokens")
    return _with_start(rows).select("doc_id", "start", "n_tokens")


def _with_start(rows: DataFrame) -> DataFrame:
    """One row a part goes through the running sum; their number is that of the written partitions, not of documents."""
    from pyspark.sql import Window

    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    before = parts.withColumn("_before", F.sum("_total").over(Window.orderBy("part")) - F.col("_total")).select("part", "_before")
    return rows.join(F.broadcast(before), "part").withColumn("start", F.col("_before") + F.col("local_start"))


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        bounds = np.asarray(lists.offsets)
        flat = np.asarray(lists.values).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        sizes = np.diff(bounds).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("local_start"), pa.array(sizes), pa.array(crc, pa.int64())], ["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{ensure_checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    discarded(spark, path)  # when the driver ends
    back = spark.read.schema(FILE_COLUMNS).parquet(path).select("doc_id", "part", "local_start", "ids")
    return _with_start(back.mapInArrow(_crc, "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids_crc32 bigint")).select("doc_id", "start", "n_tokens", "ids_crc32")
