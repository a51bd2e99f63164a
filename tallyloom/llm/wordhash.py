"""Words of many texts at once, found and hashed in numpy on the texts' UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
#: Words are hashed byte by byte up to this length; the rest of a longer word is hashed in one piece.
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
        return x ^ (x >> _U(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: ASCII characters other than letters, digits and white space.
_MARK = np.array([i < 128 and not chr(i).isalnum() and not _WHITE[i] for i in range(256)])


@dataclass
class Words:
    """hash, start and end (byte places) of each word; first[i]:first[i + 1] are the words of text i."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    bytes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes and the offsets of the texts; a null text is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def find_words(texts: pa.Array, lower: bool = False, bare: bool = False) -> Words:
    """lower: A-Z become a-z. bare: ASCII punctuation is taken out first, so words differ by letters and digits only."""
    raw, offsets = bytes_of(texts)
    if bare:
        keep = ~_MARK[raw]
        offsets = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))[offsets]
        raw = raw[keep]
    if lower:
        raw = _LOWER[raw]
    inside = ~_WHITE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside))[:-1]
    after = np.concatenate((inside, [False]))[1:]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    first = np.searchsorted(start, offsets)
    return Words(_hashes(raw, start, end), start, end, first, raw)


def _hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    out = size.astype(np.uint64)
    if not len(size):
        return out
    order = np.argsort(-size, kind="stable")
    longest = int(size[order[0]])
    begins, acc = start[order], out[order]
    reach = np.searchsorted(-size[order], -np.arange(min(longest, _LONG)), side="left")
    with np.errstate(over="ignore"):
        for k, n in enumerate(reach.tolist()):
            acc[:n] = acc[:n] * _STEP + _BYTE[raw[begins[:n] + k]]
        for i in range(int(np.searchsorted(-size[order], -_LONG, side="left"))):
            rest = raw[begins[i] + _LONG : end[order[i]]].tobytes()
            acc[i] = acc[i] * _STEP + _U(xxhash.xxh64_intdigest(rest))
    out[order] = acc
    return mix(out)


def hash_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans differ in place, not in value, where their bytes are equal."""
    return _hashes(raw, start, end)


def grams(hashes: np.ndarray, first: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words that stay in one text, and the word at which each begins."""
    total = len(hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    base = hashes if seed == 0 else mix(hashes + _U(seed))
    with np.errstate(over="ignore"):
        if n <= 8:
            acc = base[:total].copy()
            for k in range(1, n):
                acc = acc * _STEP + base[k : total + k]
        else:  # by doubling: acc holds runs of a power of two, out the run built so far
            acc, size, out, built = base, 1, None, 0
            want = n
            while want:
                if want & 1:
                    out = acc[:total] if out is None else out * _power(size) + acc[built : built + total]
                    built += size
                want >>= 1
                if want:
                    acc = acc[: len(acc) - size] * _power(size) + acc[size:]
                    size *= 2
            acc = out
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin = np.flatnonzero(text[:total] == text[n - 1 :])
    return mix(acc[begin] + _U(n)), begin


def _power(n: int) -> np.uint64:
    return _U(pow(int(_STEP), n, 1 << 64))


def signed(hashes: np.ndarray) -> pa.Array:
    """As Spark's bigint."""
    return pa.array(hashes.view(np.int64), pa.int64())
