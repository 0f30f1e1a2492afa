"""Word and phrase hashes, vectorised over all words of a batch of texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

_MUL = np.uint64(0x9E3779B97F4A7C15)
_cache: dict[str, int] = {}


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes; a bounded per-worker cache avoids hashing common words again."""
    if len(_cache) > 200_000:
        _cache.clear()
    get = _cache.get
    return np.fromiter((get(w) or _add(w) for w in words), np.uint64, len(words))


def _add(word: str) -> int:
    _cache[word] = h = xxhash.xxh3_64_intdigest(word) or 1
    return h


def seed_bits(seed: int) -> int:
    return (seed * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & (2**64 - 1)


def mix(x: np.ndarray, seed: int | None = 0) -> np.ndarray:
    """64-bit finaliser. ``seed`` None: ``x`` holds the seed's bits already."""
    with np.errstate(over="ignore"):
        if seed is not None:
            x = x ^ np.uint64(seed_bits(seed))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def phrases(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries (order counts); empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = mix(h, seed + 1)
    acc = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            acc = acc * _MUL + h[j:j + n]
    return mix(acc, seed)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def text_key(text: str) -> tuple[int, int]:
    """128 hash bits of a text, as two signed longs."""
    d = xxhash.xxh3_128_digest(text)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))


@dataclass
class Spans:
    """Words of a column of texts as byte ranges: ``starts`` and ``ends`` in ``data``, ``owner`` (row of the column),
    and ``first`` (index of each row's first word, one more at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    first: np.ndarray

    def words(self, lo: int, hi: int) -> bytes:
        """Words ``lo`` to ``hi``, joined by one space."""
        if lo >= hi:
            return b""
        return b" ".join(self.data[self.starts[lo]:self.ends[hi - 1]].tobytes().split())

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)


def word_spans(texts: pa.Array) -> Spans:
    """Words (runs of bytes other than white space) of a string column without nulls, found without decoding it."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset).astype(np.int64) if n else np.zeros(1, np.int64)
    held = texts.buffers()[2] if n else None
    data = np.frombuffer(held, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])) if held is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)  # a text starts here
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= space[:-1]
    after[:-1] |= space[1:]
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    first = np.searchsorted(starts, offsets)
    return Spans(data, starts, ends, np.repeat(np.arange(n), np.diff(first)), first)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A non-zero 64-bit hash of every byte range, eight bytes of all ranges at a time."""
    view = np.ndarray(len(data) + 1, np.dtype("<u8"), np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    left = ends - starts
    h = mix(left.astype(np.uint64), 5)
    long = np.flatnonzero(left > 4096)
    at, rows = starts.copy(), np.flatnonzero(left <= 4096)
    while len(rows):
        chunk, rest = view[at[rows]], left[rows]
        short = np.flatnonzero(rest < 8)
        chunk[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
        h[rows] = mix(h[rows] ^ chunk, 6)
        rows = rows[rest > 8]
        at[rows] += 8
        left[rows] -= 8
    for i in long.tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    h[h == 0] = 1
    return h
