"""Byte-level BPE as a streaming transducer with bounded lookahead, and an incremental decoder.

A token sequence is the BPE encoding of its bytes exactly if every adjacent
pair of tokens is the encoding of its own concatenation. So every prefix of
the input has one possible last token, and encoding is a left-to-right pass:
at each byte, the token that ends there and is compatible with the last token
of what precedes it. ``Merges.lookahead`` is how many bytes beyond a token can
still change it: the longest chain of merges in which each competes for the
right part of the one before it and has a smaller rank. It is computed in one
pass over the merges. A token is stable once that many bytes behind it are
read; it is emitted then, so a piece of any length needs a window of bytes only.

Texts are cut at added tokens, then by the byte-level split pattern, ``CHUNK`` characters at a time; ids are
hashed, counted and decoded chunk by chunk. Short
pieces are looked up in a bounded cache; up to 64 characters fit the window and are read in one go.

Defined results: a null text counts as empty: no tokens, and the hash of an
empty text. Very long texts and pieces stream through. Equal rows give equal
results; empty tables give empty results; extra columns are ignored by
``encode_documents`` except for those named in ``keep``.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, types as T

from fareway.llm.common import small_batches, table

CHUNK = 100_000  # characters encoded at a time

# Fixed value: the byte-level split pattern of the public vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same pattern in the standard library's faster classes; equal on texts without a character of ``_odd()`` or above U+FFFF.
FAST = r"""'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""


@lru_cache(1)
def _odd() -> re.Pattern:
    """Characters below U+10000 that the two patterns classify differently."""
    wide = [(regex.compile(r"\p{L}"), re.compile(r"[^\W\d_]")), (regex.compile(r"\p{N}"), re.compile(r"\d")),
            (regex.compile(r"\s"), re.compile(r"\s"))]
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    odd: set[str] = set()
    for a, b in wide:
        odd |= set(a.findall(every)) ^ set(b.findall(every))
    ranges, codes = [], sorted(map(ord, odd))
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return re.compile("[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges) + "]")


_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Vocabulary and merge list of a byte-level BPE file, with what the transducer needs."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        model = spec["model"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.ids = {as_bytes(s): i for s, i in model["vocab"].items() if s not in self.added}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(as_bytes(a), as_bytes(b)): r for r, (a, b) in enumerate(pairs)}
        self.max_token = max(map(len, self.ids))
        self.lookahead = self._sufficient_lookahead()
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.added.items()}
        made = {a + b: (a, b, r) for (a, b), r in reversed(self.ranks.items())}  # how each token forms: by its first merge
        self._made = made
        self._automaton({b: i for b, i in self.ids.items() if self.merge(b) == [b]})
        self._spines: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}
        self._pair: dict[int, bool] = {}

    def _sufficient_lookahead(self) -> int:
        chain_of: dict[bytes, int] = {}  # bytes that merges starting with this token, so far, can look beyond it
        token: dict[bytes, int] = {}  # bytes beyond a token that decide whether it forms
        for (u, v), _ in sorted(self.ranks.items(), key=lambda x: x[1]):
            own = max(chain_of.get(v, 0), token.get(v, 0))
            token[u + v] = max(token.get(u + v, 0), own)
            chain_of[u] = max(chain_of.get(u, 0), len(v) + own)
        return max(token.values(), default=0)

    def _automaton(self, tokens: dict[bytes, int]) -> None:
        """Trie of the tokens with suffix links: ``out[node]`` has (length, id) of every token that ends there."""
        self.next: dict[int, int] = {}  # node << 8 | byte
        self.out: list[tuple[tuple[int, int], ...]] = [()]
        self.link = [0]
        for token, i in tokens.items():
            node = 0
            for c in token:
                key = node << 8 | c
                node = self.next.get(key, 0)
                if not node:
                    node = self.next[key] = len(self.out)
                    self.out.append(())
                    self.link.append(0)
            self.out[node] = ((len(token), i),)
        edges = sorted(self.next.items(), key=lambda e: e[1])
        depth = [0] * len(self.out)
        for key, node in edges:
            depth[node] = depth[key >> 8] + 1
        for key, node in sorted(edges, key=lambda e: depth[e[1]]):
            parent, c = key >> 8, key & 255
            if parent:
                self.link[node] = self.step(self.link[parent], c)
            self.out[node] += self.out[self.link[node]]

    def step(self, node: int, c: int) -> int:
        """The longest suffix, after byte ``c``, that starts a token; found once and kept as an edge, if there is room."""
        key = node << 8 | c
        to = self.next.get(key)
        if to is None:
            if not node:
                return 0
            to = self.step(self.link[node], c)
            if to and len(self.next) < 400_000:
                self.next[key] = to
        return to

    def merge(self, piece: bytes) -> list[bytes]:
        """Encoding of a few bytes by the rule itself: the lowest-ranked, leftmost pair first."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        get, none = self.ranks.get, 1 << 60
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
        return parts

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """Symbols at the right (1) or left (0) edge of a token while it forms, with the ranks between which each lasts."""
        out = self._spines.get((token, side))
        if out is None:
            symbol, used = self.bytes_of[token], 1 << 40
            out = []
            while symbol in self._made:
                rank = self._made[symbol][2]
                out.append((symbol, rank, used))
                symbol, used = self._made[symbol][side], rank
            out.append((symbol, -1, used))
            self._spines[token, side] = out
        return out

    def follows(self, a: int, b: int) -> bool:
        """Whether token ``b`` can come right after ``a`` in an encoding.

        It cannot if, while both form, two edge symbols that exist at the same time merge across the boundary
        first. Of equal ranks, the leftmost merge goes first.
        """
        if len(self._pair) > 400_000:
            self._pair.clear()  # bounded: it is found again when needed
        ranks, ok = self.ranks, True
        for x, x_from, x_to in self._spine(a, 1):
            for y, y_from, y_to in self._spine(b, 0):
                if x_from <= y_to and y_from < x_to and (r := ranks.get((x, y))) is not None and r < x_to and r <= y_to:
                    ok = False
        self._pair[a << 32 | b] = ok
        return ok

    def last_tokens(self, text: bytes, last: list[int], start: int = 0, before: int = -1, node: int = 0) -> int:
        """Append to ``last`` the last token of every prefix of ``text`` longer than ``start`` (-1: none).

        ``before`` is the token in front of ``text`` (-1: none), ``node`` the automaton's state at ``start``;
        its state at the end is returned.
        """
        go, step, out, known, follows = self.next.get, self.step, self.out, self._pair.get, self.follows
        for i in range(start, len(text)):
            c = text[i]
            node = go(node << 8 | c) or step(node, c)
            found = -1
            for n, t in out[node]:
                j = i - n
                if j >= 0:
                    prev = last[j]
                    if prev < 0:
                        continue
                elif j < -1:
                    continue
                elif before < 0:
                    found = t
                    break
                else:
                    prev = before
                ok = known(prev << 32 | t)
                if ok or ok is None and follows(prev, t):
                    found = t
                    break
            last.append(found)
        return node


class Transducer:
    """Encodes one piece fed in parts; ``feed`` and ``close`` yield token ids as they become stable."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.buffer = b""  # bytes from the last stable boundary on
        self.last: list[int] = []  # last token of each prefix of the buffer, -1 for none
        self.before = -1  # the last token emitted
        self.node = 0  # state of the automaton
        self.hold = max(merges.lookahead, merges.max_token)

    def _emit(self, stop: int) -> Iterator[int]:
        """Tokens of the whole buffer's encoding that end at ``stop`` or before."""
        ends, i = [], len(self.buffer)
        while i > 0:
            if i <= stop:
                ends.append(i)
            i -= len(self.merges.bytes_of[self.last[i - 1]])
        for i in reversed(ends):
            self.before = self.last[i - 1]
            yield self.before
        if ends:
            self.buffer, self.last = self.buffer[ends[0]:], self.last[ends[0]:]

    def feed(self, data: bytes) -> Iterator[int]:
        step = 4 * self.hold
        for at in range(0, len(data), step):
            start, self.buffer = len(self.buffer), self.buffer + data[at:at + step]
            self.node = self.merges.last_tokens(self.buffer, self.last, start, self.before, self.node)
            if len(self.buffer) > 2 * self.hold:
                yield from self._emit(len(self.buffer) - self.merges.lookahead)

    def close(self) -> Iterator[int]:
        yield from self._emit(len(self.buffer))


class Encoder:
    """Text to ids. ``cache`` bounds how many short pieces each of two generations remembers."""

    def __init__(self, merges: Merges, cache: int = 200_000, longest_cached: int = 64) -> None:
        self.merges, self.size, self.longest = merges, cache, longest_cached
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.fast, self.exact = re.compile(FAST), regex.compile(PATTERN)
        self.special = re.compile("|".join(map(re.escape, sorted(merges.added, key=len, reverse=True)))) if merges.added else None

    def _piece(self, piece: str) -> tuple[int, ...]:
        known = self.older.get(piece)
        if known is not None:
            return self._remember(piece, known)
        data, merges = piece.encode(), self.merges
        if len(piece) > self.longest:
            t = Transducer(merges)
            return (*t.feed(data), *t.close())
        last: list[int] = []
        merges.last_tokens(data, last)
        ids, i = (), len(data)
        while i > 0:
            ids = (last[i - 1], *ids)
            i -= len(merges.bytes_of[last[i - 1]])
        return self._remember(piece, ids)

    def _remember(self, piece: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        """Two generations: when the younger one is full it becomes the older one, and what is asked for again moves up."""
        if len(self.cache) >= self.size:
            self.older, self.cache = self.cache, {}
        self.cache[piece] = ids
        return ids

    def _plain(self, text: str) -> Iterable[int]:
        split = (self.exact if _odd().search(text) or _ASTRAL.search(text) else self.fast).findall
        miss, out, pieces = self._piece, [], split(text)
        for at in range(0, len(pieces), 20_000):  # the younger generation may change in between
            get = self.cache.get
            out.append([get(p) or miss(p) for p in pieces[at:at + 20_000]])
        return chain.from_iterable(chain.from_iterable(out))

    def encode(self, text: str) -> list[int]:
        if self.special is None or not self.special.search(text):
            return list(self._plain(text))
        out: list[int] = []
        at = 0
        for m in self.special.finditer(text):
            out += self._plain(text[at:m.start()])
            out.append(self.merges.added[m[0]])
            at = m.end()
        return out + list(self._plain(text[at:]))

    def _safe(self, text: str, start: int) -> int:
        """A place from ``start`` on, but before the end, where a text can be cut whatever follows: in front of a single
        space between two other characters, outside of added tokens. 0 if there is none yet."""
        stop = len(text) - max([2, *map(len, self.merges.added)])
        added = [m.span() for m in self.special.finditer(text)] if self.special else []
        at = text.rfind(" ", start, stop)
        while at > start:
            if not text[at - 1].isspace() and not text[at + 1].isspace() and not any(a < at < z for a, z in added):
                return at
            at = text.rfind(" ", start, at)
        return 0

    def encode_stream(self, chunks: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a text that arrives in chunks. What is held back is the end of a chunk from its last safe place on."""
        chunks = iter(chunks)
        rest, seen = next(chunks, ""), 0
        for chunk in chunks:
            at = self._safe(rest, seen)
            if at:
                yield self.encode(rest[:at])
                rest, seen = rest[at:], 0
            else:
                seen = max(0, len(rest) - 1000)  # no place before; look on from here
            rest += chunk
        yield self.encode(rest)


class Decoder:
    """Ids to text, incrementally: bytes of a character that is not complete yet wait for the next ids."""

    def __init__(self, merges: Merges) -> None:
        self.bytes_of = merges.bytes_of.__getitem__
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of, ids)))

    def close(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One per Python worker: vocabulary and cache outlive a batch."""
    return Encoder(Merges(path))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                     digest: bool = False) -> DataFrame:
    """``keep`` plus ``n_tokens``, and ``ids`` or, with ``digest``, the hashes of ids and of the decoded text.

    ``path``: a byte-level BPE file that every executor can open; by default the installed public one.
    """
    fields = [docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType())]
    if digest:
        fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    else:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path or vocabulary())
        for b in batches:
            n, first, second = [], [], []
            for t in b["_bpe_text"]:
                text = t.as_py() or ""
                parts = enc.encode_stream(text[i:i + CHUNK] for i in range(0, max(1, len(text)), CHUNK))
                if not digest:
                    first.append([i for ids in parts for i in ids])
                    n.append(len(first[-1]))
                    continue
                dec, decoded, listed, total = Decoder(enc.merges), hashlib.sha256(), hashlib.sha256(), 0
                for ids in parts:
                    if ids:
                        listed.update((("," if total else "") + str(ids)[1:-1].replace(" ", "")).encode())
                        decoded.update(dec.feed(ids).encode())
                        total += len(ids)
                decoded.update(dec.close().encode())
                n.append(total)
                first.append(listed.hexdigest())
                second.append(decoded.hexdigest())
            cols = [b[c] for c in range(len(keep))] + [pa.array(n, pa.int64())]
            names = [*keep, "n_tokens"]
            if digest:
                yield pa.RecordBatch.from_arrays([*cols, pa.array(first, pa.string()), pa.array(second, pa.string())],
                                                 [*names, "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([*cols, pa.array(first, pa.list_(pa.int32()))], [*names, "ids"])

    return docs.select(*keep, docs[text].cast("string").alias("_bpe_text")).mapInArrow(run, T.StructType(fields))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return encode_documents(table(spark, sf_dir, "documents"), digest=True)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline form: token ids per document, with its id, language and source."""
    small_batches(spark)
    return encode_documents(docs, keep=("doc_id", "lang", "source"))
