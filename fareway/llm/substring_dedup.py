"""Exact removal of repeated passages by sharded repeated-phrase automata.

A window is ``WINDOW`` consecutive words. A word goes if a window over it has
a word sequence that also starts anywhere else, in any document.

1. Every window is named by its anchor: the phrase of ``PHRASE`` words with
   the smallest hash in it. Equal windows have equal anchors, and about one
   word in fifteen is an anchor. Windows whose anchor phrase occurs once are
   unique and go no further (one count per phrase, combined map-side).
2. The other windows form segments (consecutive windows of one anchor). Equal
   segments are merged first, so a passage in thousands of copies is one row
   with a count from here on.
3. Confirm: the windows of distinct segments are counted, weighted by the
   segment's copies. Those counted twice or more recur; one place of each is
   kept as its example.
4. Automata: recurring windows are patterns of Aho-Corasick automata, sharded
   by anchor. Words are read in blocks (``BLOCK`` words have one short code, one
   stream per phase), so a pattern has ``WINDOW / BLOCK`` codes. All distinct
   segments stream through the automaton of their shard, a batch at a time;
   every match marks the words of its window.
5. Marks go to all copies of a segment and are united per document.

Hot phrases: counts are combined before shuffles; joins on phrase or segment
are plain equi-joins over written tables, which adaptive execution splits; a
shard with many segments is dealt to several tasks, each with the automaton.

Words are byte ranges found and hashed with vector operations; texts are
never decoded before they are cut. Phrases, windows and blocks are equal if their
64- to 320-bit hashes are.

Defined results: null and empty texts and texts below ``WINDOW`` words lose
nothing. Two rows equal in id and text are two places, so both lose all
words if they have 35 or more. Of phrases with equal hashes in a window the leftmost is its anchor. A
very long text is one row; its segments are rows of their own. Empty tables give empty results. Extra columns of
any name pass through the stage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fareway.llm.common import (
    discard, materialize, packed, row_key, small_batches, table, text_or_empty, unpacked,
)
from fareway.llm.hashing import Spans, phrases, signed, text_key, word_spans

WINDOW, PHRASE, BLOCK = 35, 8, 7
UNKNOWN = " "  # the character of a block that no pattern has


def anchors(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per segment: first word, number of windows, anchor hash. ``h``, ``owner``: hash and text of every word."""
    n = len(h) - WINDOW + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty, empty.view(np.uint64)
    p = phrases(h, PHRASE)
    span = WINDOW - PHRASE + 1
    at = np.empty(n, np.int64)
    low = np.uint64((1 << 17) - 1)
    for i in range(0, n, 100_000):
        # The smallest phrase of each window; low bits give its place, so the leftmost of equal ones wins.
        part = p[i:i + 100_000 + span - 1][:n - i + span - 1]
        key = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while 2 * width <= span:  # minima of spans of twice the width
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < span:
            key = np.minimum(key[:len(key) - (span - width)], key[span - width:])
        at[i:i + len(key)] = (key & low).astype(np.int64) + i
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1:])  # windows within one text
    if not len(inside):
        return empty, empty, empty.view(np.uint64)
    a = at[inside]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (inside[1:] != inside[:-1] + 1)]))
    return inside[new], np.diff(np.append(new, len(inside))), p[a[new]]


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        w = word_spans(b["text"])
        start, count, a = anchors(w.hashes(), w.owner)
        owner = w.owner[start]
        o = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(a)), b["r1"].take(o), b["r2"].take(o), pa.array((start - w.first[owner]).astype(np.int32)),
             pa.array(count.astype(np.int32))], ["a", "r1", "r2", "start", "n"])


def _emit_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        w = word_spans(b["text"])
        runs = b["runs"]
        size = np.diff(runs.offsets.to_numpy())
        owner = np.repeat(np.arange(len(size)), size)
        flat = runs.flatten()
        start, count = flat.field("start").to_numpy(), flat.field("n").to_numpy()
        lo = w.first[owner] + start
        segments = [w.words(i, j) for i, j in zip(lo.tolist(), (lo + count + WINDOW - 1).tolist(), strict=True)]
        keys = [text_key(s) for s in segments]
        o = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [b["r1"].take(o), b["r2"].take(o), pa.array(start, pa.int32()), flat.field("a"), pa.array([k[0] for k in keys], pa.int64()),
             pa.array([k[1] for k in keys], pa.int64()), pa.array(segments, pa.binary()).cast(pa.string())],
            ["r1", "r2", "start", "a", "s1", "s2", "words"])


def _emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of every window of each segment, with the segment's copies and the window's place."""
    for b in batches:
        w = word_spans(b["words"])
        h = w.hashes()
        w1, w2 = phrases(h, WINDOW, 3), phrases(h, WINDOW, 4)
        start = np.flatnonzero(w.owner[:len(w1)] == w.owner[WINDOW - 1:])
        o = pa.array(w.owner[start])
        pos = start - w.first[w.owner[start]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(w1[start])), pa.array(signed(w2[start])), b["copies"].take(o), b["s1"].take(o), b["s2"].take(o),
             pa.array(pos.astype(np.int32))], ["w1", "w2", "copies", "s1", "s2", "pos"])


class PhraseAutomaton:
    """Aho-Corasick over windows as sequences of word blocks.

    A block is known by the hash of its words; its number is written with as many characters of a small alphabet as the
    shard's blocks need, as the automaton looks through a node's edges one by one: a node must not have an edge per block.
    """

    def __init__(self) -> None:
        self.blocks = np.zeros(0, np.uint64)
        self.width = 1  # characters per block
        self.codes = np.zeros((1, 1), np.uint8)
        self.patterns: list[np.ndarray] = []  # block hashes of windows, one row each
        self.machine: ahocorasick.Automaton | None = None

    def add(self, rows: np.ndarray) -> None:
        self.patterns.append(rows)

    def _build(self) -> None:
        rows = np.concatenate(self.patterns)
        self.blocks, number = np.unique(rows, return_inverse=True)
        n = np.arange(len(self.blocks) + 1)
        while 64**self.width < len(n):
            self.width += 1
        self.codes = np.stack([48 + n // 64**i % 64 for i in range(self.width)], 1).astype(np.uint8)
        self.codes[-1] = ord(UNKNOWN)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        size = self.width * (WINDOW // BLOCK)
        text = self.codes[number.reshape(rows.shape)].tobytes().decode("ascii")
        add = self.machine.add_word
        for i in range(0, len(text), size):
            add(text[i:i + size])
        self.machine.make_automaton()

    def locate(self, blocks: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """First words of all occurrences of patterns. ``blocks``: hash of the block from each word on; ``inside``:
        whether the block lies within one segment."""
        if not self.patterns:
            return np.zeros(0, np.int64)
        if self.machine is None:
            self._build()
        at = np.searchsorted(self.blocks, blocks)
        at[at == len(self.blocks)] = 0
        at[(self.blocks[at] != blocks) | ~inside] = len(self.blocks)
        found = []
        for phase in range(min(BLOCK, len(at))):
            stream = at[phase::BLOCK]
            text = self.codes[stream].tobytes().decode("ascii")
            ends = np.array([end for end, _ in self.machine.iter(text)], np.int64) + 1
            ends = ends[ends % self.width == 0]
            found.append(phase + (ends // self.width) * BLOCK - WINDOW)
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def unite(starts: np.ndarray, owner: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Union of [s, s + width) per owner: owner, low and high end of disjoint intervals. ``starts`` rise."""
    if not len(starts):
        return starts, starts, starts
    new = np.flatnonzero(np.concatenate([[True], (np.diff(starts) > width) | (owner[1:] != owner[:-1])]))
    last = np.append(new[1:], len(starts)) - 1
    return owner[new], starts[new], starts[last] + width


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, salt, kind): a shard's patterns build its automaton, its segments stream through."""
    at, machine = None, PhraseAutomaton()
    for b in batches:
        shard, salt, kind = (b[c].to_numpy() for c in ("shard", "salt", "kind"))
        change = np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)) + 1
        edges = [0, *change.tolist(), len(shard)]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            if x == y:
                continue
            if at != (shard[x], salt[x]):
                at, machine = (shard[x], salt[x]), PhraseAutomaton()
            w = word_spans(b["words"].slice(x, y - x))
            blocks = phrases(w.hashes(), BLOCK, 5)
            if kind[x] == 0:
                places = b["places"].slice(x, y - x)
                owner = np.repeat(np.arange(y - x), np.diff(places.offsets.to_numpy()))
                first = w.first[owner] + places.flatten().to_numpy()
                machine.add(blocks[first[:, None] + np.arange(0, WINDOW, BLOCK)])
                continue
            starts = machine.locate(blocks, w.owner[:len(blocks)] == w.owner[BLOCK - 1:])
            starts = starts[w.owner[starts] == w.owner[starts + WINDOW - 1]]  # not from one segment into the next
            owner, lo, hi = unite(starts, w.owner[starts])
            o, before = pa.array(owner + x), w.first[owner]
            yield pa.RecordBatch.from_arrays([b["s1"].take(o), b["s2"].take(o), pa.array((lo - before).astype(np.int32)),
                                              pa.array((hi - before).astype(np.int32))], ["s1", "s2", "lo", "hi"])


def cut(w: Spans, row: int, marked: list[tuple[int, int]]) -> tuple[bytes, bytes, int, int]:
    """A text without the marked words (the rest as it stands), its words joined by spaces, word counts: all, removed.
    ``marked``: rising, disjoint ranges of words."""
    first, n = int(w.first[row]), int(w.first[row + 1] - w.first[row])
    edges = [0, *[x for span in marked for x in span], n]
    runs = [(first + a, first + z) for a, z in zip(edges[::2], edges[1::2], strict=True) if a < z]
    rest = b" ".join([w.data[w.starts[a]:w.ends[z - 1]].tobytes() for a, z in runs])
    return rest, b" ".join(rest.split()), n, n - sum(z - a for a, z in runs)


def _finish(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = word_spans(b["text"])
            marks = b["marked"]
            new, n, removed = [], [], []
            for row in range(len(marks)):
                marked = united([(m["lo"], m["hi"]) for m in marks[row].as_py() or ()])
                rest, kept, total, gone = cut(w, row, marked)
                n.append(total)
                removed.append(gone)
                new.append(hashlib.sha256(kept).hexdigest() if digest else rest.decode() if gone else None)
            yield pa.RecordBatch.from_arrays([b[0], pa.array(new, pa.string()), pa.array(n, pa.int64()), pa.array(
                removed, pa.int64())], [b.schema.names[0], "new", "n_words", "n_removed"])

    return run


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Rising ranges without overlap that cover the same words. ``spans`` rise."""
    out: list[tuple[int, int]] = []
    for a, z in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def repeated_places(spark: SparkSession, docs: DataFrame, shard_windows: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """``docs`` (r1, r2, text, ...) written with the ``runs`` of windows that may recur, and (r1, r2, marked) for rows that lose words."""
    a = materialize(spark, docs.select("r1", "r2", "text").mapInArrow(
        _emit_anchors, "a long, r1 long, r2 long, start int, n int"), "sub-anchors")
    recurring = materialize(spark, a.groupBy("a").agg(F.count("*").alias("c")).filter(
        "c > 1").select("a"), "sub-recurring")
    # Rows equal in id and text share a key, so their runs come several times: a set drops them before the shuffle.
    runs = a.join(recurring, "a", "left_semi").groupBy("r1", "r2").agg(F.collect_set(F.struct("start", "n", "a")).alias("runs"))
    held = materialize(spark, docs.join(runs, ["r1", "r2"], "left"), "sub-docs")
    discard(spark, a, recurring)
    seg = materialize(spark, held.filter("runs is not null").select("r1", "r2", "text", "runs").mapInArrow(
        _emit_segments, "r1 long, r2 long, start int, a long, s1 long, s2 long, words string"), "sub-segments")
    distinct = materialize(spark, seg.groupBy("s1", "s2", "a").agg(F.count("*").alias("copies"), F.first("words").alias(
        "words")), "sub-distinct")
    w = distinct.select("s1", "s2", "copies", "words").mapInArrow(
        _emit_windows, "w1 long, w2 long, copies long, s1 long, s2 long, pos int")
    # One example place per recurring window, whichever comes first: all show the same words, and the table written
    # fixes the choice. A segment's copies alone can make its windows recur.
    confirmed = materialize(spark, w.groupBy("w1", "w2").agg(F.sum("copies").alias("c"), *[
        F.first(c).alias(c) for c in ("s1", "s2", "pos")]).filter("c > 1").select("s1", "s2", "pos"), "sub-confirmed")
    shards = max(1, -(-confirmed.count() // shard_windows))
    shard = F.pmod(F.xxhash64("a"), F.lit(shards)).alias("shard")
    places = confirmed.groupBy("s1", "s2").agg(F.sort_array(F.collect_list("pos")).alias("places"))
    texts = distinct.select("s1", "s2", "words", shard)
    # A shard with over twice the mean number of segments is dealt to several tasks, each with its automaton.
    mean = max(1000, 2 * distinct.count() // shards)
    size = materialize(spark, texts.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(mean)).cast("int").alias("salts")), "sub-shards")
    patterns = texts.join(places, ["s1", "s2"]).join(size, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), "s1", "s2", "words",
        "places")
    stream = texts.join(size, "shard").select(
        "shard", F.pmod(F.xxhash64("s1", "s2"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind"), "s1", "s2",
        "words", F.lit(None).cast("array<int>").alias("places"))
    dealt = patterns.union(stream).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    marks = materialize(spark, dealt.mapInArrow(_locate, "s1 long, s2 long, lo int, hi int"), "sub-marks")
    discard(spark, distinct, confirmed, size)
    hits = seg.select("s1", "s2", "r1", "r2", "start").join(marks, ["s1", "s2"]).select(
        "r1", "r2", F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi")).alias("m"))
    marked = hits.groupBy("r1", "r2").agg(F.sort_array(F.collect_set("m")).alias("marked"))
    return held, marked


def dedup(spark: SparkSession, docs: DataFrame, keep: str, digest: bool = False) -> DataFrame:
    """Column ``keep`` of ``docs`` (with ``doc_id`` and ``text``), ``new`` (the rest of the text where words go, else null;
    with ``digest`` the hash of its words), ``n_words`` and ``n_removed``."""
    small_batches(spark)
    r1, r2 = row_key("doc_id", "text")
    docs = docs.withColumn("text", text_or_empty()).withColumns({"r1": r1, "r2": r2})
    held, marked = repeated_places(spark, docs)
    rest = held.filter("runs is null").withColumn("marked", F.lit(None).cast("array<struct<lo:int,hi:int>>"))
    lost = held.filter("runs is not null").join(marked, ["r1", "r2"], "left")
    both = rest.select(keep, "text", "marked").union(lost.select(keep, "text", "marked"))
    schema = T.StructType([docs.schema[keep], T.StructField("new", T.StringType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType())])
    return both.mapInArrow(_finish(digest), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(spark, docs, "doc_id", digest=True).withColumnRenamed("new", "kept_sha256")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline form: texts without their repeated words. Every document stays, even with an empty text."""
    out = dedup(spark, packed(docs, "doc_id", "text"), "_doc")
    changed = F.col("n_removed") > 0
    return unpacked(out, text=F.when(changed, F.col("new")).otherwise(F.col("_doc.text")),
                    n_chars=F.when(changed, F.length("new")).otherwise(F.col("_doc.n_chars")).cast("long"))
