"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Items of a benchmark become windows of ``WINDOW`` consecutive words; an item
with fewer words is one window. For the windows of each length, a shift table
says for every pair of words how far the search may jump: pairs that no
window holds are skipped by almost a window's length. Where the shift is 0,
the pair's bucket, refined by the window's first two words, gives the windows
to compare, and each is compared word by word, so hits are exact.

Benchmark size: items are cut into segments of bounded length that overlap
by a window less a word, and dealt to blocks of about ``BLOCK_BYTES`` of text by a hash. Only one block
is on the driver or in a worker at a time. With one block, a single pass over
the documents marks and counts. With more, each block's pass leaves only the
rows of documents that it hits, and these are united by document at the end.
No document is shuffled for the search; documents never meet each other.

Defined results: null and empty texts have no words; items without words have
no window. A null item id counts as one item, written as an empty text;
repeated items with one id are one item. Equal documents get equal results,
row by row. Very long texts need their words in memory. Empty tables: without documents no
rows, without items no hits. Other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fareway.llm.common import materialize, row_key, small_batches, table, text_or_empty

WINDOW, BLOCK_BYTES, SEGMENT = 10, 4 << 20, 1000

#: Byte classes of words: ASCII letters (lower-cased) and digits, and every byte of a character beyond ASCII.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class WuManber:
    """Search for word windows of one length."""

    def __init__(self, length: int) -> None:
        self.length, self.pair = length, min(2, length)  # words in a block of the shift table
        self.far = length - self.pair + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple[list[bytes], int]]]] = {}

    def add(self, window: list[bytes], number: int) -> None:
        m, p = self.length, self.pair
        for end in range(p, m):
            block = tuple(window[end - p:end])
            if self.shift.get(block, self.far) > m - end:
                self.shift[block] = m - end
        suffix = tuple(window[m - p:])
        self.shift[suffix] = 0
        self.buckets.setdefault(suffix, {}).setdefault(tuple(window[:p]), []).append((window, number))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(first word, number) of every occurrence of a window."""
        m, n, far, shift = self.length, len(words), self.far, self.shift.get
        i = m
        if self.pair == 1:
            while i <= n:
                if not shift((words[i - 1],), far):
                    for _, number in self.buckets[words[i - 1],][words[i - 1],]:
                        yield i - 1, number
                i += 1
            return
        while i <= n:
            block = (words[i - 2], words[i - 1])
            jump = shift(block, far)
            if jump:
                i += jump
                continue
            at = i - m
            for window, number in self.buckets[block].get((words[at], words[at + 1]), ()):
                if words[at:i] == window:
                    yield at, number
            i += 1


class Matcher:
    """Wu-Manber searches over the windows of a block of segments, one search per window length."""

    def __init__(self, segments: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        numbers: dict[tuple[bytes, ...], int] = {}
        self.items: list[list[str]] = []  # ids of the items that hold a window
        self.searches: dict[int, WuManber] = {}
        for item, text in segments:
            words = text.split(b" ")
            m = min(window, len(words))
            for i in range(len(words) - m + 1):
                key = tuple(words[i:i + m])
                number = numbers.get(key)
                if number is None:
                    number = numbers[key] = len(self.items)
                    self.items.append([])
                    self.searches.setdefault(m, WuManber(m)).add(list(key), number)
                if not self.items[number] or self.items[number][-1] != item:
                    self.items[number].append(item)

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint ranges of hit words, and the ids of the items with a window in them."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        for m, search in self.searches.items():
            for at, number in search.search(words):
                found.add(number)
                spans.append((at, at + m))
        return unite(spans), {item for number in found for item in self.items[number]}


def unite(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def _segments(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = SEGMENT - window + 1
        for b in batches:
            item, text = [], []
            for i, t in zip(b["item"].to_pylist(), b["text"].to_pylist(), strict=True):
                words = words_of(t.encode())
                for at in range(0, max(1, len(words) - window + 1) if words else 0, step):
                    item.append(i)
                    text.append(b" ".join(words[at:at + SEGMENT]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(text, pa.string())], ["item", "words"])

    return run


def _report(spans: list[tuple[int, int]], items: set[str], n: int) -> tuple:
    hit = sum(z - a for a, z in spans)
    return n, hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), hit > 0


REPORT = [("n_words", T.LongType(), pa.int64()), ("n_hit", T.LongType(), pa.int64()), ("n_items", T.LongType(), pa.int64()),
          ("items_sha256", T.StringType(), pa.string()), ("contaminated", T.BooleanType(), pa.bool_())]
_SPANS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",),
                  text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` plus ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``spans`` (ranges of hit
    words) and ``items`` (ids as texts, sorted)."""
    raw = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                           text_or_empty(item_text).alias("text")).filter(F.length("text") > 0)
    parts = materialize(spark, raw.mapInArrow(_segments(window), "item string, words string"), "items")
    total = parts.agg(F.sum(F.octet_length("words") + F.octet_length("item") + 50)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    parts = parts.withColumn("_b", F.pmod(F.xxhash64("words", "item"), F.lit(blocks)))

    def load(block: int):
        got = parts.filter(F.col("_b") == block).select("item", "words").toArrow()  # about block_bytes of text
        segments = list(zip(got["item"].to_pylist(), [w.encode() for w in got["words"].to_pylist()], strict=True))
        return spark.sparkContext.broadcast(sorted(segments))

    def scan(shared, finish: bool):
        matcher = None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal matcher
            matcher = matcher or Matcher(shared.value, window)
            for b in batches:
                reports, spans, items, hit = [], [], [], []
                for row, cell in enumerate(b["_text"]):
                    words = words_of(bytes(cell.as_buffer()))
                    found, ids = matcher.find(words)
                    if finish or found:
                        hit.append(row)
                        reports.append(_report(found, ids, len(words)))
                        spans.append([{"lo": a, "hi": z} for a, z in found])
                        items.append(sorted(ids))
                ends = [pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
                if finish:
                    ends = [*[pa.array([r[i] for r in reports], t) for i, (_, _, t) in enumerate(REPORT)], *ends]
                names = [c for c in b.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays([*[b[c].take(pa.array(hit, pa.int64())) for c in names], *ends], [
                    *names, *[c for c, _, _ in REPORT] * finish, "spans", "items"])

        return run

    span_type = T.ArrayType(T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]))
    ends = [T.StructField("spans", span_type), T.StructField("items", T.ArrayType(T.StringType()))]
    full = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, t) for c, t, _ in REPORT] + ends)
    if blocks == 1:
        return docs.select(*keep, text_or_empty(text).alias("_text")).mapInArrow(scan(load(0), True), full)
    k1, k2 = row_key(text)  # equal texts have equal hits
    keyed = docs.select(*keep, text_or_empty(text).alias("_text"), k1.alias("_k1"), k2.alias("_k2"))
    hits = None
    for block in range(blocks):
        shared = load(block)
        some = materialize(spark, keyed.select("_k1", "_k2", "_text").mapInArrow(
            scan(shared, False), T.StructType([keyed.schema["_k1"], keyed.schema["_k2"], *ends])), "block-hits")
        shared.destroy()
        hits = some if hits is None else hits.union(some)
    found = hits.dropDuplicates(["_k1", "_k2", "spans", "items"]).groupBy("_k1", "_k2").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [unite([(s["lo"], s["hi"]) for s in row or ()]) for row in b["spans"].to_pylist()]
            items = [set(row or ()) for row in b["items"].to_pylist()]
            reports = [_report(s, i, n) for s, i, n in zip(spans, items, b["n"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                *[b[c] for c in keep], *[pa.array([r[i] for r in reports], t) for i, (_, _, t) in enumerate(REPORT)],
                pa.array([[{"lo": a, "hi": z} for a, z in s] for s in spans], _SPANS),
                pa.array([sorted(i) for i in items], pa.list_(pa.string()))], full.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.array([len(words_of(bytes(cell.as_buffer()))) for cell in b["_text"]], np.int64)
            yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], b["_k1"], b["_k2"], pa.array(n)], [*keep, "_k1", "_k2", "n"])

    counted = keyed.mapInArrow(count, T.StructType([
        *[docs.schema[c] for c in keep], keyed.schema["_k1"], keyed.schema["_k2"], T.StructField("n", T.LongType())]))
    return counted.join(found, ["_k1", "_k2"], "left").select(*keep, "n", "spans", "items").mapInArrow(finish, full)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("spans", "items")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS phrase
      FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0)),
s AS (SELECT r, m, k, array_to_string(w[k:k + m - 1], ' ') AS phrase
      FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM p))),
h AS (SELECT r, s.m, k, item FROM s JOIN p USING (m, phrase)),
g AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(k, k + m)) AS x FROM (SELECT DISTINCT r, m, k FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN g USING (r) LEFT JOIN t USING (r)
"""
