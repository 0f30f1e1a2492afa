"""Near-duplicate classes by Order MinHash, verified by banded alignment.

Words are lower-cased runs of letters and digits. Shingles are ``K`` words and
carry their occurrence number, so repeats within a text differ. A sketch takes
the ``L`` shingles with the smallest hashes under one seed and keeps them in
text order; two texts agree in a sketch only if they share these shingles in
the same order. ``SKETCHES`` sketches per text are the search keys: at
similarity s a key agrees with probability of about s ** L, so at 0.8 one of
24 does with probability above 0.999.

1. Texts with equal words (128 hash bits) are one node (map-side combined).
2. Texts with an equal key form a bucket. A member's popularity is the sum of
   its buckets' sizes; each bucket's centre is its most popular member, which
   in a group of copies is close to the original. Members are compared with
   centres only, never with each other. Members that are not linked to the
   centre meet again, with a centre of their own, for ``ROUNDS`` rounds.
   Members of buckets that then still span several classes, linked or not,
   are joined exactly (``exact_links``): a pair with an equal key is either in
   one class already or compared. Texts of up to ``SHORT`` shingles, for which
   keys of five shingles are too coarse, are joined exactly with all texts that
   can reach 0.8 with them, whatever their keys.
3. Each distinct pair is verified: shingles of both texts are aligned in
   order. As shingles are unique by their occurrence number, the longest
   common subsequence is a longest increasing subsequence of positions; pairs
   of places further apart than the allowed number of gaps are outside the
   band. The similarity is aligned / (all shingles of both - aligned).
4. Links of 0.8 or more join texts into classes by label propagation over
   written tables with pointer jumping.

Hot buckets and hot centres are plain equi-joins over written tables, split
by adaptive execution; counts and centres are combined before shuffles.

Defined results: null, empty and wordless texts are classes of their own. A
text of fewer than ``K`` words is one shingle. The class id is the smallest
doc_id of the class (null ids last); rows equal in id and text are in one
class. Ties are broken by id, then by hash. Empty tables give empty results. A very long text is one row of the shingle
table. Other columns, whatever their names, are left alone (the stage passes them through).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fareway.llm.common import materialize, packed, row_key, small_batches, table, text_or_empty, unpacked, words_of
from fareway.llm.hashing import mix, phrases, seed_bits, signed, text_key, word_hashes

K, L, SKETCHES, ROUNDS, THRESHOLD, SHORT = 5, 5, 24, 3, 0.8, 15
_normal = re.compile(r"[^\W_]+").findall


def normal_words(text: str) -> list[str]:
    """Lower-cased runs of letters and digits; the plain words of a text that has none."""
    return _normal(text.lower()) or words_of(text)


def labelled_shingles(words: list[str]) -> np.ndarray:
    """One hash per shingle and occurrence: the second equal shingle of a text is another one."""
    if not words:
        return np.zeros(0, np.uint64)
    s = phrases(word_hashes(words), min(K, len(words)))
    order = np.argsort(s, kind="stable")
    same = np.concatenate([[False], s[order][1:] == s[order][:-1]])
    if same.any():
        idx = np.arange(len(s))
        run = np.maximum.accumulate(np.where(same, 0, idx))
        occurrence = np.zeros(len(s), np.uint64)
        occurrence[order] = (idx - run).astype(np.uint64)
        s = np.where(occurrence > 0, mix(s ^ mix(occurrence, 17), 18), s)
    return s


def sketches(s: np.ndarray, n: int = SKETCHES, size: int = L) -> np.ndarray:
    """Per seed: a hash of the ``size`` smallest shingles in text order."""
    take = min(size, len(s))
    at = np.empty((n, take), np.int64)
    step = max(1, 16_384 // len(s))  # seeds at a time
    for i in range(0, n, step):
        own = mix(s ^ np.array([[seed_bits(100 + j)] for j in range(i, min(i + step, n))], np.uint64), None)
        at[i:i + step] = np.argpartition(own, take - 1, axis=1)[:, :take]
    acc = np.full(n, take, np.uint64)
    with np.errstate(over="ignore"):
        for v in s[np.sort(at, axis=1)].T:
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + v
    return mix(acc, 5)


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """aligned / (|a| + |b| - aligned), or 0 where it cannot reach ``threshold``."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < threshold * max(n, m):
        return 0.0
    need = threshold * (n + m) / (1 + threshold)  # aligned shingles needed
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = n + m - 2 * need + 1e-9  # shingles that may be left unaligned on both sides
    inside = np.abs(i - j) <= band
    if inside.sum() < need - 1e-9:
        return 0.0
    order = np.argsort(i[inside], kind="stable")
    path = j[inside][order]
    if (np.diff(path) > 0).all():
        aligned = len(path)
    else:
        tails: list[int] = []
        for v in path.tolist():
            at = bisect_left(tails, v)
            if at == len(tails):
                tails.append(v)
            else:
                tails[at] = v
        aligned = len(tails)
    return aligned / (n + m - aligned)


def _emit_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        k1, k2, n, sk = [], [], [], []
        for text in b["text"].to_pylist():
            words = normal_words(text)
            if not words:
                k1.append(None)
                k2.append(None)
                n.append(None)
                sk.append(None)
                continue
            x, y = text_key(" ".join(words))
            k1.append(x)
            k2.append(y)
            s = labelled_shingles(words)
            n.append(len(s))
            sk.append(signed(sketches(s)).tolist())
        yield pa.RecordBatch.from_arrays([b["doc_id"], b["r1"], b["r2"], pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(
            n, pa.int32()), pa.array(sk, pa.list_(pa.int64()))], ["doc_id", "r1", "r2", "k1", "k2", "n", "sk"])


def _emit_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        s = [signed(labelled_shingles(normal_words(t))).tolist() for t in b["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["k"], pa.array(s, pa.list_(pa.int64()))], ["k", "s"])


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = []
            for c in ("sa", "sb"):
                values, ends = b[c].values.to_numpy().view(np.uint64), b[c].offsets.to_numpy()
                sides.append([values[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)])
            sim = [similarity(x, y, threshold) for x, y in zip(*sides, strict=True)]
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(sim, pa.float64())], ["a", "b", "sim"])

    return run


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``k``, ``label``: the smallest node reachable over ``links`` (a, b). Only counts reach the driver."""
    both = materialize(spark, links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                       "near-links")
    labels = materialize(spark, both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m")).select(
        "k", F.least("k", "m").alias("label")), "near-labels")
    while True:
        around = both.join(labels.select(F.col("k").alias("b"), "label"), "b").groupBy(F.col("a").alias("k")).agg(
            F.min("label").alias("m"))
        closer = materialize(spark, labels.join(around, "k").select(
            "k", F.col("label").alias("old"), F.least("label", "m").alias("label")), "near-closer")
        jump = closer.select(F.col("k").alias("label"), F.col("label").alias("far"))
        after = materialize(spark, closer.join(jump, "label", "left").select(
            "k", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "near-labels")
        changed = after.filter("old != label").count()
        labels = after.select("k", "label")
        if not changed:
            return labels


def verified(spark: SparkSession, pairs: DataFrame, texts: DataFrame, threshold: float, name: str) -> DataFrame:
    """(a, b, sim) of ``pairs`` (a, b). ``texts``: (k, s) shingles."""
    sides = pairs.join(texts.select(F.col("k").alias("b"), F.col("s").alias("sb")), "b").join(
        texts.select(F.col("k").alias("a"), F.col("s").alias("sa")), "a")
    return materialize(spark, sides.select("a", "b", "sa", "sb").mapInArrow(
        _verify(threshold), "a long, b long, sim double"), name)


def exact_links(spark: SparkSession, near: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """All links (a, b) between nodes of ``near`` (k, label) whose labels differ, without a chance to miss one.

    Shingles are ordered by rarity among ``near``. Two texts that reach ``threshold`` share one of the first
    n - ceil(threshold * n) + 1 shingles of either, and behind the first shared one enough are left on both
    sides. So texts meet under their rare shingles; those that all share are reached by few. The label with
    most members under a shingle is compared with the others, never with itself.
    """
    own = near.join(texts, "k").select("k", "label", F.size("s").alias("n"), F.explode("s").alias("w"))
    own = materialize(spark, own, "near-own")
    often = own.groupBy("w").agg(F.count("*").alias("df")).filter("df > 1")
    common = own.join(often, "w").groupBy("k", "label", "n").agg(F.sort_array(F.collect_list(F.struct("df", "w"))).alias("g"))
    alone = F.col("n") - F.size("g")  # shingles of no other text come first
    first = F.greatest(F.lit(0), F.col("n") - F.ceil(threshold * F.col("n") - 1e-9) + 1 - alone).cast("int")
    keys = materialize(spark, common.select("k", "label", "n", alone.alias("u"), F.posexplode(F.slice("g", F.lit(1), first)).alias(
        "i", "e")).select("k", "label", "n", (F.col("n") - F.col("u") - F.col("i")).alias("rest"), F.col("e.w").alias("w")), "near-prefix")
    main = keys.groupBy("w", "label").agg(F.count("*").alias("c")).groupBy("w").agg(
        F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("labels")).filter("labels > 1")
    lists = materialize(spark, keys.join(main.drop("labels"), "w"), "near-lists")
    reach = F.least("x.rest", "y.rest") >= threshold / (1 + threshold) * (F.col("x.n") + F.col("y.n")) - 1e-9
    once = F.expr("y.label = y.main or x.k < y.k")
    met = lists.filter("label != main").alias("x").join(lists.alias("y"), F.expr("x.w = y.w and x.label != y.label") & once & reach)
    pairs = materialize(spark, met.select(F.least("x.k", "y.k").alias("a"), F.greatest("x.k", "y.k").alias("b")).distinct(), "near-rare")
    return verified(spark, pairs, texts, threshold, "near-exact").filter(F.col("sim") >= threshold).select("a", "b")


def candidate_links(spark: SparkSession, texts: DataFrame, members: DataFrame, threshold: float, rounds: int) -> DataFrame:
    """Verified links (a, b) of members with centres. ``texts``: (k, s) shingles; ``members``: (k, band, h, pop)."""
    links, left = None, members
    for i in range(rounds):
        centre = left.groupBy("band", "h").agg(F.max_by("k", F.struct("pop", "k")).alias("c"), F.count("*").alias("n")).filter("n > 1")
        met = materialize(spark, left.join(centre.select("band", "h", "c"), ["band", "h"]).filter("k != c"), f"near-met{i}")
        pairs = materialize(spark, met.select(F.col("k").alias("a"), F.col("c").alias("b")).distinct(), f"near-pairs{i}")
        seen = verified(spark, pairs, texts, threshold, f"near-seen{i}")
        new = seen.filter(F.col("sim") >= threshold).select("a", "b").distinct()
        links = new if links is None else links.union(new)
        if i + 1 == rounds or not seen.filter(F.col("sim") < threshold).limit(1).count():
            break
        far = seen.filter(F.col("sim") < threshold).select(F.col("a").alias("k"), F.col("b").alias("c")).distinct()
        left = materialize(spark, met.join(far, ["k", "c"], "left_semi").select("k", "band", "h", "pop"), f"near-left{i}")
    return links


def renamed_nodes(spark: SparkSession, found: DataFrame) -> DataFrame | None:
    """Nodes are different word sequences (k1, k2), named by k1. Where several share k1, all but the first get a name
    (``k``) that no node has: (k1, k2, k), or None if there are none. At 10^11 texts that is some hundred rows."""
    shared = found.groupBy("k1").agg(F.count("*").alias("c")).filter("c > 1").select("k1")
    if not shared.head(1):
        return None
    clash = materialize(spark, found.join(shared, "k1", "left_semi").select("k1", "k2").withColumn("i", F.row_number().over(
        Window.partitionBy("k1").orderBy("k2"))).filter("i > 1").select("k1", "k2"), "near-clash")
    n = clash.count()
    for seed in range(100):
        named = materialize(spark, clash.withColumn("k", F.xxhash64(F.lit(seed), "k1", "k2")), "near-moved")
        if named.select("k").distinct().count() == n and not named.join(found.select(F.col("k1").alias("k")), "k", "left_semi").head(1):
            return named
    raise RuntimeError("no free names for texts whose hashes collide")


def node_names(rows: DataFrame, moved: DataFrame | None) -> DataFrame:
    """``rows`` (k1, k2, ...) with their node ``k``; null where k1 is."""
    if moved is None:
        return rows.withColumn("k", F.col("k1"))
    return rows.join(moved.withColumnRenamed("k", "_k"), ["k1", "k2"], "left").withColumn("k", F.coalesce("_k", "k1")).drop("_k")


def classes(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, r1, r2, class_id) per row of ``docs``, and (r1, r2) of the rows that stay."""
    small_batches(spark)
    r1, r2 = row_key("doc_id", "text")
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    keyed = docs.withColumns({"r1": r1, "r2": r2})
    rows = materialize(spark, keyed.select("doc_id", "r1", "r2", "text").mapInArrow(_emit_sketches, (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, r1 long, r2 long, k1 long, k2 long, n int, sk array<long>")), "near-rows")
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "r1", "r2")
    found = materialize(spark, rows.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.min(place).alias("rep"), F.first("n").alias("n"), F.first("sk").alias("sk")), "near-nodes")
    moved = renamed_nodes(spark, found)
    nodes = node_names(found, moved)
    short = nodes.filter(F.col("n") <= int(SHORT / threshold)).select("k")
    keys = nodes.select("k", F.posexplode("sk").alias("band", "h"))
    busy = materialize(spark, keys.groupBy("band", "h").agg(F.count("*").alias("n")).filter("n > 1"), "near-busy")
    members = materialize(spark, keys.join(busy, ["band", "h"]), "near-members")
    pop = members.groupBy("k").agg(F.sum("n").alias("pop"))
    members = materialize(spark, members.drop("n").join(pop, "k"), "near-popular")
    reps = members.select("k").union(short).distinct().join(nodes.select("k", "rep.r1", "rep.r2"), "k")
    texts = materialize(spark, keyed.join(reps, ["r1", "r2"]).select("k", "text").mapInArrow(
        _emit_shingles, "k long, s array<long>").dropDuplicates(["k"]), "near-shingles")
    links = candidate_links(spark, texts, members, threshold, rounds)
    labels = components(spark, links)
    inside = materialize(spark, members.select("k", "band", "h").join(labels, "k", "left").withColumn(
        "label", F.coalesce("label", "k")), "near-inside")
    mixed = inside.groupBy("band", "h").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y")
    near = inside.join(mixed, ["band", "h"], "left_semi").select("k", "label").union(
        short.join(labels, "k", "left").select("k", F.coalesce("label", "k"))).distinct()
    more = exact_links(spark, near, texts, threshold)
    if more.limit(1).count():
        labels = components(spark, links.union(more))
    named = materialize(spark, nodes.select("k", "rep").join(labels, "k", "left").select(
        "k", "rep", F.coalesce("label", "k").alias("label")), "near-named")
    first = materialize(spark, named.groupBy("label").agg(F.min("rep").alias("first")), "near-first")
    known = materialize(spark, named.join(first, "label").select("k", F.col("first.doc_id").alias("class_id")), "near-classes")
    out = node_names(rows, moved).join(known, "k", "left")
    result = out.select("doc_id", "r1", "r2", F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    stay = first.select("first.r1", "first.r2").union(rows.filter("k1 is null").select("r1", "r2"))
    return result, stay


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    result, _ = classes(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return result.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("is_representative"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline form: the first document of each class stays, as it is."""
    _, stay = classes(spark, docs)
    r1, r2 = row_key("doc_id", "text")
    keyed = packed(docs, "doc_id", text_or_empty().alias("text")).withColumns({"r1": r1, "r2": r2}).drop("doc_id", "text")
    stay = materialize(spark, stay.distinct(), "near-stay")
    return unpacked(keyed.join(stay, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"]))
