"""Mix sources to target weights by weighted fair queueing.

Every document of a source is shuffled by a seeded hash and queued once per
allowed pass. Its virtual start and finish are the source's tokens served
before and after it, divided by the source's target. A scheduler that always
serves the earliest finish gives every source its share at any time.

1. ``keyed`` reduces documents to source, hash and size; rows equal in all
   three become one run of equal rows.
2. ``queue`` gives each run its place in its source: prefix sums over hash
   buckets, never one task per source.
3. ``schedule`` lays out the copies of all passes, sorts them by finish over
   all sources (range partitions) and adds up what is served along that order.
   The order is cut where the total budget is reached: at that time every
   source has one copy in service at most, which is taken up to the cut.
   What the cut order holds is checked against the budget.
4. ``deal`` joins the kept copies back to their documents by hash, the only
   shuffle of whole rows. Of a run that the cut splits, the rows are numbered
   by parts of the input and served in that order.

Targets: sources in code-point order (null last) weigh ``weights`` in turn
and share ``share`` times all sizes; no target exceeds ``max_repeat`` times
its source's size, and the excess is reshared by weight among the others. The
budget is the sum of the targets unless a smaller one is given.

Defined results: a null text has size 0 and takes 0. Equal rows are served
one by one, also if they fill a third of the table. Equal finish times are
ordered by hash. A source of size 0 has target 0. Empty tables give empty
results. Very long texts are one row each. Other columns, whatever their names, are kept in
``_doc`` and come back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fareway.llm.common import WORD, count_words, discard, materialize, row_key, table, text_or_empty, unpacked

WEIGHTS, SHARE, MAX_REPEAT = (5, 2, 1), 1.5, 2


def source_key(source: str = "source"):
    """A text that keeps a null source apart from every other and sorts it last."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source).cast("string")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: ``key``, ``source_size``, ``target``. ``sizes``: rows of (key, size).

    Water filling over one row per source: by rising ceiling per weight, a
    source is full while the level reached by the rest is above its ceiling.
    """
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("_i", F.row_number().over(Window.orderBy("key")))
    s = s.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                        ((F.col("_i") - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("_cap", F.col("source_size").cast("double") * max_repeat)
    s = s.withColumn("_budget", F.sum("source_size").over(every) * F.lit(float(share)))
    up = Window.orderBy(F.col("_cap") / F.col("_w"), "_i")
    s = s.withColumn("_full", F.coalesce(F.sum("_cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("_rest", F.sum("_w").over(up.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("_level", (F.col("_budget") - F.col("_full")) / F.col("_rest"))
    s = s.withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_cap"))
    level = F.min_by(F.when(F.col("_open"), F.col("_level")), F.when(F.col("_open"), F.struct(
        F.col("_cap") / F.col("_w"), "_i"))).over(every)
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least("_cap", level * F.col("_w")))
    return s.select("key", "source_size", target.alias("target"))


def keyed(docs: DataFrame, size: Column, identity: list[str], source: str = "source", seed: int = 11) -> DataFrame:
    """``_doc`` (the whole row), ``s`` (its source), ``size``, and ``h1``, ``h2``: the shuffle's hash of ``identity``."""
    h1, h2 = row_key(*identity)
    return docs.select(F.struct("*").alias("_doc"), source_key(source).alias("s"), size.cast("long").alias("size"),
                       h1.bitwiseXOR(F.lit(seed)).alias("h1"), h2.alias("h2"))


ID = ["s", "h1", "h2"]
RUN = [*ID, "size"]


def queue(spark: SparkSession, keys: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Runs of equal rows of ``keys`` with ``rows``, ``start`` (tokens of the source before the run in its first pass),
    ``source_size`` and ``target``."""
    counted = materialize(spark, keys.groupBy(*RUN).agg(F.count("*").alias("rows")), "mix-runs")
    buckets = max(64, int(counted.count()**0.5))
    runs = counted.withColumn("words", F.col("size") * F.col("rows")).withColumn(
        "b", F.pmod(F.shiftrightunsigned("h1", 16), F.lit(buckets)))
    sums = runs.groupBy("s", "b").agg(F.sum("words").alias("sum"))
    offsets = sums.withColumn("before", F.coalesce(F.sum("sum").over(
        Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    targets = source_targets(sums.select(F.col("s").alias("key"), F.col("sum").alias("size")),
                             weights, share, max_repeat).withColumnRenamed("key", "s")
    offsets = offsets.join(targets, "s").select("s", "b", "before", "source_size", "target")
    inside = F.sum("words").over(Window.partitionBy("s", "b").orderBy("h1", "h2", "size")
                                 .rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    placed = runs.withColumn("inside", inside).join(offsets, ["s", "b"])
    out = materialize(spark, placed.select(*RUN, "rows", (F.col("before") + F.col("inside")).alias("start"), "source_size",
                                           "target"), "mix-queue")
    discard(spark, counted)
    return out


def schedule(spark: SparkSession, queued: DataFrame, max_repeat: int = MAX_REPEAT, budget: float | None = None) -> DataFrame:
    """Copies of runs in the order of their virtual ``finish``, up to the cut: ``pass``, ``taken`` (words of the whole
    run) and ``served`` (words of this and all earlier copies)."""
    total = queued.select("s", "target").distinct().agg(F.sum("target")).first()[0] or 0.0
    end = 1.0 if budget is None or budget >= total else max(0.0, budget / total)  # virtual time at which the budget is spent
    words = F.col("size") * F.col("rows")
    copies = queued.filter("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
    copies = copies.withColumn("begin", F.col("start") + F.col("pass") * F.col("source_size"))
    copies = copies.withColumn("finish", F.try_divide(F.col("begin") + words, F.col("target")))
    order = ["finish", "h1", "h2", "s", "size", "pass"]
    line = copies.repartitionByRange(*order).sortWithinPartitions(*order)
    # A copy that finishes after the budget is spent is in service at the cut and gets what its source has left.
    left = F.floor(F.col("target") * F.lit(end) - F.col("begin") + F.lit(1e-6))
    line = line.withColumn("taken", F.greatest(F.lit(0), F.least(words, left)).cast("long")).filter("taken > 0")
    line = materialize(spark, line.select(*order, "taken", F.spark_partition_id().alias("part")), "mix-line")
    sums = line.groupBy("part").agg(F.sum("taken").alias("sum"))
    before = sums.select("part", F.coalesce(F.sum("sum").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), "sum")
    spent = before.agg(F.max(F.col("before") + F.col("sum"))).first()[0] or 0
    sources = queued.select("s").distinct().count()
    if abs(spent - total * end) > sources + 1e-6 * total:
        raise RuntimeError(f"the cut order holds {spent} words, the budget is {total * end}")
    along = F.sum("taken").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return line.withColumn("within", along).join(before.select("part", "before"), "part").select(
        *order, "taken", (F.col("before") + F.col("within")).alias("served"))


def kept(queued: DataFrame, line: DataFrame) -> DataFrame:
    """Per run what the cut order holds of it: ``whole`` (copies of every row) and ``part`` (words of a further copy,
    served to the run's rows one after the other)."""
    sums = line.groupBy(*RUN).agg(F.sum("taken").alias("run_taken"))
    out = queued.join(sums, RUN, "left").withColumn("words", F.col("size") * F.col("rows"))
    taken = F.coalesce("run_taken", F.lit(0))
    return out.select(*RUN, "rows", "source_size", "target",
                      F.when(F.col("words") > 0, F.floor(taken / F.col("words"))).otherwise(0).cast("int").alias("whole"),
                      F.when(F.col("words") > 0, taken % F.col("words")).otherwise(0).cast("long").alias("part"))


def deal(spark: SparkSession, keys: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of ``keys`` with their run's ``size``, ``source_size`` and ``target``, ``whole`` copies and ``part`` words of one more."""
    rows, runs = keys.select("_doc", *ID), materialize(spark, runs, "mix-kept")
    shown = ["_doc", "size", "source_size", "target", "whole", "part"]
    split = runs.filter("rows > 1 and part > 0")  # at most one per source
    if not split.head(1):
        return rows.join(runs, ID).select(*shown)
    # Rows of a split run are alike, so any numbering does; it is written before use, so a lost task cannot change it.
    some = materialize(spark, rows.join(split.select(*ID), ID, "left_semi").withColumn("at", F.monotonically_increasing_id()), "mix-split")
    some = some.withColumn("p", F.shiftright("at", 33))
    counts = some.groupBy(*ID, "p").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy(*ID).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    number = F.row_number().over(Window.partitionBy(*ID, "p").orderBy("at")) - 1
    some = some.withColumn("i", number).join(counts, [*ID, "p"]).join(split, ID)
    some = some.withColumn("own", F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - (
        F.col("before") + F.col("i")) * F.col("size"))))
    full = F.col("own") == F.col("size")
    some = some.withColumn("whole", F.col("whole") + full.cast("int")).withColumn("part", F.when(full, 0).otherwise(F.col("own")).cast("long"))
    return rows.join(runs.filter("rows = 1 or part = 0"), ID).select(*shown).union(some.select(*shown))


def mix(spark: SparkSession, keys: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT,
        budget: float | None = None) -> DataFrame:
    """Rows of ``keyed`` documents with ``size``, ``source_size``, ``target``, ``whole`` and ``part``."""
    narrow = materialize(spark, keys.select(*RUN), "mix-keys")
    queued = queue(spark, narrow, weights, share, max_repeat)
    line = schedule(spark, queued, max_repeat, budget)
    discard(spark, narrow)
    return deal(spark, keys, kept(queued, line))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = text_or_empty()
    docs = materialize(spark, table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.xxhash64(t).alias("text"), count_words(t).alias("words")), "mix-docs")
    mixed = mix(spark, keyed(docs, F.col("words"), ["doc_id", "text"]))
    return mixed.select("_doc.doc_id", "size", "source_size", "target",
                        (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline form: the mixed corpus, copies as rows of their own.

    The copy in service at the cut keeps its first words, as many as it is served, joined by spaces.
    """
    mixed = mix(spark, keyed(docs, count_words(text_or_empty()), ["doc_id", "text"]))
    copies = F.col("whole") + (F.col("part") > 0).cast("int")
    out = mixed.filter(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("_doc.text"), F.lit(WORD), F.lit(0)), 1, F.col("part").cast("int")), " ")
    cut = F.col("copy") > F.col("whole")
    return unpacked(out, text=F.when(cut, head).otherwise(F.col("_doc.text")),
                    n_chars=F.when(cut, F.length(head)).otherwise(F.col("_doc.n_chars")).cast("long"))
