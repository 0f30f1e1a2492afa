"""Session windows computed in parallel, with or without a session key, in batch and stream.

A session chains events (of one key, or of all keys when there is none)
while consecutive events are at most ``gap`` apart; trips are then counted
per ``count_keys`` inside each session. Spark's ``session_window`` keeps
every event of a key in one task (and refuses an unkeyed stream), so a hot
key, or the unkeyed case, would run through a single task. This is a
distributed gaps-and-islands over intervals instead (an event is an interval
of one instant; an open session of earlier batches is one interval):

1. distinct intervals, map-side de-duplicated so a hot timestamp costs one
   row per task, range-partitioned on (key, start) into balanced slices: a
   hot key's time range is split across many slices;
2. one summary row per slice and key, its latest end; a running maximum over
   the slices of a key carries ends forward (a prefix scan as a window over summaries);
3. a session starts where an interval begins more than ``gap`` after all
   earlier ends of its key; a second scan carries the latest start forward;
4. events are pre-aggregated per (key, time, count keys) and joined to
   their session.

``SessionStream`` runs this on every micro-batch of a stream and keeps only
open sessions as state. Nothing but single numbers passes the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareway.session import checkpoint_dir
from fareway.sources import versions as V


def _same(a: str, b: str, cols: list[str]):
    """Null-safe equality of aliased frames on ``cols``."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def sessionize(intervals: DataFrame, keys: list[str], gap_us: int, slices: int | None = None,
               rows_per_slice: int = 2_000_000) -> DataFrame:
    """``intervals`` (keys, ``_lo``, ``_hi``: microseconds), once each, with ``_sess``, the start of their session."""
    spark = intervals.sparkSession
    checkpoint_dir(spark)  # the shared folder the checkpoint below writes to
    distinct = intervals.select(*keys, "_lo", "_hi").distinct()
    if not slices:
        distinct = distinct.checkpoint(eager=True)
        n = distinct.count()  # cheap: reads the checkpointed rows
        slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_per_slice), 1)
    # Reliable checkpoint in the shared checkpoint folder: pins the slice numbers.
    ranged = distinct.repartitionByRange(slices, *keys, "_lo", "_hi").withColumn("pid", F.spark_partition_id()).checkpoint(eager=True)

    inside = Window.partitionBy("pid", *keys).orderBy("_lo", "_hi")
    earlier, run = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)

    def carried(rows: DataFrame, value, name: str) -> DataFrame:
        """The largest ``value`` of the key in earlier slices, beside every row."""
        scan = rows.groupBy("pid", *keys).agg(F.max(value).alias("_v")).withColumn(name, F.max("_v").over(before)).drop("_v")
        return rows.alias("r").join(scan.alias("s"), _same("r", "s", ["pid", *keys])).select("r.*", f"s.{name}")

    rows = carried(ranged, F.col("_hi"), "_end_before")
    seen = F.greatest(F.max("_hi").over(earlier), F.col("_end_before"))
    rows = rows.withColumn("_new", F.when(seen.isNull() | (F.col("_lo") - seen > gap_us), F.col("_lo")))
    rows = carried(rows, F.col("_new"), "_start_before")
    return rows.withColumn("_sess", F.coalesce(F.max("_new").over(run), F.col("_start_before"))).select(*keys, "_lo", "_hi", "_sess")


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _merged(counts: DataFrame, keys: list[str], count_keys: list[str], gap_us: int, slices: int | None,
            rows_per_slice: int = 2_000_000) -> DataFrame:
    """``counts`` (keys, count keys, ``_lo``, ``_hi``, ``_n``) by session: ``_sess``, ``_last``, ``num_trips`` per count key."""
    mapped = sessionize(counts, keys, gap_us, slices, rows_per_slice)
    last = mapped.groupBy(*keys, "_sess").agg(F.max("_hi").alias("_last"))
    found = counts.alias("c").join(mapped.alias("m"), _same("c", "m", [*keys, "_lo", "_hi"])).select("c.*", "m._sess")
    # Totals first: a long session reaches the join with its ends as one row per count key.
    totals = found.groupBy(*keys, "_sess", *count_keys).agg(F.sum("_n").cast("bigint").alias("num_trips"))
    return totals.alias("t").join(last.alias("l"), _same("t", "l", [*keys, "_sess"])).select("t.*", "l._last")


def _counted(events: DataFrame, ts: str, keys: list[str], count_keys: list[str]) -> DataFrame:
    at = events.select(*keys, *count_keys, _micros(ts).alias("_lo")).where("_lo is not null")
    return at.groupBy(*keys, *count_keys, "_lo").agg(F.count(F.lit(1)).alias("_n")).withColumn("_hi", F.col("_lo"))


def _shown(merged: DataFrame, keys: list[str], count_keys: list[str], gap_us: int, kind: str) -> DataFrame:
    return merged.select(*keys, F.timestamp_micros("_sess").cast(kind).alias("session_start"),
                         F.timestamp_micros(F.col("_last") + F.lit(gap_us)).cast(kind).alias("session_end"), *count_keys, "num_trips")


def session_counts(events: DataFrame, ts: str, gap_seconds: int, session_keys: list[str] | None = None,
                   count_keys: list[str] | None = None, slices: int | None = None,
                   rows_per_slice: int = 2_000_000) -> DataFrame:
    """Sessions per ``session_keys`` (all events together when empty) with
    trip counts per ``count_keys``. ``slices`` defaults to enough slices for
    ``rows_per_slice`` distinct (key, time) pairs each, at least the shuffle
    partition count."""
    sk = list(session_keys or [])
    ck = [c for c in (count_keys or []) if c not in sk]
    gap_us = gap_seconds * 1_000_000
    merged = _merged(_counted(events, ts, sk, ck), sk, ck, gap_us, slices, rows_per_slice)
    return _shown(merged, sk, ck, gap_us, "timestamp_ntz")


def global_session_counts(events: DataFrame, ts: str, gap_seconds: int, keys: list[str],
                          slices: int | None = None) -> DataFrame:
    """Sessions over all events together, then trips per ``keys`` inside."""
    return session_counts(events, ts, gap_seconds, [], keys, slices)


class SessionStream:
    """Sessions over a stream, as a ``foreachBatch`` writer into ``sink``.

    State is one folder per batch: the open sessions with their counts, and
    the latest event time. A replayed batch starts from the state of the one before it and
    writes its own state and output again. Events whose session would have
    ended by the watermark (latest time of earlier batches less ``delay``) are
    late and dropped; a session is emitted when the watermark passes its end.
    """

    def __init__(self, path: str, sink, ts: str, gap_seconds: int, session_keys: list[str] | None = None,
                 count_keys: list[str] | None = None, delay_seconds: int = 5, slices: int | None = None):
        self.path, self.sink, self.ts, self.slices = path.rstrip("/"), sink, ts, slices
        self.gap, self.delay = gap_seconds * 1_000_000, delay_seconds * 1_000_000
        self.keys = list(session_keys or [])
        self.count_keys = [c for c in (count_keys or []) if c not in self.keys]

    def schema(self, events: DataFrame):
        """Schema of what the sink gets."""
        types = {f.name: f.dataType.simpleString() for f in events.schema.fields}
        cols = [f"`{c}` {types[c]}" for c in self.keys] + ["session_start timestamp", "session_end timestamp"]
        return ", ".join(cols + [f"`{c}` {types[c]}" for c in self.count_keys] + ["num_trips bigint"])

    def _state(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame | None, int | None]:
        ids = [int(f.rsplit("=", 1)[1]) for f in V.children(spark, self.path) if "/batch=" in f]
        ids = [i for i in ids if i < batch_id]
        if not ids:
            return None, None
        at = f"{self.path}/batch={max(ids)}"
        return spark.read.parquet(f"{at}/open"), spark.read.parquet(f"{at}/time").first()["latest"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        open_before, latest = self._state(spark, batch_id)
        counts = _counted(batch, self.ts, self.keys, self.count_keys)
        if latest is not None:
            counts = counts.where(F.col("_lo") + F.lit(self.gap) > F.lit(latest - self.delay))
        counts = counts.checkpoint(eager=True)
        seen = batch.agg(F.max(_micros(self.ts))).first()[0]
        latest = max((t for t in (latest, seen) if t is not None), default=None)
        if open_before is not None:
            counts = counts.unionByName(open_before.select(*counts.columns))
        merged = _merged(counts, self.keys, self.count_keys, self.gap, self.slices).checkpoint(eager=True)
        ended = F.col("_last") + F.lit(self.gap) <= F.lit(None if latest is None else latest - self.delay).cast("long")
        ended = F.coalesce(ended, F.lit(False))
        state = f"{self.path}/batch={batch_id}"
        still = merged.where(~ended).select(*self.keys, *self.count_keys, F.col("_sess").alias("_lo"), F.col("num_trips").alias("_n"),
                                            F.col("_last").alias("_hi"))
        still.write.mode("overwrite").parquet(f"{state}/open")
        spark.range(1).select(F.lit(latest).cast("long").alias("latest")).write.mode("overwrite").parquet(f"{state}/time")
        self.sink(_shown(merged.where(ended), self.keys, self.count_keys, self.gap, "timestamp"), batch_id)
        V.remove(spark, [f for f in V.children(spark, self.path) if "/batch=" in f and int(f.rsplit("=", 1)[1]) < batch_id - 1])


GLOBAL_SESSION_SQL_TEMPLATE = """WITH e AS (SELECT date_trunc('second', event_ts) AS ts, PULocationID FROM rides),
d AS (SELECT DISTINCT ts FROM e),
l AS (SELECT ts, lag(ts) OVER (ORDER BY ts) AS prev FROM d),
s AS (SELECT ts, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL {gap} MINUTE THEN 1 ELSE 0 END)
  OVER (ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM l),
b AS (SELECT sid, min(ts) AS session_start, max(ts) + INTERVAL {gap} MINUTE AS session_end FROM s GROUP BY sid)
SELECT b.session_start, b.session_end, e.PULocationID, count(*) AS num_trips
FROM e JOIN s ON e.ts = s.ts JOIN b ON s.sid = b.sid GROUP BY 1, 2, 3"""
