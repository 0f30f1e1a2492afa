"""Streaming jobs over ride messages derived from ``events``.

The producer side writes the messages as JSON-lines files, one folder per
two weeks of event time, in event-time order, plus an optional far-future flush
message. Each query streams those files (one folder per micro-batch), runs
the windowed aggregate with a 5 s watermark into an idempotent keyed sink,
and returns the sink's contents. The oracles are the batch window SQL. An
empty table gives empty results.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.operators import reports as R
from fareway.plans import fixtures as fx
from fareway.plans.registry import query
from fareway.session import scratch_path
from fareway.sources import versions as V
from fareway.streaming import sessions as GS
from fareway.streaming import sinks as K
from fareway.streaming import sources as SS
from fareway.streaming import windows as WN

BATCHES = 4  # micro-batches that the files of a query are dealt to: a batch has more files, and tasks, as the data grow
ROWS_PER_FILE = 1_000_000
SLICE_SECONDS = 14 * 86400
FLUSH_TS = "2099-01-01 00:00:00"
DELAY = "5 seconds"


def flush_event(spark: SparkSession, form: str) -> DataFrame:
    """Sentinel far in the future: advances the watermark past every real
    window; its own window never closes, so it is never emitted."""
    if form == "text":
        row = [(FLUSH_TS, FLUSH_TS, -1, -1, 0, 0.0, 0.0, 0.0)]
        return spark.createDataFrame(row, SS.RIDE_TEXT_SCHEMA)
    ms = int(dt.datetime(2099, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    return spark.createDataFrame([(-1, -1, 0.0, 0.0, ms)], SS.RIDE_EPOCH_SCHEMA)


def write_message_slices(spark, sf, form: str, first: int = 0, last: int | None = None,
                         root: str | None = None) -> tuple[str, int]:
    """Write time slices [first, last) of messages, one folder each, in one
    pass: range-partitioned by event time, so that files are in time order.
    Returns (root, number of slices in the data), 0 for an empty table."""
    rides = fx.rides(spark, sf)
    epoch = F.unix_seconds(F.col("event_ts").cast("timestamp"))
    lo, hi = rides.agg(F.min(epoch), F.max(epoch)).first()
    root = root or scratch_path(spark, f"rides-{form}")
    if lo is None:
        return root, 0
    n = (hi - lo) // SLICE_SECONDS + 1
    number = F.floor((epoch - F.lit(lo)) / SLICE_SECONDS)
    to_msg = SS.to_text_message if form == "text" else SS.to_epoch_message
    part = rides.where((number >= first) & (number < (n if last is None else min(last, n))))
    messages = to_msg(part, F.format_string("%04d", number).alias("s"), F.col("event_ts").alias("_at"))
    messages = messages.repartitionByRange("_at").sortWithinPartitions("s", "_at").drop("_at")
    messages.write.mode("append").partitionBy("s").option("maxRecordsPerFile", ROWS_PER_FILE).json(root)
    put_in_order(spark, root)
    return root, n


_STARTED: dict[str, int] = {}


def put_in_order(spark: SparkSession, root: str) -> None:
    """A file stream reads files by their time: give them the order of their names, as one producer would."""
    now = _STARTED.setdefault(root, int(dt.datetime.now().timestamp() * 1000) - 86_400_000)
    files = [f for folder in V.children(spark, root) if "/s=" in folder for f in V.children(spark, folder) if f.endswith(".json")]
    for i, f in enumerate(files):
        path, fs = V._fs(spark, f)
        fs.setTimes(path, now + i, -1)


def files_per_trigger(spark: SparkSession, root: str) -> int:
    files = sum(f.endswith(".json") for folder in V.children(spark, root) if "/s=" in folder for f in V.children(spark, folder))
    return max(1, -(-files // BATCHES))


def write_flush(spark, root: str, form: str) -> None:
    flush_event(spark, form).repartition(1).write.json(f"{root}/s=9999")


def _source(spark, root, form):
    schema = SS.RIDE_TEXT_SCHEMA if form == "text" else SS.RIDE_EPOCH_SCHEMA
    stream = SS.read_stream(spark, f"{root}/*/*.json", schema, fmt="files", max_per_trigger=files_per_trigger(spark, root))
    if form == "text":
        return SS.with_event_time(stream, DELAY, text_col="lpep_pickup_datetime")
    return SS.with_event_time(stream, DELAY, epoch_col="tpep_pickup_datetime")


def _ntz(df: DataFrame, *cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def run_windows(spark, root, form, build, key, sink_path=None, ckpt=None):
    out = build(_source(spark, root, form))
    sink = K.KeyedSink(sink_path or scratch_path(spark, "sink"), key, out.schema)
    q = K.run_stream(out, sink, ckpt or scratch_path(spark, "ckpt"))
    q.awaitTermination()
    return sink, q


def _window_query(spark, sf, form, build, key, flush=True):
    root, _ = write_message_slices(spark, sf, form)
    if flush:
        write_flush(spark, root, form)
    sink, _ = run_windows(spark, root, form, build, key)
    return sink.read(spark)


def tumble_zone(size):
    def build(df):
        return WN.tumbling(df, "event_timestamp", size, ["PULocationID"], WN.ride_window_aggs(df)).drop("window_end")
    return build


def tumble_tips(df):
    return WN.tumbling(df, "event_timestamp", "1 hour", [], WN.tips_aggs(df)).drop("window_end")


def _session_query(spark, sf, gap_minutes, session_keys, count_keys):
    """Sessions of the streamed messages, into a keyed sink."""
    root, _ = write_message_slices(spark, sf, "text")
    write_flush(spark, root, "text")
    stream = _source(spark, root, "text")
    sink = K.KeyedSink(scratch_path(spark, "sink"), [*session_keys, "session_start", *count_keys])
    writer = GS.SessionStream(scratch_path(spark, "sessions"), sink, "event_timestamp", gap_minutes * 60, session_keys, count_keys)
    sink.schema = writer.schema(stream)
    K.run_stream(stream, writer, scratch_path(spark, "ckpt")).awaitTermination()
    return _ntz(sink.read(spark), "session_start", "session_end")


# ---------------------------------------------------------------- oracles

def _bucket(ts: str, seconds: int) -> str:
    return f"to_timestamp(floor(epoch({ts}) / {seconds}) * {seconds})::TIMESTAMP"


def tumble_sql(seconds: int, ts_unit: str) -> str:
    ts = f"date_trunc('{ts_unit}', event_ts)"
    return (f"SELECT {_bucket(ts, seconds)} AS window_start, PULocationID, count(*) AS num_trips, "
            f"cast(sum(total_amount) AS double) AS total_revenue FROM rides GROUP BY 1, 2")


_TS_SECOND = "date_trunc('second', event_ts)"
TIPS_SQL = (f"SELECT {_bucket(_TS_SECOND, 3600)} AS window_start, "
            "cast(sum(tip_amount) AS double) AS total_tips FROM rides GROUP BY 1")


def session_sql(gap_minutes: int) -> str:
    return f"""SELECT PULocationID, min(ts) AS session_start, max(ts) + INTERVAL {gap_minutes} MINUTE AS session_end,
count(*) AS num_trips FROM (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL {gap_minutes} MINUTE
THEN 1 ELSE 0 END) OVER (PARTITION BY PULocationID ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
FROM (SELECT PULocationID, ts, lag(ts) OVER (PARTITION BY PULocationID ORDER BY ts) AS prev
FROM (SELECT PULocationID, date_trunc('second', event_ts) AS ts FROM rides)))
GROUP BY PULocationID, sid"""


SESSION_GAP_MIN = 60
HW_SESSION_GAP_MIN = 5


# ---------------------------------------------------------------- windows

@query("stream_tumble_1h", tumble_sql(3600, "millisecond"))
def stream_tumble_1h(spark, sf):
    return _ntz(_window_query(spark, sf, "epoch", tumble_zone("1 hour"), ["window_start", "PULocationID"]),
                "window_start")


@query("stream_tumble_5m", tumble_sql(300, "second"))
def stream_tumble_5m(spark, sf):
    return _ntz(_window_query(spark, sf, "text", tumble_zone("5 minutes"), ["window_start", "PULocationID"]),
                "window_start")


@query("stream_tumble_global", TIPS_SQL)
def stream_tumble_global(spark, sf):
    return _ntz(_window_query(spark, sf, "text", tumble_tips, ["window_start"]), "window_start")


@query("stream_session_keyed", session_sql(SESSION_GAP_MIN))
def stream_session_keyed(spark, sf):
    return _session_query(spark, sf, SESSION_GAP_MIN, ["PULocationID"], [])


def _hw_sessions(spark, sf):
    return _session_query(spark, sf, HW_SESSION_GAP_MIN, ["PULocationID"], [])


@query("longest_session", f"""SELECT PULocationID, cast(num_trips AS bigint) AS num_trips, session_start AS window_start,
date_diff('second', session_start, session_end) AS session_duration FROM ({session_sql(HW_SESSION_GAP_MIN)})
QUALIFY row_number() OVER (ORDER BY date_diff('second', session_start, session_end) DESC, num_trips DESC, PULocationID,
session_start) <= 10""")
def longest_session(spark, sf):
    """The ten longest sessions; the length in whole seconds."""
    s = _hw_sessions(spark, sf)
    g = s.select("PULocationID", F.col("num_trips").cast("bigint").alias("num_trips"), F.col("session_start").alias("window_start"),
                 F.timestamp_diff("SECOND", "session_start", "session_end").alias("session_duration"))
    return R.top_k(g, 10, F.col("session_duration").desc(), F.col("num_trips").desc(), F.col("PULocationID"),
                   F.col("window_start"))


@query("session_totals", f"""SELECT cast(sum(num_trips) AS bigint) AS total_trips, count(*) AS sessions
FROM ({session_sql(HW_SESSION_GAP_MIN)})""")
def session_totals(spark, sf):
    return _hw_sessions(spark, sf).agg(F.sum("num_trips").cast("bigint").alias("total_trips"),
                                       F.count(F.lit(1)).alias("sessions"))


@query("stream_top_windows", f"""SELECT * FROM (SELECT 'trips' AS ranking, window_start, PULocationID,
cast(num_trips AS double) AS value FROM ({tumble_sql(300, 'second')})
ORDER BY num_trips DESC, window_start, PULocationID LIMIT 3)
UNION ALL SELECT * FROM (SELECT 'tips' AS ranking, window_start, CAST(NULL AS INTEGER) AS PULocationID,
total_tips AS value FROM ({TIPS_SQL}) ORDER BY total_tips DESC, window_start LIMIT 10)""")
def stream_top_windows(spark, sf):
    """Read-out queries over the stored window sinks: the 3 busiest 5-minute
    zone windows and the 10 hours with the largest tips."""
    w = stream_tumble_5m(spark, sf)
    trips = R.top_k(w, 3, F.col("num_trips").desc(), F.col("window_start"), F.col("PULocationID")).select(
        F.lit("trips").alias("ranking"), "window_start", "PULocationID",
        F.col("num_trips").cast("double").alias("value"))
    t = stream_tumble_global(spark, sf)
    tips = R.top_k(t, 10, F.col("total_tips").desc(), F.col("window_start")).select(
        F.lit("tips").alias("ranking"), "window_start", F.lit(None).cast("int").alias("PULocationID"),
        F.col("total_tips").alias("value"))
    return trips.unionByName(tips)


@query("stream_session_global", GS.GLOBAL_SESSION_SQL_TEMPLATE.format(gap=HW_SESSION_GAP_MIN))
def stream_session_global(spark, sf):
    """Sessions over all zones together (5 min gap) inside the stream, then
    trips per zone in each session."""
    return _session_query(spark, sf, HW_SESSION_GAP_MIN, [], ["PULocationID"])


# ---------------------------------------------------------------- pass-through, sources

def _append_query(spark, sf, form, transform):
    root, _ = write_message_slices(spark, sf, form)
    stream = SS.read_stream(spark, f"{root}/*/*.json",
                            SS.RIDE_TEXT_SCHEMA if form == "text" else SS.RIDE_EPOCH_SCHEMA,
                            fmt="files", max_per_trigger=files_per_trigger(spark, root))
    out = transform(stream)
    sink = K.KeyedSink(scratch_path(spark, "sink"), [], out.schema)
    K.run_stream(out, sink, scratch_path(spark, "ckpt")).awaitTermination()
    return sink.read(spark)


@query("stream_pass_through", """SELECT PULocationID, DOLocationID, trip_distance, cast(total_amount AS double) AS total_amount,
date_trunc('millisecond', event_ts) AS pickup_datetime FROM rides""")
def stream_pass_through(spark, sf):
    def t(s):
        return s.select("PULocationID", "DOLocationID", "trip_distance", "total_amount",
                        F.timestamp_millis("tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"))
    return _append_query(spark, sf, "epoch", t)


@query("stream_pass_through_text", """SELECT PULocationID, DOLocationID, trip_distance, cast(total_amount AS double) AS total_amount,
date_trunc('second', event_ts) AS pickup_datetime FROM rides""")
def stream_pass_through_text(spark, sf):
    def t(s):
        return s.select("PULocationID", "DOLocationID", "trip_distance", "total_amount",
                        F.to_timestamp("lpep_pickup_datetime", SS.TEXT_TS_FORMAT).cast("timestamp_ntz")
                        .alias("pickup_datetime"))
    return _append_query(spark, sf, "text", t)


_TEXT_MSG_SQL = """SELECT strftime(date_trunc('second', event_ts), '%Y-%m-%d %H:%M:%S') AS lpep_pickup_datetime,
strftime(date_trunc('second', event_ts) + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS lpep_dropoff_datetime,
PULocationID, DOLocationID, passenger_count, trip_distance, cast(tip_amount AS double) AS tip_amount,
cast(total_amount AS double) AS total_amount FROM rides"""

# Messages of the later half of the weekly slices (the ones that arrive after
# a query started 'from latest').
_LATEST_WHERE = f""" WHERE floor((floor(epoch(event_ts)) - (SELECT min(floor(epoch(event_ts))) FROM rides)) / {SLICE_SECONDS})
>= (SELECT floor((floor((max(floor(epoch(event_ts))) - min(floor(epoch(event_ts)))) / {SLICE_SECONDS}) + 1) / 2) FROM rides)"""


@query("stream_source_earliest", _TEXT_MSG_SQL)
def stream_source_earliest(spark, sf):
    return _append_query(spark, sf, "text", lambda s: s)


@query("stream_source_latest", _TEXT_MSG_SQL + _LATEST_WHERE)
def stream_source_latest(spark, sf):
    """Only messages that arrive after the query first starts."""
    _, n = write_message_slices(spark, sf, "text", 0, 0)
    root, _ = write_message_slices(spark, sf, "text", 0, n // 2)
    ckpt = scratch_path(spark, "ckpt")
    src = SS.read_stream(spark, f"{root}/*/*.json", SS.RIDE_TEXT_SCHEMA, fmt="files",
                         max_per_trigger=files_per_trigger(spark, root))
    SS.skip_existing(src, ckpt)
    write_message_slices(spark, sf, "text", n // 2, None, root=root)
    sink = K.KeyedSink(scratch_path(spark, "sink"), [], src.schema)
    K.run_stream(src, sink, ckpt).awaitTermination()
    return sink.read(spark)


# ---------------------------------------------------------------- late data, flush, restart, sinks

@query("stream_late_drop", tumble_sql(300, "second"))
def stream_late_drop(spark, sf):
    """The first two weeks of messages are delivered again after everything
    else: their windows closed long before, so every one of them is dropped
    by the watermark and the windows equal those of the on-time data.
    (Rows only seconds behind the bound are tested exactly in pytest.)"""
    root, n = write_message_slices(spark, sf, "text")
    sink_path, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    run = lambda: run_windows(spark, root, "text", tumble_zone("5 minutes"), ["window_start", "PULocationID"], sink_path, ckpt)
    run()
    rides = fx.rides(spark, sf)
    epoch = F.unix_seconds(F.col("event_ts").cast("timestamp"))
    lo = rides.agg(F.min(epoch)).first()[0]
    late = SS.to_text_message(rides.where(F.floor((epoch - F.lit(lo)) / SLICE_SECONDS) == 0))
    late.coalesce(1).write.json(f"{root}/s={n:04d}")
    write_flush(spark, root, "text")
    sink, _ = run()
    return _ntz(sink.read(spark), "window_start")


@query("stream_flush", f"""SELECT (SELECT count(*) FROM ({tumble_sql(3600, 'second')}) w
WHERE w.window_start + INTERVAL 1 HOUR <= (SELECT max(date_trunc('second', event_ts)) FROM rides) - INTERVAL 5 SECOND)
AS windows_without_flush, (SELECT count(*) FROM ({tumble_sql(3600, 'second')})) AS windows_with_flush""")
def stream_flush(spark, sf):
    root, _ = write_message_slices(spark, sf, "text")
    without, _ = run_windows(spark, root, "text", tumble_zone("1 hour"), ["window_start", "PULocationID"])
    n_without = without.read(spark)
    write_flush(spark, root, "text")
    with_flush, _ = run_windows(spark, root, "text", tumble_zone("1 hour"), ["window_start", "PULocationID"])
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = n_without.select(one.alias("a"), zero.alias("b")).union(with_flush.read(spark).select(zero, one))
    return both.agg(F.sum("a").alias("windows_without_flush"), F.sum("b").alias("windows_with_flush"))


@query("stream_restart", tumble_sql(300, "second"))
def stream_restart(spark, sf):
    """Stop after the first half of the input, resume from the checkpoint:
    the sink equals one uninterrupted run."""
    _, n = write_message_slices(spark, sf, "text", 0, 0)
    root, _ = write_message_slices(spark, sf, "text", 0, max(1, n // 2))
    sink_path, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    run_windows(spark, root, "text", tumble_zone("5 minutes"), ["window_start", "PULocationID"], sink_path, ckpt)
    write_message_slices(spark, sf, "text", max(1, n // 2), None, root=root)
    write_flush(spark, root, "text")
    sink, _ = run_windows(spark, root, "text", tumble_zone("5 minutes"), ["window_start", "PULocationID"],
                          sink_path, ckpt)
    return _ntz(sink.read(spark), "window_start")


@query("stream_upsert", TIPS_SQL)
def stream_upsert(spark, sf):
    """Keyed upsert sink; a replayed micro-batch replaces its own rows."""
    root, _ = write_message_slices(spark, sf, "text")
    write_flush(spark, root, "text")
    sink, q = run_windows(spark, root, "text", tumble_tips, ["window_start"])
    ids = sink.pending(spark)
    if ids:
        copy = scratch_path(spark, "replay")
        spark.read.parquet(f"{sink.path}/batches/batch_id={ids[-1]}").write.parquet(copy)
        sink(spark.read.parquet(copy), ids[-1])  # the same batch delivered again
    sink.compact(spark, ids[-1] if ids else -1)
    return _ntz(sink.read(spark), "window_start")


# ---------------------------------------------------------------- T12 view over a windowed stream

@query("stream_view_insert", f"""SELECT window_start, PULocationID, num_trips FROM ({tumble_sql(300, "second")})
WHERE num_trips > 1""")
def stream_view_insert(spark, sf):
    """A temporary view over the windowed stream, and a streaming insert of
    a SQL query on that view into the keyed sink."""
    root, _ = write_message_slices(spark, sf, "text")
    write_flush(spark, root, "text")

    def build(df):
        view = f"windowed_{uuid.uuid4().hex[:8]}"
        tumble_zone("5 minutes")(df).createOrReplaceTempView(view)
        return spark.sql(f"SELECT window_start, PULocationID, num_trips FROM {view} WHERE num_trips > 1")

    sink, _ = run_windows(spark, root, "text", build, ["window_start", "PULocationID"])
    return _ntz(sink.read(spark), "window_start")
