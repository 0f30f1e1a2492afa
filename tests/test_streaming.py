"""Streaming: windows, exact-gap sessions, flush, late data, restart, global sessions."""

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from fareway.session import scratch_path
from fareway.sources import versions as V
from fareway.streaming import sessions as GS
from fareway.streaming import sinks as K
from fareway.streaming import sources as SS
from fareway.streaming import windows as WN

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _msg(sec, zone, amount=1.0):
    t = (T0 + dt.timedelta(seconds=sec)).strftime("%Y-%m-%d %H:%M:%S")
    return {"lpep_pickup_datetime": t, "lpep_dropoff_datetime": t, "PULocationID": zone, "DOLocationID": zone,
            "passenger_count": 1, "trip_distance": 1.0, "tip_amount": amount / 10, "total_amount": amount}


def _write(root, name, msgs):
    os.makedirs(f"{root}/{name}", exist_ok=True)
    with open(f"{root}/{name}/part.json", "w") as f:
        for m in msgs:
            f.write(json.dumps(m) + "\n")


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _run(spark, root, build, key, ckpt=None, sink_path=None):
    src = SS.read_stream(spark, f"{root}/*/*.json", SS.RIDE_TEXT_SCHEMA, max_per_trigger=1)
    timed = SS.with_event_time(src, "5 seconds", text_col="lpep_pickup_datetime")
    sink = K.KeyedSink(sink_path or scratch_path(spark, "t-sink"), key)
    q = K.run_stream(build(timed), sink, ckpt or scratch_path(spark, "t-ckpt"))
    q.awaitTermination()
    return sink, q


def _sessions(df):
    return WN.sessions(df, "event_timestamp", "5 minutes", ["PULocationID"])


def test_session_exact_gap_merges_and_flush_closes(spark):
    root = _local(scratch_path(spark, "t-in"))
    _write(root, "b0", [_msg(0, 1), _msg(300, 1), _msg(1000, 1), _msg(0, 2)])
    sink, _ = _run(spark, root, _sessions, ["PULocationID", "session_start"])
    before = sink.read(spark)
    # nothing closed yet except what the watermark (max - 5 s) passed
    n_before = 0 if before is None else before.count()
    _write(root, "b9", [_msg(10 ** 8, -1)])  # flush message
    sink, _ = _run(spark, root, _sessions, ["PULocationID", "session_start"])
    got = sorted((r.PULocationID, r.num_trips) for r in sink.read(spark).collect())
    assert got == [(1, 1), (1, 2), (2, 1)]  # 0 and 300 s merge (exactly one gap apart)
    assert n_before < 3


def test_late_rows_behind_closed_window_are_dropped(spark):
    """A row older than the watermark whose window was already emitted is
    dropped (and counted); rows within the 5 s bound are kept."""
    root = _local(scratch_path(spark, "t-in"))
    _write(root, "b0", [_msg(0, 1), _msg(400, 1)])
    _write(root, "b1", [_msg(395, 1)])  # 5 s behind the newest: on time
    _write(root, "b2", [_msg(100, 1), _msg(410, 1)])  # 300 s late: window [0, 5 min) closed in b1
    _write(root, "b3", [_msg(10 ** 8, -1)])
    build = lambda df: WN.tumbling(df, "event_timestamp", "5 minutes", ["PULocationID"], WN.ride_window_aggs(df))  # noqa
    sink, q = _run(spark, root, build, ["window_start", "PULocationID"])
    got = sorted((r.window_start.minute, r.num_trips) for r in sink.read(spark).collect())
    assert got == [(0, 1), (5, 3)]
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_restart_from_checkpoint_equals_single_run(spark):
    msgs = [_msg(i * 37, i % 3, float(i)) for i in range(200)]
    build = lambda df: WN.tumbling(df, "event_timestamp", "5 minutes", ["PULocationID"], WN.ride_window_aggs(df))  # noqa
    root = _local(scratch_path(spark, "t-in"))
    _write(root, "b0", msgs[:100])
    ckpt, sink_path = scratch_path(spark, "t-ckpt"), scratch_path(spark, "t-sink")
    _run(spark, root, build, ["window_start", "PULocationID"], ckpt, sink_path)
    _write(root, "b1", msgs[100:])
    _write(root, "b2", [_msg(10 ** 8, -1)])
    sink, _ = _run(spark, root, build, ["window_start", "PULocationID"], ckpt, sink_path)
    resumed = sorted(tuple(r) for r in sink.read(spark).collect())
    root2 = _local(scratch_path(spark, "t-in"))
    _write(root2, "b0", msgs)
    _write(root2, "b1", [_msg(10 ** 8, -1)])
    once, _ = _run(spark, root2, build, ["window_start", "PULocationID"])
    assert resumed == sorted(tuple(r) for r in once.read(spark).collect())


def _brute_global_sessions(events, gap):
    times = sorted({t for t, _ in events})
    start, sess = None, {}
    prev = None
    for t in times:
        if prev is None or (t - prev).total_seconds() > gap:
            start = t
        sess[t] = start
        prev = t
    ends = {}
    for t, s in sess.items():
        ends[s] = max(ends.get(s, t), t)
    out = {}
    for t, z in events:
        s = sess[t]
        k = (s, ends[s] + dt.timedelta(seconds=gap), z)
        out[k] = out.get(k, 0) + 1
    return sorted((a, b, z, n) for (a, b, z), n in out.items())


def test_global_sessions_match_brute_force(spark):
    rnd = random.Random(7)
    events, t = [], T0
    for _ in range(3000):
        t += dt.timedelta(seconds=rnd.choice([0, 10, 60, 299, 300, 301, 900]))
        events.append((t, rnd.randrange(5)))
    hot = events[1000][0]
    events += [(hot, 9)] * 1500  # one timestamp holding a third of the rows
    df = spark.createDataFrame(events, "ts timestamp_ntz, zone int")
    for slices in (1, 4, 16):
        got = sorted(tuple(r) for r in GS.global_session_counts(df, "ts", 300, ["zone"], slices=slices).collect())
        assert got == _brute_global_sessions(events, 300)


def test_keyed_sink_replay_is_idempotent(spark):
    sink = K.KeyedSink(scratch_path(spark, "t-sink"), ["k"])
    b = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    sink(b, 0)
    sink(b, 0)
    sink(spark.createDataFrame([(2, 25)], "k int, v int"), 1)
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == [(1, 10), (2, 25)]


def _brute_keyed_sessions(events, gap):
    by_key = {}
    for t, k, z in events:
        by_key.setdefault(k, []).append((t, z))
    out = []
    for k, rows in by_key.items():
        sub = _brute_global_sessions(rows, gap)
        out += [(k, a, b, z, n) for a, b, z, n in sub]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_keyed_sessions_split_a_hot_key_and_match_brute_force(spark):
    rnd = random.Random(11)
    events, t = [], T0
    for _ in range(2000):
        t += dt.timedelta(seconds=rnd.choice([0, 20, 120, 299, 300, 301, 1200]))
        k = 7 if rnd.random() < 0.4 else rnd.choice([1, 2, 3, None])  # key 7 holds ~40% of rows
        events.append((t, k, rnd.randrange(3)))
    df = spark.createDataFrame(events, "ts timestamp_ntz, k int, zone int")
    want = _brute_keyed_sessions(events, 300)
    for slices in (1, 5, 13):
        got = GS.session_counts(df, "ts", 300, ["k"], ["zone"], slices=slices).collect()
        got = sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
        assert got == want


def test_keyed_sessions_continue_across_slices(spark):
    # key 1 at the end of one slice and the start of the next, no gap: one session
    events = [(T0 + dt.timedelta(seconds=60 * i), k, 0) for k in (1, 2) for i in range(40)]
    df = spark.createDataFrame(events, "ts timestamp_ntz, k int, zone int")
    want = _brute_keyed_sessions(events, 300)
    for slices in (2, 3, 7, 40):
        got = sorted(tuple(r) for r in GS.session_counts(df, "ts", 300, ["k"], ["zone"], slices=slices).collect())
        assert got == want


def test_keyed_sink_compacts_and_keeps_the_newest_row(spark):
    sink = K.KeyedSink(scratch_path(spark, "t-sink"), ["k"], "k int, v int", compact_every=3, buckets=4)
    assert sink.read(spark).count() == 0 and sink.read(spark).dtypes == [("k", "int"), ("v", "int")]
    want = {}
    for i in range(11):
        rows = [(k, 100 * i + k) for k in range(i % 4, 20, 3)]
        want |= dict(rows)
        sink(spark.createDataFrame(rows, "k int, v int"), i)
        assert dict(tuple(r) for r in sink.read(spark).collect()) == want
        assert len(sink.pending(spark)) <= 4  # a read touches one snapshot and a bounded number of batches
    upto = sink._pointer(spark)["upto"]
    assert upto > 0
    sink(spark.createDataFrame([(1, -1)], "k int, v int"), upto)  # a merged batch delivered again changes nothing
    assert dict(tuple(r) for r in sink.read(spark).collect()) == want
    sink(spark.createDataFrame([(1, 7)], "k int, v int"), 10)  # the last batch replaces its own rows
    assert dict(tuple(r) for r in sink.read(spark).collect())[1] == 7
    assert len(V.children(spark, f"{sink.path}/current")) == 1


def test_keyed_sink_crash_before_the_pointer(spark, monkeypatch):
    sink = K.KeyedSink(scratch_path(spark, "t-sink"), ["k"], compact_every=100)
    for i in range(4):
        sink(spark.createDataFrame([(i % 2, i), (9, i)], "k int, v int"), i)
    monkeypatch.setattr(sink, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    before = sorted(tuple(r) for r in sink.read(spark).collect())
    try:
        sink.compact(spark, 3)
    except RuntimeError:
        pass
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == before == [(0, 2), (1, 3), (9, 3)]
    monkeypatch.undo()
    sink.compact(spark, 3)
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == before and not sink.pending(spark)


def _stream_sessions(spark, root, keys, count_keys, gap=300):
    src = SS.with_event_time(SS.read_stream(spark, f"{root}/*/*.json", SS.RIDE_TEXT_SCHEMA, max_per_trigger=1), "5 seconds",
                             text_col="lpep_pickup_datetime")
    sink = K.KeyedSink(scratch_path(spark, "t-sink"), [*keys, "session_start", *count_keys])
    writer = GS.SessionStream(scratch_path(spark, "t-state"), sink, "event_timestamp", gap, keys, count_keys, slices=6)
    sink.schema = writer.schema(src)
    K.run_stream(src, writer, scratch_path(spark, "t-ckpt")).awaitTermination()
    return sink.read(spark)


def _streamed(seed, hot):
    """Messages in time order, in batches that cut sessions; ``hot`` of them in one zone."""
    rnd, events, t = random.Random(seed), [], 0
    for _ in range(900):
        t += rnd.choice([0, 10, 60, 299, 300, 301, 900])
        events.append((t, 1 if rnd.random() < hot else rnd.randrange(2, 5)))
    return events


def test_session_stream_by_key_with_a_hot_zone(spark):
    events = _streamed(3, 0.4)
    root = _local(scratch_path(spark, "t-in"))
    for i in range(3):
        _write(root, f"b{i}", [_msg(t, z) for t, z in events[300 * i:300 * (i + 1)]])
        os.utime(f"{root}/b{i}/part.json", (1_700_000_000 + i, 1_700_000_000 + i))
    _write(root, "b9", [_msg(10 ** 8, -1)])
    os.utime(f"{root}/b9/part.json", (1_700_000_100, 1_700_000_100))
    got = sorted((r.PULocationID, r.session_start, r.session_end, r.num_trips) for r in _stream_sessions(
        spark, root, ["PULocationID"], []).collect())
    at = lambda t: T0 + dt.timedelta(seconds=t)
    want = []
    for z in {z for _, z in events}:
        want += [(z, a, b, n) for a, b, _, n in _brute_global_sessions([(at(t), 0) for t, y in events if y == z], 300)]
    assert got == sorted(want)


def test_global_session_stream(spark):
    events = _streamed(5, 0.4)
    root = _local(scratch_path(spark, "t-in"))
    for i in range(3):
        _write(root, f"b{i}", [_msg(t, z) for t, z in events[300 * i:300 * (i + 1)]])
        os.utime(f"{root}/b{i}/part.json", (1_700_000_000 + i, 1_700_000_000 + i))
    _write(root, "b9", [_msg(10 ** 8, -1)])
    os.utime(f"{root}/b9/part.json", (1_700_000_100, 1_700_000_100))
    got = sorted((r.session_start, r.session_end, r.PULocationID, r.num_trips) for r in _stream_sessions(
        spark, root, [], ["PULocationID"]).collect())
    assert got == _brute_global_sessions([(T0 + dt.timedelta(seconds=t), z) for t, z in events], 300)


def test_session_stream_replay_late_rows_and_empty_batches(spark):
    sink = K.KeyedSink(scratch_path(spark, "t-sink"), ["z", "session_start"], "z int, session_start timestamp, session_end timestamp, num_trips bigint")
    writer = GS.SessionStream(scratch_path(spark, "t-state"), sink, "t", 300, ["z"], [])
    batch = lambda *rows: spark.createDataFrame([(T0 + dt.timedelta(seconds=s), z) for s, z in rows], "t timestamp, z int")
    none = spark.createDataFrame([], "t timestamp, z int")
    writer(none, 0)
    writer(batch((0, 1), (100, 1)), 1)
    for _ in range(2):  # delivered again: the same state and output
        writer(batch((350, 1), (2000, 2)), 2)
    writer(batch((1600, 1), (1700, 2)), 3)  # 1600 + 300 is before 2000 - 5: late; 1700 + 300 is not
    writer(none, 4)
    writer(batch((10 ** 6, 9)), 5)
    got = sorted((r.z, (r.session_start - T0).total_seconds(), (r.session_end - T0).total_seconds(), r.num_trips) for r in sink.read(spark).collect())
    assert got == [(1, 0, 650, 3), (2, 1700, 2300, 2)]


def test_hot_zone_is_split_by_time(spark):
    """A zone with a third of all events: no slice holds much more than its share."""
    events = [(T0 + dt.timedelta(seconds=11 * i), 1 if i % 3 == 0 else i % 50) for i in range(6000)]
    df = spark.createDataFrame(events, "ts timestamp, z int").select("z", GS._micros("ts").alias("_lo"), GS._micros("ts").alias("_hi"))
    sizes = df.distinct().repartitionByRange(12, "z", "_lo", "_hi").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) <= 2 * 6000 / 12
    got = GS.sessionize(df, ["z"], 300_000_000, slices=12)
    assert got.where("z = 1").select("_sess").distinct().count() == 1


def test_empty_messages(spark, tmp_path):
    from fareway.plans import catalog_stream as C

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    for q in (C.stream_tumble_5m, C.stream_session_global, C.stream_session_keyed, C.stream_upsert, C.stream_pass_through):
        assert q(spark, str(tmp_path)).count() == 0
