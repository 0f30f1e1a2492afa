"""Load strategies on tables and file sources on hand-made files."""

import datetime as dt
import decimal
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareway.operators import key_summary as KS
from fareway.operators import loads as L
from fareway.session import scratch_path
from fareway.sources import files as src
from fareway.sources import versions as V
from fareway.sources import writers as W


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def _name(tag):
    import uuid
    return f"{tag}_{uuid.uuid4().hex[:8]}"


def test_strategies_idempotent_where_they_should_be(spark):
    base = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 10), (2, dt.datetime(2024, 2, 1), 20)],
                                 "k int, t timestamp_ntz, v int")
    run = spark.createDataFrame([(3, dt.datetime(2024, 2, 2), 30)], "k int, t timestamp_ntz, v int")
    name = _name("ti")
    L.materialize(base, "replace", name)
    for _ in range(2):  # the same run twice gives the same table
        L.materialize(run, "time_interval", name, time_col="t", start="2024-02-01", end="2024-03-01")
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [
        (1, dt.datetime(2024, 1, 1), 10), (3, dt.datetime(2024, 2, 2), 30)]

    name2 = _name("ap")
    L.materialize(base, "append", name2)
    L.materialize(base, "append", name2)  # append is not idempotent
    assert spark.table(name2).count() == 4

    name3 = _name("up")
    L.materialize(base, "replace", name3)
    upd = spark.createDataFrame([(2, dt.datetime(2024, 2, 1), 99)], "k int, t timestamp_ntz, v int")
    for _ in range(2):
        L.materialize(upd, "merge", name3, key="k")
    assert sorted(r.v for r in spark.table(name3).collect()) == [10, 99]


def test_merge_insert_only_twice_inserts_once(spark):
    name = _name("tgt")
    W.materialize_table(spark.createDataFrame([("a", 1)], "id string, v int"), name)
    src_df = spark.createDataFrame([("a", 9), ("b", 2), ("b", 3)], "id string, v int")
    assert L.merge_insert_only(name, src_df, "id") == 2
    assert L.merge_insert_only(name, src_df, "id") == 0
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("a", 1), ("b", 2), ("b", 3)]


def test_ingest_months_skips_missing_and_keeps_minimal_schema(spark):
    root = scratch_path(spark, "t-months")
    df = spark.createDataFrame([(1, 2.0)], "VendorID int, total_amount double")
    df.write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")
    df.write.parquet(f"{root}/yellow_tripdata_2024-03.parquet")
    now = dt.datetime(2024, 5, 1)
    out = src.ingest_months(spark, root, "2024-01-15", "2024-03-02", ["yellow", "green"], now)
    rows = sorted((r.filename, r.taxi_type) for r in out.collect())
    assert rows == [("yellow_tripdata_2024-01.parquet", "yellow"), ("yellow_tripdata_2024-03.parquet", "yellow")]
    empty = src.ingest_months(spark, root, "2030-01-01", "2030-02-01", ["yellow"], now)
    assert empty.columns == ["taxi_type", "filename", "ingested_at"] and empty.count() == 0


def test_json_records_single_document(spark):
    path = _local(scratch_path(spark, "t-json"))
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/doc.json", "w") as f:
        json.dump({"products": [{"brand": "A", "price": 1.5}, {"price": 2.0}]}, f, indent=2)
    schema = T.StructType([T.StructField("products", T.ArrayType(T.StructType([
        T.StructField("brand", T.StringType()), T.StructField("price", T.DoubleType())])))])
    got = sorted((tuple(r) for r in src.read_json_records(spark, path, "products", schema, multiline=True).collect()),
                 key=lambda r: r[1])
    assert got == [("A", 1.5), (None, 2.0)]


def test_external_csv_trailing_values_and_short_rows(spark):
    path = _local(scratch_path(spark, "t-csv"))
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/a.csv", "w") as f:
        f.write("a,b\n1,x,extra\n2\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    got = sorted(tuple(r) for r in src.external_table(spark, _name("ext"), "csv", path, schema).collect())
    assert got == [(1, "x"), (2, None)]


def test_seed_key_checked(spark):
    import pytest
    from fareway.operators.quality import CheckFailed

    path = _local(scratch_path(spark, "t-seed"))
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/s.csv", "w") as f:
        f.write("payment_type_id,payment_type_name\n1,Card\n1,Cash\n")
    schema = T.StructType([T.StructField("payment_type_id", T.IntegerType()),
                           T.StructField("payment_type_name", T.StringType())])
    with pytest.raises(CheckFailed):
        src.load_seed(spark, path, schema, "payment_type_id")


def test_copy_in_null_pads(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    target = T.StructType([T.StructField("id", T.StringType()), T.StructField("a", T.IntegerType()),
                           T.StructField("b", T.StringType())])
    assert tuple(src.copy_in(df, ["a", "b"], target).collect()[0]) == (None, 1, "x")
    assert F is not None


def test_revenue_job_writes_all_outputs_and_matches_query(spark, sf_small):
    from fareway.plans import fixtures as fx
    from fareway.plans.catalog_batch import SINCE, revenue_zones_df
    from fareway.plans.jobs import revenue_job

    out = scratch_path(spark, "t-revenue")
    paths = revenue_job(spark, fx.raw_trips(spark, sf_small, "green"), fx.raw_trips(spark, sf_small, "yellow"),
                        src.read_lookup_frame(fx.zones(spark, sf_small, id_as_string=True)), out, since=SINCE)
    assert set(paths) == {"green", "yellow", "total", "zones"}
    got = sorted(repr(tuple(r)) for r in spark.read.parquet(paths["zones"]).collect())
    want = sorted(repr(tuple(r)) for r in revenue_zones_df(spark, sf_small).collect())
    assert got == want and len(got) > 0


def test_ingest_months_schema_drift(spark):
    root = scratch_path(spark, "t-drift")
    spark.createDataFrame([(1, 2, 1.5)], "VendorID int, passenger_count int, Airport_fee double").write.parquet(
        f"{root}/yellow_tripdata_2024-01.parquet")
    spark.createDataFrame([(2, 3.0, 2.5)], "VendorID bigint, passenger_count double, airport_fee double").write.parquet(
        f"{root}/yellow_tripdata_2024-02.parquet")
    out = src.ingest_months(spark, root, "2024-01-01", "2024-02-28", ["yellow"], dt.datetime(2024, 3, 1))
    types = dict(out.dtypes)
    assert types["VendorID"] == "bigint" and types["passenger_count"] == "double"
    assert [c for c in out.columns if c.lower() == "airport_fee"] == ["Airport_fee"]
    got = sorted((r.VendorID, r.passenger_count, r.Airport_fee, r.filename) for r in out.collect())
    assert got == [(1, 2.0, 1.5, "yellow_tripdata_2024-01.parquet"), (2, 3.0, 2.5, "yellow_tripdata_2024-02.parquet")]


def test_incremental_fact_build(spark, sf_small):
    from fareway.operators import staging as S
    from fareway.plans import fixtures as fx
    from fareway.plans.jobs import build_fact_incremental, fct_trips, int_trips, int_trips_unioned

    trips = int_trips(int_trips_unioned(fx.raw_trips(spark, sf_small, "green"), fx.raw_trips(spark, sf_small, "yellow")),
                      fx.payment_lookup(spark))
    zones = S.dim_zones(fx.zones(spark, sf_small))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    name = _name("fct")
    build_fact_incremental(spark, name, trips.where(F.col("pickup_datetime") < cut), zones)
    n1 = spark.table(name).count()
    build_fact_incremental(spark, name, trips, zones)  # only newer trips are added
    build_fact_incremental(spark, name, trips, zones)  # nothing newer: unchanged
    full = fct_trips(trips, zones)
    assert n1 < spark.table(name).count() == full.count()
    assert spark.table(name).select("trip_id").distinct().count() == full.count()


def test_revenue_cli_on_files(spark, sf_small):
    from fareway.plans import fixtures as fx
    from fareway.plans.catalog_batch import SINCE, revenue_zones_df
    from fareway.plans.jobs import revenue_job
    from fareway.plans.revenue_cli import main  # noqa: F401 - importable entry point

    root = scratch_path(spark, "t-cli")
    for svc in ("green", "yellow"):
        fx.raw_trips(spark, sf_small, svc).write.parquet(f"{root}/pq/{svc}/2024/01")
    fx.zones(spark, sf_small, id_as_string=True).write.option("header", True).csv(f"{root}/zones")
    out = revenue_job(spark, src.read_trips(spark, f"{root}/pq/green/*/*"), src.read_trips(spark, f"{root}/pq/yellow/*/*"),
                      src.read_lookup(spark, f"{root}/zones"), f"{root}/report", since=SINCE, files=1)
    got = sorted(repr(tuple(r)) for r in spark.read.parquet(out["zones"]).collect())
    want = sorted(repr(tuple(r)) for r in revenue_zones_df(spark, sf_small).collect())
    assert got == want


def test_identity_keeps_every_digit(spark):
    df = spark.sql("""SELECT * FROM VALUES (timestamp_ntz'2024-01-01 00:00:00.1', 1.00000001D), (timestamp_ntz'2024-01-01 00:00:00.9', 1.00000001D),
        (timestamp_ntz'2024-01-01 00:00:00.1', 1.00000002D) AS t(ts, x)""")
    assert L.add_row_identity(df, ["ts", "x"]).select("unique_row_id").distinct().count() == 3


def test_append_and_merge_add_new_columns(spark):
    name = _name("grow")
    L.materialize(spark.createDataFrame([(1,)], "a int"), "replace", name)
    L.materialize(spark.createDataFrame([(2, "x")], "a int, b string"), "append", name)
    assert L.merge_insert_only(name, spark.createDataFrame([(2, "y", 1.5), (3, "z", 2.5)], "a int, b string, c double"), "a") == 1
    got = sorted((tuple(r) for r in spark.table(name).select("a", "b", "c").collect()), key=str)
    assert got == [(1, None, None), (2, "x", None), (3, "z", 2.5)]


def test_upsert_keeps_layout_and_untouched_partitions(spark):
    name = _name("parts")
    L.materialize(spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c")], "k int, v int, p string"), "replace", name,
                  partition_by=["p"])
    files = {r["p"]: r["f"] for r in spark.table(name).select("p", F.col("_metadata.file_path").alias("f")).collect()}
    L.merge_upsert(name, spark.createDataFrame([(1, 11, "b"), (4, 40, "b")], "k int, v int, p string"), "k")
    assert W.partition_columns(spark, name) == ["p"]
    assert sorted(tuple(r) for r in spark.table(name).select("k", "v", "p").collect()) == [
        (1, 11, "b"), (2, 20, "b"), (3, 30, "c"), (4, 40, "b")]
    after = {r["p"]: r["f"] for r in spark.table(name).select("p", F.col("_metadata.file_path").alias("f")).collect()}
    assert after["c"] == files["c"] and after["b"] != files["b"] and "a" not in after


def _rows(spark, name, *cols):
    return sorted((tuple(r) for r in spark.table(name).select(*cols).collect()), key=str)


def test_deleted_rows_stay_deleted(spark):
    """A partition that a merge empties does not come back with the next append to it."""
    name = _name("moved")
    L.materialize(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, p int"), "replace", name, partition_by=["p"])
    L.merge_upsert(name, spark.createDataFrame([(1, "moved", 2)], "k int, v string, p int"), "k")
    assert _rows(spark, name, "k", "v", "p") == [(1, "moved", 2), (2, "b", 2)]
    L.append_rows(name, spark.createDataFrame([(3, "new", 1)], "k int, v string, p int"))
    assert _rows(spark, name, "k", "v", "p") == [(1, "moved", 2), (2, "b", 2), (3, "new", 1)]


def test_partition_values_of_any_text(spark):
    values = ["O'Hare", "a/b c", "50%", "back\\slash", "é", 'quote"', None, "x=y", "plus+"]
    name = _name("texts")
    L.materialize(spark.createDataFrame([(i, i, v) for i, v in enumerate(values)], "k int, v int, p string"), "replace", name,
                  partition_by=["p"])
    for _ in range(2):
        L.merge_upsert(name, spark.createDataFrame([(i, 10 * i, v) for i, v in enumerate(values)], "k int, v int, p string"), "k")
    assert _rows(spark, name, "k", "v", "p") == sorted(((i, 10 * i, v) for i, v in enumerate(values)), key=str)
    L.merge_upsert(name, spark.createDataFrame([(i, 1, "one") for i in range(len(values))], "k int, v int, p string"), "k")
    assert _rows(spark, name, "k", "v", "p") == [(i, 1, "one") for i in range(len(values))]


@pytest.mark.parametrize("fail_at", [0, 1, 2])
def test_failed_switch_leaves_old_or_new_and_is_finished_later(spark, monkeypatch, fail_at):
    name = _name("broken")
    old = [(i, "old", i % 3) for i in range(9)]
    L.materialize(spark.createDataFrame(old, "k int, v string, p int"), "replace", name, partition_by=["p"])
    new = spark.createDataFrame([(i, "new", i % 3) for i in range(6)] + [(8, "new", 0)], "k int, v string, p int")
    apply = V._apply

    def broken(spark, table, steps):
        apply(spark, table, steps[:fail_at])
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(V, "_apply", broken)
    with pytest.raises(RuntimeError):
        L.merge_upsert(name, new, "k")
    monkeypatch.undo()
    spark.catalog.refreshTable(name)
    want = {k: (k, "new", p) for k, _, p in [(i, "", i % 3) for i in range(6)] + [(8, "", 0)]} | {6: (6, "old", 0), 7: (7, "old", 1)}
    for p in range(3):  # each partition is as before or as it will be
        now = sorted(r for r in _rows(spark, name, "k", "v", "p") if r[2] == p)
        assert now in (sorted(r for r in old if r[2] == p), sorted(r for r in want.values() if r[2] == p))
    L.append_rows(name, spark.createDataFrame([(20, "later", 1)], "k int, v string, p int"))
    assert _rows(spark, name, "k", "v", "p") == sorted([*want.values(), (20, "later", 1)], key=str)


def test_superseded_folders_are_removed(spark):
    name = _name("clean")
    L.materialize(spark.createDataFrame([(i, i, i % 3) for i in range(9)], "k int, v int, p int"), "replace", name, partition_by=["p"])
    before = set(V.folders(spark.table(name), ["p"]).values())
    L.merge_upsert(name, spark.createDataFrame([(1, 100, 1)], "k int, v int, p int"), "k")
    after = V.folders(spark.table(name), ["p"])
    gone = before - set(after.values())
    assert len(gone) == 1 and not any(V.children(spark, f) for f in gone)
    assert all(V.children(spark, f) for f in after.values())
    assert not [f for f in V.children(spark, V.side_folder(spark, name)) if "/switch-" in f]


@pytest.mark.parametrize("partition_by", [None, ["p"]])
def test_failing_replace_keeps_the_table(spark, monkeypatch, partition_by):
    name = _name("kept")
    L.materialize(spark.createDataFrame([(1, 1)], "k int, p int"), "replace", name, partition_by=partition_by)
    first = V.location(spark, name)
    monkeypatch.setattr(W, "swap_table", lambda *a: (_ for _ in ()).throw(RuntimeError("no catalog")))
    with pytest.raises(RuntimeError):
        L.materialize(spark.createDataFrame([("x", 2)], "other string, p int"), "replace", name, partition_by=["p"])
    assert _rows(spark, name, "k", "p") == [(1, 1)]
    monkeypatch.undo()
    L.materialize(spark.createDataFrame([("x", 2)], "other string, p int"), "replace", name, partition_by=["p"])
    assert _rows(spark, name, "other", "p") == [("x", 2)] and W.partition_columns(spark, name) == ["p"]
    assert not V.children(spark, first)


def test_partitioned_time_interval_and_delete_insert(spark):
    t = lambda m, d: dt.datetime(2024, m, d)
    base = spark.createDataFrame([(1, t(1, 5), 1), (2, t(2, 5), 2), (3, t(2, 25), 2), (4, t(3, 5), 3)], "k int, t timestamp_ntz, m int")
    name = _name("pti")
    L.materialize(base, "replace", name, partition_by=["m"])
    untouched = V.folders(spark.table(name), ["m"])
    run = spark.createDataFrame([(9, t(2, 7), 2), (8, t(3, 30), 3)], "k int, t timestamp_ntz, m int")
    for _ in range(2):
        L.materialize(run, "time_interval", name, time_col="t", start="2024-02-01", end="2024-02-20")
    assert _rows(spark, name, "k", "m") == [(1, 1), (3, 2), (4, 3), (9, 2)]
    now = V.folders(spark.table(name), ["m"])
    assert now[1,] == untouched[1,] and now[3,] == untouched[3,] and now[2,] != untouched[2,]
    L.materialize(spark.createDataFrame([(3, t(1, 1), 1), (3, t(3, 1), 3)], "k int, t timestamp_ntz, m int"), "delete_insert", name, key="k")
    assert _rows(spark, name, "k", "m") == [(1, 1), (3, 1), (3, 3), (4, 3), (9, 2)]


def test_load_adds_columns_to_a_partitioned_table(spark):
    name = _name("wide")
    L.materialize(spark.createDataFrame([(1, 1), (2, 2)], "k int, p int"), "replace", name, partition_by=["p"])
    before = V.folders(spark.table(name), ["p"])
    L.merge_upsert(name, spark.createDataFrame([(2, "x", 2)], "k int, extra string, p int"), "k")
    assert _rows(spark, name, "k", "extra", "p") == [(1, None, 1), (2, "x", 2)]
    assert V.folders(spark.table(name), ["p"])[1,] == before[1,]


def test_truncate_load_and_file_load_add_columns(spark):
    name = _name("stage")
    W.ensure_table(spark, name, T.StructType([T.StructField("a", T.IntegerType())]))
    W.truncate_load(spark, spark.createDataFrame([(1, "x")], "a int, b string"), name)
    assert _rows(spark, name, "a", "b") == [(1, "x")]


def test_merge_reads_only_files_that_may_hold_its_keys(spark):
    name = _name("big")
    month = lambda m: spark.range(40).select(
        F.md5(F.concat_ws("-", F.lit(m), "id")).alias("k"), F.lit(dt.datetime(2024, m, 1)).cast("timestamp_ntz").alias("t"), F.col("id"))
    W.ensure_table(spark, name, month(1).schema)
    read = []
    for m in range(1, 7):
        assert L.merge_insert_only(name, month(m), "k", within=["t"]) == 40
        read.append(len(KS.may_hold(name, month(m), ["k"], ["k", "t"])))
    assert len(KS.file_names(spark.table(name))) >= 6 and len(set(read)) == 1  # as many files for the sixth month as for the first
    assert L.merge_insert_only(name, month(2), "k", within=["t"]) == 0
    assert L.merge_insert_only(name, month(2).unionByName(month(9).limit(3)), "k", within=["t"]) == 3
    # Without columns that go with the key, the bitmaps tell files apart.
    hold = KS.may_hold(name, month(4).where("id in (3, 30)"), ["k"], ["k"])
    assert 1 <= len(hold) <= 3
    scan = spark.table(name).where(F.col("_metadata.file_path").isin(sorted(hold)))
    assert scan.join(month(4), "k", "left_semi").count() >= 2


def test_merge_keeps_rows_with_null_keys_and_nulls_beside_keys(spark):
    name = _name("nulls")
    W.materialize_table(spark.createDataFrame([("a", None, 1), ("b", 5, 2)], "k string, w int, v int"), name)
    src = spark.createDataFrame([("a", None, 9), (None, None, 3), ("c", None, 4), ("b", 5, 7)], "k string, w int, v int")
    assert L.merge_insert_only(name, src, "k", within=["w"]) == 2
    assert _rows(spark, name, "k", "w", "v") == sorted([("a", None, 1), ("b", 5, 2), (None, None, 3), ("c", None, 4)], key=str)


def test_widest_decimal():
    a, b = T.DecimalType(18, 2), T.DecimalType(18, 3)
    out = src.canonical_columns([T.StructType([T.StructField("x", t)]) for t in (a, b, T.LongType())])
    assert out["x"].dataType == T.DecimalType(22, 3)
    assert src.canonical_columns([T.StructType([T.StructField("x", t)]) for t in (T.DecimalType(38, 10), T.LongType(), T.DecimalType(
        38, 2))])["x"].dataType == T.StringType()  # no decimal holds 36 digits before the point and 10 after it


def test_drifting_numbers_keep_every_digit(spark):
    big = 2**60 + 1
    cases = [([3, 4], [1.5], "double"), ([big], [2.0, 3.0], "bigint"), ([big], [0.25], "decimal(38,18)"), ([big], [1e300], "string")]
    for i, (whole, real, want) in enumerate(cases):
        root = scratch_path(spark, "t-digits")
        spark.createDataFrame([(x,) for x in whole], "x bigint").coalesce(1).write.parquet(f"{root}/a")
        spark.createDataFrame([(x,) for x in real], "x double").coalesce(1).write.parquet(f"{root}/b")
        out = src.read_schema_groups(spark, [f"{root}/a", f"{root}/b"])
        assert dict(out.dtypes)["x"] == want, i
        if want != "double":
            assert str(big) in {str(r.x).split(".")[0] for r in out.collect()}
        assert out.count() == len(whole) + len(real)


def test_drift_is_found_by_halving(spark, monkeypatch):
    root = scratch_path(spark, "t-many")
    paths = []
    for i in range(16):
        name = "fee" if i < 11 else "Fee"
        spark.createDataFrame([(i, 0.5)], f"id {'int' if i < 5 else 'bigint'}, {name} double").coalesce(1).write.parquet(f"{root}/f{i:02d}")
        paths.append(f"{root}/f{i:02d}")
    groups = src.schema_groups(spark, paths)
    assert sorted(p for _, ps in groups for p in ps) == paths and len(groups) <= 3
    out = src.read_schema_groups(spark, paths)
    assert out.columns[:2] == ["id", "fee"] and sorted(r.id for r in out.collect()) == list(range(16))
    assert out.agg(F.sum("fee")).first()[0] == 8.0


def test_warehouse_connector_commits_and_aborts(spark):
    from fareway.sources import warehouse as H

    path = _local(scratch_path(spark, "t-warehouse"))
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("int").alias("m"), F.lit(dt.datetime(2024, 1, 1)).cast(
        "timestamp_ntz").alias("t"), F.col("id").cast("decimal(18,3)").alias("d"))
    assert W.write_table(df, "reports.x", location=path).exceptAll(df).count() == 0
    H.write(df.where("id < 10"), path, mode="append")
    assert H.read(spark, path).count() == 1010
    before = sorted(os.listdir(f"{path}/data"))
    bad = df.withColumn("m", F.when(F.col("id") == 999, F.raise_error(F.lit("broken row")).cast("int")).otherwise(F.col("m")))
    with pytest.raises(Exception, match="broken row"):
        H.write(bad.repartition(4), path)
    assert H.read(spark, path).count() == 1010  # the table is as it was, and the write left nothing
    assert sorted(os.listdir(f"{path}/data")) == before and sorted(os.listdir(path)) == ["data", "manifest.json"]
    H.write(df.where("id < 3"), path)
    assert sorted(r.id for r in H.read(spark, path).collect()) == [0, 1, 2] and len(os.listdir(f"{path}/data")) <= 3
    H.write(df.limit(0), path)
    assert H.read(spark, path).count() == 0 and H.read(spark, path).dtypes == df.dtypes
    with pytest.raises(Exception):
        H.write(bad, f"{path}-new")
    assert not os.path.exists(f"{path}-new/manifest.json")


def test_sums_of_doubles_do_not_depend_on_order(spark):
    from fareway.operators import reports as R
    from fareway.streaming import windows as WN

    rows = [(dt.datetime(2024, 1, 1, i % 3), i % 2, v) for i, v in enumerate([0.1234567, 1e9 + 0.0000001, -1e9, 1e-7, 0.3, 12345.6789012] * 40)]
    exact = {}
    for t, z, v in rows:
        exact[t, z] = exact.get((t, z), 0) + decimal.Decimal(repr(v))
    seen, streamed = set(), set()
    for n in (1, 3, 16):
        df = spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, PULocationID int, total_amount double").repartition(n)
        got = {(r.hour, r.zone_id): r.x_amount for r in R.revenue_hourly(df, "x").collect()}
        assert got == {k: v.quantize(decimal.Decimal("0.01"), decimal.ROUND_HALF_UP) for k, v in exact.items()}
        seen.add(str(sorted(got.items())))
        w = WN.tumbling(df, "pickup_datetime", "1 hour", ["PULocationID"], WN.ride_window_aggs(df))
        sums = {(r.window_start, r.PULocationID): r.total_revenue for r in w.collect()}
        assert sums == {k: float(v) for k, v in exact.items()}
        streamed.add(str(sorted(sums.items())))
    assert len(seen) == len(streamed) == 1


def _refused(*args, **kwargs):
    raise AssertionError("not for large tables")


def test_summaries_hold_no_file_in_one_python_task(spark, monkeypatch):
    from pyspark.sql import GroupedData

    monkeypatch.setattr(GroupedData, "applyInPandas", _refused)
    name = _name("wholefile")
    rows = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"))
    W.materialize_table(rows.coalesce(1), name)
    assert L.merge_insert_only(name, spark.range(2990, 3010).select(F.md5(F.col("id").cast("string")).alias("k"), "id"), "k") == 10
    for r in KS.known(spark, name, ["k"]).collect():
        file = spark.table(name).where(F.col("_metadata.file_path") == r["file"])
        lo, hi, n = file.agg(F.min("k"), F.max("k"), F.count("*")).first()
        assert (r["lo_k"], r["hi_k"], r["rows"], r["nulls_k"]) == (lo, hi, n, 0) and len(r["bitmap"]) * 8 == KS._bits(n)
        want = np.zeros(KS._bits(n), bool)
        for at in KS._slots(file.select(KS._hash(["k"]).alias("h")).toArrow()["h"].to_numpy(), len(want)):
            want[at] = True
        assert bytes(r["bitmap"]) == np.packbits(want).tobytes()


def test_bitmaps_of_a_file_that_many_tasks_read(spark):
    hashes = spark.range(5000).select((F.col("id") % 3).cast("int").alias("_no"), F.xxhash64("id").alias("h"))
    bits = {0: KS.MIN_BITS, 1: 1 << 17, 2: 1 << 15, 9: KS.MIN_BITS}
    got = {r["_no"]: bytes(r["bitmap"]) for r in KS.bitmaps(hashes.repartition(5), bits).collect()}
    assert sorted(got) == [0, 1, 2]
    for no in got:
        want = np.zeros(bits[no], bool)
        for at in KS._slots(hashes.where(F.col("_no") == no).toArrow()["h"].to_numpy(), bits[no]):
            want[at] = True
        assert got[no] == np.packbits(want).tobytes()


def test_report_of_n_files_shuffles_no_rows(spark, monkeypatch):
    monkeypatch.setattr(W, "PART_ROWS", 100)
    rows = spark.range(0, 4000, 1, 5).select("id", F.col("id").cast("string").alias("t"), (F.col("id") % 3).alias("m"))
    few = W.write_report(rows.limit(150), scratch_path(spark, "t-few"), files=4)  # fewer parts than it takes: rows are dealt
    assert len([f for f in os.listdir(_local(few)) if f.endswith(".parquet")]) == 4 and spark.read.parquet(few).count() == 150
    from pyspark.sql.classic.dataframe import DataFrame
    monkeypatch.setattr(DataFrame, "repartition", _refused)
    path = W.write_report(rows, scratch_path(spark, "t-n"), files=4)
    back = spark.read.parquet(path)
    sizes = [r["count"] for r in back.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) == 4 and min(sizes) >= 800 and back.exceptAll(rows).count() == 0 and back.count() == 4000
    parts = W.write_report(rows, scratch_path(spark, "t-np"), files=2, partition_by=["m"])
    assert spark.read.parquet(parts).groupBy("m").agg(F.count_distinct(F.col("_metadata.file_path")).alias("n")).where("n > 2").count() == 0


def test_keys_of_a_large_load_are_not_listed(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    name = _name("manykeys")
    W.materialize_table(spark.range(50).select(F.col("id").cast("string").alias("k")), name)
    monkeypatch.setattr(KS, "MAX_KEYS", 10)
    monkeypatch.setattr(DataFrame, "toArrow", _refused)
    assert L.merge_insert_only(name, spark.range(1000).select(F.col("id").cast("string").alias("k")), "k") == 950


def test_touched_partitions_by_value_and_by_key(spark):
    name = _name("touched")
    rows = [(1, 1), (2, 1), (3, 2), (4, None), (5, 3), (6, 4)]
    L.materialize(spark.createDataFrame(rows, "k int, p int"), "replace", name, partition_by=["p"])
    source = spark.createDataFrame([(5, 1), (7, None), (8, 9)], "k int, p int")
    touched = L.touched_rows(name, source, "k")
    assert set(touched.folders) == {(1,), (None,), (3,)}
    assert sorted(r.k for r in touched.rows.collect()) == [1, 2, 4, 5]
    L.merge_upsert(name, source, "k")
    assert _rows(spark, name, "k", "p") == sorted([(1, 1), (2, 1), (3, 2), (4, None), (5, 1), (6, 4), (7, None), (8, 9)], key=str)


def test_partitioned_upsert_chooses_its_rows_once(spark, sf_small, monkeypatch):
    from fareway.plans import catalog_loads as C

    seen, merge = [], L.merge_upsert
    monkeypatch.setattr(L, "merge_upsert", lambda name, moved, key: seen.append(moved) or merge(name, moved, key))
    C.upsert_partitioned(spark, sf_small)
    assert "Window" not in seen[0]._jdf.queryExecution().toString()
