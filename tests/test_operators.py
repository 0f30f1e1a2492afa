"""Operators on hand-made frames: nulls, ties, duplicates, empty inputs."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fareway.functions import columns as X
from fareway.operators import joins as J
from fareway.operators import loads as L
from fareway.operators import quality as Q
from fareway.operators import reports as R
from fareway.operators import staging as S
from fareway.operators.dedup import dedup_first

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def ts(sec):
    return T0 + dt.timedelta(seconds=sec)


def test_duration_counts_minute_boundaries(spark):
    df = spark.createDataFrame([(ts(59), ts(60)), (ts(0), ts(59)), (ts(0), ts(3600))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(X.trip_duration_minutes("a", "b")).collect()]
    assert got == [1, 0, 60]


def test_payment_and_vendor_labels(spark):
    df = spark.createDataFrame([("1",), ("6",), ("9",), ("x",), (None,)], "p string")
    assert [r[0] for r in df.select(X.payment_description("p")).collect()] == [
        "Credit card", "Voided trip", "EMPTY", "EMPTY", "EMPTY"]
    v = spark.createDataFrame([(1,), (3,), (None,)], "v int")
    assert [r[0] for r in v.select(X.vendor_name("v")).collect()] == ["Creative Mobile Technologies", None, None]


def test_vendor_code_matches_python_rule(spark):
    df = spark.createDataFrame([(1,), (2,), (7,), (None,)], "v int")
    got = [r[0] for r in df.select(X.vendor_code("v")).collect()]

    def rule(v):
        n = v + 1
        return f"s/{n:03}" if n % 3 == 0 else f"e/{n:03}"
    assert got == [rule(1), rule(2), rule(7), None]


def test_dedup_first_is_deterministic_on_ties(spark):
    rows = [(1, ts(0), ts(10), "b"), (1, ts(0), ts(10), "a"), (1, ts(0), ts(5), "z"), (2, ts(0), None, "q")]
    df = spark.createDataFrame(rows, "k int, p timestamp_ntz, d timestamp_ntz, x string")
    out = {r.k: r.x for r in dedup_first(df, ["k", "p"], [F.col("d").asc_nulls_last()]).collect()}
    assert out == {1: "z", 2: "q"}
    df2 = spark.createDataFrame(rows[:2], "k int, p timestamp_ntz, d timestamp_ntz, x string")
    assert dedup_first(df2, ["k", "p"], [F.col("d")]).collect()[0].x == "a"


def test_distinct_count_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (2,)], "v int")
    assert R.distinct_count(df, "v").collect()[0][0] == 3


def test_rows_at_max_returns_all_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 150.0), (4, 1.0)], "id int, d double")
    got = sorted(r.id for r in R.rows_at_max(df, "d", F.col("d") <= 100).collect())
    assert got == [1, 2]


def test_project_keys_missing_vs_null(spark):
    df = spark.createDataFrame([('{"brand": "A", "price": 1}',), ('{"price": 2}',), ('{"brand": null}',)], "j string")
    got = [tuple(r) for r in S.project_keys(df, "j", ["brand", "price"]).collect()]
    assert got == [("A", "1"), ("N/A", "2"), (None, "N/A")]


def test_fill_zero_only_numeric(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b double, s string")
    assert tuple(S.fill_zero(df).collect()[0]) == (0, 0.0, None)


def test_parse_params_fallbacks():
    assert S.parse_params('{"taxi_types": ["green"]}') == ["green"]
    assert S.parse_params('{"taxi_types": "green"}') == ["yellow"]
    assert S.parse_params("not json") == ["yellow"]
    assert S.parse_params(None) == ["yellow"]
    assert S.parse_run_date(" 2024-01-05T10:00:00 ") == "2024-01-05"


def test_enrich_payment_null_code_becomes_zero(spark):
    trips = spark.createDataFrame([(None,), (1,), (9,)], "payment_type int")
    lk = spark.createDataFrame([(0, "Flex"), (1, "Card")], "payment_type int, description string")
    got = sorted(tuple(r) for r in J.enrich_payment(trips, lk).collect())
    assert got == [(0, "Flex"), (1, "Card"), (9, "Unknown")]


def test_mart_keeps_null_zone_apart_from_literal(spark):
    rows = [(None, ts(0), "Green", "t1"), ("Unknown Zone", ts(0), "Green", "t2")]
    fct = spark.createDataFrame(rows, "pickup_zone string, pickup_datetime timestamp_ntz, service_type string, "
                                      "trip_id string")
    for c in R.MART_SUMS:
        fct = fct.withColumn(c, F.lit(Decimal("1.000")).cast("decimal(18,3)"))
    fct = fct.withColumn("passenger_count", F.lit(1)).withColumn("trip_distance", F.lit(Decimal("1.0")))
    out = R.monthly_zone_revenue(fct).collect()
    assert len(out) == 2 and {r.pickup_zone for r in out} == {"Unknown Zone"}


def test_insert_only_merge_keeps_duplicate_new_keys(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 9), ("b", 2), ("b", 3)], "k string, v int")
    got = sorted(tuple(r) for r in L.insert_only_rows(target, source, "k").collect())
    assert got == [("b", 2), ("b", 3)]


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([("a", 1), ("c", 5)], "k string, v int")
    source = spark.createDataFrame([("a", 9), ("b", 2), ("b", 3)], "k string, v int")
    with pytest.raises(ValueError):
        L.upsert_rows(target, source, "k")
    got = sorted(tuple(r) for r in L.upsert_rows(target, source, "k", dedupe=[F.col("v").desc()]).collect())
    assert got == [("a", 9), ("b", 3), ("c", 5)]


def test_delete_insert_keeps_duplicate_source_rows(spark):
    target = spark.createDataFrame([("a", 1), ("c", 5)], "k string, v int")
    source = spark.createDataFrame([("a", 9), ("a", 8)], "k string, v int")
    got = sorted(tuple(r) for r in L.delete_insert_rows(target, source, "k").collect())
    assert got == [("a", 8), ("a", 9), ("c", 5)]


def test_incremental_since(spark):
    df = spark.createDataFrame([(ts(0),), (ts(10),), (ts(20),)], "p timestamp_ntz")
    assert L.incremental_since(df, None, "p").count() == 3
    assert L.incremental_since(df, df.where("p <= '2024-01-01 12:00:10'"), "p").count() == 1
    assert L.incremental_since(df, df.limit(0), "p").count() == 0


def test_time_interval_replaces_only_window(spark):
    target = spark.createDataFrame([(ts(0), 1), (ts(100), 2), (None, 3)], "p timestamp_ntz, v int")
    source = spark.createDataFrame([(ts(100), 20), (ts(5000), 99)], "p timestamp_ntz, v int")
    got = sorted(r.v for r in L.time_interval_rows(target, source, "p", "2024-01-01 12:01:00",
                                                   "2024-01-01 12:02:00").collect())
    assert got == [1, 3, 20]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, -1.0), (None, "x", 0.0), (2, "a", 3.0)],
                               "k int, c string, amt double")
    rows = {(r["check"], r["column"]): r["failed_rows"] for r in Q.collect_checks([
        Q.check_suite(df, "t", [("not_null", "k"), ("non_negative", "amt"), ("positive", "amt"),
                                ("accepted_values", "c", ["a"])]),
        Q.check_unique(df, "t", "k"), Q.check_unique_combination(df, "t", ["k", "c"])])}
    assert rows == {("not_null", "k"): 1, ("non_negative", "amt"): 1, ("positive", "amt"): 2,
                    ("accepted_values", "c"): 1, ("unique", "k"): 1, ("unique_combination_of_columns", "k,c"): 0}
    dim = spark.createDataFrame([(1,)], "id int")
    assert Q.collect_checks([Q.check_relationships(df, "t", "k", dim, "id")])[0]["failed_rows"] == 1
    with pytest.raises(Q.CheckFailed):
        Q.assert_checks([Q.check_not_null(df, "t", "k")])
    assert Q.collect_checks([Q.check_row_count(df.limit(0), "t")])[0]["passed"] is False


def test_freshness_levels(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "loaded timestamp_ntz")
    def status(h):
        return Q.check_freshness(df, "t", "loaded", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)).collect()[0]
    assert status(1).status == "pass" and status(30).status == "warn" and status(50).status == "error"
    assert status(30).passed and not status(50).passed


def test_month_sequence(spark):
    df = spark.createDataFrame([(dt.date(2024, 11, 20), dt.date(2025, 2, 1))], "a date, b date")
    assert df.select(X.month_sequence("a", "b")).collect()[0][0] == ["2024-11", "2024-12", "2025-01", "2025-02"]


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    got = sorted(tuple(r) for r in S.union_by_name([a, b]).collect())
    assert got == [(1, "x", None), (2, None, 3.0)]


def test_pandas_udf_matches_native_expression(spark):
    from fareway.functions.udf import register, vendor_code_udf

    df = spark.createDataFrame([(0,), (1,), (2,), (8,), (None,)], "v int")
    a = [r[0] for r in df.select(vendor_code_udf("v")).collect()]
    b = [r[0] for r in df.select(X.vendor_code("v")).collect()]
    assert a == b
    register(spark)
    df.createOrReplaceTempView("vendors_t")
    assert [r[0] for r in spark.sql("SELECT vendor_code(v) FROM vendors_t").collect()] == b


def test_from_files_like_underscore_wildcard(spark):
    df = spark.createDataFrame([("yellow_tripdata_2021-03.csv",), ("yellow_tripdata_2021_03.csv",),
                                ("yellow_tripdata_2021-04.csv",)], "filename string")
    assert R.from_files(df, "yellow_tripdata_2021_03%").count() == 2


def test_merge_upsert_table(spark):
    import uuid

    from fareway.sources.writers import materialize_table

    name = f"up_{uuid.uuid4().hex[:8]}"
    materialize_table(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), name)
    L.merge_upsert(name, spark.createDataFrame([("b", 20), ("c", 3)], "k string, v int"), "k")
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("a", 1), ("b", 20), ("c", 3)]
