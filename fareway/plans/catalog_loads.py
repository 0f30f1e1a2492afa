"""Sources that need files, sinks and load strategies.

Every query writes into a fresh folder under the shared checkpoint
directory, reads the outcome back and returns it; the oracle is the SQL of
the expected final table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareway.functions import columns as X
from fareway.operators import loads as L
from fareway.operators import reports as R
from fareway.operators import staging as S
from fareway.plans import fixtures as fx
from fareway.plans.catalog_batch import HASH7_COLUMNS, HOURLY_ALL, _HASH7
from fareway.plans.catalog_models import STG_YELLOW
from fareway.plans.registry import query
from fareway.session import scratch_path
from fareway.sources import files as src
from fareway.sources import writers as W

INGESTED_AT = dt.datetime(2024, 1, 1, 0, 0, 0)


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _hourly_green(spark, sf):
    return R.revenue_hourly(S.normalize_trip_names(fx.raw_trips(spark, sf, "green")), "green")


def _stg_yellow(spark, sf):
    return S.stage_yellow(fx.raw_trips(spark, sf, "yellow"))


def yellow_schema(spark, sf) -> T.StructType:
    return fx.raw_trips(spark, sf, "yellow").drop("filename").schema


# ------------------------------------------------------------------ file sources

@query("scan_parquet_glob", "SELECT * EXCLUDE (filename) FROM green_tripdata")
def scan_parquet_glob(spark, sf):
    g = fx.raw_trips(spark, sf, "green").drop("filename")
    root = scratch_path(spark, "pq")
    parts = g.withColumns({"year": F.year("lpep_pickup_datetime"),
                           "month": F.date_format("lpep_pickup_datetime", "MM")})
    W.write_report(parts, f"{root}/green", partition_by=["year", "month"])
    return src.read_trips(spark, f"{root}/green/*/*/*.parquet")


@query("scan_csv_header", """SELECT cast(c_custkey AS varchar) AS c_custkey, c_name,
cast(c_nationkey AS varchar) AS c_nationkey, c_mktsegment FROM customer""")
def scan_csv_header(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = scratch_path(spark, "lookup-csv")
    c.write.option("header", True).csv(path)
    return src.read_lookup(spark, path)


def _yellow_csv(spark, sf) -> str:
    y = fx.raw_trips(spark, sf, "yellow").drop("filename")
    path = scratch_path(spark, "yellow-csv-gz")
    (y.write.option("header", True).option("compression", "gzip")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))
    return path


@query("scan_csv_typed", "SELECT * EXCLUDE (filename) FROM yellow_tripdata")
def scan_csv_typed(spark, sf):
    schema = yellow_schema(spark, sf)
    return src.read_trips_csv(spark, _yellow_csv(spark, sf), schema, min_partitions=8)


_EXT_COLS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
             "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type"]


@query("external_csv", f"SELECT {', '.join(_EXT_COLS)} FROM yellow_tripdata")
def external_csv(spark, sf):
    full = yellow_schema(spark, sf)
    declared = T.StructType([full[c] for c in _EXT_COLS])  # fewer columns than the file
    return src.external_table(spark, _name("ext_yellow_csv"), "csv", _yellow_csv(spark, sf), declared)


@query("external_parquet", "SELECT * FROM yellow_tripdata")
def external_parquet(spark, sf):
    path = scratch_path(spark, "yellow-pq")
    W.write_report(fx.raw_trips(spark, sf, "yellow"), path, files=4)
    return src.external_table(spark, _name("ext_yellow_pq"), "parquet", path)


STAGING_EXTRA = [T.StructField("unique_row_id", T.StringType()), T.StructField("filename", T.StringType())]


@query("copy_in_columns", "SELECT CAST(NULL AS varchar) AS unique_row_id, CAST(NULL AS varchar) AS filename, "
                          "* EXCLUDE (filename) FROM yellow_tripdata")
def copy_in_columns(spark, sf):
    schema = yellow_schema(spark, sf)
    target = T.StructType(STAGING_EXTRA + list(schema.fields))
    csv = src.read_trips_csv(spark, _yellow_csv(spark, sf), schema)
    return src.copy_in(csv, [f.name for f in schema.fields], target)


SEED_SCHEMA = T.StructType([T.StructField("base_id", T.LongType()), T.StructField("base_name", T.StringType()),
                            T.StructField("nation_id", T.IntegerType())])


@query("seed_lookup", "SELECT s_suppkey AS base_id, s_name AS base_name, s_nationkey AS nation_id FROM supplier")
def seed_lookup(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.col("s_suppkey").alias("base_id"), F.col("s_name").alias("base_name"), F.col("s_nationkey").alias("nation_id"))
    path = scratch_path(spark, "seed")
    s.write.option("header", True).csv(path)
    return src.load_seed(spark, path, SEED_SCHEMA, "base_id", table="bases")


_ING_Y = [n for n, _ in fx.trip_columns(fx.DUCK, "yellow") if n != "filename"]
_ING_G = [n for n, _ in fx.trip_columns(fx.DUCK, "green") if n != "filename"]
_ALL = list(dict.fromkeys(_ING_Y + _ING_G))


def _ing_select(service, cols):
    sel = [c if c in cols else f"NULL AS {c}" for c in _ALL]
    return (f"SELECT {', '.join(sel)}, '{service}' AS taxi_type, replace(filename, '.csv', '.parquet') AS filename, "
            f"TIMESTAMP '2024-01-01 00:00:00' AS ingested_at FROM {service}_tripdata")


@query("ingest_months", f"{_ing_select('yellow', _ING_Y)} UNION ALL {_ing_select('green', _ING_G)}")
def ingest_months(spark, sf):
    root = scratch_path(spark, "months")
    for t in ("yellow", "green"):
        raw = fx.raw_trips(spark, sf, t)
        monthly = raw.withColumn("filename", F.regexp_replace("filename", r"\.csv$", ".parquet"))
        W.write_report(monthly, root, mode="append", partition_by=["filename"])
    types = S.parse_params('{"taxi_types": ["yellow", "green"]}')
    start, end = S.parse_run_date("1995-01-01T00:00:00"), S.parse_run_date("2002-02-15")
    return src.ingest_months(spark, root, start, end, types, INGESTED_AT,
                             pattern="filename={type}_tripdata_{ym}.parquet")


# ------------------------------------------------------------------ file sinks

@query("write_parquet", "SELECT * FROM green", HOURLY_ALL)
def write_parquet(spark, sf):
    # one file while the report is small (AQE coalescing), more as it grows
    path = W.write_report(_hourly_green(spark, sf), scratch_path(spark, "report"))
    return spark.read.parquet(path)


@query("write_repartitioned", "SELECT count(*) AS rows, 4 AS files FROM yellow_tripdata")
def write_repartitioned(spark, sf):
    path = W.write_report(fx.raw_trips(spark, sf, "yellow"), scratch_path(spark, "rep4"), files=4)
    back = spark.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_distinct(F.col("_metadata.file_path")).cast("int").alias("files"))


@query("write_json", "SELECT * FROM green", HOURLY_ALL)
def write_json(spark, sf):
    df = _hourly_green(spark, sf)
    path = W.write_json(df, scratch_path(spark, "json"))
    return spark.read.schema(df.schema).json(path)


@query("write_for_run", "SELECT * FROM fhv_tripdata WHERE cast(pickup_datetime AS date) = DATE '1996-03-15'")
def write_for_run(spark, sf):
    day = "1996-03-15"
    f = R.on_day(fx.fhv_trips(spark, sf), "pickup_datetime", day)
    root = scratch_path(spark, "runs")
    path = W.write_for_run(f, root, day)
    return spark.read.parquet(path)


@query("publish_json", """SELECT count(*) AS messages, count(*) FILTER (WHERE PULocationID IS NOT NULL) AS parsed,
cast(sum(total_amount) AS decimal(38,2)) AS total_amount FROM rides""")
def publish_json(spark, sf):
    from fareway.streaming.sources import RIDE_TEXT_SCHEMA, to_text_message

    path = scratch_path(spark, "topic")
    W.publish_json(to_text_message(fx.rides(spark, sf)), path)
    back = spark.read.text(path).select(F.from_json("value", RIDE_TEXT_SCHEMA).alias("m")).select("m.*")
    return back.agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col("PULocationID").isNotNull()).alias("parsed"),
                    F.sum(X.exact(back, "total_amount")).cast("decimal(38,2)").alias("total_amount"))


# ------------------------------------------------------------------ tables

@query("write_table", "SELECT * FROM green", HOURLY_ALL)
def write_table(spark, sf):
    return W.write_table(_hourly_green(spark, sf), f"reports.{_name('green_hourly')}")


@query("ensure_table", "SELECT * FROM green", HOURLY_ALL)
def ensure_table(spark, sf):
    df = _hourly_green(spark, sf)
    name = _name("green_hourly")
    W.ensure_table(spark, name, df.schema)
    W.ensure_table(spark, name, df.schema)  # second call is a no-op
    df.write.insertInto(name)
    return spark.table(name)


@query("strategy_table", "SELECT * FROM stg_yellow", STG_YELLOW)
def strategy_table(spark, sf):
    return W.materialize_table(_stg_yellow(spark, sf), _name("yellow_native"))


@query("layout_partition_cluster", """SELECT DISTINCT vendor_id FROM stg_yellow
WHERE cast(dropoff_datetime AS date) BETWEEN DATE '1997-03-01' AND DATE '1997-03-15'""", STG_YELLOW)
def layout_partition_cluster(spark, sf):
    """Partitioned by the filtered column (dropoff month folders) and
    clustered by (dropoff date, vendor) inside the files: the date filter
    prunes folders and parquet row groups."""
    y = _stg_yellow(spark, sf).withColumns({
        "dropoff_date": F.to_date("dropoff_datetime"),
        "dropoff_month": F.trunc(F.to_date("dropoff_datetime"), "month")})
    t = W.materialize_table(y, _name("yellow_part"), partition_by=["dropoff_month"],
                            cluster_by=["dropoff_date", "vendor_id"])
    lo, hi = F.lit("1997-03-01").cast("date"), F.lit("1997-03-15").cast("date")
    return (t.where(F.col("dropoff_month").between(F.trunc(lo, "month"), F.trunc(hi, "month")))
            .where(F.col("dropoff_date").between(lo, hi)).select("vendor_id").distinct())


@query("truncate_load", "SELECT * FROM green", HOURLY_ALL)
def truncate_load(spark, sf):
    df = _hourly_green(spark, sf)
    name = _name("staging")
    W.ensure_table(spark, name, df.schema)
    df.limit(5).write.insertInto(name)  # leftovers of an earlier run
    return W.truncate_load(spark, df, name)


# ------------------------------------------------------------------ merge / strategies

def _yellow_with_id(spark, sf):
    y = fx.raw_trips(spark, sf, "yellow").drop("filename")
    return L.add_row_identity(y, HASH7_COLUMNS, filename=F.concat(
        F.lit("yellow_tripdata_"), F.date_format("tpep_pickup_datetime", "yyyy-MM"), F.lit(".csv")))


_YID = f"y_id AS (SELECT {_HASH7} AS unique_row_id, * EXCLUDE (filename), filename FROM yellow_tripdata)"


@query("merge_insert_only", """SELECT * FROM y_id WHERE tpep_pickup_datetime < TIMESTAMP '1998-01-01'
UNION ALL SELECT * FROM y_id WHERE tpep_pickup_datetime >= TIMESTAMP '1997-07-01' AND unique_row_id NOT IN
(SELECT unique_row_id FROM y_id WHERE tpep_pickup_datetime < TIMESTAMP '1998-01-01')""", _YID)
def merge_insert_only(spark, sf):
    y = _yellow_with_id(spark, sf)
    name = _name("yellow_trips")
    W.materialize_table(y.where(F.col("tpep_pickup_datetime") < F.lit("1998-01-01").cast("timestamp_ntz")), name)
    source = y.where(F.col("tpep_pickup_datetime") >= F.lit("1997-07-01").cast("timestamp_ntz"))
    L.merge_insert_only(name, source, "unique_row_id", within=HASH7_COLUMNS)
    L.merge_insert_only(name, source, "unique_row_id", within=HASH7_COLUMNS)  # idempotent: inserts nothing the second time
    return spark.table(name)


_STG_TRIPS = "stg_yellow"


_YK = STG_YELLOW + """, yk AS (SELECT * EXCLUDE (rn) FROM (SELECT md5(concat_ws('-', cast(vendor_id AS varchar),
cast(pickup_datetime AS varchar), cast(pickup_location_id AS varchar))) AS rid, *,
row_number() OVER (PARTITION BY vendor_id, pickup_datetime, pickup_location_id ORDER BY dropoff_datetime,
dropoff_location_id, total_amount, trip_distance, passenger_count, rate_code_id, payment_type, fare_amount,
tip_amount, tolls_amount, store_and_fwd_flag) AS rn FROM stg_yellow) WHERE rn = 1)"""


def _keyed_yellow(spark, sf):
    """One trip per vendor, pickup time and zone, with its key ``rid``."""
    from fareway.operators.dedup import dedup_first

    y = _stg_yellow(spark, sf)
    order = [F.col(c).asc_nulls_last() for c in ("dropoff_datetime", "dropoff_location_id", "total_amount",
                                                 "trip_distance", "passenger_count", "rate_code_id", "payment_type",
                                                 "fare_amount", "tip_amount", "tolls_amount", "store_and_fwd_flag")]
    keyed = dedup_first(y, ["vendor_id", "pickup_datetime", "pickup_location_id"], order, tie_break=False)
    return keyed.select(F.md5(F.concat_ws("-", F.col("vendor_id").cast("string"),
                                           F.col("pickup_datetime").cast("string"),
                                           F.col("pickup_location_id").cast("string"))).alias("rid"), *y.columns)


@query("merge_upsert", """SELECT * FROM yk WHERE pickup_datetime < TIMESTAMP '1998-01-01' AND rid NOT IN
(SELECT rid FROM yk WHERE pickup_datetime >= TIMESTAMP '1997-07-01')
UNION ALL SELECT * REPLACE (cast(total_amount + 1 AS decimal(18,3)) AS total_amount) FROM yk WHERE pickup_datetime >= TIMESTAMP '1997-07-01'""", _YK)
def merge_upsert(spark, sf):
    keyed = _keyed_yellow(spark, sf)
    name = _name("trips_upsert")
    W.materialize_table(keyed.where(F.col("pickup_datetime") < F.lit("1998-01-01").cast("timestamp_ntz")), name)
    changed = keyed.where(F.col("pickup_datetime") >= F.lit("1997-07-01").cast("timestamp_ntz")).withColumn(
        "total_amount", (F.col("total_amount") + 1).cast("decimal(18,3)"))
    return L.materialize(changed, "merge", name, key="rid")


@query("incremental_hwm", """SELECT * FROM stg_yellow WHERE pickup_datetime >
(SELECT max(pickup_datetime) FROM stg_yellow WHERE pickup_datetime < TIMESTAMP '1998-01-01')""", STG_YELLOW)
def incremental_hwm(spark, sf):
    y = _stg_yellow(spark, sf)
    name = _name("fct")
    target = W.materialize_table(y.where(F.col("pickup_datetime") < F.lit("1998-01-01").cast("timestamp_ntz")), name)
    return L.incremental_since(y, target, "pickup_datetime")


@query("schema_append_columns", """SELECT vendor_id, pickup_datetime, total_amount, NULL::INTEGER AS payment_type
FROM stg_yellow WHERE pickup_datetime < TIMESTAMP '1998-01-01'
UNION ALL SELECT vendor_id, pickup_datetime, total_amount, payment_type FROM stg_yellow
WHERE pickup_datetime >= TIMESTAMP '1998-01-01'""", STG_YELLOW)
def schema_append_columns(spark, sf):
    y = _stg_yellow(spark, sf)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old = y.where(F.col("pickup_datetime") < cut).select("vendor_id", "pickup_datetime", "total_amount")
    new = y.where(F.col("pickup_datetime") >= cut).select("vendor_id", "pickup_datetime", "total_amount",
                                                          "payment_type")
    return L.align_schema(old, new)


@query("strategy_append", "SELECT * FROM green UNION ALL SELECT * FROM green", HOURLY_ALL)
def strategy_append(spark, sf):
    df = _hourly_green(spark, sf)
    name = _name("append")
    L.materialize(df, "append", name)  # first run creates
    return L.materialize(df, "append", name)  # second run appends again (not idempotent)


@query("strategy_view", "SELECT zone_id, cast(sum(green_amount) AS decimal(38,2)) AS amount FROM green GROUP BY 1",
       HOURLY_ALL)
def strategy_view(spark, sf):
    name = _name("v_green_hourly")
    L.materialize(_hourly_green(spark, sf), "view", name)
    return spark.sql(f"SELECT zone_id, CAST(sum(green_amount) AS decimal(38,2)) AS amount FROM {name} GROUP BY zone_id")


_WIN = ("TIMESTAMP '1997-03-01'", "TIMESTAMP '1997-04-01'")


_TIME_INTERVAL = f"""SELECT * FROM stg_yellow WHERE NOT (pickup_datetime >= {_WIN[0]} AND pickup_datetime < {_WIN[1]})
UNION ALL SELECT * REPLACE (cast(total_amount + 1 AS decimal(18,3)) AS total_amount) FROM stg_yellow
WHERE pickup_datetime >= {_WIN[0]} AND pickup_datetime < {_WIN[1]}"""


@query("strategy_time_interval", _TIME_INTERVAL, STG_YELLOW)
def strategy_time_interval(spark, sf):
    y = _stg_yellow(spark, sf)
    name = _name("ti")
    L.materialize(y, "replace", name)
    run = y.where(F.col("pickup_datetime") >= F.lit("1997-02-01").cast("timestamp_ntz")).withColumn(
        "total_amount", (F.col("total_amount") + 1).cast("decimal(18,3)"))
    L.materialize(run, "time_interval", name, time_col="pickup_datetime", start="1997-03-01", end="1997-04-01")
    L.materialize(run, "time_interval", name, time_col="pickup_datetime", start="1997-03-01", end="1997-04-01")
    return spark.table(name)


_DELETE_INSERT = """SELECT * FROM stg_yellow WHERE pickup_location_id NOT IN (1, 2, 3)
UNION ALL SELECT * REPLACE (cast(total_amount + 1 AS decimal(18,3)) AS total_amount) FROM stg_yellow WHERE pickup_location_id IN (1, 2, 3)"""


@query("strategy_delete_insert", _DELETE_INSERT, STG_YELLOW)
def strategy_delete_insert(spark, sf):
    y = _stg_yellow(spark, sf)
    name = _name("di")
    L.materialize(y, "replace", name)
    src_rows = y.where(F.col("pickup_location_id").isin(1, 2, 3)).withColumn(
        "total_amount", (F.col("total_amount") + 1).cast("decimal(18,3)"))
    return L.materialize(src_rows, "delete_insert", name, key="pickup_location_id")


# ------------------------------------------------------------------ the same strategies on a partitioned table

_MONTH = "CAST(date_trunc('month', pickup_datetime) AS DATE)"


def _by_month(df):
    return df.withColumn("pickup_month", F.trunc(F.to_date("pickup_datetime"), "month"))


@query("upsert_partitioned", f"""SELECT *, {_MONTH} AS pickup_month FROM yk WHERE pickup_datetime < TIMESTAMP '1997-07-01'
UNION ALL SELECT * REPLACE (cast(total_amount + 1 AS decimal(18,3)) AS total_amount),
CAST({_MONTH} + INTERVAL 1 MONTH AS DATE) AS pickup_month FROM yk WHERE pickup_datetime >= TIMESTAMP '1997-07-01'
UNION ALL SELECT *, DATE '1997-07-01' AS pickup_month FROM yk WHERE pickup_datetime < TIMESTAMP '1995-06-01'""", _YK)
def upsert_partitioned(spark, sf):
    """Rows from July 1997 on move to the next month's partition, which
    empties July 1997; rows appended there later do not bring its old ones back."""
    keyed = L.staged(_by_month(_keyed_yellow(spark, sf)))  # the table, the moved and the early rows are of one choice
    name = _name("trips_by_month")
    cut = F.lit("1997-07-01").cast("timestamp_ntz")
    W.materialize_table(keyed, name, partition_by=["pickup_month"])
    moved = keyed.where(F.col("pickup_datetime") >= cut).withColumns({
        "total_amount": (F.col("total_amount") + 1).cast("decimal(18,3)"), "pickup_month": F.add_months("pickup_month", 1)})
    L.merge_upsert(name, moved, "rid")
    early = keyed.where(F.col("pickup_datetime") < F.lit("1995-06-01").cast("timestamp_ntz"))
    L.append_rows(name, early.withColumn("pickup_month", F.lit("1997-07-01").cast("date")))
    return spark.table(name)


@query("time_interval_partitioned", f"SELECT *, {_MONTH} AS pickup_month FROM ({_TIME_INTERVAL})", STG_YELLOW)
def time_interval_partitioned(spark, sf):
    y = _by_month(_stg_yellow(spark, sf))
    name = _name("tip")
    L.materialize(y, "replace", name, partition_by=["pickup_month"])
    run = y.withColumn("total_amount", (F.col("total_amount") + 1).cast("decimal(18,3)"))
    for _ in range(2):
        L.materialize(run, "time_interval", name, time_col="pickup_datetime", start="1997-03-01", end="1997-04-01")
    return spark.table(name)


@query("delete_insert_partitioned", f"SELECT *, {_MONTH} AS pickup_month FROM ({_DELETE_INSERT})", STG_YELLOW)
def delete_insert_partitioned(spark, sf):
    y = _by_month(_stg_yellow(spark, sf))
    name = _name("dip")
    L.materialize(y, "replace", name, partition_by=["pickup_month"])
    rows = y.where(F.col("pickup_location_id").isin(1, 2, 3)).withColumn(
        "total_amount", (F.col("total_amount") + 1).cast("decimal(18,3)"))
    return L.materialize(rows, "delete_insert", name, key="pickup_location_id")


@query("full_refresh", "SELECT * FROM stg_yellow WHERE pickup_datetime >= TIMESTAMP '1998-01-01'", STG_YELLOW)
def full_refresh(spark, sf):
    y = _stg_yellow(spark, sf)
    name = _name("fr")
    L.materialize(y, "replace", name)
    newer = y.where(F.col("pickup_datetime") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return L.materialize(newer, "merge", name, key="pickup_datetime", full_refresh=True)


# ------------------------------------------------------------------ E5 file load, row counts

@query("load_month", f"""SELECT {_HASH7} AS unique_row_id,
CASE WHEN tpep_pickup_datetime < TIMESTAMP '1998-07-01' THEN 'yellow_tripdata_a.csv' ELSE 'yellow_tripdata_b.csv' END
AS filename, * EXCLUDE (filename) FROM yellow_tripdata""")
def load_month(spark, sf):
    """Two trip files loaded through staging with insert-only merges; the
    first file is loaded twice and the second load inserts nothing."""
    from fareway.plans.jobs import load_trip_file

    schema = yellow_schema(spark, sf)
    cut = F.lit("1998-07-01").cast("timestamp_ntz")
    y = fx.raw_trips(spark, sf, "yellow").drop("filename")
    files = {}
    for name, cond in (("yellow_tripdata_a.csv", F.col("tpep_pickup_datetime") < cut),
                       ("yellow_tripdata_b.csv", F.col("tpep_pickup_datetime") >= cut)):
        path = scratch_path(spark, "download")
        y.where(cond).write.option("header", True).option("compression", "gzip").option(
            "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
        files[name] = path
    full = T.StructType(STAGING_EXTRA + list(schema.fields))
    staging, target = _name("yellow_staging"), _name("yellow_tripdata")
    W.ensure_table(spark, staging, full)
    W.ensure_table(spark, target, full)
    for name in ("yellow_tripdata_a.csv", "yellow_tripdata_b.csv", "yellow_tripdata_a.csv"):
        load_trip_file(spark, files[name], schema, name, staging, target, HASH7_COLUMNS)
    return spark.table(target)


@query("row_counts", """SELECT 'green_tripdata' AS table_name, count(*) AS row_count FROM green_tripdata
UNION ALL SELECT 'yellow_tripdata', count(*) FROM yellow_tripdata
UNION ALL SELECT 'stg_fhv', count(*) FROM fhv_tripdata WHERE dispatching_base_num IS NOT NULL""")
def row_counts(spark, sf):
    frames = [("green_tripdata", fx.raw_trips(spark, sf, "green")),
              ("yellow_tripdata", fx.raw_trips(spark, sf, "yellow")),
              ("stg_fhv", S.stage_fhv(fx.fhv_trips(spark, sf)))]
    out = None
    for name, df in frames:
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


# ------------------------------------------------------------------ O1 sorted report, green month load

@query("report_sorted", """SELECT *, row_number() OVER (ORDER BY hour, zone_id) AS position FROM green""", HOURLY_ALL)
def report_sorted(spark, sf):
    """The written report is in order: each row's place in the files, in the
    order of their names, is its rank by hour and zone."""
    path = W.write_report(R.ordered(_hourly_green(spark, sf), "hour", "zone_id"), scratch_path(spark, "sorted"))
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.row_index").alias("_i"))
    before = rows.groupBy("_f").agg(F.count(F.lit(1)).alias("_n")).select("_f", F.coalesce(F.sum("_n").over(
        Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # one row per file
    return rows.join(before, "_f").withColumn("position", F.col("_before") + F.col("_i") + 1).drop("_f", "_i", "_before")


GREEN_HASH_COLUMNS = ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID",
                      "fare_amount", "trip_distance"]


@query("load_month_green", f"""SELECT {_HASH7.replace('tpep_', 'lpep_')} AS unique_row_id,
'green_tripdata.csv' AS filename, * EXCLUDE (filename) FROM green_tripdata""")
def load_month_green(spark, sf):
    """The green month load: the file is loaded twice, the second load inserts nothing."""
    from fareway.plans.jobs import load_trip_file

    g = fx.raw_trips(spark, sf, "green").drop("filename")
    path = scratch_path(spark, "download")
    g.write.option("header", True).option("compression", "gzip").option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    full = T.StructType(STAGING_EXTRA + list(g.schema.fields))
    staging, target = _name("green_staging"), _name("green_tripdata")
    W.ensure_table(spark, staging, full)
    W.ensure_table(spark, target, full)
    for _ in range(2):
        load_trip_file(spark, path, g.schema, "green_tripdata.csv", staging, target, GREEN_HASH_COLUMNS)
    return spark.table(target)
