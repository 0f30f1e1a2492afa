"""Batch questions: scans, projections, joins, aggregates, top-k, scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.functions import columns as X
from fareway.operators import joins as J
from fareway.operators import reports as R
from fareway.operators import staging as S
from fareway.plans import fixtures as fx
from fareway.plans.registry import query
from fareway.sources import files as src

# Run parameters of the questions (the supplied data spans 1995-2001).
SINCE = "1996-01-01"
DAY = "1998-06-15"
MONTH = "1997-03-01"
MONTH_END = "1997-04-01"
PICKUP_ZONE_NAME = "NATION_1"


def _yellow(spark, sf):
    return S.normalize_trip_names(fx.raw_trips(spark, sf, "yellow"))


def _green(spark, sf):
    return S.normalize_trip_names(fx.raw_trips(spark, sf, "green"))


def hash_inputs(df: DataFrame, names: list[str]):
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(F.col(n), types[n]) for n in names]


# ------------------------------------------------------------------ flagship

def revenue_zones_df(spark: SparkSession, sf: str, since: str = SINCE) -> DataFrame:
    """Green and yellow hourly revenue, full outer joined, named by zone."""
    g = R.revenue_hourly(_green(spark, sf), "green", since)
    y = R.revenue_hourly(_yellow(spark, sf), "yellow", since)
    total = J.outer_revenue(g, y, ["hour", "zone_id"])
    zones = src.read_lookup_frame(fx.zones(spark, sf, id_as_string=True))
    out = J.join_lookup_by_text_id(total, zones, "zone_id", "LocationID")
    return out.drop("LocationID", "zone_id")


_HOURLY = """
{p} AS (SELECT date_trunc('hour', {pre}_pickup_datetime) AS hour, PULocationID AS zone_id,
  cast(sum(total_amount) AS decimal(38,2)) AS {p}_amount, count(1) AS {p}_number_records
  FROM {p}_tripdata WHERE {pre}_pickup_datetime >= TIMESTAMP '{since}' GROUP BY 1, 2)"""
HOURLY_CTES = (_HOURLY.format(p="green", pre="lpep", since=SINCE) + ","
               + _HOURLY.format(p="yellow", pre="tpep", since=SINCE) + """,
total AS (SELECT coalesce(g.hour, y.hour) AS hour, coalesce(g.zone_id, y.zone_id) AS zone_id,
  green_amount, green_number_records, yellow_amount, yellow_number_records
  FROM green g FULL OUTER JOIN yellow y ON g.hour = y.hour AND g.zone_id = y.zone_id)""")

# The same report over the whole table, for the sinks.
HOURLY_ALL = _HOURLY.format(p="green", pre="lpep", since="0001-01-01")

REVENUE_ZONES_SQL = """
SELECT t.hour, t.green_amount, t.green_number_records, t.yellow_amount, t.yellow_number_records,
       z.Borough, z.Zone, z.service_zone
FROM total t JOIN zones_text z ON t.zone_id = cast(z.LocationID AS int)"""

query("revenue_zones", REVENUE_ZONES_SQL, HOURLY_CTES)(revenue_zones_df)


@query("revenue_hourly", "SELECT * FROM green", HOURLY_CTES)
def revenue_hourly(spark, sf):
    return R.revenue_hourly(_green(spark, sf), "green", SINCE)


@query("revenue_total", "SELECT * FROM total", HOURLY_CTES)
def revenue_total(spark, sf):
    g = R.revenue_hourly(_green(spark, sf), "green", SINCE)
    y = R.revenue_hourly(_yellow(spark, sf), "yellow", SINCE)
    return J.outer_revenue(g, y, ["hour", "zone_id"])


# ------------------------------------------------------------------ sources

@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(spark, sf):
    return src.read_trips(spark, f"{sf}/lineitem.parquet")


@query("scan_pruned_limit", """SELECT VendorID, tpep_pickup_datetime, PULocationID, DOLocationID,
  total_amount FROM (SELECT * FROM yellow_tripdata ORDER BY tpep_pickup_datetime, tpep_dropoff_datetime,
  PULocationID, DOLocationID, total_amount, passenger_count, trip_distance, VendorID NULLS FIRST LIMIT 1000)""")
def scan_pruned_limit(spark, sf):
    # The bounded read: five columns, a fixed-size sample. Ordered so that the
    # sample is reproducible across engines (planned as a per-partition top-k).
    y = fx.raw_trips(spark, sf, "yellow")
    ordered = y.orderBy("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
                        "total_amount", "passenger_count", "trip_distance", F.col("VendorID").asc_nulls_first())
    return src.sample_rows(ordered, ["VendorID", "tpep_pickup_datetime", "PULocationID", "DOLocationID",
                                     "total_amount"], 1000)


# ------------------------------------------------------------------ projections / filters

@query("project_filter", """SELECT PULocationID, DOLocationID, total_amount FROM yellow_tripdata
WHERE fare_amount > 1000""")
def project_filter(spark, sf):
    y = fx.raw_trips(spark, sf, "yellow")
    return y.select("PULocationID", "DOLocationID", "total_amount").where(y.fare_amount > 1000)


@query("rename_common", """SELECT VendorID, lpep_pickup_datetime AS pickup_datetime,
lpep_dropoff_datetime AS dropoff_datetime, PULocationID, total_amount FROM green_tripdata""")
def rename_common(spark, sf):
    return _green(spark, sf).select("VendorID", "pickup_datetime", "dropoff_datetime", "PULocationID",
                                    "total_amount")


@query("tag_service", """SELECT VendorID, tpep_pickup_datetime AS pickup_datetime, total_amount,
'yellow' AS service_type FROM yellow_tripdata""")
def tag_service(spark, sf):
    return S.tag_service(_yellow(spark, sf), "yellow").select("VendorID", "pickup_datetime", "total_amount",
                                                              "service_type")


_COMMON = ["VendorID", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "RatecodeID",
           "PULocationID", "DOLocationID", "passenger_count", "trip_distance", "fare_amount", "extra",
           "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
           "payment_type", "congestion_surcharge", "filename"]


def _union_sql(service_col: bool = True) -> str:
    def sel(p, pre):
        cols = ", ".join(
            f"{pre}_{c} AS {c}" if c in ("pickup_datetime", "dropoff_datetime") else c for c in _COMMON)
        return f"SELECT {cols}, '{p}' AS service_type FROM {p}_tripdata"
    return f"{sel('green', 'lpep')} UNION ALL {sel('yellow', 'tpep')}"


def trips_data(spark, sf) -> DataFrame:
    """Both services on their common columns (green order), tagged."""
    g, y = _green(spark, sf), _yellow(spark, sf)
    cols = S.common_columns(g, y)
    return S.union_common([g.select(cols).withColumn("service_type", F.lit("green")),
                           y.select(cols).withColumn("service_type", F.lit("yellow"))])


@query("union_common_columns", _union_sql())
def union_common_columns(spark, sf):
    return trips_data(spark, sf)


@query("revenue_monthly", f"""SELECT PULocationID AS pickup_zone, date_trunc('month', pickup_datetime) AS revenue_month,
service_type,
cast(sum(fare_amount) AS decimal(38,2)) AS revenue_monthly_fare,
cast(sum(extra) AS decimal(38,2)) AS revenue_monthly_extra,
cast(sum(mta_tax) AS decimal(38,2)) AS revenue_monthly_mta_tax,
cast(sum(tip_amount) AS decimal(38,2)) AS revenue_monthly_tip_amount,
cast(sum(tolls_amount) AS decimal(38,2)) AS revenue_monthly_tolls_amount,
cast(sum(improvement_surcharge) AS decimal(38,2)) AS revenue_monthly_improvement_surcharge,
cast(sum(total_amount) AS decimal(38,2)) AS revenue_monthly_total_amount,
cast(sum(congestion_surcharge) AS decimal(38,2)) AS revenue_monthly_congestion_surcharge,
cast(sum(passenger_count) AS double) / count(passenger_count) AS avg_monthly_passenger_count,
cast(sum(cast(trip_distance AS decimal(18,7))) AS double) / count(trip_distance) AS avg_monthly_trip_distance
FROM ({_union_sql()}) GROUP BY 1, 2, 3""")
def revenue_monthly(spark, sf):
    return R.revenue_monthly(trips_data(spark, sf))


@query("count_by_vendor", """SELECT service_type, VendorID, count(1) AS count FROM
(SELECT VendorID, 'yellow' AS service_type FROM yellow_tripdata) GROUP BY 1, 2""")
def count_by_vendor(spark, sf):
    return S.tag_service(fx.raw_trips(spark, sf, "yellow"), "yellow").groupBy("service_type", "VendorID").count()


@query("count_short_trips", """SELECT count(*) AS trips FROM green_tripdata
WHERE lpep_pickup_datetime >= TIMESTAMP '1997-01-01' AND lpep_pickup_datetime < TIMESTAMP '1998-01-01'
AND trip_distance <= 1""")
def count_short_trips(spark, sf):
    g = R.in_window(_green(spark, sf), "pickup_datetime", "1997-01-01", "1998-01-01")
    return g.where(F.col("trip_distance") <= 1).agg(F.count(F.lit(1)).alias("trips"))


@query("rows_at_max", """SELECT lpep_pickup_datetime AS pickup_datetime, trip_distance FROM green_tripdata
WHERE trip_distance = (SELECT max(trip_distance) FROM green_tripdata WHERE trip_distance <= 100)""")
def rows_at_max(spark, sf):
    g = _green(spark, sf)
    return R.rows_at_max(g, "trip_distance", F.col("trip_distance") <= 100,
                         select=["pickup_datetime", "trip_distance"])


def _zone_day_totals(spark, sf, how: str) -> DataFrame:
    g = R.on_day(_green(spark, sf), "pickup_datetime", DAY)
    z = fx.zones(spark, sf)
    j = g.join(z, g.PULocationID == z.LocationID, how)
    return j.groupBy(F.col("Zone").alias("zone")).agg(
        F.round(F.sum("total_amount").cast("decimal(38,2)"), 2).alias("zone_amount"))


@query("biggest_zone", f"""SELECT z.Zone AS zone, round(cast(sum(g.total_amount) AS decimal(38,2)), 2) AS zone_amount
FROM green_tripdata g LEFT JOIN zones z ON g.PULocationID = z.LocationID
WHERE cast(g.lpep_pickup_datetime AS date) = DATE '{DAY}'
GROUP BY 1 ORDER BY zone_amount DESC, zone ASC NULLS FIRST LIMIT 1""")
def biggest_zone(spark, sf):
    return R.top_k(_zone_day_totals(spark, sf, "left"), 1, F.col("zone_amount").desc(),
                   F.col("zone").asc_nulls_first())


@query("biggest_zone_inner", f"""SELECT zone, zone_amount FROM (
SELECT z.Zone AS zone, cast(sum(d.amount) AS decimal(38,2)) AS zone_amount FROM zones z, (
 SELECT PULocationID AS id, sum(total_amount) AS amount FROM green_tripdata
 WHERE lpep_pickup_datetime >= TIMESTAMP '{DAY}' AND lpep_pickup_datetime < TIMESTAMP '{DAY}' + INTERVAL 1 DAY GROUP BY ALL) d
WHERE d.id = z.LocationID GROUP BY ALL) QUALIFY row_number() OVER (ORDER BY zone_amount DESC, zone) = 1""")
def biggest_zone_inner(spark, sf):
    return R.top_k(_zone_day_totals(spark, sf, "inner"), 1, F.col("zone_amount").desc(), F.col("zone").asc())


@query("largest_tip", f"""SELECT pz.Zone AS pickup_zone, dz.Zone AS dropoff_zone, max(g.tip_amount) AS max_tip_amount
FROM green_tripdata g LEFT JOIN zones pz ON g.PULocationID = pz.LocationID
LEFT JOIN zones dz ON g.DOLocationID = dz.LocationID
WHERE pz.Zone = '{PICKUP_ZONE_NAME}' AND g.lpep_pickup_datetime >= TIMESTAMP '{MONTH}'
  AND g.lpep_pickup_datetime < TIMESTAMP '{MONTH_END}'
GROUP BY 1, 2 ORDER BY max_tip_amount DESC, dropoff_zone ASC NULLS FIRST LIMIT 1""")
def largest_tip(spark, sf):
    g = R.in_window(_green(spark, sf), "pickup_datetime", MONTH, MONTH_END)
    z = fx.zones(spark, sf)
    pz = z.select(F.col("LocationID").alias("pu_id"), F.col("Zone").alias("pickup_zone"))
    dz = z.select(F.col("LocationID").alias("do_id"), F.col("Zone").alias("dropoff_zone"))
    j = (g.join(pz, g.PULocationID == pz.pu_id, "left").join(dz, g.DOLocationID == dz.do_id, "left")
         .where(F.col("pickup_zone") == PICKUP_ZONE_NAME))  # null-rejecting: left becomes inner
    agg = j.groupBy("pickup_zone", "dropoff_zone").agg(F.max("tip_amount").alias("max_tip_amount"))
    return R.top_k(agg, 1, F.col("max_tip_amount").desc(), F.col("dropoff_zone").asc_nulls_first())


@query("least_frequent_zone", f"""SELECT z.Zone AS zone, count(*) AS trips FROM yellow_tripdata y
LEFT JOIN zones_text z ON y.PULocationID = cast(z.LocationID AS int)
WHERE date_trunc('month', y.tpep_pickup_datetime) = TIMESTAMP '{MONTH}'
GROUP BY 1 ORDER BY trips ASC, zone ASC NULLS FIRST LIMIT 10""")
def least_frequent_zone(spark, sf):
    y = R.in_month(_yellow(spark, sf), "pickup_datetime", MONTH)
    z = src.read_lookup_frame(fx.zones(spark, sf, id_as_string=True))
    j = y.join(z, y.PULocationID == z.LocationID.try_cast("int"), "left")
    agg = j.groupBy(F.col("Zone").alias("zone")).agg(F.count(F.lit(1)).alias("trips"))
    return R.top_k(agg, 10, F.col("trips").asc(), F.col("zone").asc_nulls_first())


@query("count_on_day", f"""SELECT count(1) AS trips FROM yellow_tripdata
WHERE date_trunc('day', tpep_pickup_datetime) = TIMESTAMP '{DAY}'""")
def count_on_day(spark, sf):
    return R.on_day(_yellow(spark, sf), "pickup_datetime", DAY).agg(F.count(F.lit(1)).alias("trips"))


@query("longest_trip", """SELECT (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 3600 AS trip_length_h
FROM yellow_tripdata ORDER BY trip_length_h DESC LIMIT 2""")
def longest_trip(spark, sf):
    y = _yellow(spark, sf).select(X.hours_between("pickup_datetime", "dropoff_datetime").alias("trip_length_h"))
    return R.top_k(y, 2, F.col("trip_length_h").desc())


@query("count_zero_fare", "SELECT count(1) AS trips FROM yellow_tripdata WHERE fare_amount = 0")
def count_zero_fare(spark, sf):
    return fx.raw_trips(spark, sf, "yellow").where(F.col("fare_amount") == 0).agg(F.count(F.lit(1)).alias("trips"))


@query("count_long_trips", "SELECT count(*) AS trips FROM green_tripdata WHERE trip_distance > 5")
def count_long_trips(spark, sf):
    return fx.raw_trips(spark, sf, "green").where(F.col("trip_distance") > 5).agg(F.count(F.lit(1)).alias("trips"))


FILENAME_PATTERNS = ["yellow_tripdata_1997%", "green_tripdata_1997%", "yellow_tripdata_1998_03%"]


@query("count_by_filename", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE filename LIKE '{p}') AS n{i}" for i, p in enumerate(FILENAME_PATTERNS))
    + " FROM (SELECT filename FROM yellow_tripdata UNION ALL SELECT filename FROM green_tripdata)")
def count_by_filename(spark, sf):
    both = fx.raw_trips(spark, sf, "yellow").select("filename").unionByName(
        fx.raw_trips(spark, sf, "green").select("filename"))
    # one scan, one conditional count per pattern (same rows as R.from_files)
    return both.agg(*[F.count_if(F.col("filename").like(p)).alias(f"n{i}") for i, p in enumerate(FILENAME_PATTERNS)])


@query("distinct_vendor_range", """SELECT DISTINCT VendorID FROM yellow_tripdata
WHERE cast(tpep_dropoff_datetime AS date) >= DATE '1997-03-01' AND cast(tpep_dropoff_datetime AS date) <= DATE '1997-03-15'""")
def distinct_vendor_range(spark, sf):
    y = fx.raw_trips(spark, sf, "yellow")
    d = F.to_date("tpep_dropoff_datetime")
    return y.where(d.between(F.lit("1997-03-01").cast("date"), F.lit("1997-03-15").cast("date"))).select(
        "VendorID").distinct()


@query("count_distinct_zone", "SELECT count(*) AS distinct_count FROM (SELECT DISTINCT VendorID FROM yellow_tripdata)")
def count_distinct_zone(spark, sf):
    # NULL vendor counts as one value, as in a count over a DISTINCT subquery.
    return R.distinct_count(fx.raw_trips(spark, sf, "yellow"), "VendorID")


@query("fn_date_trunc", """SELECT lpep_pickup_datetime AS pickup_datetime,
date_trunc('hour', lpep_pickup_datetime) AS hour, date_trunc('day', lpep_pickup_datetime) AS day,
date_trunc('month', lpep_pickup_datetime) AS month FROM green_tripdata""")
def fn_date_trunc(spark, sf):
    g = _green(spark, sf)
    return g.select("pickup_datetime", *[F.date_trunc(u, "pickup_datetime").cast("timestamp_ntz").alias(u)
                                         for u in ("hour", "day", "month")])


@query("fn_to_date", """SELECT VendorID, cast(tpep_pickup_datetime AS date) AS pickup_date,
cast(tpep_dropoff_datetime AS date) AS dropoff_date, PULocationID, DOLocationID, total_amount FROM yellow_tripdata""")
def fn_to_date(spark, sf):
    y = _yellow(spark, sf)
    return y.select("VendorID", F.to_date("pickup_datetime").alias("pickup_date"),
                    F.to_date("dropoff_datetime").alias("dropoff_date"), "PULocationID", "DOLocationID",
                    "total_amount")


@query("trip_duration_minutes", """SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS trip_duration_minutes FROM yellow_tripdata""")
def trip_duration_minutes(spark, sf):
    y = _yellow(spark, sf)
    return y.select("pickup_datetime", "dropoff_datetime",
                    X.trip_duration_minutes("pickup_datetime", "dropoff_datetime").alias("trip_duration_minutes"))


@query("fn_parse_timestamp", """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts_text,
date_trunc('second', ts) AS parsed, CAST(NULL AS TIMESTAMP) AS parsed_bad FROM events""")
def fn_parse_timestamp(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    t = e.select("event_id", X.timestamp_text("ts").alias("ts_text"), "props")
    return t.select("event_id", "ts_text",
                    X.parse_timestamp("ts_text").cast("timestamp_ntz").alias("parsed"),
                    X.parse_timestamp("props").cast("timestamp_ntz").alias("parsed_bad"))


@query("fn_epoch_millis", """SELECT event_id, epoch_ms(date_trunc('millisecond', ts)) AS ts_ms,
date_trunc('millisecond', ts) AS ts_back FROM events""")
def fn_epoch_millis(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    ms = e.select("event_id", X.epoch_millis("ts").alias("ts_ms"))
    return ms.select("event_id", "ts_ms", X.from_epoch_millis("ts_ms").cast("timestamp_ntz").alias("ts_back"))


@query("fn_month_sequence", """SELECT o_orderkey, list_transform(generate_series(date_trunc('month', o_orderdate),
date_trunc('month', o_orderdate + INTERVAL 75 DAY), INTERVAL 1 MONTH), lambda m: strftime(m, '%Y-%m')) AS months FROM orders""")
def fn_month_sequence(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select("o_orderkey", X.month_sequence("o_orderdate", F.date_add("o_orderdate", 75)).alias("months"))


_HASH7 = ("md5(coalesce(cast(VendorID AS varchar), '') || coalesce(cast(tpep_pickup_datetime AS varchar), '')"
          " || coalesce(cast(tpep_dropoff_datetime AS varchar), '') || coalesce(cast(PULocationID AS varchar), '')"
          " || coalesce(cast(DOLocationID AS varchar), '') || coalesce(cast(fare_amount AS varchar), '')"
          " || coalesce(cast(trip_distance AS varchar), ''))")
HASH7_COLUMNS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
                 "fare_amount", "trip_distance"]


@query("row_identity", f"SELECT {_HASH7} AS unique_row_id, filename, VendorID, tpep_pickup_datetime, total_amount FROM yellow_tripdata")
def row_identity(spark, sf):
    y = fx.raw_trips(spark, sf, "yellow")
    y = y.withColumn("unique_row_id", X.row_hash(hash_inputs(y, HASH7_COLUMNS)))
    return y.select("unique_row_id", "filename", "VendorID", "tpep_pickup_datetime", "total_amount")


@query("row_identity_bytes", """SELECT unhex(md5(coalesce(cast(VendorID AS varchar), '')
|| coalesce(cast(lpep_pickup_datetime AS varchar), '') || coalesce(cast(lpep_dropoff_datetime AS varchar), '')
|| coalesce(cast(PULocationID AS varchar), '') || coalesce(cast(DOLocationID AS varchar), ''))) AS unique_row_id,
filename, VendorID FROM green_tripdata""")
def row_identity_bytes(spark, sf):
    g = fx.raw_trips(spark, sf, "green")
    cols = ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID"]
    return g.select(X.row_hash(hash_inputs(g, cols), binary=True).alias("unique_row_id"), "filename", "VendorID")


@query("safe_cast", """SELECT cast(RatecodeID AS varchar) || CASE WHEN PULocationID % 7 = 0 THEN 'x' ELSE '' END AS rate_text,
try_cast(cast(RatecodeID AS varchar) || CASE WHEN PULocationID % 7 = 0 THEN 'x' ELSE '' END AS int) AS rate_code_id,
try_cast(store_and_fwd_flag AS int) AS flag_as_int FROM green_tripdata""")
def safe_cast_q(spark, sf):
    g = fx.raw_trips(spark, sf, "green")
    text = F.concat(F.col("RatecodeID").cast("string"),
                    F.when(F.col("PULocationID") % 7 == 0, F.lit("x")).otherwise(F.lit("")))
    return g.select(text.alias("rate_text"), X.safe_cast(text, "int").alias("rate_code_id"),
                    X.safe_cast("store_and_fwd_flag", "int").alias("flag_as_int"))


_PAY_CASE = ("CASE try_cast(payment_type AS int) WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' "
             "WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' ELSE 'EMPTY' END")


# The labels.
@query("case_payment", f"""SELECT payment_type, {_PAY_CASE} AS payment_type_description, count(*) AS trips
FROM yellow_tripdata GROUP BY 1, 2""")
def case_payment(spark, sf):
    y = fx.raw_trips(spark, sf, "yellow")
    return y.groupBy("payment_type", X.payment_description("payment_type").alias("payment_type_description")).agg(
        F.count(F.lit(1)).alias("trips"))


_VENDOR_CASE = ("CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.' "
                "WHEN 4 THEN 'Unknown/Other' END")


# The labels.
@query("case_vendor", f"SELECT DISTINCT VendorID AS vendor_id, {_VENDOR_CASE} AS vendor_name FROM yellow_tripdata")
def case_vendor(spark, sf):
    y = fx.raw_trips(spark, sf, "yellow")
    return y.select(F.col("VendorID").alias("vendor_id"), X.vendor_name("VendorID").alias("vendor_name")).distinct()


@query("udf_vendor_code", """SELECT VendorID, CASE WHEN VendorID IS NULL THEN NULL
WHEN (VendorID + 1) % 3 = 0 THEN 's/' || lpad(cast(VendorID + 1 AS varchar), 3, '0')
ELSE 'e/' || lpad(cast(VendorID + 1 AS varchar), 3, '0') END AS ModVenID,
cast(tpep_pickup_datetime AS date) AS pickup_date, PULocationID, total_amount FROM yellow_tripdata""")
def udf_vendor_code(spark, sf):
    y = fx.raw_trips(spark, sf, "yellow")
    return y.select("VendorID", X.vendor_code("VendorID").alias("ModVenID"),
                    F.to_date("tpep_pickup_datetime").alias("pickup_date"), "PULocationID", "total_amount")


@query("format_check", r"""SELECT count(*) AS n_rows,
count(*) FILTER (WHERE regexp_full_match(strftime(ts, '%Y-%m-%d %H:%M:%S'), '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}')) AS n_ts_ok,
count(*) FILTER (WHERE regexp_full_match(props, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}')) AS n_props_ok FROM events""")
def format_check(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    pat = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
    return e.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(X.matches_full(X.timestamp_text("ts"), pat)).alias("n_ts_ok"),
                 F.count_if(X.matches_full("props", pat)).alias("n_props_ok"))


@query("typed_record", """SELECT cast(PULocationID AS int) AS PULocationID, cast(DOLocationID AS int) AS DOLocationID,
cast(trip_distance AS double) AS trip_distance, cast(total_amount AS double) AS total_amount,
epoch_ms(date_trunc('millisecond', event_ts)) AS tpep_pickup_datetime FROM rides""")
def typed_record(spark, sf):
    r = fx.rides(spark, sf)
    return r.select(F.col("PULocationID").cast("int").alias("PULocationID"),
                    F.col("DOLocationID").cast("int").alias("DOLocationID"),
                    F.col("trip_distance").cast("double").alias("trip_distance"),
                    F.col("total_amount").cast("double").alias("total_amount"),
                    X.epoch_millis("event_ts").alias("tpep_pickup_datetime"))


@query("json_roundtrip", """SELECT count(*) AS n_rows, count(*) AS n_equal FROM rides""")
def json_roundtrip(spark, sf):
    from fareway.streaming.sources import RIDE_TEXT_SCHEMA, to_text_message

    r = to_text_message(fx.rides(spark, sf))
    cols = [f.name for f in RIDE_TEXT_SCHEMA.fields]
    enc = r.select(F.struct(*cols).alias("rec"), F.to_json(F.struct(*cols)).alias("value"))
    dec = enc.select("rec", F.from_json("value", RIDE_TEXT_SCHEMA).alias("back"))
    return dec.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_if(F.col("rec") == F.col("back")).alias("n_equal"))


@query("fill_zero", """SELECT coalesce(VendorID, 0) AS VendorID, lpep_pickup_datetime, PULocationID,
coalesce(payment_type, 0) AS payment_type, coalesce(ehail_fee, 0) AS ehail_fee,
coalesce(congestion_surcharge, 0) AS congestion_surcharge, store_and_fwd_flag FROM green_tripdata""")
def fill_zero(spark, sf):
    g = fx.raw_trips(spark, sf, "green").select("VendorID", "lpep_pickup_datetime", "PULocationID", "payment_type",
                                                "ehail_fee", "congestion_surcharge", "store_and_fwd_flag")
    return S.fill_zero(g)


@query("dev_sample", """SELECT * FROM fhv_tripdata WHERE pickup_datetime >= TIMESTAMP '1995-01-01'
AND pickup_datetime < TIMESTAMP '1995-02-01'""")
def dev_sample(spark, sf):
    return S.dev_sample(fx.fhv_trips(spark, sf), True, "pickup_datetime", "1995-01-01", "1995-02-01")


@query("dim_zones", "SELECT LocationID AS location_id, Borough AS borough, Zone AS zone, service_zone FROM zones")
def dim_zones_q(spark, sf):
    return S.dim_zones(fx.zones(spark, sf))


# The table DDL a preview of the yellow file prints (written out by hand).
_YELLOW_DDL = ("CREATE TABLE yellow_tripdata (`VendorID` int, `tpep_pickup_datetime` timestamp_ntz, "
               "`tpep_dropoff_datetime` timestamp_ntz, `passenger_count` bigint, `trip_distance` double, "
               "`RatecodeID` int, `store_and_fwd_flag` string, `PULocationID` int, `DOLocationID` int, "
               "`payment_type` int, `fare_amount` decimal(18,2), `extra` decimal(18,2), `mta_tax` decimal(18,2), "
               "`tip_amount` decimal(18,2), `tolls_amount` decimal(18,2), `improvement_surcharge` decimal(18,2), "
               "`total_amount` decimal(18,2), `congestion_surcharge` decimal(18,2), `filename` string)")


@query("profile", f"""SELECT count(*) AS row_count, 19 AS column_count, count(*) - count(VendorID) AS null_VendorID,
count(*) - count(payment_type) AS null_payment_type, count(DISTINCT PULocationID) AS distinct_PULocationID,
min(tpep_pickup_datetime) AS min_pickup, max(tpep_pickup_datetime) AS max_pickup,
'{_YELLOW_DDL}' AS ddl FROM yellow_tripdata""")
def profile(spark, sf):
    """Preview of a frame: shape, null and distinct counts, time span (one
    aggregate pass) and the table DDL of its schema."""
    from fareway.operators.quality import profile as prof, schema_ddl

    y = fx.raw_trips(spark, sf, "yellow")
    out = prof(y, nulls=["VendorID", "payment_type"], distinct=["PULocationID"], span="tpep_pickup_datetime")
    return out.withColumns({"column_count": F.lit(len(y.columns)),
                            "ddl": F.lit(schema_ddl(y, "yellow_tripdata"))})


# ------------------------------------------------------------------ A4 with the optional fee columns

@query("revenue_monthly_fees", """SELECT PULocationID AS pickup_zone, date_trunc('month', tpep_pickup_datetime) AS revenue_month,
cast(sum(CASE WHEN PULocationID % 5 = 0 THEN 1.75 ELSE 0 END) AS decimal(38,2)) AS revenue_monthly_Airport_fee,
cast(sum(CASE WHEN DOLocationID % 2 = 0 THEN 0.75 END) AS decimal(38,2)) AS revenue_monthly_cbd_congestion_fee,
cast(sum(total_amount) AS decimal(38,2)) AS revenue_monthly_total_amount FROM yellow_tripdata GROUP BY 1, 2""")
def revenue_monthly_fees(spark, sf):
    """Monthly revenue of trips that carry the airport and congestion-zone fees."""
    y = _yellow(spark, sf).withColumns({
        "Airport_fee": F.when(F.col("PULocationID") % 5 == 0, F.lit("1.75")).otherwise(F.lit("0")).cast("decimal(18,2)"),
        "cbd_congestion_fee": F.when(F.col("DOLocationID") % 2 == 0, F.lit("0.75")).cast("decimal(18,2)"),
        "service_type": F.lit("Yellow")})
    return R.revenue_monthly(y).select("pickup_zone", "revenue_month", "revenue_monthly_Airport_fee",
                                       "revenue_monthly_cbd_congestion_fee", "revenue_monthly_total_amount")
