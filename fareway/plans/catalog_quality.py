"""Data-quality checks over the trip views (one row per check)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fareway.functions import columns as X
from fareway.operators import loads as L
from fareway.operators import quality as Q
from fareway.plans import fixtures as fx
from fareway.plans import jobs
from fareway.plans.catalog_batch import HASH7_COLUMNS, _HASH7
from fareway.plans.catalog_models import ELT, MODEL_CTES, _ingested, elt_staging_df
from fareway.plans.registry import query
from fareway.schemas import FCT_TRIPS_CONTRACT

FRESHNESS_NOW = dt.datetime(2024, 1, 2, 12, 0, 0)


def _row(check, table, column, failed):
    return (f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
            f"cast({failed} AS bigint) AS failed_rows, ({failed}) = 0 AS passed")


def _yellow(spark, sf):
    return fx.raw_trips(spark, sf, "yellow")


@query("check_not_null", " UNION ALL ".join([
    _row("not_null", "yellow_tripdata", "VendorID", "(SELECT count(*) FROM yellow_tripdata WHERE VendorID IS NULL)"),
    _row("not_null", "yellow_tripdata", "payment_type",
         "(SELECT count(*) FROM yellow_tripdata WHERE payment_type IS NULL)")]))
def check_not_null(spark, sf):
    return Q.check_suite(_yellow(spark, sf), "yellow_tripdata", [("not_null", "VendorID"), ("not_null", "payment_type")])


@query("check_unique", _row("unique", "yellow_tripdata", "unique_row_id",
                            "(SELECT count(*) FROM (SELECT unique_row_id FROM y_id WHERE unique_row_id IS NOT NULL "
                            "GROUP BY 1 HAVING count(*) > 1))"),
       f"y_id AS (SELECT {_HASH7} AS unique_row_id FROM yellow_tripdata)")
def check_unique(spark, sf):
    y = L.add_row_identity(_yellow(spark, sf), HASH7_COLUMNS)
    return Q.check_unique(y, "yellow_tripdata", "unique_row_id")


@query("check_unique_combination", _row(
    "unique_combination_of_columns", "yellow_tripdata", "VendorID,tpep_pickup_datetime,PULocationID",
    "(SELECT count(*) FROM (SELECT 1 FROM yellow_tripdata GROUP BY VendorID, tpep_pickup_datetime, PULocationID "
    "HAVING count(*) > 1))"))
def check_unique_combination(spark, sf):
    return Q.check_unique_combination(_yellow(spark, sf), "yellow_tripdata",
                                      ["VendorID", "tpep_pickup_datetime", "PULocationID"])


@query("check_accepted_values", _row("accepted_values", "yellow_tripdata", "VendorID",
                                     "(SELECT count(*) FROM yellow_tripdata WHERE VendorID NOT IN (1, 2))"))
def check_accepted_values(spark, sf):
    return Q.check_accepted_values(_yellow(spark, sf), "yellow_tripdata", "VendorID", [1, 2])


@query("check_relationships", _row(
    "relationships", "yellow_tripdata", "PULocationID",
    "(SELECT count(*) FROM yellow_tripdata y WHERE PULocationID IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM zones z WHERE z.LocationID = y.PULocationID))"))
def check_relationships(spark, sf):
    return Q.check_relationships(_yellow(spark, sf), "yellow_tripdata", "PULocationID", fx.zones(spark, sf),
                                 "LocationID")


@query("check_non_negative", " UNION ALL ".join([
    _row("non_negative", "yellow_tripdata", "fare_amount", "(SELECT count(*) FROM yellow_tripdata WHERE fare_amount < 0)"),
    _row("non_negative", "yellow_tripdata", "trip_distance",
         "(SELECT count(*) FROM yellow_tripdata WHERE trip_distance < 0)"),
    _row("positive", "yellow_tripdata", "total_amount", "(SELECT count(*) FROM yellow_tripdata WHERE total_amount <= 0)"),
]))
def check_non_negative(spark, sf):
    return Q.check_suite(_yellow(spark, sf), "yellow_tripdata",
                         [("non_negative", "fare_amount"), ("non_negative", "trip_distance"),
                          ("positive", "total_amount")])


@query("check_custom", _row("custom", "elt_staging", "non_negative_total_amount",
                            "(SELECT count(*) FROM elt_staging WHERE total_amount < 0)"), ELT)
def check_custom(spark, sf):
    return Q.check_custom(elt_staging_df(spark, sf), "elt_staging", "non_negative_total_amount", "total_amount < 0")


@query("check_row_count", _row("row_count_positive", "elt_report", "*",
                               "(SELECT CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM elt_report)"), ELT)
def check_row_count(spark, sf):
    from fareway.operators import reports as R

    rep = R.trips_report(elt_staging_df(spark, sf))
    return Q.check_row_count(rep, "elt_report")


@query("check_contract", _row("contract", "fct_trips", "*", "0"))
def check_contract(spark, sf):
    fct = jobs.build_models(fx.raw_trips(spark, sf, "green"), fx.raw_trips(spark, sf, "yellow"),
                            fx.zones(spark, sf), fx.payment_lookup(spark))["fct_trips"]
    return Q.check_contract(fct, "fct_trips", FCT_TRIPS_CONTRACT)


@query("check_freshness", """SELECT 'freshness' AS "check", 'ingested' AS "table", 'ingested_at' AS "column",
CAST(CASE WHEN m IS NULL OR h > 48 THEN 1 ELSE 0 END AS bigint) AS failed_rows, NOT (m IS NULL OR h > 48) AS passed,
CASE WHEN m IS NULL OR h > 48 THEN 'error' WHEN h > 24 THEN 'warn' ELSE 'pass' END AS status, m AS max_loaded_at
FROM (SELECT m, (epoch(TIMESTAMP '2024-01-02 12:00:00') - epoch(m)) / 3600.0 AS h
FROM (SELECT max(ingested_at) AS m FROM ingested))""", ELT)
def check_freshness(spark, sf):
    return Q.check_freshness(_ingested(spark, sf), "ingested", "ingested_at", FRESHNESS_NOW)


_PK_COLS = ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"]


@query("check_primary_key", " UNION ALL ".join([
    _row("primary_key", "elt_staging", ",".join(_PK_COLS),
         f"(SELECT count(*) FROM (SELECT 1 FROM elt_staging GROUP BY {', '.join(_PK_COLS)} HAVING count(*) > 1))"),
    _row("not_null", "elt_staging", "pickup_datetime",
         "(SELECT count(*) FROM elt_staging WHERE pickup_datetime IS NULL)"),
    _row("not_null", "elt_staging", "dropoff_datetime",
         "(SELECT count(*) FROM elt_staging WHERE dropoff_datetime IS NULL)")]), ELT)
def check_primary_key(spark, sf):
    return Q.check_primary_key(elt_staging_df(spark, sf), "elt_staging", _PK_COLS,
                               not_null=["pickup_datetime", "dropoff_datetime"])


@query("check_suite", " UNION ALL ".join([
    _row("not_null", "stg_yellow", "vendor_id", "(SELECT count(*) FROM stg_yellow WHERE vendor_id IS NULL)"),
    _row("non_negative", "stg_yellow", "total_amount", "(SELECT count(*) FROM stg_yellow WHERE total_amount < 0)"),
    _row("accepted_values", "stg_yellow", "payment_type",
         "(SELECT count(*) FROM stg_yellow WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6))"),
    _row("unique", "stg_yellow", "trip_key", f"(SELECT count(*) FROM (SELECT k FROM (SELECT md5(concat_ws('-', "
         f"cast(vendor_id AS varchar), cast(pickup_datetime AS varchar), cast(pickup_location_id AS varchar))) "
         f"AS k FROM stg_yellow) GROUP BY k HAVING count(*) > 1))"),
    _row("relationships", "stg_yellow", "dropoff_location_id",
         "(SELECT count(*) FROM stg_yellow y WHERE dropoff_location_id IS NOT NULL AND NOT EXISTS "
         "(SELECT 1 FROM zones z WHERE z.LocationID = y.dropoff_location_id))")]), MODEL_CTES)
def check_suite(spark, sf):
    """Itemised results of every check on staged yellow trips (row-level
    checks share one scan). ``Q.assert_checks`` raises on any failure."""
    from fareway.operators import staging as S

    y = S.stage_yellow(_yellow(spark, sf))
    y = y.withColumn("trip_key", F.md5(F.concat_ws("-", F.col("vendor_id").cast("string"),
                                                   F.col("pickup_datetime").cast("string"),
                                                   F.col("pickup_location_id").cast("string"))))
    row_level = Q.check_suite(y, "stg_yellow", [("not_null", "vendor_id"), ("non_negative", "total_amount"),
                                                ("accepted_values", "payment_type", [1, 2, 3, 4, 5, 6])])
    return (row_level.unionByName(Q.check_unique(y, "stg_yellow", "trip_key"))
            .unionByName(Q.check_relationships(y, "stg_yellow", "dropoff_location_id", fx.zones(spark, sf),
                                               "LocationID")))

