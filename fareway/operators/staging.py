"""Schema standardisation of the raw trip files (projections and unions)."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareway.functions.columns import safe_cast

MONEY = "decimal(18,3)"  # warehouse 'numeric' spelled with an explicit precision


def normalize_trip_names(df: DataFrame) -> DataFrame:
    """tpep_/lpep_ pickup and dropoff columns -> pickup_datetime/dropoff_datetime."""
    mapping = {}
    for c in df.columns:
        low = c.lower()
        for pre in ("tpep_", "lpep_"):
            if low.startswith(pre) and low[len(pre):] in ("pickup_datetime", "dropoff_datetime"):
                mapping[c] = low[len(pre):]
    return df.withColumnsRenamed(mapping) if mapping else df


def tag_service(df: DataFrame, value: str, name: str = "service_type") -> DataFrame:
    return df.withColumn(name, F.lit(value))


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns present in both frames, in the order of the first."""
    other = {c.lower() for c in b.columns}
    return [c for c in a.columns if c.lower() in other]


def union_common(frames: list[DataFrame]) -> DataFrame:
    cols = frames[0].columns
    for f in frames[1:]:
        keep = {c.lower() for c in f.columns}
        cols = [c for c in cols if c.lower() in keep]
    return reduce(lambda x, y: x.unionByName(y), [f.select(*cols) for f in frames])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Name-wise concat; columns missing from a frame become NULL."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def _col(df: DataFrame, name: str) -> Column:
    # Column names are case-insensitive in effect (sources say 'vendorid').
    for c in df.columns:
        if c.lower() == name.lower():
            return F.col(f"`{c}`")
    raise KeyError(name)


def stage_yellow(df: DataFrame) -> DataFrame:
    """Rename + type the yellow file; rows without a vendor are dropped."""
    c = lambda n: _col(df, n)
    return df.where(c("vendorid").isNotNull()).select(
        c("vendorid").cast("int").alias("vendor_id"),
        c("ratecodeid").cast("int").alias("rate_code_id"),
        c("pulocationid").cast("int").alias("pickup_location_id"),
        c("dolocationid").cast("int").alias("dropoff_location_id"),
        c("tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        c("tpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        c("store_and_fwd_flag").cast("string").alias("store_and_fwd_flag"),
        c("passenger_count").cast("int").alias("passenger_count"),
        c("trip_distance").cast(MONEY).alias("trip_distance"),
        c("fare_amount").cast(MONEY).alias("fare_amount"),
        c("extra").cast(MONEY).alias("extra"),
        c("mta_tax").cast(MONEY).alias("mta_tax"),
        c("tip_amount").cast(MONEY).alias("tip_amount"),
        c("tolls_amount").cast(MONEY).alias("tolls_amount"),
        c("improvement_surcharge").cast(MONEY).alias("improvement_surcharge"),
        c("total_amount").cast(MONEY).alias("total_amount"),
        c("payment_type").cast("int").alias("payment_type"),
    )


def stage_green(df: DataFrame) -> DataFrame:
    """Rename + type the green file; rate code, trip type, payment cast safely."""
    c = lambda n: _col(df, n)
    return df.where(c("vendorid").isNotNull()).select(
        c("vendorid").cast("int").alias("vendor_id"),
        safe_cast(c("ratecodeid"), "int").alias("rate_code_id"),
        c("pulocationid").cast("int").alias("pickup_location_id"),
        c("dolocationid").cast("int").alias("dropoff_location_id"),
        c("lpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        c("lpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        c("store_and_fwd_flag").cast("string").alias("store_and_fwd_flag"),
        c("passenger_count").cast("int").alias("passenger_count"),
        c("trip_distance").cast(MONEY).alias("trip_distance"),
        safe_cast(c("trip_type"), "int").alias("trip_type"),
        c("fare_amount").cast(MONEY).alias("fare_amount"),
        c("extra").cast(MONEY).alias("extra"),
        c("mta_tax").cast(MONEY).alias("mta_tax"),
        c("tip_amount").cast(MONEY).alias("tip_amount"),
        c("tolls_amount").cast(MONEY).alias("tolls_amount"),
        c("ehail_fee").cast(MONEY).alias("ehail_fee"),
        c("improvement_surcharge").cast(MONEY).alias("improvement_surcharge"),
        c("total_amount").cast(MONEY).alias("total_amount"),
        safe_cast(c("payment_type"), "int").alias("payment_type"),
    )


def stage_fhv(df: DataFrame) -> DataFrame:
    """For-hire trips: drop rows without a dispatching base, rename."""
    c = lambda n: _col(df, n)
    return df.where(c("dispatching_base_num").isNotNull()).select(
        c("dispatching_base_num").alias("dispatching_base_num"),
        c("pickup_datetime").alias("pickup_datetime"),
        c("dropoff_datetime").alias("dropoff_datetime"),
        c("pulocationid").cast("int").alias("pickup_location_id"),
        c("dolocationid").cast("int").alias("dropoff_location_id"),
        c("sr_flag").alias("SR_Flag"),
        c("affiliated_base_number").alias("affiliated_base_number"),
    )


UNIONED_COLUMNS = [
    "vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount", "payment_type",
    "service_type",
]


def union_trips(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both staged services on one column list; yellow gets typed constants
    for the columns it lacks (street-hail trip type 1, no e-hail fee)."""
    g = green.withColumn("service_type", F.lit("Green")).select(*UNIONED_COLUMNS)
    y = (yellow.withColumn("trip_type", F.lit(1).cast("int"))
         .withColumn("ehail_fee", F.lit(0).cast(MONEY))
         .withColumn("service_type", F.lit("Yellow"))
         .select(*UNIONED_COLUMNS))
    return g.unionByName(y)


def dim_zones(zones: DataFrame) -> DataFrame:
    """Pass-through rename of the zone seed."""
    c = lambda n: _col(zones, n)
    return zones.select(c("locationid").alias("location_id"), c("borough").alias("borough"),
                        c("zone").alias("zone"), c("service_zone").alias("service_zone"))


def fill_zero(df: DataFrame) -> DataFrame:
    """NULL -> 0 in every numeric column (others untouched)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.fillna(0, subset=numeric) if numeric else df


def unify(*cols: str | Column) -> Column:
    """First non-null of alternate spellings of one logical column."""
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols])


def project_keys(df: DataFrame, json_col: str, keys: list[str], default: str = "N/A",
                 schema: str = "string") -> DataFrame:
    """Keep only ``keys`` of a JSON object column; a missing key gives
    ``default`` while a key present with null stays null."""
    m = F.from_json(F.col(json_col), T.MapType(T.StringType(), T.StringType()))
    out = [F.when(F.map_contains_key(m, k), m[k]).otherwise(F.lit(default)).alias(k) for k in keys]
    return df.select(*out)


def dev_sample(df: DataFrame, enabled: bool, col: str, start: str, end: str) -> DataFrame:
    """Deterministic development slice: a half-open time range when enabled."""
    if not enabled:
        return df
    return df.where((F.col(col) >= F.lit(start).cast("timestamp_ntz"))
                    & (F.col(col) < F.lit(end).cast("timestamp_ntz")))


def parse_params(raw: str | None, default_types=("yellow",)) -> list[str]:
    """The services named by a run's JSON settings; ``default_types`` where
    the settings are absent, not JSON, or do not hold a list of them."""
    fallback = list(default_types)
    if not raw:
        return fallback
    try:
        settings = json.loads(raw)
    except (ValueError, TypeError):
        return fallback
    named = settings.get("taxi_types") if isinstance(settings, dict) else None
    return named if isinstance(named, list) else fallback


def parse_run_date(text: str) -> str:
    """The calendar day (yyyy-MM-dd) of a run date or timestamp text."""
    day = re.match(r"\s*(\d{4}-\d{2}-\d{2})", text)
    if not day:
        raise ValueError(f"not a run date: {text!r}")
    return day[1]
