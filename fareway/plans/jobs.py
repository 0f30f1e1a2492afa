"""Composite jobs: the reference's pipelines as chains of our operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.functions import columns as X
from fareway.operators import joins as J
from fareway.operators import reports as R
from fareway.operators import staging as S
from fareway.operators.dedup import dedup_first

# ---------------------------------------------------------------- E1 revenue job


def revenue_job(spark: SparkSession, green: DataFrame, yellow: DataFrame, zones_text: DataFrame,
                output: str, since: str | None = None, files: int | None = None) -> dict[str, str]:
    """Hourly revenue of both services, their full outer join, and the
    zone-named report, each written under ``output``.

    The two hourly aggregates are written once and the join reads the
    written reports back, so nothing is recomputed and a lost executor only
    re-runs the stage it was in.
    """
    from fareway.sources.writers import write_report

    out = {}
    for name, df in (("green", green), ("yellow", yellow)):
        agg = R.revenue_hourly(S.normalize_trip_names(df), name, since)
        out[name] = write_report(R.ordered(agg, "hour", "zone_id"), f"{output}/{name}", files=files)
    g = spark.read.parquet(out["green"])
    y = spark.read.parquet(out["yellow"])
    total = J.outer_revenue(g, y, ["hour", "zone_id"])
    out["total"] = write_report(R.ordered(total, "hour", "zone_id"), f"{output}/total", files=files)
    named = J.join_lookup_by_text_id(spark.read.parquet(out["total"]), zones_text, "zone_id", "LocationID")
    out["zones"] = write_report(named.drop("LocationID", "zone_id"), f"{output}/zones", files=files)
    return out


# ---------------------------------------------------------------- E3 layered models

def int_trips_unioned(green_raw: DataFrame, yellow_raw: DataFrame) -> DataFrame:
    return S.union_trips(S.stage_green(green_raw), S.stage_yellow(yellow_raw))


TRIP_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]


def int_trips(unioned: DataFrame, payment_lookup: DataFrame) -> DataFrame:
    """The first trip per (vendor, pickup time, pickup zone, service) by
    dropoff time, then payment label and surrogate trip id for what is left."""
    first = dedup_first(unioned, TRIP_KEY, [F.col("dropoff_datetime").asc_nulls_last()])
    enriched = J.enrich_payment(first, payment_lookup)
    types = {f.name: f.dataType.simpleString() for f in enriched.schema.fields}
    enriched = enriched.withColumn("trip_id", X.surrogate_key([(F.col(c), types[c]) for c in TRIP_KEY]))
    cols = ["trip_id", "vendor_id", "service_type", "rate_code_id", "pickup_location_id",
            "dropoff_location_id", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
            "passenger_count", "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax",
            "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
            "payment_type", "payment_type_description"]
    return enriched.select(*cols)


FCT_COLUMNS = ["trip_id", "vendor_id", "service_type", "rate_code_id", "pickup_location_id",
               "pickup_borough", "pickup_zone", "dropoff_location_id", "dropoff_borough", "dropoff_zone",
               "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
               "trip_distance", "trip_type", "trip_duration_minutes", "fare_amount", "extra", "mta_tax",
               "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
               "payment_type", "payment_type_description"]


def fct_trips(trips: DataFrame, dim_zones: DataFrame, since: DataFrame | None = None) -> DataFrame:
    """Fact table: trips with pickup and dropoff zone names and duration.

    ``since`` (optional) is the existing fact; only trips strictly after
    its latest pickup are produced (incremental build).
    """
    if since is not None:
        from fareway.operators.loads import incremental_since

        trips = incremental_since(trips, since, "pickup_datetime")
    out = J.enrich_zones(trips, dim_zones)
    out = out.withColumn("trip_duration_minutes",
                         X.trip_duration_minutes("pickup_datetime", "dropoff_datetime"))
    return out.select(*FCT_COLUMNS)


def dim_vendors(fct: DataFrame) -> DataFrame:
    return fct.select("vendor_id", X.vendor_name("vendor_id").alias("vendor_name")).distinct()


def build_models(green_raw: DataFrame, yellow_raw: DataFrame, zones: DataFrame,
                 payment_lookup: DataFrame) -> dict[str, DataFrame]:
    """The layered model DAG as lazily chained frames."""
    unioned = int_trips_unioned(green_raw, yellow_raw)
    trips = int_trips(unioned, payment_lookup)
    dz = S.dim_zones(zones)
    fct = fct_trips(trips, dz)
    return {"int_trips_unioned": unioned, "int_trips": trips, "dim_zones": dz, "fct_trips": fct,
            "dim_vendors": dim_vendors(fct), "fct_monthly_zone_revenue": R.monthly_zone_revenue(fct)}


# ---------------------------------------------------------------- E4 ELT


def snake_case_trip_columns(df: DataFrame) -> DataFrame:
    """Loader naming: PULocationID -> pu_location_id, DOLocationID -> do_location_id."""
    ren = {c: {"pulocationid": "pu_location_id", "dolocationid": "do_location_id"}[c.lower()]
           for c in df.columns if c.lower() in ("pulocationid", "dolocationid")}
    return df.withColumnsRenamed(ren)


ELT_COLUMNS = ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
               "taxi_type", "passenger_count", "trip_distance", "payment_type", "payment_type_name",
               "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
               "total_amount", "ingested_at", "filename"]


def elt_staging(ingested: DataFrame, payment_lookup: DataFrame, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """Staging of ingested trips: unified timestamps, payment names,
    duplicates removed by business key (first by file name).

    The run window is applied before the dedup: pickup time is part of the
    key, so the result equals filtering afterwards, but the filter reaches
    the scan.
    """
    t = snake_case_trip_columns(ingested)
    pickup = S.unify(*[c for c in ("tpep_pickup_datetime", "lpep_pickup_datetime") if c in t.columns])
    dropoff = S.unify(*[c for c in ("tpep_dropoff_datetime", "lpep_dropoff_datetime") if c in t.columns])
    base = t.select(
        "taxi_type", pickup.alias("pickup_datetime"), dropoff.alias("dropoff_datetime"),
        F.col("pu_location_id").alias("pickup_location_id"),
        F.col("do_location_id").alias("dropoff_location_id"),
        "passenger_count", "trip_distance", "total_amount", "fare_amount", "extra", "mta_tax", "tip_amount",
        "tolls_amount", "improvement_surcharge", "payment_type", "filename", "ingested_at")
    base = base.where(F.col("pickup_datetime").isNotNull() & (F.col("total_amount") >= 0)
                      & (F.col("fare_amount") >= 0))
    base = R.in_window(base, "pickup_datetime", start, end)
    key = ["taxi_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
           "total_amount"]
    first = dedup_first(base, key, [F.col("filename").asc_nulls_last()])
    # Labels after the dedup: they follow from the code, and fewer rows need them. NULL codes never match (plain equality).
    lk = payment_lookup.select("payment_type_id", "payment_type_name")
    named = first.join(lk, first.payment_type == lk.payment_type_id, "left").drop("payment_type_id")
    return named.withColumn("payment_type_name", F.coalesce("payment_type_name", F.lit("Unknown"))).select(
        *ELT_COLUMNS)


def ingest_frame(green_raw: DataFrame, yellow_raw: DataFrame, now: dt.datetime) -> DataFrame:
    """In-memory form of the month ingest: both services by name, tagged."""
    frames = [g.withColumns({"taxi_type": F.lit(t), "ingested_at": F.lit(now).cast("timestamp_ntz")})
              for t, g in (("yellow", yellow_raw), ("green", green_raw))]
    return S.union_by_name(frames)


# ---------------------------------------------------------------- E6 JSON products


def product_documents(part: DataFrame, per_doc: int = 50) -> DataFrame:
    """One JSON document per block of ``per_doc`` consecutive parts, each
    ``{"products": [...]}``. The brand key is absent for some products and
    present-but-null for others."""
    missing = F.col("p_partkey") % 11 == 0
    nulled = F.col("p_partkey") % 13 == 0
    full = F.to_json(F.struct(F.col("p_name").alias("title"),
                              F.when(nulled, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("brand"),
                              F.col("p_retailprice").alias("price")), {"ignoreNullFields": "false"})
    short = F.to_json(F.struct(F.col("p_name").alias("title"), F.col("p_retailprice").alias("price")))
    prod = part.select((F.col("p_partkey") / per_doc).cast("bigint").alias("doc_id"),
                       F.when(missing, short).otherwise(full).alias("product"))
    docs = prod.groupBy("doc_id").agg(F.collect_list("product").alias("items"))
    return docs.select(F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(', "products": ['),
                                F.array_join("items", ", "), F.lit("]}")).alias("value"))


def avg_price_by_brand(products: DataFrame) -> DataFrame:
    """Average price per brand (2 decimals), highest first; the brand
    of a product without one is the default 'N/A'."""
    price = F.col("price").cast("decimal(18,2)")
    agg = products.groupBy("brand").agg(F.round(R.exact_avg(price), 2).alias("avg_price"))
    return agg.orderBy(F.col("avg_price").desc())


# ---------------------------------------------------------------- E5 file load


def load_trip_file(spark: SparkSession, csv_path: str, schema, filename: str, staging: str, target: str,
                   hash_columns: list[str]) -> int:
    """One trip file into the warehouse table: typed CSV read, staging
    reloaded (truncate + load of the listed columns), hash identity and file
    name added, then an insert-only merge on the identity. Columns that staging
    or target lack are added to them. Re-loading a
    file inserts nothing. Returns the number of inserted rows."""
    from fareway.operators.loads import add_row_identity, merge_insert_only
    from fareway.sources.files import copy_in, read_trips_csv
    from fareway.sources.writers import add_columns, truncate_load

    raw = read_trips_csv(spark, csv_path, schema)
    add_columns(staging, raw)
    truncate_load(spark, copy_in(raw, [f.name for f in schema.fields], spark.table(staging).schema), staging)
    staged = spark.table(staging).drop("unique_row_id", "filename")
    with_id = add_row_identity(staged, hash_columns, filename=filename)
    return merge_insert_only(target, with_id, "unique_row_id", within=hash_columns)


def build_fact_incremental(spark: SparkSession, table: str, trips: DataFrame, dim_zones: DataFrame,
                           full_refresh: bool = False) -> DataFrame:
    """The fact table as an incremental model with a unique key.

    First build (or ``full_refresh``): the whole fact. Later builds: only
    trips after the table's latest pickup, upserted on ``trip_id``; new
    columns of the model are appended to the table (old rows NULL).
    """
    from fareway.operators.loads import materialize

    if full_refresh or not spark.catalog.tableExists(table):
        return materialize(fct_trips(trips, dim_zones), "replace", table)
    existing = spark.table(table)
    new = fct_trips(trips, dim_zones, since=existing)
    return materialize(new, "merge", table, key="trip_id")
