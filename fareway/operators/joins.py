"""Equi-joins of trips to their dimensions.

No hint and no count: Catalyst broadcasts a lookup below its byte threshold,
and adaptive execution decides again from the sizes it has seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def enrich_payment(trips: DataFrame, lookup: DataFrame, code: str = "payment_type",
                   lookup_code: str = "payment_type", label: str = "description",
                   out_label: str = "payment_type_description", unknown: str = "Unknown") -> DataFrame:
    """Left join on ``coalesce(code, 0)``; a missing label becomes ``unknown``.

    The output code column is the coalesced one.
    """
    lk = lookup.select(F.col(lookup_code).alias("_pk"), F.col(label).alias("_pl"))
    t = trips.withColumn(code, F.coalesce(F.col(code), F.lit(0)))
    return (t.join(lk, t[code] == lk["_pk"], "left")
            .withColumn(out_label, F.coalesce(F.col("_pl"), F.lit(unknown)))
            .drop("_pk", "_pl"))


def enrich_zones(trips: DataFrame, zones: DataFrame, pickup: str = "pickup_location_id",
                 dropoff: str = "dropoff_location_id") -> DataFrame:
    """Role-playing dimension: the zone table joined twice (pickup, dropoff)."""
    z = zones.select("location_id", "borough", "zone")
    pz = z.select(F.col("location_id").alias("_pz_id"), F.col("borough").alias("pickup_borough"),
                  F.col("zone").alias("pickup_zone"))
    dz = z.select(F.col("location_id").alias("_dz_id"), F.col("borough").alias("dropoff_borough"),
                  F.col("zone").alias("dropoff_zone"))
    out = trips.join(pz, trips[pickup] == pz["_pz_id"], "left")
    out = out.join(dz, out[dropoff] == dz["_dz_id"], "left")
    return out.drop("_pz_id", "_dz_id")


def outer_revenue(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join USING ``keys`` (key columns coalesced).

    Both inputs are aggregates hash-partitioned on ``keys``, so the
    sort-merge join reuses their partitioning without another exchange.
    """
    return a.join(b, on=keys, how="outer")


def join_lookup_by_text_id(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """Inner join of an integer key to a text id of a lookup (cast explicit)."""
    return df.join(lookup, df[key] == lookup[lookup_key].try_cast("int"), "inner")
