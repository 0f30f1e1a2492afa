"""Aggregations, ranked questions and marts over trips.

Sums of money are cast to ``decimal(38,2|3)`` and averages are computed as
``double(sum) / count`` (exact sum, one IEEE division), so results are
bit-identical across engines and independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareway.functions import columns as X


def money_sum(c: str | Column, scale: int = 2) -> Column:
    """Sum rounded once, at the end. Pass floating point through ``columns.exact``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast(f"decimal(38,{scale})")


def exact_avg(c: str | Column) -> Column:
    """avg as double(exact sum) / count of non-null values."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast("double") / F.count(c)


def int_sum(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast("bigint")


def in_window(df: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Half-open ``[start, end)`` on a timestamp column (pushable range)."""
    c = F.col(col)
    if start is not None:
        df = df.where(c >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(c < F.lit(end).cast("timestamp_ntz"))
    return df


def on_day(df: DataFrame, col: str, day: str) -> DataFrame:
    """Rows whose timestamp falls on ``day``, written as a pushable range."""
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    return df.where((F.col(col) >= start) & (F.col(col) < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")))


def in_month(df: DataFrame, col: str, month_start: str) -> DataFrame:
    """``date_trunc('month', col) = month_start`` rewritten as a range."""
    s = F.lit(month_start).cast("date")
    return df.where((F.col(col) >= s.cast("timestamp_ntz"))
                    & (F.col(col) < F.add_months(s, 1).cast("timestamp_ntz")))


def revenue_hourly(df: DataFrame, prefix: str, since: str | None = None,
                   ts: str = "pickup_datetime", zone: str = "PULocationID") -> DataFrame:
    """Revenue and trip count per (hour, pickup zone) of one service."""
    if since is not None:
        df = df.where(F.col(ts) >= F.lit(since).cast("timestamp_ntz"))
    return (df.groupBy(F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz").alias("hour"),
                       F.col(zone).alias("zone_id"))
            .agg(money_sum(X.exact(df, "total_amount")).alias(f"{prefix}_amount"),
                 F.count(F.lit(1)).alias(f"{prefix}_number_records")))


MONTHLY_SUMS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                "improvement_surcharge", "total_amount", "congestion_surcharge"]
MONTHLY_OPTIONAL_SUMS = ["Airport_fee", "cbd_congestion_fee"]


def revenue_monthly(df: DataFrame, sums: list[str] | None = None,
                    avgs: tuple[str, ...] = ("passenger_count", "trip_distance")) -> DataFrame:
    """Monthly revenue per (pickup zone, month, service).

    The set of sums follows the columns the input has: optional fee
    columns are summed only when present.
    """
    if sums is None:
        have = {c.lower(): c for c in df.columns}
        sums = [c for c in MONTHLY_SUMS if c.lower() in have]
        sums += [have[c.lower()] for c in MONTHLY_OPTIONAL_SUMS if c.lower() in have]
    aggs = [money_sum(X.exact(df, c)).alias(f"revenue_monthly_{'fare' if c == 'fare_amount' else c}") for c in sums]
    aggs += [exact_avg(X.exact(df, c)).alias(f"avg_monthly_{c}") for c in avgs]
    return df.groupBy(F.col("PULocationID").alias("pickup_zone"),
                      F.date_trunc("month", "pickup_datetime").cast("timestamp_ntz").alias("revenue_month"),
                      "service_type").agg(*aggs)


MART_SUMS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
             "improvement_surcharge", "total_amount"]


def monthly_zone_revenue(fct: DataFrame) -> DataFrame:
    """Monthly mart over the fact table.

    Grouped on the raw pickup zone; ``coalesce(zone, 'Unknown Zone')`` is
    applied after grouping, so a NULL zone and a literal 'Unknown Zone'
    stay separate rows (the SQL semantics of grouping by the source column).
    """
    aggs = [money_sum(X.exact(fct, c), 3).alias(f"revenue_monthly_{c if c != 'fare_amount' else 'fare'}")
            for c in MART_SUMS]
    aggs += [F.count("trip_id").alias("total_monthly_trips"),
             exact_avg(X.exact(fct, "passenger_count")).alias("avg_monthly_passenger_count"),
             exact_avg(X.exact(fct, "trip_distance")).alias("avg_monthly_trip_distance")]
    g = fct.groupBy(F.col("pickup_zone").alias("_zone"),
                    F.date_trunc("month", "pickup_datetime").cast("timestamp_ntz").alias("revenue_month"),
                    "service_type").agg(*aggs)
    return g.withColumn("pickup_zone", F.coalesce(F.col("_zone"), F.lit("Unknown Zone"))).drop("_zone")


def trips_report(staged: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Daily report by (date, taxi type, payment name) in ``[start, end)``."""
    df = in_window(staged, "pickup_datetime", start, end)
    return df.groupBy(F.to_date("pickup_datetime").alias("trip_date"), "taxi_type",
                      "payment_type_name").agg(
        F.count(F.lit(1)).alias("trip_count"),
        int_sum("passenger_count").alias("total_passengers"),
        F.sum(X.exact(df, "trip_distance")).cast("double").alias("total_distance"),
        money_sum(X.exact(df, "fare_amount")).alias("total_fare"),
        money_sum(X.exact(df, "tip_amount")).alias("total_tips"),
        money_sum(X.exact(df, "total_amount")).alias("total_revenue"),
        exact_avg(X.exact(df, "fare_amount")).alias("avg_fare"),
        exact_avg(X.exact(df, "total_amount")).alias("avg_revenue"),
        exact_avg(X.exact(df, "trip_distance")).alias("avg_trip_distance"),
        exact_avg(X.exact(df, "passenger_count")).alias("avg_passengers"),
    )


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values, NULL counted as one value (one-row frame)."""
    return df.select(col).distinct().agg(F.count(F.lit(1)).alias("distinct_count"))


def rows_at_max(df: DataFrame, col: str, cond: Column | None = None,
                select: list[str] | None = None) -> DataFrame:
    """Rows whose ``col`` equals the maximum over rows satisfying ``cond``
    (all ties). The one-row maximum is broadcast to the scan."""
    src = df if cond is None else df.where(cond)
    m = src.agg(F.max(col).alias("_max"))
    out = df.join(F.broadcast(m), F.col(col) == F.col("_max"), "inner").drop("_max")
    return out.select(*select) if select else out


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """Globally sorted for a written report: range partitions, each sorted (no single task)."""
    return df.orderBy(*cols)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Ordered limit (planned as TakeOrderedAndProject: per-partition top-k)."""
    return df.orderBy(*order).limit(k)


def from_files(df: DataFrame, pattern: str, col: str = "filename") -> DataFrame:
    """Rows loaded from files matching a SQL LIKE pattern ('_' matches any
    one character, so '2021_03%' also matches '2021-03')."""
    return df.where(F.col(col).like(pattern))


def zone_ranking(mart: DataFrame, service: str, year: int, k: int = 1) -> DataFrame:
    """Top pickup zones by total revenue for one service and year, from the
    monthly mart (ties broken by zone name)."""
    m = mart.where((F.col("service_type") == service) & (F.year("revenue_month") == year))
    agg = m.groupBy("pickup_zone").agg(F.sum("revenue_monthly_total_amount").cast("decimal(38,3)").alias("total_revenue"))
    return top_k(agg, k, F.col("total_revenue").desc(), F.col("pickup_zone").asc())


def month_trips(mart: DataFrame, service: str, month_start: str) -> DataFrame:
    """Total trips of one service in one month, from the monthly mart."""
    m = mart.where((F.col("service_type") == service)
                   & (F.col("revenue_month") == F.lit(month_start).cast("timestamp_ntz")))
    return m.agg(F.sum("total_monthly_trips").cast("bigint").alias("trips"))
