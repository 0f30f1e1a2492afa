"""Event-time windows over a watermarked stream (or a batch frame).

Each function returns a plain aggregate; run it with ``run_stream`` in
append mode (a window is emitted once the watermark passes its end) or call
it on a batch frame to get the same rows at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareway.functions.columns import exact


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Fixed, non-overlapping windows of ``size`` per ``keys``."""
    g = df.groupBy(F.window(F.col(ts), size).alias("w"), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                    *[c for c in g.columns if c not in ("w", *keys)])


def sessions(df: DataFrame, ts: str, gap: str, keys: list[str]) -> DataFrame:
    """Session windows per key: a session grows while the next event is at
    most ``gap`` after the previous one (events exactly ``gap`` apart merge)."""
    g = df.groupBy(*keys, F.session_window(F.col(ts), gap).alias("s")).agg(F.count(F.lit(1)).alias("num_trips"))
    return g.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "num_trips")


def ride_window_aggs(df: DataFrame, amount: str = "total_amount") -> list[Column]:
    """Trip count and revenue; money is summed with all its digits, so the
    double result does not depend on arrival order."""
    return [F.count(F.lit(1)).alias("num_trips"), F.sum(exact(df, amount)).cast("double").alias("total_revenue")]


def tips_aggs(df: DataFrame, amount: str = "tip_amount") -> list[Column]:
    return [F.sum(exact(df, amount)).cast("double").alias("total_tips")]
