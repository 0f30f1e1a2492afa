"""Data-quality checks.

Every check returns a one-row-per-check DataFrame with columns
``check, table, column, failed_rows, passed``. Column-level checks of one
table fold into a single aggregate pass (``check_suite``); key checks are a
grouped count; referential checks are an anti-join. Only the tiny result
frame ever reaches the driver (``assert_checks``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_COLUMNS = ["check", "table", "column", "failed_rows", "passed"]


class CheckFailed(AssertionError):
    def __init__(self, rows):
        self.rows = rows
        lines = [f"{r['check']}({r['table']}.{r['column']}): {r['failed_rows']} failing rows" for r in rows]
        super().__init__("data checks failed:\n  " + "\n  ".join(lines))


def _result(df: DataFrame, check: str, table: str, column: str, failed: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"),
                     failed.cast("bigint").alias("failed_rows")).withColumn("passed", F.col("failed_rows") == 0)


def _violations(kind: str, col: str, arg=None) -> Column:
    c = F.col(col)
    if kind == "not_null":
        return c.isNull()
    if kind == "non_negative":
        return c < 0
    if kind == "positive":
        return c <= 0
    if kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(arg))
    if kind == "custom":
        return arg if isinstance(arg, Column) else F.expr(arg)
    raise ValueError(kind)


def check_suite(df: DataFrame, table: str, specs: Iterable[tuple]) -> DataFrame:
    """Several row-level checks in one scan.

    ``specs``: tuples ``(kind, column[, arg])`` with kind in not_null,
    non_negative, positive, accepted_values, custom (arg = violating predicate).
    """
    specs = [tuple(s) + (None,) * (3 - len(s)) for s in specs]
    aggs = [F.count_if(_violations(k, c, a) if k != "custom" else _violations(k, c, a)).alias(f"_c{i}")
            for i, (k, c, a) in enumerate(specs)]
    counts = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(k).alias("check"), F.lit(table).alias("table"), F.lit(c).alias("column"),
                              F.col(f"_c{i}").cast("bigint").alias("failed_rows"))
                     for i, (k, c, _) in enumerate(specs)])
    return (counts.select(F.inline(rows)).withColumn("passed", F.col("failed_rows") == 0))


def check_not_null(df: DataFrame, table: str, col: str) -> DataFrame:
    return check_suite(df, table, [("not_null", col)])


def check_non_negative(df: DataFrame, table: str, col: str) -> DataFrame:
    return check_suite(df, table, [("non_negative", col)])


def check_accepted_values(df: DataFrame, table: str, col: str, values: list) -> DataFrame:
    """Values outside the accepted list; NULL passes."""
    return check_suite(df, table, [("accepted_values", col, values)])


def check_custom(df: DataFrame, table: str, name: str, violating: str | Column) -> DataFrame:
    """Zero rows may satisfy the ``violating`` predicate."""
    return check_suite(df, table, [("custom", name, violating)])


def _duplicate_keys(df: DataFrame, cols: list[str], ignore_nulls: bool) -> DataFrame:
    src = df.select(*cols)
    if ignore_nulls:
        for c in cols:
            src = src.where(F.col(c).isNotNull())
    # Partial aggregation happens map-side, so a hot key costs one row per
    # task before the shuffle, not one row per occurrence.
    return src.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)


def check_unique(df: DataFrame, table: str, col: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    dup = _duplicate_keys(df, [col], ignore_nulls=True)
    return _result(dup.agg(F.count(F.lit(1)).alias("n")), "unique", table, col, F.col("n"))


def check_unique_combination(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """Number of column combinations (NULL is a value) occurring more than once."""
    dup = _duplicate_keys(df, cols, ignore_nulls=False)
    return _result(dup.agg(F.count(F.lit(1)).alias("n")), "unique_combination_of_columns", table,
                   ",".join(cols), F.col("n"))


def check_primary_key(df: DataFrame, table: str, cols: list[str],
                      not_null: list[str] | None = None) -> DataFrame:
    """Declared key: combinations unique (nullable parts compare as values)
    plus not-null on the declared non-nullable parts."""
    uniq = check_unique_combination(df, table, cols).withColumn("check", F.lit("primary_key"))
    if not not_null:
        return uniq
    return uniq.unionByName(check_suite(df, table, [("not_null", c) for c in not_null]))


def check_relationships(df: DataFrame, table: str, col: str, dim: DataFrame, dim_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (anti-join)."""
    keys = dim.select(F.col(dim_col).alias("_k")).distinct()
    orphans = df.where(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("_k"), "left_anti")
    return _result(orphans.agg(F.count(F.lit(1)).alias("n")), "relationships", table, col, F.col("n"))


def check_row_count(df: DataFrame, table: str) -> DataFrame:
    """Fails when the table is empty (stops at the first row found)."""
    n = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return _result(n, "row_count_positive", table, "*", F.when(F.col("n") > 0, 0).otherwise(1))


def check_contract(df: DataFrame, table: str, contract: T.StructType) -> DataFrame:
    """Exact column names and types; one failing 'row' per mismatched column."""
    spark = df.sparkSession
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    bad = [n for n in want if n not in have or have[n] != want[n]] + [n for n in have if n not in want]
    return spark.createDataFrame([("contract", table, ",".join(bad) or "*", len(bad), not bad)],
                                 "check string, table string, column string, failed_rows bigint, passed boolean")


def check_freshness(df: DataFrame, table: str, col: str, now: dt.datetime,
                    warn_after_hours: int = 24, error_after_hours: int = 48) -> DataFrame:
    """Age of the newest row against warn/error thresholds.

    Adds ``status`` (pass, warn, error) and ``max_loaded_at``; ``passed``
    is false only on error.
    """
    now_c = F.lit(now).cast("timestamp_ntz")
    m = df.agg(F.max(F.col(col).cast("timestamp_ntz")).alias("max_loaded_at"))
    age_h = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now_c) / F.lit(3600.0)
    status = (F.when(F.col("max_loaded_at").isNull() | (age_h > error_after_hours), "error")
              .when(age_h > warn_after_hours, "warn").otherwise("pass"))
    return m.select(F.lit("freshness").alias("check"), F.lit(table).alias("table"), F.lit(col).alias("column"),
                    F.when(status == "error", 1).otherwise(0).cast("bigint").alias("failed_rows"),
                    (status != "error").alias("passed"), status.alias("status"), "max_loaded_at")


def collect_checks(frames: list[DataFrame]) -> list[dict]:
    rows = []
    for f in frames:
        rows += [r.asDict() for r in f.select(*RESULT_COLUMNS).collect()]
    return rows


def assert_checks(frames: list[DataFrame]) -> list[dict]:
    """Run the (tiny) check frames; raise listing every failure."""
    rows = collect_checks(frames)
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise CheckFailed(failed)
    return rows


def profile(df: DataFrame, nulls: list[str], distinct: list[str], span: str | None = None) -> DataFrame:
    """One-pass profile: row count, null counts, distinct counts, time span."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls]
    aggs += [F.count_distinct(F.col(c)).alias(f"distinct_{c}") for c in distinct]
    if span:
        aggs += [F.min(span).alias("min_pickup"), F.max(span).alias("max_pickup")]
    return df.agg(*aggs)


def schema_ddl(df: DataFrame, table: str) -> str:
    """CREATE TABLE text for a frame's schema (the table DDL of a preview)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return f"CREATE TABLE {table} ({cols})"
