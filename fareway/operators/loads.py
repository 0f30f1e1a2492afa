"""Load strategies over plain parquet tables.

Parquet tables have no MERGE/UPDATE/DELETE, so each strategy is written as
the relational result it stands for (anti-join + union, filtered union). On a
partitioned table only the partitions that a load can change are read, and
their new contents go to versioned folders that are switched one by one
(``sources/versions.py``); an unpartitioned table goes to a new location as a
whole. A running reader never sees a half-written partition, a failed job
leaves old or new contents, and superseded folders are removed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.functions.columns import row_hash
from fareway.operators import key_summary as KS
from fareway.operators.reports import in_window
from fareway.session import staged
from fareway.sources import versions as V
from fareway.sources.writers import add_columns, materialize_table, partition_columns


def add_row_identity(df: DataFrame, cols: list[str], filename: str | Column | None = None,
                     name: str = "unique_row_id", binary: bool = False) -> DataFrame:
    """Hash identity of each row (md5 of the coalesced column text) and the
    source file name, computed before the write (no post-load UPDATE)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = df.withColumn(name, row_hash([(F.col(c), types[c]) for c in cols], binary=binary))
    if filename is not None:
        out = out.withColumn("filename", F.lit(filename) if isinstance(filename, str) else filename)
    return out


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def insert_only_rows(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    """Source rows whose key is absent from the target. Source rows sharing
    a new key are all kept (none of them matches the target)."""
    k = _keys(key)
    existing = target.select(*k).distinct()  # only the key columns are scanned
    return source.join(existing, on=k, how="left_anti")


def merge_insert_only(target_table: str, source: DataFrame, key: str | list[str], within: list[str] | None = None) -> int:
    """WHEN NOT MATCHED THEN INSERT: append the new rows; existing rows are
    never rewritten. Returns the number of inserted rows.

    Only files that may hold a key of the source are read (``key_summary``).
    ``within`` names columns that equal keys agree on, such as those that a
    hash key is made of: their ranges tell files apart when the key's cannot.
    The anti-join reads the file listing fixed at planning time, so
    the appended files are not read back by the same job.
    """
    spark = source.sparkSession
    V.recover(spark, target_table)
    k = _keys(key)
    target = spark.table(target_table)
    have = set(target.columns)
    columns = list(dict.fromkeys([*k, *[c for c in within or () if c in have and c in source.columns]]))
    source = staged(source)
    KS.summarise(spark, target_table, k, columns)
    files = KS.may_hold(target_table, source, k, columns)
    append_rows(target_table, insert_only_rows(target.where(F.col("_metadata.file_path").isin(sorted(files))), source, k))
    spark.catalog.refreshTable(target_table)
    return KS.summarise(spark, target_table, k, columns)


def upsert_rows(target: DataFrame, source: DataFrame, key: str | list[str],
                dedupe: list[Column] | None = None) -> DataFrame:
    """Matched rows replaced by the source row, others inserted.

    Several source rows for one key are an error (a warehouse MERGE rejects
    them) unless ``dedupe`` gives the order that picks the one to keep.
    """
    k = _keys(key)
    if dedupe is not None:
        from fareway.operators.dedup import dedup_first

        source = dedup_first(source, k, dedupe)
    else:
        dup = source.groupBy(*k).count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"source has several rows for one {k}; pass dedupe=")
    kept = target.join(source.select(*k).distinct(), on=k, how="left_anti")
    # New source columns are appended (old rows NULL): schema change
    # 'append new columns'.
    return kept.unionByName(source, allowMissingColumns=True)


def delete_insert_rows(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    """Delete target rows whose key occurs in the source, insert all source
    rows (duplicate source keys are kept)."""
    k = _keys(key)
    kept = target.join(source.select(*k).distinct(), on=k, how="left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def time_interval_rows(target: DataFrame, source: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """Replace the run window ``[start, end)`` of the target with the source
    rows of that window."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    in_win = (F.col(col) >= lo) & (F.col(col) < hi)
    kept = target.where(~in_win | F.col(col).isNull())
    return kept.unionByName(source.where(in_win), allowMissingColumns=True)


def incremental_since(df: DataFrame, target: DataFrame | None, col: str) -> DataFrame:
    """Rows strictly newer than the target's latest ``col``.

    The maximum is read once on the driver and inlined as a literal, so the
    filter is pushed into the scan. No target (first build) keeps every row;
    an empty target (NULL maximum) keeps none, like ``> (select max ...)``.
    """
    if target is None:
        return df
    hwm = target.agg(F.max(col).alias("m")).collect()[0]["m"]
    if hwm is None:
        return df.where(F.lit(False))
    return df.where(F.col(col) > F.lit(hwm))


def align_schema(target: DataFrame, source: DataFrame) -> DataFrame:
    """Schema change 'append new columns': old rows get NULL in them."""
    return target.unionByName(source, allowMissingColumns=True)


def append_rows(table: str, rows: DataFrame) -> None:
    """Append by name. Columns that the table lacks are added to it first
    (old rows read NULL); columns that the rows lack are NULL."""
    spark = rows.sparkSession
    V.recover(spark, table)
    add_columns(table, rows)
    conform(table, rows).write.insertInto(table)


def conform(table: str, rows: DataFrame) -> DataFrame:
    """``rows`` with exactly the columns of ``table``; those they lack are NULL."""
    given = {c.lower() for c in rows.columns}
    return rows.select(*[F.col(f"`{f.name}`") if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in rows.sparkSession.table(table).schema.fields])


@dataclass
class Touched:
    """The part of a table that a load can change: its rows and, by partition value, its folders."""

    rows: DataFrame
    parts: list[str]
    folders: dict[tuple, str]


def touched_rows(table: str, source: DataFrame, key: str | list[str] | None = None, time_col: str | None = None,
                 start: str | None = None, end: str | None = None) -> Touched:
    """The partitions of ``table`` that hold a matched key, a partition value of
    the source, or a time in the window. An unpartitioned table is one partition.

    Partition values and folders pass the driver; they become a filter on the
    partition columns, so only those folders are listed and read."""
    spark = source.sparkSession
    V.recover(spark, table)
    target = spark.table(table)
    parts = partition_columns(spark, table)
    if not parts:
        return Touched(target, parts, {})

    def held_in(values: set[tuple]) -> Column:
        return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [
            F.col(c).eqNullSafe(F.lit(v).cast(target.schema[c].dataType)) for c, v in zip(parts, value, strict=True)])
            for value in values], F.lit(False))

    def found(df: DataFrame) -> set[tuple]:
        return {tuple(r) for r in df.select(*parts).distinct().collect()}

    values: set[tuple] = set()
    if set(parts) <= set(source.columns):  # partition values only, no rows
        values |= found(target.select(*parts).distinct().join(
            source.select(*parts).distinct().withColumnsRenamed({c: f"_p_{c}" for c in parts}),
            reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in parts]), "left_semi"))
    if key:  # in the other partitions
        k = _keys(key)
        values |= found(target.where(~held_in(values)).join(source.select(*k).distinct(), on=k, how="left_semi"))
    if time_col:
        t = F.col(time_col)
        values |= found(target.where((t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz"))))
    rows = target.where(held_in(values))
    return Touched(rows, parts, V.folders(rows, parts) if values else {})


def rewrite(table: str, touched: Touched, new: DataFrame) -> DataFrame:
    """Put ``new`` in the place of the touched rows of ``table``.

    Without partitions the table is written anew. Otherwise columns that the
    table lacks are added first (old rows read NULL), and only the touched partitions are written."""
    spark = new.sparkSession
    if not touched.parts:
        return materialize_table(new, table)
    add_columns(table, new)
    V.switch(spark, table, touched.parts, V.write_version(conform(table, new), table, touched.parts), touched.folders)
    return spark.table(table)


STRATEGIES = ("append", "replace", "view", "time_interval", "delete_insert", "merge", "full_refresh")


def materialize(df: DataFrame, strategy: str, table: str, key: str | list[str] | None = None,
                time_col: str | None = None, start: str | None = None, end: str | None = None,
                partition_by: list[str] | None = None, full_refresh: bool = False) -> DataFrame:
    """Apply a load strategy to the named table and return it.

    append: add rows. replace / full_refresh: rebuild. view: temp view only.
    time_interval: swap the run window. delete_insert: swap the keys present
    in the source. merge: upsert on a unique key.
    """
    spark = df.sparkSession
    if strategy == "view":
        df.createOrReplaceTempView(table)
        return spark.table(table)
    exists = spark.catalog.tableExists(table)
    if strategy in ("replace", "full_refresh") or full_refresh or not exists:
        return materialize_table(df, table, partition_by=partition_by)
    if strategy == "append":
        append_rows(table, df)
        return spark.table(table)
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}; one of {STRATEGIES}")
    if strategy == "time_interval":
        df = staged(in_window(df, time_col, start, end))
        target = touched_rows(table, df, time_col=time_col, start=start, end=end)
        return rewrite(table, target, time_interval_rows(target.rows, df, time_col, start, end))
    df = staged(df)
    target = touched_rows(table, df, key)
    rows = delete_insert_rows if strategy == "delete_insert" else upsert_rows
    return rewrite(table, target, rows(target.rows, df, key))


def merge_upsert(target_table: str, source: DataFrame, key: str | list[str],
                 dedupe: list[Column] | None = None) -> DataFrame:
    """Upsert merge into a table on a unique key (matched rows replaced,
    others inserted). A partitioned table keeps its layout and only the
    partitions that the source touches are written again."""
    source = staged(source)
    target = touched_rows(target_table, source, key)
    return rewrite(target_table, target, upsert_rows(target.rows, source, key, dedupe))
