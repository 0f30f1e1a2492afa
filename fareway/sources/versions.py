"""Versioned partition folders: copy on write for external parquet tables.

New contents of partitions are written to a folder of their own, beside the
table. Each partition is then pointed there with one catalog change, so its
readers see the old or the new contents. What is to be switched is written
down first: a job that dies between two switches leaves each partition old
or new, and the next load of the table finishes the rest. Superseded folders are
removed after the last switch; nothing can bring their rows back.

One writer at a time per table; readers that still list a removed folder have
to refresh. The number of touched partitions, not their rows, passes the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of the null partition
JOURNAL = T.StructType([T.StructField(c, T.StringType()) for c in ("spec", "location", "superseded")])


def literal(value) -> str:
    """SQL literal of a partition value; text form is cast to the column's type by the catalog."""
    if value is None:
        return "NULL"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spec_of(parts: list[str], values: Iterable) -> str:
    return ", ".join(f"`{c}` = {literal(v)}" for c, v in zip(parts, values, strict=True))


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        p, fs = _fs(spark, path)
        fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of the files of a folder."""
    p, fs = _fs(spark, path)
    return {s.getPath().toString(): s.getLen() for s in fs.listStatus(p)}


def folder_of(file: F.Column) -> F.Column:
    """Folder of a file, as a path (file names in metadata are URL-encoded)."""
    return F.regexp_replace(F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B"))), "/[^/]*$", "")


def folders(rows: DataFrame, parts: list[str]) -> dict[tuple, str]:
    """Folder of every partition that has rows. Only partition values and file names are read."""
    files = rows.select(*parts, F.col("_metadata.file_path").alias("_file")).distinct()  # decoded once a file, not once a row
    got = files.select(*parts, folder_of(F.col("_file")).alias("_folder")).distinct().collect()
    return {tuple(r[c] for c in parts): r["_folder"] for r in got}


def side_folder(spark: SparkSession, table: str) -> str:
    """Versions and journals of a table lie beside its first location."""
    return f"{location(spark, table)}.versions"


def write_version(df: DataFrame, table: str, parts: list[str]) -> dict[tuple, str]:
    """Write ``df`` to a new version folder; the folder of each partition value in it."""
    spark = df.sparkSession
    path = f"{side_folder(spark, table)}/{uuid.uuid4().hex}"
    df.hint("rebalance", *parts).write.partitionBy(*parts).parquet(path)
    return folders(spark.read.schema(df.schema).parquet(path), parts)


def switch(spark: SparkSession, table: str, parts: list[str], new: dict[tuple, str], old: dict[tuple, str]) -> None:
    """Point the partitions of ``new`` at their folders, drop those only in ``old``, remove the old folders."""
    root = side_folder(spark, table)
    steps = [(spec_of(parts, v), f, old.get(v)) for v, f in new.items()]
    steps += [(spec_of(parts, v), None, f) for v, f in old.items() if v not in new]
    if not steps:
        return
    journal = f"{root}/switch-{uuid.uuid4().hex}"
    spark.createDataFrame(steps, JOURNAL).coalesce(1).write.json(journal)
    _apply(spark, table, steps)
    _finish(spark, table, journal, steps)


def recover(spark: SparkSession, table: str) -> None:
    """Finish switches that an earlier job left undone. A journal without its success mark was never begun."""
    for path in children(spark, side_folder(spark, table)):
        if not path.rsplit("/", 1)[-1].startswith("switch-"):
            continue
        done, fs = _fs(spark, f"{path}/_SUCCESS")
        if fs.exists(done):
            steps = [(r["spec"], r["location"], r["superseded"]) for r in spark.read.schema(JOURNAL).json(path).collect()]
            _apply(spark, table, steps)
            _finish(spark, table, path, steps)
        else:
            remove(spark, [path])


def _apply(spark: SparkSession, table: str, steps: list[tuple]) -> None:
    """Idempotent: a step that was done already changes nothing."""
    for spec, folder, _ in steps:
        if folder is None:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        else:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {literal(folder)}")
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {literal(folder)}")
    spark.catalog.refreshTable(table)


def _finish(spark: SparkSession, table: str, journal: str, steps: list[tuple]) -> None:
    kept = {folder for _, folder, _ in steps}
    remove(spark, [f for _, _, f in steps if f and f not in kept])
    remove(spark, [journal])
    spark.catalog.refreshTable(table)


