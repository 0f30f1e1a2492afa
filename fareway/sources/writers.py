"""Sinks: parquet/JSON files, tables, JDBC, message export.

Table locations are explicit paths under the shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local default warehouse.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareway.session import scratch_path
from fareway.sources import versions, warehouse

PART_ROWS = 500_000  # rows of a file that a report of n files is put together from


def write_report(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite",
                 partition_by: list[str] | None = None, max_records_per_file: int | None = 5_000_000) -> str:
    """Parquet output.

    By default the file count follows the data: AQE coalesces the last
    shuffle of a report into few partitions (one file while it is small) and
    ``max_records_per_file`` caps a file as it grows, without an extra pass
    to count rows. ``files=n`` asks for exactly n files: the rows are first written
    by all tasks (``coalesce`` alone would shrink the upstream stages), and n tasks put
    these compressed columns together (a shuffle would hand each of them its rows unpacked).
    """
    scratch = None
    if files:
        scratch = scratch_path(df.sparkSession, "parts")
        df.write.option("compression", "zstd").option("maxRecordsPerFile", PART_ROWS).parquet(scratch)
        df = in_tasks(df.sparkSession, scratch, df.schema, files)
    w = df.write.mode(mode)
    if max_records_per_file and not files:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with apart(df.sparkSession) if files else nullcontext():
        w.parquet(path)
    versions.remove(df.sparkSession, [scratch] if scratch else [])
    return path


@contextmanager
def apart(spark: SparkSession) -> Iterator[None]:
    """A union keeps the partitions of its inputs: Spark 4.1 else makes one of inputs that have one partition each."""
    key = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def in_tasks(spark: SparkSession, path: str, schema: T.StructType, n: int) -> DataFrame:
    """The parquet files under ``path`` in n partitions of about equal bytes, none of them empty.

    To be used ``apart``. Files are dealt whole, the largest first; only their names and sizes pass the driver.
    Few files are small (``PART_ROWS``): their rows are dealt instead."""
    rows = spark.read.schema(schema).parquet(path)
    sizes = {f: size for f, size in versions.sizes(spark, path).items() if f.endswith(".parquet")}
    if len(sizes) < 4 * n:
        return rows.repartition(n)
    heap: list[tuple[int, int, list[str]]] = [(0, i, []) for i in range(n)]
    for f in sorted(sizes, key=lambda f: (-sizes[f], f)):
        held, i, names = heapq.heappop(heap)
        heapq.heappush(heap, (held + sizes[f], i, [*names, f]))
    return reduce(DataFrame.unionAll, [spark.read.schema(schema).parquet(*names).coalesce(1) for _, _, names in heap])


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON-lines records (one object per line)."""
    df.write.mode(mode).json(path)
    return path


def write_for_run(df: DataFrame, root: str, day: str, mode: str = "overwrite") -> str:
    """Run-parameterised output folder ``root/day=<day>``."""
    path = f"{root.rstrip('/')}/day={day}"
    df.write.mode(mode).parquet(path)
    return path


def publish_json(df: DataFrame, target: str, fmt: str = "files", servers: str | None = None,
                 key: str | None = None) -> None:
    """Rows as JSON messages. ``fmt='kafka'`` writes to topic ``target``;
    ``fmt='files'`` writes JSON-lines text under the folder ``target``."""
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")
    cols = [value] + ([F.col(key).cast("string").alias("key")] if key else [])
    out = df.select(*cols)
    if fmt == "kafka":
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", target).save()
    else:
        out.select("value").write.mode("append").text(target)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 100_000,
               properties: dict | None = None, num_partitions: int | None = None) -> None:
    """JDBC load: parallel inserts per partition, ``batchsize`` rows per round trip."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url, table, mode=mode, properties=props)


def load_jdbc_chunked(df: DataFrame, url: str, table: str, batchsize: int = 100_000,
                      properties: dict | None = None) -> None:
    """Create-or-replace the (empty) table with the frame's schema, then append."""
    write_jdbc(df.limit(0), url, table, mode="overwrite", batchsize=batchsize, properties=properties)
    write_jdbc(df, url, table, mode="append", batchsize=batchsize, properties=properties)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def table_location(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"table-{name}")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None,
                 partition_by: list[str] | None = None) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS with typed columns (parquet, explicit location)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = location or table_location(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet {part} LOCATION '{loc}'")
    return spark.table(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def materialize_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                      cluster_by: list[str] | None = None, location: str | None = None) -> DataFrame:
    """Create-or-replace table from a query (CTAS).

    The new contents go to a fresh location and the table is re-pointed, so
    a replace never overwrites files that the query itself is reading.
    ``partition_by`` gives directory partitions (pruned by filters);
    ``cluster_by`` sorts rows inside each file so parquet min/max statistics
    skip row groups for filters on those columns.
    """
    spark = df.sparkSession
    loc = location or table_location(spark, name)
    out = df
    if partition_by:
        # Rebalance by the partition columns: small partition values share a
        # task, and a hot one (say a month with a third of the rows) is split
        # by its size at run time, without a sampling pass.
        out = out.hint("rebalance", *partition_by)
    if cluster_by:
        out = out.sortWithinPartitions(*(partition_by or []), *cluster_by)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(loc)
    exists = spark.catalog.tableExists(name)
    old = [versions.location(spark, name)] if exists else []
    old += [f"{f}.versions" for f in old]
    same = exists and not partition_by and not partition_columns(spark, name) and [
        (f.name, f.dataType) for f in spark.table(name).schema.fields] == [(f.name, f.dataType) for f in df.schema.fields]
    if same:  # one catalog change: readers see the old or the new contents
        spark.sql(f"ALTER TABLE {name} SET LOCATION {versions.literal(loc)}")
        spark.catalog.refreshTable(name)
    else:
        swap_table(spark, name, df.schema, loc, partition_by, exists)
    versions.remove(spark, [f for f in old if f != loc])
    return spark.table(name)


def swap_table(spark: SparkSession, name: str, schema: T.StructType, loc: str, partition_by: list[str] | None, exists: bool) -> None:
    """Register the written folder under ``name``. The new table is complete before the
    old one steps aside, and the old one comes back if the new one cannot take its name."""
    tag = uuid.uuid4().hex[:8]
    fresh, aside = f"{name}_new_{tag}", f"{name}_old_{tag}"
    part = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {fresh} ({cols}) USING parquet {part} LOCATION {versions.literal(loc)}")
    try:
        if partition_by:
            spark.sql(f"MSCK REPAIR TABLE {fresh}")
        if exists:
            spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
        try:
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        except Exception:
            if exists:
                spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    if exists:
        spark.sql(f"DROP TABLE {aside}")


def add_columns(table: str, rows: DataFrame) -> None:
    """Schema change 'append new columns': columns of ``rows`` that the table lacks are added; its rows read NULL."""
    spark = rows.sparkSession
    have = {c.lower() for c in spark.table(table).columns}
    new = [f for f in rows.schema.fields if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")


def truncate_load(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Empty the staging table, then load the frame into it. Columns of the frame that the table lacks are added.

    Tables here live at explicit locations (external), where TRUNCATE is not
    allowed; an INSERT OVERWRITE has the same outcome in one step.
    """
    add_columns(table, df)
    df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    return spark.table(table)


def write_table(df: DataFrame, table: str, fmt: str = warehouse.FORMAT, options: dict | None = None,
                location: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Warehouse sink through a connector; the table as it can be read back.

    By default the library's own connector (two-phase commit into a folder that all machines reach);
    ``fmt`` names any other on the class path, which is read back by the same name."""
    spark = df.sparkSession
    if fmt == warehouse.FORMAT:
        return warehouse.read(spark, warehouse.write(df, location or table_location(spark, table.replace(".", "-")), mode))
    df.write.format(fmt).options(**(options or {})).mode(mode).save(table)
    return spark.read.format(fmt).options(**(options or {})).load(table)
