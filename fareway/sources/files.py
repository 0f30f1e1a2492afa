"""File sources: parquet, CSV, JSON, external tables, seeds, month ingest."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareway.operators.quality import assert_checks, check_not_null, check_unique


def read_trips(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet scan (one path, a glob, or a list); schema from the footers."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row; every column is read as text."""
    return spark.read.option("header", True).csv(path)


def read_lookup_frame(df: DataFrame) -> DataFrame:
    """The all-text shape of a lookup (what a header-only CSV read yields)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def read_trips_csv(spark: SparkSession, path: str, schema: T.StructType,
                   timestamp_format: str = "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
                   min_partitions: int | None = None) -> DataFrame:
    """Typed CSV read (gzip or plain) with declared nullable columns.

    A gzip file cannot be split, so one task reads it; ``min_partitions``
    redistributes the rows right after the read so later stages run wide.
    """
    df = (spark.read.schema(schema).option("header", True)
          .option("timestampFormat", timestamp_format)
          .option("timestampNTZFormat", timestamp_format)
          .option("mode", "PERMISSIVE").csv(path))
    if min_partitions:
        df = df.repartition(min_partitions)
    return df


def external_table(spark: SparkSession, name: str, fmt: str, location: str,
                   schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """Register an external (unmanaged) table over files and return it.

    CSV rows with more values than the declared columns keep the leading
    ones; short rows are NULL-filled (PERMISSIVE mode).
    """
    cols = ""
    if schema is not None:
        cols = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ")"
    opts = "OPTIONS (header 'true')" if fmt == "csv" and header else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} {cols} USING {fmt} {opts} LOCATION '{location}'")
    return spark.table(name)


def copy_in(df: DataFrame, columns: list[str], target: T.StructType) -> DataFrame:
    """Load the named source columns into a wider target: matching names are
    cast to the target type, target columns not listed stay NULL."""
    wanted = {c.lower(): c for c in columns}
    out = []
    for f in target.fields:
        src = wanted.get(f.name.lower())
        col = F.col(f"`{src}`").cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        out.append(col.alias(f.name))
    return df.select(*out)


def read_json_records(spark: SparkSession, path: str, field: str,
                      schema: T.StructType | None = None, multiline: bool = False) -> DataFrame:
    """JSON documents with an array under ``field`` -> one row per element.

    Documents are read one per line so the input splits across tasks; set
    ``multiline`` for a single pretty-printed document.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if multiline:
        reader = reader.option("multiLine", True)
    docs = reader.json(path)
    return docs.select(F.inline(F.col(field)))


def load_seed(spark: SparkSession, path: str, schema: T.StructType, key: str,
              table: str = "seed") -> DataFrame:
    """Typed seed CSV with its key checked (not null + unique) before use."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    assert_checks([check_not_null(df, table, key), check_unique(df, table, key)])
    return df


def sample_rows(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    """Column-pruned bounded read."""
    return df.select(*cols).limit(n)


def _months(start: str, end: str) -> list[str]:
    s = dt.date.fromisoformat(start.strip()[:10]).replace(day=1)
    e = dt.date.fromisoformat(end.strip()[:10]).replace(day=1)
    out = []
    while s <= e:
        out.append(s.strftime("%Y-%m"))
        s = (s.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


_INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _widest_decimal(types) -> T.DataType:
    """The decimal with the most digits before and after the point that any of the exact types has;
    text where that is more than 38 digits, so that no digit is lost."""
    scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in types)
    whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _INTEGRAL_DIGITS[type(t)] for t in types)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()


def canonical_columns(schemas: list[T.StructType], mixed: dict[str, T.DataType] | None = None) -> dict[str, T.StructField]:
    """One spelling and one type per column (names case-insensitive) over
    files whose footers differ: the same type is kept; mixed integral types
    widen to bigint, exact types to a decimal that holds them all, a mix with
    floating point to double or what ``mixed`` says, mixed timestamps to NTZ,
    anything else to string."""
    seen: dict[str, list[T.StructField]] = {}
    for sch in schemas:
        for f in sch.fields:
            seen.setdefault(f.name.lower(), []).append(f)
    out = {}
    for low, fields in seen.items():
        types = {f.dataType for f in fields}
        if len(types) == 1:
            dtype = fields[0].dataType
        elif all(isinstance(t, _INTEGRAL) for t in types):
            dtype = T.LongType()
        elif all(isinstance(t, _INTEGRAL + (T.DecimalType,)) for t in types):
            dtype = _widest_decimal(types)
        elif all(isinstance(t, _INTEGRAL + _FRACTIONAL) for t in types):
            dtype = (mixed or {}).get(low, T.DoubleType())
        elif all(isinstance(t, (T.TimestampType, T.TimestampNTZType)) for t in types):
            dtype = T.TimestampNTZType()
        else:
            dtype = T.StringType()
        out[low] = T.StructField(fields[0].name, dtype, True)
    return out


def _conflict(e: Exception) -> bool:
    return "CANNOT_MERGE" in str(e) or "merge" in str(e).lower()


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Runs of ``paths`` whose footers agree, with their schema.

    Footers are read and merged by Spark's distributed ``mergeSchema`` job;
    paths that disagree are halved and tried again. Files drift from time to time, not one
    by one, so k changes over n files in order take about k log n jobs. Groups of one schema are joined."""
    try:
        schema = spark.read.option("mergeSchema", "true").parquet(*paths).schema
        names = [f.name.lower() for f in schema.fields]
        if len(names) == len(set(names)) or len(paths) == 1:
            return [(schema, paths)]
    except Exception as e:  # noqa: BLE001 - conflicting footer types
        if not _conflict(e) or len(paths) == 1:
            raise
    half = len(paths) // 2
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, some in schema_groups(spark, paths[:half]) + schema_groups(spark, paths[half:]):
        groups.setdefault(schema.json(), (schema, []))[1].extend(some)
    return list(groups.values())


def _exact_type(groups: list[tuple[T.StructType, DataFrame]], low: str) -> T.DataType:
    """A type for a column that is a whole number in some groups and floating point in others, chosen from the data:
    double if it holds every whole number, bigint if every floating number is whole, else a
    decimal that holds all digits, else text. One aggregate over the column in all groups."""
    parts = []
    for schema, df in groups:
        for f in schema.fields:
            if f.name.lower() != low:
                continue
            c = F.col(f"`{f.name}`")
            if isinstance(f.dataType, _INTEGRAL + (T.DecimalType,)):
                whole = F.lit(True) if isinstance(f.dataType, _INTEGRAL) else c == F.floor(c)
                digits = c.cast("decimal(38,18)").isNotNull() if isinstance(f.dataType, T.DecimalType) else F.lit(True)
                parts.append(df.select(F.coalesce(c.cast("double").cast("decimal(38,0)") == c.cast("decimal(38,0)"), F.lit(True)).alias(
                    "as_double"), F.coalesce(whole, F.lit(True)).alias("as_long"), F.coalesce(digits, F.lit(True)).alias("as_decimal")))
            else:
                d = c.cast("double")
                inside = F.abs(d) < F.lit(1e18)
                exact = inside & (d.try_cast("decimal(38,18)").cast("double") == d)
                parts.append(df.select(F.lit(True).alias("as_double"), F.coalesce(inside & (d == F.floor(d)), d.isNull()).alias("as_long"),
                                       F.coalesce(exact, d.isNull()).alias("as_decimal")))
    r = reduce(lambda a, b: a.unionByName(b), parts).agg(*[F.coalesce(F.bool_and(c), F.lit(True)).alias(c) for c in (
        "as_double", "as_long", "as_decimal")]).first()
    if r["as_double"]:
        return T.DoubleType()
    if r["as_long"]:
        return T.LongType()
    return T.DecimalType(38, 18) if r["as_decimal"] else T.StringType()


def read_schema_groups(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files with differing footers (types or name case): one scan
    per distinct schema, each cast to the canonical columns, then
    concatenated by name. Files sharing a schema (the usual case) are one
    scan. Names differing in case only are one column."""
    found = schema_groups(spark, paths)
    frames = [(schema, spark.read.schema(schema).parquet(*ps)) for schema, ps in found]
    if len(frames) == 1 and len({f.name.lower() for f in found[0][0].fields}) == len(found[0][0].fields):
        return frames[0][1].withColumn("_file_path", F.col("_metadata.file_path"))
    types: dict[str, set] = {}
    for schema, _ in frames:
        for f in schema.fields:
            types.setdefault(f.name.lower(), set()).add(type(f.dataType))
    floating = (T.FloatType, T.DoubleType)
    mixed = {low: _exact_type(frames, low) for low, ts in types.items() if len(ts) > 1 and ts & set(floating) and all(
        issubclass(t, _INTEGRAL + _FRACTIONAL) for t in ts) and not ts <= set(floating)}
    canon = canonical_columns([schema for schema, _ in frames], mixed)
    out = []
    for schema, df in frames:
        cols = [F.col(f"`{f.name}`").cast(canon[f.name.lower()].dataType).alias(canon[f.name.lower()].name) for f in schema.fields]
        out.append(df.select(*cols, F.col("_metadata.file_path").alias("_file_path")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def ingest_months(spark: SparkSession, root: str, start: str, end: str, taxi_types: list[str],
                  now: dt.datetime, pattern: str = "{type}_tripdata_{ym}.parquet") -> DataFrame:
    """Trips of every (type, month) in ``[start month, end month]``.

    Missing files are skipped with a warning. Each service is read with one
    scan per distinct file schema (monthly files drift in types and name
    case; see ``read_schema_groups``); ``filename`` comes from the file
    metadata, so no per-file plan is built. Services with different columns
    are concatenated by name (missing columns NULL). With no file at all
    the result keeps a minimal schema (taxi_type, filename, ingested_at).
    """
    frames = []
    for t in taxi_types:
        paths = []
        for ym in _months(start, end):
            p = f"{root.rstrip('/')}/{pattern.format(type=t, ym=ym)}"
            if _exists(spark, p):
                paths.append(p)
            else:
                print(f"Warning: skipping missing {p}")
        if not paths:
            continue
        df = read_schema_groups(spark, paths)
        # The file name is the last path element of the pattern (after any
        # 'key=' prefix of a partition-style folder).
        name = pattern.rsplit("/", 1)[-1].split("=", 1)[-1]
        name_re = re.escape(name).replace(re.escape("{type}"), re.escape(t)).replace(
            re.escape("{ym}"), r"\d{4}-\d{2}")
        fname = F.regexp_extract(F.col("_file_path"), f"({name_re})", 1)
        frames.append(df.withColumns({"taxi_type": F.lit(t), "filename": fname,
                                      "ingested_at": F.lit(now).cast("timestamp_ntz")}).drop("_file_path"))
    if not frames:
        schema = "taxi_type string, filename string, ingested_at timestamp_ntz"
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
