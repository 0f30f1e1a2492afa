"""Which files of a table may hold the keys of a load.

Beside a table lies one summary row per file: how many rows it has, the range of
its key and of columns that go with the key, and a bitmap of key hashes. A load
reads only files whose ranges meet its own and whose bitmap has one of its
keys. The answer is never too small: files without a summary are read, and
get one.

Bounds: a bitmap has at most ``MAX_BITS`` bits; the key hashes of a load of at
most ``MAX_KEYS`` distinct keys are shared with all tasks to be looked up in bitmaps.
A larger load goes by ranges alone. Names of files and their row counts pass the driver, not rows.
A task of Python holds a bitmap or two and a batch of rows, however many rows a file has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.session import staged
from fareway.sources import versions as V

MIN_BITS, MAX_BITS, MAX_KEYS = 1 << 10, 1 << 23, 2_000_000
PIECE = 4096  # bytes of a bitmap that Spark's bitmap functions work on


def _folder(spark: SparkSession, table: str) -> str:
    return f"{V.side_folder(spark, table)}/keys"


def _hash(columns: list[str]) -> F.Column:
    return F.xxhash64(*columns)


def _slots(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    h = hashes.view(np.uint64)
    return [(h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)]


def file_names(df: DataFrame) -> set[str]:
    """Files of the frame as its metadata column names them."""
    return {re.sub("^file:/+", "file:/", f) for f in df.inputFiles()}


def _in(files) -> F.Column:
    return F.col("_metadata.file_path").isin(sorted(files))


def known(spark: SparkSession, table: str, columns: list[str]) -> DataFrame | None:
    """Summaries that cover ``columns``."""
    if not V.children(spark, _folder(spark, table)):
        return None
    out = spark.read.option("mergeSchema", True).parquet(_folder(spark, table))
    return out if {f"lo_{c}" for c in columns} <= set(out.columns) else None


def summarise(spark: SparkSession, table: str, key: list[str], columns: list[str]) -> int:
    """Write the summaries of files that lack them; the rows of these files."""
    target = spark.table(table)
    have = known(spark, table, columns)
    done = {r["file"] for r in have.select("file").collect()} if have is not None else set()
    new = file_names(target) - done
    if not new:
        return 0
    named = _local(spark, _no=pa.array(range(len(new)), pa.int32()), file=pa.array(sorted(new)))
    # A number instead of the name goes with each row.
    rows = target.where(_in(new)).select(*{*key, *columns}, F.col("_metadata.file_path").alias("_file")).join(
        F.broadcast(named.withColumnRenamed("file", "_file")), "_file").drop("_file")
    ranges = named.join(staged(rows.groupBy("_no").agg(F.count(F.lit(1)).alias("rows"), *[a for c in columns for a in (
        F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))])), "_no", "left").fillna(
        0, ["rows", *[f"nulls_{c}" for c in columns]])  # a file without rows gets a summary too
    counts = {r["_no"]: r["rows"] for r in ranges.select("_no", "rows").collect()}
    found = bitmaps(rows.select("_no", _hash(key).alias("h")), {i: _bits(n) for i, n in counts.items()})
    ranges.join(found, "_no", "left").drop("_no").withColumn("bitmap", F.coalesce("bitmap", F.lit(bytes(MIN_BITS // 8)))).write.mode(
        "append").parquet(_folder(spark, table))
    return sum(counts.values())


def _local(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A row per file, without a Python task."""
    return spark.createDataFrame(pa.table(columns))


def _bits(rows: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, 1 << (12 * rows).bit_length()))


def bitmaps(hashes: DataFrame, bits: dict[int, int]) -> DataFrame:
    """``_no``, ``bitmap`` of the key hashes ``h`` of each file number, with ``bits`` bits.

    A task sets the bits of its own rows, batch by batch, in one field at a time (a scan reads file after file); fields of
    one file are then joined in pieces of ``PIECE`` bytes. So no task holds the rows of a file."""

    def pieces(i: int, field: np.ndarray) -> pa.RecordBatch:
        packed = np.packbits(field).tobytes()
        at = range(0, len(packed), PIECE)
        return pa.RecordBatch.from_arrays([pa.array([i] * len(at), pa.int32()), pa.array([k // PIECE for k in at], pa.int32()), pa.array(
            [packed[k:k + PIECE] for k in at], pa.binary())], ["_no", "piece", "bitmap"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, field = None, None
        for batch in batches:
            ids, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist()] if len(ids) else []
            for lo, hi in zip(starts, [*starts[1:], len(ids)], strict=True):
                if ids[lo] != now:
                    if now is not None:
                        yield pieces(now, field)
                    now = int(ids[lo])
                    field = np.zeros(bits[now], bool)
                for at in _slots(h[lo:hi], len(field)):
                    field[at] = True
        if now is not None:
            yield pieces(now, field)

    sizes = _local(hashes.sparkSession, _no=pa.array(list(bits), pa.int32()), size=pa.array([n // 8 for n in bits.values()], pa.int32()))
    joined = hashes.mapInArrow(partial, "_no int, piece int, bitmap binary").groupBy("_no", "piece").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    whole = joined.groupBy("_no").agg(F.array_sort(F.collect_list(F.struct("piece", "bitmap"))).alias("p")).join(F.broadcast(sizes), "_no")
    # bitmap_or_agg gives PIECE bytes for a shorter field as well: the rest is cut off.
    return whole.select("_no", F.expr("substring(unhex(array_join(transform(p, x -> hex(x.bitmap)), '')), 1, size)").alias("bitmap"))


def may_hold(table: str, source: DataFrame, key: list[str], within: list[str]) -> set[str]:
    """Files of ``table`` that may hold a key of ``source``. Equal keys have equal values in ``within``."""
    spark = source.sparkSession
    columns = list(dict.fromkeys([*key, *within]))
    files = file_names(spark.table(table))
    have = known(spark, table, columns)
    if have is None or not files:
        return files
    span = source.agg(*[a for c in columns for a in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"), F.count_if(
        F.col(c).isNull()).alias(f"nulls_{c}"))], F.approx_count_distinct(_hash(key)).alias("n_keys")).first()
    have = have.where(F.col("file").isin(sorted(files)))
    without = files - {r["file"] for r in have.select("file").collect()}

    def meets(c: str) -> F.Column:
        both = F.lit(False)
        if span[f"lo_{c}"] is not None:
            both = (F.col(f"lo_{c}") <= F.lit(span[f"hi_{c}"])) & (F.col(f"hi_{c}") >= F.lit(span[f"lo_{c}"]))
        return F.coalesce(both, F.lit(False)) | ((F.col(f"nulls_{c}") > 0) & F.lit(span[f"nulls_{c}"] > 0))

    near = have.where(reduce(lambda a, b: a & b, [meets(c) for c in columns]))
    some = None
    if span["n_keys"] <= 1.5 * MAX_KEYS:  # an estimate: far more keys are not even listed
        some = source.select(_hash(key).alias("h")).distinct().limit(MAX_KEYS + 1).toArrow()["h"].to_numpy()
    if some is not None and len(some) <= MAX_KEYS:
        shared = spark.sparkContext.broadcast(some)

        def hit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                keep = []
                for raw in pdf["bitmap"]:
                    field = np.unpackbits(np.frombuffer(raw, np.uint8)).view(bool)
                    first, second = _slots(shared.value, len(field))
                    keep.append(bool((field[first] & field[second]).any()))
                yield pdf.loc[keep, ["file"]]

        near = near.select("file", "bitmap").mapInPandas(hit, "file string")
    return without | {r["file"] for r in near.select("file").collect()}
