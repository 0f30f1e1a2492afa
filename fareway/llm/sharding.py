"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 by a content hash (hash buckets, per-bucket counts,
then offsets: no global sort and no single-task numbering of rows). A keyed
Feistel network over the smallest even-width power of two >= n, with cycle
walking back into [0, n), permutes the numbers. Position p goes to shard
``p % shards`` and slot ``p // shards``, so shard sizes differ by at most one
row and slots are gapless. ``place`` and ``unplace`` compute both directions
from a row number alone, without any lookup.

Defined results: a null text counts as empty (size 1, CRC 0). Rows equal in
id and text are interchangeable and get distinct slots. A null id is a value
like any other. An empty table gives an empty result. Very long texts are only hashed
and measured. Rows with equal hashes are ordered by nothing else, so which of them gets which
slot does not matter. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fareway.llm.common import row_key, table, text_or_empty

ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, (max(1, n - 1).bit_length() + 1) // 2)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit finaliser (shift, multiply, shift) of the half block and a round key."""
    x = (x ^ np.uint64(key & (2**64 - 1))) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _keys(seed: int) -> list[int]:
    return [(seed * 0xBF58476D1CE4E5B9 + (r + 1) * 0x94D049BB133111EB) & (2**64 - 1) for r in range(ROUNDS)]


def _network(x: np.ndarray, bits: int, keys: list[int], inverse: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    for k in reversed(keys) if inverse else keys:
        if inverse:
            left, right = right ^ (_mix(left, k) & mask), left
        else:
            left, right = right, left ^ (_mix(right, k) & mask)
    return (left << shift) | right


def permute(rows: np.ndarray, n: int, seed: int = 7, inverse: bool = False) -> np.ndarray:
    """Bijection of [0, n): values outside walk the cycle until they are inside."""
    if n <= 1:
        return rows.copy()
    bits, keys = _half_bits(n), _keys(seed)
    with np.errstate(over="ignore"):
        out = _network(rows.astype(np.uint64), bits, keys, inverse)
        far = out >= n
        while far.any():
            out[far] = _network(out[far], bits, keys, inverse)
            far = out >= n
    return out.astype(np.int64)


def place(row: int, n: int, shards: int, seed: int = 7) -> tuple[int, int]:
    p = int(permute(np.array([row]), n, seed)[0])
    return p % shards, p // shards


def unplace(shard: int, slot: int, n: int, shards: int, seed: int = 7) -> int:
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def number_rows(df: DataFrame, keys: list[str], n: int, name: str = "row_no") -> DataFrame:
    """``df`` with gapless numbers 0..n-1, ordered by a hash of ``keys``.

    About sqrt(n) hash buckets of about sqrt(n) rows; only one count per
    bucket is gathered for the offsets.
    """
    buckets = max(64, int(n**0.5))
    h1, h2 = row_key(*keys)
    df = df.withColumn("_h1", h1).withColumn("_h2", h2).withColumn(
        "_b", F.pmod(F.shiftrightunsigned("_h1", 16), F.lit(buckets)))
    offsets = df.groupBy("_b").agg(F.count("*").alias("_n"))
    offsets = offsets.select("_b", F.coalesce(F.sum("_n").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h1", "_h2")) - 1
    df = df.withColumn("_in", inside).join(offsets, "_b")
    return df.withColumn(name, (F.col("_off") + F.col("_in")).cast("long")).drop("_h1", "_h2", "_b", "_in", "_off")


def shard(df: DataFrame, keys: list[str], shards: int = 16, seed: int = 7) -> DataFrame:
    """``df`` with ``row_no``, ``shard`` and ``slot``."""
    n = df.count()

    @F.pandas_udf("long")
    def position(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), n, seed))

    df = number_rows(df, keys, n).withColumn("_pos", position("row_no"))
    return (df.withColumn("shard", (F.col("_pos") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("_pos") / shards).cast("long")).drop("_pos"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = text_or_empty()
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.xxhash64(t).alias("_t"), (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"))
    return shard(docs, ["doc_id", "_t", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_no")
