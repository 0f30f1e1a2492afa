"""A Bloom filter of bounded size over integer keys, built by Spark and shared with Python workers.

It only ever spares work: whoever uses it joins exactly afterwards. Beyond
``MAX_BITS`` more keys pass by chance; results stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fareway.llm.hashing import mix

MIN_BITS, MAX_BITS = 1 << 16, 1 << 27  # at most 16 MB
SEEDS = (21, 22, 23)


def fold(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of the aligned 64-bit columns, order of columns counts."""
    acc = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        acc = mix(acc ^ c.view(np.uint64), 20)
    return acc


def places(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    key = fold(columns)
    return [mix(key, s) & np.uint64(bits - 1) for s in SEEDS]


def build(keys: DataFrame, columns: list[str]) -> np.ndarray:
    """The filter over ``columns`` (longs) of ``keys``, as bytes. At most MAX_BITS / 8 of them reach the driver."""
    n = keys.count()
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (16 * n).bit_length()))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field: dict[int, int] = {}
        for b in batches:
            at = np.concatenate(places([b[c].to_numpy() for c in columns], bits)).astype(np.int64)
            word, inverse = np.unique(at >> 6, return_inverse=True)
            value = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(value, inverse, np.uint64(1) << (at & 63).astype(np.uint64))
            for w, v in zip(word.tolist(), value.tolist(), strict=True):
                field[w] = field.get(w, 0) | v
        yield pa.RecordBatch.from_arrays([pa.array(list(field), pa.int64()), pa.array(
            np.fromiter(field.values(), np.uint64, len(field)).view(np.int64))], ["word", "value"])

    got = keys.select(*columns).mapInArrow(emit, "word long, value long").groupBy("word").agg(
        F.bit_or("value").alias("value")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[got["word"].to_numpy()] = got["value"].to_numpy()
    return out.view(np.uint8)


def may_hold(field: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Per row, false only if it is certainly not a key."""
    ok = np.ones(len(columns[0]), bool)
    for at in places(columns, len(field) * 8):
        ok &= (field[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return ok


def share(spark: SparkSession, keys: DataFrame, columns: list[str]):
    return spark.sparkContext.broadcast(build(keys, columns))
