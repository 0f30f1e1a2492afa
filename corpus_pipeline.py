"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read back as the next stage's input, so a lost executor
costs no more than the running stage, and then removes its predecessor's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareway.llm import bpe, mixing, order_minhash, substring_dedup, toxicity
from fareway.llm.common import discard, materialize

STAGES = [
    ("toxicity", toxicity.stage),
    ("near_dedup", order_minhash.stage),
    ("substring_dedup", substring_dedup.stage),
    ("mixing", mixing.stage),
    ("bpe", bpe.stage),
]

#: Learned scores, alignments and tokens have no SQL form; tests compare run() with a plain Python chain.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(spark, before)  # its successor is written
        before = docs
    return docs
