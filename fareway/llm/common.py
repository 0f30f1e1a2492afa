"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareway.session import scratch_path

#: A word: a run of characters other than space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
words_of = re.compile(WORD).findall
word_spans = re.compile(WORD).finditer


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage so that a lost executor re-reads files instead of recomputing,
    and gives adaptive execution exact sizes for the joins that follow.
    """
    path = scratch_path(spark, name)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")  # this job's shuffle files go with it
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that no later plan reads."""
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def row_key(*cols: str) -> tuple[Column, Column]:
    """128 hash bits of the given columns, as two longs: the leading constant seeds the hash of what follows."""
    return F.xxhash64(F.lit(1), *cols), F.xxhash64(F.lit(2), *cols)


def packed(docs: DataFrame, *cols: str) -> DataFrame:
    """``cols`` beside the whole row in ``_doc``, so that no other column of ``docs`` can clash with a working column."""
    return docs.select(F.struct("*").alias("_doc"), *cols)


def unpacked(df: DataFrame, **new: Column) -> DataFrame:
    """The rows kept in ``_doc``, with ``new`` values for columns that they have."""
    names = df.schema["_doc"].dataType.names
    return df.select(*[new.get(c, F.col("_doc")[c]).alias(c) for c in names])


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows and bytes: one row may be a very long text, vector or archive. All operators set the
    same values, so that lazily built frames run alike in whatever order they were built."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "400")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
