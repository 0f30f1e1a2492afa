"""Streaming sinks and the query runner.

``KeyedSink`` is an idempotent upsert-by-key sink on plain parquet, kept as a
log-structured merge: each micro-batch is written (overwrite) to its own
folder, so a batch replayed after a failure replaces its own output instead
of adding to it. After ``compact_every`` batches the older ones are merged
into a snapshot of hash buckets, of which only those that hold a changed key are
written again. A numbered pointer, created last, names the snapshot's
folders; until then readers use the former one. Readers take the newest row per key of one
snapshot and a bounded number of batches. ``jdbc_append`` writes each batch
with a JDBC append (at-least-once on replay).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareway.sources import versions as V


class KeyedSink:
    """``key`` empty: an append-only sink, which keeps all batches as they are.

    ``schema``: what ``read`` returns, empty, before the first batch.
    """

    def __init__(self, path: str, key: list[str], schema=None, compact_every: int = 8, buckets: int = 16):
        self.path = path.rstrip("/")
        self.schema = schema
        self.key = list(key)
        self.compact_every, self.buckets = compact_every, buckets

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.key and batch_id <= self._pointer(spark)["upto"]:
            return  # delivered again, but merged already
        batch.write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")
        if self.key and len(self.pending(spark)) > self.compact_every:
            self.compact(spark, batch_id - 1)  # the running batch may be replayed; those before it are final

    # ---- batches and pointer

    def pending(self, spark: SparkSession) -> list[int]:
        """Ids of the batches that are not in the snapshot."""
        upto = self._pointer(spark)["upto"]
        ids = [int(f.rsplit("=", 1)[1]) for f in V.children(spark, f"{self.path}/batches") if "/batch_id=" in f]
        return sorted(i for i in ids if i > upto)

    def _pointer(self, spark: SparkSession) -> dict:
        found = sorted(f for f in V.children(spark, f"{self.path}/current") if not f.endswith(".tmp"))
        if not found:
            return {"upto": -1, "number": 0, "buckets": {}}
        return json.loads("".join(r[0] for r in spark.read.text(found[-1], wholetext=True).collect()))

    def _switch(self, spark: SparkSession, pointer: dict) -> None:
        name = f"{self.path}/current/{pointer['number']:012d}"
        target, fs = V._fs(spark, name)
        draft = spark._jvm.org.apache.hadoop.fs.Path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        if not fs.rename(draft, target):
            raise RuntimeError(f"{name} exists: another writer compacts this sink")

    # ---- rows

    def _batches(self, spark: SparkSession, ids: list[int]) -> DataFrame:
        return spark.read.option("basePath", f"{self.path}/batches").option("mergeSchema", True).parquet(
            *[f"{self.path}/batches/batch_id={i}" for i in ids]).withColumn("batch_id", F.col("batch_id").cast("long"))

    def _rows(self, spark: SparkSession, folders: list[str], ids: list[int]) -> DataFrame | None:
        """Snapshot rows (with the batch they come from) and the rows of batches."""
        parts = [spark.read.option("mergeSchema", True).parquet(*folders)] if folders else []
        parts += [self._batches(spark, ids)] if ids else []
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)

    def _newest(self, rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*self.key).orderBy(F.col("batch_id").desc())
        return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Merge the batches up to ``upto`` into the snapshot. A crash before the pointer is there changes nothing."""
        now = self._pointer(spark)
        ids = [i for i in self.pending(spark) if i <= upto]
        if not ids:
            return
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        fresh = self._batches(spark, ids)
        hit = [str(r[0]) for r in fresh.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        rows = self._rows(spark, [now["buckets"][b] for b in hit if b in now["buckets"]], ids)
        folder = f"{self.path}/snapshots/{uuid.uuid4().hex}"
        self._newest(rows).withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(folder)
        buckets = now["buckets"] | {b: f"{folder}/_bucket={b}" for b in hit}
        self._switch(spark, {"upto": upto, "number": now["number"] + 1, "buckets": buckets})
        kept = set(buckets.values())
        old = [f for f in now["buckets"].values() if f not in kept]
        old += [f for f in V.children(spark, f"{self.path}/current") if f < f"{f.rsplit('/', 1)[0]}/{now['number'] + 1:012d}"]
        done = [f for f in V.children(spark, f"{self.path}/batches") if "/batch_id=" in f and int(f.rsplit("=", 1)[1]) <= upto]
        V.remove(spark, [*old, *done])

    def read(self, spark: SparkSession) -> DataFrame:
        """Current table: the row of the latest batch for every key."""
        rows = self._rows(spark, sorted(self._pointer(spark)["buckets"].values()), self.pending(spark))
        if rows is None:
            if self.schema is None:
                raise ValueError(f"nothing written to {self.path} yet, and no schema given")
            return spark.createDataFrame([], self.schema)
        return (self._newest(rows) if self.key else rows).drop("batch_id")


def _jdbc_delete_batch(spark: SparkSession, url: str, table: str, batch_id: int, properties: dict) -> None:
    """Delete a batch's earlier rows over JDBC from the driver (no data
    moves); nothing to do while the table does not exist yet."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        if k != "driver":
            props.setProperty(k, str(v))
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        meta = conn.getMetaData()
        found = any(meta.getTables(None, None, name, None).next() for name in {table, table.upper(), table.lower()})
        if found:
            col = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier("batch_id")
            conn.createStatement().execute(f"DELETE FROM {table} WHERE {col} = {int(batch_id)}")
    finally:
        conn.close()


def jdbc_append(url: str, table: str, properties: dict | None = None, idempotent: bool = True):
    """foreachBatch writer appending each micro-batch to a JDBC table.

    With ``idempotent`` the rows carry their ``batch_id`` and a replayed
    batch first deletes its earlier rows, so a restart after a failure does
    not duplicate output. Without it the sink is at-least-once.
    """
    props = dict(properties or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if idempotent:
            batch = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            _jdbc_delete_batch(spark, url, table, batch_id, props)
        batch.write.jdbc(url, table, mode="append", properties=props)

    return write


def run_stream(df: DataFrame, sink, checkpoint: str, output_mode: str = "append",
               available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start ``df`` into ``sink`` (a foreachBatch callable) with a checkpoint.

    ``available_now`` processes everything present and stops (tests, batch
    back-fills); otherwise a processing-time trigger keeps running.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()

