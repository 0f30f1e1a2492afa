"""Session defaults and the shared scratch/checkpoint location.

The library never hard-codes a local temp folder for cluster runs: scratch
output (load-strategy targets, stream checkpoints, lineage cuts) lives under
the cluster's ``spark.checkpoint.dir``. Only when that is unset (unit tests,
laptop runs) do we create one under the machine's temp folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Shuffle partition count is deliberately not
# fixed here: AQE coalesces small shuffles and splits skewed ones at runtime.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state lives in RocksDB (off-heap, spills to local disk, only
    # changes uploaded at each commit) instead of executor heap: keyed window
    # state can grow with the data without exhausting memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "fareway", master: str | None = None,
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Runtime SQL settings the operators assume (safe to call repeatedly)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Read from the session; a local one is created only when none is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in classic mode
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="fareway-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/fareway-scratch/{name}-{uuid.uuid4().hex[:12]}"


def staged(source: DataFrame) -> DataFrame:
    """The source, evaluated once: a load reads it for its partitions, its keys and its rows."""
    path = scratch_path(source.sparkSession, "load-source")
    source.write.parquet(path)
    return source.sparkSession.read.schema(source.schema).parquet(path)
