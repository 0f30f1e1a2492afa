"""Ride-message stream sources.

Messages are JSON objects (one per record). In production the source is a
Kafka topic; the Kafka connector is optional, so the same parsing runs over
a folder of JSON-lines files (one file per producer batch) for tests.
Offsets/progress live in the query checkpoint, not in a consumer group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareway.functions.columns import epoch_millis, timestamp_text

# Ride message, epoch form: pickup time as epoch milliseconds.
RIDE_EPOCH_SCHEMA = T.StructType([
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("tpep_pickup_datetime", T.LongType()),
])

# Ride message, text form: timestamps as 'yyyy-MM-dd HH:mm:ss' text.
RIDE_TEXT_SCHEMA = T.StructType([
    T.StructField("lpep_pickup_datetime", T.StringType()),
    T.StructField("lpep_dropoff_datetime", T.StringType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])

TEXT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def to_text_message(rides: DataFrame, *more: Column) -> DataFrame:
    """Ride rows -> text-form message columns (sub-second digits dropped), and ``more``."""
    return rides.select(
        timestamp_text("event_ts").alias("lpep_pickup_datetime"),
        timestamp_text(F.col("event_ts") + F.expr("INTERVAL 10 MINUTES")).alias("lpep_dropoff_datetime"),
        F.col("PULocationID").cast("int").alias("PULocationID"),
        F.col("DOLocationID").cast("int").alias("DOLocationID"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("tip_amount").cast("double").alias("tip_amount"),
        F.col("total_amount").cast("double").alias("total_amount"),
        *more,
    )


def to_epoch_message(rides: DataFrame, *more: Column) -> DataFrame:
    """Ride rows -> epoch-form message columns (millisecond pickup time), and ``more``."""
    return rides.select(
        F.col("PULocationID").cast("int").alias("PULocationID"),
        F.col("DOLocationID").cast("int").alias("DOLocationID"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("total_amount").cast("double").alias("total_amount"),
        epoch_millis("event_ts").alias("tpep_pickup_datetime"),
        *more,
    )


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def read_stream(spark: SparkSession, source: str, schema: T.StructType, start: str = "earliest",
                fmt: str = "files", servers: str | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of parsed messages.

    ``fmt='kafka'``: ``source`` is the topic, ``start`` the starting offsets
    ('earliest' or 'latest'). ``fmt='files'``: ``source`` is a folder of
    JSON-lines files.
    """
    if fmt == "kafka":
        if not kafka_available(spark):
            raise RuntimeError("Kafka connector not on the classpath; use fmt='files'")
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
               .option("subscribe", source).option("startingOffsets", start))
        if max_per_trigger:
            raw = raw.option("maxOffsetsPerTrigger", max_per_trigger)
        value = raw.load().select(F.col("value").cast("string").alias("value"))
        return value.select(F.from_json("value", schema).alias("r")).select("r.*")
    reader = spark.readStream.schema(schema)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    # For files, 'latest' is a checkpoint that already holds the files
    # present at start (see ``skip_existing``).
    return reader.json(source)


def with_event_time(df: DataFrame, delay: str = "5 seconds", text_col: str | None = None,
                    epoch_col: str | None = None, ts_col: str | None = None,
                    out: str = "event_timestamp") -> DataFrame:
    """Computed event-time column + watermark (bounded out-of-orderness).

    The event time is a session-zone (UTC) ``TIMESTAMP``; NTZ values are
    cast first because watermarks require it.
    """
    if text_col:
        ts = F.to_timestamp(F.col(text_col), TEXT_TS_FORMAT)
    elif epoch_col:
        ts = F.timestamp_millis(F.col(epoch_col))
    else:
        ts = F.col(ts_col).cast("timestamp")
    return df.withColumn(out, ts).withWatermark(out, delay)


def skip_existing(stream: DataFrame, checkpoint: str) -> None:
    """'Start from latest' for a file source: record the files present now
    in ``checkpoint`` without emitting them; a query started later from the
    same checkpoint only sees files that arrive afterwards."""
    q = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, i: None).trigger(availableNow=True).start())
    q.awaitTermination()
