"""Quality metrics on change: every micro-batch appends its metrics to a history.

The reference point is the stream's own progress: a batch is identified by its id,
its folder is written with overwrite, and a replayed batch therefore replaces
itself instead of counting twice.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def batch_metrics(events: DataFrame) -> DataFrame:
    """Rows, empty values and newest record per event type."""
    return events.groupBy(F.col("event_type").alias("table_name")).agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("value") < 1).alias("null_count"),
        F.max("ts").alias("newest"))


def appending(history: str, metrics: Callable[[DataFrame], DataFrame] = batch_metrics) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        metrics(batch).write.mode("overwrite").parquet(f"{history}/batch_id={batch_id}")
    return write


def start(
    spark: SparkSession, folder: str, schema: StructType | str, history: str, checkpoint: str,
    glob: str = "*.parquet", files_per_batch: int | None = None,
) -> StreamingQuery:
    """Read what has arrived since the last run, then stop (``availableNow``)."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.parquet(folder).writeStream
        .foreachBatch(appending(history))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start())


def combined(spark: SparkSession, history: str) -> DataFrame:
    """Metrics over all batches; these measures add up, or take the maximum."""
    return spark.read.parquet(history).groupBy("table_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.max("newest").alias("newest"))


# ------------------------------------------------------------ running state per table

def _versions(state: str) -> Callable[[DataFrame, int], None]:
    # complete mode: each batch hands over the whole running state (one row per table); it is
    # written under its batch id, so a replayed batch rewrites its own version and nothing else
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
    return write


def start_stateful(
    spark: SparkSession, folder: str, schema: StructType | str, state: str, checkpoint: str, delay: str = "6 hours",
    glob: str = "*.parquet", files_per_batch: int | None = None,
) -> list[StreamingQuery]:
    """Metrics with state: rows, empty values (J1), repeats (J2), row count (J4) and newest record (J5) per table.

    Records carry an event time ``ts`` and an ``event_id``. A watermark ``delay`` behind the newest
    time seen bounds the state: repeats of an id within it are removed before counting, and
    records older than the watermark when they arrive are dropped as late. The counts live in
    the state store of a streaming aggregation (one row per table, restored from ``checkpoint``
    after a restart or a lost executor); every batch writes the whole running state as a new
    version. A second query counts the raw records, so that repeats are measured, not only removed.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # watermarks need zoned time: zone-less UTC times are read in the session zone, which is UTC
    events = reader.parquet(folder).withColumn("_event_time", F.col("ts").cast("timestamp"))
    unique = events.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(["event_id"])
    running = unique.groupBy(F.col("event_type").alias("table_name")).agg(
        F.count("*").alias("row_count"), F.count_if(F.col("value") < 1).alias("null_count"), F.max("ts").alias("newest"))
    raw = events.groupBy(F.col("event_type").alias("table_name")).agg(F.count("*").alias("records"))
    queries = []
    for frame, name in ((running, "unique"), (raw, "raw")):
        queries.append(
            frame.writeStream.outputMode("complete").foreachBatch(_versions(f"{state}/{name}"))
            .option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start())
    return queries


def _latest(spark: SparkSession, path: str) -> DataFrame:
    versions = spark.read.parquet(path)
    newest = versions.agg(F.max("batch_id")).first()[0]  # one scalar
    return versions.where(F.col("batch_id") == newest).drop("batch_id")


def running_state(spark: SparkSession, state: str) -> DataFrame:
    """The newest version of the running state: table_name, row_count, null_count, duplicate_count, newest.

    duplicate_count is the records received less the records counted: repeats of an id within the
    watermark, and records that arrived later than the watermark.
    """
    unique, raw = _latest(spark, f"{state}/unique"), _latest(spark, f"{state}/raw")
    return unique.join(raw, "table_name").select(
        "table_name", "row_count", "null_count", (F.col("records") - F.col("row_count")).alias("duplicate_count"), "newest")
