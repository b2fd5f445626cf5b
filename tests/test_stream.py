from datetime import datetime, timedelta

from keelmark.sources.tables import SCHEMAS
from keelmark.streaming import metrics as stream
from tests.helpers import rows


def events(spark, first, count):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, start + timedelta(hours=i), i % 3, "click" if i % 2 else "view", float(i % 4), "{}") for i in range(first, first + count)], SCHEMAS["events"])


def test_stream_equals_batch_and_continues_where_it_stopped(spark, tmp_path):
    inbox, history, checkpoint = (str(tmp_path / n) for n in ("inbox", "history", "checkpoint"))
    for i in range(3):
        events(spark, i * 10, 10).coalesce(1).write.mode("append").parquet(inbox)
    run = lambda: stream.start(spark, inbox, SCHEMAS["events"], history, checkpoint, files_per_batch=1).awaitTermination()
    run()
    assert spark.read.parquet(history).select("batch_id").distinct().count() == 3
    expected = lambda: rows(stream.batch_metrics(spark.read.parquet(inbox)))
    assert rows(stream.combined(spark, history)) == expected()
    run()  # nothing new: nothing is added
    assert rows(stream.combined(spark, history)) == expected()
    events(spark, 30, 7).coalesce(1).write.mode("append").parquet(inbox)
    run()
    assert rows(stream.combined(spark, history)) == expected()


def test_replayed_batch_replaces_itself(spark, tmp_path):
    history = str(tmp_path / "history")
    write = stream.appending(history)
    batch = events(spark, 0, 10)
    write(batch, 0)
    write(batch, 1)
    once = rows(stream.combined(spark, history))
    write(batch, 1)
    assert rows(stream.combined(spark, history)) == once


def test_running_state_removes_repeats_and_equals_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    inbox, state, checkpoint = (str(tmp_path / n) for n in ("inbox", "state", "checkpoint"))
    first = events(spark, 0, 10)
    first.coalesce(1).write.mode("append").parquet(inbox)
    run = lambda: [q.awaitTermination() for q in stream.start_stateful(spark, inbox, SCHEMAS["events"], state, checkpoint, files_per_batch=1)]
    run()
    # repeats of ids 5-7, new ids, and an out-of-order record inside the watermark (hour 8 after hour 9)
    later = events(spark, 5, 3).unionByName(events(spark, 10, 3)).unionByName(events(spark, 8, 1).withColumn("event_id", F.lit(99).cast("bigint")))
    later.coalesce(1).write.mode("append").parquet(inbox)
    run()
    run()  # nothing new: the state stays as it was
    every = spark.read.parquet(inbox)
    unique = every.dropDuplicates(["event_id"])
    expected = rows(stream.batch_metrics(unique).join(
        every.groupBy(F.col("event_type").alias("table_name")).count(), "table_name").select(
        "table_name", "row_count", "null_count", (F.col("count") - F.col("row_count")).alias("duplicate_count"), "newest"))
    assert rows(stream.running_state(spark, state)) == expected
    assert sum(r[3] for r in expected) == 3
