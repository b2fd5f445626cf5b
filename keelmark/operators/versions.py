"""Keyed refresh, snapshots and comparison of product versions."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelmark.functions.columns import text, to_rows
from keelmark.session import run_dir


def upsert(current: DataFrame, incoming: DataFrame, key: str, version: str = "score_calculated_at") -> DataFrame:
    """Keep the newest row per key; on equal versions the incoming row wins, and a null version is the oldest.

    ``current`` has one row per key. Only the incoming rows are ranked; the current ones pass through an anti-join
    against the incoming keys. ``incoming`` is read twice, so one that is costly to compute should be stored first.
    """
    newest = Window.partitionBy(key).orderBy(F.desc(version))
    latest = incoming.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    held = current.select(F.col(key).alias("_key"), F.col(version).alias("_version"))
    newer = (F.col("_version") > F.col(version)) | (F.col(version).isNull() & F.col("_version").isNotNull())
    fresh = latest.join(held, F.col(key).eqNullSafe(F.col("_key")) & newer, "left_anti")
    replaced = fresh.select(F.col(key).alias("_key"))
    return current.join(replaced, F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(fresh)


def changed_rows(later: DataFrame, current: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows of ``later`` whose key is new, or that differ from ``current`` in any of ``columns`` (nulls are equal)."""
    held = current.select(F.col(key).alias("_key"), F.struct(*columns).alias("_held"))
    joined = later.join(held, F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.filter(~F.struct(*columns).eqNullSafe(F.col("_held"))).select(*later.columns)


def incremental_refresh(previous: str, incoming: DataFrame, key: str, target: str, version: str = "score_calculated_at") -> DataFrame:
    """Keyed refresh of a stored product: the merged table is written to a new folder.

    The previous folder is left as it was, so a failed run can simply be repeated.
    """
    current = incoming.sparkSession.read.parquet(previous)
    upsert(current, incoming, key, version).write.parquet(target)
    return incoming.sparkSession.read.parquet(target)


BUCKET = "key_bucket"


def key_bucket(key: str, buckets: int):
    """Bucket of a key: a hash modulo the bucket count; a null key has its own fixed bucket."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Store a keyed table partitioned by key bucket, one folder per bucket, ready for keyed refreshes."""
    df.withColumn(BUCKET, key_bucket(key, buckets)).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def refresh_buckets(path: str, incoming: DataFrame, key: str, buckets: int, version: str = "score_calculated_at") -> list[int]:
    """Keyed refresh in place: only the buckets that incoming keys fall into are rewritten.

    The touched buckets of the stored table are read (partition pruning on the bucket folder),
    merged with the incoming rows by :func:`upsert`, staged in a new folder as they come, and then
    dealt out by bucket and written back with dynamic partition overwrite, which replaces exactly the bucket folders present in
    the output. Files of untouched buckets are not opened, moved or renamed. A failure before the
    last write leaves the table as it was; a failure during it is mended by repeating the last
    write from the staged copy. Returns the touched bucket numbers (at most ``buckets`` values).
    """
    spark = incoming.sparkSession
    fresh = incoming.withColumn(BUCKET, key_bucket(key, buckets))
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
    if not touched:
        return []
    current = spark.read.parquet(path).where(F.col(BUCKET).isin(touched))
    merged = upsert(current.drop(BUCKET), fresh.drop(BUCKET), key, version).withColumn(BUCKET, key_bucket(key, buckets))
    staging = run_dir(spark, "refresh-stage")
    merged.write.parquet(staging)
    (spark.read.parquet(staging).repartition(BUCKET).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
    return touched


def version_summary(df: DataFrame, label: str, stamp: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.max(stamp).alias("as_of")).select(
        F.lit(label).alias("version"), "row_count", F.lit(len(df.columns)).alias("column_count"), "as_of")


def column_differences(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per column: rows present on both sides whose values differ; and keys missing on either side.

    One join on the key and one aggregate, whatever the number of columns.
    """
    left = old.select(F.col(key).alias("_key"), F.struct(*columns).alias("o"))
    right = new.select(F.col(key).alias("_key"), F.struct(*columns).alias("n"))
    joined = left.join(right, "_key", "full")
    measures = [F.count_if(F.col("n").isNull()).alias("_only_old"), F.count_if(F.col("o").isNull()).alias("_only_new")]
    measures += [F.expr(f"count_if(o IS NOT NULL AND n IS NOT NULL AND NOT (o.{c} <=> n.{c})) AS {c}__changed") for c in columns]
    rows = [("'missing rows'", text(key), "_only_old"), ("'added rows'", text(key), "_only_new")]
    rows += [("'changed values'", text(c), f"{c}__changed") for c in columns]
    return to_rows(joined.agg(*measures), rows, ("check_type", "column_name", "row_count"))
