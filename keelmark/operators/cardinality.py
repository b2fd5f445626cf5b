"""Exact distinct counts that merge: dictionary-coded bitmaps of dimensions, stored per day.

Dimension values are numbered by a persisted dictionary (column, value, code) that only grows:
a day's new values get the next codes of their column, so codes never change and bitmaps of
different days can be combined. A day is measured in one aggregate over the table: each
dimension's codes are joined from its (small) dictionary and folded by
``bitmap_construct_agg``; the per-day bitmaps are stored, and any set of days is merged by
``bitmap_or_agg`` and counted by ``bitmap_count``, exactly, without reading the rows again.
An integer key, whose values are far too many for one bitmap, is stored as bitmaps per
bucket of 32,768 values and merged bucket by bucket in the same way.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelmark.functions.columns import text, to_rows

C = F.col
#: Values one bitmap holds: Spark's bitmap functions cut positions into buckets of this size.
BITMAP_SIZE = 32768


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception:  # nothing stored yet
        return spark.createDataFrame([], schema)


def extend_dictionary(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """Codes for every non-null value of ``columns``: known values keep theirs, new ones are appended.

    Codes are 1, 2, ... per column in order of first appearance by day, new values of one day in
    ascending order. The distinct values of a dimension are few; they are the only rows shuffled.
    """
    spark = df.sparkSession
    schema = "column_name string, value string, code bigint"
    known = _read(spark, path, schema)
    values = None
    for c in columns:
        part = df.select(F.lit(c).alias("column_name"), C(c).cast("string").alias("value")).where(C("value").isNotNull())
        values = part if values is None else values.unionByName(part)
    fresh = values.distinct().join(known, ["column_name", "value"], "left_anti")
    base = known.groupBy("column_name").agg(F.max("code").alias("_base"))
    order = Window.partitionBy("column_name").orderBy("value")
    numbered = (fresh.join(base, "column_name", "left")
                .select("column_name", "value", (F.coalesce("_base", F.lit(0)) + F.row_number().over(order)).cast("bigint").alias("code")))
    numbered.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def day_bitmaps(df: DataFrame, day: str, dimensions: Sequence[str], dictionary: DataFrame, key: str | None = None) -> DataFrame:
    """Bitmaps of one day: (day, column_name, bucket, bitmap); one aggregate for the dimensions, one for the key.

    Dimensions must have at most ``BITMAP_SIZE`` codes (checked); their dictionaries are
    broadcast, bounded by that size.
    """
    coded = df
    sizes = {r[0]: r[1] for r in dictionary.groupBy("column_name").agg(F.max("code")).collect()}  # one row per column
    for c in dimensions:
        if sizes.get(c, 0) > BITMAP_SIZE:
            raise ValueError(f"{c} has more than {BITMAP_SIZE} values: count it as a key")
        codes = dictionary.where(C("column_name") == c).select(C("value").alias(f"_v_{c}"), C("code").alias(f"_c_{c}"))
        coded = coded.join(F.broadcast(codes), C(c).cast("string") == C(f"_v_{c}"), "left")
    measures = [F.bitmap_construct_agg(F.bitmap_bit_position(C(f"_c_{c}"))).alias(c) for c in dimensions]
    dims = to_rows(coded.agg(*measures), [(text(c), "1", c) for c in dimensions], ("column_name", "bucket", "bitmap"))
    result = dims.select(F.lit(day).alias("day"), "column_name", C("bucket").cast("bigint").alias("bucket"), "bitmap")
    if key is not None:
        keyed = (df.where(C(key).isNotNull())
                 .groupBy(F.bitmap_bucket_number(C(key)).alias("bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position(C(key))).alias("bitmap"))
                 .select(F.lit(day).alias("day"), F.lit(key).alias("column_name"), "bucket", "bitmap"))
        result = result.unionByName(keyed)
    return result


def merged_counts(bitmaps: DataFrame) -> DataFrame:
    """Exact distinct counts over all stored days: bitmaps OR-ed per column and bucket, then counted."""
    per_bucket = bitmaps.groupBy("column_name", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return per_bucket.groupBy("column_name").agg(F.sum("n").cast("bigint").alias("value")).select(
        F.lit("UNIQUE_COUNT").alias("metric_name"), "column_name", "value")
