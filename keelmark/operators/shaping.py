"""Data-shaping operators: spines, samples, weighted buckets, multipliers, keys."""

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark.functions.temporal import day


def volumes(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every named frame."""
    counted = [f.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("source"), "row_count") for n, f in frames.items()]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result


def daily_activity(accounts: DataFrame, transactions: DataFrame, until: date, days: int) -> DataFrame:
    """Movements per account and day over the last ``days`` days, zero on quiet days.

    The calendar is opened up after the join: what is shuffled is one record of
    ``days`` counters per account, not accounts × days.
    """
    age = F.datediff(day(until), F.col("txn_date"))
    counters = [F.count_if(age == back) for back in range(days)]
    per_account = (
        transactions.filter(age.between(0, days - 1))
        .groupBy("account_id").agg(F.array(*counters).alias("counts"))
    )
    quiet = F.array_repeat(F.lit(0).cast("bigint"), days)
    return (
        accounts.select("account_id").join(per_account, "account_id", "left")
        .select("account_id", F.posexplode(F.coalesce("counts", quiet)).alias("back", "txn_count"))
        .select("account_id", F.date_sub(day(until), F.col("back")).alias("activity_date"), "txn_count")
    )


def bucket_of(key: Column, multiplier: int = 37, buckets: int = 100) -> Column:
    """A repeatable bucket number per key: the stand-in for a random draw."""
    return F.pmod(key * multiplier, F.lit(buckets))


def keyed_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    return df.filter(bucket_of(F.col(key)) < percent)


def weighted_choice(key: Column, cuts: Sequence[tuple[int, str]]) -> Column:
    """Category by cumulative weight: the first cut above the key's bucket."""
    *inner, last = cuts
    result = F.lit(last[1])
    for limit, name in reversed(inner):
        result = F.when(bucket_of(key) < limit, F.lit(name)).otherwise(result)
    return result


def multiplied(df: DataFrame, times: int, name: str = "n") -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(times))))


def surrogate_key(prefix: str, key: Column, width: int) -> Column:
    """Prefixed, zero-padded key derived from the natural key: no global numbering is needed."""
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def continue_sequence(df: DataFrame, sequence: str, load: str, name: str = "seq") -> DataFrame:
    """Number the rows of ``df`` densely, continuing the stored ``sequence``, and record the load.

    ``df`` should be read from storage, so that partitions and their order are the same on a
    recompute. Rows are counted per partition (one row per partition reaches the driver), the
    counts become offsets, and each row takes ``last + offset(partition) + position + 1``, its
    position read from ``monotonically_increasing_id`` (record number in the lower 33 bits).
    No sort and no window over all rows. The sequence table gets one row per load (load,
    first_number, last_number); a load already recorded raises instead of numbering twice.
    """
    spark = df.sparkSession
    schema = "load string, first_number bigint, last_number bigint"
    try:
        history = spark.read.schema(schema).parquet(sequence)
        done = history.agg(F.max("last_number"), F.count_if(F.col("load") == load)).first()
    except Exception:  # the first load of the sequence
        history, done = None, (None, 0)
    if done[1]:
        raise ValueError(f"load {load!r} is numbered already")
    last = done[0] or 0
    tagged = df.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
    counts = dict(tagged.groupBy("_part").count().collect())
    offsets, running = [], 0
    for part in range(max(counts, default=-1) + 1):
        offsets.append(running)
        running += counts.get(part, 0)
    position = F.col("_id") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    offset = F.element_at(F.array(*[F.lit(o) for o in offsets]), F.col("_part") + 1) if offsets else F.lit(0)
    numbered = tagged.withColumn(name, (F.lit(last) + offset + position + 1).cast("bigint")).drop("_part", "_id")
    if running:
        spark.createDataFrame([(load, last + 1, last + running)], schema).write.mode("append").parquet(sequence)
    return numbered
