"""Readers and writers for Parquet tables."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelmark.functions.temporal import moment
from keelmark.session import run_dir


# ---------------------------------------------------------------- fixed values
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
# ------------------------------------------------------------ end fixed values


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by name. Declared schemas spare a job that opens footers to infer one."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh: the whole table is replaced."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For results that several passes read: they are computed once, and a lost
    executor costs a file read instead of the whole lineage.
    """
    path = run_dir(df.sparkSession, purpose)
    refresh(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def snapshot_columns(df: DataFrame, version: str, taken_at: datetime, reason: str) -> DataFrame:
    return df.withColumns({
        "snapshot_version": F.lit(version),
        "snapshot_at": moment(taken_at),
        "snapshot_reason": F.lit(reason),
    })


def snapshot_once(df: DataFrame, path: str, version: str, taken_at: datetime, reason: str) -> None:
    """Write-once audit copy: a second call with the same path leaves the first copy alone."""
    snapshot_columns(df, version, taken_at, reason).write.mode("ignore").parquet(path)


def log_entries(df: DataFrame, payload: Sequence[str | Column], name: str = "changes") -> DataFrame:
    """Fold columns into one JSON text column, ready to be appended to a log table."""
    plain = [c for c in payload if isinstance(c, str)]
    return df.withColumn(name, F.to_json(F.struct(*payload))).drop(*plain)


def clustered(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Order a table by its clustering keys before a write, so row groups can be skipped.

    Ranges are cut over *all* keys: an account holding a large share of the rows
    is spread over several ranges by its later keys.
    """
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def publish(df: DataFrame, name: str, materialisation: str = "table", path: str | None = None) -> None:
    """Materialise under a name: a temporary view, or a fully refreshed Parquet table."""
    if materialisation == "view":
        df.createOrReplaceTempView(name)
    elif materialisation == "table":
        if path is None:
            raise ValueError("a table needs a path")
        refresh(df, path)
        df.sparkSession.read.parquet(path).createOrReplaceTempView(name)
    else:
        raise ValueError(f"unknown materialisation {materialisation!r}; for keyed refreshes see operators.versions.incremental_refresh")


def bucketed_table(df: DataFrame, name: str, key: str, buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """Save as a catalog table in the warehouse, hashed into ``buckets`` files by ``key`` and sorted within them.

    Two tables bucketed alike on their join key are joined bucket by bucket: the plan has no
    exchange on either side, and aggregates by the key need none either. Sorting by the key
    and then ``sort`` keeps row-group statistics narrow, so filters on those columns skip row
    groups. Returns the table as read from the catalog.
    """
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *sort).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


def append_once(entries: DataFrame, path: str, id_column: str) -> int:
    """Append log entries whose id the log does not hold yet; returns how many were appended.

    Entries of an id already logged are skipped, so a repeated or resumed run adds nothing.
    Columns are written as they are, VARIANT payloads included.
    """
    spark = entries.sparkSession
    try:
        logged = spark.read.parquet(path).select(id_column)
        fresh = entries.join(logged, id_column, "left_anti")
    except Exception:  # no log yet
        fresh = entries
    kept = stored(fresh, "log-append")
    appended = kept.count()
    if appended:
        kept.write.mode("append").parquet(path)
    return appended
