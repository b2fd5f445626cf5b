"""Masking by role, masking compliance, retention and erasure."""

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import masked, text, to_rows
from keelmark.functions.temporal import day
from keelmark.operators.versions import BUCKET, key_bucket, write_bucketed
from keelmark.plans.contract import Contract
from keelmark.session import run_dir

C = F.col

#: A removal broadcasts at most this many keys.
BROADCAST_KEYS = 1_000_000


def masked_view(df: DataFrame, contract: Contract, roles: Iterable[str]) -> DataFrame:
    """The table as seen by a session with these roles: any authorised role sees the value."""
    held = {role.lower() for role in roles}
    hidden = {m.column: masked(C(m.column)) for m in contract.masks if m.column in df.columns and not held & m.roles}
    return df.withColumns(hidden) if hidden else df


def masking_compliance(published: DataFrame, original: DataFrame, contract: Contract) -> DataFrame:
    """Rows of a masked publication that do not carry the mask of the original value."""
    columns = [m.column for m in contract.masks]
    kept = original.select(contract.key, *[C(c).alias(f"_{c}") for c in columns])
    paired = published.select(contract.key, *columns).join(kept, contract.key)
    measured = paired.agg(
        F.count("*").alias("checked"), *[F.count_if(~C(c).eqNullSafe(masked(C(f"_{c}")))).alias(c) for c in columns])
    return to_rows(measured, [(text(c), "checked", c) for c in columns], ("column_name", "checked_rows", "unmasked_rows"))


def expired_accounts(accounts: DataFrame, as_of: date, months: int = S.RETENTION_MONTHS) -> DataFrame:
    """Accounts whose closure is further back than the retention period."""
    return accounts.filter(F.add_months("closed_date", months) < day(as_of))


def without(df: DataFrame, key: str, keys: DataFrame, on: str | None = None) -> DataFrame:
    """``df`` minus the rows whose key is listed in ``keys``."""
    listed = keys.select(C(on or key).alias("_listed")).distinct()
    return df.join(listed, C(key) == C("_listed"), "left_anti")


def removal_audit(tables: Mapping[str, tuple[DataFrame, str]], keys: DataFrame, on: str) -> DataFrame:
    """Per table: rows before, removed and kept, for a removal by key.

    Rows are counted per key first, so the audit joins one record per key.
    """
    listed = keys.select(C(on).alias("_listed")).distinct().withColumn("_hit", F.lit(True))
    result = None
    for name, (df, key) in tables.items():
        per_key = df.groupBy(C(key).alias("_key")).agg(F.count("*").alias("n"))
        joined = per_key.join(listed, C("_key") == C("_listed"), "left")
        audit = joined.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum(F.when(C("_hit"), C("n"))), F.lit(0)).alias("rows_removed"))
        row = audit.select(F.lit(name).alias("table_name"), "*", (C("rows_before") - C("rows_removed")).alias("rows_kept"))
        result = row if result is None else result.unionByName(row)
    return result


def remove_by_key(path: str, key: str, keys: DataFrame, on: str, buckets: int, bucket_by: str | None = None) -> int:
    """Delete the rows of a bucketed table whose ``key`` is listed; only buckets holding a listed key are rewritten.

    The touched buckets are read (partition pruning), the listed keys taken away by an anti-join,
    the rest staged by bucket in a new folder and written back, as staged, with dynamic partition
    overwrite; a bucket left without rows is replaced by an empty one. Up to ``BROADCAST_KEYS`` keys
    are broadcast, and the table is not shuffled at all; more are joined by a shuffle, and the rest
    dealt out by bucket again. ``keys`` are read several times and should be stored. Untouched buckets keep their files. Null keys
    are never listed. When the table is bucketed by another column than ``key``, ``bucket_by``
    names that column in ``keys``: the listed rows then say which buckets they live in.
    Returns the number of rows removed.
    """
    spark = keys.sparkSession
    listed = keys.select(C(on).alias("_listed"), C(bucket_by or on).alias("_bucket_key")).where(C("_listed").isNotNull())
    touched = sorted(r[0] for r in listed.select(key_bucket("_bucket_key", buckets)).distinct().collect())  # <= buckets values
    listed = listed.select("_listed").distinct()
    if not touched:
        return 0
    current = spark.read.parquet(path).where(C(BUCKET).isin(touched))
    before = current.count()
    few = listed.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    kept = current.join(F.broadcast(listed) if few else listed, C(key) == C("_listed"), "left_anti")
    kept = kept if few else kept.repartition(BUCKET)
    staging = run_dir(spark, "removal-stage")
    kept.write.partitionBy(BUCKET).parquet(staging)
    staged = spark.read.schema(kept.schema).parquet(staging)  # the schema is given: all rows may be gone
    after = {r[0]: r[1] for r in staged.groupBy(BUCKET).count().collect()}
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    schema = current.drop(BUCKET).schema
    for bucket in touched:
        if bucket not in after:
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{BUCKET}={bucket}")
    return before - sum(after.values())


def store_for_removal(tables: Mapping[str, tuple[DataFrame, str]], folder: str, buckets: int) -> dict[str, tuple[str, str]]:
    """Store each table bucketed by the key removals go by: name -> (path, key)."""
    stored = {}
    for name, (df, key) in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        write_bucketed(df, path, key, buckets)
        stored[name] = (path, key)
    return stored


def apply_removal(spark, stored: Mapping[str, tuple[str, str]], cascade: Iterable[tuple[str, str, str, str | None]],
                  keys: DataFrame, on: str, request_id: str, log_path: str, buckets: int) -> bool:
    """Carry out one removal request through a cascade of keys, and log it once.

    ``cascade`` lists (table, key, source, source_key) in order: the rows of ``table`` whose ``key``
    is among the ``source_key`` values of ``source`` are removed, where ``source`` is ``"request"``
    for the requested keys or an earlier table of the cascade (its rows of the request, read
    before that table loses them). A request already in the log is not applied again, so a
    repeated or resumed run changes nothing; the log gains one row per table of the request.
    """
    try:
        done = spark.read.parquet(log_path).where(C("request_id") == request_id).limit(1).count() > 0
    except Exception:  # no log written yet
        done = False
    if done:
        return False
    requested = keys.select(C(on).alias("_key")).where(C("_key").isNotNull()).distinct()
    gathered = {"request": (_held(requested, "request"), "_key")}
    cascade, entries = list(cascade), []
    for table, key, source, source_key in cascade:
        frame, column = gathered[source]
        listed = frame.select(C(source_key or column).alias("_key"))
        path, _ = stored[table]
        wanted = {column or key for _, _, origin, column in cascade if origin == table}
        if wanted:  # keys of the rows about to go, kept for the tables further down the cascade
            going = spark.read.parquet(path).join(listed.select(C("_key").alias("_k")), C(key) == C("_k"), "left_semi")
            gathered[table] = (_held(going.select(*sorted(wanted)).distinct(), table), key)
        removed = remove_by_key(path, key, listed, "_key", buckets)
        entries.append((request_id, table, key, removed))
    log = spark.createDataFrame(entries, "request_id string, table_name string, key_column string, rows_removed bigint")
    log.coalesce(1).write.mode("append").parquet(log_path)
    return True


def _held(df: DataFrame, purpose: str) -> DataFrame:
    # keys of rows that the next step deletes are read by later steps: store them first, in the shared folder
    path = run_dir(df.sparkSession, f"removal-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
