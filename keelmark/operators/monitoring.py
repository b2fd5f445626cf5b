"""Reliability, quality and adoption reports over product, metric and access history."""

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.series import newest, newest_with_previous, with_previous
from keelmark.functions.temporal import hour_of, hours_crossed, moment, moment_before

C = F.col
LABEL = S.LABEL


def _within(column: str, at: datetime, *, days: int = 0, hours: int = 0) -> Column:
    """After the start of the look-back window and not after ``at``."""
    return (C(column) > moment_before(at, days=days, hours=hours)) & (C(column) <= moment(at))


def _label(condition: Column, yes: str, no: str) -> Column:
    return F.when(condition, LABEL[yes]).otherwise(LABEL[no])


# ---------------------------------------------------------------- reliability
def freshness_status(product: DataFrame, at: Sequence[datetime]) -> DataFrame:
    """Age of the newest record against the service level, at each check time."""
    newest_row = product.agg(F.max("score_calculated_at").alias("last_refresh"))
    checked = newest_row.withColumn("check_time", F.explode(F.array(*map(moment, at))))
    aged = checked.withColumn("hours_since_refresh", hours_crossed(C("last_refresh"), C("check_time")))
    return aged.select(
        F.lit("FRESHNESS CHECK").alias("check_type"), "check_time", "hours_since_refresh",
        _label(C("hours_since_refresh") <= S.FRESHNESS_WARN_HOURS, "within_sla", "sla_breach").alias("sla_status"),
        "last_refresh", F.lit(f"{S.FRESHNESS_WARN_HOURS} hours").alias("sla_target"))


def freshness_history(history: DataFrame, limit: int = 48) -> DataFrame:
    """The newest freshness measurements of every table."""
    measured = history.filter(C("metric_name") == "FRESHNESS")
    recent = newest(measured, ["table_name"], [F.desc("measurement_time")], limit)
    return recent.select(
        "table_name", hour_of(C("measurement_time")).alias("check_time"), C("value").alias("freshness_seconds"),
        F.round(C("value").cast("decimal(18,0)") / 3600, 1).cast("decimal(18,1)").alias("freshness_hours"),
        _label(C("value") <= S.FRESHNESS_WARN_HOURS * 3600, "ok", "breach").alias("status"))


def row_counts_with_previous(history: DataFrame) -> DataFrame:
    counts = history.filter(C("metric_name") == "ROW_COUNT")
    return with_previous(counts, ["table_name"], "measurement_time", "value", "previous")


def row_count_stability(history: DataFrame, limit: int = 20) -> DataFrame:
    """Change against the preceding count, for the newest counts of every table."""
    counts = history.filter(C("metric_name") == "ROW_COUNT")
    recent = newest_with_previous(counts, ["table_name"], "measurement_time", "value", "previous", limit)
    percent = (C("value") - C("previous")) / F.nullif(C("previous"), F.lit(0)) * 100
    return recent.select(
        "table_name", hour_of(C("measurement_time")).alias("check_time"), C("value").alias("row_count"),
        C("previous").alias("prev_row_count"), F.round(percent, 1).alias("pct_change"),
        _label(F.abs(percent) > S.ROW_COUNT_CHANGE_PERCENT, "changed", "stable").alias("status"))


def availability(product: DataFrame, name: str = S.PRODUCT) -> DataFrame:
    return product.agg(
        F.count("*").alias("current_row_count"), F.max("data_as_of_date").alias("data_as_of"),
        F.max("score_calculated_at").alias("last_calculated"),
    ).select(F.lit(name).alias("table_name"), "*",
             _label(C("current_row_count") > 0, "available", "unavailable").alias("availability"))


# -------------------------------------------------------------------- quality
def expectation_report(status: DataFrame, limit: int = 50) -> DataFrame:
    recent = newest(status, ["table_name"], [F.desc("measurement_time"), F.asc("expectation_name")], limit)
    violated = C("expectation_violated")
    label = F.when(violated.isNull(), LABEL["unknown"]).otherwise(_label(violated, "failed", "passed"))
    return recent.select("table_name", "expectation_name", label.alias("status"), "metric_name", "metric_value", "measurement_time")


def latest_metrics(history: DataFrame) -> DataFrame:
    """All metrics of each table's newest measurement (the newest times are one small row per table)."""
    last = history.groupBy("table_name").agg(F.max("measurement_time").alias("measurement_time"))
    return history.join(last, ["table_name", "measurement_time"]).select(
        "table_name", "metric_name", C("column_name").alias("columns"), C("value").alias("current_value"),
        C("measurement_time").alias("last_checked"))


def metric_results(history: DataFrame, limit: int = 100) -> DataFrame:
    order = [F.desc("measurement_time"), F.asc("table_name"), F.asc("metric_name")]
    return history.orderBy(*order).limit(limit).select("measurement_time", "metric_name", "table_name", "column_name", "value")


def failed_expectations(status: DataFrame) -> DataFrame:
    return (
        status.filter("expectation_violated")
        .groupBy("table_name", F.to_date("measurement_time").alias("date"), "expectation_name", "expectation_violated", "metric_value")
        .agg(F.count("*").alias("occurrence_count")))


# ------------------------------------------------------------------- adoption
def _uses(access: DataFrame, at: datetime, product: str, **window: int) -> DataFrame:
    return access.filter(_within("query_start_time", at, **window) & F.array_contains("base_objects_accessed", product))


def upstream_lineage(access: DataFrame, at: datetime, product: str = S.PRODUCT, limit: int = 20) -> DataFrame:
    sources = _uses(access, at, product, days=7).select(F.inline("direct_objects_accessed"))
    return sources.select(
        C("objectName").alias("source_object"), C("objectDomain").alias("source_type"), F.lit(product).alias("target_table"),
    ).distinct().orderBy("source_object", "source_type").limit(limit)


def usage_by_role(access: DataFrame, at: datetime, product: str = S.PRODUCT) -> DataFrame:
    return _uses(access, at, product, days=30).groupBy("role_name").agg(
        F.count("*").alias("query_count"),
        F.count_distinct("user_name").alias("unique_users"),
        F.count_distinct(F.to_date("query_start_time")).alias("active_days"),
        F.min("query_start_time").alias("first_access"),
        F.max("query_start_time").alias("last_access"))


def usage_by_user(access: DataFrame, at: datetime, product: str = S.PRODUCT, limit: int = 20) -> DataFrame:
    used = _uses(access, at, product, days=30).groupBy("user_name", "role_name").agg(
        F.count("*").alias("query_count"), F.max("query_start_time").alias("last_access"))
    idle = F.datediff(F.to_date(moment(at)), F.to_date("last_access")).alias("days_since_last_access")
    return used.select("*", idle).orderBy(F.desc("query_count"), "user_name", "role_name").limit(limit)


def usage_daily(access: DataFrame, at: datetime, product: str = S.PRODUCT) -> DataFrame:
    return _uses(access, at, product, days=30).groupBy(F.to_date("query_start_time").alias("date")).agg(
        F.count("*").alias("query_count"),
        F.count_distinct("user_name").alias("unique_users"),
        F.count_distinct("role_name").alias("unique_roles"))


def column_usage(access: DataFrame, at: datetime, product: str = S.PRODUCT, limit: int = 20) -> DataFrame:
    touched = access.filter(_within("query_start_time", at, days=7)).select(F.inline("direct_objects_accessed"))
    columns = F.array_join("columns", ",")
    return (
        touched.filter(C("objectName").contains(product))
        .groupBy(C("objectName").alias("accessed_object"), columns.alias("columns_accessed"))
        .agg(F.count("*").alias("access_count"))
        .orderBy(F.desc("access_count"), "accessed_object", "columns_accessed").limit(limit))


def downstream_dependencies(access: DataFrame, at: datetime, product: str = S.PRODUCT, limit: int = 10) -> DataFrame:
    """Statements that build something from the product."""
    text = F.upper("query_text")
    builds = reduce(Column.__or__, [text.like(p) for p in ("%CREATE%VIEW%", "%CREATE%TABLE%", "%INSERT%INTO%")])
    return (
        _uses(access, at, product, days=7).filter(builds)
        .select("query_text", "user_name", "role_name", "query_start_time").distinct()
        .orderBy(F.desc("query_start_time"), "user_name", "role_name", "query_text").limit(limit))


# --------------------------------------------------------------------- alerts
def freshness_alert(product: DataFrame, at: Sequence[datetime]) -> DataFrame:
    """Does any row exceed the service level at the check time?"""
    old = [
        F.struct(moment(t).alias("check_time"), F.col(f"t{i}").alias("triggered")) for i, t in enumerate(at)
    ]
    stale = [
        (F.count_if(hours_crossed(C("score_calculated_at"), moment(t)) > S.FRESHNESS_WARN_HOURS) > 0).alias(f"t{i}")
        for i, t in enumerate(at)
    ]
    return product.agg(*stale).select(F.inline(F.array(*old)))


def expectation_alert(status: DataFrame, at: datetime, hours: int = 1) -> DataFrame:
    recent = status.filter(_within("measurement_time", at, hours=hours))
    return recent.agg((F.count_if("expectation_violated") > 0).alias("triggered"), F.count_if("expectation_violated").alias("violations"))


def row_count_drop_alert(history: DataFrame) -> DataFrame:
    """Per table: is one of its two newest counts more than the limit below the preceding count?"""
    counts = history.filter(C("metric_name") == "ROW_COUNT")
    two = newest_with_previous(counts, ["table_name"], "measurement_time", "value", "previous", 2)
    dropped = (C("previous") > 0) & ((C("previous") - C("value")) * 100 > C("previous") * S.ROW_COUNT_CHANGE_PERCENT)
    return two.groupBy("table_name").agg((F.count_if(dropped) > 0).alias("triggered"))


def threshold_alerts(history: DataFrame, at: datetime, minimum_rows: int, hours: int = 24) -> DataFrame:
    """Nulls, duplicates or a low row count in the last day's measurements."""
    metric, value = C("metric_name"), C("value")
    conditions = {
        "null_values": (metric == "NULL_COUNT") & (value > 0),
        "duplicate_keys": (metric == "DUPLICATE_COUNT") & (value > 0),
        "low_row_count": (metric == "ROW_COUNT") & (value < minimum_rows),
    }
    recent = history.filter(_within("measurement_time", at, hours=hours))
    counted = recent.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
    rows = [F.struct(F.lit(n).alias("alert_name"), C(n).alias("measurements"), (C(n) > 0).alias("triggered")) for n in conditions]
    return counted.select(F.inline(F.array(*rows)))


# --------------------------------------------------------------------- health
def health_summary(
    product: DataFrame, status: DataFrame, access: DataFrame, product_at: datetime, at: datetime, name: str = S.PRODUCT,
) -> DataFrame:
    """Freshness, quality and usage in one row: three one-row aggregates stacked, then folded."""
    fresh = product.agg(hours_crossed(F.max("score_calculated_at"), moment(product_at)).alias("hours_since_refresh"))
    quality = status.filter(_within("measurement_time", at, hours=1)).agg(
        F.count_if("expectation_violated").alias("failed_expectations"), F.count("*").alias("total_expectations"))
    usage = _uses(access, at, name, days=1).agg(
        F.count("*").alias("queries_last_24h"), F.count_distinct("user_name").alias("unique_users_last_24h"))
    stacked = fresh.unionByName(quality, allowMissingColumns=True).unionByName(usage, allowMissingColumns=True)
    folded = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    plain = lambda condition, no: F.when(condition, "OK").otherwise(no)
    return folded.select(
        F.lit(name).alias("data_product"), "hours_since_refresh",
        plain(C("hours_since_refresh") <= S.FRESHNESS_WARN_HOURS, "BREACH").alias("freshness_status"),
        "failed_expectations", "total_expectations",
        plain(C("failed_expectations") == 0, "ISSUES").alias("quality_status"),
        "queries_last_24h", "unique_users_last_24h", moment(at).alias("checked_at"))
