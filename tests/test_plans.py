"""What the physical plans must and must not contain."""

import itertools
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from keelmark.operators import features, versions
from keelmark.sources import banking
from parity import QUERIES

NO_PLAN = {"stream_metrics", "version_snapshot"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_PLAN))
def test_no_cartesian_product_and_no_python(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert forbidden not in text


def test_product_scans_are_pruned_and_filtered(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        text = plan(QUERIES["churn_product_v1"](spark, folder))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = re.findall(r"FileScan parquet \[(.*?)\].*?PushedFilters: \[(.*?)\], ReadSchema", text)
    lines = [(columns, pushed) for columns, pushed in scans if "l_orderkey" in columns]
    assert len(lines) == 2
    for columns, pushed in lines:
        assert "l_extendedprice" not in columns and "GreaterThanOrEqual(l_shipdate" in pushed
    assert any("LessThan(l_shipdate" in pushed for _, pushed in lines)


def test_account_aggregate_reuses_the_join_partitioning(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["churn_product_v1"](spark, folder))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange per side of the account join, none for the grouping by account that follows
    by_account = re.findall(r"Exchange hashpartitioning\(account_id#\d+L, \d+\)", text)
    assert len(by_account) == 2


def test_newest_rows_are_limited_before_the_shuffle(spark, folder):
    assert "WindowGroupLimit" in plan(QUERIES["freshness_history"](spark, folder))


def test_refresh_does_not_rank_the_current_table(spark):
    stamp, value = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("score_calculated_at"), F.lit("x").alias("v")
    current = spark.range(9).select(F.col("id").alias("k"), stamp, value)
    incoming = spark.createDataFrame([(1, datetime(2024, 1, 2), "y")], "k bigint, score_calculated_at timestamp_ntz, v string")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = plan(versions.upsert(current, incoming, "k")).splitlines()
    windows = [i for i, line in enumerate(lines) if line.lstrip(" :+-").startswith("Window [")]
    assert windows and any("Range (" in line for line in lines)
    for i in windows:
        below = itertools.takewhile(lambda line: depth(line) > depth(lines[i]), lines[i + 1:])
        assert not any("Range (" in line for line in below)


def test_latest_engagement_stays_in_hash_aggregation(spark, folder):
    text = plan(features.latest_engagement(banking.digital_engagement(spark, folder), date(2001, 9, 1)))
    assert "SortAggregate" not in text


@pytest.mark.parametrize("name", ["products_90d_ago", "product_downgrade", "churn_product_v2"])
def test_holdings_as_of_need_no_calendar(spark, folder, name):
    assert "Generate" not in plan(QUERIES[name](spark, folder))


def test_bucketed_tables_join_without_exchange(spark, folder):
    # as at scale, where neither side is small enough to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["bucketed_account_activity"](spark, folder)
        text = plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text
    assert df.count() > 0


@pytest.mark.parametrize("name", ["row_count_stability", "alert_row_count_drop"])
def test_newest_counts_with_lag_need_at_most_two_exchanges(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert text.count("Exchange") <= 2 and "WindowGroupLimit" in text
