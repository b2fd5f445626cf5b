from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from keelmark.functions import series
from keelmark.operators import monitoring
from tests.helpers import rows

HISTORY = "table_name string, metric_name string, column_name string, value bigint, measurement_time timestamp_ntz"


def history(spark, counts, table="t", start=datetime(2024, 1, 30), step=timedelta(days=1)):
    return spark.createDataFrame([(table, "ROW_COUNT", "*", v, start + i * step) for i, v in enumerate(counts)], HISTORY)


def test_previous_value_equals_lag_across_periods_and_gaps(spark):
    long = history(spark, [i * 7 % 50 for i in range(400)], "big", datetime(2023, 1, 1), timedelta(hours=31))
    gappy = history(spark, [5, None, 7], "gap", datetime(2023, 1, 31), timedelta(days=80))
    unnamed = history(spark, [1, 2, 3], None, datetime(2023, 1, 31), timedelta(days=20))
    df = long.unionByName(gappy).unionByName(unnamed)
    plain = F.lag("value").over(Window.partitionBy("table_name").orderBy("measurement_time"))
    split = series.with_previous(df, ["table_name"], "measurement_time", "value", "previous").select(*df.columns, "previous")
    key = lambda r: (r[0] or "", r[4])
    assert sorted((tuple(r) for r in split.collect()), key=key) == sorted((tuple(r) for r in df.withColumn("previous", plain).collect()), key=key)


def test_newest_keeps_a_number_per_key(spark):
    df = spark.createDataFrame([(k, n) for k in "ab" for n in range(5)], "k string, n int")
    assert rows(series.newest(df, ["k"], [F.desc("n")], 2)) == [("a", 3), ("a", 4), ("b", 3), ("b", 4)]


def test_stability_marks_only_changes_over_the_limit(spark):
    got = {r.row_count: (r.prev_row_count, r.pct_change, r.status[-6:]) for r in monitoring.row_count_stability(history(spark, [100, 120, 145, 0, 9])).collect()}
    assert got[100] == (None, None, "STABLE") and got[120] == (100, 20.0, "STABLE")
    assert got[145][1] == 20.8 and got[145][2] == "CHANGE"
    assert got[0] == (145, -100.0, "CHANGE") and got[9] == (0, None, "STABLE")  # no change is defined from zero


def test_drop_alert_reads_the_two_newest_counts(spark):
    alert = lambda counts: monitoring.row_count_drop_alert(history(spark, counts)).first().triggered
    assert alert([100, 79]) and alert([100, 79, 79]) and not alert([100, 79, 79, 79])
    assert not alert([100, 80]) and not alert([100, 200]) and not alert([0, 5]) and not alert([5])


def test_expectation_alert_window_is_one_hour(spark):
    at = datetime(2024, 1, 31)
    df = spark.createDataFrame([("t", True, at - timedelta(hours=1)), ("t", False, at), ("t", True, at + timedelta(seconds=1))],
                               "table_name string, expectation_violated boolean, measurement_time timestamp_ntz")
    assert rows(monitoring.expectation_alert(df, at)) == [(False, 0)]
    assert rows(monitoring.expectation_alert(df, at + timedelta(seconds=1))) == [(True, 1)]


def test_unknown_expectations_are_reported_as_such(spark):
    df = spark.createDataFrame([("t", "e", None, "M", 1, datetime(2024, 1, 1))],
                               "table_name string, expectation_name string, expectation_violated boolean, metric_name string, metric_value bigint, measurement_time timestamp_ntz")
    assert monitoring.expectation_report(df).first().status.endswith("UNKNOWN")


def test_threshold_alerts(spark):
    at = datetime(2024, 1, 31)
    df = spark.createDataFrame([
        ("t", "NULL_COUNT", "a", 1, at - timedelta(hours=24)), ("t", "DUPLICATE_COUNT", "a", 2, at), ("t", "ROW_COUNT", "*", 10, at)], HISTORY)
    assert rows(monitoring.threshold_alerts(df, at, minimum_rows=10)) == [("duplicate_keys", 1, True), ("low_row_count", 0, False), ("null_values", 0, False)]


def test_freshness_reports(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 6, 30),), (datetime(2024, 1, 2, 6, 30),)], "score_calculated_at timestamp_ntz")
    at = [datetime(2024, 1, 3, 6, 59), datetime(2024, 1, 3, 7, 0)]
    assert [r.hours_since_refresh for r in monitoring.freshness_status(df, at).orderBy("check_time").collect()] == [24, 25]
    # the alert looks at every row, not at the newest
    assert [r.triggered for r in monitoring.freshness_alert(df, [datetime(2024, 1, 2, 6, 0), *at]).orderBy("check_time").collect()] == [False, True, True]


def test_health_of_an_empty_history(spark):
    product = spark.createDataFrame([(datetime(2024, 1, 1, 6),)], "score_calculated_at timestamp_ntz")
    status = spark.createDataFrame([], "expectation_violated boolean, measurement_time timestamp_ntz")
    access = spark.createDataFrame([], "query_start_time timestamp_ntz, user_name string, base_objects_accessed array<string>")
    row = monitoring.health_summary(product, status, access, datetime(2024, 1, 3), datetime(2024, 1, 3)).first()
    assert (row.freshness_status, row.quality_status, row.total_expectations, row.queries_last_24h) == ("BREACH", "OK", 0, 0)
