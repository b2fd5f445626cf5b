from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from keelmark.functions import temporal as t
from tests.helpers import literal


@pytest.mark.parametrize("start, end, months", [
    (date(2024, 2, 29), date(2024, 3, 1), 1),
    (date(2024, 2, 1), date(2024, 2, 29), 0),
    (date(2019, 2, 28), date(2024, 2, 29), 60),
    (date(2019, 1, 31), date(2024, 2, 1), 61),
    (date(2023, 12, 31), date(2024, 1, 1), 1),
])
def test_months_count_boundaries(spark, start, end, months):
    assert literal(spark, m=t.months_crossed(F.lit(start), F.lit(end))).m == months


@pytest.mark.parametrize("start, end, hours", [
    ("2024-01-01 00:59:59", "2024-01-01 01:00:00", 1),
    ("2024-01-01 01:00:00", "2024-01-01 01:59:59", 0),
    ("2024-01-01 06:00:00", "2024-01-02 06:59:00", 24),
    ("2024-01-01 06:59:00", "2024-01-02 07:00:00", 25),
])
def test_hours_count_boundaries(spark, start, end, hours):
    at = lambda text: t.moment(datetime.fromisoformat(text))
    assert literal(spark, h=t.hours_crossed(at(start), at(end))).h == hours


def test_seconds_are_floored_after_subtracting(spark):
    start = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00.200000'")
    end = F.expr("TIMESTAMP_NTZ '2024-01-01 00:02:48.000000'")
    assert literal(spark, s=t.seconds_elapsed(start, end)).s == 167


def test_month_end_steps_back_to_month_end(spark):
    row = literal(spark, a=t.months_before(date(2024, 5, 31), 3), b=t.months_before(date(2024, 2, 29), 12))
    assert (row.a, row.b) == (date(2024, 2, 29), date(2023, 2, 28))


def test_moments_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert literal(spark, m=t.moment(datetime(2024, 3, 10, 2, 30))).m == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_look_back_of_a_whole_day_in_hours(spark):
    row = literal(spark, m=t.moment_before(datetime(2024, 1, 31), hours=24), d=t.moment_before(datetime(2024, 1, 31), days=30))
    assert (row.m, row.d) == (datetime(2024, 1, 30), datetime(2024, 1, 1))
