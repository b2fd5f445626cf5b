from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from keelmark.operators import features, scoring
from keelmark.sources import banking
from keelmark.sources.banking import Sources
from tests.helpers import AS_OF, literal, rows

ACCOUNTS = "account_id bigint, customer_id bigint, account_type string, account_status string, current_balance decimal(15,2)"
MOVES = "txn_id string, account_id bigint, txn_date date, amount decimal(15,2), channel string"
ENGAGEMENT = ("engagement_id string, customer_id bigint, measurement_date date, login_count_30d int, mobile_app_active boolean, "
              "online_banking_active boolean, features_used_count int")
COMPLAINTS = "complaint_id bigint, customer_id bigint, complaint_date date, status string, severity string, resolution_date date"
CUSTOMERS = "customer_id bigint, customer_name string, customer_segment string, region string, onboarding_date date, kyc_status string"


def accounts(spark):
    return spark.createDataFrame([
        (10, 1, "CURRENT_ACCOUNT", "ACTIVE", D("-50.00")), (11, 1, "LOAN", "ACTIVE", D("800.00")),
        (12, 1, "ISA", "CLOSED", D("999.00")),
        (20, 2, "CURRENT_ACCOUNT", "ACTIVE", D("-50.00")),
        (30, 3, "CURRENT_ACCOUNT", "CLOSED", D("70.00")),
    ], ACCOUNTS)


def moves(spark):
    listed = [(10, d) for d in ("2023-11-29", "2024-01-15", "2024-02-29", "2024-03-01", "2023-08-28")]
    listed += [(11, "2023-08-29"), (11, "2023-11-28"), (30, "2024-02-01")]
    return spark.createDataFrame(
        [(f"t{i}", a, date.fromisoformat(d), D("5.00"), "ATM") for i, (a, d) in enumerate(listed)], MOVES)


def test_account_metrics(spark):
    got = {r.customer_id: r for r in features.account_metrics(accounts(spark)).collect()}
    assert set(got) == {1, 2}
    # beside another account a negative current balance reads as zero; alone it stays negative
    assert got[1].primary_account_balance == 0 and got[2].primary_account_balance == D("-50.00")
    assert (got[1].total_products_held, got[1].total_relationship_balance) == (2, D("750.00"))


def test_activity_windows_at_month_end(spark):
    got = rows(features.account_activity(moves(spark), AS_OF))
    # recent from 2023-11-29, prior from 2023-08-29; later than the as-of day and older than six months are out
    assert got == [(10, 3, 0, date(2024, 2, 29)), (11, 0, 2, date(2023, 11, 28)), (30, 1, 0, date(2024, 2, 1))]


def test_one_pass_metrics_equal_the_separate_ones(spark):
    a, m = accounts(spark), moves(spark)
    apart = features.account_metrics(a).join(features.transaction_metrics(a, m, AS_OF), "customer_id")
    together = features.relationship_metrics(a, m, AS_OF).select(apart.columns)
    assert rows(together) == rows(apart)


def test_one_pass_metrics_count_repeated_account_rows_like_the_separate_ones(spark):
    a = accounts(spark).unionByName(accounts(spark).filter("account_id = 10"))
    m = moves(spark)
    apart = features.account_metrics(a).join(features.transaction_metrics(a, m, AS_OF), "customer_id")
    assert rows(features.relationship_metrics(a, m, AS_OF).select(apart.columns)) == rows(apart)


def test_latest_engagement_is_one_whole_row_up_to_the_date(spark):
    days = [("a", 1, date(2024, 1, 1), 9, True, True, 1), ("b", 1, date(2024, 2, 1), 1, False, None, 2),
            ("c", 1, date(2024, 2, 1), 2, None, True, 3), ("d", 1, date(2024, 2, 2), 7, True, True, 7)]
    newest = lambda listed: rows(features.latest_engagement(spark.createDataFrame(listed, ENGAGEMENT), date(2024, 2, 1)))
    assert newest(days) == newest(days[::-1])
    assert newest(days)[0] in [(1, date(2024, 2, 1), 1, False, None, 2), (1, date(2024, 2, 1), 2, None, True, 3)]
    assert newest(days[3:]) == []


def test_complaints_outside_the_year_do_not_count(spark):
    got = features.complaint_metrics(spark.createDataFrame([
        (1, 1, date(2023, 2, 28), "OPEN", "HIGH", None), (2, 1, date(2023, 2, 27), "OPEN", "HIGH", None),
        (3, 1, date(2024, 2, 29), "RESOLVED", "HIGH", None), (4, 1, date(2024, 3, 1), "OPEN", "HIGH", None)], COMPLAINTS), AS_OF)
    assert rows(got) == [(1, 1, 2)]


@pytest.mark.parametrize("recent, prior, trend", [
    (5, 0, "STABLE"), (0, 0, "STABLE"), (12, 10, "INCREASING"), (11, 10, "STABLE"), (9, 10, "STABLE"),
    (8, 10, "DECLINING"), (5, 10, "DECLINING"), (4, 10, "SEVERELY_DECLINING"), (0, 1, "SEVERELY_DECLINING"),
])
def test_trend_limits(spark, recent, prior, trend):
    assert literal(spark, t=features.transaction_trend(F.lit(recent), F.lit(prior))).t == trend


def test_customer_without_anything_gets_defaults(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    sources = Sources(
        spark.createDataFrame([(7, "Bo", "AFFLUENT", "ASIA", date(2024, 2, 1), "VERIFIED"),
                               (8, "Cy", "AFFLUENT", "ASIA", date(2024, 2, 1), "FAILED")], CUSTOMERS),
        empty(ACCOUNTS), empty(MOVES), empty(ENGAGEMENT), empty(COMPLAINTS))
    row, = scoring.with_risk_flags(features.customer_features(sources, AS_OF)).collect()
    assert row.customer_id == 7 and row.days_since_last_transaction == 999 and row.transaction_trend == "STABLE"
    assert (row.total_products_held, row.digital_engagement_score, row.relationship_tenure_months) == (0, 0, 0)
    assert row.declining_balance_flag and row.dormancy_flag and row.low_engagement_flag
    assert not row.reduced_activity_flag and not row.complaint_flag


def test_snapshots_match_a_month_by_month_count(spark):
    held = spark.createDataFrame([
        (1, date(2023, 1, 31), None), (1, date(2023, 2, 1), date(2023, 4, 30)), (1, date(2023, 6, 15), date(2023, 6, 20)),
        (2, date(2023, 1, 5), date(2023, 3, 31)), (2, date(2023, 5, 1), date(2023, 5, 31)), (2, date(2023, 5, 2), None),
        (3, date(2024, 1, 1), None)], "customer_id bigint, opened_date date, closed_date date")
    data = [tuple(r) for r in held.collect()]
    for until in (date(2023, 7, 31), date(2023, 7, 30), date(2023, 2, 28)):
        ends = [date(2023, m, d) for m, d in ((1, 31), (2, 28), (3, 31), (4, 30), (5, 31), (6, 30), (7, 31))]
        expected = []
        for customer in (1, 2, 3):
            for end in ends:
                open_ = sum(1 for c, o, x in data if c == customer and o <= end and (x is None or x > end))
                if open_ and end <= until:
                    expected.append((customer, end, open_))
        assert rows(banking.product_snapshots(held, until)) == sorted(expected)


def test_as_of_join_takes_the_last_span_begun(spark):
    from keelmark.functions.series import as_of

    spans = spark.createDataFrame(
        [(1, date(2024, 1, 31), 2), (1, date(2024, 3, 31), 5), (2, date(2024, 5, 31), 1), (None, date(2024, 1, 31), 7)],
        "k bigint, start date, n int")
    probes = spark.createDataFrame(
        [(1, date(2024, 3, 31), "on a start"), (1, date(2024, 2, 15), "between"), (1, date(2023, 1, 1), "before"),
         (2, date(2024, 6, 1), "after"), (3, date(2024, 6, 1), "no spans"), (None, date(2024, 6, 1), "null key"),
         (1, date(2024, 2, 15), "between")],
        "k bigint, at date, label string")
    got = sorted((r["label"], r["held"]) for r in as_of(probes, spans, "k", "at", "start", "n", "held").collect())
    assert got == [("after", 1), ("before", None), ("between", 2), ("between", 2), ("no spans", None),
                   ("null key", 7), ("on a start", 5)]


def test_sequence_continues_without_gap_or_repeat(spark, tmp_path):
    from keelmark.operators import shaping

    seq = str(tmp_path / "seq")
    first = spark.range(0, 1000, numPartitions=7).toDF("k")
    second = spark.range(1000, 1250, numPartitions=3).toDF("k")
    a = shaping.continue_sequence(first, seq, "a").collect()
    b = shaping.continue_sequence(second, seq, "b").collect()
    numbers = sorted(r["seq"] for r in a + b)
    assert numbers == list(range(1, 1251))
    assert sorted(r["seq"] for r in b) == list(range(1001, 1251))
    assert shaping.continue_sequence(spark.range(0).toDF("k"), seq, "empty").count() == 0
    with pytest.raises(ValueError):
        shaping.continue_sequence(second, seq, "b")


def test_newest_with_previous_equals_lag_over_whole_series(spark):
    from pyspark.sql import Window

    from keelmark.functions.series import newest_with_previous

    rows_ = [("a", t, t * 10) for t in range(50)] + [("b", 1, 5), (None, 3, 7), (None, 4, 8)]
    df = spark.createDataFrame(rows_, "k string, t int, v int")
    full = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    expected = full.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("t")))).filter("r <= 3").drop("r")
    got = newest_with_previous(df, ["k"], "t", "v", "p", 3)
    key = lambda r: (r[0] or "", r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)
