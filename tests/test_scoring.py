import json
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from keelmark.operators import scoring
from tests.helpers import column, features, rows


def scored(spark, *changes, rule="trend"):
    frame = scoring.with_score(scoring.with_risk_flags(features(spark, *changes), rule))
    return scoring.with_intervention(scoring.with_driver(frame))


def test_flag_limits(spark):
    got = scoring.with_risk_flags(features(
        spark, {}, {"total_relationship_balance": D("499.99")}, {"primary_account_balance": D("99.99")},
        {"days_since_last_transaction": 45}, {"days_since_last_transaction": 46},
        {"login_count_30d": 2, "mobile_app_active": False}, {"login_count_30d": 3, "mobile_app_active": False},
        {"complaints_last_12m": 1}, {"complaints_last_12m": 2}, {"open_complaints_count": 1}))
    assert column(got, "declining_balance_flag") == [False, True, True] + [False] * 7
    assert column(got, "dormancy_flag") == [False] * 4 + [True] + [False] * 5
    assert column(got, "low_engagement_flag") == [False] * 5 + [True] + [False] * 4
    assert column(got, "complaint_flag") == [False] * 8 + [True, True]
    assert column(got, "has_unresolved_complaint") == [False] * 9 + [True]


def test_activity_rules_differ_between_70_and_90_percent(spark):
    changes = ({"txn_count_recent_3m": 7, "transaction_trend": "DECLINING"}, {"txn_count_recent_3m": 6, "transaction_trend": "DECLINING"})
    by = lambda rule: column(scoring.with_risk_flags(features(spark, *changes), rule), "reduced_activity_flag")
    assert by("trend") == [True, True] and by("ratio70") == [False, True]
    with pytest.raises(ValueError):
        scoring.reduced_activity("other")


def test_score_points(spark):
    risky = dict(total_relationship_balance=D("0.00"), transaction_trend="DECLINING", login_count_30d=0, mobile_app_active=False,
                 open_complaints_count=1, days_since_last_transaction=100)
    shielded = dict(total_products_held=3, relationship_tenure_months=61, digital_engagement_score=71)
    got = scored(spark, {}, risky, {**risky, "customer_segment": "MASS_MARKET"}, shielded, {**shielded, "customer_segment": "HIGH_NET_WORTH"},
                 {"relationship_tenure_months": 60, "digital_engagement_score": 70, "total_products_held": 2},
                 {"customer_segment": "MASS_MARKET"}, {"customer_segment": "HIGH_NET_WORTH"})
    # 20; 20+95 capped; 20+95+5 capped; 20-30 floored; floored; untouched; +5; -5
    assert column(got, "churn_risk_score") == [20, 100, 100, 0, 0, 20, 25, 15]


def test_tier_bands(spark):
    scores = [0, 25, 26, 50, 51, 75, 76, 100]
    got = spark.createDataFrame([(s,) for s in scores], "churn_risk_score int").select(
        "churn_risk_score", scoring.by_band(F.col("churn_risk_score"), 0).alias("t"), scoring.by_band(F.col("churn_risk_score"), 3).alias("p"))
    assert [r[1:] for r in rows(got)] == [
        ("LOW", 4), ("LOW", 4), ("MEDIUM", 3), ("MEDIUM", 3), ("HIGH", 2), ("HIGH", 2), ("CRITICAL", 1), ("CRITICAL", 1)]


DRIVER_SCHEMA = """dormancy_flag boolean, days_since_last_transaction int, declining_balance_flag boolean, primary_account_balance decimal(15,2),
reduced_activity_flag boolean, complaint_flag boolean, has_unresolved_complaint boolean, low_engagement_flag boolean, churn_risk_score int"""


@pytest.mark.parametrize("row, driver", [
    ((True, 61, True, D(1), True, True, True, True, 90), "DORMANCY"),
    ((True, 60, True, D(1), True, True, True, True, 90), "BALANCE_DECLINE"),
    ((True, 60, True, D(100), True, True, True, True, 90), "ACTIVITY_REDUCTION"),
    ((False, 9, True, D(100), False, True, True, True, 90), "COMPLAINTS"),
    ((False, 9, True, D(100), False, True, False, True, 90), "LOW_ENGAGEMENT"),
    ((True, 50, True, D(100), False, True, False, False, 51), "MULTI_FACTOR"),
    ((True, 50, False, D(100), False, False, False, False, 50), "NONE"),
])
def test_driver_order(spark, row, driver):
    assert scoring.with_driver(spark.createDataFrame([row], DRIVER_SCHEMA)).first().primary_risk_driver == driver


@pytest.mark.parametrize("score, complaint, quiet, action", [
    (76, True, True, "URGENT_ESCALATION"), (75, True, True, "RELATIONSHIP_CALL"), (51, False, True, "RETENTION_OFFER"),
    (50, True, True, "DIGITAL_ENGAGEMENT"), (26, True, False, "BRANCH_MEETING"), (25, True, True, "NO_ACTION"),
])
def test_interventions(spark, score, complaint, quiet, action):
    df = spark.createDataFrame([(score, complaint, quiet)], "churn_risk_score int, complaint_flag boolean, low_engagement_flag boolean")
    assert scoring.with_intervention(df).first().recommended_intervention == action


def test_driver_detail_is_json(spark):
    detail = json.loads(column(scoring.with_driver_detail(scoring.with_risk_flags(features(spark, {}))), "risk_drivers_json")[0])
    assert detail["declining_balance"] == {"flag": False, "balance": 9000.00}
    assert detail["complaints"] == {"flag": False, "open_count": 0, "total_12m": 0}
    assert set(detail) == {"declining_balance", "reduced_activity", "low_engagement", "complaints", "dormancy"}


def test_lifetime_value_rounds_once_and_half_away_from_zero(spark):
    got = scoring.with_lifetime_value(features(
        spark,
        {"total_relationship_balance": D("25000.00"), "relationship_tenure_months": 0, "customer_segment": "MASS_MARKET"},
        {"total_relationship_balance": D("24999.99"), "relationship_tenure_months": 0, "customer_segment": "MASS_MARKET"},
        {"total_relationship_balance": D("50000.00"), "relationship_tenure_months": 120, "customer_segment": "MASS_MARKET"},
        {"total_relationship_balance": D("50000.00"), "relationship_tenure_months": 121, "customer_segment": "HIGH_NET_WORTH"},
        {"total_relationship_balance": D("0.05"), "relationship_tenure_months": 0, "customer_segment": "AFFLUENT"},
        {"total_relationship_balance": D("-0.05"), "relationship_tenure_months": 0, "customer_segment": "AFFLUENT"},
        {"total_relationship_balance": D("100.00"), "relationship_tenure_months": 1, "customer_segment": "MASS_AFFLUENT"}))
    assert column(got, "estimated_clv") == [
        D("25000.00"), D("24999.99"), D("100000.00"), D("150000.00"), D("0.07"), D("-0.07"), D("110.92")]
    assert column(got, "clv_tier") == ["MEDIUM_VALUE", "STANDARD", "HIGH_VALUE", "HIGH_VALUE", "STANDARD", "STANDARD", "STANDARD"]


CONFIDENCE_SCHEMA = ("churn_risk_score int, dormancy_flag boolean, declining_balance_flag boolean, complaint_flag boolean, "
                     "low_engagement_flag boolean, primary_risk_driver string")


@pytest.mark.parametrize("row, confidence", [
    ((70, False, False, False, False, "NONE"), 50), ((71, False, False, False, False, "NONE"), 70),
    ((100, True, True, True, True, "DORMANCY"), 95), ((40, False, False, False, False, "NONE"), 30),
    ((60, False, False, False, False, "MULTI_FACTOR"), 15), ((39, True, True, False, True, "NONE"), 65), ((61, True, False, True, False, "NONE"), 50),
])
def test_confidence(spark, row, confidence):
    assert scoring.with_confidence(spark.createDataFrame([row], CONFIDENCE_SCHEMA)).first().action_confidence_score == confidence


def test_vulnerability_branches(spark):
    flagged = scoring.with_risk_flags(features(
        spark,
        {"digital_engagement_score": 19, "open_complaints_count": 1, "total_relationship_balance": D("1.00")},
        {"digital_engagement_score": 20, "open_complaints_count": 1, "total_relationship_balance": D("1.00")},
        {"relationship_tenure_months": 121, "digital_engagement_score": 9},
        {"relationship_tenure_months": 120, "digital_engagement_score": 9},
        {"relationship_tenure_months": 121, "digital_engagement_score": 10}))
    assert column(scoring.with_vulnerability(flagged), "vulnerability_indicator") == [True, False, True, False, False]


def test_downgrade_defaults_to_the_current_count(spark):
    held = spark.createDataFrame(
        [(1, date(2024, 1, 1), 9), (1, date(2023, 11, 30), 3), (1, date(2023, 10, 31), 5), (2, date(2023, 11, 30), 1)],
        "customer_id bigint, snapshot_date date, product_count int")
    before = scoring.products_held(held, date(2024, 2, 29))
    assert rows(before) == [(1, 3), (2, 1)]
    got = scoring.with_downgrade(features(spark, {"total_products_held": 2}, {"total_products_held": 1}, {"total_products_held": 4}), before)
    assert column(got, "products_held_90d_ago") == [3, 1, 4]
    assert column(got, "product_downgrade_flag") == [True, False, False]


def test_balance_trend_limits(spark):
    accounts = spark.createDataFrame([(i, i) for i in range(1, 6)], "account_id bigint, customer_id bigint")
    old, new = date(2023, 1, 1), date(2024, 2, 1)
    moves = [(1, old, 100), (1, new, 10), (2, old, 100), (2, new, 11), (3, old, 100), (3, new, -11), (4, old, -100), (4, new, -11)]
    df = spark.createDataFrame([(a, d, D(v)) for a, d, v in moves], "account_id bigint, txn_date date, amount decimal(15,2)")
    got = scoring.balance_trend_over(df, accounts, date(2024, 2, 29))
    assert column(got, "balance_trend_90d") == ["STABLE", "GROWING", "DECLINING", "DECLINING", "STABLE"]


