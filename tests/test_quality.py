from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keelmark.operators import quality, rules
from tests.helpers import rows

PRODUCT = """customer_id bigint, churn_risk_score int, risk_tier string, recommended_intervention string, intervention_priority int,
digital_engagement_score int, declining_balance_flag boolean, reduced_activity_flag boolean, low_engagement_flag boolean,
complaint_flag boolean, dormancy_flag boolean"""
SOUND = [
    (1, 0, "LOW", "NO_ACTION", 4, 0, False, False, False, False, False), (2, 25, "LOW", "NO_ACTION", 4, 100, False, False, False, False, False),
    (3, 26, "MEDIUM", "BRANCH_MEETING", 3, 50, False, False, False, False, False), (4, 51, "HIGH", "RETENTION_OFFER", 2, 50, True, False, False, False, False),
    (5, 100, "CRITICAL", "URGENT_ESCALATION", 1, 50, False, False, False, False, True),
]


@pytest.mark.parametrize("rule_id", rules.V1_RULES)
def test_rules_are_silent_on_sound_rows(spark, rule_id):
    assert rules.violations(spark.createDataFrame(SOUND, PRODUCT), rule_id).count() == 0


@pytest.mark.parametrize("rule_id, row", [
    ("BR001", (9, 26, "LOW", "NO_ACTION", 3, 0, True, False, False, False, False)),
    ("BR001", (9, 101, "CRITICAL", "NO_ACTION", 1, 0, True, False, False, False, False)),
    ("BR002", (9, 60, "HIGH", "NO_ACTION", 2, 0, False, False, False, False, False)),
    ("BR003", (9, 60, "HIGH", "URGENT_ESCALATION", 2, 0, True, False, False, False, False)),
    ("BR004", (9, 60, "HIGH", "NO_ACTION", 1, 0, True, False, False, False, False)),
    ("BR004", (9, 60, "HIGH", "NO_ACTION", 7, 0, True, False, False, False, False)),
    ("DQ001", (9, -1, "LOW", "NO_ACTION", 4, 0, True, False, False, False, False)),
    ("DQ002", (9, 10, "LOW", "NO_ACTION", 4, 101, True, False, False, False, False)),
])
def test_rules_find_a_row_made_to_break_them(spark, rule_id, row):
    found = rules.violations(spark.createDataFrame([*SOUND, row], PRODUCT), rule_id).collect()
    assert [r.customer_id for r in found] == [9] and found[0].violation.startswith(rule_id)


@pytest.mark.parametrize("rule_id", ["BR001", "BR004", "DQ001", "DQ002"])
def test_null_operands_make_a_rule_silent(spark, rule_id):
    empty = [(1, None, None, None, None, None, False, False, False, False, False)]
    assert rules.violations(spark.createDataFrame(empty, PRODUCT), rule_id).count() == 0


def test_version_two_rules(spark):
    df = spark.createDataFrame([
        (1, 100000.0, "HIGH_VALUE", 2, 2, False, 50), (2, 99999.99, "HIGH_VALUE", 2, 3, True, 0), (3, 25000.0, "STANDARD", 3, 2, True, 101),
        (4, 24999.99, "STANDARD", 1, 2, False, -1)],
        "customer_id int, estimated_clv double, clv_tier string, total_products_held int, products_held_90d_ago int, "
        "product_downgrade_flag boolean, action_confidence_score int")
    ids = lambda rule: sorted(r.customer_id for r in rules.violations(df, rule).collect())
    assert (ids("CLV_TIER"), ids("DOWNGRADE"), ids("CONFIDENCE")) == ([2, 3], [3, 4], [3, 4])


TABLE = "id string, kind string, at timestamp_ntz"


def some(spark):
    return spark.createDataFrame([("a", "x", datetime(2024, 1, 1)), ("a", None, None), (None, "y", datetime(2024, 1, 2)), ("b", "x", None)], TABLE)


def test_metrics(spark):
    df = some(spark)
    assert rows(quality.null_counts(df)) == [("NULL_COUNT", "at", 2), ("NULL_COUNT", "id", 1), ("NULL_COUNT", "kind", 1)]
    assert rows(quality.duplicate_count(df, "id")) == [("DUPLICATE_COUNT", "id", 2)]
    assert rows(quality.unique_counts(df, ["id", "kind"])) == [("UNIQUE_COUNT", "id", 2), ("UNIQUE_COUNT", "kind", 2)]
    assert rows(quality.row_count(df)) == [("ROW_COUNT", "*", 4)]
    assert rows(quality.freshness(df, "at", [datetime(2024, 1, 2, 0, 1), datetime(2024, 1, 3)])) == [
        ("FRESHNESS", "at", 60), ("FRESHNESS", "at", 86400)]


def test_expectations_match_by_metric_and_column(spark):
    metrics = quality.measure(some(spark), "id", ["id", "kind"], "at", datetime(2024, 1, 3))
    wanted = [quality.Expectation("no_null_id", "NULL_COUNT", "id", "=", 0), quality.Expectation("young", "FRESHNESS", None, "<=", 86400),
              quality.Expectation("enough", "ROW_COUNT", "*", ">=", 5)]
    got = {r.expectation_name: r.expectation_violated for r in quality.evaluate(metrics, wanted).collect()}
    assert got == {"no_null_id": True, "young": False, "enough": True}


def test_column_tests(spark):
    got = rows(quality.column_tests(some(spark), "t", {"id": ("unique", "not_null"), "kind": (("x",),)}))
    assert got == [("t", "id", "not_null", 1), ("t", "id", "unique", 1), ("t", "kind", "accepted_values", 1)]


def test_orphans_count_rows_and_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (3,), (4,), (4,), (4,), (None,)], "fk int")
    parent = spark.createDataFrame([(1, True), (1, True), (4, False)], "id int, good boolean")
    assert rows(quality.orphans(child, "fk", parent, "id", F.col("good"))) == [(3, 2, 3)]
    assert rows(quality.orphans(child.filter("fk = 1"), "fk", parent, "id")) == [(0, 0, 0)]


def test_minimum_and_age_return_rows_only_when_broken(spark):
    df = some(spark)
    assert quality.too_few_rows(df, 4).count() == 0
    assert rows(quality.too_few_rows(df.filter("false"), 1))[0][2] == 0
    assert quality.stale(df, "at", [datetime(2024, 1, 3, 0, 59)]).count() == 0
    assert quality.stale(df, "at", [datetime(2024, 1, 3, 1, 0)]).first().hours_since_refresh == 25


def test_high_risk_share(spark):
    df = spark.createDataFrame([("HIGH",), ("LOW",), ("LOW",), ("LOW",)], "risk_tier string")
    row = quality.high_risk_share(df).first()
    assert (float(row.high_risk_percent), row.violated) == (25.0, True)
    assert not quality.high_risk_share(df.unionByName(df.filter("risk_tier = 'LOW'"))).first().violated


def test_bitmaps_merge_days_exactly(spark, tmp_path):
    from keelmark.operators import cardinality

    schema = "k bigint, tier string, region string"
    day1 = spark.createDataFrame([(1, "LOW", "EU"), (2, "HIGH", None), (70000, "LOW", "EU")], schema)
    day2 = spark.createDataFrame([(2, "MEDIUM", "ASIA"), (3, "LOW", "EU"), (None, None, "US")], schema)
    path, store = str(tmp_path / "dictionary"), str(tmp_path / "bitmaps")
    first = {(r[0], r[1]): r[2] for r in cardinality.extend_dictionary(day1, ["tier", "region"], path).collect()}
    for label, frame in (("d1", day1), ("d2", day2)):
        dictionary = cardinality.extend_dictionary(frame, ["tier", "region"], path)
        cardinality.day_bitmaps(frame, label, ["tier", "region"], dictionary, "k").write.mode("append").partitionBy("day").parquet(store)
    again = {(r[0], r[1]): r[2] for r in spark.read.parquet(path).collect()}
    assert all(again[v] == code for v, code in first.items())  # codes never change
    assert len(again) == len(set(again)) == 6
    got = {r["column_name"]: r["value"] for r in cardinality.merged_counts(spark.read.parquet(store)).collect()}
    assert got == {"k": 4, "tier": 3, "region": 3}
