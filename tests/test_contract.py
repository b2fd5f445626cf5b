from datetime import datetime
from decimal import Decimal as D

import pytest

from keelmark import settings as S
from keelmark.operators import quality
from keelmark.plans import contract as c

V1, V2 = c.bundled(S.V1), c.bundled(S.V2)


def test_both_shapes_describe_the_same_kind_of_contract():
    for contract, width in ((V1, 32), (V2, 38)):
        by_name = {f.name: f for f in contract.fields}
        assert len(by_name) == width and contract.key == "customer_id"
        assert by_name["customer_id"].unique and by_name["customer_id"].max_length == 50
        assert len(contract.required) == width
        assert by_name["risk_tier"].allowed == S.TIERS
        assert contract.freshness_column == "score_calculated_at"
        assert (contract.warn_hours, contract.fail_hours) == (24, 25)
        assert contract.retention_months == 84
        assert contract.masks[0].column == "customer_name" and contract.masks[0].roles == frozenset(S.AUTHORISED_ROLES)
    assert (V1.minimum_rows, V2.minimum_rows) == (50000, 500)
    assert (V1.high_risk_percent, V2.high_risk_percent) == (25, None)
    assert V1.completeness["digital_engagement_score"] == 90 and V2.completeness == {"customer_id": 100, "churn_risk_score": 100, "estimated_clv": 100}


def test_columns_of_the_contracts_are_the_columns_of_the_products():
    assert {f.name for f in V1.fields} == set(S.V1_COLUMNS)
    assert {f.name for f in V2.fields} == {*S.V1_COLUMNS, *S.V2_ADDED}


def test_list_shape_keeps_check_expressions_and_validity():
    score = next(f for f in V2.fields if f.name == "churn_risk_score")
    assert score.checks == ("churn_risk_score >= 0 AND churn_risk_score <= 100", "churn_risk_score BETWEEN 0 AND 100")


def test_what_a_contract_implies():
    assert V1.unique == V2.unique == ["customer_id"]
    assert V1.dimensions == ["customer_segment", "region", "transaction_trend", "balance_trend", "risk_tier",
                             "primary_risk_driver", "recommended_intervention"]
    implied = {e.name: e.limit for e in c.expectations(V1)}
    assert len(implied) == 35 and implied["freshness_sla"] == 90000 and implied["min_row_count"] == 50000
    tests = c.column_tests(V2)
    assert tests["customer_id"] == ("unique", "not_null") and tests["intervention_priority"] == ("not_null", (1, 2, 3, 4))


def test_roles_fall_back_to_access_control():
    document = {"metadata": {"name": "x", "version": 1}, "spec": {
        "schema": {"primary_key": "id", "properties": {"id": {"type": "string"}}},
        "masking_policies": {"M": {"applies_to": "id"}}, "access_control": {"authorized_roles": [{"role": "ANALYST"}, "Clerk"]}}}
    found = c.from_document(document)
    assert found.masks[0].roles == {"analyst", "clerk"} and found.unique == ["id"] and found.required == ["id"]


def test_contract_column_tests_run(spark):
    df = spark.createDataFrame([("a", 5), ("a", 1)], "customer_id string, intervention_priority int")
    tests = {k: v for k, v in c.column_tests(V2).items() if k in df.columns}
    assert {(r.column_name, r.test): r.failures for r in quality.column_tests(df, "t", tests).collect()} == {
        ("customer_id", "unique"): 1, ("customer_id", "not_null"): 0, ("intervention_priority", "not_null"): 0,
        ("intervention_priority", "accepted_values"): 1}


def test_thresholds_are_found_in_either_place():
    document = {"metadata": {"name": "x", "version": 1}, "spec": {
        "schema": {"properties": {"id": {"type": "string", "constraints": {"unique": True}}, "at": {"type": "timestamp"}}},
        "data_quality": {"monitoring": {"metrics": [{"name": "row_count", "threshold": "> 12"}]}}}}
    found = c.from_document(document)
    assert (found.key, found.minimum_rows, found.warn_hours, found.fail_hours) == ("id", 12, 24, 25)


DOCUMENT = {"metadata": {"name": "t", "version": "1"}, "spec": {
    "schema": {"primary_key": "id", "properties": {
        "id": {"type": "string", "constraints": {"required": True, "unique": True, "max_length": 3}},
        "kind": {"type": "string", "constraints": {"enum": ["A", "B"]}},
        "n": {"type": "integer", "constraints": {"minimum": 1, "maximum": 9}},
        "at": {"type": "timestamp", "constraints": {}}}},
    "data_quality": {
        "completeness": {"kind": 75},
        "business_rules": [{"name": "n_even", "validation": "n % 2 = 0", "severity": "warning"}]}}}


def results(spark, rows):
    df = spark.createDataFrame(rows, "id string, kind string, n int, at timestamp_ntz")
    found = c.suite(df, c.from_document(DOCUMENT), datetime(2024, 1, 3), minimum_rows=4)
    return found, {(r.rule, r.column_name): r for r in found.collect()}


def test_suite_passes_on_sound_rows(spark):
    at = datetime(2024, 1, 2)
    found, by = results(spark, [("a", "A", 2, at), ("b", "B", 4, at), ("c", "A", 8, at), ("d", None, 2, at)])
    assert not any(r.violated for r in by.values())
    assert by[("freshness_seconds", "at")].value == 86400 and by[("completeness", "kind")].value == D("75.00")
    assert c.gate(found).first().passed


@pytest.mark.parametrize("row, broken", [
    ((None, "A", 2), {("not_null", "id")}),
    (("a", "A", 2), {("unique", "id")}),
    (("long", "A", 2), {("max_length", "id")}),
    (("e", "C", 2), {("accepted_values", "kind")}),
    (("e", "A", 0), {("minimum", "n")}),
    (("e", "A", 10), {("maximum", "n")}),
    (("e", "A", 3), {("business_rule", "n_even")}),
])
def test_each_rule_fails_on_a_row_made_to_break_it(spark, row, broken):
    at = datetime(2024, 1, 2)
    found, by = results(spark, [("a", "A", 2, at), ("b", "B", 4, at), ("c", "A", 8, at), (*row, at)])
    violated = {key for key, r in by.items() if r.violated}
    # a null key is also one row that no distinct value accounts for
    assert violated - {("unique", "id")} == broken - {("unique", "id")} and broken <= violated
    assert c.gate(found).first().passed == (broken == {("business_rule", "n_even")})


def test_age_and_volume_limits(spark):
    _, by = results(spark, [("a", "A", 2, datetime(2024, 1, 1, 22)), ("b", None, 2, None)])
    assert by[("freshness_seconds", "at")].violated and by[("row_count", "*")].violated and by[("completeness", "kind")].violated
