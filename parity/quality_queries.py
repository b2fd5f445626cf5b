"""Contract rules, metrics, expectations and validation.

A sound product breaks no rule, so rule queries run over two copies of it: the
published one, and an audit copy with known defects planted by region.
"""

from datetime import datetime

from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.operators import quality, rules
from keelmark.plans import contract as contracts
from keelmark.sources import banking
from keelmark.sources.tables import stored
from parity.product_queries import v1, v1_earlier, v2
from parity.registry import query, view

CHECKS = (datetime(2001, 9, 1, 12, 0, 0), datetime(2001, 9, 3, 12, 0, 0))
C = F.col


def with_audit_copy(product):
    """Both copies in one pass. Defects: tiers (AFRICA), flags (AMERICA), interventions (ASIA),
    priorities (EUROPE); scores, names and repeated rows (MIDDLE EAST)."""
    defect = C("target") == "audit"
    at = lambda region: defect & (C("region") == region)
    copies = F.when(C("region") == "MIDDLE EAST", F.array(F.lit("published"), F.lit("audit"), F.lit("audit"))).otherwise(
        F.array(F.lit("published"), F.lit("audit")))
    copied = product.withColumn("target", F.explode(copies))
    changes = {
        "risk_tier": F.when(at("AFRICA"), F.when(C("risk_tier") == "LOW", "UNKNOWN").otherwise("LOW")).otherwise(C("risk_tier")),
        "recommended_intervention": F.when(at("ASIA"), "URGENT_ESCALATION").otherwise(C("recommended_intervention")),
        "intervention_priority": F.when(at("EUROPE"), 5 - C("intervention_priority")).otherwise(C("intervention_priority")),
        "churn_risk_score": C("churn_risk_score") + F.when(at("MIDDLE EAST"), 90).otherwise(0),
        "digital_engagement_score": C("digital_engagement_score") - F.when(at("MIDDLE EAST"), 60).otherwise(0),
        "customer_name": F.when(at("MIDDLE EAST"), None).otherwise(C("customer_name")),
        **{flag: C(flag) & ~at("AMERICA") for flag in S.FLAGS},
    }
    if "clv_tier" in product.columns:
        changes["clv_tier"] = F.when(at("AFRICA"), "MEDIUM_VALUE").otherwise(C("clv_tier"))
        changes["product_downgrade_flag"] = C("product_downgrade_flag") != at("EUROPE")
        changes["action_confidence_score"] = C("action_confidence_score") + F.when(at("ASIA"), 60).otherwise(0)
    return copied.withColumns(changes)


def _audit_sql(source: str, extra: str = "") -> str:
    hit = lambda region: f"(target = 'audit' AND region = '{region}')"
    flags = ", ".join(f"{f} AND NOT {hit('AMERICA')} AS {f}" for f in S.FLAGS)
    return f"""
SELECT * REPLACE (
  if({hit('AFRICA')}, if(risk_tier = 'LOW', 'UNKNOWN', 'LOW'), risk_tier) AS risk_tier,
  if({hit('ASIA')}, 'URGENT_ESCALATION', recommended_intervention) AS recommended_intervention,
  if({hit('EUROPE')}, 5 - intervention_priority, intervention_priority) AS intervention_priority,
  if({hit('MIDDLE EAST')}, churn_risk_score + 90, churn_risk_score) AS churn_risk_score,
  if({hit('MIDDLE EAST')}, digital_engagement_score - 60, digital_engagement_score) AS digital_engagement_score,
  if({hit('MIDDLE EAST')}, NULL, customer_name) AS customer_name, {flags} {extra})
FROM (SELECT *, 'published' AS target FROM {source} UNION ALL SELECT *, 'audit' FROM {source}
      UNION ALL SELECT *, 'audit' FROM {source} WHERE region = 'MIDDLE EAST')
"""


view("audited_v1", _audit_sql("v1"), "v1")
view("audited_v2", _audit_sql("v2", """,
  if(target = 'audit' AND region = 'AFRICA', 'MEDIUM_VALUE', clv_tier) AS clv_tier,
  if(target = 'audit' AND region = 'EUROPE', NOT product_downgrade_flag, product_downgrade_flag) AS product_downgrade_flag,
  if(target = 'audit' AND region = 'ASIA', action_confidence_score + 60, action_confidence_score) AS action_confidence_score
"""), "v2")


def audited_v1(spark, folder):
    return with_audit_copy(v1(spark, folder))


def audited_v2(spark, folder):
    return with_audit_copy(v2(spark, folder))


# ---------------------------------------------------------------------- rules
_TIER_OK = ("CASE risk_tier WHEN 'LOW' THEN churn_risk_score BETWEEN 0 AND 25 WHEN 'MEDIUM' THEN churn_risk_score BETWEEN 26 AND 50 "
            "WHEN 'HIGH' THEN churn_risk_score BETWEEN 51 AND 75 WHEN 'CRITICAL' THEN churn_risk_score BETWEEN 76 AND 100 ELSE FALSE END")
_PRIORITY_OK = ("CASE intervention_priority WHEN 1 THEN churn_risk_score > 75 WHEN 2 THEN churn_risk_score BETWEEN 51 AND 75 "
                "WHEN 3 THEN churn_risk_score BETWEEN 26 AND 50 WHEN 4 THEN churn_risk_score <= 25 ELSE FALSE END")
_CLV_OK = ("clv_tier = CASE WHEN estimated_clv >= 100000 THEN 'HIGH_VALUE' WHEN estimated_clv >= 25000 THEN 'MEDIUM_VALUE' "
           "ELSE 'STANDARD' END")
BROKEN_SQL = {
    "BR001": f"NOT ({_TIER_OK})",
    "BR002": f"risk_tier IN ('HIGH', 'CRITICAL') AND NOT ({' OR '.join(S.FLAGS)})",
    "BR003": "recommended_intervention = 'URGENT_ESCALATION' AND risk_tier <> 'CRITICAL'",
    "BR004": f"NOT ({_PRIORITY_OK})",
    "DQ001": "churn_risk_score NOT BETWEEN 0 AND 100",
    "DQ002": "digital_engagement_score NOT BETWEEN 0 AND 100",
    "CLV_TIER": f"NOT ({_CLV_OK})",
    "DOWNGRADE": "product_downgrade_flag <> (total_products_held < products_held_90d_ago)",
    "CONFIDENCE": "action_confidence_score NOT BETWEEN 0 AND 100",
}
_RULE_KEYS = {
    "br001": ("BR001", audited_v1), "br002": ("BR002", audited_v1), "br003": ("BR003", audited_v1), "br004": ("BR004", audited_v1),
    "dq001": ("DQ001", audited_v1), "dq002": ("DQ002", audited_v1),
    "br_clv_alignment": ("CLV_TIER", audited_v2), "br_downgrade_consistency": ("DOWNGRADE", audited_v2),
    "confidence_range": ("CONFIDENCE", audited_v2),
}


def _register_rule(key, rule_id, source):
    rule = rules.RULES[rule_id]
    over_view = source.__name__
    sql = f"SELECT target, {', '.join(rule.shows)}, '{rule.label}' AS violation FROM {over_view} WHERE {BROKEN_SQL[rule_id]}"
    query(key, sql, over_view)(lambda spark, folder: rules.violations(source(spark, folder), rule_id, ("target",)))


for _key, (_rule, _source) in _RULE_KEYS.items():
    _register_rule(_key, _rule, _source)


# -------------------------------------------------------------------- metrics
def _sources(spark, folder):
    return {
        "customers": banking.customers(spark, folder), "accounts": banking.accounts(spark, folder),
        "transactions": banking.transactions(spark, folder), "digital_engagement": banking.digital_engagement(spark, folder),
        "complaints": banking.complaints(spark, folder),
    }


SOURCE_VIEWS = ("customers", "accounts", "transactions", "digital_engagement", "complaints")
_NULLABLE = {"accounts": ("account_id", "closed_date", "current_balance"), "complaints": ("complaint_id", "resolution_date", "status")}


@query("dq_null_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'NULL_COUNT' AS metric_name, '{c}' AS column_name, count(*) - count({c}) AS value FROM {t}"
    for t, columns in {**_NULLABLE, "v1": S.V1_COLUMNS}.items() for c in columns), "accounts", "complaints", "v1")
def dq_null_counts(spark, folder):
    frames = {**_sources(spark, folder), "v1": v1(spark, folder)}
    listed = {**_NULLABLE, "v1": S.V1_COLUMNS}
    return quality.union([
        quality.null_counts(frames[t], columns).select(F.lit(t).alias("table_name"), "*") for t, columns in listed.items()])


_KEYS = {"customers": "customer_id", "accounts": "account_id", "transactions": "txn_id", "digital_engagement": "engagement_id",
         "complaints": "complaint_id"}


@query("dq_duplicate_count", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'DUPLICATE_COUNT' AS metric_name, '{k}' AS column_name, count(*) - count(DISTINCT {k}) AS value FROM {t}"
    for t, k in _KEYS.items()), *SOURCE_VIEWS)
def dq_duplicate_count(spark, folder):
    frames = _sources(spark, folder)
    return quality.union([
        quality.duplicate_count(frames[t], k).select(F.lit(t).alias("table_name"), "*") for t, k in _KEYS.items()])


@query("dq_unique_counts", " UNION ALL ".join(
    f"SELECT 'UNIQUE_COUNT' AS metric_name, '{c}' AS column_name, count(DISTINCT {c}) AS value FROM v1" for c in S.CARDINALITY_COLUMNS), "v1")
def dq_unique_counts(spark, folder):
    """The key counted alone; dimensions by dictionary-coded bitmaps, which later days can merge with."""
    from keelmark.operators import cardinality
    from keelmark.session import run_dir

    frame = stored(v1(spark, folder), "unique-counts-product")
    key, dimensions = S.CARDINALITY_COLUMNS[0], list(S.CARDINALITY_COLUMNS[1:])
    dictionary = cardinality.extend_dictionary(frame, dimensions, f"{run_dir(spark, 'cardinality')}/dictionary")
    keyed = frame.agg(F.count_distinct(key).alias("value")).select(
        F.lit("UNIQUE_COUNT").alias("metric_name"), F.lit(key).alias("column_name"), "value")
    return keyed.unionByName(cardinality.merged_counts(cardinality.day_bitmaps(frame, "today", dimensions, dictionary)))


@query("dq_unique_counts_merged", " UNION ALL ".join(
    f"SELECT 'UNIQUE_COUNT' AS metric_name, '{c}' AS column_name, count(DISTINCT {c}) AS value FROM (SELECT * FROM v1 UNION ALL SELECT * FROM v1_earlier)"
    for c in S.CARDINALITY_COLUMNS), "v1", "v1_earlier")
def dq_unique_counts_merged(spark, folder):
    """Distinct counts over two days, from bitmaps stored per day and merged: no day is read twice."""
    from keelmark.operators import cardinality
    from keelmark.session import run_dir

    home = run_dir(spark, "cardinality")
    key, dimensions = S.CARDINALITY_COLUMNS[0], list(S.CARDINALITY_COLUMNS[1:])
    for label, frame in (("earlier", v1_earlier(spark, folder)), ("current", v1(spark, folder))):
        dictionary = cardinality.extend_dictionary(frame, dimensions, f"{home}/dictionary")
        cardinality.day_bitmaps(frame, label, dimensions, dictionary, key).write.mode("append").partitionBy("day").parquet(f"{home}/bitmaps")
    return cardinality.merged_counts(spark.read.parquet(f"{home}/bitmaps"))


@query("dq_row_count", "SELECT 'ROW_COUNT' AS metric_name, '*' AS column_name, count(*) AS value FROM v1", "v1")
def dq_row_count(spark, folder):
    return quality.row_count(v1(spark, folder))


@query("dq_freshness", " UNION ALL ".join(
    f"SELECT 'FRESHNESS' AS metric_name, 'score_calculated_at' AS column_name, "
    f"(epoch_us(TIMESTAMP '{t}') - epoch_us(max(score_calculated_at))) // 1000000 AS value FROM v1" for t in CHECKS), "v1")
def dq_freshness(spark, folder):
    return quality.freshness(v1(spark, folder), "score_calculated_at", CHECKS)


_EXPECTED = quality.product_expectations(minimum_rows=S.MINIMUM_ROWS)
_METRIC_SQL = {
    "NULL_COUNT": "count(*) - count({c})", "DUPLICATE_COUNT": "count(*) - count(DISTINCT {c})", "ROW_COUNT": "count(*)",
    "FRESHNESS": f"(epoch_us(TIMESTAMP '{CHECKS[1]}') - epoch_us(max({{c}}))) // 1000000",
}


def _expectation_sql() -> str:
    parts = []
    for e in _EXPECTED:
        value = _METRIC_SQL[e.metric].format(c=e.column)
        parts.append(
            f"SELECT '{e.metric}' AS metric_name, '{e.column}' AS column_name, {value} AS value, '{e.name}' AS expectation_name, "
            f"'{e.operator}' AS operator, CAST({e.limit} AS BIGINT) AS limit_value, NOT ({value} {e.operator} {e.limit}) AS expectation_violated FROM v1")
    return " UNION ALL ".join(parts)


@query("dq_expectations", _expectation_sql(), "v1")
def dq_expectations(spark, folder):
    required = [e.column for e in _EXPECTED if e.metric == "NULL_COUNT"]
    metrics = quality.measure(stored(v1(spark, folder), "v1"), "customer_id", required, "score_calculated_at", CHECKS[1])
    return quality.evaluate(metrics, _EXPECTED)


_C1, _C2 = contracts.bundled(S.V1), contracts.bundled(S.V2)
_CONTRACT_METRICS = (
    [("NULL_COUNT", c) for c in S.V1_COLUMNS] + [("DUPLICATE_COUNT", "customer_id"), ("ROW_COUNT", "*"), ("FRESHNESS", "score_calculated_at")])
_TRACKED = ("customer_segment", "region", "transaction_trend", "balance_trend", "risk_tier", "primary_risk_driver", "recommended_intervention")


@query("contract_metrics", " UNION ALL ".join(
    [f"SELECT '{m}' AS metric_name, '{c}' AS column_name, {_METRIC_SQL[m].format(c=c)} AS value FROM v1" for m, c in _CONTRACT_METRICS]
    + [f"SELECT 'UNIQUE_COUNT', '{c}', count(DISTINCT {c}) FROM v1" for c in _TRACKED]), "v1")
def contract_metrics(spark, folder):
    return contracts.metrics(stored(v1(spark, folder), "v1"), _C1, CHECKS[1])


@query("contract_expectations", f"""
SELECT * FROM (
  {" UNION ALL ".join(f"SELECT 'no_null_{c}' AS expectation_name, count(*) - count({c}) AS value, count({c}) < count(*) AS expectation_violated FROM v1" for c in S.V1_COLUMNS)}
  UNION ALL SELECT 'no_duplicate_customer_id', count(*) - count(DISTINCT customer_id), count(*) > count(DISTINCT customer_id) FROM v1
  UNION ALL SELECT 'min_row_count', count(*), count(*) < 50000 FROM v1
  UNION ALL SELECT 'freshness_sla', {_METRIC_SQL["FRESHNESS"].format(c="score_calculated_at")}, {_METRIC_SQL["FRESHNESS"].format(c="score_calculated_at")} > 90000 FROM v1)
""", "v1")
def contract_expectations(spark, folder):
    metrics = contracts.metrics(stored(v1(spark, folder), "v1"), _C1, CHECKS[1])
    return quality.evaluate(metrics, contracts.expectations(_C1)).select("expectation_name", "value", "expectation_violated")


def _test_sql(table: str, tests: dict) -> list[str]:
    parts = []
    for c, listed in tests.items():
        for test in listed:
            if test == "unique":
                failures = f"(SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
                parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'unique' AS test, {failures} AS failures")
            else:
                broken = f"{c} IS NULL" if test == "not_null" else f"{c} NOT IN {test}"
                kind = test if test == "not_null" else "accepted_values"
                parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{kind}' AS test, count(*) FILTER ({broken}) AS failures FROM {table}")
    return parts


view("audit_copy", "SELECT * FROM audited_v1 WHERE target = 'audit'", "audited_v1")


@query("column_tests", " UNION ALL ".join(
    [p for t, tests in quality.SOURCE_TESTS.items() for p in _test_sql(t, tests)]
    + _test_sql("v1", quality.PRODUCT_TESTS) + _test_sql("audit_copy", quality.PRODUCT_TESTS)), *SOURCE_VIEWS, "v1", "audit_copy")
def column_tests(spark, folder):
    frames = _sources(spark, folder)
    audited = stored(audited_v1(spark, folder), "audited")
    return quality.union([
        *[quality.column_tests(frames[t], t, tests) for t, tests in quality.SOURCE_TESTS.items()],
        quality.column_tests(audited.filter("target = 'published'"), "v1", quality.PRODUCT_TESTS),
        quality.column_tests(audited.filter("target = 'audit'"), "audit_copy", quality.PRODUCT_TESTS)])


# ------------------------------------------------------------- minima, freshness
@query("dq003_min_rows", """
SELECT 900 AS required, 'FAIL: row count below minimum (900)' AS violation, count(*) AS row_count FROM v1 HAVING count(*) < 900
UNION ALL SELECT 1000000000, 'FAIL: row count below minimum (1000000000)', count(*) FROM v1 HAVING count(*) < 1000000000
""", "v1")
def dq003_min_rows(spark, folder):
    return quality.too_few_rows(v1(spark, folder), S.MINIMUM_ROWS, 1_000_000_000)


@query("freshness_sla", " UNION ALL ".join(
    f"SELECT max(score_calculated_at) AS latest_refresh, TIMESTAMP '{t}' AS check_time, "
    f"date_diff('hour', max(score_calculated_at), TIMESTAMP '{t}') AS hours_since_refresh FROM v1 "
    f"HAVING date_diff('hour', max(score_calculated_at), TIMESTAMP '{t}') > 24" for t in CHECKS), "v1")
def freshness_sla(spark, folder):
    return quality.stale(v1(spark, folder), "score_calculated_at", CHECKS)


def share_sql(part: str, whole: str, digits: int, factor: int = 1) -> str:
    """Exact half-up ratio of non-negative integers."""
    scale = 10 ** digits
    unit = "1" if digits == 0 else f"0.{'0' * (digits - 1)}1"
    return f"CAST(CAST((2 * {scale * factor} * ({part}) + ({whole})) // (2 * ({whole})) AS DECIMAL(15,0)) * {unit} AS DECIMAL(18,{digits}))"


_HIGH = "count(*) FILTER (risk_tier IN ('HIGH', 'CRITICAL'))"


@query("high_risk_pct", f"SELECT {_HIGH} AS high_risk_rows, count(*) AS row_count, {share_sql(_HIGH, 'count(*)', 2, 100)} AS high_risk_percent, "
       f"{share_sql(_HIGH, 'count(*)', 2, 100)} >= 25 AS violated FROM v1", "v1")
def high_risk_pct(spark, folder):
    return quality.high_risk_share(v1(spark, folder))


_FOREIGN_KEYS = (
    ("accounts", "customer_id", "customers", "customer_id"), ("transactions", "account_id", "accounts", "account_id"),
    ("digital_engagement", "customer_id", "customers", "customer_id"), ("complaints", "customer_id", "customers", "customer_id"),
    ("v1", "customer_id", "customers", "customer_id"))
_ELIGIBLE = {"customers": "kyc_status = 'VERIFIED'", "accounts": "account_status = 'ACTIVE'"}


@query("referential_integrity", " UNION ALL ".join(
    f"SELECT '{child}.{fk}' AS foreign_key, '{parent}' AS parent, "
    f"count(*) FILTER ({fk} NOT IN (SELECT {key} FROM {parent})) AS orphan_rows, "
    f"count(DISTINCT {fk}) FILTER ({fk} NOT IN (SELECT {key} FROM {parent})) AS orphan_keys, "
    f"count(*) FILTER ({fk} IN (SELECT {key} FROM {parent} WHERE NOT ({_ELIGIBLE[parent]}))) AS ineligible_rows FROM {child}"
    for child, fk, parent, key in _FOREIGN_KEYS), *SOURCE_VIEWS, "v1")
def referential_integrity(spark, folder):
    """Rows without a parent, and rows of unverified customers or closed accounts."""
    frames = {**_sources(spark, folder), "v1": v1(spark, folder)}
    return quality.union([
        quality.orphans(frames[child], fk, frames[parent], key, F.expr(_ELIGIBLE[parent]))
        .select(F.lit(f"{child}.{fk}").alias("foreign_key"), F.lit(parent).alias("parent"), "*")
        for child, fk, parent, key in _FOREIGN_KEYS])


# ------------------------------------------------------------- contract checks
#: Business rules of the second contract, as it declares them; open at both ends.
_V2_BROKEN = {
    "risk_tier_score_alignment": "CASE WHEN churn_risk_score <= 25 THEN risk_tier <> 'LOW' WHEN churn_risk_score <= 50 THEN risk_tier <> 'MEDIUM' "
                                 "WHEN churn_risk_score <= 75 THEN risk_tier <> 'HIGH' ELSE risk_tier <> 'CRITICAL' END",
    "clv_tier_alignment": "clv_tier <> CASE WHEN estimated_clv >= 100000 THEN 'HIGH_VALUE' WHEN estimated_clv >= 25000 THEN 'MEDIUM_VALUE' ELSE 'STANDARD' END",
    "product_downgrade_consistency": "product_downgrade_flag <> (total_products_held < products_held_90d_ago)",
}


def _check_sql(contract, at, minimum_rows, kinds=None) -> str:
    """The checks of a contract, spelled out from its fields for the SQL engine."""
    rows = []

    def add(rule, column, value, limit, comparison=">", severity="error"):
        if kinds is None or rule in kinds:
            measured, bound = f"CAST({value} AS DECIMAL(18,2))", f"CAST({limit} AS DECIMAL(18,2))"
            rows.append(f"{{'rule': '{rule}', 'column_name': '{column}', 'severity': '{severity}', 'value': {measured}, "
                        f"'limit_value': {bound}, 'violated': coalesce({measured} {comparison} {bound}, true)}}")

    counted = lambda broken: f"count(*) FILTER ({broken})"
    listed = lambda values: "(" + ", ".join(repr(v) for v in values) + ")"
    for name in contract.required:
        add("not_null", name, counted(f"{name} IS NULL"), 0)
    for f in contract.fields:
        if f.allowed:
            add("accepted_values", f.name, counted(f"{f.name} NOT IN {listed(f.allowed)}"), 0)
        if f.minimum is not None:
            add("minimum", f.name, counted(f"{f.name} < {f.minimum}"), 0)
        if f.maximum is not None:
            add("maximum", f.name, counted(f"{f.name} > {f.maximum}"), 0)
        if f.max_length:
            add("max_length", f.name, counted(f"length(CAST({f.name} AS VARCHAR)) > {f.max_length}"), 0)
        for text in f.checks:
            add("check", f.name, counted(f"NOT ({text})"), 0)
        if f.unique:
            add("unique", f.name, f"count(*) - count(DISTINCT {f.name})", 0)
    for name, percent in contract.completeness.items():
        add("completeness", name, share_sql(f"count({name})", "count(*)", 2, 100), percent, "<")
    for rule in contract.business_rules:
        add("business_rule", rule.get("rule_id") or rule["name"], counted(BROKEN_SQL[rule["rule_id"]] if "rule_id" in rule else _V2_BROKEN[rule["name"]]), 0, severity=rule.get("severity", "error"))
    stamp = contract.freshness_column
    add("freshness_seconds", stamp, f"(epoch_us(TIMESTAMP '{at}') - epoch_us(max({stamp}))) // 1000000", contract.fail_hours * 3600)
    add("row_count", "*", "count(*)", minimum_rows, "<")
    return "[" + ",\n".join(rows) + "]"


def _suite_sql(contract, source, at, minimum_rows, kinds=None) -> str:
    return f"SELECT target, unnest({_check_sql(contract, at, minimum_rows, kinds)}, recursive := true) FROM {source} GROUP BY target"


_BY = ("target",)


@query("contract_suite", _suite_sql(_C1, "audited_v1", CHECKS[0], S.MINIMUM_ROWS), "audited_v1")
def contract_suite(spark, folder):
    return contracts.suite(stored(audited_v1(spark, folder), "audited"), _C1, CHECKS[0], S.MINIMUM_ROWS, _BY)


@query("contract_suite_v2", _suite_sql(_C2, "audited_v2", CHECKS[1], S.MINIMUM_ROWS), "audited_v2")
def contract_suite_v2(spark, folder):
    return contracts.suite(stored(audited_v2(spark, folder), "audited"), _C2, CHECKS[1], S.MINIMUM_ROWS, _BY)


@query("constraint_violations", _suite_sql(
    _C1, "audited_v1", CHECKS[0], 0, ("accepted_values", "minimum", "maximum", "max_length", "check")), "audited_v1")
def constraint_violations(spark, folder):
    return contracts.evaluate(audited_v1(spark, folder), contracts.constraint_checks(_C1), _BY)


@query("completeness_pct", _suite_sql(_C1, "audited_v1", CHECKS[0], 0, ("completeness",)), "audited_v1")
def completeness_pct(spark, folder):
    return contracts.evaluate(audited_v1(spark, folder), contracts.completeness_checks(_C1), _BY)


@query("quality_gate", f"""
SELECT target, count(*) FILTER (violated AND severity = 'error') AS broken_errors,
       count(*) FILTER (violated AND severity = 'warning') AS broken_warnings,
       count(*) FILTER (violated AND severity = 'error') = 0 AS passed
FROM ({_suite_sql(_C1, "audited_v1", CHECKS[0], S.MINIMUM_ROWS)}) GROUP BY target
""", "audited_v1")
def quality_gate(spark, folder):
    return contracts.gate(contract_suite(spark, folder), _BY)


_REQUIRED_NULL = " OR ".join(f"{c} IS NULL" for c in S.REQUIRED_FIELDS)
_VALIDATION = {
    "TEST 1: Row Count": ("count(*)", ">= 1000"),
    "TEST 2: Required Fields Not Null": (f"count(*) FILTER ({_REQUIRED_NULL})", "= 0"),
    "TEST 3: Customer ID Unique": ("count(*) - count(DISTINCT customer_id)", "= 0"),
    "TEST 4: Churn Score Range": (f"count(*) FILTER ({BROKEN_SQL['DQ001']})", "= 0"),
    "TEST 5: Risk Tier Alignment": (f"count(*) FILTER ({BROKEN_SQL['BR001']})", "= 0"),
    "TEST 6: High Risk Has Driver": (f"count(*) FILTER ({BROKEN_SQL['BR002']})", "= 0"),
    "TEST 7: Urgent Escalation Check": (f"count(*) FILTER ({BROKEN_SQL['BR003']})", "= 0"),
    "TEST 8: Valid Risk Tiers": ("count(*) FILTER (risk_tier NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL'))", "= 0"),
}


@query("validation_suite", " UNION ALL ".join(
    f"SELECT target, '{name}' AS test_name, if({m} {ok}, 'PASS', 'FAIL') AS result, {m} AS measured FROM audited_v1 GROUP BY target"
    for name, (m, ok) in _VALIDATION.items()), "audited_v1")
def validation_suite(spark, folder):
    return quality.validation_suite(stored(audited_v1(spark, folder), "audited"), _BY)


@query("validation_summary", f"""
SELECT count(*) AS total_rows, count(*) FILTER (risk_tier = 'LOW') AS low_count, count(*) FILTER (risk_tier = 'MEDIUM') AS medium_count,
       count(*) FILTER (risk_tier = 'HIGH') AS high_count, count(*) FILTER (risk_tier = 'CRITICAL') AS critical_count,
       {share_sql('sum(churn_risk_score)', 'count(*)', 2)} AS avg_risk_score, max(score_calculated_at) AS last_refresh
FROM v1
""", "v1")
def validation_summary(spark, folder):
    return quality.validation_summary(v1(spark, folder))
