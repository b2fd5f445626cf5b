"""Data-quality metrics, expectations, column tests and the release gate.

Metrics of one table come from one aggregate, opened into long rows afterwards.
Distinct counts are kept apart, since an aggregate with a distinct argument
shuffles its other measures once per distinct value.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import literal, ratio, text, to_rows
from keelmark.functions.temporal import hours_crossed, moment, seconds_elapsed
from keelmark.operators.rules import RULES


METRIC = ("metric_name", "column_name", "value")


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -------------------------------------------------------------------- metrics
def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    measured = df.agg(*[F.expr(f"count_if({c} IS NULL) AS {c}") for c in columns])
    return to_rows(measured, [("'NULL_COUNT'", text(c), c) for c in columns], METRIC)


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond one per key value (the key's own combine makes heavy duplicates cheap)."""
    return df.agg((F.count("*") - F.count_distinct(key)).alias("value")).select(
        F.lit("DUPLICATE_COUNT").alias("metric_name"), F.lit(key).alias("column_name"), "value")


def unique_counts(df: DataFrame, columns: Sequence[str] = S.CARDINALITY_COLUMNS) -> DataFrame:
    measured = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return to_rows(measured, [("'UNIQUE_COUNT'", text(c), c) for c in columns], METRIC)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("value")).select(
        F.lit("ROW_COUNT").alias("metric_name"), F.lit("*").alias("column_name"), "value")


def freshness(df: DataFrame, column: str, at: Sequence[datetime]) -> DataFrame:
    """Age of the newest record at each check time."""
    newest = df.agg(F.max(column).alias("newest"))
    aged = newest.select(*[seconds_elapsed(F.col("newest"), moment(t)).alias(f"m{i}") for i, t in enumerate(at)])
    return to_rows(aged, [("'FRESHNESS'", text(column), f"m{i}") for i in range(len(at))], METRIC)


def measure(df: DataFrame, key: str, required: Sequence[str], stamp: str, at: datetime) -> DataFrame:
    """The standing metrics of a product: nulls, rows and age in one pass, duplicates in another."""
    nulls = [("NULL_COUNT", c, F.expr(f"count_if({c} IS NULL)")) for c in required]
    listed = [*nulls, ("ROW_COUNT", "*", F.count("*")), ("FRESHNESS", stamp, seconds_elapsed(F.max(stamp), moment(at)))]
    wide = df.agg(*[column.alias(f"m{i}") for i, (_, _, column) in enumerate(listed)])
    rows = [(text(metric), text(name), f"m{i}") for i, (metric, name, _) in enumerate(listed)]
    return to_rows(wide, rows, METRIC).unionByName(duplicate_count(df, key))


# --------------------------------------------------------------- expectations
@dataclass(frozen=True)
class Expectation:
    name: str
    metric: str
    column: str | None
    operator: str  # one of "=", "<=", ">="
    limit: int


def product_expectations(minimum_rows: int = S.EXPECTED_MINIMUM_ROWS) -> list[Expectation]:
    required = ("customer_id", "churn_risk_score", "risk_tier", "customer_segment", "recommended_intervention")
    return [
        *[Expectation(f"no_null_{c}", "NULL_COUNT", c, "=", 0) for c in required],
        Expectation("no_duplicate_customer_id", "DUPLICATE_COUNT", "customer_id", "=", 0),
        Expectation("freshness_sla", "FRESHNESS", "score_calculated_at", "<=", S.FRESHNESS_WARN_HOURS * 3600),
        Expectation("min_row_count", "ROW_COUNT", "*", ">=", minimum_rows),
    ]


def expectation_table(metrics: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """The rules as rows. They come from a contract, so their number is known and small."""
    entries = [
        F.struct(
            F.lit(e.name).alias("expectation_name"), F.lit(e.metric).alias("rule_metric"),
            F.lit(e.column).cast("string").alias("rule_column"), F.lit(e.operator).alias("operator"),
            F.lit(e.limit).cast("bigint").alias("limit_value"))
        for e in expectations
    ]
    return metrics.sparkSession.range(1).select(F.inline(F.array(*entries)))


def meets(value: Column, operator: Column, limit: Column) -> Column:
    return F.when(operator == "=", value == limit).when(operator == "<=", value <= limit).when(operator == ">=", value >= limit)


def evaluate(metrics: DataFrame, expectations: Sequence[Expectation], column: str = "column_name") -> DataFrame:
    """Join metrics to the rules that name them and mark violations.

    The rule table is literal rows, so its broadcast does not grow with the data.
    A rule without a column applies to the metric on any column.
    """
    rules = F.broadcast(expectation_table(metrics, expectations))
    applies = (F.col("metric_name") == F.col("rule_metric")) & (F.col("rule_column").isNull() | (F.col(column) == F.col("rule_column")))
    joined = metrics.join(rules, applies)
    violated = ~meets(F.col("value"), F.col("operator"), F.col("limit_value"))
    return joined.withColumn("expectation_violated", violated).drop("rule_metric", "rule_column")


# --------------------------------------------------------------- column tests
# ---------------------------------------------------------------- fixed values
SOURCE_TESTS = {
    "customers": {"customer_id": ("unique", "not_null")},
    "accounts": {"account_id": ("unique", "not_null")},
    "transactions": {"txn_id": ("unique", "not_null")},
    "digital_engagement": {"customer_id": ("not_null",)},
    "complaints": {"complaint_id": ("unique", "not_null")},
}
PRODUCT_TESTS = {
    "customer_id": ("unique", "not_null"),
    "customer_name": ("not_null",),
    "customer_segment": ("not_null", S.SEGMENTS),
    "relationship_tenure_months": ("not_null",),
    "transaction_trend": (S.TRENDS,),
    "balance_trend": (S.TRENDS,),
    "churn_risk_score": ("not_null",),
    "risk_tier": ("not_null", S.TIERS),
    "primary_risk_driver": ("not_null", S.DRIVERS),
    "recommended_intervention": ("not_null", S.INTERVENTIONS),
    "score_calculated_at": ("not_null",),
    "data_as_of_date": ("not_null",),
    "model_version": ("not_null",),
}
# ------------------------------------------------------------ end fixed values


def column_tests(df: DataFrame, table: str, tests: Mapping[str, Sequence]) -> DataFrame:
    """``unique``, ``not_null`` or a tuple of accepted values per column; failing rows per test.

    As tests on values, uniqueness counts the values that occur more than once.
    """
    plain = [(c, t) for c, listed in tests.items() for t in listed if t != "unique"]
    measures, rows = [], []
    for i, (name, test) in enumerate(plain):
        broken = f"{name} IS NULL" if test == "not_null" else f"{name} NOT IN ({', '.join(map(literal, test))})"
        measures.append(F.expr(f"count_if({broken}) AS m{i}"))
        rows.append((text(table), text(name), "'not_null'" if test == "not_null" else "'accepted_values'", f"m{i}"))
    names = ("table_name", "column_name", "test", "failures")
    frames = [to_rows(df.agg(*measures), rows, names)]
    for name, listed in tests.items():
        if "unique" in listed:
            repeated = df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
            counted = repeated.agg(F.count_if(F.col("n") > 1).alias("failures"))
            frames.append(counted.select(F.lit(table).alias("table_name"), F.lit(name).alias("column_name"),
                                         F.lit("unique").alias("test"), "failures"))
    return union(frames)


# ------------------------------------------------------------ integrity, limits
def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str, eligible: Column | None = None) -> DataFrame:
    """Child rows without a parent, and child rows whose parent is not ``eligible``.

    Children are counted per key before the join, so a foreign key that owns much of
    the table is one record there.
    """
    per_key = child.filter(F.col(foreign_key).isNotNull()).groupBy(F.col(foreign_key).alias("_child")).agg(F.count("*").alias("n"))
    parents = parent.groupBy(F.col(key).alias("_parent")).agg(
        F.bool_or(F.lit(True) if eligible is None else eligible).alias("_eligible"))
    joined = per_key.join(parents, F.col("_child") == F.col("_parent"), "left")
    missing = F.col("_parent").isNull()
    excluded = ~missing & ~F.coalesce("_eligible", F.lit(False))
    rows_where = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    return joined.agg(
        rows_where(missing).alias("orphan_rows"), F.count_if(missing).alias("orphan_keys"), rows_where(excluded).alias("ineligible_rows"))


def too_few_rows(df: DataFrame, *minimums: int) -> DataFrame:
    """One row per minimum the table falls short of."""
    counted = df.agg(F.count("*").alias("row_count"))
    required = counted.select(F.explode(F.array(*map(F.lit, minimums))).alias("required"), "row_count")
    label = F.format_string("FAIL: row count below minimum (%d)", F.col("required"))
    return required.filter(F.col("row_count") < F.col("required")).select("required", label.alias("violation"), "row_count")


def stale(df: DataFrame, column: str, at: Sequence[datetime], hours: int = S.FRESHNESS_WARN_HOURS) -> DataFrame:
    """One row per check time at which the newest record is older than ``hours``."""
    newest = df.agg(F.max(column).alias("latest_refresh"))
    timed = newest.withColumn("check_time", F.explode(F.array(*map(moment, at))))
    aged = timed.withColumn("hours_since_refresh", hours_crossed(F.col("latest_refresh"), F.col("check_time")))
    return aged.filter(F.col("hours_since_refresh") > hours)


def high_risk_share(df: DataFrame, limit_percent: int = S.HIGH_RISK_LIMIT_PERCENT) -> DataFrame:
    high = F.count_if(F.col("risk_tier").isin("HIGH", "CRITICAL"))
    shares = df.agg(high.alias("high_risk_rows"), F.count("*").alias("row_count"), ratio(high, F.count("*"), 2, 100).alias("high_risk_percent"))
    return shares.withColumn("violated", F.col("high_risk_percent") >= limit_percent)


# ----------------------------------------------------------- release validation
def validation_suite(df: DataFrame, by: Sequence[str] = (), minimum_rows: int = S.VALIDATION_MINIMUM_ROWS) -> DataFrame:
    """The post-release checks as PASS/FAIL rows."""
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in S.REQUIRED_FIELDS])
    listed = [
        ("TEST 1: Row Count", F.count("*"), f">= {minimum_rows}"),
        ("TEST 2: Required Fields Not Null", F.count_if(missing), "= 0"),
        ("TEST 4: Churn Score Range", F.count_if(RULES["DQ001"].broken()), "= 0"),
        ("TEST 5: Risk Tier Alignment", F.count_if(RULES["BR001"].broken()), "= 0"),
        ("TEST 6: High Risk Has Driver", F.count_if(RULES["BR002"].broken()), "= 0"),
        ("TEST 7: Urgent Escalation Check", F.count_if(RULES["BR003"].broken()), "= 0"),
        ("TEST 8: Valid Risk Tiers", F.count_if(~F.col("risk_tier").isin(*S.TIERS)), "= 0"),
    ]
    verdict = lambda measure, passes: f"if({measure} {passes}, 'PASS', 'FAIL')"
    names = ("test_name", "result", "measured")
    wide = df.groupBy(*by).agg(*[m.alias(f"m{i}") for i, (_, m, _) in enumerate(listed)])
    rows = [
        (text(name), verdict(f"m{i}", passes), f"m{i}")
        for i, (name, _, passes) in enumerate(listed)
    ]
    repeated = df.groupBy(*by).agg((F.count("*") - F.count_distinct("customer_id")).alias("d"))
    unique = to_rows(repeated, [("'TEST 3: Customer ID Unique'", verdict("d", "= 0"), "d")], names, by)
    return to_rows(wide, rows, names, by).unionByName(unique)


def validation_summary(df: DataFrame) -> DataFrame:
    tier = lambda name: F.count_if(F.col("risk_tier") == name).alias(f"{name.lower()}_count")
    return df.agg(
        F.count("*").alias("total_rows"), *[tier(t) for t in S.TIERS],
        ratio(F.sum("churn_risk_score"), F.count("churn_risk_score"), 2).alias("avg_risk_score"),
        F.max("score_calculated_at").alias("last_refresh"))
