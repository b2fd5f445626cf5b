"""Flags, score, tier, driver and intervention, and the signals added in version 2."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import any_of, bounded, points, total
from keelmark.functions.series import as_of as as_of_join
from keelmark.functions.temporal import day

C = F.col


def reduced_activity(rule: str = "trend") -> Column:
    """``trend``: the trend is falling. ``ratio70``: recent count under 70 % of the prior one."""
    if rule == "trend":
        return C("transaction_trend").isin("DECLINING", "SEVERELY_DECLINING")
    if rule == "ratio70":
        return C("txn_count_recent_3m") * 10 < C("txn_count_prior_3m") * S.RATIO70_TENTHS
    raise ValueError(f"unknown reduced-activity rule {rule!r}")


def with_risk_flags(features: DataFrame, activity_rule: str = "trend") -> DataFrame:
    has_open = C("open_complaints_count") > 0
    return features.withColumns({
        "has_unresolved_complaint": has_open,
        "declining_balance_flag": (C("total_relationship_balance") < S.LOW_TOTAL_BALANCE)
        | (C("primary_account_balance") < S.LOW_PRIMARY_BALANCE),
        "reduced_activity_flag": reduced_activity(activity_rule),
        "low_engagement_flag": (C("login_count_30d") < S.LOW_LOGINS) & ~C("mobile_app_active"),
        "complaint_flag": has_open | (C("complaints_last_12m") >= S.REPEAT_COMPLAINTS),
        "dormancy_flag": C("days_since_last_transaction") > S.DORMANT_AFTER_DAYS,
    })


def raw_score() -> Column:
    raised = [points(C(flag), amount) for flag, amount in S.FLAG_POINTS.items()]
    segment = [points(C("customer_segment") == name, amount) for name, amount in S.SEGMENT_POINTS.items()]
    protective = [
        C("total_products_held") >= S.MULTI_PRODUCT_FROM,
        C("relationship_tenure_months") > S.LONG_TENURE_OVER,
        C("digital_engagement_score") > S.ENGAGED_OVER,
    ]
    return total([F.lit(S.BASE_SCORE), *raised, *segment, *(points(p, -S.PROTECTIVE_POINTS) for p in protective)])


def by_band(score: Column, position: int) -> Column:
    """The value at ``position`` of the first tier band whose upper limit holds the score."""
    *inner, top = S.TIER_BANDS
    result = F.lit(top[position])
    for band in reversed(inner):
        result = F.when(score <= band[2], F.lit(band[position])).otherwise(result)
    return result


def with_score(flagged: DataFrame) -> DataFrame:
    return flagged.withColumn("churn_risk_score", bounded(raw_score())).withColumns({
        "risk_tier": by_band(C("churn_risk_score"), 0),
        "intervention_priority": by_band(C("churn_risk_score"), 3),
    })


def above(tier: str) -> Column:
    """Score over the upper limit of a tier."""
    limit = next(band[2] for band in S.TIER_BANDS if band[0] == tier)
    return C("churn_risk_score") > limit


def with_driver(scored: DataFrame) -> DataFrame:
    ranked = [
        ("DORMANCY", C("dormancy_flag") & (C("days_since_last_transaction") > S.DORMANCY_DRIVER_DAYS)),
        ("BALANCE_DECLINE", C("declining_balance_flag") & (C("primary_account_balance") < S.LOW_PRIMARY_BALANCE)),
        ("ACTIVITY_REDUCTION", C("reduced_activity_flag")),
        ("COMPLAINTS", C("complaint_flag") & C("has_unresolved_complaint")),
        ("LOW_ENGAGEMENT", C("low_engagement_flag")),
        ("MULTI_FACTOR", above("MEDIUM")),
    ]
    first = F.coalesce(*[F.when(applies, F.lit(name)) for name, applies in ranked], F.lit("NONE"))
    return scored.withColumn("primary_risk_driver", first)


def with_driver_detail(scored: DataFrame) -> DataFrame:
    detail = {
        "declining_balance": {"flag": "declining_balance_flag", "balance": "total_relationship_balance"},
        "reduced_activity": {"flag": "reduced_activity_flag", "trend": "transaction_trend"},
        "low_engagement": {"flag": "low_engagement_flag", "score": "digital_engagement_score"},
        "complaints": {"flag": "complaint_flag", "open_count": "open_complaints_count", "total_12m": "complaints_last_12m"},
        "dormancy": {"flag": "dormancy_flag", "days_inactive": "days_since_last_transaction"},
    }
    nested = lambda entries: "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in entries.items()) + ")"
    record = nested({name: nested(fields) for name, fields in detail.items()})
    return scored.withColumn("risk_drivers_json", F.expr(f"to_json({record})"))


def with_intervention(scored: DataFrame) -> DataFrame:
    high = F.when(C("complaint_flag"), "RELATIONSHIP_CALL").otherwise("RETENTION_OFFER")
    medium = F.when(C("low_engagement_flag"), "DIGITAL_ENGAGEMENT").otherwise("BRANCH_MEETING")
    choice = (
        F.when(above("HIGH"), "URGENT_ESCALATION")
        .when(above("MEDIUM"), high)
        .when(above("LOW"), medium)
        .otherwise("NO_ACTION")
    )
    return scored.withColumn("recommended_intervention", choice)


# ------------------------------------------------------------------ version 2

def products_held(snapshots: DataFrame, as_of: date, days: int = S.HISTORY_DAYS) -> DataFrame:
    """The newest snapshot at least ``days`` old, per customer."""
    return (
        snapshots.filter(C("snapshot_date") <= F.date_sub(day(as_of), days))
        .groupBy("customer_id")
        .agg(F.max_by("product_count", "snapshot_date").alias("products_held_90d_ago"))
    )


def products_held_as_of(probes: DataFrame, spans: DataFrame, as_of: date, days: int = S.HISTORY_DAYS) -> DataFrame:
    """``probes`` with products_held_90d_ago: the count of the last holding span begun ``days`` before ``as_of``.

    That is the newest month-end snapshot at least ``days`` old, read from the spans of changes
    by an as-of join instead of from a calendar of month ends.
    """
    dated = probes.withColumn("_probe_at", F.date_sub(day(as_of), days))
    return as_of_join(dated, spans, "customer_id", "_probe_at", "span_start", "product_count", "products_held_90d_ago").drop("_probe_at")


def with_downgrade(product: DataFrame, held_before: DataFrame) -> DataFrame:
    known = product.join(held_before, "customer_id", "left").withColumn(
        "products_held_90d_ago", F.coalesce("products_held_90d_ago", "total_products_held"))
    return known.withColumn("product_downgrade_flag", C("total_products_held") < C("products_held_90d_ago"))


def lifetime_value() -> Column:
    """Balance × tenure factor × segment factor, in decimals: rounded once, at the end."""
    tenure = F.least(C("relationship_tenure_months"), F.lit(S.CLV_TENURE_CAP)) + S.CLV_TENURE_CAP
    tenths = F.lit(10)
    for segment, value in S.CLV_SEGMENT_TENTHS.items():
        tenths = F.when(C("customer_segment") == segment, F.lit(value)).otherwise(tenths)
    scaled = C("total_relationship_balance") * tenure.cast("decimal(4,0)") * tenths.cast("decimal(2,0)")
    return F.round(scaled / (10 * S.CLV_TENURE_CAP), 2).cast("decimal(15,2)")


def with_downgrade_as_of(product: DataFrame, spans: DataFrame, as_of: date) -> DataFrame:
    """The downgrade flag with the holdings of 90 days ago taken by an as-of join on the product rows themselves."""
    known = products_held_as_of(product, spans, as_of).withColumn(
        "products_held_90d_ago", F.coalesce("products_held_90d_ago", "total_products_held"))
    return known.withColumn("product_downgrade_flag", C("total_products_held") < C("products_held_90d_ago"))


def with_lifetime_value(product: DataFrame) -> DataFrame:
    value = C("estimated_clv")
    return product.withColumn("estimated_clv", lifetime_value()).withColumn(
        "clv_tier",
        F.when(value >= S.CLV_HIGH_FROM, "HIGH_VALUE").when(value >= S.CLV_MEDIUM_FROM, "MEDIUM_VALUE").otherwise("STANDARD"))


def with_confidence(product: DataFrame) -> DataFrame:
    score = C("churn_risk_score")
    return product.withColumn("action_confidence_score", bounded(total([
        F.lit(S.CONFIDENCE_BASE),
        points(score > 70, 20),
        points(C("dormancy_flag") & C("declining_balance_flag"), 15),
        points(C("complaint_flag") & C("low_engagement_flag"), 10),
        points(score.between(40, 60), -20),
        points(C("primary_risk_driver") == "MULTI_FACTOR", -15),
    ])))


def with_vulnerability(product: DataFrame) -> DataFrame:
    engagement = C("digital_engagement_score")
    stressed = (engagement < S.VULNERABLE_ENGAGEMENT) & C("complaint_flag") & C("declining_balance_flag")
    excluded = (C("relationship_tenure_months") > S.EXCLUDED_TENURE) & (engagement < S.EXCLUDED_ENGAGEMENT)
    return product.withColumn("vulnerability_indicator", any_of([stressed, excluded]))


def balance_trend_over(movements: DataFrame, accounts: DataFrame, as_of: date, days: int = S.HISTORY_DAYS) -> DataFrame:
    """Balance now and ``days`` ago from the running total of movements, and the trend between.

    Both totals come from one conditional aggregate per account, then per customer.
    """
    then = F.date_sub(day(as_of), days)
    per_account = (
        movements.filter(C("txn_date") <= day(as_of))
        .groupBy("account_id")
        .agg(F.sum("amount").alias("now"), F.sum(F.when(C("txn_date") <= then, C("amount"))).alias("before"))
    )
    zero = F.lit(0).cast("decimal(25,2)")
    per_customer = (
        accounts.select("account_id", "customer_id").join(per_account, "account_id", "left")
        .groupBy("customer_id")
        .agg(
            F.coalesce(F.sum("now"), zero).cast("decimal(25,2)").alias("balance_now"),
            F.coalesce(F.sum("before"), zero).cast("decimal(25,2)").alias("balance_before"),
        )
    )
    change = (C("balance_now") - C("balance_before")) * 100
    limit = F.abs("balance_before") * S.BALANCE_CHANGE_PERCENT
    return per_customer.withColumn(
        "balance_trend_90d", F.when(change > limit, "GROWING").when(change < -limit, "DECLINING").otherwise("STABLE"))
