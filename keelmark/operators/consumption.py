"""What consumers ask of the product: worklists, distributions and the metric layer."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import ratio

C = F.col


def critical_customers(product: DataFrame, limit: int = 50) -> DataFrame:
    return (
        product.filter(C("risk_tier") == "CRITICAL")
        .select("customer_id", "customer_name", "customer_segment", "churn_risk_score", "risk_tier",
                "primary_risk_driver", "recommended_intervention")
        .orderBy(F.desc("churn_risk_score"), "customer_id").limit(limit))


def tier_distribution(product: DataFrame) -> DataFrame:
    order = F.lit(len(S.TIERS))
    for rank, tier in enumerate(("CRITICAL", "HIGH", "MEDIUM"), start=1):
        order = F.when(C("risk_tier") == tier, rank).otherwise(order)
    return product.groupBy("risk_tier").agg(
        F.count("*").alias("customer_count"),
        ratio(F.sum("churn_risk_score"), F.count("churn_risk_score"), 1).alias("avg_risk_score"),
        F.round(F.sum("total_relationship_balance"), 0).cast("decimal(25,0)").alias("total_balance_at_risk"),
        ratio(F.sum("relationship_tenure_months"), F.count("relationship_tenure_months"), 1).alias("avg_tenure_months"),
    ).withColumn("tier_order", order)


def driver_analysis(product: DataFrame) -> DataFrame:
    return product.filter(C("primary_risk_driver") != "NONE").groupBy("primary_risk_driver").agg(
        F.count("*").alias("customer_count"),
        ratio(F.sum("churn_risk_score"), F.count("churn_risk_score"), 1).alias("avg_risk_score"),
        F.count_if(C("risk_tier").isin("HIGH", "CRITICAL")).alias("high_risk_count"))


def intervention_queue(product: DataFrame) -> DataFrame:
    """Everyone to be contacted, most urgent first, with the driver detail parsed."""
    detail = F.parse_json("risk_drivers_json")
    return (
        product.filter(C("recommended_intervention") != "NO_ACTION")
        .select("customer_id", "customer_name", "region", "churn_risk_score", "recommended_intervention",
                "primary_risk_driver", "intervention_priority",
                F.variant_get(detail, "$.declining_balance.balance", "decimal(15,2)").alias("detail_balance"),
                F.variant_get(detail, "$.reduced_activity.trend", "string").alias("detail_trend"),
                F.variant_get(detail, "$.dormancy.days_inactive", "int").alias("detail_days_inactive"))
        .orderBy("intervention_priority", F.desc("churn_risk_score"), "customer_id"))


def top_lifetime_value(product_v2: DataFrame, limit: int = 10) -> DataFrame:
    return (
        product_v2.filter(C("risk_tier").isin("CRITICAL", "HIGH"))
        .select("customer_id", "customer_name", "churn_risk_score", "risk_tier", *S.V2_ADDED)
        .orderBy(F.desc("estimated_clv"), "customer_id").limit(limit))


def customer_count() -> Column:
    return F.count("customer_id")


def metric_query(
    product: DataFrame, dimensions: Sequence[str], metrics: Mapping[str, Column] | None = None, where: Column | None = None,
) -> DataFrame:
    """Aggregate declared metrics over declared dimensions.

    ``metrics`` defaults to the customer count; callers may pass further aggregates.
    """
    unknown = [d for d in dimensions if d not in S.DIMENSIONS]
    if unknown:
        raise ValueError(f"not a dimension: {', '.join(unknown)}")
    chosen = metrics or {"customer_count": customer_count()}
    filtered = product if where is None else product.filter(where)
    return filtered.groupBy(*dimensions).agg(*[m.alias(n) for n, m in chosen.items()])
