"""Literal rows for operator tests."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

AS_OF = date(2024, 2, 29)

FEATURE_SCHEMA = """
customer_id bigint, customer_name string, customer_segment string, region string, relationship_tenure_months int,
total_products_held int, primary_account_balance decimal(15,2), total_relationship_balance decimal(15,2),
txn_count_recent_3m bigint, txn_count_prior_3m bigint, days_since_last_transaction int, mobile_app_active boolean,
login_count_30d int, digital_engagement_score int, open_complaints_count int, complaints_last_12m int,
transaction_trend string, balance_trend string
"""
# A customer without any risk or protection: score 20.
CALM = dict(
    customer_id=1, customer_name="Ada", customer_segment="AFFLUENT", region="ASIA", relationship_tenure_months=24,
    total_products_held=1, primary_account_balance=Decimal("5000.00"), total_relationship_balance=Decimal("9000.00"),
    txn_count_recent_3m=10, txn_count_prior_3m=10, days_since_last_transaction=5, mobile_app_active=True,
    login_count_30d=10, digital_engagement_score=50, open_complaints_count=0, complaints_last_12m=0,
    transaction_trend="STABLE", balance_trend="STABLE",
)


def features(spark, *changes):
    """One calm customer per change, numbered from 1, with the change applied."""
    rows = [{**CALM, "customer_id": i, **change} for i, change in enumerate(changes, start=1)]
    names = [part.split()[0] for part in FEATURE_SCHEMA.replace("\n", " ").replace("decimal(15,2)", "decimal").split(",")]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], FEATURE_SCHEMA)


def column(df, name, key="customer_id"):
    return [row[0] for row in df.orderBy(key).select(name).collect()]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def literal(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


__all__ = ["AS_OF", "CALM", "F", "column", "features", "frame", "literal", "rows"]
