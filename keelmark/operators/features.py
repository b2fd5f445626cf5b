"""Customer-grain features.

Facts are reduced to one row per key before any join, so a join never multiplies
balances and a key that owns a large share of the facts is combined map-side.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import points
from keelmark.functions.temporal import day, days_crossed, months_before, months_crossed
from keelmark.sources.banking import Sources

PRIMARY_TYPE = "CURRENT_ACCOUNT"


def verified(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("kyc_status") == "VERIFIED")


def active(accounts: DataFrame) -> DataFrame:
    return accounts.filter(F.col("account_status") == "ACTIVE")


def _primary_balance() -> Column:
    """Zero for other account types: a lone negative current account stays negative."""
    return F.when(F.col("account_type") == PRIMARY_TYPE, F.col("current_balance")).otherwise(F.lit(0).cast("decimal(15,2)"))


def account_metrics(accounts: DataFrame) -> DataFrame:
    return active(accounts).groupBy("customer_id").agg(
        F.count_distinct("account_id").cast("int").alias("total_products_held"),
        F.max(_primary_balance()).alias("primary_account_balance"),
        F.sum("current_balance").cast("decimal(15,2)").alias("total_relationship_balance"),
    )


def account_activity(transactions: DataFrame, as_of: date) -> DataFrame:
    """Per account: movements in the recent and the prior window, and the last day seen."""
    recent_from = months_before(as_of, S.RECENT_MONTHS)
    when = F.col("txn_date")
    return (
        transactions
        .filter(when.between(months_before(as_of, S.ACTIVITY_MONTHS), day(as_of)))
        .groupBy("account_id")
        .agg(
            F.count_if(when >= recent_from).alias("recent"),
            F.count_if(when < recent_from).alias("prior"),
            F.max(when).alias("last_seen"),
        )
    )


def _summed_activity() -> list[Column]:
    return [
        F.coalesce(F.sum("recent"), F.lit(0)).alias("txn_count_recent_3m"),
        F.coalesce(F.sum("prior"), F.lit(0)).alias("txn_count_prior_3m"),
        F.max("last_seen").alias("last_transaction_date"),
    ]


def transaction_metrics(accounts: DataFrame, transactions: DataFrame, as_of: date) -> DataFrame:
    return (
        active(accounts).select("account_id", "customer_id")
        .join(account_activity(transactions, as_of), "account_id", "left")
        .groupBy("customer_id").agg(*_summed_activity())
    )


def relationship_metrics(accounts: DataFrame, transactions: DataFrame, as_of: date) -> DataFrame:
    """``account_metrics`` and ``transaction_metrics`` in one pass over the accounts.

    The inner grouping follows the join's partitioning by account, and stands in
    for the distinct count: accounts are counted once each in the outer grouping.
    """
    per_account = (
        active(accounts)
        .join(account_activity(transactions, as_of), "account_id", "left")
        .groupBy("account_id", "customer_id")
        .agg(
            F.max(_primary_balance()).alias("primary_part"),
            F.sum("current_balance").alias("balance_part"),
            F.sum("recent").alias("recent"),
            F.sum("prior").alias("prior"),
            F.max("last_seen").alias("last_seen"),
        )
    )
    return per_account.groupBy("customer_id").agg(
        F.count("account_id").cast("int").alias("total_products_held"),
        F.max("primary_part").alias("primary_account_balance"),
        F.sum("balance_part").cast("decimal(15,2)").alias("total_relationship_balance"),
        *_summed_activity(),
    )


def distinct_monthly_average(accounts: DataFrame, transactions: DataFrame, as_of: date) -> DataFrame:
    """Distinct movements of the recent window per month, for every customer with an active account.

    Movements are reduced to distinct ids before they meet the accounts, in an inner
    join (whose heavy partitions may be split), and only counts meet the customers.
    """
    owners = active(accounts).select("account_id", "customer_id")
    window = F.col("txn_date").between(months_before(as_of, S.RECENT_MONTHS), day(as_of))
    moved = transactions.filter(window).select("account_id", "txn_id").distinct()
    counted = moved.join(owners, "account_id").groupBy("customer_id").agg(F.count_distinct("txn_id").alias("n"))
    average = (F.coalesce("n", F.lit(0)) / S.RECENT_MONTHS).alias("avg_monthly_transactions")
    return owners.select("customer_id").distinct().join(counted, "customer_id", "left").select("customer_id", average)


def latest_engagement(engagement: DataFrame, as_of: date) -> DataFrame:
    """The newest measurement per customer up to the date, as one hash aggregate.

    Where a customer has several on one date, a hash of their ids decides. Date and hash share one long, as wider
    orderings or payloads would leave hash aggregation.
    """
    payload = ["measurement_date", "login_count_30d", "mobile_app_active", "online_banking_active", "features_used_count"]
    dated = engagement.filter(F.col("measurement_date") <= day(as_of))
    place = F.unix_date("measurement_date") * F.lit(1 << 32) + F.pmod(F.xxhash64("engagement_id"), F.lit(1 << 32))
    return dated.withColumn("_place", place).groupBy("customer_id").agg(*(F.max_by(c, "_place").alias(c) for c in payload))


def complaint_metrics(complaints: DataFrame, as_of: date) -> DataFrame:
    raised = F.col("complaint_date")
    return (
        complaints
        .filter(raised.between(months_before(as_of, S.COMPLAINT_MONTHS), day(as_of)))
        .groupBy("customer_id")
        .agg(
            F.count_if(F.col("status") == "OPEN").cast("int").alias("open_complaints_count"),
            F.count("*").cast("int").alias("complaints_last_12m"),
        )
    )


def engagement_points() -> Column:
    """Uncapped engagement points; missing measurements count as none."""
    yes = lambda name: F.coalesce(F.col(name), F.lit(False))
    return (
        F.coalesce("login_count_30d", F.lit(0)) * S.LOGIN_POINTS
        + points(yes("mobile_app_active"), S.MOBILE_POINTS)
        + points(yes("online_banking_active"), S.ONLINE_POINTS)
        + F.coalesce("features_used_count", F.lit(0)) * S.FEATURE_POINTS
    )


def transaction_trend(recent: Column, prior: Column) -> Column:
    """Trend of two counts; limits are compared in tenths so that they are exact."""
    grown = recent * 10
    return (
        F.when(prior == 0, "STABLE")
        .when(grown > prior * S.TREND_UP_TENTHS, "INCREASING")
        .when(grown >= prior * S.TREND_FLAT_TENTHS, "STABLE")
        .when(grown >= prior * S.TREND_DOWN_TENTHS, "DECLINING")
        .otherwise("SEVERELY_DECLINING")
    )


def _or_zero(name: str, kind: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast(kind)


def customer_features(sources: Sources, as_of: date) -> DataFrame:
    """One row per verified customer. Every joined side is unique and partitioned by customer."""
    joined = (
        verified(sources.customers)
        .join(relationship_metrics(sources.accounts, sources.transactions, as_of), "customer_id", "left")
        .join(latest_engagement(sources.digital_engagement, as_of), "customer_id", "left")
        .join(complaint_metrics(sources.complaints, as_of), "customer_id", "left")
    )
    filled = joined.select(
        "customer_id", "customer_name", "customer_segment", "region",
        months_crossed(F.col("onboarding_date"), day(as_of)).alias("relationship_tenure_months"),
        _or_zero("total_products_held", "int").alias("total_products_held"),
        _or_zero("primary_account_balance", "decimal(15,2)").alias("primary_account_balance"),
        _or_zero("total_relationship_balance", "decimal(15,2)").alias("total_relationship_balance"),
        _or_zero("txn_count_recent_3m", "bigint").alias("txn_count_recent_3m"),
        _or_zero("txn_count_prior_3m", "bigint").alias("txn_count_prior_3m"),
        F.coalesce(days_crossed(F.col("last_transaction_date"), day(as_of)), F.lit(S.NO_TRANSACTION_DAYS))
        .alias("days_since_last_transaction"),
        F.coalesce("mobile_app_active", F.lit(False)).alias("mobile_app_active"),
        _or_zero("login_count_30d", "int").alias("login_count_30d"),
        F.least(F.lit(S.SCORE_MAX), engagement_points()).alias("digital_engagement_score"),
        _or_zero("open_complaints_count", "int").alias("open_complaints_count"),
        _or_zero("complaints_last_12m", "int").alias("complaints_last_12m"),
    )
    recent, prior = F.col("txn_count_recent_3m"), F.col("txn_count_prior_3m")
    return filled.withColumns({
        "avg_monthly_transactions_3m": F.round(recent.cast("decimal(18,0)") / S.RECENT_MONTHS, 1).cast("decimal(10,1)"),
        "transaction_trend": transaction_trend(recent, prior),
        "balance_trend": F.when(F.col("total_relationship_balance") > S.BALANCE_STABLE_ABOVE, "STABLE").otherwise("DECLINING"),
    })
