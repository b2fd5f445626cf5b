"""The five banking sources (and product history), derived from the star-schema tables.

A deployment with real banking tables builds ``Sources`` from them directly; the
operators only see the frames. Scans project the columns they need, and date
limits are written on the stored timestamp so that they reach the Parquet reader.
"""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import text
from keelmark.functions.temporal import day
from keelmark.sources.tables import table

# ---------------------------------------------------------------- fixed values
SEGMENT_OF_MARKET = {"BUILDING": "AFFLUENT", "MACHINERY": "HIGH_NET_WORTH", "FURNITURE": "MASS_AFFLUENT"}
ACCOUNT_TYPES = ("CURRENT_ACCOUNT", "SAVINGS_ACCOUNT", "CREDIT_CARD", "LOAN", "ISA")
ONBOARDING_CHANNELS = ("BRANCH", "ONLINE", "MOBILE_APP", "REFERRAL", "PARTNERSHIP")
TXN_CHANNELS = ("MOBILE_APP", "ONLINE", "BRANCH", "ATM", "MERCHANT", "AUTO")
# ------------------------------------------------------------ end fixed values


@dataclass(frozen=True)
class Sources:
    customers: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    digital_engagement: DataFrame
    complaints: DataFrame


def _pick(values: tuple[str, ...], position: str) -> Column:
    """Zero-based pick from a list of literals; ``position`` is a SQL expression."""
    return F.expr(f"element_at(array({', '.join(map(text, values))}), CAST({position} AS INT) + 1)")


def _mapped(column: str, mapping: dict[str, str], default: str) -> Column:
    cases = " ".join(f"WHEN {text(raw)} THEN {text(target)}" for raw, target in mapping.items())
    return F.expr(f"CASE {column} {cases} ELSE {text(default)} END")


def _priority_digit() -> Column:
    return F.left("o_orderpriority", F.lit(1)).cast("int")


def _account_key() -> Column:
    return F.col("o_custkey") * 10 + _priority_digit()


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    placed = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return placed.select(
        key.alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        _mapped("c_mktsegment", SEGMENT_OF_MARKET, "MASS_MARKET").alias("customer_segment"),
        F.col("r_name").alias("region"),
        _pick(ONBOARDING_CHANNELS, "c_custkey % 5").alias("onboarding_channel"),
        F.date_sub(F.lit(S.AS_OF), (F.lit(30) + (key * 37) % 5445).cast("int")).alias("onboarding_date"),
        F.when(key % 50 == 0, "PENDING_REVIEW").otherwise("VERIFIED").alias("kyc_status"),
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """One account per customer and order priority; opened and closed by its first and last order."""
    ordered = F.to_date("o_orderdate")
    grouped = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"), _priority_digit().alias("digit"))
        .agg(F.min(ordered).alias("opened_date"), F.max(ordered).alias("last_order"))
    )
    balances = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").cast("decimal(15,2)").alias("balance"))
    closed = (F.col("customer_id") * 7 + F.col("digit")) % 20 == 0
    kind = _pick(ACCOUNT_TYPES, "digit - 1")
    return grouped.join(balances, "customer_id", "left").select(
        (F.col("customer_id") * 10 + F.col("digit")).alias("account_id"),
        "customer_id",
        kind.alias("account_type"),
        F.when(closed, "CLOSED").otherwise("ACTIVE").alias("account_status"),
        "opened_date",
        F.when(closed, F.col("last_order")).alias("closed_date"),
        F.when(kind == "SAVINGS_ACCOUNT", F.col("balance") * 10).otherwise(F.col("balance"))
        .cast("decimal(15,2)").alias("current_balance"),
    )


def transactions(
    spark: SparkSession, folder: str, since: date | Column | None = None, until: date | Column | None = None,
) -> DataFrame:
    """Line items as account movements. ``since``/``until`` are inclusive days."""
    lines = table(spark, folder, "lineitem")
    shipped = F.col("l_shipdate")
    if since is not None:
        lines = lines.filter(shipped >= day(since).cast("timestamp_ntz"))
    if until is not None:
        lines = lines.filter(shipped < F.date_add(day(until), 1).cast("timestamp_ntz"))
    money = F.col("l_extendedprice").cast("decimal(15,2)")
    joined = lines.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("txn_id"),
        _account_key().alias("account_id"),
        F.to_date(shipped).alias("txn_date"),
        F.when(F.col("l_returnflag") == "R", -money).otherwise(money).cast("decimal(15,2)").alias("amount"),
        _pick(TXN_CHANNELS, "l_linenumber % 6").alias("channel"),
    )


#: The events lie 1,168 weeks after the banking dates; moved back, they fall on both sides of the as-of date.
EVENT_DAYS_LATE = 7 * 1168


def digital_engagement(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly activity per customer."""
    week = F.date_sub(F.trunc(F.to_date("ts"), "week"), EVENT_DAYS_LATE)
    person = F.col("user_id") * 10 + F.col("event_id") % 10
    weekly = (
        table(spark, folder, "events")
        .groupBy(person.alias("customer_id"), week.alias("measurement_date"))
        .agg(
            F.sum(F.floor(F.col("value") / 10)).cast("int").alias("login_count_30d"),
            F.bool_or(F.col("event_type") == "click").alias("mobile_app_active"),
            F.bool_or(F.col("event_type") == "signup").alias("online_banking_active"),
            F.count_distinct("event_type").cast("int").alias("features_used_count"),
        )
    )
    return weekly.select(
        F.concat_ws("-", "customer_id", "measurement_date").alias("engagement_id"), *weekly.columns)


def complaints(spark: SparkSession, folder: str, since: date | Column | None = None) -> DataFrame:
    """Large returns count as complaints; ids are not unique in the data, on purpose."""
    quantity, open_ = F.col("l_quantity"), F.col("l_linestatus") == "O"
    lines = table(spark, folder, "lineitem").filter((F.col("l_returnflag") == "R") & (quantity >= 45))
    if since is not None:
        lines = lines.filter(F.col("l_shipdate") >= day(since).cast("timestamp_ntz"))
    raised = F.to_date("l_shipdate")
    return lines.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("complaint_id"),
        F.col("o_custkey").alias("customer_id"),
        raised.alias("complaint_date"),
        F.when(open_, "OPEN").otherwise("RESOLVED").alias("status"),
        F.when(quantity >= 50, "CRITICAL").when(quantity >= 48, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.when(~open_, F.date_add(raised, F.col("l_linenumber"))).alias("resolution_date"),
    )


def holding_spans(held: DataFrame, until: date | Column) -> DataFrame:
    """Spans of a constant number of open accounts per customer, up to ``until``: one row per change.

    customer_id, span_start (the month end from which the count holds), product_count (> 0).
    Openings count from the month end after opening, closures until the one after closing.
    Changes are two projections of the accounts, unioned (no generator), summed per customer
    and month end, and turned into running counts by one window per customer, whose length is
    the number of months with a change, not the number of accounts.
    """
    last = day(until)
    opened = held.select("customer_id", F.last_day("opened_date").alias("span_start"), F.lit(1).alias("change"))
    closed = held.select("customer_id", F.last_day("closed_date").alias("span_start"), F.lit(-1).alias("change"))
    changes = (opened.unionByName(closed).filter(F.col("span_start") <= last)
               .groupBy("customer_id", "span_start").agg(F.sum("change").alias("change")))
    ordered = Window.partitionBy("customer_id").orderBy("span_start")
    return (changes.select("customer_id", "span_start", F.sum("change").over(ordered).cast("int").alias("product_count"))
            .filter("product_count > 0"))


def product_snapshots(held: DataFrame, until: date | Column) -> DataFrame:
    """Month-end count of accounts open per customer, up to ``until``.

    An account counts from the month end after its opening until the one after its
    closure. Those changes are summed per customer and month *before* the calendar
    is opened up, so the shuffles carry changes, not accounts × months, and the
    window of a customer is no longer than the number of months with a change.
    """
    last = day(until)
    last_month = F.add_months(F.trunc(F.date_add(last, 1), "MM"), -1)
    change = lambda when, amount: F.struct(F.last_day(when).alias("month_end"), F.lit(amount).alias("change"))
    changes = (
        held.select("customer_id", F.inline(F.array(change("opened_date", 1), change("closed_date", -1))))
        .filter(F.col("month_end") <= last)
        .groupBy("customer_id", "month_end").agg(F.sum("change").alias("change"))
    )
    ordered = Window.partitionBy("customer_id").orderBy("month_end")
    spans = changes.select(
        "customer_id", "month_end",
        F.sum("change").over(ordered).cast("int").alias("product_count"),
        F.lead("month_end").over(ordered).alias("next_change"),
    ).filter("product_count > 0")
    until_month = F.coalesce(F.add_months(F.trunc("next_change", "MM"), -1), last_month)
    months = F.sequence(F.trunc("month_end", "MM"), until_month, F.expr("INTERVAL 1 MONTH"))
    return spans.select("customer_id", F.explode(months).alias("month"), "product_count").select(
        "customer_id", F.last_day("month").alias("snapshot_date"), "product_count")


def load(spark: SparkSession, folder: str, as_of: date = S.AS_OF) -> Sources:
    """All sources; the two large ones limited to the windows a product run reads."""
    return Sources(
        customers=customers(spark, folder),
        accounts=accounts(spark, folder),
        transactions=transactions(spark, folder, F.add_months(F.lit(as_of), -S.ACTIVITY_MONTHS), as_of),
        digital_engagement=digital_engagement(spark, folder),
        complaints=complaints(spark, folder, F.add_months(F.lit(as_of), -S.COMPLAINT_MONTHS)),
    )
