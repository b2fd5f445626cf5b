"""Consumer worklists, the metric layer, governance and the change-driven metrics."""

from datetime import date

from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import ratio
from keelmark.operators import consumption, governance, quality
from keelmark.plans import contract as contracts
from keelmark.session import run_dir
from keelmark.sources import banking
from keelmark.sources.tables import SCHEMAS, stored, table
from keelmark.streaming import metrics as stream
from parity.product_queries import v1, v2
from parity.quality_queries import share_sql
from parity.registry import query, view

C = F.col


@query("critical_top50", """
SELECT customer_id, customer_name, customer_segment, churn_risk_score, risk_tier, primary_risk_driver, recommended_intervention
FROM v1 WHERE risk_tier = 'CRITICAL' ORDER BY churn_risk_score DESC, customer_id LIMIT 50
""", "v1")
def critical_top50(spark, folder):
    return consumption.critical_customers(v1(spark, folder))


@query("tier_distribution", f"""
SELECT risk_tier, count(*) AS customer_count, {share_sql('sum(churn_risk_score)', 'count(*)', 1)} AS avg_risk_score,
       CAST(round(sum(total_relationship_balance), 0) AS DECIMAL(25,0)) AS total_balance_at_risk,
       {share_sql('sum(relationship_tenure_months)', 'count(*)', 1)} AS avg_tenure_months,
       CAST(list_position(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'], risk_tier) AS INTEGER) AS tier_order
FROM v1 GROUP BY risk_tier
""", "v1")
def tier_distribution(spark, folder):
    return consumption.tier_distribution(v1(spark, folder))


@query("driver_analysis", f"""
SELECT primary_risk_driver, count(*) AS customer_count, {share_sql('sum(churn_risk_score)', 'count(*)', 1)} AS avg_risk_score,
       count(*) FILTER (churn_risk_score > 50) AS high_risk_count
FROM v1 WHERE primary_risk_driver <> 'NONE' GROUP BY primary_risk_driver
""", "v1")
def driver_analysis(spark, folder):
    return consumption.driver_analysis(v1(spark, folder))


@query("intervention_queue", """
SELECT customer_id, customer_name, region, churn_risk_score, recommended_intervention, primary_risk_driver, intervention_priority,
       total_relationship_balance AS detail_balance, transaction_trend AS detail_trend, days_since_last_transaction AS detail_days_inactive
FROM v1 WHERE recommended_intervention <> 'NO_ACTION'
""", "v1")
def intervention_queue(spark, folder):
    return consumption.intervention_queue(v1(spark, folder))


@query("top_clv", f"""
SELECT customer_id, customer_name, churn_risk_score, risk_tier, {', '.join(S.V2_ADDED)}
FROM v2 WHERE risk_tier IN ('CRITICAL', 'HIGH') ORDER BY estimated_clv DESC, customer_id LIMIT 10
""", "v2")
def top_clv(spark, folder):
    return consumption.top_lifetime_value(v2(spark, folder))


@query("semantic_count_by_segment_tier", """
SELECT customer_segment, risk_tier, count(customer_id) AS customer_count FROM v1 GROUP BY ALL
""", "v1")
def semantic_count_by_segment_tier(spark, folder):
    return consumption.metric_query(v1(spark, folder), ["customer_segment", "risk_tier"])


@query("semantic_questions", f"""
SELECT 'average score by segment' AS question, customer_segment AS answer_for, {share_sql('sum(churn_risk_score)', 'count(*)', 2)} AS answer FROM v1 GROUP BY 2
UNION ALL SELECT 'high risk customers by tier in EUROPE', risk_tier, CAST(count(customer_id) AS DECIMAL(18,2)) FROM v1
  WHERE region = 'EUROPE' AND risk_tier IN ('HIGH', 'CRITICAL') GROUP BY 2
UNION ALL SELECT 'critical customers by region', region, CAST(count(customer_id) AS DECIMAL(18,2)) FROM v1 WHERE risk_tier = 'CRITICAL' GROUP BY 2
UNION ALL SELECT 'balance at risk with complaints by segment', customer_segment, CAST(sum(total_relationship_balance) AS DECIMAL(18,2))
  FROM v1 WHERE complaint_flag GROUP BY 2
""", "v1")
def semantic_questions(spark, folder):
    product = stored(v1(spark, folder), "v1")
    as_value = lambda column: column.cast("decimal(18,2)")
    asked = [
        ("average score by segment", "customer_segment", ratio(F.sum("churn_risk_score"), F.count("*"), 2), None),
        ("high risk customers by tier in EUROPE", "risk_tier", as_value(consumption.customer_count()),
         (C("region") == "EUROPE") & C("risk_tier").isin("HIGH", "CRITICAL")),
        ("critical customers by region", "region", as_value(consumption.customer_count()), C("risk_tier") == "CRITICAL"),
        ("balance at risk with complaints by segment", "customer_segment", as_value(F.sum("total_relationship_balance")), C("complaint_flag")),
    ]
    return quality.union([
        consumption.metric_query(product, [dimension], {"answer": metric}, where)
        .select(F.lit(question).alias("question"), C(dimension).alias("answer_for"), "answer")
        for question, dimension, metric, where in asked])


# ----------------------------------------------------------------- governance
_CONTRACT = contracts.bundled(S.V1)
_MASKED = "SELECT * REPLACE (left(customer_name, 1) || '****' AS customer_name) FROM v1"


@query("masked_unauthorised", _MASKED, "v1")
def masked_unauthorised(spark, folder):
    return governance.masked_view(v1(spark, folder), _CONTRACT, ["analyst_external"])


@query("masked_authorised", "SELECT * FROM v1", "v1")
def masked_authorised(spark, folder):
    return governance.masked_view(v1(spark, folder), _CONTRACT, ["analyst_external", "Branch_Manager"])


@query("masking_compliance", """
SELECT 'masked' AS publication, 'customer_name' AS column_name, count(*) AS checked_rows, CAST(0 AS BIGINT) AS unmasked_rows FROM v1
UNION ALL SELECT 'clear', 'customer_name', count(*), count(*) FILTER (customer_name <> left(customer_name, 1) || '****') FROM v1
""", "v1")
def masking_compliance(spark, folder):
    """A masked publication, and one that was released in clear by mistake."""
    product = stored(v1(spark, folder), "v1")
    published = {"masked": ["analyst_external"], "clear": ["branch_manager"]}
    return quality.union([
        governance.masking_compliance(governance.masked_view(product, _CONTRACT, roles), product, _CONTRACT)
        .select(F.lit(name).alias("publication"), "*") for name, roles in published.items()])


RETAINED_AT = date(2008, 6, 1)
view("expired", f"SELECT account_id FROM accounts WHERE closed_date + INTERVAL 84 MONTH < DATE '{RETAINED_AT}'", "accounts")


@query("retention_expired", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_before, count(*) FILTER (account_id IN (SELECT account_id FROM expired)) AS rows_removed, "
    f"count(*) FILTER (account_id NOT IN (SELECT account_id FROM expired)) AS rows_kept FROM {t}" for t in ("accounts", "transactions")),
    "accounts", "transactions", "expired")
def retention_expired(spark, folder):
    held = banking.accounts(spark, folder)
    expired = governance.expired_accounts(held, RETAINED_AT)
    tables = {"accounts": (held, "account_id"), "transactions": (banking.transactions(spark, folder), "account_id")}
    return governance.removal_audit(tables, expired, "account_id")


@query("retained_transactions", "SELECT * FROM transactions WHERE account_id NOT IN (SELECT account_id FROM expired)", "transactions", "expired")
def retained_transactions(spark, folder):
    expired = governance.expired_accounts(banking.accounts(spark, folder), RETAINED_AT)
    return governance.without(banking.transactions(spark, folder), "account_id", expired)


view("erasure_requests", "SELECT customer_id FROM customers WHERE kyc_status = 'PENDING_REVIEW'", "customers")
_BY_CUSTOMER = ("customers", "accounts", "digital_engagement", "complaints")


@query("erasure_applied", " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, count(*) AS rows_before, count(*) FILTER (customer_id IN (SELECT customer_id FROM erasure_requests)) AS rows_removed, "
     f"count(*) FILTER (customer_id NOT IN (SELECT customer_id FROM erasure_requests)) AS rows_kept FROM {t}" for t in _BY_CUSTOMER]
    + ["SELECT 'transactions', count(*), count(*) FILTER (account_id // 10 IN (SELECT customer_id FROM erasure_requests)), "
       "count(*) FILTER (account_id // 10 NOT IN (SELECT customer_id FROM erasure_requests)) FROM transactions"]),
    *_BY_CUSTOMER, "transactions", "erasure_requests")
def erasure_applied(spark, folder):
    """Requests of customers under review, carried out in every table; movements go by their accounts."""
    held, people = banking.accounts(spark, folder), banking.customers(spark, folder)
    requests = people.filter(C("kyc_status") == "PENDING_REVIEW")
    by_customer = {
        "customers": (people, "customer_id"), "accounts": (held, "customer_id"),
        "digital_engagement": (banking.digital_engagement(spark, folder), "customer_id"),
        "complaints": (banking.complaints(spark, folder), "customer_id"),
    }
    owned = held.join(requests.select("customer_id"), "customer_id", "left_semi")
    return governance.removal_audit(by_customer, requests, "customer_id").unionByName(
        governance.removal_audit({"transactions": (banking.transactions(spark, folder), "account_id")}, owned, "account_id"))


# Removal that removes: tables stored by key bucket, requests carried through a cascade of keys.
REMOVAL_BUCKETS = 32
ERASURE_ID = "erasure-pending-review"
_ERASED = ("customers", "accounts", "transactions", "digital_engagement", "complaints", "product")


def _erasure_store(spark, folder):
    """Every table with customer data, and the product, stored by key bucket; the request applied twice."""
    people = banking.customers(spark, folder)
    tables = {
        "customers": (people, "customer_id"), "accounts": (banking.accounts(spark, folder), "customer_id"),
        "transactions": (banking.transactions(spark, folder), "account_id"),
        "digital_engagement": (banking.digital_engagement(spark, folder), "customer_id"),
        "complaints": (banking.complaints(spark, folder), "customer_id"), "product": (v1(spark, folder), "customer_id"),
    }
    base = run_dir(spark, "erasure")
    held = governance.store_for_removal(tables, base, REMOVAL_BUCKETS)
    requests = people.filter(C("kyc_status") == "PENDING_REVIEW")
    cascade = [("customers", "customer_id", "request", None), ("accounts", "customer_id", "request", None),
               ("transactions", "account_id", "accounts", "account_id"),
               ("digital_engagement", "customer_id", "request", None), ("complaints", "customer_id", "request", None),
               ("product", "customer_id", "request", None)]
    for _ in range(2):  # the second run finds the request in the log and changes nothing
        governance.apply_removal(spark, held, cascade, requests, "customer_id", ERASURE_ID, f"{base}/_log", REMOVAL_BUCKETS)
    return held, f"{base}/_log"


def _remaining(spark, held, name):
    from keelmark.operators.versions import BUCKET
    return spark.read.parquet(held[name][0]).drop(BUCKET)


view("erased_accounts_of", "SELECT account_id FROM accounts WHERE customer_id IN (SELECT customer_id FROM erasure_requests)",
     "accounts", "erasure_requests")


@query("erased_accounts", "SELECT * FROM accounts WHERE customer_id NOT IN (SELECT customer_id FROM erasure_requests)",
       "accounts", "erasure_requests")
def erased_accounts(spark, folder):
    """Accounts left after the erasure request, removed from the stored table bucket by bucket."""
    held, _ = _erasure_store(spark, folder)
    return _remaining(spark, held, "accounts")


@query("erased_transactions", "SELECT * FROM transactions WHERE account_id NOT IN (SELECT account_id FROM erased_accounts_of)",
       "transactions", "erased_accounts_of")
def erased_transactions(spark, folder):
    """Movements left: they go with the accounts of erased customers (customer -> account -> movement)."""
    held, _ = _erasure_store(spark, folder)
    return _remaining(spark, held, "transactions")


@query("erased_product", "SELECT * FROM v1 WHERE customer_id NOT IN (SELECT customer_id FROM erasure_requests)",
       "v1", "erasure_requests")
def erased_product(spark, folder):
    held, _ = _erasure_store(spark, folder)
    return _remaining(spark, held, "product")


@query("erasure_log", " UNION ALL ".join(
    [f"SELECT '{ERASURE_ID}' AS request_id, '{t}' AS table_name, 'customer_id' AS key_column, "
     f"count(*) FILTER (customer_id IN (SELECT customer_id FROM erasure_requests)) AS rows_removed FROM {t}"
     for t in ("customers", "accounts", "digital_engagement", "complaints")]
    + [f"SELECT '{ERASURE_ID}', 'transactions', 'account_id', count(*) FILTER (account_id IN (SELECT account_id FROM erased_accounts_of)) FROM transactions",
       f"SELECT '{ERASURE_ID}', 'product', 'customer_id', count(*) FILTER (customer_id IN (SELECT customer_id FROM erasure_requests)) FROM v1"]),
    *_BY_CUSTOMER, "transactions", "erasure_requests", "erased_accounts_of", "v1")
def erasure_log(spark, folder):
    """The audit log after the request ran twice: one row per table, written once."""
    _, log = _erasure_store(spark, folder)
    return spark.read.parquet(log)


@query("retained_accounts", "SELECT * FROM accounts WHERE account_id NOT IN (SELECT account_id FROM expired)", "accounts", "expired")
def retained_accounts(spark, folder):
    """Accounts past retention removed from the stored table, which is bucketed by customer; their movements go too."""
    accounts = banking.accounts(spark, folder)
    held = governance.store_for_removal(
        {"accounts": (accounts, "customer_id"), "transactions": (banking.transactions(spark, folder), "account_id")},
        run_dir(spark, "retention"), REMOVAL_BUCKETS)
    expired = governance.expired_accounts(_remaining(spark, held, "accounts"), RETAINED_AT)
    expired = stored(expired.select("account_id", "customer_id"), "expired-accounts")
    governance.remove_by_key(held["transactions"][0], "account_id", expired, "account_id", REMOVAL_BUCKETS)
    governance.remove_by_key(held["accounts"][0], "account_id", expired, "account_id", REMOVAL_BUCKETS, bucket_by="customer_id")
    return _remaining(spark, held, "accounts")


EVOLUTION_ID = "product-1.0.0-to-2.0.0"
EVOLUTION_REASON = "additive release: holdings, lifetime value, confidence and vulnerability"


@query("lineage_log", f"""
SELECT '{EVOLUTION_ID}' AS change_id, '1.0.0' AS from_version, '2.0.0' AS to_version,
       unnest([{", ".join(f"'{c}'" for c in S.V2_ADDED)}]) AS column_name, '{EVOLUTION_REASON}' AS reason,
       (SELECT count(*) FROM v2) AS rows_at_change
""", "v2")
def lineage_log(spark, folder):
    """Schema evolution logged with a VARIANT payload, appended twice (the second append is skipped), then listed."""
    from keelmark.sources.tables import append_once

    before, after = v1(spark, folder), v2(spark, folder)
    added = [c for c in after.columns if c not in before.columns]
    payload = F.to_json(F.struct(F.array(*[F.lit(c) for c in added]).alias("added"), F.lit(EVOLUTION_REASON).alias("reason"),
                                 F.col("rows").alias("rows")))
    entries = after.agg(F.count("*").alias("rows")).select(
        F.lit(EVOLUTION_ID).alias("change_id"), F.lit("1.0.0").alias("from_version"), F.lit("2.0.0").alias("to_version"),
        F.parse_json(payload).alias("payload"))
    log = f"{run_dir(spark, 'lineage')}/log"
    for _ in range(2):
        append_once(entries, log, "change_id")
    listed = spark.read.parquet(log)
    return listed.select(
        "change_id", "from_version", "to_version",
        F.explode(F.variant_get("payload", "$.added", "array<string>")).alias("column_name"),
        F.variant_get("payload", "$.reason", "string").alias("reason"),
        F.variant_get("payload", "$.rows", "bigint").alias("rows_at_change"))


@query("json_path_listing", """
SELECT event_type, CAST(props ->> '$.k' AS BIGINT) AS k, count(*) AS entries FROM (SELECT event_type, CAST(props AS JSON) AS props FROM events) GROUP BY ALL
""")
def json_path_listing(spark, folder):
    detail = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, folder, "events").groupBy("event_type", detail.alias("k")).agg(F.count("*").alias("entries"))


# ------------------------------------------------------------------ streaming
@query("stream_metrics", """
SELECT event_type AS table_name, count(*) AS row_count, count(*) FILTER (value < 1) AS null_count, max(ts) AS newest FROM events GROUP BY event_type
""")
def stream_metrics(spark, folder):
    """Metrics on change with running state per table, read from the stream's newest state version."""
    home = run_dir(spark, "stream")
    for running in stream.start_stateful(spark, folder, SCHEMAS["events"], f"{home}/state", f"{home}/checkpoint", glob="events.parquet"):
        running.awaitTermination()
    return stream.running_state(spark, f"{home}/state").drop("duplicate_count")


@query("stream_quality_state", """
SELECT event_type AS table_name, count(DISTINCT event_id) AS row_count,
       count(*) FILTER (value < 1) AS null_count, count(*) - count(DISTINCT event_id) AS duplicate_count, max(ts) AS newest
FROM events GROUP BY event_type
""")
def stream_quality_state(spark, folder):
    """J1, J2, J4 and J5 per table from a stream with a watermark and removal of repeats inside it."""
    home = run_dir(spark, "stream-state")
    for running in stream.start_stateful(spark, folder, SCHEMAS["events"], f"{home}/state", f"{home}/checkpoint", glob="events.parquet"):
        running.awaitTermination()
    return stream.running_state(spark, f"{home}/state")
