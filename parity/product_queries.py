"""Features, scores and the two product versions."""

from datetime import date, datetime

from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.operators import features, scoring, versions
from keelmark.plans import product
from keelmark.session import run_dir
from keelmark.sources import banking
from keelmark.sources.tables import snapshot_once, stored
import parity.source_queries  # noqa: F401  (declares the source views)
from parity.registry import query, view

EARLIER, EARLIER_SCORED = date(2001, 8, 1), datetime(2001, 8, 1, 6, 0, 0)


def product_views(suffix: str, as_of: date, scored_at: datetime) -> None:
    """SQL views for one evaluation date; ``suffix`` keeps several dates apart."""
    d = f"DATE '{as_of}'"
    back = lambda months: f"CAST({d} - INTERVAL {months} MONTH AS DATE)"
    view(f"account_metrics{suffix}", """
SELECT customer_id, CAST(count(DISTINCT account_id) AS INTEGER) AS total_products_held,
       max(if(account_type = 'CURRENT_ACCOUNT', current_balance, 0)) AS primary_account_balance,
       CAST(sum(current_balance) AS DECIMAL(15,2)) AS total_relationship_balance
FROM accounts WHERE account_status = 'ACTIVE' GROUP BY customer_id
""", "accounts")
    view(f"transaction_metrics{suffix}", f"""
SELECT customer_id,
       count(*) FILTER (txn_date >= {back(3)}) AS txn_count_recent_3m,
       count(*) FILTER (txn_date < {back(3)}) AS txn_count_prior_3m,
       max(txn_date) AS last_transaction_date
FROM accounts LEFT JOIN (
  SELECT account_id, txn_date FROM transactions WHERE txn_date BETWEEN {back(6)} AND {d}
) USING (account_id)
WHERE account_status = 'ACTIVE' GROUP BY customer_id
""", "accounts", "transactions")
    view(f"latest_engagement{suffix}", f"""
SELECT customer_id, measurement_date, login_count_30d, mobile_app_active, online_banking_active, features_used_count
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY measurement_date DESC, engagement_id DESC) AS rn
      FROM digital_engagement WHERE measurement_date <= {d}) WHERE rn = 1
""", "digital_engagement")
    view(f"complaint_metrics{suffix}", f"""
SELECT customer_id, CAST(sum(if(status = 'OPEN', 1, 0)) AS INTEGER) AS open_complaints_count,
       CAST(count(*) AS INTEGER) AS complaints_last_12m
FROM complaints WHERE complaint_date BETWEEN {back(12)} AND {d} GROUP BY customer_id
""", "complaints")
    view(f"features{suffix}", f"""
SELECT *,
  CAST(round(txn_count_recent_3m / 3.0, 1) AS DECIMAL(10,1)) AS avg_monthly_transactions_3m,
  CASE WHEN txn_count_prior_3m = 0 THEN 'STABLE'
       WHEN 10 * txn_count_recent_3m > 11 * txn_count_prior_3m THEN 'INCREASING'
       WHEN 10 * txn_count_recent_3m >= 9 * txn_count_prior_3m THEN 'STABLE'
       WHEN 2 * txn_count_recent_3m >= txn_count_prior_3m THEN 'DECLINING'
       ELSE 'SEVERELY_DECLINING' END AS transaction_trend,
  if(total_relationship_balance > 1000, 'STABLE', 'DECLINING') AS balance_trend
FROM (
  SELECT c.customer_id, customer_name, customer_segment, region,
    CAST(date_diff('month', onboarding_date, {d}) AS INTEGER) AS relationship_tenure_months,
    coalesce(total_products_held, 0) AS total_products_held,
    coalesce(primary_account_balance, 0) AS primary_account_balance,
    coalesce(total_relationship_balance, 0) AS total_relationship_balance,
    coalesce(txn_count_recent_3m, 0) AS txn_count_recent_3m,
    coalesce(txn_count_prior_3m, 0) AS txn_count_prior_3m,
    CAST(coalesce(date_diff('day', last_transaction_date, {d}), 999) AS INTEGER) AS days_since_last_transaction,
    coalesce(mobile_app_active, false) AS mobile_app_active,
    coalesce(login_count_30d, 0) AS login_count_30d,
    CAST(least(100, 2 * coalesce(login_count_30d, 0) + 20 * CAST(coalesce(mobile_app_active, false) AS INTEGER)
      + 10 * CAST(coalesce(online_banking_active, false) AS INTEGER) + 2 * coalesce(features_used_count, 0)) AS INTEGER) AS digital_engagement_score,
    coalesce(open_complaints_count, 0) AS open_complaints_count,
    coalesce(complaints_last_12m, 0) AS complaints_last_12m
  FROM customers c
  LEFT JOIN account_metrics{suffix} USING (customer_id)
  LEFT JOIN transaction_metrics{suffix} USING (customer_id)
  LEFT JOIN latest_engagement{suffix} USING (customer_id)
  LEFT JOIN complaint_metrics{suffix} USING (customer_id)
  WHERE kyc_status = 'VERIFIED'
)
""", "customers", f"account_metrics{suffix}", f"transaction_metrics{suffix}", f"latest_engagement{suffix}", f"complaint_metrics{suffix}")
    view(f"flagged{suffix}", f"""
SELECT *, open_complaints_count > 0 AS has_unresolved_complaint,
  total_relationship_balance < 500 OR primary_account_balance < 100 AS declining_balance_flag,
  transaction_trend LIKE '%DECLINING' AS reduced_activity_flag,
  login_count_30d < 3 AND NOT mobile_app_active AS low_engagement_flag,
  open_complaints_count > 0 OR complaints_last_12m >= 2 AS complaint_flag,
  days_since_last_transaction > 45 AS dormancy_flag
FROM features{suffix}
""", f"features{suffix}")
    view(f"scored{suffix}", f"""
SELECT *,
  list_extract(['LOW','MEDIUM','HIGH','CRITICAL'], band) AS risk_tier,
  CAST(5 - band AS INTEGER) AS intervention_priority,
  CASE WHEN dormancy_flag AND days_since_last_transaction > 60 THEN 'DORMANCY'
       WHEN declining_balance_flag AND primary_account_balance < 100 THEN 'BALANCE_DECLINE'
       WHEN reduced_activity_flag THEN 'ACTIVITY_REDUCTION'
       WHEN open_complaints_count > 0 THEN 'COMPLAINTS'
       WHEN low_engagement_flag THEN 'LOW_ENGAGEMENT'
       WHEN band > 2 THEN 'MULTI_FACTOR' ELSE 'NONE' END AS primary_risk_driver,
  '{{"declining_balance":{{"flag":' || declining_balance_flag || ',"balance":' || total_relationship_balance
    || '}},"reduced_activity":{{"flag":' || reduced_activity_flag || ',"trend":"' || transaction_trend
    || '"}},"low_engagement":{{"flag":' || low_engagement_flag || ',"score":' || digital_engagement_score
    || '}},"complaints":{{"flag":' || complaint_flag || ',"open_count":' || open_complaints_count || ',"total_12m":' || complaints_last_12m
    || '}},"dormancy":{{"flag":' || dormancy_flag || ',"days_inactive":' || days_since_last_transaction || '}}}}' AS risk_drivers_json,
  CASE band WHEN 4 THEN 'URGENT_ESCALATION' WHEN 3 THEN if(complaint_flag, 'RELATIONSHIP_CALL', 'RETENTION_OFFER')
            WHEN 2 THEN if(low_engagement_flag, 'DIGITAL_ENGAGEMENT', 'BRANCH_MEETING') ELSE 'NO_ACTION' END AS recommended_intervention
FROM (
  SELECT *, 1 + CAST(churn_risk_score > 25 AS INTEGER) + CAST(churn_risk_score > 50 AS INTEGER) + CAST(churn_risk_score > 75 AS INTEGER) AS band
  FROM (
    SELECT *, CAST(least(100, greatest(0, 20
      + list_sum([20 * CAST(declining_balance_flag AS INTEGER), 20 * CAST(reduced_activity_flag AS INTEGER),
                  15 * CAST(low_engagement_flag AS INTEGER), 15 * CAST(complaint_flag AS INTEGER), 25 * CAST(dormancy_flag AS INTEGER)])
      - 10 * list_sum([CAST(total_products_held >= 3 AS INTEGER), CAST(relationship_tenure_months > 60 AS INTEGER),
                       CAST(digital_engagement_score > 70 AS INTEGER)])
      + CASE customer_segment WHEN 'MASS_MARKET' THEN 5 WHEN 'HIGH_NET_WORTH' THEN -5 ELSE 0 END)) AS INTEGER) AS churn_risk_score
    FROM flagged{suffix}))
""", f"flagged{suffix}")
    view(f"v1{suffix}", f"""
SELECT {', '.join(S.V1_COLUMNS[:-3])}, TIMESTAMP '{scored_at}' AS score_calculated_at, {d} AS data_as_of_date, '1.0.0' AS model_version
FROM scored{suffix}
""", f"scored{suffix}")


product_views("", S.AS_OF, S.SCORED_AT)
product_views("_earlier", EARLIER, EARLIER_SCORED)
view("held_90d_ago", """
SELECT customer_id, arg_max(product_count, snapshot_date) AS products_held_90d_ago
FROM product_snapshots WHERE snapshot_date <= DATE '2001-09-01' - 90 GROUP BY customer_id
""", "product_snapshots")
view("v2", f"""
SELECT * EXCLUDE (model_version), '2.0.0' AS model_version,
  total_products_held < products_held_90d_ago AS product_downgrade_flag,
  CASE WHEN estimated_clv >= 100000 THEN 'HIGH_VALUE' WHEN estimated_clv >= 25000 THEN 'MEDIUM_VALUE' ELSE 'STANDARD' END AS clv_tier,
  CAST(least(100, greatest(0, 50
    + CASE WHEN churn_risk_score > 70 THEN 20 WHEN churn_risk_score BETWEEN 40 AND 60 THEN -20 ELSE 0 END
    + if(dormancy_flag AND declining_balance_flag, 15, 0) + if(complaint_flag AND low_engagement_flag, 10, 0)
    - if(primary_risk_driver = 'MULTI_FACTOR', 15, 0))) AS INTEGER) AS action_confidence_score,
  (digital_engagement_score < 20 AND complaint_flag AND declining_balance_flag)
    OR (relationship_tenure_months > 120 AND digital_engagement_score < 10) AS vulnerability_indicator
FROM (
  SELECT v1.*, coalesce(products_held_90d_ago, total_products_held) AS products_held_90d_ago,
    -- whole pence, rounded half away from zero in integers
    CAST(CAST(sign(total_relationship_balance) * ((2 * abs(weighted) + 1200) // 2400) AS DECIMAL(17,0)) * 0.01 AS DECIMAL(15,2)) AS estimated_clv
  FROM (SELECT *, CAST(total_relationship_balance * 100 AS HUGEINT) * (120 + least(relationship_tenure_months, 120))
          * CASE customer_segment WHEN 'HIGH_NET_WORTH' THEN 15 WHEN 'AFFLUENT' THEN 13 WHEN 'MASS_AFFLUENT' THEN 11 ELSE 10 END AS weighted
        FROM v1) v1
  LEFT JOIN held_90d_ago USING (customer_id)
)
""", "v1", "held_90d_ago")
V2_LIST = ", ".join((*S.V1_COLUMNS, *S.V2_ADDED))


def v1(spark, folder):
    return product.build_v1(banking.load(spark, folder))


def v1_earlier(spark, folder):
    return product.build_v1(banking.load(spark, folder, EARLIER), EARLIER, EARLIER_SCORED)


def snapshots(spark, folder):
    return banking.product_snapshots(banking.accounts(spark, folder), F.date_sub(F.lit(S.AS_OF), S.HISTORY_DAYS))


def spans(spark, folder):
    return banking.holding_spans(banking.accounts(spark, folder), F.date_sub(F.lit(S.AS_OF), S.HISTORY_DAYS))


def v2(spark, folder):
    return product.build_v2(banking.load(spark, folder), spans(spark, folder))


# ------------------------------------------------------------------- features
@query("account_metrics", "SELECT * FROM account_metrics", "account_metrics")
def account_metrics(spark, folder):
    return features.account_metrics(banking.accounts(spark, folder))


@query("transaction_metrics", "SELECT * FROM transaction_metrics", "transaction_metrics")
def transaction_metrics(spark, folder):
    s = banking.load(spark, folder)
    return features.transaction_metrics(s.accounts, s.transactions, S.AS_OF)


@query("txn_window_counts", """
SELECT account_id, count(*) FILTER (txn_date >= DATE '2001-06-01') AS recent,
       count(*) FILTER (txn_date < DATE '2001-06-01') AS prior, max(txn_date) AS last_seen
FROM transactions WHERE txn_date BETWEEN DATE '2001-03-01' AND DATE '2001-09-01' GROUP BY account_id
""", "transactions")
def txn_window_counts(spark, folder):
    return features.account_activity(banking.load(spark, folder).transactions, S.AS_OF)


@query("active_account_txns", """
SELECT t.txn_id, t.account_id, a.customer_id, t.txn_date, t.amount
FROM transactions t JOIN accounts a ON a.account_id = t.account_id
WHERE a.account_status = 'ACTIVE' AND t.txn_date BETWEEN DATE '2001-03-01' AND DATE '2001-09-01'
""", "transactions", "accounts")
def active_account_txns(spark, folder):
    s = banking.load(spark, folder)
    owners = features.active(s.accounts).select("account_id", "customer_id")
    return s.transactions.join(owners, "account_id").select("txn_id", "account_id", "customer_id", "txn_date", "amount")


@query("avg_monthly_txn_distinct", """
SELECT customer_id, count(DISTINCT txn_id) FILTER (txn_date >= DATE '2001-06-01') / 3 AS avg_monthly_transactions
FROM accounts LEFT JOIN (SELECT * FROM transactions WHERE txn_date <= DATE '2001-09-01') USING (account_id)
WHERE account_status = 'ACTIVE' GROUP BY customer_id
""", "accounts", "transactions")
def avg_monthly_txn_distinct(spark, folder):
    s = banking.load(spark, folder)
    return features.distinct_monthly_average(s.accounts, s.transactions, S.AS_OF)


@query("latest_engagement", "SELECT * FROM latest_engagement", "latest_engagement")
def latest_engagement(spark, folder):
    return features.latest_engagement(banking.digital_engagement(spark, folder), S.AS_OF)


@query("engagement_score", """
SELECT customer_id, login_count_30d, 2 * login_count_30d + if(mobile_app_active, 20, 0) + if(online_banking_active, 10, 0)
         + 2 * features_used_count AS engagement_points,
       least(100, 2 * login_count_30d + if(mobile_app_active, 20, 0) + if(online_banking_active, 10, 0)
         + 2 * features_used_count) AS digital_engagement_score
FROM latest_engagement
""", "latest_engagement")
def engagement_score(spark, folder):
    newest = features.latest_engagement(banking.digital_engagement(spark, folder), S.AS_OF)
    scored = newest.withColumn("engagement_points", features.engagement_points())
    return scored.select("customer_id", "login_count_30d", "engagement_points",
                         F.least(F.lit(S.SCORE_MAX), "engagement_points").alias("digital_engagement_score"))


@query("complaint_metrics", "SELECT * FROM complaint_metrics", "complaint_metrics")
def complaint_metrics(spark, folder):
    return features.complaint_metrics(banking.load(spark, folder).complaints, S.AS_OF)


@query("customer_features", "SELECT * FROM features", "features")
def customer_features(spark, folder):
    return features.customer_features(banking.load(spark, folder), S.AS_OF)


@query("txn_trend", """
SELECT customer_id, txn_count_recent_3m, txn_count_prior_3m, transaction_trend FROM features
""", "features")
def txn_trend(spark, folder):
    return features.customer_features(banking.load(spark, folder), S.AS_OF).select(
        "customer_id", "txn_count_recent_3m", "txn_count_prior_3m", "transaction_trend")


# -------------------------------------------------------------------- scoring
def _scored(spark, folder):
    return product.scored_customers(banking.load(spark, folder), S.AS_OF)


FLAG_LIST = "customer_id, has_unresolved_complaint, " + ", ".join(S.FLAGS)


@query("risk_flags", f"SELECT {FLAG_LIST} FROM flagged", "flagged")
def risk_flags(spark, folder):
    flagged = scoring.with_risk_flags(features.customer_features(banking.load(spark, folder), S.AS_OF))
    return flagged.select(*FLAG_LIST.split(", "))


@query("reduced_activity_ratio70", """
SELECT reduced_activity_flag AS by_trend, 10 * txn_count_recent_3m < 7 * txn_count_prior_3m AS by_ratio70, count(*) AS customers
FROM flagged GROUP BY ALL
""", "flagged")
def reduced_activity_ratio70(spark, folder):
    frame = features.customer_features(banking.load(spark, folder), S.AS_OF)
    return frame.groupBy(
        scoring.reduced_activity("trend").alias("by_trend"), scoring.reduced_activity("ratio70").alias("by_ratio70"),
    ).agg(F.count("*").alias("customers"))


@query("churn_score", "SELECT customer_id, churn_risk_score, risk_tier FROM scored", "scored")
def churn_score(spark, folder):
    return _scored(spark, folder).select("customer_id", "churn_risk_score", "risk_tier")


@query("primary_driver", "SELECT customer_id, primary_risk_driver FROM scored", "scored")
def primary_driver(spark, folder):
    return _scored(spark, folder).select("customer_id", "primary_risk_driver")


@query("risk_drivers_json_fields", """
SELECT customer_id, declining_balance_flag AS balance_flag, total_relationship_balance AS balance,
       transaction_trend AS trend, digital_engagement_score AS engagement,
       open_complaints_count AS open_count, complaints_last_12m AS total_12m, days_since_last_transaction AS days_inactive
FROM scored
""", "scored")
def risk_drivers_json_fields(spark, folder):
    detail = F.parse_json("risk_drivers_json")
    field = lambda path, kind: F.variant_get(detail, path, kind)
    return _scored(spark, folder).select(
        "customer_id",
        field("$.declining_balance.flag", "boolean").alias("balance_flag"),
        field("$.declining_balance.balance", "decimal(15,2)").alias("balance"),
        field("$.reduced_activity.trend", "string").alias("trend"),
        field("$.low_engagement.score", "int").alias("engagement"),
        field("$.complaints.open_count", "int").alias("open_count"),
        field("$.complaints.total_12m", "int").alias("total_12m"),
        field("$.dormancy.days_inactive", "int").alias("days_inactive"),
    )


@query("interventions", "SELECT customer_id, recommended_intervention, intervention_priority FROM scored", "scored")
def interventions(spark, folder):
    return _scored(spark, folder).select("customer_id", "recommended_intervention", "intervention_priority")


query("churn_product_v1", "SELECT * FROM v1", "v1")(v1)


# ------------------------------------------------------------------ version 2
query("churn_product_v2", f"SELECT {V2_LIST} FROM v2", "v2")(v2)


@query("products_90d_ago", "SELECT * FROM held_90d_ago", "held_90d_ago")
def products_90d_ago(spark, folder):
    """Customers with holdings 90 days ago: an as-of join of one probe per customer over the spans of changes."""
    held = spans(spark, folder)
    customers = held.select("customer_id").distinct()
    return scoring.products_held_as_of(customers, held, S.AS_OF).where(F.col("products_held_90d_ago").isNotNull())


@query("product_downgrade", """
SELECT customer_id, total_products_held, products_held_90d_ago, product_downgrade_flag FROM v2
""", "v2")
def product_downgrade(spark, folder):
    frame = features.customer_features(banking.load(spark, folder), S.AS_OF)
    return scoring.with_downgrade_as_of(frame, spans(spark, folder), S.AS_OF).select(
        "customer_id", "total_products_held", "products_held_90d_ago", "product_downgrade_flag")


@query("clv", "SELECT customer_id, estimated_clv, clv_tier FROM v2", "v2")
def clv(spark, folder):
    frame = features.customer_features(banking.load(spark, folder), S.AS_OF)
    return scoring.with_lifetime_value(frame).select("customer_id", "estimated_clv", "clv_tier")


@query("action_confidence", "SELECT customer_id, churn_risk_score, action_confidence_score FROM v2", "v2")
def action_confidence(spark, folder):
    return scoring.with_confidence(_scored(spark, folder)).select("customer_id", "churn_risk_score", "action_confidence_score")


@query("vulnerability", "SELECT customer_id, vulnerability_indicator FROM v2", "v2")
def vulnerability(spark, folder):
    return scoring.with_vulnerability(_scored(spark, folder)).select("customer_id", "vulnerability_indicator")


@query("balance_trend_90d", """
SELECT customer_id, balance_now, balance_before,
  CASE WHEN 10 * (balance_now - balance_before) > abs(balance_before) THEN 'GROWING'
       WHEN 10 * (balance_before - balance_now) > abs(balance_before) THEN 'DECLINING' ELSE 'STABLE' END AS balance_trend_90d
FROM (
  SELECT customer_id,
    CAST(coalesce(sum(amount) FILTER (txn_date <= DATE '2001-09-01'), 0) AS DECIMAL(25,2)) AS balance_now,
    CAST(coalesce(sum(amount) FILTER (txn_date <= DATE '2001-09-01' - 90), 0) AS DECIMAL(25,2)) AS balance_before
  FROM accounts LEFT JOIN transactions USING (account_id) GROUP BY customer_id)
""", "accounts", "transactions")
def balance_trend_90d(spark, folder):
    history = banking.transactions(spark, folder, until=S.AS_OF)
    return scoring.balance_trend_over(history, banking.accounts(spark, folder), S.AS_OF)


# ------------------------------------------------------------------ evolution
#: Buckets of the stored product: a refresh rewrites only those its changed keys fall into.
PRODUCT_BUCKETS = 64
COMPARED = [c for c in S.V1_COLUMNS if c not in ("customer_id", "score_calculated_at", "model_version")]


def _differs(new: str, old: str) -> str:
    return " OR ".join(f"{new}.{c} IS DISTINCT FROM {old}.{c}" for c in COMPARED)


@query("incremental_upsert", f"""
SELECT n.* FROM v1 n LEFT JOIN v1_earlier o ON n.customer_id = o.customer_id
WHERE o.customer_id IS NULL OR {_differs("n", "o")}
UNION ALL
SELECT o.* FROM v1_earlier o LEFT JOIN v1 n ON n.customer_id = o.customer_id
WHERE n.customer_id IS NULL OR NOT ({_differs("n", "o")})
""", "v1", "v1_earlier")
def incremental_upsert(spark, folder):
    """Last month's stored product refreshed in place with every customer of whom anything changed since.

    The product is stored partitioned by key bucket; only buckets holding a changed customer are rewritten.
    """
    path = run_dir(spark, "product")
    versions.write_bucketed(v1_earlier(spark, folder), path, "customer_id", PRODUCT_BUCKETS)
    current = spark.read.parquet(path).drop(versions.BUCKET)
    changed = stored(versions.changed_rows(v1(spark, folder), current, "customer_id", COMPARED), "changed-customers")
    versions.refresh_buckets(path, changed, "customer_id", PRODUCT_BUCKETS)
    return spark.read.parquet(path).drop(versions.BUCKET)


SNAPSHOT = (S.V1, S.SCORED_AT, "before version 2.0.0")


@query("version_snapshot", """
SELECT *, '1.0.0' AS snapshot_version, TIMESTAMP '2001-09-01 06:00:00' AS snapshot_at,
       'before version 2.0.0' AS snapshot_reason FROM v1
""", "v1")
def version_snapshot(spark, folder):
    """Written once and read back; the second write must leave the first copy alone."""
    path = run_dir(spark, "snapshot")
    snapshot_once(v1(spark, folder), path, *SNAPSHOT)
    snapshot_once(spark.createDataFrame([], "customer_id bigint"), path, S.V2, S.SCORED_AT, "must not replace the first")
    return spark.read.parquet(path)


@query("version_compare", """
SELECT 'v1.0 (Snapshot)' AS version, count(*) AS row_count, 35 AS column_count, TIMESTAMP '2001-09-01 06:00:00' AS as_of FROM v1
UNION ALL SELECT 'v2.0 (Current)', count(*), 38, max(score_calculated_at) FROM v2
""", "v1", "v2")
def version_compare(spark, folder):
    from keelmark.sources.tables import snapshot_columns
    kept = snapshot_columns(v1(spark, folder), *SNAPSHOT)
    return versions.version_summary(kept, "v1.0 (Snapshot)", "snapshot_at").unionByName(
        versions.version_summary(v2(spark, folder), "v2.0 (Current)", "score_calculated_at"))


@query("backward_compat_diff", "SELECT 'missing rows' AS check_type, 'customer_id' AS column_name, count(*) FILTER (b.customer_id IS NULL) AS row_count "
       "FROM v1 a FULL JOIN v2 b USING (customer_id) UNION ALL "
       "SELECT 'added rows', 'customer_id', count(*) FILTER (a.customer_id IS NULL) FROM v1 a FULL JOIN v2 b USING (customer_id) UNION ALL "
       + " UNION ALL ".join(
           f"SELECT 'changed values', '{c}', count(*) FILTER (a.{c} IS DISTINCT FROM b.{c}) FROM v1 a JOIN v2 b USING (customer_id)"
           for c in COMPARED), "v1", "v2")
def backward_compat_diff(spark, folder):
    return versions.column_differences(v1(spark, folder), v2(spark, folder), "customer_id", COMPARED)


@query("release_diff", "SELECT 'missing rows' AS check_type, 'customer_id' AS column_name, count(*) FILTER (b.customer_id IS NULL) AS row_count "
       "FROM v1_earlier a FULL JOIN v1 b USING (customer_id) UNION ALL "
       "SELECT 'added rows', 'customer_id', count(*) FILTER (a.customer_id IS NULL) FROM v1_earlier a FULL JOIN v1 b USING (customer_id) UNION ALL "
       + " UNION ALL ".join(
           f"SELECT 'changed values', '{c}', count(*) FILTER (a.{c} IS DISTINCT FROM b.{c}) FROM v1_earlier a JOIN v1 b USING (customer_id)"
           for c in COMPARED), "v1", "v1_earlier")
def release_diff(spark, folder):
    """The same comparison between two refreshes a month apart, where values do change."""
    return versions.column_differences(v1_earlier(spark, folder), v1(spark, folder), "customer_id", COMPARED)
