"""Scans of the sources and of the monitoring tables, and data-shaping operators."""

from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions import temporal
from keelmark.operators import features, shaping
from keelmark.sources import banking, entities
from keelmark.sources.tables import stored, table
from parity.registry import query, view

# ------------------------------------------------------------------ SQL views
view("customers", """
SELECT c_custkey AS customer_id, c_name AS customer_name,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'AFFLUENT' WHEN 'MACHINERY' THEN 'HIGH_NET_WORTH'
                         WHEN 'FURNITURE' THEN 'MASS_AFFLUENT' ELSE 'MASS_MARKET' END AS customer_segment,
       r_name AS region,
       ['BRANCH','ONLINE','MOBILE_APP','REFERRAL','PARTNERSHIP'][1 + c_custkey % 5] AS onboarding_channel,
       DATE '2001-09-01' - CAST(30 + (c_custkey * 37) % 5445 AS INTEGER) AS onboarding_date,
       CASE WHEN c_custkey % 50 = 0 THEN 'PENDING_REVIEW' ELSE 'VERIFIED' END AS kyc_status
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
view("accounts", """
SELECT o_custkey * 10 + d AS account_id, o_custkey AS customer_id, kind AS account_type,
       CASE WHEN shut THEN 'CLOSED' ELSE 'ACTIVE' END AS account_status,
       opened AS opened_date, CASE WHEN shut THEN final END AS closed_date,
       CAST(CAST(c_acctbal AS DECIMAL(15,2)) * CASE WHEN kind = 'SAVINGS_ACCOUNT' THEN 10 ELSE 1 END AS DECIMAL(15,2)) AS current_balance
FROM (
  SELECT o_custkey, d, min(od) AS opened, max(od) AS final, (o_custkey * 7 + d) % 20 = 0 AS shut,
         ['CURRENT_ACCOUNT','SAVINGS_ACCOUNT','CREDIT_CARD','LOAN','ISA'][d] AS kind
  FROM (SELECT o_custkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS d, CAST(o_orderdate AS DATE) AS od FROM orders)
  GROUP BY o_custkey, d
) LEFT JOIN customer ON c_custkey = o_custkey
""")
view("transactions", """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS txn_id,
       o_custkey * 10 + CAST(left(o_orderpriority, 1) AS INTEGER) AS account_id,
       CAST(l_shipdate AS DATE) AS txn_date,
       CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS amount,
       ['MOBILE_APP','ONLINE','BRANCH','ATM','MERCHANT','AUTO'][1 + l_linenumber % 6] AS channel
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
view("digital_engagement", """
SELECT concat_ws('-', customer_id, measurement_date) AS engagement_id, *
FROM (
  SELECT user_id * 10 + event_id % 10 AS customer_id, CAST(date_trunc('week', ts) AS DATE) - 8176 AS measurement_date,
         CAST(sum(floor(value / 10)) AS INTEGER) AS login_count_30d,
         count(*) FILTER (event_type = 'click') > 0 AS mobile_app_active,
         count(*) FILTER (event_type = 'signup') > 0 AS online_banking_active,
         CAST(count(DISTINCT event_type) AS INTEGER) AS features_used_count
  FROM events GROUP BY 1, 2)
""")
view("complaints", """
SELECT l_orderkey * 10 + l_linenumber AS complaint_id, o_custkey AS customer_id,
       CAST(l_shipdate AS DATE) AS complaint_date,
       CASE l_linestatus WHEN 'O' THEN 'OPEN' ELSE 'RESOLVED' END AS status,
       CASE WHEN l_quantity >= 50 THEN 'CRITICAL' WHEN l_quantity >= 48 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       CASE WHEN l_linestatus <> 'O' THEN CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER) END AS resolution_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R' AND l_quantity >= 45
""")
view("product_snapshots", """
SELECT customer_id, s AS snapshot_date, CAST(count(*) AS INTEGER) AS product_count
FROM accounts JOIN (
  SELECT last_day(CAST(m AS DATE)) AS s
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH) AS months(m)
) ON opened_date <= s AND (closed_date IS NULL OR closed_date > s)
GROUP BY customer_id, s
""", "accounts")

# -------------------------------------------------------------------- sources
query("src_customers", "SELECT * FROM customers", "customers")(banking.customers)
query("src_accounts", "SELECT * FROM accounts", "accounts")(banking.accounts)
query("src_transactions", "SELECT * FROM transactions", "transactions")(banking.transactions)
query("src_engagement", "SELECT * FROM digital_engagement", "digital_engagement")(banking.digital_engagement)
query("src_complaints", "SELECT * FROM complaints", "complaints")(banking.complaints)


@query("src_product_snapshots", "SELECT * FROM product_snapshots", "product_snapshots")
def src_product_snapshots(spark, folder):
    return banking.product_snapshots(banking.accounts(spark, folder), S.AS_OF)


_DOMAIN_CHECKS = (
    ("customers", "customer_segment", S.SEGMENTS), ("customers", "kyc_status", ("VERIFIED", "PENDING_REVIEW", "FAILED")),
    ("customers", "onboarding_channel", banking.ONBOARDING_CHANNELS),
    ("accounts", "account_type", banking.ACCOUNT_TYPES), ("accounts", "account_status", ("ACTIVE", "CLOSED", "SUSPENDED", "DORMANT")),
    ("transactions", "channel", banking.TXN_CHANNELS),
    ("complaints", "severity", ("CRITICAL", "HIGH", "MEDIUM", "LOW")), ("complaints", "status", ("OPEN", "RESOLVED", "ESCALATED", "WITHDRAWN")),
)


def _domain_sql() -> str:
    one = ("SELECT '{0}' AS entity, '{1}' AS column_name, count(*) FILTER ({1} NOT IN {2}) AS violations, "
           "count(*) FILTER ({1} IS NULL) AS nulls, count(*) AS row_count FROM {3}")
    parts = [one.format(entity, column, domain, entity) for entity, column, domain in _DOMAIN_CHECKS]
    # The raw market segments, not yet mapped to the declared domain.
    parts.append(one.format("customers_raw", "c_mktsegment", S.SEGMENTS, "customer").replace("'c_mktsegment'", "'customer_segment'"))
    return "\nUNION ALL ".join(parts)


@query("schema_domain_violations", _domain_sql(), "customers", "accounts", "transactions", "complaints")
def schema_domain_violations(spark, folder):
    raw = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("customer_segment"))
    checked = [
        entities.domain_violations(banking.customers(spark, folder), "customers"),
        entities.domain_violations(banking.accounts(spark, folder), "accounts"),
        entities.domain_violations(banking.transactions(spark, folder), "transactions"),
        entities.domain_violations(banking.complaints(spark, folder), "complaints"),
        entities.domain_violations(raw, "customers", label="customers_raw"),
    ]
    result = checked[0]
    for frame in checked[1:]:
        result = result.unionByName(frame)
    return result


@query("conformed_accounts", """
SELECT CAST(account_id AS VARCHAR) AS account_id, CAST(customer_id AS VARCHAR) AS customer_id, account_type,
       CAST(NULL AS VARCHAR) AS product_name, account_status, opened_date, closed_date, current_balance,
       CAST(0 AS DECIMAL(15,2)) AS available_balance, CAST(0 AS DECIMAL(15,2)) AS overdraft_limit,
       CAST(NULL AS DECIMAL(5,4)) AS interest_rate, CAST(NULL AS VARCHAR) AS branch_code,
       CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM accounts
""", "accounts")
def conformed_accounts(spark, folder):
    """The feed cast to the enterprise model: declared types, declared defaults, absent fields empty."""
    return entities.conform(banking.accounts(spark, folder), "accounts")


@query("source_volumes", "\nUNION ALL ".join(
    f"SELECT '{t}' AS source, count(*) AS row_count FROM {t}"
    for t in ("customers", "accounts", "transactions", "digital_engagement", "complaints")),
    "customers", "accounts", "transactions", "digital_engagement", "complaints")
def source_volumes(spark, folder):
    return shaping.volumes({
        "customers": banking.customers(spark, folder),
        "accounts": banking.accounts(spark, folder),
        "transactions": banking.transactions(spark, folder),
        "digital_engagement": banking.digital_engagement(spark, folder),
        "complaints": banking.complaints(spark, folder),
    })


@query("segment_distribution", "SELECT customer_segment, count(*) AS customers FROM customers GROUP BY ALL", "customers")
def segment_distribution(spark, folder):
    return banking.customers(spark, folder).groupBy("customer_segment").agg(F.count("*").alias("customers"))


# -------------------------------------------------------------------- shaping
@query("date_spine_activity", """
SELECT account_id, activity_date, count(txn_id) AS txn_count
FROM (SELECT account_id, CAST(d AS DATE) AS activity_date
      FROM accounts CROSS JOIN generate_series(TIMESTAMP '2001-08-03', TIMESTAMP '2001-09-01', INTERVAL 1 DAY) AS spine(d)
      WHERE account_status = 'ACTIVE')
LEFT JOIN (SELECT account_id, txn_date AS activity_date, txn_id FROM transactions) USING (account_id, activity_date)
GROUP BY ALL
""", "accounts", "transactions")
def date_spine_activity(spark, folder):
    until = S.AS_OF
    movements = banking.transactions(spark, folder, F.date_sub(F.lit(until), 29), until)
    return shaping.daily_activity(features.active(banking.accounts(spark, folder)), movements, until, days=30)


@query("keyed_sample", """
SELECT customer_id, customer_name, customer_segment FROM customers WHERE (customer_id * 37) % 100 < 25
""", "customers")
def keyed_sample(spark, folder):
    kept = shaping.keyed_sample(banking.customers(spark, folder), "customer_id", percent=25)
    return kept.select("customer_id", "customer_name", "customer_segment")


@query("weighted_bucket_distribution", """
SELECT CASE WHEN b < 50 THEN 'MASS_MARKET' WHEN b < 80 THEN 'MASS_AFFLUENT' WHEN b < 95 THEN 'AFFLUENT'
            ELSE 'HIGH_NET_WORTH' END AS assigned_segment, count(*) AS customers
FROM (SELECT (customer_id * 37) % 100 AS b FROM customers) GROUP BY 1
""", "customers")
def weighted_bucket_distribution(spark, folder):
    cuts = list(zip((50, 80, 95, 100), S.SEGMENTS))
    assigned = shaping.weighted_choice(F.col("customer_id"), cuts).alias("assigned_segment")
    return banking.customers(spark, folder).groupBy(assigned).agg(F.count("*").alias("customers"))


@query("row_multiplier", """
SELECT customer_id, CAST(n AS INTEGER) AS n, customer_id * 10 + n AS slot_id FROM customers CROSS JOIN range(1, 4) AS r(n)
""", "customers")
def row_multiplier(spark, folder):
    tripled = shaping.multiplied(banking.customers(spark, folder).select("customer_id"), 3)
    return tripled.withColumn("slot_id", F.col("customer_id") * 10 + F.col("n"))


@query("surrogate_keys", """
SELECT account_id, 'ACC-' || lpad(CAST(account_id AS VARCHAR), 8, '0') AS account_code,
       'CUST-' || lpad(CAST(customer_id AS VARCHAR), 6, '0') AS customer_code
FROM accounts
""", "accounts")
def surrogate_keys(spark, folder):
    return banking.accounts(spark, folder).select(
        "account_id",
        shaping.surrogate_key("ACC-", F.col("account_id"), 8).alias("account_code"),
        shaping.surrogate_key("CUST-", F.col("customer_id"), 6).alias("customer_code"))


#: Buckets of the clustered layout: both sides of a join must have the same number.
LAYOUT_BUCKETS = 16


@query("sequence_loads", """
SELECT load_name, n AS row_count, CASE WHEN n > 0 THEN (sum(n) OVER (ORDER BY load_name) - n + 1)::BIGINT END AS first_number,
       CASE WHEN n > 0 THEN (sum(n) OVER (ORDER BY load_name))::BIGINT END AS last_number, n AS distinct_numbers
FROM (
  SELECT 'opened before 1997' AS load_name, count(*) AS n FROM accounts WHERE opened_date < DATE '1997-01-01'
  UNION ALL SELECT 'opened since 1997', count(*) FROM accounts WHERE NOT (opened_date < DATE '1997-01-01') OR opened_date IS NULL)
""", "accounts")
def sequence_loads(spark, folder):
    """Two loads of accounts numbered by one sequence that continues: no gap, no repeat, no global sort."""
    from keelmark.session import run_dir

    home = run_dir(spark, "sequence")
    accounts = stored(banking.accounts(spark, folder), "accounts-to-number")
    early = F.col("opened_date") < F.lit("1997-01-01").cast("date")
    out = None
    for label, rows in (("opened before 1997", accounts.where(early)), ("opened since 1997", accounts.where(~early | F.col("opened_date").isNull()))):
        loaded = stored(shaping.continue_sequence(stored(rows, "load"), f"{home}/sequence", label), "numbered")
        summary = loaded.agg(F.count("*").alias("row_count"), F.min("seq").alias("first_number"), F.max("seq").alias("last_number"),
                             F.count_distinct("seq").alias("distinct_numbers")).select(F.lit(label).alias("load_name"), "*")
        out = summary if out is None else out.unionByName(summary)
    return out


@query("bucketed_account_activity", """
SELECT a.account_id, a.customer_id, count(t.txn_id) AS txn_count, max(t.txn_date) AS last_txn_date
FROM accounts a LEFT JOIN transactions t ON a.account_id = t.account_id
GROUP BY a.account_id, a.customer_id
""", "accounts", "transactions")
def bucketed_account_activity(spark, folder):
    """Accounts and their movements stored bucketed and sorted by account: joined and grouped without an exchange."""
    import uuid

    from keelmark.sources.tables import bucketed_table

    run = uuid.uuid4().hex[:12]
    accounts = bucketed_table(banking.accounts(spark, folder), f"accounts_by_account_{run}", "account_id", LAYOUT_BUCKETS)
    moves = bucketed_table(banking.transactions(spark, folder), f"transactions_by_account_{run}", "account_id", LAYOUT_BUCKETS, ["txn_date"])
    joined = accounts.select("account_id", "customer_id").join(moves.select("account_id", "txn_id", "txn_date"), "account_id", "left")
    return joined.groupBy("account_id", "customer_id").agg(F.count("txn_id").alias("txn_count"), F.max("txn_date").alias("last_txn_date"))


@query("scalar_function_battery", """
SELECT o_orderkey AS order_key,
       CAST(od - INTERVAL 3 MONTH AS DATE) AS three_months_before,
       od + 10 AS ten_days_after,
       o_orderdate + INTERVAL 90 SECOND AS ninety_seconds_after,
       o_orderdate - INTERVAL 5 HOUR AS five_hours_before,
       CAST(od - INTERVAL 2 YEAR AS DATE) AS two_years_before,
       CAST(date_diff('month', od, DATE '2001-09-01') AS INTEGER) AS months_old,
       CAST(date_diff('day', od, DATE '2001-09-01') AS INTEGER) AS days_old,
       CAST(date_diff('hour', o_orderdate, TIMESTAMP '2001-09-01 06:30:00') AS BIGINT) AS hours_old,
       date_trunc('hour', o_orderdate) AS order_hour,
       od AS order_day,
       least(100, CAST(o_custkey AS BIGINT)) AS capped_customer,
       greatest(50, CAST(o_custkey AS BIGINT)) AS floored_customer,
       abs(CAST(o_custkey AS BIGINT) - 500) AS distance_from_500,
       o_orderkey % 7 AS key_mod_7,
       o_orderkey / 3 AS third_of_key,
       round(CAST(o_totalprice AS DECIMAL(15,2)), 0) AS whole_price,
       lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS padded_key,
       lower(replace(o_orderpriority, '-', '.')) || '@' || left(o_orderstatus, 1) AS contact_like,
       upper(concat(o_orderstatus, '/', o_orderpriority)) AS upper_label,
       ['zero','one','two','three','four','five'][1 + CAST(left(o_orderpriority, 1) AS INTEGER)] AS digit_word,
       list_contains(['1-URGENT','2-HIGH'], o_orderpriority) AS is_pressing,
       coalesce(nullif(o_orderstatus, 'P'), 'PARTIAL') AS status_filled,
       nullif(o_custkey, 1) / nullif(o_orderkey % 7, 0) AS guarded_ratio,
       CAST('{"k":' || o_orderkey || ',"s":{"v":"' || o_orderstatus || '"}}' AS JSON) ->> '$.s.v' AS json_status,
       CAST(CAST('{"k":' || o_orderkey || '}' AS JSON) ->> '$.k' AS BIGINT) AS json_key
FROM (SELECT *, CAST(o_orderdate AS DATE) AS od FROM orders)
""")
def scalar_function_battery(spark, folder):
    ordered, key, customer = F.col("o_orderdate"), F.col("o_orderkey"), F.col("o_custkey")
    placed, priority, status = F.to_date(ordered), F.col("o_orderpriority"), F.col("o_orderstatus")
    built = F.concat(F.lit('{"k":'), key.cast("string"), F.lit(',"s":{"v":"'), status, F.lit('"}}'))
    words = F.array(*map(F.lit, ("zero", "one", "two", "three", "four", "five")))
    return table(spark, folder, "orders").select(
        key.alias("order_key"),
        F.add_months(placed, -3).alias("three_months_before"),
        F.date_add(placed, 10).alias("ten_days_after"),
        (ordered + F.expr("INTERVAL 90 SECOND")).alias("ninety_seconds_after"),
        (ordered - F.expr("INTERVAL 5 HOUR")).alias("five_hours_before"),
        F.add_months(placed, -24).alias("two_years_before"),
        temporal.months_crossed(placed, F.lit(S.AS_OF)).alias("months_old"),
        temporal.days_crossed(placed, F.lit(S.AS_OF)).alias("days_old"),
        temporal.hours_crossed(ordered, F.expr("TIMESTAMP_NTZ '2001-09-01 06:30:00'")).alias("hours_old"),
        temporal.hour_of(ordered).alias("order_hour"),
        placed.alias("order_day"),
        F.least(F.lit(100), customer).alias("capped_customer"),
        F.greatest(F.lit(50), customer).alias("floored_customer"),
        F.abs(customer - 500).alias("distance_from_500"),
        F.pmod(key, F.lit(7)).alias("key_mod_7"),
        (key / 3).alias("third_of_key"),
        F.round(F.col("o_totalprice").cast("decimal(15,2)"), 0).cast("decimal(15,0)").alias("whole_price"),
        F.lpad(key.cast("string"), 10, "0").alias("padded_key"),
        F.concat(F.lower(F.replace(priority, F.lit("-"), F.lit("."))), F.lit("@"), F.left(status, F.lit(1))).alias("contact_like"),
        F.upper(F.concat(status, F.lit("/"), priority)).alias("upper_label"),
        F.element_at(words, F.left(priority, F.lit(1)).cast("int") + 1).alias("digit_word"),
        F.array_contains(F.array(F.lit("1-URGENT"), F.lit("2-HIGH")), priority).alias("is_pressing"),
        F.coalesce(F.nullif(status, F.lit("P")), F.lit("PARTIAL")).alias("status_filled"),
        (F.nullif(customer, F.lit(1)) / F.nullif(F.pmod(key, F.lit(7)), F.lit(0))).alias("guarded_ratio"),
        F.variant_get(F.parse_json(built), "$.s.v", "string").alias("json_status"),
        F.get_json_object(built, "$.k").cast("bigint").alias("json_key"),
    )
