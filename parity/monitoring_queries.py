"""Reliability, quality and adoption reports."""

from keelmark import settings as S
from keelmark.operators import monitoring
from keelmark.sources import monitoring as sources
from parity.product_queries import v1
from parity.quality_queries import CHECKS
from parity.registry import query, view

AT = S.MONITOR_AT
NOW = f"TIMESTAMP '{AT}'"

view("metric_history", """
SELECT table_name, measurement_time, unnest([
  {'metric_name': 'ROW_COUNT', 'column_name': '*', 'value': n},
  {'metric_name': 'FRESHNESS', 'column_name': 'ts', 'value': (epoch_us(measurement_time) - epoch_us(newest)) // 1000000},
  {'metric_name': 'NULL_COUNT', 'column_name': 'value', 'value': low}], recursive := true)
FROM (SELECT event_type AS table_name, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS measurement_time,
             count(*) AS n, max(ts) AS newest, count(*) FILTER (value < 1) AS low
      FROM events GROUP BY 1, 2)
""")
view("expectation_status", """
SELECT table_name, measurement_time, metric_name, value AS metric_value,
       CASE metric_name WHEN 'FRESHNESS' THEN 'freshness_sla' WHEN 'NULL_COUNT' THEN 'no_null_value' ELSE 'min_row_count' END AS expectation_name,
       CASE metric_name WHEN 'FRESHNESS' THEN value > 1800 WHEN 'NULL_COUNT' THEN value > 0 ELSE value < 60 END AS expectation_violated
FROM metric_history
""", "metric_history")
view("access_history", """
SELECT event_id AS access_id, ts AS query_start_time, 'user_' || user_id AS user_name, event_type AS role_name,
  CASE event_type WHEN 'purchase' THEN 'CREATE VIEW v AS SELECT * FROM ' || first WHEN 'signup' THEN 'insert into t select * from ' || lower(first)
                  ELSE 'SELECT * FROM ' || first END AS query_text,
  CASE WHEN event_id % 2 = 1 THEN [{'objectName': first, 'objectDomain': 'Table', 'columns': cols}, {'objectName': second, 'objectDomain': 'Table', 'columns': cols}]
       ELSE [{'objectName': first, 'objectDomain': 'Table', 'columns': cols}] END AS direct_objects_accessed,
  CASE WHEN event_id % 4 = 3 THEN [first, 'CUSTOMERS'] ELSE ['CHURN_RISK', first] END AS base_objects_accessed
FROM (SELECT *, names[1 + event_id % 5] AS first, names[1 + (event_id // 5) % 5] AS second,
             ['customer_id', ['risk_tier', 'churn_risk_score', 'region'][1 + event_id % 3]] AS cols
      FROM (SELECT *, ['CHURN_RISK', 'CUSTOMERS', 'ACCOUNTS', 'TRANSACTIONS', 'COMPLAINTS'] AS names FROM events))
""")
_SINCE = lambda interval: f"query_start_time > {NOW} - INTERVAL {interval} AND query_start_time <= {NOW}"
_PRODUCT_USE = lambda interval: f"SELECT * FROM access_history WHERE {_SINCE(interval)} AND list_contains(base_objects_accessed, 'CHURN_RISK')"
view("used_30d", _PRODUCT_USE("30 DAY"), "access_history")
view("used_7d", _PRODUCT_USE("7 DAY"), "access_history")
view("used_1d", _PRODUCT_USE("1 DAY"), "access_history")


def history(spark, folder):
    return sources.metric_history(spark, folder)


def status(spark, folder):
    return sources.expectation_status(history(spark, folder))


def access(spark, folder):
    return sources.access_history(spark, folder)


query("src_metric_history", "SELECT * FROM metric_history", "metric_history")(history)
query("src_expectation_status", "SELECT * FROM expectation_status", "expectation_status")(status)


@query("src_access_history", """
SELECT access_id, query_start_time, user_name, role_name, query_text, len(direct_objects_accessed) AS objects,
       array_to_string([o.objectName || ':' || array_to_string(o.columns, ',') for o in direct_objects_accessed], ';') AS touched,
       array_to_string(base_objects_accessed, ',') AS base_objects
FROM access_history
""", "access_history")
def src_access_history(spark, folder):
    return access(spark, folder).selectExpr(
        "access_id", "query_start_time", "user_name", "role_name", "query_text",
        "CAST(size(direct_objects_accessed) AS BIGINT) AS objects",
        "array_join(transform(direct_objects_accessed, o -> concat(o.objectName, ':', array_join(o.columns, ','))), ';') AS touched",
        "array_join(base_objects_accessed, ',') AS base_objects")


# ---------------------------------------------------------------- reliability
@query("freshness_status", " UNION ALL ".join(f"""
SELECT 'FRESHNESS CHECK' AS check_type, TIMESTAMP '{t}' AS check_time, date_diff('hour', m, TIMESTAMP '{t}') AS hours_since_refresh,
       if(date_diff('hour', m, TIMESTAMP '{t}') <= 24, '{S.LABEL["within_sla"]}', '{S.LABEL["sla_breach"]}') AS sla_status,
       m AS last_refresh, '24 hours' AS sla_target
FROM (SELECT max(score_calculated_at) AS m FROM v1)""" for t in CHECKS), "v1")
def freshness_status(spark, folder):
    return monitoring.freshness_status(v1(spark, folder), CHECKS)


@query("freshness_history", f"""
SELECT table_name, date_trunc('hour', measurement_time) AS check_time, value AS freshness_seconds,
       CAST(CAST((2 * 10 * value + 3600) // 7200 AS DECIMAL(17,0)) * 0.1 AS DECIMAL(18,1)) AS freshness_hours,
       if(value <= 86400, '{S.LABEL["ok"]}', '{S.LABEL["breach"]}') AS status
FROM metric_history WHERE metric_name = 'FRESHNESS'
QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY measurement_time DESC) <= 48
""", "metric_history")
def freshness_history(spark, folder):
    return monitoring.freshness_history(history(spark, folder))


view("counts_with_previous", """
SELECT *, lag(value) OVER (PARTITION BY table_name ORDER BY measurement_time) AS previous
FROM metric_history WHERE metric_name = 'ROW_COUNT'
""", "metric_history")


@query("row_count_stability", f"""
SELECT table_name, date_trunc('hour', measurement_time) AS check_time, value AS row_count, previous AS prev_row_count,
       round((value - previous) / nullif(previous, 0) * 100, 1) AS pct_change,
       CASE WHEN abs((value - previous) / nullif(previous, 0) * 100) > 20 THEN '{S.LABEL["changed"]}' ELSE '{S.LABEL["stable"]}' END AS status
FROM counts_with_previous
QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY measurement_time DESC) <= 20
""", "counts_with_previous")
def row_count_stability(spark, folder):
    return monitoring.row_count_stability(history(spark, folder))


@query("availability", f"""
SELECT 'CHURN_RISK' AS table_name, count(*) AS current_row_count, max(data_as_of_date) AS data_as_of, max(score_calculated_at) AS last_calculated,
       if(count(*) > 0, '{S.LABEL["available"]}', '{S.LABEL["unavailable"]}') AS availability FROM v1
""", "v1")
def availability(spark, folder):
    return monitoring.availability(v1(spark, folder))


# -------------------------------------------------------------------- quality
@query("expectation_status", f"""
SELECT table_name, expectation_name, if(expectation_violated, '{S.LABEL["failed"]}', '{S.LABEL["passed"]}') AS status, metric_name, metric_value, measurement_time
FROM expectation_status
QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY measurement_time DESC, expectation_name) <= 50
""", "expectation_status")
def expectation_status(spark, folder):
    return monitoring.expectation_report(status(spark, folder))


@query("latest_metrics", """
SELECT table_name, metric_name, column_name AS columns, value AS current_value, measurement_time AS last_checked
FROM metric_history h WHERE measurement_time = (SELECT max(measurement_time) FROM metric_history i WHERE i.table_name = h.table_name)
""", "metric_history")
def latest_metrics(spark, folder):
    return monitoring.latest_metrics(history(spark, folder))


@query("metric_results", """
SELECT measurement_time, metric_name, table_name, column_name, value FROM metric_history
ORDER BY measurement_time DESC, table_name, metric_name LIMIT 100
""", "metric_history")
def metric_results(spark, folder):
    return monitoring.metric_results(history(spark, folder))


@query("failed_expectations_daily", """
SELECT table_name, CAST(measurement_time AS DATE) AS date, expectation_name, expectation_violated, metric_value, count(*) AS occurrence_count
FROM expectation_status WHERE expectation_violated GROUP BY ALL
""", "expectation_status")
def failed_expectations_daily(spark, folder):
    return monitoring.failed_expectations(status(spark, folder))


# ------------------------------------------------------------------- adoption
@query("upstream_lineage", """
SELECT DISTINCT o.objectName AS source_object, o.objectDomain AS source_type, 'CHURN_RISK' AS target_table
FROM (SELECT unnest(direct_objects_accessed) AS o FROM used_7d) ORDER BY 1, 2 LIMIT 20
""", "used_7d")
def upstream_lineage(spark, folder):
    return monitoring.upstream_lineage(access(spark, folder), AT)


@query("usage_by_role", """
SELECT role_name, count(*) AS query_count, count(DISTINCT user_name) AS unique_users,
       count(DISTINCT CAST(query_start_time AS DATE)) AS active_days, min(query_start_time) AS first_access, max(query_start_time) AS last_access
FROM used_30d GROUP BY role_name
""", "used_30d")
def usage_by_role(spark, folder):
    return monitoring.usage_by_role(access(spark, folder), AT)


@query("usage_by_user", f"""
SELECT user_name, role_name, count(*) AS query_count, max(query_start_time) AS last_access,
       CAST(date_diff('day', max(query_start_time), {NOW}) AS INTEGER) AS days_since_last_access
FROM used_30d GROUP BY user_name, role_name ORDER BY query_count DESC, user_name, role_name LIMIT 20
""", "used_30d")
def usage_by_user(spark, folder):
    return monitoring.usage_by_user(access(spark, folder), AT)


@query("usage_daily", """
SELECT CAST(query_start_time AS DATE) AS date, count(*) AS query_count, count(DISTINCT user_name) AS unique_users, count(DISTINCT role_name) AS unique_roles
FROM used_30d GROUP BY 1
""", "used_30d")
def usage_daily(spark, folder):
    return monitoring.usage_daily(access(spark, folder), AT)


@query("column_usage", f"""
SELECT o.objectName AS accessed_object, array_to_string(o.columns, ',') AS columns_accessed, count(*) AS access_count
FROM (SELECT unnest(direct_objects_accessed) AS o FROM access_history WHERE {_SINCE('7 DAY')})
WHERE o.objectName LIKE '%CHURN_RISK%' GROUP BY 1, 2 ORDER BY access_count DESC, 1, 2 LIMIT 20
""", "access_history")
def column_usage(spark, folder):
    return monitoring.column_usage(access(spark, folder), AT)


@query("downstream_dependencies", """
SELECT DISTINCT query_text, user_name, role_name, query_start_time FROM used_7d
WHERE regexp_matches(upper(query_text), 'CREATE.*(VIEW|TABLE)|INSERT.*INTO')
ORDER BY query_start_time DESC, user_name, role_name, query_text LIMIT 10
""", "used_7d")
def downstream_dependencies(spark, folder):
    return monitoring.downstream_dependencies(access(spark, folder), AT)


# --------------------------------------------------------------------- alerts
@query("alert_freshness", " UNION ALL ".join(
    f"SELECT TIMESTAMP '{t}' AS check_time, coalesce(bool_or(date_diff('hour', score_calculated_at, TIMESTAMP '{t}') > 24), false) AS triggered FROM v1"
    for t in CHECKS), "v1")
def alert_freshness(spark, folder):
    return monitoring.freshness_alert(v1(spark, folder), CHECKS)


@query("alert_expectation", f"""
SELECT count(*) FILTER (expectation_violated) > 0 AS triggered, count(*) FILTER (expectation_violated) AS violations
FROM expectation_status WHERE measurement_time > {NOW} - INTERVAL 1 HOUR AND measurement_time <= {NOW}
""", "expectation_status")
def alert_expectation(spark, folder):
    return monitoring.expectation_alert(status(spark, folder), AT)


@query("alert_row_count_drop", """
SELECT table_name, bool_or(previous IS NOT NULL AND previous > 0 AND (previous - value) * 5 > previous) AS triggered
FROM (SELECT * FROM counts_with_previous QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY measurement_time DESC) <= 2)
GROUP BY table_name
""", "counts_with_previous")
def alert_row_count_drop(spark, folder):
    return monitoring.row_count_drop_alert(history(spark, folder))


_RECENT = f"metric_history WHERE measurement_time > {NOW} - INTERVAL 24 HOUR AND measurement_time <= {NOW}"


@query("alert_dq_thresholds", " UNION ALL ".join(
    f"SELECT '{name}' AS alert_name, count(*) FILTER ({condition}) AS measurements, count(*) FILTER ({condition}) > 0 AS triggered FROM {_RECENT}"
    for name, condition in (
        ("null_values", "metric_name = 'NULL_COUNT' AND value > 0"), ("duplicate_keys", "metric_name = 'DUPLICATE_COUNT' AND value > 0"),
        ("low_row_count", "metric_name = 'ROW_COUNT' AND value < 60"))), "metric_history")
def alert_dq_thresholds(spark, folder):
    return monitoring.threshold_alerts(history(spark, folder), AT, minimum_rows=60)


@query("health_summary", f"""
SELECT 'CHURN_RISK' AS data_product, h AS hours_since_refresh, if(h <= 24, 'OK', 'BREACH') AS freshness_status,
       bad AS failed_expectations, n AS total_expectations, if(bad = 0, 'OK', 'ISSUES') AS quality_status,
       q AS queries_last_24h, u AS unique_users_last_24h, {NOW} AS checked_at
FROM (SELECT date_diff('hour', max(score_calculated_at), TIMESTAMP '{CHECKS[0]}') AS h FROM v1),
     (SELECT count(*) FILTER (expectation_violated) AS bad, count(*) AS n FROM expectation_status
      WHERE measurement_time > {NOW} - INTERVAL 1 HOUR AND measurement_time <= {NOW}),
     (SELECT count(*) AS q, count(DISTINCT user_name) AS u FROM used_1d)
""", "v1", "expectation_status", "used_1d")
def health_summary(spark, folder):
    return monitoring.health_summary(v1(spark, folder), status(spark, folder), access(spark, folder), CHECKS[0], AT)
