"""Values the churn-risk product is defined by.

Everything below is a *fixed value*: scores, tiers, labels and limits must be
exactly these for results to be right. Code elsewhere reads them from here.
"""

from datetime import date, datetime

# ---------------------------------------------------------------- fixed values
PRODUCT = "CHURN_RISK"
V1, V2 = "1.0.0", "2.0.0"

# Enumerations, in their natural order.
SEGMENTS = ("MASS_MARKET", "MASS_AFFLUENT", "AFFLUENT", "HIGH_NET_WORTH")
TRENDS = ("INCREASING", "STABLE", "DECLINING", "SEVERELY_DECLINING")
TIERS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
DRIVERS = (
    "BALANCE_DECLINE", "ACTIVITY_REDUCTION", "LOW_ENGAGEMENT",
    "COMPLAINTS", "DORMANCY", "MULTI_FACTOR", "NONE",
)
INTERVENTIONS = (
    "NO_ACTION", "DIGITAL_ENGAGEMENT", "RELATIONSHIP_CALL",
    "BRANCH_MEETING", "RETENTION_OFFER", "URGENT_ESCALATION",
)
CLV_TIERS = ("HIGH_VALUE", "MEDIUM_VALUE", "STANDARD")

# Windows and defaults of the features.
RECENT_MONTHS, ACTIVITY_MONTHS, COMPLAINT_MONTHS = 3, 6, 12
NO_TRANSACTION_DAYS = 999

# Transaction trend: recent count against a multiple (in tenths) of the prior count.
TREND_UP_TENTHS, TREND_FLAT_TENTHS, TREND_DOWN_TENTHS = 11, 9, 5
RATIO70_TENTHS = 7
BALANCE_STABLE_ABOVE = 1000

# Engagement score.
LOGIN_POINTS, FEATURE_POINTS, MOBILE_POINTS, ONLINE_POINTS = 2, 2, 20, 10
SCORE_MIN, SCORE_MAX = 0, 100

# Risk flags.
LOW_TOTAL_BALANCE, LOW_PRIMARY_BALANCE = 500, 100
LOW_LOGINS, REPEAT_COMPLAINTS, DORMANT_AFTER_DAYS = 3, 2, 45
FLAGS = (
    "declining_balance_flag", "reduced_activity_flag", "low_engagement_flag",
    "complaint_flag", "dormancy_flag",
)

# Churn score.
BASE_SCORE = 20
FLAG_POINTS = dict(zip(FLAGS, (20, 20, 15, 15, 25)))
MULTI_PRODUCT_FROM, LONG_TENURE_OVER, ENGAGED_OVER = 3, 60, 70
PROTECTIVE_POINTS = 10
SEGMENT_POINTS = {"MASS_MARKET": 5, "HIGH_NET_WORTH": -5}

# Tier: (name, lowest score, highest score, intervention priority).
TIER_BANDS = (("LOW", 0, 25, 4), ("MEDIUM", 26, 50, 3), ("HIGH", 51, 75, 2), ("CRITICAL", 76, 100, 1))
DORMANCY_DRIVER_DAYS = 60

# Version 2 signals.
HISTORY_DAYS = 90
CLV_TENURE_CAP = 120
CLV_SEGMENT_TENTHS = {"HIGH_NET_WORTH": 15, "AFFLUENT": 13, "MASS_AFFLUENT": 11}
CLV_HIGH_FROM, CLV_MEDIUM_FROM = 100_000, 25_000
CONFIDENCE_BASE = 50
VULNERABLE_ENGAGEMENT, EXCLUDED_ENGAGEMENT, EXCLUDED_TENURE = 20, 10, 120
BALANCE_CHANGE_PERCENT = 10

# Output columns of version 1, in order, and the additions of version 2.
V1_COLUMNS = (
    "customer_id", "customer_name", "customer_segment", "region",
    "relationship_tenure_months", "total_products_held",
    "primary_account_balance", "total_relationship_balance",
    "avg_monthly_transactions_3m", "transaction_trend", "balance_trend",
    "days_since_last_transaction",
    "mobile_app_active", "login_count_30d", "digital_engagement_score",
    "open_complaints_count", "complaints_last_12m", "has_unresolved_complaint",
    *FLAGS,
    "churn_risk_score", "risk_tier", "primary_risk_driver", "risk_drivers_json",
    "recommended_intervention", "intervention_priority",
    "score_calculated_at", "data_as_of_date", "model_version",
)
V2_ADDED = (
    "products_held_90d_ago", "product_downgrade_flag", "estimated_clv",
    "clv_tier", "action_confidence_score", "vulnerability_indicator",
)

# Dimensions of the consumer-facing metric layer.
DIMENSIONS = (
    "customer_id", "customer_name", "customer_segment", "region",
    "risk_tier", "primary_risk_driver", "recommended_intervention", "intervention_priority",
    "transaction_trend", "balance_trend", *FLAGS,
    "has_unresolved_complaint", "mobile_app_active",
    "churn_risk_score", "total_relationship_balance", "relationship_tenure_months",
    "digital_engagement_score", "open_complaints_count", "data_as_of_date", "model_version",
)

# Service levels and quality limits.
FRESHNESS_WARN_HOURS, FRESHNESS_FAIL_HOURS = 24, 25
MINIMUM_ROWS, VALIDATION_MINIMUM_ROWS, EXPECTED_MINIMUM_ROWS = 900, 1000, 500
HIGH_RISK_LIMIT_PERCENT = 25
ROW_COUNT_CHANGE_PERCENT = 20
RETENTION_MONTHS = 84
REQUIRED_FIELDS = (
    "customer_id", "customer_name", "churn_risk_score", "risk_tier",
    "primary_risk_driver", "recommended_intervention", "score_calculated_at",
)
CARDINALITY_COLUMNS = (
    "customer_id", "risk_tier", "customer_segment", "region",
    "primary_risk_driver", "recommended_intervention",
)
AUTHORISED_ROLES = (
    "retention_analyst", "branch_manager", "customer_analytics",
    "compliance_officer", "data_science_team",
)
MASK_SUFFIX = "****"

# Labels of the monitoring reports.
LABEL = {
    "within_sla": "✅ WITHIN SLA", "sla_breach": "❌ SLA BREACH",
    "ok": "✅ OK", "breach": "❌ BREACH",
    "changed": "⚠️ SIGNIFICANT CHANGE", "stable": "✅ STABLE",
    "available": "✅ AVAILABLE", "unavailable": "❌ UNAVAILABLE",
    "passed": "✅ PASSED", "failed": "❌ FAILED", "unknown": "⚠️ UNKNOWN",
}
# ------------------------------------------------------------ end fixed values

# Evaluation points of the test data (both lie in the past, so every job takes
# its "now" as a parameter).
AS_OF = date(2001, 9, 1)
SCORED_AT = datetime(2001, 9, 1, 6, 0, 0)
MONITOR_AT = datetime(2024, 1, 31, 0, 0, 0)
