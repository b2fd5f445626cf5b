"""The enterprise model: fields, types, nullability, personal-data marks and value domains."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelmark.functions.columns import text, to_rows

# ---------------------------------------------------------------- fixed values
# name type [?]: a question mark allows nulls.
FIELDS = {
    "customers": """
        customer_id string, customer_name string, email string?, phone string?, date_of_birth date?,
        customer_segment string, region string, onboarding_channel string?, onboarding_date date,
        kyc_status string, created_at timestamp_ntz, updated_at timestamp_ntz""",
    "accounts": """
        account_id string, customer_id string, account_type string, product_name string, account_status string,
        opened_date date, closed_date date?, current_balance decimal(15;2), available_balance decimal(15;2),
        overdraft_limit decimal(15;2), interest_rate decimal(5;4)?, branch_code string?,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "transactions": """
        txn_id string, account_id string, txn_date date, txn_timestamp timestamp_ntz, txn_type string,
        txn_category string?, amount decimal(15;2), balance_after decimal(15;2)?, channel string?,
        merchant_category string?, description string?, created_at timestamp_ntz""",
    "digital_engagement": """
        engagement_id string, customer_id string, measurement_date date, login_count_30d int,
        mobile_app_active boolean, online_banking_active boolean, last_login_date date?, last_login_channel string?,
        session_count_30d int, avg_session_minutes decimal(5;1), features_used_count int,
        push_notifications_enabled boolean, created_at timestamp_ntz, updated_at timestamp_ntz""",
    "complaints": """
        complaint_id string, customer_id string, complaint_date date, category string, subcategory string?,
        channel string?, severity string, status string, resolution_date date?, resolution_type string?,
        escalated boolean, compensation_amount decimal(10;2)?, root_cause string?, description string?,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
}
DOMAINS = {
    "customers": {
        "customer_segment": ("MASS_MARKET", "MASS_AFFLUENT", "AFFLUENT", "HIGH_NET_WORTH"),
        "onboarding_channel": ("BRANCH", "ONLINE", "MOBILE_APP", "REFERRAL", "PARTNERSHIP"),
        "kyc_status": ("VERIFIED", "PENDING_REVIEW", "FAILED"),
    },
    "accounts": {
        "account_type": ("CURRENT_ACCOUNT", "SAVINGS_ACCOUNT", "CREDIT_CARD", "LOAN", "ISA"),
        "account_status": ("ACTIVE", "CLOSED", "SUSPENDED", "DORMANT"),
    },
    "transactions": {
        "txn_type": ("DIRECT_DEBIT", "STANDING_ORDER", "CARD_PAYMENT", "TRANSFER_OUT",
                     "TRANSFER_IN", "ATM_WITHDRAWAL", "SALARY_CREDIT", "INTEREST"),
        "txn_category": ("GROCERIES", "UTILITIES", "ENTERTAINMENT", "TRANSPORT", "DINING",
                         "SHOPPING", "HEALTHCARE", "INSURANCE", "SUBSCRIPTIONS", "OTHER"),
        "channel": ("MOBILE_APP", "ONLINE", "BRANCH", "ATM", "MERCHANT", "AUTO"),
    },
    "digital_engagement": {"last_login_channel": ("MOBILE_APP", "ONLINE_BANKING")},
    "complaints": {
        "category": ("SERVICE_QUALITY", "FEES_AND_CHARGES", "PRODUCT_ISSUE", "DIGITAL_BANKING",
                     "FRAUD_DISPUTE", "COMMUNICATION", "WAITING_TIME"),
        "channel": ("BRANCH", "PHONE", "EMAIL", "MOBILE_APP", "SOCIAL_MEDIA", "LETTER"),
        "severity": ("CRITICAL", "HIGH", "MEDIUM", "LOW"),
        "status": ("OPEN", "RESOLVED", "ESCALATED", "WITHDRAWN"),
        "resolution_type": ("APOLOGY", "REFUND", "PROCESS_CHANGE", "COMPENSATION", "EXPLANATION"),
        "root_cause": ("Human Error", "System Issue", "Process Gap", "Third Party", "Customer Misunderstanding"),
    },
}
DEFAULTS = {
    "customers": {"kyc_status": "VERIFIED"},
    "accounts": {"current_balance": 0, "available_balance": 0, "overdraft_limit": 0},
    "digital_engagement": {
        "login_count_30d": 0, "mobile_app_active": False, "online_banking_active": False,
        "session_count_30d": 0, "avg_session_minutes": 0, "features_used_count": 0, "push_notifications_enabled": True,
    },
    "complaints": {"escalated": False},
}
PERSONAL = {"customers": ("customer_name", "email", "phone", "date_of_birth")}
# ------------------------------------------------------------ end fixed values


def schema_of(entity: str) -> T.StructType:
    """Declared schema; domains and personal-data marks travel as field metadata."""
    fields = []
    for declaration in FIELDS[entity].replace("\n", " ").split(","):
        name, kind = declaration.split()
        metadata: dict = {}
        if name in DOMAINS.get(entity, {}):
            metadata["domain"] = list(DOMAINS[entity][name])
        if name in PERSONAL.get(entity, ()):
            metadata["pii"] = True
        data_type = T.DataType.fromDDL(kind.rstrip("?").replace(";", ","))
        fields.append(T.StructField(name, data_type, nullable=kind.endswith("?"), metadata=metadata))
    return T.StructType(fields)


def conform(df: DataFrame, entity: str) -> DataFrame:
    """Cast to the declared types and fill declared defaults.

    Values that cannot be cast become null, to be reported by the quality rules
    instead of failing the load; fields the feed lacks are added empty.
    """
    columns = []
    for field in schema_of(entity).fields:
        value = F.col(field.name).try_cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        default = DEFAULTS.get(entity, {}).get(field.name)
        if default is not None:
            value = F.coalesce(value, F.lit(default).cast(field.dataType))
        columns.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*columns)


def domain_violations(df: DataFrame, entity: str, label: str | None = None) -> DataFrame:
    """Values outside the declared domains, for every enumerated column present: one aggregate."""
    checked = {c: d for c, d in DOMAINS.get(entity, {}).items() if c in df.columns}
    measures = [F.count("*").alias("row_count")]
    for column, domain in checked.items():
        measures.append(F.count_if(~F.col(column).isin(*domain)).alias(f"{column}__bad"))
        measures.append(F.count_if(F.col(column).isNull()).alias(f"{column}__null"))
    rows = [
        (text(label or entity), text(column), f"{column}__bad", f"{column}__null", "row_count")
        for column in checked
    ]
    return to_rows(df.agg(*measures), rows, ("entity", "column_name", "violations", "nulls", "row_count"))
