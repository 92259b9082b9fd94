"""Typed catalog of the nine core tables (S8) and the raw customer CSV contract.

Money and measures are ``DecimalType(10,2)`` / ``(12,2)`` as in the relational
schema, so sums are exact and every engine agrees on them; results are cast to
double at the edge.  Spark does not enforce keys, ranges or nullability: the
rules below are data for the audits in :mod:`churnlab.operators.quality`.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
BIG_MONEY = T.DecimalType(12, 2)


def _fields(*spec: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in spec])


# The nine tables of the relational schema (names, columns, types).
CUSTOMERS = _fields(
    ("customer_id", T.LongType()),
    ("gender", T.StringType()),
    ("senior_citizen", T.BooleanType()),
    ("has_partner", T.BooleanType()),
    ("has_dependents", T.BooleanType()),
    ("tenure_months", T.LongType()),
    ("phone_service", T.BooleanType()),
    ("multiple_lines", T.StringType()),
    ("internet_service", T.StringType()),
    ("online_security", T.StringType()),
    ("online_backup", T.StringType()),
    ("device_protection", T.StringType()),
    ("tech_support", T.StringType()),
    ("streaming_tv", T.StringType()),
    ("streaming_movies", T.StringType()),
    ("contract_type", T.StringType()),
    ("paperless_billing", T.BooleanType()),
    ("payment_method", T.StringType()),
    ("monthly_charges", MONEY),
    ("total_charges", BIG_MONEY),
    ("churned", T.BooleanType()),
    ("source_system", T.StringType()),
    ("is_synthetic", T.BooleanType()),
)

FIXED_SUBSCRIPTIONS = _fields(
    ("fixed_subscription_id", T.StringType()),
    ("customer_id", T.LongType()),
    ("service_type", T.StringType()),
    ("plan_name", T.StringType()),
    ("download_speed_mbps", T.IntegerType()),
    ("contract_type", T.StringType()),
    ("monthly_recurring_revenue", MONEY),
    ("subscription_status", T.StringType()),
    ("is_synthetic", T.BooleanType()),
)

MOBILE_SUBSCRIPTIONS = _fields(
    ("mobile_subscription_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("service_type", T.StringType()),
    ("plan_name", T.StringType()),
    ("line_count", T.IntegerType()),
    ("is_5g_enabled", T.BooleanType()),
    ("monthly_recurring_revenue", MONEY),
    ("subscription_status", T.StringType()),
    ("is_synthetic", T.BooleanType()),
)

BYOD_DEVICES = _fields(
    ("device_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("mobile_subscription_id", T.LongType()),
    ("device_ownership", T.StringType()),
    ("device_os", T.StringType()),
    ("device_age_months", T.IntegerType()),
    ("is_synthetic", T.BooleanType()),
)

MONTHLY_USAGE = _fields(
    ("usage_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("subscription_id", T.LongType()),
    ("service_type", T.StringType()),
    ("usage_month", T.StringType()),
    ("data_gb", MONEY),
    ("voice_minutes", T.IntegerType()),
    ("sms_count", T.IntegerType()),
    ("is_synthetic", T.BooleanType()),
)

BILLING_HISTORY = _fields(
    ("invoice_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("billing_month", T.StringType()),
    ("invoice_amount", MONEY),
    ("payment_status", T.StringType()),
    ("days_late", T.IntegerType()),
    ("is_synthetic", T.BooleanType()),
)

NETWORK_INCIDENTS = _fields(
    ("incident_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("incident_month", T.StringType()),
    ("incident_type", T.StringType()),
    ("duration_minutes", T.IntegerType()),
    ("service_affected", T.StringType()),
    ("is_synthetic", T.BooleanType()),
)

SUPPORT_TICKETS = _fields(
    ("ticket_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("ticket_month", T.StringType()),
    ("complaint_category_seed", T.StringType()),
    ("ticket_text", T.StringType()),
    ("priority", T.StringType()),
    ("resolution_hours", MONEY),
    ("is_synthetic", T.BooleanType()),
)

RETENTION_CAMPAIGNS = _fields(
    ("campaign_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("campaign_month", T.StringType()),
    ("offer_type", T.StringType()),
    ("offer_value", MONEY),
    ("accepted_offer", T.BooleanType()),
    ("is_synthetic", T.BooleanType()),
)

CATALOG: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "fixed_subscriptions": FIXED_SUBSCRIPTIONS,
    "mobile_subscriptions": MOBILE_SUBSCRIPTIONS,
    "byod_devices": BYOD_DEVICES,
    "monthly_usage": MONTHLY_USAGE,
    "billing_history": BILLING_HISTORY,
    "network_incidents": NETWORK_INCIDENTS,
    "support_tickets": SUPPORT_TICKETS,
    "retention_campaigns": RETENTION_CAMPAIGNS,
}

# Key, reference and check rules of the relational schema.
PRIMARY_KEYS: dict[str, str] = {
    "customers": "customer_id",
    "fixed_subscriptions": "fixed_subscription_id",
    "mobile_subscriptions": "mobile_subscription_id",
    "byod_devices": "device_id",
    "monthly_usage": "usage_id",
    "billing_history": "invoice_id",
    "network_incidents": "incident_id",
    "support_tickets": "ticket_id",
    "retention_campaigns": "campaign_id",
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("fixed_subscriptions", "customer_id", "customers", "customer_id"),
    ("mobile_subscriptions", "customer_id", "customers", "customer_id"),
    ("byod_devices", "customer_id", "customers", "customer_id"),
    ("byod_devices", "mobile_subscription_id", "mobile_subscriptions", "mobile_subscription_id"),
    ("monthly_usage", "customer_id", "customers", "customer_id"),
    ("billing_history", "customer_id", "customers", "customer_id"),
    ("network_incidents", "customer_id", "customers", "customer_id"),
    ("support_tickets", "customer_id", "customers", "customer_id"),
    ("retention_campaigns", "customer_id", "customers", "customer_id"),
]

# (table, rule name, SQL predicate that every row must satisfy; null passes)
RANGE_RULES: list[tuple[str, str, str]] = [
    ("customers", "tenure_months_non_negative", "tenure_months >= 0"),
    ("customers", "monthly_charges_non_negative", "monthly_charges >= 0"),
    ("customers", "total_charges_non_negative", "total_charges >= 0"),
    ("fixed_subscriptions", "download_speed_non_negative", "download_speed_mbps >= 0"),
    ("fixed_subscriptions", "mrr_non_negative", "monthly_recurring_revenue >= 0"),
    ("mobile_subscriptions", "line_count_positive", "line_count >= 1"),
    ("mobile_subscriptions", "mrr_non_negative", "monthly_recurring_revenue >= 0"),
    ("byod_devices", "device_age_non_negative", "device_age_months >= 0"),
    ("monthly_usage", "data_gb_non_negative", "data_gb >= 0"),
    ("monthly_usage", "voice_minutes_non_negative", "voice_minutes >= 0"),
    ("monthly_usage", "sms_count_non_negative", "sms_count >= 0"),
    ("billing_history", "invoice_amount_non_negative", "invoice_amount >= 0"),
    ("billing_history", "days_late_non_negative", "days_late >= 0"),
    ("network_incidents", "duration_non_negative", "duration_minutes >= 0"),
    ("support_tickets", "resolution_hours_non_negative", "resolution_hours >= 0"),
    ("retention_campaigns", "offer_value_non_negative", "offer_value >= 0"),
]

# The raw CSV contract (V1), exactly these 21 columns.
RAW_CUSTOMER_COLUMNS: list[str] = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]

# Types read from the raw CSV.  TotalCharges stays text so blanks survive.
RAW_CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            T.IntegerType()
            if name in ("SeniorCitizen", "tenure")
            else T.DoubleType()
            if name == "MonthlyCharges"
            else T.StringType(),
            True,
        )
        for name in RAW_CUSTOMER_COLUMNS
    ]
)
