"""Customer feature table (A9): spine + eight summaries + null policy + derived
columns (J1, P9-P16).

One lazy plan: nine scans, eight partial/final aggregates, eight left joins on
``customer_id``, one projection.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions.scalar import safe_ratio
from churnlab.operators.summaries import all_summaries, left_join_all

# The null policy of the feature builder.
COUNT_COLUMNS = [
    "fixed_subscription_count",
    "mobile_subscription_count",
    "mobile_line_count",
    "byod_device_count",
    "invoice_count",
    "late_payment_count",
    "network_incident_count",
    "support_ticket_count",
    "cancellation_request_count",
    "billing_complaint_count",
    "network_complaint_count",
    "retention_offer_count",
    "accepted_offer_count",
]

AMOUNT_COLUMNS = [
    "fixed_mrr",
    "mobile_mrr",
    "max_download_speed_mbps",
    "avg_byod_device_age_months",
    "total_data_gb",
    "avg_monthly_data_gb",
    "total_voice_minutes",
    "total_sms_count",
    "total_invoice_amount",
    "avg_invoice_amount",
    "avg_days_late",
    "total_incident_minutes",
    "avg_incident_minutes",
    "avg_resolution_hours",
    "avg_offer_value",
]

# Output order of the summary columns (the original roll-up order).
SUMMARY_COLUMNS = [
    "fixed_subscription_count", "fixed_mrr", "max_download_speed_mbps",
    "mobile_subscription_count", "mobile_line_count", "mobile_mrr", "has_5g",
    "byod_device_count", "avg_byod_device_age_months",
    "total_data_gb", "avg_monthly_data_gb", "total_voice_minutes", "total_sms_count",
    "invoice_count", "total_invoice_amount", "avg_invoice_amount", "late_payment_count",
    "avg_days_late",
    "network_incident_count", "total_incident_minutes", "avg_incident_minutes",
    "support_ticket_count", "avg_resolution_hours", "cancellation_request_count",
    "billing_complaint_count", "network_complaint_count",
    "retention_offer_count", "accepted_offer_count", "avg_offer_value",
]

def build_customer_features(
    tables: dict[str, DataFrame],
    as_of_month: str | None = None,
    overrides: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Wide feature row per customer.

    ``as_of_month`` ('YYYY-MM'), when given, keeps only fact rows dated on or
    before that month (the point-in-time rule); the filter is pushed into each
    scan that carries a month column.  ``overrides`` supplies precomputed
    summaries by fact-table name; they hold their own rows, so the two don't go
    together (``roles.summary_overrides`` takes the month instead).
    """
    if as_of_month is not None and overrides:
        raise ValueError("as_of_month cannot filter precomputed summaries; build the overrides as of the month")
    if as_of_month is not None:
        tables = _as_of(tables, as_of_month)
    customers = tables["customers"]
    joined = left_join_all(customers, all_summaries(tables, "features", overrides))

    mrr_total = F.coalesce(F.col("fixed_mrr"), F.lit(0)) + F.coalesce(
        F.col("mobile_mrr"), F.lit(0)
    )
    filled = joined.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in customers.schema.fields
        ],
        *[
            F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias(c)
            if c in COUNT_COLUMNS
            else F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
            if c in AMOUNT_COLUMNS
            else F.coalesce(F.col(c), F.lit(False)).alias(c)
            for c in SUMMARY_COLUMNS
        ],
        mrr_total.cast("double").alias("total_mrr"),
    )
    return filled.select(
        *[c for c in filled.columns if c != "total_mrr"],
        "total_mrr",
        F.when(F.col("churned"), F.col("total_mrr"))
        .otherwise(F.lit(0.0))
        .alias("monthly_revenue_at_risk"),
        (F.col("byod_device_count") > 0).alias("has_byod"),
        (F.col("mobile_subscription_count") > 0).alias("has_mobile"),
        (F.col("network_incident_count") > 0).alias("has_network_incident"),
        (F.col("support_ticket_count") > 0).alias("has_support_ticket"),
        safe_ratio("late_payment_count", "invoice_count").alias("late_payment_rate"),
        safe_ratio("accepted_offer_count", "retention_offer_count").alias(
            "retention_acceptance_rate"
        ),
    )


MONTH_COLUMNS = {
    "monthly_usage": "usage_month",
    "billing_history": "billing_month",
    "network_incidents": "incident_month",
    "support_tickets": "ticket_month",
    "retention_campaigns": "campaign_month",
}


def _as_of(tables: dict[str, DataFrame], as_of_month: str) -> dict[str, DataFrame]:
    out = dict(tables)
    for name, month_col in MONTH_COLUMNS.items():
        if name in out and month_col in out[name].columns:
            out[name] = out[name].filter(F.col(month_col) <= F.lit(as_of_month))
    return out
