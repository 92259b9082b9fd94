"""The two analytical views of the SQL track.

``customer_360`` keeps the SQL rules: ``count(*)`` counts, NULL averages for
customers without rows, decimals until the edge.  ``kpi_summary`` is one global
aggregate over it: partial aggregates per task, one tiny final merge, exactly
one row even for an empty input.  Catalyst drops the summaries the KPI does not
read (usage, billing) because their joins are left joins on a unique key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions.scalar import ratio_or_null
from churnlab.operators.summaries import all_summaries, left_join_all

# Customer columns of the customer_360 view, in view order.
CUSTOMER_COLUMNS_360 = [
    "customer_id",
    "gender",
    "senior_citizen",
    "has_partner",
    "has_dependents",
    "tenure_months",
    "contract_type",
    "internet_service",
    "payment_method",
    "monthly_charges",
    "total_charges",
    "churned",
]

# Summary columns of the view in order, with the default when
# the customer has no rows (None keeps NULL).
SUMMARY_COLUMNS_360 = [
    ("fixed_subscription_count", 0),
    ("fixed_mrr", 0),
    ("max_download_speed_mbps", 0),
    ("mobile_subscription_count", 0),
    ("mobile_line_count", 0),
    ("mobile_mrr", 0),
    ("has_5g", False),
    ("byod_device_count", 0),
    ("avg_byod_device_age_months", None),
    ("total_data_gb", 0),
    ("total_voice_minutes", 0),
    ("total_sms_count", 0),
    ("invoice_count", 0),
    ("total_invoice_amount", 0),
    ("late_payment_count", 0),
    ("avg_days_late", None),
    ("network_incident_count", 0),
    ("total_incident_minutes", 0),
    ("support_ticket_count", 0),
    ("avg_resolution_hours", None),
    ("cancellation_request_count", 0),
    ("retention_offer_count", 0),
    ("accepted_offer_count", 0),
]


def customer_360(
    tables: dict[str, DataFrame],
    exact: bool = False,
    overrides: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The customer_360 view.

    ``exact=True`` keeps money as decimal (for further SQL-track aggregation);
    otherwise decimals become double and integer counts bigint at the edge.
    ``overrides`` supplies precomputed summaries by fact-table name.
    """
    customers = tables["customers"].select(*CUSTOMER_COLUMNS_360)
    joined = left_join_all(customers, all_summaries(tables, "sql", overrides))
    cols = [F.col(c) for c in CUSTOMER_COLUMNS_360]
    for name, default in SUMMARY_COLUMNS_360:
        cols.append(
            F.col(name).alias(name)
            if default is None
            else F.coalesce(F.col(name), F.lit(default)).alias(name)
        )
    mrr = F.coalesce(F.col("fixed_mrr"), F.lit(0)) + F.coalesce(F.col("mobile_mrr"), F.lit(0))
    cols.append(mrr.alias("total_mrr"))
    cols.append(
        F.when(F.col("churned"), mrr).otherwise(F.lit(0)).alias("monthly_revenue_at_risk")
    )
    view = joined.select(*cols)
    if exact:
        return view
    return to_edge_types(view)


def to_edge_types(df: DataFrame) -> DataFrame:
    """Decimals to double, small integers to bigint (the output type policy)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def kpi_summary(view_exact: DataFrame) -> DataFrame:
    """One-row KPI table over the exact customer_360 view."""

    def flag_sum(cond):
        # SQL sum(case ...): NULL over zero rows, unlike count_if
        return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")

    n = F.count(F.lit(1))
    churned = flag_sum(F.col("churned"))
    byod = flag_sum(F.col("byod_device_count") > 0)
    mrr = F.col("total_mrr").cast(T.DecimalType(38, 2))
    agg = view_exact.agg(
        n.alias("customer_count"),
        churned.alias("churned_customer_count"),
        F.sum(mrr).alias("_mrr_sum"),
        F.count(F.col("total_mrr")).alias("_mrr_n"),
        F.sum(F.col("monthly_revenue_at_risk").cast(T.DecimalType(38, 2))).alias("_risk_sum"),
        byod.alias("byod_customer_count"),
        F.sum("support_ticket_count").cast("bigint").alias("support_ticket_count"),
        F.sum("network_incident_count").cast("bigint").alias("network_incident_count"),
        F.sum("retention_offer_count").cast("bigint").alias("retention_offer_count"),
        F.sum("accepted_offer_count").cast("bigint").alias("accepted_offer_count"),
    )
    return agg.select(
        "customer_count",
        "churned_customer_count",
        ratio_or_null("churned_customer_count", "customer_count", 4).alias(
            "customer_churn_rate"
        ),
        F.col("_mrr_sum").cast("double").alias("total_mrr"),
        (F.col("_mrr_sum").cast("double") / F.col("_mrr_n").cast("double")).alias("arpu"),
        F.col("_risk_sum").cast("double").alias("monthly_revenue_at_risk"),
        "byod_customer_count",
        ratio_or_null("byod_customer_count", "customer_count", 4).alias("byod_adoption_rate"),
        "support_ticket_count",
        "network_incident_count",
        "retention_offer_count",
        "accepted_offer_count",
    )
