"""Raw customer file -> cleaned customer table.

All checks that can fail run as aggregates in as few Spark jobs as possible
(one for the value checks, one per key check); only their small results come
back to the driver, which raises with the same messages as the original tool.
The cleaned frame itself is a single projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.functions.constants import SOURCE_SYSTEM
from churnlab.functions.scalar import (
    snake_case,
    strip_whitespace,
    text_to_double,
    yes_no_to_boolean,
)
from churnlab.operators.quality import key_stats, validate_columns
from churnlab.sources.schemas import RAW_CUSTOMER_COLUMNS

# Raw columns with a strict Yes/No domain.
YES_NO_COLUMNS = ["Partner", "Dependents", "PhoneService", "PaperlessBilling", "Churn"]
YES_NO = ("Yes", "No")


def validate_source(raw: DataFrame) -> None:
    """V1 + V3 + V4: exact column set, no null id, no duplicate id."""
    validate_columns(raw, RAW_CUSTOMER_COLUMNS)
    stats = key_stats(raw, "customerID").first()
    if stats["null_key_count"]:
        raise ValueError("customerID contains missing values")
    if stats["duplicate_key_count"]:
        raise ValueError("customerID contains duplicate values")


def _value_checks(raw: DataFrame) -> dict:
    tenure = F.col("tenure")
    parsed = text_to_double("TotalCharges")
    aggs = [
        F.count_if(parsed.isNull() & ~tenure.eqNullSafe(F.lit(0))).alias("bad_total_charges"),
        F.count_if(~F.col("SeniorCitizen").isin(0, 1)).alias("bad_senior"),
    ]
    for c in YES_NO_COLUMNS:
        aggs.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*YES_NO)).alias(f"bad_{c}"))
    return raw.agg(*aggs).first().asDict()


def domain_audit(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Every value outside its column's domain, as rows of (column_name,
    bad_value, row_count); nulls pass.  One scan; the bad values are counted
    map-side and stay distributed, however many there are."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.when(~F.col(c).isin(*allowed), F.col(c).cast("string")).alias("bad_value"),
            )
            for c, allowed in domains.items()
        ]
    )
    return (
        df.select(F.inline(pairs))
        .filter(F.col("bad_value").isNotNull())
        .groupBy("column_name", "bad_value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def yes_no_audit(raw: DataFrame) -> DataFrame:
    """All unexpected Yes/No values of a raw customer table."""
    return domain_audit(raw, {c: YES_NO for c in YES_NO_COLUMNS})


def clean_customer_data(raw: DataFrame, check: bool = True) -> DataFrame:
    """21 raw columns -> 23 typed, snake-cased columns."""
    if check:
        validate_source(raw)
        bad = _value_checks(raw)
        if bad["bad_total_charges"]:
            raise ValueError(
                f"Found {bad['bad_total_charges']} invalid TotalCharges values "
                "for customers with nonzero tenure"
            )
        if bad["bad_senior"]:
            raise ValueError(f"SeniorCitizen contains {bad['bad_senior']} values other than 0/1")
        for c in YES_NO_COLUMNS:
            if bad[f"bad_{c}"]:
                raise ValueError(
                    f"{c} contains unexpected values in {bad[f'bad_{c}']} rows; "
                    "yes_no_audit lists every value"
                )

    total = F.coalesce(text_to_double("TotalCharges"), F.lit(0.0))
    cleaned = raw.select(
        strip_whitespace("customerID").alias("customer_id"),
        snake_case("gender").alias("gender"),
        F.col("SeniorCitizen").cast("boolean").alias("senior_citizen"),
        yes_no_to_boolean("Partner").alias("has_partner"),
        yes_no_to_boolean("Dependents").alias("has_dependents"),
        F.col("tenure").cast("bigint").alias("tenure_months"),
        yes_no_to_boolean("PhoneService").alias("phone_service"),
        snake_case("MultipleLines").alias("multiple_lines"),
        snake_case("InternetService").alias("internet_service"),
        snake_case("OnlineSecurity").alias("online_security"),
        snake_case("OnlineBackup").alias("online_backup"),
        snake_case("DeviceProtection").alias("device_protection"),
        snake_case("TechSupport").alias("tech_support"),
        snake_case("StreamingTV").alias("streaming_tv"),
        snake_case("StreamingMovies").alias("streaming_movies"),
        snake_case("Contract").alias("contract_type"),
        yes_no_to_boolean("PaperlessBilling").alias("paperless_billing"),
        snake_case("PaymentMethod").alias("payment_method"),
        F.col("MonthlyCharges").cast("double").alias("monthly_charges"),
        total.cast("double").alias("total_charges"),
        yes_no_to_boolean("Churn").alias("churned"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.lit(False).alias("is_synthetic"),
    )
    if check and key_stats(cleaned, "customer_id").first()["duplicate_key_count"]:
        raise ValueError("Cleaned output contains duplicate customer IDs")
    return cleaned
