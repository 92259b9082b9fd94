"""Dashboard and run-summary queries (R1-R11) over the feature, score,
explanation and classified-ticket tables.

Each is a join on ``customer_id`` and/or one aggregate; top-k reports use
``orderBy(...).limit(k)``, which Spark plans as a per-task top-k plus a final
merge (TakeOrderedAndProject), never a full sort into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions.scalar import round_half_up
from churnlab.operators import scoring

# The score columns the dashboards join to the features.
SCORE_JOIN_COLUMNS = [
    "customer_id",
    "churn_probability",
    "risk_category",
    "retention_priority",
    "recommended_action",
    "estimated_monthly_revenue_at_risk",
]

# The explanation columns the customer page joins.
EXPLANATION_COLUMNS = [
    "customer_id",
    "top_factor_1",
    "top_factor_1_impact",
    "top_factor_2",
    "top_factor_2_impact",
    "top_factor_3",
    "top_factor_3_impact",
]


def money_sum(c: str) -> Column:
    """Exact sum of a cent-valued column, returned as double."""
    return F.sum(F.col(c).cast(T.DecimalType(38, 2))).cast("double")


def boolean_rate(c: str) -> Column:
    """Mean of a boolean (nulls skipped) = count_if / count."""
    return F.count_if(F.col(c)).cast("double") / F.count(F.col(c)).cast("double")


def customer_scores(features: DataFrame, scores: DataFrame) -> DataFrame:
    """Features left-joined to the six score columns."""
    return features.join(scores.select(*SCORE_JOIN_COLUMNS), "customer_id", "left")


def with_explanations(customer_360: DataFrame, explanations: DataFrame | None) -> DataFrame:
    """Optional explanation columns, joined only when the table exists."""
    if explanations is None:
        return customer_360
    return customer_360.join(explanations.select(*EXPLANATION_COLUMNS), "customer_id", "left")


def executive_tiles(c360: DataFrame) -> DataFrame:
    """Customers, observed churn rate, total MRR, expected money at risk."""
    return c360.agg(
        F.count(F.lit(1)).alias("customers"),
        boolean_rate("churned").alias("churn_rate"),
        money_sum("total_mrr").alias("total_mrr"),
        money_sum("estimated_monthly_revenue_at_risk").alias("expected_revenue_at_risk"),
    )


def value_counts(df: DataFrame, column: str, count_col: str = "customer_count") -> DataFrame:
    """Counts per non-null value, largest first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.col(count_col).desc(), F.col(column).asc())
    )


def top_actions(scores: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent recommended actions."""
    return value_counts(scores, "recommended_action").limit(k)


# Columns of the highest-value-at-risk table.
TOP_AT_RISK_COLUMNS = [
    "customer_id",
    "risk_category",
    "retention_priority",
    "churn_probability",
    "total_mrr",
    "estimated_monthly_revenue_at_risk",
    "contract_type",
    "support_ticket_count",
    "network_incident_count",
    "recommended_action",
]


def top_at_risk(c360: DataFrame, k: int = 25, cuts: DataFrame | None = None) -> DataFrame:
    """The k customers with the most expected revenue at risk.  With the
    quartile ``cuts`` of all customers, those k rows get their priority."""
    order = [F.col("estimated_monthly_revenue_at_risk").desc_nulls_last(), F.col("customer_id").asc()]
    top = c360.orderBy(*order).limit(k)
    if cuts is not None:
        top = scoring.with_priorities(top, cuts).orderBy(*order)
    return top.select(*TOP_AT_RISK_COLUMNS)


# Fields of the single-customer page.
DETAIL_COLUMNS = [
    "customer_id",
    "risk_category",
    "churn_probability",
    "total_mrr",
    "estimated_monthly_revenue_at_risk",
    "contract_type",
    "internet_service",
    "payment_method",
    "tenure_months",
    "has_mobile",
    "has_byod",
    "has_5g",
    "retention_priority",
    "recommended_action",
    "late_payment_rate",
    "support_ticket_count",
    "network_incident_count",
    "cancellation_request_count",
]


def customer_detail(c360: DataFrame, customer_id) -> DataFrame:
    """One customer's record.  Over stored tables the filter reaches
    each Parquet scan."""
    cols = DETAIL_COLUMNS + [c for c in EXPLANATION_COLUMNS[1:] if c in c360.columns]
    return c360.filter(F.col("customer_id") == F.lit(customer_id)).select(*cols)


# Interpolated quartiles of 6-decimal scores have at most 8 decimals; rounding
# to 9 removes last-bit differences between interpolation formulas.
QUANTILE_DIGITS = 9


def score_distribution(df: DataFrame, group_col: str, score_col: str) -> DataFrame:
    """Min, quartiles (linear interpolation) and max per group.

    Exact ``percentile`` keeps a value -> count map per group; scores carry 6
    decimals in [0, 1], so that map has at most 1,000,001 entries whatever the
    table size."""
    q = F.percentile(F.col(score_col), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        df.filter(F.col(group_col).isNotNull() & F.col(score_col).isNotNull())
        .groupBy(group_col)
        .agg(F.min(score_col).alias("min_score"), q.alias("_q"), F.max(score_col).alias("max_score"))
        .select(
            group_col,
            "min_score",
            round_half_up(F.col("_q")[0], QUANTILE_DIGITS).alias("q1_score"),
            round_half_up(F.col("_q")[1], QUANTILE_DIGITS).alias("median_score"),
            round_half_up(F.col("_q")[2], QUANTILE_DIGITS).alias("q3_score"),
            "max_score",
        )
    )


def run_summary(scores: DataFrame) -> DataFrame:
    """Rows, churn rate and revenue at risk of all customers, and the number
    of customers of each risk category and action, as (metric, value) rows.

    One pass over ``scores``: its rows shrink to one for each pair of category
    and action (map-side), and each such row counts for all, for its category
    and for its action.  Without customers, the figures of all remain: 0 rows.
    """
    none = F.lit(None).cast("string")
    sums = {
        "rows": F.count(F.lit(1)),
        "churned": F.count_if("churned"),
        "known": F.count("churned"),
        "revenue": F.sum(F.col("monthly_revenue_at_risk").cast(T.DecimalType(38, 2))),
    }
    pairs = scores.groupBy("risk_category", "recommended_action").agg(*(c.alias(n) for n, c in sums.items()))
    kinds = F.array(
        F.struct(F.lit("all").alias("kind"), none.alias("name")),
        F.struct(F.lit("risk_category:").alias("kind"), F.col("risk_category").alias("name")),
        F.struct(F.lit("recommended_action:").alias("kind"), F.col("recommended_action").alias("name")),
    )
    counted = pairs.select(F.explode(kinds).alias("k"), *sums).select("k.kind", "k.name", *sums)
    # all customers are there even if there are none
    seed = scores.sparkSession.range(1).select(
        F.lit("all").alias("kind"), none.alias("name"), *(F.lit(0).cast("long").alias(n) for n in list(sums)[:3]),
        F.lit(None).cast(T.DecimalType(38, 2)).alias("revenue"),
    )
    total = counted.union(seed).groupBy("kind", "name").agg(*(F.sum(n).alias(n) for n in sums))
    rate = F.when(F.col("known") > 0, F.col("churned").cast("double") / F.col("known").cast("double"))

    def figure(name, value: Column) -> Column:
        return F.struct(name.alias("metric"), value.cast("double").alias("value"))

    of_all = F.array(
        figure(F.lit("feature_rows"), F.col("rows")),
        figure(F.lit("churn_rate"), rate),
        figure(F.lit("monthly_revenue_at_risk"), F.col("revenue")),
    )
    of_group = F.array(figure(F.concat("kind", "name"), F.col("rows")))
    figures = F.explode(F.when(F.col("kind") == "all", of_all).otherwise(of_group)).alias("f")
    return total.select(figures).select("f.*")


# --- P32: display text (report layer only) -----------------------------------


def format_currency(c: str | Column, decimals: int = 0) -> Column:
    """'$1,234' style text of a money column (rounded on the binary value, as Python's format)."""
    x = F.col(c) if isinstance(c, str) else c
    text = F.format_number(F.abs(x), decimals)
    return F.when(x.isNull(), F.lit(None)).when(
        x < 0, F.concat(F.lit("-$"), text)
    ).otherwise(F.concat(F.lit("$"), text))


def format_percent(c: str | Column, decimals: int = 1) -> Column:
    """'23.4%' style text of a rate in [0, 1]."""
    x = F.col(c) if isinstance(c, str) else c
    return F.concat(F.format_number(x * F.lit(100.0), decimals), F.lit("%"))


def executive_tiles_text(tiles: DataFrame) -> DataFrame:
    """R1 as the dashboard shows it: counts with separators, rate and money as text."""
    return tiles.select(
        F.format_number(F.col("customers"), 0).alias("customers"),
        format_percent("churn_rate", 1).alias("observed_churn_rate"),
        format_currency("total_mrr", 0).alias("monthly_recurring_revenue"),
        format_currency("expected_revenue_at_risk", 0).alias("expected_monthly_revenue_at_risk"),
    )
