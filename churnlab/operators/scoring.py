"""Customer scoring.

The probability enters as a column: from a fitted Spark ML model
(``model_probability``) or from any expression, such as the fixed linear
scorecard below that the SQL oracle can reproduce.  Everything after it is
column arithmetic plus one distributed rank (the priority quartile).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.functions.scalar import (
    logistic,
    priority_score,
    retention_action,
    risk_category,
    round_half_up,
)
from churnlab.operators.ranking import quartile_cuts, with_quartiles

# The columns the score table carries from the feature row.
SCORE_COLUMNS = [
    "customer_id",
    "contract_type",
    "churned",
    "monthly_charges",
    "total_mrr",
    "monthly_revenue_at_risk",
    "support_ticket_count",
    "network_incident_count",
    "network_complaint_count",
    "cancellation_request_count",
    "late_payment_count",
    "late_payment_rate",
    "has_byod",
]

# Our own fixed scorecard: a stand-in churn model with known coefficients, so
# a SQL engine can compute the same probability and the same attributions.
# (model input name, SQL expression over the feature row, coefficient,
#  decimals of the value - used to sum it exactly)
SCORECARD_INTERCEPT = -2.2
SCORECARD: list[tuple[str, str, float, int]] = [
    ("categorical__contract_type_month_to_month", "contract_type = 'month_to_month'", 1.6, 0),
    ("categorical__internet_service_fiber_optic", "internet_service = 'fiber_optic'", 0.7, 0),
    ("numeric__tenure_months", "tenure_months", -0.035, 0),
    ("numeric__monthly_charges", "monthly_charges", 0.012, 2),
    ("numeric__support_ticket_count", "support_ticket_count", 0.08, 0),
    ("numeric__network_incident_count", "network_incident_count", 0.06, 0),
    ("numeric__late_payment_count", "late_payment_count", 0.15, 0),
    ("numeric__has_byod", "has_byod", -0.2, 0),
]


def term_value(expr: str) -> Column:
    return F.expr(expr).cast("double")


def scorecard_margin() -> Column:
    z = F.lit(SCORECARD_INTERCEPT)
    for _name, expr, coef, _scale in SCORECARD:
        z = z + F.lit(coef) * term_value(expr)
    return z


def scorecard_probability() -> Column:
    """1 / (1 + exp(-z)) of the fixed scorecard, cut to 6 decimals."""
    return round_half_up(logistic(scorecard_margin()), 6)


def model_probability(model, features: DataFrame, out_col: str = "churn_probability") -> DataFrame:
    """M9: class-1 probability from a fitted Spark ML model, for every row."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(features)
    return scored.withColumn(out_col, vector_to_array(F.col("probability"))[1]).select(
        *features.columns, out_col
    )


def score_rows(
    features: DataFrame,
    probability: Column | str = "churn_probability",
    keep_features: bool = False,
) -> DataFrame:
    """The row-only part of M10: carried columns, probability, risk band (P18),
    money at risk (P19) and recommended action (P20).  A projection: no
    shuffle, no job; columns that a query does not use are pruned.

    ``keep_features=True`` carries every feature column instead of the 13
    score columns: the features joined to their scores (J2) without a join.
    """
    p = F.col(probability) if isinstance(probability, str) else probability
    carried = features.columns if keep_features else SCORE_COLUMNS
    carried = [c for c in carried if c != "churn_probability"]
    base = features.select(*carried, p.cast("double").alias("churn_probability"))
    return base.select(
        "*",
        risk_category("churn_probability").alias("risk_category"),
        round_half_up(F.col("churn_probability") * F.col("total_mrr"), 2).alias(
            "estimated_monthly_revenue_at_risk"
        ),
    ).withColumn("recommended_action", retention_action())


def priority_cuts(scored: DataFrame) -> DataFrame:
    """The quartile cuts (W1) of the priority score (P21), one row."""
    narrow = scored.select("customer_id", priority_score().alias("_priority"))
    return quartile_cuts(narrow, "_priority")


def with_priorities(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Retention priority (W2) of every row from the cuts of all of them."""
    return with_quartiles(rows, cuts, priority_score())


def score_customers(
    features: DataFrame,
    probability: Column | str = "churn_probability",
    sort: bool = True,
    keep_features: bool = False,
) -> DataFrame:
    """The risk score table, with the priority quartile as a column of the
    row; sorted by priority text ascending then money at risk descending (T1)."""
    scored = score_rows(features, probability, keep_features)
    columns = [c for c in scored.columns if c != "recommended_action"]
    out = with_priorities(scored, priority_cuts(scored)).select(
        *columns, "retention_priority", "recommended_action"
    )
    if sort:
        out = out.orderBy(
            F.col("retention_priority").asc(),
            F.col("estimated_monthly_revenue_at_risk").desc(),
            F.col("customer_id").asc(),
        )
    return out
