"""Column expressions shared by the operators.

All of these are native Catalyst expressions (whole-stage codegen); none is a
Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlab.functions.constants import (
    NUMERIC_TEXT_PATTERN,
    RISK_BANDS,
)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, digits: int) -> Column:
    """Round half away from zero for non-negative values: floor(x*10^k + 0.5) / 10^k.

    Written the same way in the SQL oracle, so both engines give the same double.
    """
    scale = float(10**digits)
    return F.floor(col_(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def strip_whitespace(c: str | Column) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs and newlines too,
    not only the spaces ``trim`` removes)."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def snake_case(c: str | Column) -> Column:
    """Trim, lower, runs of [^a-z0-9] to '_', strip '_'; null stays null."""
    replaced = F.regexp_replace(F.lower(F.trim(col_(c))), "[^a-z0-9]+", "_")
    return F.btrim(replaced, F.lit("_"))


def normalize_label(c: str | Column) -> Column:
    """Lower case, spaces to underscores."""
    return F.replace(F.lower(col_(c)), F.lit(" "), F.lit("_"))


def yes_no_to_boolean(c: str | Column) -> Column:
    """P3: 'Yes' -> true, 'No' -> false, anything else -> null (checked by V10)."""
    c = col_(c)
    return F.when(c == "Yes", F.lit(True)).when(c == "No", F.lit(False))


def text_to_double(c: str | Column) -> Column:
    """P5: trimmed text to double, null when it is not a plain decimal number.

    The regex guard keeps Spark from accepting forms such as '1d' or 'nan'.
    """
    trimmed = strip_whitespace(c)
    return F.when(
        trimmed.rlike(NUMERIC_TEXT_PATTERN), trimmed.try_cast("double")
    )


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """A / b, 0.0 when b is 0 or null."""
    num, den = col_(numerator), col_(denominator)
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(
        F.lit(0.0)
    )


def ratio_or_null(numerator: str | Column, denominator: str | Column, digits: int) -> Column:
    """round(a / nullif(b, 0), k); null when b is 0."""
    num, den = col_(numerator), col_(denominator)
    return round_half_up(
        F.when(den != 0, num.cast("double") / den.cast("double")), digits
    )


def risk_category(p: str | Column) -> Column:
    """Right-closed bins (-0.01,0.30] low, (0.30,0.60] medium, (0.60,1.0] high.

    Null or out of range gives the text 'nan'.
    """
    p = col_(p)
    expr = None
    for label, low, high in RISK_BANDS:
        cond = (p > F.lit(low)) & (p <= F.lit(high))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit("nan"))


def retention_action(
    risk: str | Column = "risk_category",
    cancellations: str | Column = "cancellation_request_count",
    incidents: str | Column = "network_incident_count",
    network_complaints: str | Column = "network_complaint_count",
    late_rate: str | Column = "late_payment_rate",
    contract: str | Column = "contract_type",
    has_byod: str | Column = "has_byod",
) -> Column:
    """P20: first-match decision list over the score row."""
    return (
        F.when(col_(risk) == "low", F.lit("monitor"))
        .when(col_(cancellations) > 0, F.lit("urgent_save_call"))
        .when(
            (col_(incidents) >= 2) | (col_(network_complaints) > 0),
            F.lit("service_recovery_credit"),
        )
        .when(col_(late_rate) >= 0.25, F.lit("billing_support_offer"))
        .when(col_(contract) == "month_to_month", F.lit("contract_discount_offer"))
        .when(col_(has_byod), F.lit("byod_loyalty_perk"))
        .otherwise(F.lit("general_retention_offer"))
    )


def priority_score(
    p: str | Column = "churn_probability",
    mrr: str | Column = "total_mrr",
    tickets: str | Column = "support_ticket_count",
    incidents: str | Column = "network_incident_count",
    late: str | Column = "late_payment_count",
) -> Column:
    """p*mrr + 5*tickets + 5*incidents + 3*late; nulls of the last four are 0."""

    def z(c):
        return F.coalesce(col_(c).cast("double"), F.lit(0.0))

    return (
        col_(p).cast("double") * z(mrr)
        + z(tickets) * F.lit(5.0)
        + z(incidents) * F.lit(5.0)
        + z(late) * F.lit(3.0)
    )


def quartile_label(rank: str | Column, n: str | Column) -> Column:
    """Quartile of a 1-based rank among n, as pandas qcut(rank, 4) gives it.

    k = max(1, ceil(4(r-1)/(n-1))) = max(1, (4(r-1) + n - 2) div (n-1)).
    n = 1 gives 'low'; a null rank gives 'nan'.
    """
    r, n = col_(rank).cast("long"), col_(n).cast("long")
    numerator = F.lit(4) * (r - 1) + n - 2
    # exact integer division: subtract the remainder first
    k = F.when(n <= 1, F.lit(1)).otherwise(
        F.greatest(
            F.lit(1),
            ((numerator - F.pmod(numerator, n - 1)) / (n - 1)).cast("long"),
        )
    )
    return (
        F.when(r.isNull(), F.lit("nan"))
        .when(k == 1, F.lit("low"))
        .when(k == 2, F.lit("medium"))
        .when(k == 3, F.lit("high"))
        .otherwise(F.lit("critical"))
    )


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def clip(c: str | Column, low: float, high: float) -> Column:
    """P25: greatest(low, least(high, x))."""
    return F.greatest(F.lit(low), F.least(F.lit(high), col_(c)))
