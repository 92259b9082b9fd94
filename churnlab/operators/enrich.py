"""Deterministic enrichment steps: plan mapping, price lookup, clipping,
surrogate ids, the customer x month grid and the per-service usage grid
(P22-P26, J6, J7, U2).

The original tool draws random facts around these steps; the draws are not
rebuilt (see README), the steps are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.functions.constants import FIXED_PLAN_DEFAULT, FIXED_PLANS, MOBILE_PLAN_PRICES
from churnlab.functions.scalar import clip, col_, round_half_up


def fixed_plan_name(internet_service: str | Column = "internet_service") -> Column:
    """Internet service -> fixed plan name."""
    c = col_(internet_service)
    expr = None
    for service, plan, _speed in FIXED_PLANS:
        expr = F.when(c == service, plan) if expr is None else expr.when(c == service, plan)
    return expr.otherwise(FIXED_PLAN_DEFAULT[0])


def fixed_plan_speed(internet_service: str | Column = "internet_service") -> Column:
    """Internet service -> download speed in Mbps."""
    c = col_(internet_service)
    expr = None
    for service, _plan, speed in FIXED_PLANS:
        expr = F.when(c == service, F.lit(speed)) if expr is None else expr.when(
            c == service, F.lit(speed)
        )
    return expr.otherwise(F.lit(FIXED_PLAN_DEFAULT[1])).cast("int")


def subscription_status(churned: str | Column = "churned") -> Column:
    """Churned -> 'cancelled', else 'active'."""
    return F.when(col_(churned), "cancelled").otherwise("active")


def plan_price(plan_name: str | Column = "plan_name") -> Column:
    """Mobile plan -> monthly price via a literal map (no join needed)."""
    prices = F.create_map(
        *[x for name, price in MOBILE_PLAN_PRICES.items() for x in (F.lit(name), F.lit(price))]
    )
    return F.element_at(prices, col_(plan_name))


def padded_id(prefix: str, number: str | Column, width: int) -> Column:
    """Zero-padded surrogate id; a number wider than ``width`` is kept whole."""
    return F.format_string(f"{prefix}%0{width}d", col_(number).cast("long"))


def fixed_subscriptions_from_customers(customers: DataFrame) -> DataFrame:
    """One fixed-line subscription per customer."""
    return customers.select(
        padded_id("fix_", F.col("customer_id") + 1, 6).alias("fixed_subscription_id"),
        "customer_id",
        F.lit("fixed_broadband").alias("service_type"),
        fixed_plan_name().alias("plan_name"),
        fixed_plan_speed().alias("download_speed_mbps"),
        "contract_type",
        F.col("monthly_charges").alias("monthly_recurring_revenue"),
        subscription_status().alias("subscription_status"),
        F.lit(True).alias("is_synthetic"),
    )


def fixed_summary_columns(spine: DataFrame) -> list[Column]:
    """A1 for the one-fixed-line-per-customer rule, as columns of the customer
    row itself: count 1, MRR = monthly charges, speed from the plan mapping.

    Equal to summarising :func:`fixed_subscriptions_from_customers` when each
    customer id appears once (the cleaned table's key rule)."""
    return [
        F.lit(1).cast("bigint").alias("fixed_subscription_count"),
        F.col("monthly_charges").alias("fixed_mrr"),
        fixed_plan_speed().alias("max_download_speed_mbps"),
    ]


def month_grid(customers: DataFrame, start: str = "2024-01", end: str = "2024-12") -> DataFrame:
    """Every customer x every month in [start, end], months as 'YYYY-MM'.

    The month list is generated inside each row (``sequence``), so this is a
    narrow projection + explode, not a join with a driver-side list.
    """
    return _explode_months(customers.select("customer_id"), start, end)


def service_usage_grid(
    customers: DataFrame,
    fixed: DataFrame,
    mobile: DataFrame,
    start: str = "2024-01",
    end: str = "2024-12",
) -> DataFrame:
    """J7 + U2: one row per held service per customer per month.

    grid x fixed (one per customer) stacked on grid x mobile (one per line).
    Both are equi-joins on ``customer_id``; the grid is expanded after the join
    so the shuffle carries subscriptions, not months.
    """
    fixed_rows = fixed.select(
        "customer_id",
        F.col("fixed_subscription_id").cast("string").alias("subscription_id"),
        F.lit("fixed_broadband").alias("service_type"),
    )
    mobile_rows = mobile.select(
        "customer_id",
        F.col("mobile_subscription_id").cast("string").alias("subscription_id"),
        F.lit("mobile").alias("service_type"),
    )
    held = fixed_rows.unionByName(mobile_rows).join(
        customers.select("customer_id"), "customer_id", "left_semi"
    )
    return _explode_months(held, start, end)


def _month_sequence(start: str, end: str) -> Column:
    return F.sequence(
        F.to_date(F.lit(start + "-01")),
        F.to_date(F.lit(end + "-01")),
        F.expr("INTERVAL 1 MONTH"),
    )


def _explode_months(df: DataFrame, start: str, end: str) -> DataFrame:
    exploded = df.select("*", F.explode(_month_sequence(start, end)).alias("_month_start"))
    return exploded.withColumn(
        "usage_month", F.date_format("_month_start", "yyyy-MM")
    ).drop("_month_start")


def clip_round(c: str | Column, low: float, high: float, digits: int | None = 2) -> Column:
    """P25: clip to [low, high], then round (digits) or truncate (digits=None)."""
    clipped = clip(c, low, high)
    if digits is None:
        return clipped.cast("long")
    return round_half_up(clipped, digits)
