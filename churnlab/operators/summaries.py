"""Per-customer roll-ups of the eight fact tables.

Each summary is one ``groupBy(customer_id).agg(...)``: Spark runs it as a
partial (map-side) hash aggregate, a shuffle of one row per customer per input
partition, and a final merge.  A customer holding a third of all fact rows
therefore costs one pre-combined row per map task, not a third of the data in
one task.

Two tracks exist because the original tool has two roll-ups with different
rules (see SURVEY 1.6):

* ``track="features"`` - the feature builder: counts non-null ids, carries the
  extra averages and complaint counters.
* ``track="sql"`` - the ``customer_360`` view: ``count(*)``, fewer columns.

Money columns typed decimal are summed exactly and stay decimal; averages are
``double(sum) / count`` so every engine produces the same double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "customer_id"


def exact_sum(df: DataFrame, name: str) -> Column:
    """Sum that stays exact for decimals (widened) and integers."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DecimalType):
        return F.sum(F.col(name).cast(T.DecimalType(38, dtype.scale)))
    return F.sum(F.col(name))


def exact_avg(df: DataFrame, name: str) -> Column:
    """Mean of the non-null values as double(sum) / count; null on no values."""
    return exact_sum(df, name).cast("double") / F.count(F.col(name)).cast("double")


def _count(df: DataFrame, id_col: str, track: str) -> Column:
    return F.count(F.col(id_col)) if track == "features" else F.count(F.lit(1))


def _flag_sum(cond: Column) -> Column:
    """sum(case when cond then 1 else 0 end); 0 for a null condition."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def summarize_fixed(fixed: DataFrame, track: str = "features") -> DataFrame:
    """A1: count, sum MRR, max download speed."""
    return fixed.groupBy(KEY).agg(
        _count(fixed, "fixed_subscription_id", track).alias("fixed_subscription_count"),
        exact_sum(fixed, "monthly_recurring_revenue").alias("fixed_mrr"),
        F.max("download_speed_mbps").alias("max_download_speed_mbps"),
    )


def summarize_mobile(mobile: DataFrame, track: str = "features") -> DataFrame:
    """A2: count, sum lines, sum MRR, any 5G."""
    return mobile.groupBy(KEY).agg(
        _count(mobile, "mobile_subscription_id", track).alias("mobile_subscription_count"),
        F.sum("line_count").cast("bigint").alias("mobile_line_count"),
        exact_sum(mobile, "monthly_recurring_revenue").alias("mobile_mrr"),
        F.bool_or("is_5g_enabled").alias("has_5g"),
    )


def summarize_byod(byod: DataFrame, track: str = "features") -> DataFrame:
    """A3: device count, mean device age."""
    return byod.groupBy(KEY).agg(
        _count(byod, "device_id", track).alias("byod_device_count"),
        exact_avg(byod, "device_age_months").alias("avg_byod_device_age_months"),
    )


def summarize_usage(usage: DataFrame, track: str = "features") -> DataFrame:
    """A4: total / mean data, total minutes and messages."""
    aggs = [exact_sum(usage, "data_gb").alias("total_data_gb")]
    if track == "features":
        aggs.append(exact_avg(usage, "data_gb").alias("avg_monthly_data_gb"))
    aggs += [
        F.sum("voice_minutes").cast("bigint").alias("total_voice_minutes"),
        F.sum("sms_count").cast("bigint").alias("total_sms_count"),
    ]
    return usage.groupBy(KEY).agg(*aggs)


def summarize_billing(billing: DataFrame, track: str = "features") -> DataFrame:
    """A5: invoices, total / mean amount, late count (L1), mean days late."""
    aggs = [
        _count(billing, "invoice_id", track).alias("invoice_count"),
        exact_sum(billing, "invoice_amount").alias("total_invoice_amount"),
    ]
    if track == "features":
        aggs.append(exact_avg(billing, "invoice_amount").alias("avg_invoice_amount"))
    aggs += [
        _flag_sum(F.col("payment_status") == "late").alias("late_payment_count"),
        exact_avg(billing, "days_late").alias("avg_days_late"),
    ]
    return billing.groupBy(KEY).agg(*aggs)


def summarize_network(network: DataFrame, track: str = "features") -> DataFrame:
    """Incident count, total / mean minutes."""
    aggs = [
        _count(network, "incident_id", track).alias("network_incident_count"),
        F.sum("duration_minutes").cast("bigint").alias("total_incident_minutes"),
    ]
    if track == "features":
        aggs.append(exact_avg(network, "duration_minutes").alias("avg_incident_minutes"))
    return network.groupBy(KEY).agg(*aggs)


def summarize_support(support: DataFrame, track: str = "features") -> DataFrame:
    """Ticket count, mean resolution, cancellation / billing / network counts."""
    seed = F.col("complaint_category_seed")
    aggs = [
        _count(support, "ticket_id", track).alias("support_ticket_count"),
        exact_avg(support, "resolution_hours").alias("avg_resolution_hours"),
        _flag_sum(seed == "cancellation_request").alias("cancellation_request_count"),
    ]
    if track == "features":
        aggs += [
            _flag_sum(seed == "billing").alias("billing_complaint_count"),
            _flag_sum(seed.isin("network_outage", "slow_internet")).alias(
                "network_complaint_count"
            ),
        ]
    return support.groupBy(KEY).agg(*aggs)


def summarize_retention(retention: DataFrame, track: str = "features") -> DataFrame:
    """Offers, accepted offers, mean offer value."""
    aggs = [
        _count(retention, "campaign_id", track).alias("retention_offer_count"),
        _flag_sum(F.col("accepted_offer")).alias("accepted_offer_count"),
    ]
    if track == "features":
        aggs.append(exact_avg(retention, "offer_value").alias("avg_offer_value"))
    return retention.groupBy(KEY).agg(*aggs)


SUMMARIES = {
    "fixed_subscriptions": summarize_fixed,
    "mobile_subscriptions": summarize_mobile,
    "byod_devices": summarize_byod,
    "monthly_usage": summarize_usage,
    "billing_history": summarize_billing,
    "network_incidents": summarize_network,
    "support_tickets": summarize_support,
    "retention_campaigns": summarize_retention,
}


def all_summaries(
    tables: dict[str, DataFrame],
    track: str = "features",
    overrides: dict[str, DataFrame] | None = None,
) -> list[DataFrame]:
    """The eight summaries in join order.

    ``overrides`` maps a fact-table name - or a tuple of names - to an already
    computed summary with the same columns (e.g. one pre-aggregated closer to
    its source, or several summaries computed in one pass), or to a function of
    the customer spine returning those columns.
    """
    overrides = overrides or {}
    covered = {name: key for key in overrides for name in (key if isinstance(key, tuple) else (key,))}
    out, used = [], set()
    for name, build in SUMMARIES.items():
        key = covered.get(name)
        if key is None:
            out.append(build(tables[name], track))
        elif key not in used:  # a combined summary stands for several tables
            out.append(overrides[key])
            used.add(key)
    return out


def summarize_usage_partials(partials: DataFrame, track: str = "features") -> DataFrame:
    """A4 from partial sums (``data_gb_sum``, ``data_gb_n``, ``voice_sum``,
    ``sms_sum`` per customer and any finer key): sums of sums, so the result
    equals :func:`summarize_usage` over the underlying rows."""
    aggs = [F.sum("data_gb_sum").alias("total_data_gb")]
    if track == "features":
        aggs.append(
            (F.sum("data_gb_sum").cast("double") / F.sum("data_gb_n").cast("double")).alias(
                "avg_monthly_data_gb"
            )
        )
    aggs += [
        F.sum("voice_sum").cast("bigint").alias("total_voice_minutes"),
        F.sum("sms_sum").cast("bigint").alias("total_sms_count"),
    ]
    return partials.groupBy(KEY).agg(*aggs)


def left_join_all(spine: DataFrame, summaries: list) -> DataFrame:
    """Spine left-joined to every summary on ``customer_id``.

    Summaries are unique per key, so the spine's row count is kept.  With
    sort-merge joins the spine is exchanged once and its hash partitioning is
    reused by every later join; AQE broadcasts a summary only when its measured
    size is under the broadcast threshold.  A summary given as a function of the
    spine (one fact row per customer, derived from the customer row) is added
    as columns, with no aggregate and no join.
    """
    out = spine
    for summary in summaries:
        if callable(summary):
            out = out.select("*", *summary(out))
        else:
            out = out.join(summary, KEY, "left")
    return out


def summarize_event_facts(facts: DataFrame, track: str = "features") -> DataFrame:
    """A3 + A6 + A7 + A8 in one aggregate over :func:`event_facts`-shaped rows
    (every role column null outside its role; ``role`` names it).

    One scan and one shuffle instead of four.  A customer with no event of a
    role gets a 0 count / NULL average here instead of no summary row, which
    the views' null policy turns into the same output.
    """

    def role_count(id_col: str, role: str) -> Column:
        # the feature track counts non-null ids, the SQL track the role's rows
        return F.count(F.col(id_col)) if track == "features" else F.count_if(F.col("role") == role)

    seed = F.col("complaint_category_seed")
    aggs = [
        role_count("device_id", "byod_devices").alias("byod_device_count"),
        exact_avg(facts, "device_age_months").alias("avg_byod_device_age_months"),
        role_count("incident_id", "network_incidents").alias("network_incident_count"),
        F.sum("duration_minutes").cast("bigint").alias("total_incident_minutes"),
    ]
    if track == "features":
        aggs.append(exact_avg(facts, "duration_minutes").alias("avg_incident_minutes"))
    aggs += [
        role_count("ticket_id", "support_tickets").alias("support_ticket_count"),
        exact_avg(facts, "resolution_hours").alias("avg_resolution_hours"),
        _flag_sum(seed == "cancellation_request").alias("cancellation_request_count"),
    ]
    if track == "features":
        aggs += [
            _flag_sum(seed == "billing").alias("billing_complaint_count"),
            _flag_sum(seed.isin("network_outage", "slow_internet")).alias(
                "network_complaint_count"
            ),
        ]
    aggs.append(role_count("campaign_id", "retention_campaigns").alias("retention_offer_count"))
    aggs.append(_flag_sum(F.col("accepted_offer")).alias("accepted_offer_count"))
    if track == "features":
        aggs.append(exact_avg(facts, "offer_value").alias("avg_offer_value"))
    return facts.groupBy(KEY).agg(*aggs)


def summarize_order_facts(facts: DataFrame, track: str = "features") -> DataFrame:
    """A2 + A5 in one aggregate over :func:`order_facts`-shaped rows (mobile
    columns null outside pending orders; marked by ``is_mobile``, ``is_invoice``).

    One scan and one shuffle of the orders instead of two.  A customer with
    invoices but no mobile line gets a 0 count / NULL sums here instead of no
    mobile row, which the views' null policy turns into the same output.
    """
    aggs = [
        (
            F.count(F.col("mobile_subscription_id"))
            if track == "features"
            else F.count_if(F.col("is_mobile"))
        ).alias("mobile_subscription_count"),
        F.sum("line_count").cast("bigint").alias("mobile_line_count"),
        exact_sum(facts, "monthly_recurring_revenue").alias("mobile_mrr"),
        F.bool_or("is_5g_enabled").alias("has_5g"),
        (
            F.count(F.col("invoice_id")) if track == "features" else F.count_if(F.col("is_invoice"))
        ).alias("invoice_count"),
        exact_sum(facts, "invoice_amount").alias("total_invoice_amount"),
    ]
    if track == "features":
        aggs.append(exact_avg(facts, "invoice_amount").alias("avg_invoice_amount"))
    aggs += [
        _flag_sum(F.col("payment_status") == "late").alias("late_payment_count"),
        exact_avg(facts, "days_late").alias("avg_days_late"),
    ]
    return facts.groupBy(KEY).agg(*aggs)
