"""The nine domain tables as views over the driver's star-schema tables.

The driver tables (``customer``, ``nation``, ``orders``, ``lineitem``,
``events``, ``documents``, ``labels``) are mapped onto the telecom roles of the
relational schema: one customer per ``c_custkey``, mobile lines from pending
orders, usage from line items, invoices from orders, devices / incidents /
tickets / offers from the event stream, complaint texts from documents.  Every
role is a projection (one join for usage, customers and ticket texts), so the
roles scale with the tables they read and Catalyst prunes what a query does not
use.  Types follow :mod:`churnlab.sources.schemas` (money as decimal).
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions.constants import COMPLAINT_LABELS, MOBILE_PLAN_PRICES
from churnlab.functions.scalar import normalize_label
from churnlab.sources.io import read_table, table_path
from churnlab.sources.schemas import BIG_MONEY, MONEY

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# The last reading of each driver table in this session, with the listing it was
# made from: a table is listed on every use and read anew when files changed.
_READS: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


def listing(spark: SparkSession, root: str, name: str) -> str:
    """Files, lengths and times of a driver table, as one text."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return ""
    # one call for the whole listing, however many files it has
    files = jvm.org.apache.commons.lang3.ArrayUtils.toString(system.listStatus(path))
    return re.sub(r"access_time=\d+", "", files)


def driver(spark: SparkSession, root: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, root.rstrip("/"), name)
    files = listing(spark, root, name)
    if key not in _READS or _READS[key][0] != files:
        _READS[key] = (files, read_table(spark, root, name))
    return _READS[key][1]


def _month(ts_col: str):
    return F.date_format(F.col(ts_col), "yyyy-MM")


def customers(spark: SparkSession, root: str) -> DataFrame:
    c = driver(spark, root, "customer")
    n = driver(spark, root, "nation").select("n_nationkey", "n_regionkey")
    key = F.col("c_custkey")
    phone = (F.col("c_nationkey") % 10) != 0
    internet = (
        F.when(F.col("n_regionkey").isin(0, 1), "fiber_optic")
        .when(F.col("n_regionkey").isin(2, 3), "dsl")
        .otherwise("no")
    )

    def addon(modulus: int, below: int):
        return (
            F.when(F.col("internet_service") == "no", "no_internet_service")
            .when(F.col("customer_id") % modulus < below, "yes")
            .otherwise("no")
        )

    monthly = (F.floor(F.greatest(F.col("c_acctbal"), F.lit(0.0)) + 0.5) / 100).cast(MONEY)
    base = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        key.alias("customer_id"),
        F.when(key % 2 == 0, "female").otherwise("male").alias("gender"),
        ((F.col("c_nationkey") % 5) == 0).alias("senior_citizen"),
        ((key % 3) == 0).alias("has_partner"),
        ((key % 4) == 0).alias("has_dependents"),
        (key % 73).cast("bigint").alias("tenure_months"),
        phone.alias("phone_service"),
        F.when(~phone, "no_phone_service")
        .when(key % 2 == 1, "yes")
        .otherwise("no")
        .alias("multiple_lines"),
        internet.alias("internet_service"),
        F.col("c_mktsegment"),
        monthly.alias("monthly_charges"),
        # low balance churns, with one label in eight flipped by a key hash so
        # the label is not a function of the charges alone
        ((F.col("c_acctbal") < 1500) != F.substring(F.md5(key.cast("string")), 1, 1).isin("0", "1"))
        .alias("churned"),
    )
    return base.select(
        "customer_id",
        "gender",
        "senior_citizen",
        "has_partner",
        "has_dependents",
        "tenure_months",
        "phone_service",
        "multiple_lines",
        "internet_service",
        addon(5, 2).alias("online_security"),
        addon(7, 3).alias("online_backup"),
        addon(11, 5).alias("device_protection"),
        addon(13, 4).alias("tech_support"),
        addon(2, 1).alias("streaming_tv"),
        addon(3, 1).alias("streaming_movies"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), "month_to_month")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "one_year")
        .otherwise("two_year")
        .alias("contract_type"),
        ((F.col("customer_id") % 5) != 0).alias("paperless_billing"),
        F.element_at(
            F.array(
                *[
                    F.lit(v)
                    for v in (
                        "electronic_check",
                        "mailed_check",
                        "bank_transfer_automatic",
                        "credit_card_automatic",
                    )
                ]
            ),
            (F.col("customer_id") % 4 + 1).cast("int"),
        ).alias("payment_method"),
        "monthly_charges",
        (F.col("monthly_charges") * F.col("tenure_months")).cast(BIG_MONEY).alias(
            "total_charges"
        ),
        "churned",
        F.lit("tpch_customer").alias("source_system"),
        F.lit(False).alias("is_synthetic"),
    )


def fixed_subscriptions(spark: SparkSession, root: str) -> DataFrame:
    from churnlab.operators.enrich import fixed_subscriptions_from_customers

    return fixed_subscriptions_from_customers(customers(spark, root))


def _mobile_columns() -> dict[str, Column]:
    """Mobile-line role over an ``orders`` row (pending orders only)."""
    digit = F.substring(F.col("o_orderpriority"), 1, 1)
    plan = (
        F.when(digit == "1", "Premium 5G")
        .when(digit == "2", "Family Share")
        .when(digit == "3", "Mobile Unlimited")
        .otherwise("Mobile Starter")
    )
    prices = F.create_map(
        *[x for name, price in MOBILE_PLAN_PRICES.items() for x in (F.lit(name), F.lit(price))]
    )
    return {
        "mobile_subscription_id": F.col("o_orderkey"),
        "customer_id": F.col("o_custkey"),
        "service_type": F.lit("mobile"),
        "plan_name": plan,
        "line_count": digit.cast("int"),
        "is_5g_enabled": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
        "monthly_recurring_revenue": F.element_at(prices, plan).cast(MONEY),
        "subscription_status": F.lit("active"),
        "is_synthetic": F.lit(True),
    }


def _billing_columns() -> dict[str, Column]:
    """Invoice role over an ``orders`` row (every order)."""
    late = F.col("o_orderpriority") == "5-LOW"
    return {
        "invoice_id": F.col("o_orderkey"),
        "customer_id": F.col("o_custkey"),
        "billing_month": _month("o_orderdate"),
        "invoice_amount": F.col("o_totalprice").cast(MONEY),
        "payment_status": F.when(late, "late").otherwise("paid"),
        "days_late": F.when(late, F.lit(1) + F.col("o_orderkey") % 30).otherwise(0).cast("int"),
        "is_synthetic": F.lit(True),
    }


MOBILE_ORDER_STATUS = "P"


def mobile_subscriptions(spark: SparkSession, root: str) -> DataFrame:
    o = driver(spark, root, "orders").filter(F.col("o_orderstatus") == MOBILE_ORDER_STATUS)
    return o.select(*[c.alias(n) for n, c in _mobile_columns().items()])


def _dated(month: Column, as_of_month: str | None) -> Column:
    return F.lit(True) if as_of_month is None else month <= F.lit(as_of_month)


def order_facts(spark: SparkSession, root: str, as_of_month: str | None = None) -> DataFrame:
    """Mobile lines and invoices in one pass over ``orders``: every order (up to
    ``as_of_month``) is an invoice; the mobile columns are null unless the order
    is pending.  ``is_mobile`` and ``is_invoice`` mark the rows of each role."""
    is_mobile = F.coalesce(F.col("o_orderstatus") == MOBILE_ORDER_STATUS, F.lit(False))
    is_invoice = F.coalesce(_dated(_month("o_orderdate"), as_of_month), F.lit(False))
    cols = [F.col("o_custkey").alias("customer_id"), is_mobile.alias("is_mobile"), is_invoice.alias("is_invoice")]
    for name, c in _mobile_columns().items():
        if name not in ("customer_id", "is_synthetic", "service_type", "subscription_status"):
            cols.append(F.when(is_mobile, c).alias(name))
    for name, c in _billing_columns().items():
        if name not in ("customer_id", "is_synthetic"):
            cols.append(F.when(is_invoice, c).alias(name))
    return driver(spark, root, "orders").select(*cols)


def _events(spark: SparkSession, root: str, event_type: str) -> DataFrame:
    return driver(spark, root, "events").filter(F.col("event_type") == event_type)


# Column definitions of the four event roles over an ``events`` row, shared by
# the per-role views and the one-pass combined summary (``event_facts``).
def _byod_columns() -> dict[str, Column]:
    return {
        "device_id": F.col("event_id"),
        "customer_id": F.col("user_id"),
        "mobile_subscription_id": F.when(F.col("event_id") % 4 != 0, F.col("event_id")),
        "device_ownership": F.lit("byod"),
        "device_os": F.when(F.col("event_id") % 2 == 0, "ios").otherwise("android"),
        "device_age_months": (
            F.lit(1) + F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 48
        ).cast("int"),
        "is_synthetic": F.lit(True),
    }


def _network_columns() -> dict[str, Column]:
    kinds = F.array(F.lit("outage"), F.lit("degraded_service"), F.lit("maintenance"))
    return {
        "incident_id": F.col("event_id"),
        "customer_id": F.col("user_id"),
        "incident_month": _month("ts"),
        "incident_type": F.element_at(kinds, (F.col("event_id") % 3 + 1).cast("int")),
        "duration_minutes": F.floor("value").cast("int"),
        "service_affected": F.when(F.col("event_id") % 2 == 0, "fixed_broadband").otherwise(
            "mobile"
        ),
        "is_synthetic": F.lit(True),
    }


def _support_columns() -> dict[str, Column]:
    labels = F.array(*[normalize_label(F.lit(label)) for label in COMPLAINT_LABELS])
    return {
        "ticket_id": F.col("event_id"),
        "customer_id": F.col("user_id"),
        "ticket_month": _month("ts"),
        "complaint_category_seed": F.element_at(labels, (F.col("event_id") % 7 + 1).cast("int")),
        "ticket_text": F.col("props"),
        "priority": F.when(F.col("value") >= 300, "high")
        .when(F.col("value") >= 100, "medium")
        .otherwise("low"),
        "resolution_hours": F.col("value").cast(MONEY),
        "is_synthetic": F.lit(True),
    }


def _retention_columns() -> dict[str, Column]:
    offers = F.array(F.lit("discount"), F.lit("bill_credit"), F.lit("device_upgrade"))
    return {
        "campaign_id": F.col("event_id"),
        "customer_id": F.col("user_id"),
        "campaign_month": _month("ts"),
        "offer_type": F.element_at(offers, (F.col("event_id") % 3 + 1).cast("int")),
        "offer_value": (F.lit(10) + F.lit(5) * (F.col("event_id") % 5)).cast(MONEY),
        "accepted_offer": F.col("value") > 50,
        "is_synthetic": F.lit(True),
    }


EVENT_ROLES = {
    # role table: (event type, column builder)
    "byod_devices": ("view", _byod_columns),
    "network_incidents": ("error", _network_columns),
    "support_tickets": ("click", _support_columns),
    "retention_campaigns": ("signup", _retention_columns),
}


def _event_role(spark: SparkSession, root: str, table: str) -> DataFrame:
    event_type, columns = EVENT_ROLES[table]
    return _events(spark, root, event_type).select(
        *[c.alias(name) for name, c in columns().items()]
    )


def byod_devices(spark: SparkSession, root: str) -> DataFrame:
    return _event_role(spark, root, "byod_devices")


# The month column of each event role that has one.
_EVENT_MONTHS = {
    "network_incidents": "incident_month",
    "support_tickets": "ticket_month",
    "retention_campaigns": "campaign_month",
}


def event_facts(spark: SparkSession, root: str, as_of_month: str | None = None) -> DataFrame:
    """All four event roles in one pass over ``events``: one row per event with
    every role column, null unless the event has that role's type (and, for the
    dated roles, falls in ``as_of_month`` or before).  ``role`` names the role
    the row belongs to, so rows can be counted whatever their ids hold."""
    cols, role = [F.col("user_id").alias("customer_id")], F.lit(None).cast("string")
    for table, (event_type, builder) in EVENT_ROLES.items():
        columns = builder()
        in_role = F.col("event_type") == event_type
        if table in _EVENT_MONTHS:
            in_role = in_role & _dated(columns[_EVENT_MONTHS[table]], as_of_month)
        role = F.when(in_role, F.lit(table)).otherwise(role)
        for name, c in columns.items():
            if name not in ("customer_id", "is_synthetic"):
                cols.append(F.when(in_role, c).alias(name))
    return driver(spark, root, "events").select(*cols, role.alias("role"))


def _usage_id() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def monthly_usage(spark: SparkSession, root: str) -> DataFrame:
    li = driver(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    o = driver(spark, root, "orders").select("o_orderkey", "o_custkey")
    # left: a line item without its order stays visible to the audits
    return li.join(o, li.l_orderkey == o.o_orderkey, "left").select(
        _usage_id().alias("usage_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_orderkey").alias("subscription_id"),
        F.lit("fixed_broadband").alias("service_type"),
        _month("l_shipdate").alias("usage_month"),
        F.col("l_quantity").cast(MONEY).alias("data_gb"),
        (F.col("l_partkey") % 1500).cast("int").alias("voice_minutes"),
        (F.col("l_suppkey") % 500).cast("int").alias("sms_count"),
        F.lit(True).alias("is_synthetic"),
    )


def usage_partials(spark: SparkSession, root: str, as_of_month: str | None = None) -> DataFrame:
    """Usage measures pre-aggregated per order before the join with orders.

    Every usage aggregate is a sum (or a sum / count), so line items are first
    combined per ``l_orderkey`` - map-side, in the scan stage - and only one
    row per order (per map task) crosses the shuffle and the join.  An order
    holding a third of all line items therefore costs one row per task.
    """
    li = driver(spark, root, "lineitem")
    if as_of_month is not None:
        li = li.filter(_month("l_shipdate") <= F.lit(as_of_month))
    per_order = li.groupBy(F.col("l_orderkey")).agg(
        F.sum(F.col("l_quantity").cast(MONEY)).alias("data_gb_sum"),
        F.count(F.col("l_quantity")).alias("data_gb_n"),
        F.sum((F.col("l_partkey") % 1500).cast("int")).alias("voice_sum"),
        F.sum((F.col("l_suppkey") % 500).cast("int")).alias("sms_sum"),
    )
    o = driver(spark, root, "orders").select("o_orderkey", "o_custkey")
    return per_order.join(o, per_order.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_custkey").alias("customer_id"), "data_gb_sum", "data_gb_n", "voice_sum", "sms_sum"
    )


def summary_overrides(
    spark: SparkSession, root: str, track: str = "features", as_of_month: str | None = None
) -> dict:
    """Summaries computed closer to the driver tables than the role rows allow:
    the fixed line as columns of the customer row (one per customer), mobile
    lines and invoices in one scan and one shuffle of ``orders``, line items
    pre-aggregated per order, and the four event roles in one scan and one
    shuffle of ``events``."""
    from churnlab.operators.enrich import fixed_summary_columns
    from churnlab.operators.summaries import (
        summarize_event_facts,
        summarize_order_facts,
        summarize_usage_partials,
    )

    return {
        "fixed_subscriptions": fixed_summary_columns,
        ("mobile_subscriptions", "billing_history"): summarize_order_facts(
            order_facts(spark, root, as_of_month), track
        ),
        "monthly_usage": summarize_usage_partials(usage_partials(spark, root, as_of_month), track),
        tuple(EVENT_ROLES): summarize_event_facts(event_facts(spark, root, as_of_month), track),
    }


def billing_history(spark: SparkSession, root: str) -> DataFrame:
    o = driver(spark, root, "orders")
    return o.select(*[c.alias(n) for n, c in _billing_columns().items()])


def network_incidents(spark: SparkSession, root: str) -> DataFrame:
    return _event_role(spark, root, "network_incidents")


def support_tickets(spark: SparkSession, root: str) -> DataFrame:
    return _event_role(spark, root, "support_tickets")


def retention_campaigns(spark: SparkSession, root: str) -> DataFrame:
    return _event_role(spark, root, "retention_campaigns")


def ticket_texts(spark: SparkSession, root: str) -> DataFrame:
    """Complaint tickets with free text: documents, seeded from their labels."""
    d = driver(spark, root, "documents").select("doc_id", "text")
    lab = driver(spark, root, "labels").select("doc_id", "quality", "toxic")
    seed = (
        F.when(F.col("toxic") == 1, "cancellation_request")
        .when(F.col("quality") == 0, "billing")
        .when(F.col("quality") == 1, "slow_internet")
    )
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("ticket_id"),
        (F.col("doc_id") % 1500).alias("customer_id"),
        F.col("text").alias("ticket_text"),
        seed.alias("complaint_category_seed"),
    )


def conversation_turns(spark: SparkSession, root: str) -> DataFrame:
    """Customer-written chat turns as complaint texts (a second text source):
    one ticket per user turn, keyed conv_id * 1000 + turn, no seed label."""
    c = driver(spark, root, "conversations").filter(F.col("role") == "user")
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ticket_id"),
        F.col("conv_id").alias("customer_id"),
        F.col("text").alias("ticket_text"),
        F.lit(None).cast("string").alias("complaint_category_seed"),
    )


ROLES = {
    "customers": customers,
    "fixed_subscriptions": fixed_subscriptions,
    "mobile_subscriptions": mobile_subscriptions,
    "byod_devices": byod_devices,
    "monthly_usage": monthly_usage,
    "billing_history": billing_history,
    "network_incidents": network_incidents,
    "support_tickets": support_tickets,
    "retention_campaigns": retention_campaigns,
}


class DomainTables(Mapping):
    """The nine role tables, keyed by schema name, each built on first use
    (a query that replaces a summary never builds that role's rows)."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root, self._built = spark, root, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = ROLES[name](self._spark, self._root)
        return self._built[name]

    def __iter__(self):
        return iter(ROLES)

    def __len__(self) -> int:
        return len(ROLES)


def domain_tables(spark: SparkSession, root: str) -> DomainTables:
    """All nine role tables, keyed by their schema name (built lazily)."""
    return DomainTables(spark, root)


def register_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Register the role tables and the two views of the schema, ``customer_360``
    and ``kpi_summary``, as temp views (S9), and return them."""
    from churnlab.operators.views import customer_360, kpi_summary

    tables = dict(domain_tables(spark, root))
    tables["ticket_texts"] = ticket_texts(spark, root)
    overrides = summary_overrides(spark, root, "sql")
    exact = customer_360(tables, exact=True, overrides=overrides)
    tables["customer_360"] = customer_360(tables, overrides=overrides)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    exact.createOrReplaceTempView("customer_360_exact")
    tables["kpi_summary"] = kpi_summary(spark.table("customer_360_exact"))
    tables["kpi_summary"].createOrReplaceTempView("kpi_summary")
    return tables


# --- the audits' view of the driver tables: keys only, one scan of each ---------


def key_sources(spark: SparkSession, root: str) -> list:
    """Primary keys of the nine tables.  Usage needs line items alone."""
    from churnlab.operators.enrich import fixed_subscriptions_from_customers
    from churnlab.operators.quality import Key
    from churnlab.sources.schemas import PRIMARY_KEYS

    spine = customers(spark, root)
    fixed = fixed_subscriptions_from_customers(spine)
    both = fixed.select("customer_id", "fixed_subscription_id")
    usage = driver(spark, root, "lineitem").select(_usage_id().alias("usage_id"))

    def key(table: str, when: Column | None = None):
        return Key(table, PRIMARY_KEYS[table], F.col(PRIMARY_KEYS[table]), when)

    return [
        (both, [key("customers"), key("fixed_subscriptions")]),
        (order_facts(spark, root), [key("mobile_subscriptions", F.col("is_mobile")), key("billing_history", F.lit(True))]),
        (event_facts(spark, root), [key(table, F.col("role") == table) for table in EVENT_ROLES]),
        (usage, [key("monthly_usage")]),
    ]


def reference_sources(spark: SparkSession, root: str) -> list:
    """References between the nine tables.  Line items are counted per order
    before they meet their customer."""
    from churnlab.operators.quality import Reference

    def to_customer(table: str, when: Column | None = None, n: Column | None = None):
        key = F.col("customer_id") if when is None else F.when(when, F.col("customer_id"))
        return Reference("customers", key, (table, "customer_id"), n)

    spine = driver(spark, root, "customer").select(F.col("c_custkey").alias("customer_id"))
    lines = F.col("mobile_subscription_id")
    orders = [
        to_customer("billing_history"),
        to_customer("mobile_subscriptions", F.col("is_mobile")),
        Reference("mobile_subscriptions", F.when(F.col("is_mobile"), lines)),
    ]
    events = [to_customer(table, F.col("role") == table) for table in EVENT_ROLES]
    events.append(Reference("mobile_subscriptions", lines, ("byod_devices", "mobile_subscription_id")))
    per_order = driver(spark, root, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    o = driver(spark, root, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    usage = per_order.join(o, per_order.l_orderkey == o.o_orderkey).select("customer_id", "n")
    return [
        (spine, [Reference("customers", F.col("customer_id")), to_customer("fixed_subscriptions")]),
        (order_facts(spark, root), orders),
        (event_facts(spark, root), events),
        (usage, [to_customer("monthly_usage", n=F.col("n"))]),
    ]
