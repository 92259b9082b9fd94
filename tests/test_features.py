"""nine tables -> features, customer_360 and KPI row.

The facts are drawn by a seeded generator; the expected values come from plain
Python over the same rows.
"""

import random
from collections import defaultdict

import pytest

from churnlab.operators import summaries
from churnlab.operators.features import build_customer_features
from churnlab.operators.views import customer_360, kpi_summary

CUSTOMER = (
    "customer_id long, gender string, senior_citizen boolean, has_partner boolean, has_dependents boolean, "
    "tenure_months bigint, phone_service boolean, multiple_lines string, internet_service string, "
    "online_security string, online_backup string, device_protection string, tech_support string, "
    "streaming_tv string, streaming_movies string, contract_type string, paperless_billing boolean, "
    "payment_method string, monthly_charges double, total_charges double, churned boolean, "
    "source_system string, is_synthetic boolean"
)
FACTS = {
    "fixed_subscriptions": "fixed_subscription_id long, customer_id long, monthly_recurring_revenue double, download_speed_mbps int",
    "mobile_subscriptions": "mobile_subscription_id long, customer_id long, line_count int, monthly_recurring_revenue double, is_5g_enabled boolean",
    "byod_devices": "device_id long, customer_id long, device_age_months int",
    "monthly_usage": "customer_id long, data_gb double, voice_minutes int, sms_count int, usage_month string",
    "billing_history": "invoice_id long, customer_id long, invoice_amount double, payment_status string, days_late int",
    "network_incidents": "incident_id long, customer_id long, duration_minutes int",
    "support_tickets": "ticket_id long, customer_id long, complaint_category_seed string, resolution_hours double",
    "retention_campaigns": "campaign_id long, customer_id long, accepted_offer boolean, offer_value double",
}
SEEDS = ["cancellation_request", "billing", "network_outage", "slow_internet", "device_problem", None]


def fact_rows(seed: int = 11, customers: int = 9):
    """Facts of customers 1..customers; the last one has none, ids may be null."""
    rng, rows = random.Random(seed), {name: [] for name in FACTS}
    quarter = lambda top: rng.randrange(4 * top) / 4  # noqa: E731  exact in binary
    for c in range(1, customers):
        for k in range(rng.randrange(5)):
            i = rng.choice([None, 10 * c + k, 10 * c + k])
            rows["fixed_subscriptions"].append((i, c, quarter(90), rng.choice([40, 250, 900])))
            rows["mobile_subscriptions"].append((i, c, rng.randrange(1, 5), quarter(60), rng.random() < 0.3))
            rows["byod_devices"].append((i, c, rng.choice([None, 3, 17, 30])))
            rows["monthly_usage"].append((c, quarter(400), rng.randrange(900), rng.randrange(300), f"2023-{k + 2:02d}"))
            rows["billing_history"].append((i, c, quarter(200), rng.choice(["late", "paid"]), rng.randrange(20)))
            rows["network_incidents"].append((i, c, rng.randrange(200)))
            rows["support_tickets"].append((i, c, rng.choice(SEEDS), quarter(70)))
            rows["retention_campaigns"].append((i, c, rng.choice([True, False, None]), quarter(40)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    add_ons = ["yes", "no"] * 3
    people = [
        [c, "female" if c % 2 else "male", c % 3 == 0, True, False, 4 * c, True, "yes", "dsl", *add_ons,
         "one_year", True, "mailed_check", 31.25 * c, 125.0 * c * c, c % 4 == 1, "made_up", False]
        for c in range(1, 10)
    ]
    out = {"customers": spark.createDataFrame(people, CUSTOMER)}
    for name, rows in fact_rows().items():
        out[name] = spark.createDataFrame(rows, FACTS[name])
    return out


def by_customer(name, column):
    """Non-null values of a fact column per customer, and rows per customer."""
    schema = [c.split()[0] for c in FACTS[name].split(", ")]
    values, count = defaultdict(list), defaultdict(int)
    for r in fact_rows()[name]:
        c = r[schema.index("customer_id")]
        count[c] += 1
        if r[schema.index(column)] is not None:
            values[c].append(r[schema.index(column)])
    return values, count


def mean(values):
    return sum(values) / len(values) if values else None


def test_features_follow_the_facts(tables):
    rows = {r["customer_id"]: r for r in build_customer_features(tables).collect()}
    assert sorted(rows) == list(range(1, 10))
    sums = {
        "fixed_mrr": ("fixed_subscriptions", "monthly_recurring_revenue"),
        "mobile_mrr": ("mobile_subscriptions", "monthly_recurring_revenue"),
        "mobile_line_count": ("mobile_subscriptions", "line_count"),
        "total_data_gb": ("monthly_usage", "data_gb"),
        "total_voice_minutes": ("monthly_usage", "voice_minutes"),
        "total_sms_count": ("monthly_usage", "sms_count"),
        "total_invoice_amount": ("billing_history", "invoice_amount"),
        "total_incident_minutes": ("network_incidents", "duration_minutes"),
    }
    means = {
        "avg_byod_device_age_months": ("byod_devices", "device_age_months"),
        "avg_monthly_data_gb": ("monthly_usage", "data_gb"),
        "avg_invoice_amount": ("billing_history", "invoice_amount"),
        "avg_days_late": ("billing_history", "days_late"),
        "avg_incident_minutes": ("network_incidents", "duration_minutes"),
        "avg_resolution_hours": ("support_tickets", "resolution_hours"),
        "avg_offer_value": ("retention_campaigns", "offer_value"),
    }
    counts = {  # non-null ids
        "fixed_subscription_count": ("fixed_subscriptions", "fixed_subscription_id"),
        "mobile_subscription_count": ("mobile_subscriptions", "mobile_subscription_id"),
        "byod_device_count": ("byod_devices", "device_id"),
        "invoice_count": ("billing_history", "invoice_id"),
        "network_incident_count": ("network_incidents", "incident_id"),
        "support_ticket_count": ("support_tickets", "ticket_id"),
        "retention_offer_count": ("retention_campaigns", "campaign_id"),
    }
    late, _ = by_customer("billing_history", "payment_status")
    seeds, _ = by_customer("support_tickets", "complaint_category_seed")
    accepted, _ = by_customer("retention_campaigns", "accepted_offer")
    for c, r in rows.items():
        for name, source in sums.items():
            assert r[name] == sum(by_customer(*source)[0][c])
        for name, source in means.items():  # nothing to average: 0 in the feature track
            assert r[name] == pytest.approx(mean(by_customer(*source)[0][c]) or 0.0)
        for name, source in counts.items():
            assert r[name] == len(by_customer(*source)[0][c])
        assert r["max_download_speed_mbps"] == max(by_customer("fixed_subscriptions", "download_speed_mbps")[0][c], default=0)
        assert r["has_5g"] == any(by_customer("mobile_subscriptions", "is_5g_enabled")[0][c])
        assert r["late_payment_count"] == late[c].count("late")
        assert r["cancellation_request_count"] == seeds[c].count("cancellation_request")
        assert r["billing_complaint_count"] == seeds[c].count("billing")
        assert r["network_complaint_count"] == seeds[c].count("network_outage") + seeds[c].count("slow_internet")
        assert r["accepted_offer_count"] == sum(accepted[c])
        assert r["total_mrr"] == r["fixed_mrr"] + r["mobile_mrr"]
        assert r["monthly_revenue_at_risk"] == (r["total_mrr"] if c % 4 == 1 else 0.0)
        assert r["has_byod"] == (r["byod_device_count"] > 0) and r["has_mobile"] == (r["mobile_subscription_count"] > 0)
        for rate, part, whole in (("late_payment_rate", "late_payment_count", "invoice_count"),
                                  ("retention_acceptance_rate", "accepted_offer_count", "retention_offer_count")):
            assert r[rate] == pytest.approx(r[part] / r[whole] if r[whole] else 0.0)


def test_feature_columns(tables):
    df = build_customer_features(tables)
    assert len(df.columns) == 23 + 29 + 8
    assert dict(df.dtypes)["support_ticket_count"] == "bigint"
    assert dict(df.dtypes)["total_voice_minutes"] == "double"


def test_view_counts_rows_and_keeps_null_averages(tables):
    view = customer_360(tables)
    assert len(view.columns) == 37
    for r in view.collect():
        c = r["customer_id"]
        for name, table in (("byod_device_count", "byod_devices"), ("support_ticket_count", "support_tickets"),
                            ("invoice_count", "billing_history"), ("retention_offer_count", "retention_campaigns")):
            assert r[name] == by_customer(table, "customer_id")[1][c]  # whatever the ids hold
        ages = by_customer("byod_devices", "device_age_months")[0][c]
        assert r["avg_byod_device_age_months"] == pytest.approx(mean(ages))
        assert r["avg_days_late"] == pytest.approx(mean(by_customer("billing_history", "days_late")[0][c]))
        assert r["mobile_mrr"] == sum(by_customer("mobile_subscriptions", "monthly_recurring_revenue")[0][c])


def test_kpi_row(tables):
    view = customer_360(tables).collect()
    (k,) = kpi_summary(customer_360(tables, exact=True)).collect()
    gone = sum(1 for r in view if r["churned"])
    assert (k["customer_count"], k["churned_customer_count"]) == (9, gone)
    assert k["customer_churn_rate"] == pytest.approx(gone / 9, abs=5e-5)
    total = sum(r["total_mrr"] for r in view)
    assert k["total_mrr"] == pytest.approx(total) and k["arpu"] == pytest.approx(total / 9)
    assert k["monthly_revenue_at_risk"] == pytest.approx(sum(r["total_mrr"] for r in view if r["churned"]))
    assert k["byod_customer_count"] == sum(1 for r in view if r["byod_device_count"] > 0)
    for name in ("support_ticket_count", "network_incident_count", "retention_offer_count", "accepted_offer_count"):
        assert k[name] == sum(r[name] for r in view)


def test_kpi_empty_input_gives_one_row(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    (k,) = kpi_summary(customer_360(empty, exact=True)).collect()
    assert k["customer_count"] == 0 and k["customer_churn_rate"] is None
    assert k["churned_customer_count"] is None  # SQL sum over no rows


def test_as_of_month_filters_facts(tables):
    rows = {r["customer_id"]: r for r in build_customer_features(tables, as_of_month="2023-03").collect()}
    for c in rows:
        kept = [r[1] for r in fact_rows()["monthly_usage"] if r[0] == c and r[4] <= "2023-03"]
        assert rows[c]["total_data_gb"] == sum(kept)
    with pytest.raises(ValueError, match="as_of_month"):
        build_customer_features(tables, as_of_month="2023-03", overrides={"monthly_usage": tables["monthly_usage"]})


def test_combined_summaries_count_rows_of_null_ids(spark):
    columns = (
        "customer_id long, role string, device_id long, device_age_months int, incident_id long, duration_minutes int, "
        "ticket_id long, complaint_category_seed string, resolution_hours double, campaign_id long, "
        "accepted_offer boolean, offer_value double"
    )
    nothing = [None] * 10
    ticket = [None] * 4 + [None, "billing", 2.0] + [None] * 3  # a ticket whose id is null
    facts = spark.createDataFrame(
        [[5, "support_tickets", *ticket], [5, "byod_devices", 8, 6, *nothing[2:]], [5, None, *nothing]], columns
    )
    sql = summaries.summarize_event_facts(facts, "sql").first()
    assert (sql["support_ticket_count"], sql["byod_device_count"], sql["network_incident_count"]) == (1, 1, 0)
    feature = summaries.summarize_event_facts(facts, "features").first()
    assert (feature["support_ticket_count"], feature["billing_complaint_count"]) == (0, 1)
