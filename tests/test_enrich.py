"""plan mapping, one fixed line per customer, month grid, usage grid
(P22-P26, J6, J7, U2)."""

import pytest
from pyspark.sql import functions as F

from churnlab.operators import enrich

COLS = (
    "customer_id long, tenure_months int, monthly_charges double, total_charges double, "
    "contract_type string, internet_service string, phone_service boolean, churned boolean"
)
ROWS = [
    (1, 12, 70.0, 840.0, "month_to_month", "fiber_optic", True, False),
    (2, 24, 45.0, 1080.0, "one_year", "dsl", True, True),
    (3, 3, 20.0, 60.0, "two_year", "no", False, False),
]


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(ROWS, COLS)


def test_fixed_subscriptions(customers):
    rows = {r["customer_id"]: r for r in enrich.fixed_subscriptions_from_customers(customers).collect()}
    assert len(rows) == 3
    assert [rows[i]["plan_name"] for i in (1, 2, 3)] == ["Fiber Max", "DSL Essential", "Voice Only"]
    assert [rows[i]["download_speed_mbps"] for i in (1, 2, 3)] == [500, 100, 0]
    assert rows[2]["subscription_status"] == "cancelled" and rows[1]["subscription_status"] == "active"
    assert rows[1]["fixed_subscription_id"] == "fix_000002"


def test_padded_id_never_truncates(spark):
    df = spark.createDataFrame([(5,), (12345678,)], "n long")
    assert [r[0] for r in df.select(enrich.padded_id("use_", "n", 6)).collect()] == ["use_000005", "use_12345678"]


def test_month_grid(customers):
    grid = enrich.month_grid(customers)
    assert grid.count() == 36
    months = sorted({r[0] for r in grid.select("usage_month").collect()})
    assert months[0] == "2024-01" and months[-1] == "2024-12" and len(months) == 12


def test_service_usage_grid(spark, customers):
    fixed = enrich.fixed_subscriptions_from_customers(customers)
    mobile = spark.createDataFrame(
        [(10, 1), (11, 1), (12, 99)], "mobile_subscription_id long, customer_id long"
    )
    grid = enrich.service_usage_grid(customers, fixed, mobile)
    counts = {(r[0], r[1]): r[2] for r in grid.groupBy("customer_id", "service_type").count().collect()}
    assert counts[(1, "fixed_broadband")] == 12 and counts[(1, "mobile")] == 24
    assert (99, "mobile") not in counts  # only customers in the spine


def test_clip_and_price(spark):
    df = spark.createDataFrame([(1.004,), (2000.0,), (-3.0,)], "v double")
    out = [r[0] for r in df.select(enrich.clip_round("v", 1.0, 168.0, 2)).collect()]
    assert out == [1.0, 168.0, 1.0]
    trunc = [r[0] for r in df.select(enrich.clip_round("v", 5.0, 720.0, None)).collect()]
    assert trunc == [5, 720, 5]
    plans = spark.createDataFrame([("Premium 5G",), ("Mobile Starter",), ("Unknown",)], "p string")
    assert [r[0] for r in plans.select(enrich.plan_price("p")).collect()] == [85.0, 35.0, None]
