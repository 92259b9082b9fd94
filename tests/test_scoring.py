"""risk bands, actions, money at risk, priority quartiles."""

import pytest
from pyspark.sql import functions as F

from churnlab.functions.scalar import quartile_label, retention_action, risk_category
from churnlab.operators.scoring import score_customers

COLS = (
    "customer_id string, contract_type string, churned boolean, monthly_charges double, "
    "total_mrr double, monthly_revenue_at_risk double, support_ticket_count int, "
    "network_incident_count int, network_complaint_count int, cancellation_request_count int, "
    "late_payment_count int, late_payment_rate double, has_byod boolean, churn_probability double"
)
ROWS = [
    ("cust_low", "one_year", False, 50.0, 50.0, 0.0, 0, 0, 0, 0, 0, 0.0, False, 0.2),
    ("cust_medium", "month_to_month", False, 70.0, 90.0, 0.0, 1, 0, 0, 0, 0, 0.0, False, 0.45),
    ("cust_high", "two_year", True, 100.0, 150.0, 150.0, 2, 2, 1, 1, 2, 0.5, True, 0.8),
]


def test_risk_band_edges(spark):
    df = spark.createDataFrame([(p,) for p in [0.1, 0.3, 0.31, 0.6, 0.61, None, -0.02, 1.01, -0.01]], "p double")
    got = [r[0] for r in df.select(risk_category("p")).collect()]
    assert got == ["low", "low", "medium", "medium", "high", "nan", "nan", "nan", "nan"]


def test_score_table(spark):
    features = spark.createDataFrame(ROWS, COLS)
    rows = {r["customer_id"]: r for r in score_customers(features, "churn_probability").collect()}
    assert rows["cust_low"]["recommended_action"] == "monitor"
    assert rows["cust_medium"]["recommended_action"] == "contract_discount_offer"
    assert rows["cust_high"]["recommended_action"] == "urgent_save_call"
    assert rows["cust_high"]["estimated_monthly_revenue_at_risk"] == 120.0
    assert rows["cust_high"]["risk_category"] == "high"
    assert len(score_customers(features, "churn_probability").columns) == 18


def test_score_table_sorted_by_priority_text_then_money(spark):
    features = spark.createDataFrame(ROWS, COLS)
    out = [r["retention_priority"] for r in score_customers(features, "churn_probability").collect()]
    assert out == sorted(out)


def test_decision_list_each_branch(spark):
    cases = [
        ("low", 5, 5, 5, 1.0, "month_to_month", True, "monitor"),
        ("high", 1, 5, 5, 1.0, "month_to_month", True, "urgent_save_call"),
        ("high", 0, 2, 0, 1.0, "month_to_month", True, "service_recovery_credit"),
        ("medium", 0, 0, 1, 1.0, "month_to_month", True, "service_recovery_credit"),
        ("medium", 0, 1, 0, 0.25, "month_to_month", True, "billing_support_offer"),
        ("medium", 0, 1, 0, 0.2, "month_to_month", True, "contract_discount_offer"),
        ("medium", 0, 1, 0, 0.2, "one_year", True, "byod_loyalty_perk"),
        ("medium", 0, 1, 0, 0.2, "one_year", False, "general_retention_offer"),
    ]
    df = spark.createDataFrame(
        cases,
        "risk_category string, cancellation_request_count int, network_incident_count int, "
        "network_complaint_count int, late_payment_rate double, contract_type string, "
        "has_byod boolean, expected string",
    )
    for row in df.select(retention_action().alias("got"), "expected").collect():
        assert row["got"] == row["expected"]


def _quartile_sizes(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").alias("r"), F.lit(n).alias("n"))
    counts = {r[0]: r[1] for r in df.groupBy(quartile_label("r", "n")).count().collect()}
    return [counts.get(k, 0) for k in ("low", "medium", "high", "critical")]


def test_quartile_sizes_match_qcut(spark):
    assert _quartile_sizes(spark, 6) == [2, 1, 1, 2]
    assert _quartile_sizes(spark, 7) == [2, 2, 1, 2]
    assert _quartile_sizes(spark, 1) == [1, 0, 0, 0]


def test_quartile_formula_against_pandas_qcut(spark):
    pd = pytest.importorskip("pandas")
    for n in [2, 3, 4, 5, 9, 10, 11, 37, 100, 101]:
        ranks = pd.Series(range(1, n + 1))
        expected = pd.qcut(ranks, 4, labels=["low", "medium", "high", "critical"]).astype(str).tolist()
        df = spark.range(1, n + 1).select(F.col("id").alias("r"), F.lit(n).alias("n"))
        got = [r[0] for r in df.orderBy("r").select(quartile_label("r", "n")).collect()]
        assert got == expected, n


def test_null_probability_gives_nan(spark):
    rows = ROWS + [("cust_null", "one_year", False, 50.0, 50.0, 0.0, 0, 0, 0, 0, 0, 0.0, False, None)]
    features = spark.createDataFrame(rows, COLS)
    out = {r["customer_id"]: r for r in score_customers(features, "churn_probability").collect()}
    assert out["cust_null"]["risk_category"] == "nan"
    assert out["cust_null"]["retention_priority"] == "nan"
