"""Report layer: display text (P32), named views (S9), column contracts (V2)."""

import pytest

from churnlab.operators.quality import require_columns
from churnlab.plans import reports
from churnlab.sources import roles
from tests.conftest import SF_SMALL


def test_display_text(spark):
    df = spark.createDataFrame([(1234567.4, 0.2345, -12.5), (None, 1.0, 0.0)], "m double, r double, n double")
    rows = df.select(
        reports.format_currency("m").alias("m"),
        reports.format_percent("r").alias("r"),
        reports.format_currency("n", 2).alias("n"),
    ).collect()
    assert (rows[0]["m"], rows[0]["r"], rows[0]["n"]) == ("$1,234,567", "23.4%", "-$12.50")
    assert rows[1]["m"] is None and rows[1]["r"] == "100.0%" and rows[1]["n"] == "$0.00"


def test_executive_tiles_text(spark):
    tiles = spark.createDataFrame([(7043, 0.2654, 456116.6, 139130.8)],
                                  "customers long, churn_rate double, total_mrr double, expected_revenue_at_risk double")
    row = reports.executive_tiles_text(tiles).first()
    assert row["customers"] == "7,043" and row["observed_churn_rate"] == "26.5%"
    assert row["monthly_recurring_revenue"] == "$456,117"


def test_named_views(spark):
    tables = roles.register_views(spark, SF_SMALL)
    assert spark.sql("SELECT count(*) FROM customers").first()[0] == 150
    n_tickets = spark.sql("SELECT count(*) FROM ticket_texts").first()[0]
    assert n_tickets == tables["ticket_texts"].count() > 0


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "t")], "ticket_id long, customer_id string")
    require_columns(df, ["ticket_id", "customer_id"])
    with pytest.raises(ValueError, match=r"\['ticket_text'\]"):
        require_columns(df, ["ticket_id", "customer_id", "ticket_text"], "Support tickets")


def test_join_based_customer_360(spark):
    features = spark.createDataFrame([(1, 10.0), (2, 20.0)], "customer_id long, total_mrr double")
    scores = spark.createDataFrame(
        [(1, 0.5, "medium", "high", "monitor", 5.0)],
        "customer_id long, churn_probability double, risk_category string, retention_priority string, "
        "recommended_action string, estimated_monthly_revenue_at_risk double",
    )
    c360 = reports.customer_scores(features, scores)
    assert c360.count() == 2 and c360.filter("customer_id = 2").first()["risk_category"] is None
    assert reports.with_explanations(c360, None) is c360
    expl = spark.createDataFrame([(1, "a", 1.0, "b", 0.5, "c", 0.1)], ", ".join(
        f"{c} {'long' if c == 'customer_id' else 'double' if c.endswith('impact') else 'string'}"
        for c in reports.EXPLANATION_COLUMNS))
    joined = reports.with_explanations(c360, expl)
    assert joined.filter("customer_id = 1").first()["top_factor_1"] == "a"
