"""top drivers (W5, L5), label cleanup (P28), linear attributions."""

import random

import pytest
from pyspark.sql import functions as F

from churnlab.operators.explain import clean_feature_name, explanation_table, top_drivers


def drivers(spark, names, impacts, n=3):
    df = spark.createDataFrame([(names, impacts)], "names array<string>, impacts array<double>")
    arr = F.arrays_zip(F.col("names").alias("name"), F.col("impacts").alias("impact"))
    row = df.select(top_drivers(arr, n).alias("d")).first()["d"]
    return [(d["name"], d["impact"]) for d in row]


def expected_drivers(impacts, n):
    """The rule: the n largest positive impacts, padded; without any, the n largest by
    size.  Ties keep the order of the input."""
    labelled = [(f"input {i}", round(x, 4)) for i, x in enumerate(impacts)]
    positive = [d for d in labelled if d[1] > 0]
    if positive:
        rest = [("No additional positive driver", 0.0)] * n
        return (sorted(positive, key=lambda d: -d[1]) + rest)[:n]
    return sorted(labelled, key=lambda d: -abs(d[1]))[:n]


@pytest.mark.parametrize("seed", range(4))
def test_top_drivers_of_drawn_impacts(spark, seed):
    rng = random.Random(seed)
    impacts = [rng.randint(-400, 400) / 100 for _ in range(9)]
    names = [f"numeric__input_{i}" for i in range(9)]
    n = 2 + seed % 3
    assert drivers(spark, names, impacts, n) == expected_drivers(impacts, n)


def test_without_positive_impacts_size_decides(spark):
    rng = random.Random(9)
    impacts = [-rng.randint(1, 400) / 100 for _ in range(6)]
    got = drivers(spark, [f"numeric__input_{i}" for i in range(6)], impacts, 4)
    assert got == expected_drivers(impacts, 4)


def test_padding_when_few_positive(spark):
    got = drivers(spark, ["numeric__tenure_months", "numeric__has_byod"], [0.3, -0.4])
    assert got == [
        ("customer tenure", 0.3),
        ("No additional positive driver", 0.0),
        ("No additional positive driver", 0.0),
    ]


def test_ties_keep_input_order_and_rounding(spark):
    got = drivers(spark, ["numeric__a_b", "numeric__c_d"], [0.123456, 0.123456])
    assert got[0] == ("a b", 0.1235) and got[1] == ("c d", 0.1235)


def test_label_cleanup(spark):
    df = spark.createDataFrame(
        [("categorical__contract_type_month_to_month",), ("numeric__late_payment_rate",),
         ("numeric__some_new_column",), ("numeric__has_5g",)],
        "n string",
    )
    got = [r[0] for r in df.select(clean_feature_name("n")).collect()]
    assert got == ["month-to-month contract", "late payment rate", "some new column", "5G enabled"]


def test_explanation_table_columns(spark):
    df = spark.createDataFrame([("c1", 0.1234567, ["numeric__x"], [0.5])],
                               "customer_id string, p double, names array<string>, impacts array<double>")
    arr = F.arrays_zip(F.col("names").alias("name"), F.col("impacts").alias("impact"))
    out = explanation_table(df, F.col("p"), arr).first()
    assert out["churn_probability"] == 0.123457
    assert out["top_factor_1"] == "x" and out["top_factor_1_impact"] == 0.5
    assert out["top_factor_3"] == "No additional positive driver"
