"""Property tests (hypothesis): snake-casing is idempotent and matches its
definition; roll-ups do not depend on row order or partitioning."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlab.functions.scalar import snake_case
from churnlab.operators.summaries import summarize_billing

TEXT = st.text(alphabet=st.sampled_from(list("aB9 _-()/.é\t")), max_size=12)


def _snake(s: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", s.strip(" ").lower()).strip("_")


@settings(max_examples=10, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_snake_case_definition_and_idempotence(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    once = df.select(snake_case("v").alias("s"))
    got = [r[0] for r in once.collect()]
    assert got == [_snake(v) for v in values]
    twice = [r[0] for r in once.select(snake_case("s")).collect()]
    assert twice == got


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 4), st.integers(0, 10_000), st.booleans(), st.integers(0, 30)),
        min_size=1,
        max_size=40,
    ),
    st.integers(1, 7),
)
def test_rollup_is_permutation_invariant(spark, rows, parts):
    data = [
        (cust, i, cents, "late" if late else "paid", days)
        for i, (cust, cents, late, days) in enumerate(rows)
    ]
    schema = "customer_id long, invoice_id long, cents long, payment_status string, days_late int"
    base = spark.createDataFrame(data, schema).withColumn(
        "invoice_amount", (F.col("cents") / 100).cast("decimal(10,2)")
    )
    a = sorted(tuple(r) for r in summarize_billing(base).collect())
    shuffled = spark.createDataFrame(list(reversed(data)), schema).withColumn(
        "invoice_amount", (F.col("cents") / 100).cast("decimal(10,2)")
    ).repartition(parts)
    b = sorted(tuple(r) for r in summarize_billing(shuffled).collect())
    assert a == b
