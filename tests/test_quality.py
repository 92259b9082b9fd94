"""Quality audits and profile."""

from pyspark.sql import functions as F

from churnlab.operators import quality


def test_key_audit_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (" a",), (None,), (None,), ("b",)], "k string")
    row = quality.key_audit({"t": df}, {"t": "k"}).first()
    assert row["row_count"] == 6 and row["null_key_count"] == 2
    assert row["duplicate_key_count"] == 2  # one extra 'a', one extra null
    assert row["duplicate_trimmed_key_count"] == 3  # ' a' clashes with 'a' after trim


def test_fk_orphans(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1,), (3,), (None,), (3,)], "pid long")
    row = quality.fk_orphans({"p": parent, "c": child}, [("c", "pid", "p", "id")]).first()
    assert row["orphan_count"] == 2


def test_range_and_null_audit(spark):
    df = spark.createDataFrame([(1, -1.0), (None, 2.0), (-5, None)], "a int, b double")
    rng = {r["rule_name"]: r["violation_count"] for r in quality.range_audit(
        {"t": df}, [("t", "a_pos", "a >= 0"), ("t", "b_pos", "b >= 0")]).collect()}
    assert rng == {"a_pos": 1, "b_pos": 1}
    nulls = {r["column_name"]: r["null_count"] for r in quality.null_audit({"t": df}).collect()}
    assert nulls == {"a": 1, "b": 1}


def test_profile_columns(spark):
    df = spark.createDataFrame(
        [("x", " ", 1), ("y", "12.5", 2), (None, "1d", 2), ("x", None, None)], "s string, t string, n int"
    )
    rows = {r["column_name"]: r for r in quality.profile_columns(df).collect()}
    assert rows["s"]["null_count"] == 1 and rows["s"]["distinct_count"] == 2
    assert rows["t"]["blank_count"] == 1 and rows["t"]["parse_failure_count"] == 2  # ' ' and '1d'
    assert rows["n"]["min_value"] == 1.0 and rows["n"]["max_value"] == 2.0
    assert rows["n"]["row_count"] == 4 and rows["n"]["data_type"] == "int"


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (None, "z")], "k int, v string")
    got = {r["metric"]: r["value"] for r in quality.duplicate_report(df, "k").collect()}
    assert got == {"row_count": 5, "duplicate_row_count": 2, "duplicate_key_count": 2}


def test_label_distribution_drops_nulls(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("No",), (None,)], "Churn string")
    got = {r[0]: r[1] for r in quality.label_distribution(df, "Churn").collect()}
    assert got == {"Yes": 1, "No": 2}


def test_blank_counts_any_whitespace(spark):
    df = spark.createDataFrame([("\t",), (" \n ",), ("x",), (None,)], "s string")
    row = quality.profile_columns(df).first()
    assert row["blank_count"] == 2 and row["null_count"] == 1


def test_references_of_several_relations_and_types(spark):
    parents = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "id string")
    lines = spark.createDataFrame([(1, "a"), (2, "z"), (3, None), (3, "z")], "line int, owner string")
    devices = spark.createDataFrame([("a", 1), ("q", 9), ("q", None), (None, 2), ("b", 9)], "owner string, line long")
    relations = [
        ("lines", "owner", "parents", "id"),
        ("devices", "owner", "parents", "id"),
        ("devices", "line", "lines", "line"),
    ]
    got = quality.fk_orphans({"parents": parents, "lines": lines, "devices": devices}, relations).collect()
    assert [(r["child_table"], r["child_column"], r["orphan_count"]) for r in got] == [
        ("lines", "owner", 2), ("devices", "owner", 2), ("devices", "line", 2)
    ]
    none = parents.limit(0)
    got = quality.fk_orphans({"parents": none, "lines": lines.limit(0)}, relations[:1]).collect()
    assert [r["orphan_count"] for r in got] == [0]


def test_key_audit_of_empty_and_hot_keys(spark):
    from pyspark.sql import functions as F

    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, " k").otherwise(F.col("id").cast("string")).alias("key"))
    rows = {r["table_name"]: r for r in quality.key_audit({"hot": hot, "none": hot.limit(0)}, {"hot": "key", "none": "key"}).collect()}
    assert rows["hot"]["row_count"] == 3000 and rows["hot"]["duplicate_key_count"] == 999
    assert rows["none"].asDict() == {
        "table_name": "none", "key_column": "key", "row_count": 0, "null_key_count": 0,
        "duplicate_key_count": 0, "duplicate_trimmed_key_count": 0,
    }
