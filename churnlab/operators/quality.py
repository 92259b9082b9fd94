"""Validation, data-quality audits and profiling.

Every audit is one pass (or one aggregate per table) that returns a small
report DataFrame; nothing is collected unless a caller wants to raise on it.
Per-column statistics are computed by unpivoting the columns into
(column, value) pairs and grouping once by column, rather than one aggregate
(and one Expand) per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions.scalar import strip_whitespace, text_to_double

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# --- V1, V2, U4: column contracts (metadata only) ---------------------------


def column_differences(columns: Iterable[str], expected: Iterable[str]) -> tuple[list[str], list[str]]:
    """U4: (sorted missing, sorted unexpected)."""
    have, want = set(columns), set(expected)
    return sorted(want - have), sorted(have - want)


def validate_columns(df: DataFrame, expected: Sequence[str]) -> None:
    """V1: exactly the expected columns; missing or extra is an error."""
    missing, unexpected = column_differences(df.columns, expected)
    if missing or unexpected:
        raise ValueError(
            f"Source schema mismatch. Missing: {missing}; Unexpected: {unexpected}"
        )


def require_columns(df: DataFrame, required: Iterable[str], what: str = "Table") -> None:
    """V2: the required subset is present."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")


# --- V3-V5, V13: keys --------------------------------------------------------


@dataclass(frozen=True)
class Key:
    """A key column of ``table``; only rows with ``when`` belong to the table."""

    table: str
    name: str
    value: Column
    when: Column | None = None


def key_audit_of(sources: Sequence[tuple[DataFrame, Sequence[Key]]]) -> DataFrame:
    """V3 + V4 + V5: primary-key report, one row per table: row_count,
    null_key_count, duplicate_key_count (every occurrence after the first; nulls
    equal) and duplicate_trimmed_key_count (the same after trimming string keys;
    trimming can create clashes).

    The keys of all tables are one stream of (table, key), each source scanned
    once.  It is counted by raw key, first in each map task, then by trimmed key;
    no join, and no shuffle for each table.  An empty table has a row of zeros.
    """
    stream, names = None, {}
    for df, keys in sources:
        said = []
        for k in keys:
            names[k.table] = k.name
            text = isinstance(df.select(k.value.alias("k")).schema["k"].dataType, T.StringType)
            said.append(
                F.struct(
                    F.lit(k.table).alias("table_name"),
                    k.value.cast("string").alias("key"),
                    F.lit(text).alias("is_text"),
                    (F.lit(True) if k.when is None else F.coalesce(k.when, F.lit(False))).alias("belongs"),
                )
            )
        rows = df.select(F.explode(F.array(*said)).alias("s")).select("s.*").where("belongs").drop("belongs")
        stream = rows if stream is None else stream.unionByName(rows)
    per_key = stream.groupBy("table_name", "is_text", "key").agg(F.count(F.lit(1)).alias("c"))
    trimmed = F.when(F.col("is_text"), strip_whitespace(F.col("key"))).otherwise(F.col("key"))
    per_trimmed = per_key.groupBy("table_name", trimmed.alias("t")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("raw"))
    counted = per_trimmed.select(
        "table_name",
        F.col("c").alias("row_count"),
        F.when(F.col("t").isNull(), F.col("c")).otherwise(0).alias("null_key_count"),
        (F.col("c") - F.col("raw")).alias("duplicate_key_count"),
        (F.col("c") - 1).alias("duplicate_trimmed_key_count"),
    )
    counts = counted.columns[1:]
    # every table is in the report, also an empty one
    tables = F.explode(F.array(*map(F.lit, names))).alias("table_name")
    seed = stream.sparkSession.range(1).select(tables).select("table_name", *(F.lit(0).cast("long").alias(c) for c in counts))
    key_column = F.element_at(F.create_map(*(F.lit(x) for item in names.items() for x in item)), F.col("table_name"))
    total = counted.union(seed).groupBy("table_name").agg(*(F.sum(c).cast("bigint").alias(c) for c in counts))
    return total.select("table_name", key_column.alias("key_column"), *counts)


def key_stats(df: DataFrame, key: str) -> DataFrame:
    """One row: the four counts of :func:`key_audit_of` for one table."""
    return key_audit_of([(df, [Key("table", key, F.col(key))])]).drop("table_name", "key_column")


def key_audit(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """:func:`key_audit_of` of plain tables; each is one source."""
    return key_audit_of([(tables[table], [Key(table, key, F.col(key))]) for table, key in keys.items()])


# --- V6: foreign keys ---------------------------------------------------------


@dataclass(frozen=True)
class Reference:
    """What the rows of a table say about keys of a parent table: that they are
    there (``child`` is None), or ``n`` references from ``child`` = (table,
    column).  Rows whose ``key`` is null say nothing."""

    parent: str
    key: Column
    child: tuple[str, str] | None = None
    n: Column | None = None


def reference_orphans(
    sources: Sequence[tuple[DataFrame, Sequence[Reference]]],
    relations: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """V6 + J8: rows whose non-null reference has no parent row, per relation.

    All tables make one stream of (parent table, key, is it a parent row,
    references by relation).  It is added up by (parent table, key), first in
    each map task - so a key that a third of the rows name is one row a task -
    and shuffled once; a key without a parent row gives its references to the
    orphans.  A source is scanned once, whatever the number of its references.
    """
    place = {(child, column, parent): i for i, (child, column, parent, _) in enumerate(relations)}
    integral = all(
        isinstance(df.select(r.key.alias("k")).schema["k"].dataType, T.IntegralType) for df, rs in sources for r in rs
    )
    stream = None
    for df, references in sources:
        said = [
            F.struct(
                F.lit(r.parent).alias("parent"),
                r.key.cast("bigint" if integral else "string").alias("key"),
                F.lit(r.child is None).alias("is_parent"),
                F.lit(-1 if r.child is None else place[*r.child, r.parent]).alias("relation"),
                (F.lit(1) if r.n is None else r.n).cast("bigint").alias("n"),
            )
            for r in references
        ]
        rows = df.select(F.explode(F.array(*said)).alias("s")).select("s.*").where("key IS NOT NULL")
        stream = rows if stream is None else stream.unionByName(rows)
    counts = [F.sum(F.when(F.col("relation") == i, F.col("n")).otherwise(0)).alias(f"n_{i}") for i in range(len(relations))]
    keys = stream.groupBy("parent", "key").agg(F.max("is_parent").alias("has_parent"), *counts)
    orphans = keys.where(~F.col("has_parent")).agg(
        *(F.coalesce(F.sum(f"n_{i}"), F.lit(0)).cast("bigint").alias(f"n_{i}") for i in range(len(relations)))
    )
    rows = [
        F.struct(
            F.lit(child).alias("child_table"),
            F.lit(column).alias("child_column"),
            F.lit(parent).alias("parent_table"),
            F.col(f"n_{i}").alias("orphan_count"),
        )
        for i, (child, column, parent, _) in enumerate(relations)
    ]
    return orphans.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def fk_orphans(
    tables: dict[str, DataFrame], relations: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """:func:`reference_orphans` of plain tables; each is one source."""
    said: dict[str, list[Reference]] = {}
    for child, column, parent, _ in relations:
        said.setdefault(child, []).append(Reference(parent, F.col(column), (child, column)))
    for parent, column in dict.fromkeys((parent, column) for _, _, parent, column in relations):
        said.setdefault(parent, []).append(Reference(parent, F.col(column)))
    return reference_orphans([(tables[t], refs) for t, refs in said.items()], relations)


# --- V7, V8: rules and not-null -----------------------------------------------


def range_audit(tables: dict[str, DataFrame], rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """V7: violations per rule; a null value passes (as a SQL CHECK does).
    One pass per table evaluates all of its rules."""
    by_table: dict[str, list[tuple[str, str]]] = {}
    for table, name, predicate in rules:
        by_table.setdefault(table, []).append((name, predicate))
    parts = []
    for table, table_rules in by_table.items():
        counts = tables[table].agg(
            *[
                F.count_if(~F.coalesce(F.expr(pred), F.lit(True))).alias(f"_r{i}")
                for i, (_n, pred) in enumerate(table_rules)
            ]
        )
        parts.append(
            _unpivot_row(
                counts,
                [(f"_r{i}", name) for i, (name, _p) in enumerate(table_rules)],
                "rule_name",
                "violation_count",
            ).select(F.lit(table).alias("table_name"), "rule_name", "violation_count")
        )
    return _union(parts)


def null_audit(tables: dict[str, DataFrame], schemas: dict[str, T.StructType] | None = None) -> DataFrame:
    """V8: null count per column of every table (one pass per table)."""
    parts = []
    for table, df in tables.items():
        cols = [f.name for f in (schemas[table].fields if schemas else df.schema.fields) if f.name in df.columns]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
        parts.append(
            _unpivot_row(
                counts, [(f"_n{i}", c) for i, c in enumerate(cols)], "column_name", "null_count"
            ).select(F.lit(table).alias("table_name"), "column_name", "null_count")
        )
    return _union(parts)


# --- V11-V19: profile ---------------------------------------------------------


def profile_columns(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """V11 + V14-V16 + V18 + V19: one row per column.

    row_count, column_position, data_type, null_count, blank_count (trimmed
    text = ''; nulls are not blank), distinct_count (non-null), parse_failure_count
    (non-null values that are not numbers as text), min/max (numeric columns).
    One unpivot + one group-by for the text statistics; one aggregate for the
    numeric ranges.
    """
    fields = df.schema.fields
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).cast("string").alias("value"))
                for f in fields
            ]
        )
    )
    long = df.select(pairs.alias("_p")).select("_p.column_name", "_p.value")
    distinct = F.countDistinct("value") if exact_distinct else F.approx_count_distinct("value")
    text_stats = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.count_if(strip_whitespace("value") == "").alias("blank_count"),
        distinct.cast("bigint").alias("distinct_count"),
        F.count_if(F.col("value").isNotNull() & text_to_double("value").isNull()).alias(
            "parse_failure_count"
        ),
    )
    numeric = [f.name for f in fields if isinstance(f.dataType, NUMERIC)]
    meta = df.sparkSession.createDataFrame(
        [(f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(fields)],
        "column_name string, column_position int, data_type string",
    )
    out = meta.join(text_stats, "column_name", "left")
    if numeric:
        ranges = df.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                        for c in numeric
                    ]
                )
            ).alias("_r")
        ).groupBy("_r.column_name").agg(
            F.min("_r.v").alias("min_value"), F.max("_r.v").alias("max_value")
        )
        out = out.join(ranges, "column_name", "left")
    else:
        out = out.withColumn("min_value", F.lit(None).cast("double")).withColumn(
            "max_value", F.lit(None).cast("double")
        )
    return out.select(
        "column_name",
        F.col("column_position").cast("bigint").alias("column_position"),
        "data_type",
        F.col("row_count").cast("bigint").alias("row_count"),
        F.col("null_count").cast("bigint").alias("null_count"),
        F.col("blank_count").cast("bigint").alias("blank_count"),
        "distinct_count",
        F.col("parse_failure_count").cast("bigint").alias("parse_failure_count"),
        "min_value",
        "max_value",
    )


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """V12 + V13 as (metric, value) rows: row_count, duplicate_row_count
    (rows - distinct rows, nulls equal) and duplicate_key_count."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    rows = per_row.agg(
        F.sum("_c").alias("row_count"), F.sum(F.col("_c") - 1).alias("duplicate_row_count")
    )
    keys = key_stats(df, key)
    return _unpivot_row(
        rows, [("row_count", "row_count"), ("duplicate_row_count", "duplicate_row_count")],
        "metric", "value",
    ).unionByName(
        _unpivot_row(keys, [("duplicate_key_count", "duplicate_key_count")], "metric", "value")
    ).select("metric", F.coalesce("value", F.lit(0).cast("bigint")).alias("value"))


def label_distribution(df: DataFrame, label: str | Column, name: str = "label") -> DataFrame:
    """V17 + A13: rows per non-null label value."""
    c = F.col(label) if isinstance(label, str) else label
    return (
        df.select(c.alias(name))
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
    )


# --- helpers -------------------------------------------------------------------


def _unpivot_row(row: DataFrame, pairs: list[tuple[str, str]], name_col: str, value_col: str) -> DataFrame:
    exploded = F.explode(
        F.array(
            *[
                F.struct(F.lit(label).alias(name_col), F.col(col).cast("bigint").alias(value_col))
                for col, label in pairs
            ]
        )
    )
    return row.select(exploded.alias("_u")).select(f"_u.{name_col}", f"_u.{value_col}")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
