"""Per-customer churn explanations.

Attributions are computed as columns of the customer row, the top drivers are
picked inside the row with higher-order array functions, and labels come from a
literal map: the whole explanation is one projection (plus one global
aggregate for the background means of a linear model).  No row leaves the JVM.

For a linear model with independent inputs the exact Shapley value of input
*j* is ``coef_j * (x_j - mean_j)`` (in margin / log-odds units).  Tree models
are explained by :mod:`churnlab.operators.tree_explain`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions.constants import (
    FEATURE_LABELS,
    FEATURE_PREFIXES,
    NO_DRIVER_LABEL,
    TOP_FACTOR_COUNT,
)
from churnlab.functions.scalar import col_, round_half_up


def clean_feature_name(name: str | Column) -> Column:
    """Drop the two prefixes, '_' -> ' ', then the business label map;
    names not in the map pass through."""
    cleaned = col_(name)
    for prefix in FEATURE_PREFIXES:
        cleaned = F.replace(cleaned, F.lit(prefix), F.lit(""))
    cleaned = F.replace(cleaned, F.lit("_"), F.lit(" "))
    labels = F.create_map(*[x for k, v in FEATURE_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(labels, cleaned), cleaned)


def linear_background(
    features: DataFrame, terms: Sequence[tuple[str, str, float, int]]
) -> dict[str, float]:
    """Mean of every model input over ``features`` (one global aggregate).

    Sums run exactly (decimal of the declared scale), so the means do not depend
    on partition order.  The result is one number per input.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, (_name, expr, _coef, scale) in enumerate(terms):
        value = F.expr(expr)
        exact = value.cast("bigint") if scale == 0 else value.cast(T.DecimalType(38, scale))
        aggs.append(F.sum(exact).alias(f"_s{i}"))
    row = features.agg(*aggs).first()
    n = float(row["_n"]) if row["_n"] else 1.0
    return {
        name: (float(row[f"_s{i}"]) if row[f"_s{i}"] is not None else 0.0) / n
        for i, (name, _e, _c, _s) in enumerate(terms)
    }


def linear_impacts(
    features: DataFrame,
    terms: Sequence[tuple[str, str, float, int]],
    background: dict[str, float],
) -> Column:
    """array<struct<name, impact>> of coef * (x - mean), in input order."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                (F.lit(coef) * (F.expr(expr).cast("double") - F.lit(float(background[name])))).alias(
                    "impact"
                ),
            )
            for name, expr, coef, _scale in terms
        ]
    )


def top_drivers(impacts: Column, n: int = TOP_FACTOR_COUNT) -> Column:
    """W5 + L5: the n largest positive impacts; if none is positive, the n
    largest by absolute value (sign kept); padded with the no-driver label.

    Ties keep input order.  Returns array<struct<name, impact>> of length n,
    names already business labels, impacts rounded to 4 decimals.
    """
    keyed = F.transform(
        impacts,
        lambda s, i: F.struct(
            (-s["impact"]).alias("k1"),
            (-F.abs(s["impact"])).alias("k2"),
            i.alias("pos"),
            s["name"].alias("name"),
            s["impact"].alias("impact"),
        ),
    )

    def chosen(keyed: Column) -> Column:
        positive = F.filter(keyed, lambda s: s["impact"] > 0)
        by_value = F.array_sort(
            positive, lambda a, b: _compare(a["k1"], b["k1"], a["pos"], b["pos"])
        )
        by_abs = F.array_sort(keyed, lambda a, b: _compare(a["k2"], b["k2"], a["pos"], b["pos"]))
        return F.slice(F.when(F.size(positive) > 0, by_value).otherwise(by_abs), 1, n)

    pad = F.struct(F.lit(NO_DRIVER_LABEL).alias("name"), F.lit(0.0).alias("impact"))

    def labelled(picked: Column) -> Column:
        return F.array(
            *[
                F.when(
                    F.size(picked) > i,
                    F.struct(
                        clean_feature_name(F.element_at(picked, i + 1)["name"]).alias("name"),
                        round_half_up(F.element_at(picked, i + 1)["impact"], 4).alias("impact"),
                    ),
                ).otherwise(pad)
                for i in range(n)
            ]
        )

    return _once(_once(keyed, chosen), labelled)


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _compare(ka, kb, pa, pb) -> Column:
    return (
        F.when(ka < kb, F.lit(-1))
        .when(ka > kb, F.lit(1))
        .when(pa < pb, F.lit(-1))
        .when(pa > pb, F.lit(1))
        .otherwise(F.lit(0))
    )


def explanation_table(
    features: DataFrame,
    probability: Column,
    impacts: Column,
    key: str = "customer_id",
    n: int = TOP_FACTOR_COUNT,
) -> DataFrame:
    """Id, probability (6 decimals), n x (top_factor_i, top_factor_i_impact)."""
    tops = features.select(
        F.col(key),
        round_half_up(probability, 6).alias("churn_probability"),
        top_drivers(impacts, n).alias("_top"),
    )
    cols = [F.col(key), F.col("churn_probability")]
    for i in range(n):
        cols += [
            F.col("_top")[i]["name"].alias(f"top_factor_{i + 1}"),
            F.col("_top")[i]["impact"].alias(f"top_factor_{i + 1}_impact"),
        ]
    return tops.select(*cols)


def with_explanation_columns(df: DataFrame, impacts: Column, n: int = TOP_FACTOR_COUNT) -> DataFrame:
    """J3 without a join: the n (top_factor_i, top_factor_i_impact) columns added
    to rows that already carry the model inputs."""
    tops = df.withColumn("_top", top_drivers(impacts, n))
    cols = []
    for i in range(n):
        cols += [
            F.col("_top")[i]["name"].alias(f"top_factor_{i + 1}"),
            F.col("_top")[i]["impact"].alias(f"top_factor_{i + 1}_impact"),
        ]
    return tops.select(*df.columns, *cols)


def driver_rows(explanations: DataFrame, key: str = "customer_id", n: int = TOP_FACTOR_COUNT) -> DataFrame:
    """One row per (customer, rank) with factor and impact (unpivot)."""
    stacked = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i + 1).cast("bigint").alias("rank"),
                    F.col(f"top_factor_{i + 1}").alias("factor"),
                    F.col(f"top_factor_{i + 1}_impact").alias("impact"),
                )
                for i in range(n)
            ]
        )
    )
    return explanations.select(key, stacked.alias("_d")).select(key, "_d.rank", "_d.factor", "_d.impact")
