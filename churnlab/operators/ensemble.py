"""Tree ensembles as column expressions (M9), and a fixed one.

A tree is nested ``CASE WHEN``s over the model's inputs and an ensemble the sum
of its trees, so scoring stays in the JVM, in the stage that computes the
inputs: no Python worker, no model object in the tasks.

The fixed ensemble below stands in for a boosted model: its trees are known, so
that a SQL engine can compute the same scores and the same attributions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.functions.scalar import logistic, round_half_up
from churnlab.operators.tree_explain import (
    TreeArrays,
    ensemble_arrays,
    ensemble_factors,
    ensemble_impacts,
)

# Nodes that become one expression; larger models score through Spark ML.
MAX_COMPILED_NODES = 4_000

# Our own fixed ensemble.  Inputs: (model input name, SQL expression over the
# feature row).  Splits: (input, threshold or set of codes, left, right); a row
# goes left at or below the threshold, or if its code is in the set.  Leaves:
# (log-odds, training cover).
INPUTS: list[tuple[str, str]] = [
    (
        "contract_type",
        "CASE contract_type WHEN 'month_to_month' THEN 0 WHEN 'one_year' THEN 1 ELSE 2 END",
    ),
    ("tenure_months", "tenure_months"),
    ("monthly_charges", "monthly_charges"),
    ("support_ticket_count", "support_ticket_count"),
    ("network_incident_count", "network_incident_count"),
    ("late_payment_count", "late_payment_count"),
]
CONTRACT, TENURE, CHARGES, TICKETS, INCIDENTS, LATE = range(len(INPUTS))
INTERCEPT = -0.4137
TREES: list[tuple[float, tuple]] = [
    (1.0, (TENURE, 12.5,
           (CONTRACT, {0}, (0.8317, 131), (0.2143, 67)),
           (LATE, 1.5,
            (TENURE, 40.5, (-0.1739, 211), (-0.6271, 331)),
            (0.3419, 59)))),
    (0.7, (CHARGES, 64.35,
           (CHARGES, 35.15, (-0.3923, 173), (-0.1181, 127)),
           (TICKETS, 2.5,
            (CONTRACT, {0, 2}, (0.1637, 241), (-0.0871, 109)),
            (TENURE, 24.5, (0.7411, 89), (0.2917, 61))))),
    (0.5, (INCIDENTS, 1.5,
           (LATE, 0.5, (-0.2713, 307), (0.1091, 97)),
           (INCIDENTS, 4.5,
            (TENURE, 30.5, (0.4517, 151), (0.0739, 113)),
            (TICKETS, 4.5, (0.5923, 79), (0.9371, 53))))),
    (0.3, (0.0417, 800)),
]


def grow(nested: tuple) -> TreeArrays:
    """Arrays of a nested tree; the cover of a split is the sum of its leaves'."""
    rows: list[list] = []  # left, right, input, threshold, codes, value, cover

    def add(node: tuple) -> int:
        at = len(rows)
        if len(node) == 2:
            rows.append([-1, -1, -1, 0.0, None, float(node[0]), float(node[1])])
            return at
        feature, test, left, right = node
        codes = frozenset(float(c) for c in test) if isinstance(test, set | frozenset) else None
        rows.append([-1, -1, feature, 0.0 if codes is not None else float(test), codes, 0.0, 0.0])
        rows[at][0], rows[at][1] = add(left), add(right)
        rows[at][6] = rows[rows[at][0]][6] + rows[rows[at][1]][6]
        return at

    add(nested)
    left, right, feature, threshold, codes, value, cover = zip(*rows)
    return TreeArrays(
        np.array(left), np.array(right), np.array(feature), np.array(threshold),
        {i: c for i, c in enumerate(codes) if c is not None}, np.array(value), np.array(cover),
    )


def tree_column(tree: TreeArrays, inputs: Sequence[Column]) -> Column:
    """The leaf value of a row; a null or NaN input goes right."""

    def at(node: int) -> Column:
        if tree.left[node] < 0:
            return F.lit(float(tree.value[node]))
        x = inputs[tree.feature[node]]
        codes = tree.categories.get(node)
        test = x.isin(*sorted(codes)) if codes is not None else x <= F.lit(float(tree.threshold[node]))
        return F.when(test, at(int(tree.left[node]))).otherwise(at(int(tree.right[node])))

    return at(0)


def ensemble_column(
    trees: Sequence[TreeArrays], factors: Sequence[float], inputs: Sequence[Column], start: float = 0.0
) -> Column:
    """``start`` plus the sum of factor times tree, added in the order of the trees."""
    nodes = sum(len(t.left) for t in trees)
    if nodes > MAX_COMPILED_NODES:
        raise ValueError(f"the ensemble has {nodes} nodes; {MAX_COMPILED_NODES} can be compiled")
    total = F.lit(start)
    for tree, factor in zip(trees, factors):
        total = total + F.lit(float(factor)) * tree_column(tree, inputs)
    return total


def compiled_probability(
    pipeline_model, features: DataFrame, work_dir: str, out_col: str = "churn_probability"
) -> DataFrame:
    """M9 for a fitted forest or boosted trees of up to ``MAX_COMPILED_NODES``
    nodes: the class-1 probability as one expression over the assembled inputs."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    trees, weights, kind = ensemble_arrays(pipeline_model.stages[-1], work_dir)
    assembled = PipelineModel(pipeline_model.stages[:-1]).transform(features)
    rows = assembled.select(*features.columns, vector_to_array("features").alias("_inputs"))
    inputs = [F.col("_inputs")[i] for i in range(pipeline_model.stages[-1].numFeatures)]
    output = ensemble_column(trees, ensemble_factors(weights, kind), inputs)
    return rows.select(*features.columns, (logistic(output) if kind == "gbt" else output).alias(out_col))


def fixed_inputs() -> list[Column]:
    return [F.expr(expr).cast("double") for _name, expr in INPUTS]


def fixed_trees() -> tuple[list[TreeArrays], list[float]]:
    return [grow(tree) for _factor, tree in TREES], [factor for factor, _tree in TREES]


def fixed_probability() -> Column:
    """1 / (1 + exp(-z)) of the fixed ensemble, cut to 6 decimals."""
    return round_half_up(logistic(ensemble_column(*fixed_trees(), fixed_inputs(), INTERCEPT)), 6)


def fixed_impacts(features: DataFrame, key: str = "customer_id") -> DataFrame:
    """Attributions of the fixed ensemble's log-odds, through the leaf-path
    tables; base value and output include the intercept."""
    rows = features.select(key, F.array(*fixed_inputs()).alias("inputs"))
    out = ensemble_impacts(rows, *fixed_trees(), [name for name, _expr in INPUTS], key)
    return out.withColumns(
        {c: F.col(c) + F.lit(INTERCEPT) for c in ("base_value", "model_output")}
    )
