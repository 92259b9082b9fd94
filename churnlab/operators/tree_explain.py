"""Exact per-row attributions for Spark tree ensembles (M11, trees).

Path-dependent Shapley values (Lundberg, Erion, Lee: "Consistent Individualized
Feature Attribution for Tree Ensembles", 2018), run per partition with
``mapInPandas``:

* the fitted ensemble is saved to the checkpoint folder and its node table read
  back with Spark (children, split feature / threshold or left categories, leaf
  value, training cover per node), then shipped to the workers as a broadcast
  of plain arrays.  The node count is checked against ``MAX_NODES`` first;
* a worker turns each tree into a leaf-path table once (:func:`leaf_table`); the
  attributions of a batch are sums over its leaves (:func:`leaf_attributions`),
  without walking the tree.

Units: gradient-boosted trees are explained in log-odds (Spark's GBT margin is
half the log-odds, so attributions are doubled); random forests in class-1
probability.  In both, attributions + base value = model output (additivity).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Nodes of an ensemble that are collected and shipped: about 100 bytes each.
MAX_NODES = 1_000_000
# Numbers in one array of an attribution pass (4 MB, near a core's cache).
CELLS = 1 << 19
# Inputs of a path up to which all ways to pass it are listed.
PATTERN_SLOTS = 8


class TreeArrays:
    """One tree as flat arrays (node ids are positions)."""

    __slots__ = ("left", "right", "feature", "threshold", "categories", "value", "cover")

    def __init__(self, left, right, feature, threshold, categories, value, cover):
        self.left, self.right, self.feature = left, right, feature
        self.threshold, self.categories = threshold, categories
        self.value, self.cover = value, cover


def ensemble_arrays(model, work_dir: str) -> tuple[list[TreeArrays], list[float], str]:
    """The trees of a fitted forest or of boosted trees; those of a Spark model
    are read from its node table.

    Returns (trees, tree weights, kind) with kind 'gbt' or 'forest'.
    """
    from pyspark.ml.classification import GBTClassificationModel

    from pyspark.sql import SparkSession

    from churnlab.operators.trees import GrownTrees

    spark = SparkSession.getActiveSession()
    if model.totalNumNodes > MAX_NODES:
        raise ValueError(f"the ensemble has {model.totalNumNodes} nodes; {MAX_NODES} can be shipped")
    if isinstance(model, GrownTrees):
        trees = [
            TreeArrays(left, np.where(left < 0, -1, left + 1), feature, threshold, {}, value, cover)
            for left, feature, threshold, value, cover in model.with_thresholds()
        ]
        return trees, [float(w) for w in model.treeWeights], model.kind
    path = f"{work_dir.rstrip('/')}/tree-model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID",
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.impurityStats").alias("stats"),
        F.col("nodeData.rawCount").alias("raw_count"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("split_values"),
        F.col("nodeData.split.numCategories").alias("num_categories"),
    )
    kind = "gbt" if isinstance(model, GBTClassificationModel) else "forest"
    rows = nodes.orderBy("treeID", "id").collect()  # the model's own size, checked above
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r)
    trees = []
    for tree_id in sorted(by_tree):
        tree_rows = by_tree[tree_id]
        n = max(r["id"] for r in tree_rows) + 1
        left = np.full(n, -1, dtype=np.int64)
        right = np.full(n, -1, dtype=np.int64)
        feature = np.full(n, -1, dtype=np.int64)
        threshold = np.zeros(n)
        value = np.zeros(n)
        cover = np.zeros(n)
        categories: dict[int, frozenset] = {}
        for r in tree_rows:
            i = r["id"]
            left[i], right[i] = r["left"], r["right"]
            stats = list(r["stats"] or [])
            if kind == "forest":
                total = float(sum(stats))
                cover[i] = total
                value[i] = stats[1] / total if total > 0 and len(stats) > 1 else 0.0
            else:
                cover[i] = float(stats[0]) if stats else float(r["raw_count"])
                value[i] = float(r["prediction"])
            if r["left"] >= 0:
                feature[i] = r["feature"]
                if r["num_categories"] is not None and r["num_categories"] >= 0:
                    categories[i] = frozenset(float(v) for v in r["split_values"])
                else:
                    threshold[i] = float(r["split_values"][0])
        trees.append(TreeArrays(left, right, feature, threshold, categories, value, cover))
    weights = [float(w) for w in model.treeWeights]
    return trees, weights, kind


@dataclass(frozen=True)
class LeafTable:
    """The leaves of a tree as arrays, one row a leaf and one slot for each
    different input on its path (unused slots change nothing)."""

    value: np.ndarray  # leaf
    feature: np.ndarray  # leaf x slot, -1 where unused
    fraction: np.ndarray  # leaf x slot: share of the cover that the input's splits let through
    node: np.ndarray  # leaf x step: the split met at that step, -1 past the end
    side: np.ndarray  # leaf x step: whether the path goes left there
    slot: np.ndarray  # leaf x step: the slot of the split's input


def leaf_table(tree: TreeArrays) -> LeafTable:
    """Walk every path from the root to a leaf once.

    A child without cover lets through nothing; a node without cover sends
    nothing either way."""
    found = []
    todo = [(0, {}, [])]  # node, input -> share let through, steps (split, goes left, input)
    while todo:
        node, shares, steps = todo.pop()
        if tree.left[node] < 0:
            found.append((float(tree.value[node]), shares, steps))
            continue
        split = int(tree.feature[node])
        for child, goes_left in ((tree.right[node], False), (tree.left[node], True)):
            share = tree.cover[child] / tree.cover[node] if tree.cover[node] > 0 else 0.0
            grown = {**shares, split: shares.get(split, 1.0) * float(share)}
            todo.append((int(child), grown, [*steps, (node, goes_left, split)]))
    slots = max(1, max(len(shares) for _, shares, _ in found))
    length = max(len(steps) for _, _, steps in found)
    n = len(found)
    table = LeafTable(
        np.array([value for value, _, _ in found]),
        np.full((n, slots), -1), np.ones((n, slots)),
        np.full((n, length), -1), np.zeros((n, length), dtype=bool), np.zeros((n, length), dtype=np.int64),
    )
    for leaf, (_, shares, steps) in enumerate(found):
        inputs = list(shares)
        table.feature[leaf, : len(inputs)] = inputs
        table.fraction[leaf, : len(inputs)] = [shares[f] for f in inputs]
        for k, (node, goes_left, split) in enumerate(steps):
            table.node[leaf, k], table.side[leaf, k] = node, goes_left
            table.slot[leaf, k] = inputs.index(split)
    return table


def goes_left(tree: TreeArrays, node: int, X: np.ndarray) -> np.ndarray:
    """Whether each row goes left at a split; a missing value goes right."""
    values = X[:, tree.feature[node]]
    cats = tree.categories.get(node)
    if cats is not None:
        return np.isin(values, list(cats))
    return values <= tree.threshold[node]


def leaf_attributions(tree: TreeArrays, table: LeafTable, X: np.ndarray, phi: np.ndarray) -> None:
    """Add the path-dependent Shapley values of one tree for the rows ``X`` to ``phi``.

    With a set S of known inputs a leaf counts ``value`` times the product, over
    the inputs of its path, of *passed* (0 or 1, inputs in S) or *fraction* (the
    others).  Averaging the gain of input j over all orders gives

        value * (passed_j - fraction_j) * integral over t in [0, 1] of
            product over i != j of (fraction_i * (1 - t) + passed_i * t)

    since k! (m - 1 - k)! / m! is the integral of t^k (1 - t)^(m - 1 - k).  The
    integrand is a polynomial of degree ``slots - 1``, so Gauss-Legendre nodes
    give it exactly.  All leaves are done at once; rows go in runs, so that the
    arrays of a pass stay below ``CELLS`` numbers.
    """
    leaves, slots = table.feature.shape
    inner = np.flatnonzero(tree.left >= 0)
    if not len(inner):
        return
    points = (slots + 1) // 2
    used = table.feature.ravel() >= 0
    order = np.flatnonzero(used)[np.argsort(table.feature.ravel()[used], kind="stable")]
    inputs, starts = np.unique(table.feature.ravel()[order], return_index=True)
    known = None
    if slots <= PATTERN_SLOTS and leaves * slots * 2**slots <= CELLS:
        # few ways to pass a path: the gains of each are worked out once
        ways = (np.arange(2**slots)[:, None] >> np.arange(slots)) & 1
        known = leaf_gains(table, np.repeat(ways[:, None, :].astype(float), leaves, axis=1))
    run = max(1, CELLS // (leaves * slots * (1 if known is not None else points)))
    for at in range(0, len(X), run):
        rows = X[at : at + run]
        left = np.zeros((len(rows), len(tree.left)), dtype=bool)
        for node in inner:
            left[:, node] = goes_left(tree, node, rows)
        if known is not None:
            way = np.full((len(rows), leaves), 2**slots - 1)
            for k in range(table.node.shape[1]):
                on = np.flatnonzero(table.node[:, k] >= 0)
                missed = left[:, table.node[on, k]] != table.side[on, k]
                way[:, on] &= ~(missed.astype(way.dtype) << table.slot[on, k])
            gains = known[way, np.arange(leaves)]
        else:
            passed = np.ones((len(rows), leaves, slots))
            for k in range(table.node.shape[1]):
                on = np.flatnonzero(table.node[:, k] >= 0)
                passed[:, on, table.slot[on, k]] *= left[:, table.node[on, k]] == table.side[on, k]
            gains = leaf_gains(table, passed)
        phi[at : at + run, inputs] += np.add.reduceat(gains.reshape(len(rows), -1)[:, order], starts, axis=1)


def leaf_gains(table: LeafTable, passed: np.ndarray) -> np.ndarray:
    """What each leaf adds to the input of each slot, for rows of ``passed``."""
    points, weights = np.polynomial.legendre.leggauss((table.feature.shape[1] + 1) // 2)
    mean = np.zeros_like(passed)
    for t, w in zip((points + 1) / 2, weights / 2):
        factor = table.fraction * (1 - t) + passed * t
        before, after = np.ones_like(factor), np.ones_like(factor)
        before[..., 1:] = np.cumprod(factor[..., :-1], axis=-1)
        after[..., :-1] = np.cumprod(factor[..., :0:-1], axis=-1)[..., ::-1]
        mean += w * before * after
    return table.value[:, None] * (passed - table.fraction) * mean


def predict_batch(tree: TreeArrays, X: np.ndarray) -> np.ndarray:
    """Leaf value of every row (vectorised descent)."""
    node = np.zeros(X.shape[0], dtype=np.int64)
    active = tree.left[node] >= 0
    while active.any():
        for n in np.unique(node[active]):
            rows = np.where(active & (node == n))[0]
            go_left = goes_left(tree, n, X[rows])
            node[rows] = np.where(go_left, tree.left[n], tree.right[n])
        active = tree.left[node] >= 0
    return tree.value[node]


def expected_value(tree: TreeArrays) -> float:
    """Cover-weighted mean leaf value (the tree's base value)."""
    leaves = tree.left < 0
    return float(np.sum(tree.value[leaves] * tree.cover[leaves]) / tree.cover[0])


def ensemble_impacts(
    rows: DataFrame,
    trees: list[TreeArrays],
    factors: list[float],
    feature_names: list[str],
    key: str = "customer_id",
    inputs_col: str = "inputs",
) -> DataFrame:
    """Attributions of ``sum(factor * tree)`` for rows of (key, array of inputs).

    Rows of (key, base_value, model_output, impacts array<struct<name, impact>>);
    impacts + base value = model output.  A null input goes right at every
    split; a null array counts as all null.  No rows give none.
    """
    base = float(sum(f * expected_value(t) for f, t in zip(factors, trees)))
    shipped = rows.sparkSession.sparkContext.broadcast((trees, factors))
    names = list(feature_names)
    n_features = len(names)

    def run(batches):
        import pandas as pd

        ensemble, tree_factors = shipped.value
        tables = [leaf_table(tree) for tree in ensemble]
        for pdf in batches:
            missing = np.full(n_features, np.nan)
            X = np.array(
                [missing if v is None else np.asarray(v, dtype=float) for v in pdf["_x"]]
            ).reshape(len(pdf), n_features)
            phi = np.zeros((len(pdf), n_features))
            output = np.zeros(len(pdf))
            for tree, table, factor in zip(ensemble, tables, tree_factors):
                part = np.zeros_like(phi)
                leaf_attributions(tree, table, X, part)
                phi += factor * part
                output += factor * predict_batch(tree, X)
            yield pd.DataFrame(
                {key: pdf[key], "model_output": output, "_phi": [row.tolist() for row in phi]}
            )

    arrays = rows.select(key, F.col(inputs_col).alias("_x"))
    key_type = rows.schema[key].dataType.simpleString()
    raw = arrays.mapInPandas(run, f"{key} {key_type}, model_output double, _phi array<double>")
    names_col = F.array(*[F.lit(n) for n in names])
    return raw.select(
        key,
        F.lit(base).alias("base_value"),
        "model_output",
        F.arrays_zip(names_col.alias("name"), F.col("_phi").alias("impact")).alias("impacts"),
    )


def ensemble_factors(weights: list[float], kind: str) -> list[float]:
    """What each tree counts: log-odds for boosted trees, class-1 probability for a forest."""
    return [2.0 * w for w in weights] if kind == "gbt" else [1.0 / len(weights)] * len(weights)


def explain_trees(
    scored: DataFrame,
    model,
    feature_names: list[str],
    work_dir: str,
    key: str = "customer_id",
    features_col: str = "features",
    partitions: int | None = None,
) -> DataFrame:
    """:func:`ensemble_impacts` of a fitted model.

    ``scored`` must hold ``features_col`` (the assembled vector the model saw).
    """
    from pyspark.ml.functions import vector_to_array

    trees, weights, kind = ensemble_arrays(model, work_dir)
    # CPU-heavy work on narrow rows: they are dealt anew, as the partitions that
    # they come in follow their bytes
    rows = scored.select(key, features_col)
    rows = rows.repartition(partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    arrays = rows.select(key, vector_to_array(F.col(features_col)).alias("inputs"))
    return ensemble_impacts(arrays, trees, ensemble_factors(weights, kind), feature_names, key)


def explain_linear_model(
    transformed: DataFrame,
    model,
    feature_names: list[str],
    key: str = "customer_id",
    features_col: str = "features",
) -> DataFrame:
    """Exact Shapley values of a fitted ``LogisticRegressionModel`` in log-odds:
    ``coef_j * (x_j - mean_j)`` over the assembled inputs, with the means taken
    over ``transformed`` by one distributed aggregate (a vector of one number
    per input).  Same output shape as :func:`explain_trees`.
    """
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    means = transformed.select(Summarizer.mean(F.col(features_col)).alias("m")).first()["m"]
    coefs = model.coefficients.toArray()
    means = means.toArray() if means is not None else np.zeros(len(coefs))
    base = float(model.intercept + float(np.dot(coefs, means)))
    coef_arr = F.array(*[F.lit(float(c)) for c in coefs])
    mean_arr = F.array(*[F.lit(float(m)) for m in means])
    names_arr = F.array(*[F.lit(n) for n in feature_names])
    x = vector_to_array(F.col(features_col))
    impacts = F.transform(
        x,
        lambda v, i: F.struct(
            F.element_at(names_arr, i + 1).alias("name"),
            (F.element_at(coef_arr, i + 1) * (v - F.element_at(mean_arr, i + 1))).alias("impact"),
        ),
    )
    margin = F.aggregate(impacts, F.lit(base), lambda acc, s: acc + s["impact"])
    return transformed.select(
        key, F.lit(base).alias("base_value"), margin.alias("model_output"), impacts.alias("impacts")
    )


def explain_model(
    pipeline_model,
    data: DataFrame,
    work_dir: str,
    key: str = "customer_id",
) -> tuple[DataFrame, str]:
    """Attributions for a fitted churn pipeline, dispatched on its final model:
    linear (exact, log-odds) for logistic regression, leaf-path tables for forests
    (probability) and boosted trees (log-odds).  Returns (frame, unit)."""
    from pyspark.ml.classification import LogisticRegressionModel

    from churnlab.operators.ml import transformed_feature_names

    final = pipeline_model.stages[-1]
    names = transformed_feature_names(pipeline_model, data)
    transformed = pipeline_model.transform(data)
    if isinstance(final, LogisticRegressionModel):
        return explain_linear_model(transformed, final, names, key), "log_odds"
    unit = "log_odds" if "GBT" in type(final).__name__ else "probability"
    return explain_trees(transformed, final, names, work_dir, key), unit
