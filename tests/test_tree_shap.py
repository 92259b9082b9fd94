"""Leaf-path attributions equal brute-force Shapley values of the path-dependent
value function; compiled ensembles score as the model does."""

import itertools
import math

import numpy as np
import pytest

from churnlab.operators import ensemble, tree_explain
from churnlab.operators.tree_explain import (
    TreeArrays,
    ensemble_impacts,
    expected_value,
    leaf_attributions,
    leaf_table,
    predict_batch,
)

# x0 <= 0.5 ? (x1 <= 0.5 ? 1 : 2) : (x2 <= 0.5 ? 3 : (x0 <= 0.8 ? 4 : 5)); x0 is split twice
LEFT = np.array([1, 3, 5, -1, -1, -1, 7, -1, -1])
RIGHT = np.array([2, 4, 6, -1, -1, -1, 8, -1, -1])
FEATURE = np.array([0, 1, 2, -1, -1, -1, 0, -1, -1])
THRESHOLD = np.array([0.5, 0.5, 0.5, 0, 0, 0, 0.8, 0, 0])
VALUE = np.array([0, 0, 0, 1.0, 2.0, 3.0, 0, 4.0, 5.0])
COVER = np.array([100, 40, 60, 10, 30, 25, 35, 20, 15.0])


def _conditional(x, known, node=0):
    if LEFT[node] < 0:
        return VALUE[node]
    f = FEATURE[node]
    if f in known:
        return _conditional(x, known, LEFT[node] if x[f] <= THRESHOLD[node] else RIGHT[node])
    return (
        COVER[LEFT[node]] * _conditional(x, known, LEFT[node])
        + COVER[RIGHT[node]] * _conditional(x, known, RIGHT[node])
    ) / COVER[node]


def _brute_force(x, m=3):
    phi = np.zeros(m)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for r in range(m):
            for subset in itertools.combinations(others, r):
                w = math.factorial(r) * math.factorial(m - r - 1) / math.factorial(m)
                phi[i] += w * (_conditional(x, set(subset) | {i}) - _conditional(x, set(subset)))
    return phi


def _attributions(tree, X, m=3):
    X = np.asarray(X, dtype=float)
    phi = np.zeros((len(X), m))
    leaf_attributions(tree, leaf_table(tree), X, phi)
    return phi


TREE = TreeArrays(LEFT, RIGHT, FEATURE, THRESHOLD, {}, VALUE, COVER)


@pytest.mark.parametrize("cells", [1 << 22, 40])
def test_leaf_paths_match_brute_force(cells, monkeypatch):
    monkeypatch.setattr(tree_explain, "CELLS", cells)  # small: a pass of one row each
    X = np.random.default_rng(0).random((40, 3))
    X[:5] = [[0.5, 0.5, 0.5], [0.8, 0.1, 0.9], [0.2, 0.9, 0.1], [0.9, 0.1, 0.9], [0.7, 0.3, 0.9]]
    phi = _attributions(TREE, X)
    for x, row in zip(X, phi):
        assert np.allclose(row, _brute_force(x), atol=1e-12)
    assert np.allclose(phi.sum(axis=1) + expected_value(TREE), predict_batch(TREE, X))


def test_categorical_split_and_missing_values():
    # node 0 sends category 1.0 left; a missing value goes right
    tree = TreeArrays(np.array([1, -1, -1]), np.array([2, -1, -1]), np.array([0, -1, -1]),
                      np.zeros(3), {0: frozenset({1.0})}, np.array([0, 10.0, 20.0]), np.array([4, 1, 3.0]))
    phi = _attributions(tree, [[1.0], [0.0], [np.nan]], 1)
    assert np.allclose(phi[:, 0], [10.0 - 17.5, 20.0 - 17.5, 20.0 - 17.5])


def test_single_leaf_and_leaf_without_cover():
    leaf = ensemble.grow((0.3, 5))
    assert not _attributions(leaf, [[1.0, 2.0, 3.0]]).any() and expected_value(leaf) == 0.3
    bare = ensemble.grow((0, 0.5, (1.0, 0), (1, 0.5, (2.0, 4), (3.0, 4))))
    X = np.array([[0.1, 0.1, 0], [0.9, 0.9, 0]])
    phi = _attributions(bare, X)
    assert np.isfinite(phi).all()
    assert np.allclose(phi.sum(axis=1) + expected_value(bare), predict_batch(bare, X))


def test_deep_path_of_many_inputs():
    # one path of ten different inputs: the integrand has degree nine
    nested = (1.0, 3)
    for i in range(10):
        nested = (i, 0.5, nested, (float(i) / 7, 2 + i))
    tree = ensemble.grow(nested)
    X = np.random.default_rng(3).random((6, 10))

    def value(x, known, node=0):
        if tree.left[node] < 0:
            return tree.value[node]
        f, left, right = tree.feature[node], tree.left[node], tree.right[node]
        if f in known:
            return value(x, known, left if x[f] <= 0.5 else right)
        both = tree.cover[left] * value(x, known, left) + tree.cover[right] * value(x, known, right)
        return both / tree.cover[node]

    for x, row in zip(X, _attributions(tree, X, 10)):
        for i in (0, 4, 9):
            others = [j for j in range(10) if j != i]
            exact = sum(
                (value(x, {*s, i}) - value(x, set(s))) * math.factorial(r) * math.factorial(9 - r)
                for r in range(10) for s in itertools.combinations(others, r)
            ) / math.factorial(10)
            assert abs(row[i] - exact) < 1e-12


def test_impacts_of_rows(spark):
    trees, factors = ensemble.fixed_trees()
    names = [name for name, _ in ensemble.INPUTS]
    rows = spark.createDataFrame(
        [(1, [0.0, 5.0, 70.0, 3.0, 2.0, 0.0]), (1, [0.0, 5.0, 70.0, 3.0, 2.0, 0.0]),
         (2, [1.0, 30.0, None, 0.0, 9.0, 2.0]), (3, None)],
        "customer_id int, inputs array<double>",
    )
    got = ensemble_impacts(rows, trees, factors, names).collect()
    assert sorted(r["customer_id"] for r in got) == [1, 1, 2, 3]
    for r in got:
        assert [i["name"] for i in r["impacts"]] == names
        assert abs(r["base_value"] + sum(i["impact"] for i in r["impacts"]) - r["model_output"]) < 1e-9
    assert ensemble_impacts(rows.limit(0), trees, factors, names).count() == 0


def test_compiled_fixed_ensemble_equals_the_arrays(spark):
    trees, factors = ensemble.fixed_trees()
    from pyspark.sql import functions as F

    X = np.random.default_rng(5).integers(0, 80, (300, 6)).astype(float)
    X[:, 0] %= 3
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "id int, x array<double>")
    inputs = [F.col("x")[i] for i in range(6)]
    got = rows.select("id", ensemble.ensemble_column(trees, factors, inputs).alias("z")).collect()
    want = sum(f * predict_batch(t, X) for t, f in zip(trees, factors))
    assert np.allclose([r["z"] for r in sorted(got)], want, atol=1e-12)
    reached = {(n, v) for n, t in enumerate(trees) for v in predict_batch(t, X)}
    assert len(reached) >= 14  # nearly every leaf of the four trees


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_compiled_model_scores_as_the_model(spark, tmp_path, kind):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    from churnlab.operators.scoring import model_probability

    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        a, b, plan = rng.normal(), rng.normal(), "abcd"[rng.integers(4)]
        rows.append((i, float(a), float(b), plan, float(a + (plan in "bd") + 0.3 * b > 0.5)))
    data = spark.createDataFrame(rows, "customer_id int, a double, b double, plan string, label double")
    tree = (GBTClassifier(maxIter=4, maxDepth=3, seed=1) if kind == "gbt"
            else RandomForestClassifier(numTrees=5, maxDepth=4, seed=1))
    model = Pipeline(stages=[
        StringIndexer(inputCol="plan", outputCol="plan_index"),
        VectorAssembler(inputCols=["plan_index", "a", "b"], outputCol="features"), tree,
    ]).fit(data)
    got = ensemble.compiled_probability(model, data, str(tmp_path)).select("customer_id", "churn_probability")
    want = model_probability(model, data).select("customer_id", "churn_probability")
    assert np.allclose([r[1] for r in sorted(got.collect())], [r[1] for r in sorted(want.collect())], atol=1e-9)
    assert "MapInPandas" not in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        ensemble.ensemble_column([TREE] * 500, [1.0] * 500, [])
