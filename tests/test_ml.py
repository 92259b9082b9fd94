"""training table -> leakage columns excluded, three models x six metrics
(M1-M9, M12, P29, P30, S5) and tree attributions (M11)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.operators import ml, tree_explain
from churnlab.operators.metrics import evaluate_predictions
from churnlab.sources.io import load_model, save_model

FAST = ml.TrainConfig(logistic_max_iter=100, forest_trees=10, boosted_iters=10)


@pytest.fixture(scope="module")
def training(spark):
    """120 drawn customers whose churn leans on tenure and tickets."""
    rng = np.random.default_rng(29)
    rows = []
    for c in range(120):
        tenure, tickets, price = int(rng.integers(1, 70)), int(rng.poisson(1.5)), float(rng.integers(80, 480)) / 4
        lines = float(rng.choice([0.0, 12.5, 40.0]))
        churned = bool(rng.random() < 1 / (1 + np.exp(0.06 * tenure - 0.5 * tickets)))
        rows.append((
            c, str(rng.choice(["month_to_month", "one_year", "two_year"])), str(rng.choice(["dsl", "fiber_optic"])),
            str(rng.choice(["mailed_check", "electronic_check"])), tenure, price, price * tenure, price, lines,
            price + lines, price + lines if churned else 0.0, int(rng.integers(0, 6)), tickets, int(rng.poisson(0.7)),
            lines > 0, bool(rng.random() < 0.4), lines > 20, "drawn", True, churned,
        ))
    cols = (
        "customer_id long, contract_type string, internet_service string, payment_method string, "
        "tenure_months long, monthly_charges double, total_charges double, fixed_mrr double, mobile_mrr double, "
        "total_mrr double, monthly_revenue_at_risk double, late_payment_count long, support_ticket_count long, "
        "network_incident_count long, has_mobile boolean, has_byod boolean, has_5g boolean, source_system string, "
        "is_synthetic boolean, churned boolean"
    )
    return spark.createDataFrame(rows, cols)


def test_excluded_columns(training):
    columns, target = ml.split_features_target(training)
    assert target == "churned"
    for c in ["customer_id", "churned", "source_system", "is_synthetic", "monthly_revenue_at_risk"]:
        assert c not in columns
    categorical, numeric = ml.column_groups(training, columns)
    assert categorical == ["contract_type", "internet_service", "payment_method"]
    assert "has_byod" in numeric and "tenure_months" in numeric


def test_three_models_six_metrics(training):
    best, rows, models = ml.train_and_evaluate(training, FAST)
    assert {r["model_name"] for r in rows} == {"logistic_regression", "random_forest", "gradient_boosted_trees"}
    for r in rows:
        for m in ["roc_auc", "average_precision", "accuracy", "precision", "recall", "f1"]:
            assert 0.0 <= r[m] <= 1.0
    assert best == max(rows, key=lambda r: r["roc_auc"])["model_name"]


def test_fit_rows_are_bounded(training):
    few = ml.TrainConfig(logistic_max_iter=5, candidates=["logistic_regression"], max_rows=60)
    _, rows, _ = ml.train_and_evaluate(training, few)
    assert len(rows) == 1


def test_registered_fits_take_every_row(training, monkeypatch):
    from churnlab.plans import catalog

    seen, stages = [], ml.feature_stages
    monkeypatch.setattr(ml, "feature_stages", lambda t, c: seen.append(t.count()) or stages(t, c))
    assert catalog.train_config().max_rows is None
    ml.train_and_evaluate(training, ml.TrainConfig(logistic_max_iter=5, candidates=["logistic_regression"]))
    churned = training.filter("churned").count()
    assert seen == [120 + -churned // 5 + (churned - 120) // 5]  # less a fifth of each class, rounded up


def test_fit_tasks_follow_the_rows(training, monkeypatch):
    seen, stages = [], ml.feature_stages
    monkeypatch.setattr(ml, "feature_stages", lambda t, c: seen.append(t.rdd.getNumPartitions()) or stages(t, c))
    one = ml.TrainConfig(logistic_max_iter=5, candidates=["logistic_regression"])
    ml.train_and_evaluate(training.repartition(4), one)
    monkeypatch.setattr(ml, "FIT_ROWS", 50)
    ml.train_and_evaluate(training.repartition(4), one)
    assert seen == [1, 3]
    wide = training.repartition(8).persist()
    assert sorted(map(tuple, ml.in_fit_tasks(wide).collect())) == sorted(map(tuple, training.collect()))
    wide.unpersist()


def test_feature_names_and_unseen_level(spark, training):
    columns, _ = ml.split_features_target(training)
    stages, _, _ = ml.feature_stages(training, columns)
    from pyspark.ml import Pipeline

    prep = Pipeline(stages=stages).fit(training)
    names = ml.transformed_feature_names(prep, training)
    assert "categorical__contract_type_month_to_month" in names
    assert "numeric__tenure_months" in names
    unseen = training.limit(1).withColumn("contract_type", F.lit("weekly"))
    vec = prep.transform(unseen).select("features").first()[0].toArray()
    slots = [i for i, n in enumerate(names) if n.startswith("categorical__contract_type_")]
    assert len(slots) == 3 and all(vec[i] == 0.0 for i in slots)  # unseen -> all zeros


def test_population_standardisation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    stats = ml.standardization_stats(df, ["x"]).first()
    assert stats["x__mean"] == 2.5 and abs(stats["x__std"] - np.sqrt(1.25)) < 1e-12
    large = spark.createDataFrame([(1e9,), (1e9 + 1,)], "x double")
    assert ml.standardization_stats(large, ["x"]).first()["x__std"] == 0.5
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert ml.standardization_stats(const, ["x"]).first()["x__std"] == 1.0


def test_class_weights(spark):
    df = spark.createDataFrame([(True,)] * 1 + [(False,)] * 3, "churned boolean")
    got = {r["churned"]: r["class_weight"] for r in ml.class_weights(df).distinct().collect()}
    assert got == {True: 2.0, False: 4 / 6}


def _auc(y, p):
    pos, neg = p[y], p[~y]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def _average_precision(y, p):
    total, prev_recall = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        pred = p >= t
        tp = (pred & y).sum()
        precision, recall = tp / pred.sum(), tp / y.sum()
        total += (recall - prev_recall) * precision
        prev_recall = recall
    return total


def test_metrics_against_definitions(spark):
    rng = np.random.default_rng(3)
    y = rng.random(300) < 0.3
    p = np.round(np.clip(y * 0.3 + rng.random(300) * 0.7, 0, 1), 2)  # many ties
    df = spark.createDataFrame([(bool(a), float(b)) for a, b in zip(y, p)], "churned boolean, churn_probability double")
    got = evaluate_predictions(df).first()
    assert abs(got["roc_auc"] - _auc(y, p)) < 1e-9
    assert abs(got["average_precision"] - _average_precision(y, p)) < 1e-9
    pred = p >= 0.5
    tp, fp, fn = (pred & y).sum(), (pred & ~y).sum(), (~pred & y).sum()
    assert got["precision"] == tp / (tp + fp) and got["recall"] == tp / (tp + fn)
    assert abs(got["f1"] - 2 * tp / (2 * tp + fp + fn)) < 1e-12
    assert got["accuracy"] == (pred == y).mean()


def test_tree_attributions_add_up(spark, training, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    from pyspark.ml.functions import vector_to_array

    columns, _ = ml.split_features_target(training)
    stages, _, _ = ml.feature_stages(training, columns)
    data = ml.prepare_training_frame(training)
    for est in [GBTClassifier(maxIter=5, maxDepth=3, seed=1), RandomForestClassifier(numTrees=5, seed=1)]:
        model = Pipeline(stages=[*stages, est]).fit(data)
        names = ml.transformed_feature_names(model, data)
        scored = model.transform(data).withColumn("p", vector_to_array("probability")[1])
        out = tree_explain.explain_trees(scored, model.stages[-1], names, str(tmp_path))
        joined = out.join(scored.select("customer_id", "p"), "customer_id").collect()
        for r in joined:
            total = r["base_value"] + sum(i["impact"] for i in r["impacts"])
            assert abs(total - r["model_output"]) < 1e-9
            prob = 1 / (1 + np.exp(-r["model_output"])) if isinstance(est, GBTClassifier) else r["model_output"]
            assert abs(prob - r["p"]) < 1e-9


def test_model_save_load(spark, training, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    columns, _ = ml.split_features_target(training)
    stages, _, _ = ml.feature_stages(training, columns)
    model = Pipeline(stages=[*stages, LogisticRegression(maxIter=10)]).fit(ml.prepare_training_frame(training))
    path = save_model(model, str(tmp_path / "model"))
    again = load_model(path)
    a = model.transform(training).select("probability").collect()
    b = again.transform(training).select("probability").collect()
    assert a == b
    with pytest.raises(FileNotFoundError):
        load_model(str(tmp_path / "missing"))


def test_metrics_with_one_class(spark):
    df = spark.createDataFrame([(False, 0.2), (False, 0.7)], "churned boolean, churn_probability double")
    row = evaluate_predictions(df).first()
    assert row["roc_auc"] is None and row["average_precision"] is None
    assert row["accuracy"] == 0.5 and row["precision"] == 0.0 and row["recall"] == 0.0


def test_linear_model_attributions_add_up(spark, training, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    columns, _ = ml.split_features_target(training)
    stages, _, _ = ml.feature_stages(training, columns)
    data = ml.prepare_training_frame(training)
    model = Pipeline(stages=[*stages, LogisticRegression(maxIter=50)]).fit(data)
    out, unit = tree_explain.explain_model(model, data, str(tmp_path))
    assert unit == "log_odds"
    scored = model.transform(data).withColumn("p", vector_to_array("probability")[1])
    for r in out.join(scored.select("customer_id", "p"), "customer_id").collect():
        total = r["base_value"] + sum(i["impact"] for i in r["impacts"])
        assert abs(total - r["model_output"]) < 1e-9
        assert abs(1 / (1 + np.exp(-r["model_output"])) - r["p"]) < 1e-9


def test_exact_standardisation_at_a_large_mean(spark):
    df = spark.createDataFrame([(1e9,), (1e9 + 1,), (None,)], "x double")
    stats = ml.standardization_stats(df, ["x"], exact_scale=2).first()
    assert stats["x__mean"] == 1e9 + 0.5 and stats["x__std"] == 0.5
