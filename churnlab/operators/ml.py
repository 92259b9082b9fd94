"""Churn model training, selection and preparation.

Training runs as Spark jobs: statistics and tree histograms are aggregated
on executors (:mod:`churnlab.operators.trees` grows the trees); the driver only
holds model parameters.  The preprocessing is a
``PipelineModel`` of native stages, so a saved model scores any table size:

* categoricals: ``StringIndexer(handleInvalid="keep")`` + ``OneHotEncoder``
  with the last slot (the unseen-value bucket) dropped, so every real level is
  kept and an unseen value becomes all zeros;
* numerics and booleans: standardised with the *population* standard deviation
  (as the original tool does; ``ml.StandardScaler`` uses the sample one) by a
  ``SQLTransformer`` whose statement carries the fitted means and deviations.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions.constants import EXCLUDED_COLUMNS, ID_COLUMNS, TARGET_COLUMN
from churnlab.session import ensure_checkpoint_dir

# Rows that one task of a fit reads.  A fit of several tasks is hundreds of short
# jobs over the same rows, and a job costs more than its arithmetic on few rows.
FIT_ROWS = 1 << 17

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DecimalType, T.BooleanType,
)


def split_features_target(features: DataFrame) -> tuple[list[str], str]:
    """Model input columns (ids, label, leakage and provenance dropped)."""
    if TARGET_COLUMN not in features.columns:
        raise ValueError(f"Missing target column: {TARGET_COLUMN}")
    excluded = set(EXCLUDED_COLUMNS) | set(ID_COLUMNS)
    return [c for c in features.columns if c not in excluded], TARGET_COLUMN


def column_groups(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """(categorical = string columns, numeric = number and boolean columns)."""
    categorical, numeric = [], []
    for f in df.schema.fields:
        if f.name not in columns:
            continue
        if isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        elif isinstance(f.dataType, NUMERIC_TYPES):
            numeric.append(f.name)
    return categorical, numeric


# --- M2: population standardisation ---------------------------------------


def standardization_stats(
    df: DataFrame, columns: list[str], exact_scale: int | None = None
) -> DataFrame:
    """One row: ``<c>__mean`` and ``<c>__std`` (population) per column.

    With ``exact_scale`` count, sum and sum of squares are integers of that many
    decimals (which values must not exceed) and combine exactly, so the
    statistics depend neither on the order in which partitions are added nor on
    the size of the mean; otherwise ``avg`` and ``stddev_pop``, which
    keep centred sums and stay accurate for large means.  A zero deviation
    becomes 1 (the column then standardises to 0).
    """
    if exact_scale is None:
        out = []
        for c in columns:
            x = F.col(c).cast("double")
            std = F.stddev_pop(x)
            out += [F.avg(x).alias(f"{c}__mean"), F.when(std > 0, std).otherwise(F.lit(1.0)).alias(f"{c}__std")]
        return df.agg(*out)
    whole = T.DecimalType(38, 0)
    aggs = []
    for c in columns:
        x = (F.col(c).cast(T.DecimalType(28, exact_scale)) * F.lit(10**exact_scale)).cast(whole)
        aggs += [F.count(x).alias(f"_n_{c}"), F.sum(x).alias(f"_s_{c}"), F.sum((x * x).cast(whole)).alias(f"_q_{c}")]
    sums = df.agg(*aggs)
    out = []
    for c in columns:
        n, s, q = (F.col(f"_{k}_{c}") for k in "nsq")
        count = n.cast("double")
        mean = s.cast("double") / F.lit(float(10**exact_scale)) / count
        # n * q - s * s is exact: no digits of a large mean cancel in doubles
        spread = (n.cast(whole) * q - s * s).cast("double")
        std = F.sqrt(spread / (count * count)) / F.lit(float(10**exact_scale))
        out += [
            mean.alias(f"{c}__mean"),
            F.when(std > 0, std).otherwise(F.lit(1.0)).alias(f"{c}__std"),
        ]
    return sums.select(*out)


def standardize_with(df: DataFrame, stats_row: dict, columns: list[str], suffix: str = "") -> DataFrame:
    """Apply fitted statistics (one small row: two numbers per column, taken to
    the driver once) as literals in a projection."""
    keep = [c for c in df.columns if suffix or c not in columns]
    return df.select(
        *keep,
        *[
            ((F.col(c).cast("double") - F.lit(stats_row[f"{c}__mean"])) / F.lit(stats_row[f"{c}__std"]))
            .alias(c + suffix)
            for c in columns
        ],
    )


def standardizer_stage(stats_row: dict, columns: list[str], suffix: str = "__std"):
    """A ``SQLTransformer`` carrying fitted means / deviations (saved with the model)."""
    from pyspark.ml.feature import SQLTransformer

    exprs = ", ".join(
        f"(CAST(`{c}` AS DOUBLE) - {stats_row[c + '__mean']!r}) / {stats_row[c + '__std']!r} "
        f"AS `{c}{suffix}`"
        for c in columns
    )
    return SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")


# --- M6: balanced class weights -------------------------------------------


def class_weights(df: DataFrame, label: str = TARGET_COLUMN, out_col: str = "class_weight") -> DataFrame:
    """n / (n_classes * n_label) for every row, as ``class_weight="balanced"``.

    The per-label counts table has one row per class (two here); Spark's own
    size check broadcasts it.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_label"))
    everything = counts.select(
        label,
        "_n_label",
        F.sum("_n_label").over(_whole()).alias("_n"),
        F.count(F.lit(1)).over(_whole()).alias("_k"),
    )
    weights = everything.select(
        label,
        (F.col("_n").cast("double") / (F.col("_k") * F.col("_n_label")).cast("double")).alias(out_col),
    )
    return df.join(weights, label, "left")


def _whole():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


# --- M1, M3-M5, M8: model pipelines ------------------------------------------


@dataclass
class TrainConfig:
    logistic_max_iter: int = 2000
    forest_trees: int = 300
    forest_min_leaf: int = 5
    boosted_iters: int = 300
    boosted_depth: int = 4
    boosted_step: float = 0.05
    boosted_subsample: float = 0.9
    seed: int = 42
    max_rows: int | None = None  # None: every labelled row; a caller's own trial may name fewer
    candidates: list[str] = field(
        default_factory=lambda: ["logistic_regression", "random_forest", "gradient_boosted_trees"]
    )


def feature_stages(train: DataFrame, columns: list[str]):
    """Preprocessing stages fitted on ``train``; returns (stages, assembled column)."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    categorical, numeric = column_groups(train, columns)
    stats = standardization_stats(train, numeric).first().asDict() if numeric else {}
    stages = []
    if numeric:
        stages.append(standardizer_stage(stats, numeric))
    if categorical:
        stages.append(
            StringIndexer(
                inputCols=categorical,
                outputCols=[f"{c}__idx" for c in categorical],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
        )
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}__idx" for c in categorical],
                outputCols=[f"categorical__{c}" for c in categorical],
                dropLast=True,  # the last slot is the indexer's unseen-value bucket
            )
        )
    stages.append(
        VectorAssembler(
            inputCols=[f"categorical__{c}" for c in categorical] + [f"{c}__std" for c in numeric],
            outputCol="features",
            handleInvalid="keep",
        )
    )
    return stages, categorical, numeric


def candidate_estimators(config: TrainConfig, n_rows: int) -> dict:
    from pyspark.ml.classification import LogisticRegression

    from churnlab.operators.trees import BoostedTrees, Forest, root_of

    all_models = {
        "logistic_regression": LogisticRegression(
            featuresCol="features",
            labelCol="label",
            weightCol="class_weight",
            maxIter=config.logistic_max_iter,
            regParam=1.0 / max(n_rows, 1),
            elasticNetParam=0.0,
            standardization=False,
        ),
        "random_forest": Forest(
            trees=config.forest_trees,
            least=config.forest_min_leaf,
            depth=30,
            inputs=root_of,
            seed=config.seed,
        ),
        "gradient_boosted_trees": BoostedTrees(
            rounds=config.boosted_iters,
            depth=config.boosted_depth,
            rate=config.boosted_step,
            rows=config.boosted_subsample,
            inputs=config.boosted_subsample,
            seed=config.seed,
        ),
    }
    return {name: all_models[name] for name in config.candidates}


def prepare_training_frame(features: DataFrame) -> DataFrame:
    """Label as double 0/1 plus balanced class weights."""
    labelled = features.withColumn("label", F.col(TARGET_COLUMN).cast("double"))
    return class_weights(labelled, label="label")


def in_fit_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` (persisted) in one partition for about ``FIT_ROWS`` of them, at
    most as many as they have: no shuffle, every row kept."""
    return rows.coalesce(max(1, -(-rows.count() // FIT_ROWS)))


def train_and_evaluate(
    features: DataFrame,
    config: TrainConfig | None = None,
) -> tuple[str, list, dict]:
    """M8: fit every candidate on the stratified 80 %, score the 20 % hold-out,
    keep the best ROC AUC (the first listed wins ties).

    Returns (best name, metric rows - one per model, fitted models).
    """
    from pyspark.ml import Pipeline, PipelineModel

    from churnlab.operators.metrics import evaluate_predictions
    from churnlab.operators.ranking import hash_positions, stratified_split
    from churnlab.operators.trees import Binned, BinnedFit

    config = config or TrainConfig()
    columns, _ = split_features_target(features)
    if config.max_rows is not None:
        # only where the caller asks for a trial on fewer rows: a seeded sample
        place = hash_positions(features, "customer_id", config.seed)
        features = place.filter(F.col("_r") <= config.max_rows).drop("_r", "_n")
    split = stratified_split(features, "customer_id", TARGET_COLUMN, 0.2, config.seed)
    split = prepare_training_frame(split).persist()
    # checkpointed: the plans of hundreds of jobs would each hold the plan of the features
    ensure_checkpoint_dir(features.sparkSession)
    rows = in_fit_tasks(split).checkpoint(eager=True)
    split.unpersist()
    train = rows.filter(F.col("split") == "train")
    test = rows.filter(F.col("split") == "test")
    stages, _, _ = feature_stages(train, columns)
    # the preprocessing is fitted once and its vectors are kept: a fit reads them often
    prepared = Pipeline(stages=stages).fit(train)
    vectors = prepared.transform(train).select("features", "label", "class_weight").persist()
    n_rows = vectors.count()
    candidates = candidate_estimators(config, n_rows)
    binned = Binned(vectors) if any(isinstance(e, BinnedFit) for e in candidates.values()) else None

    def fit_and_score(item):
        from pyspark.ml.functions import vector_to_array

        name, estimator = item
        if isinstance(estimator, BinnedFit):
            estimator.binned = binned
        model = PipelineModel(stages=[*prepared.stages, estimator.fit(vectors)])
        scored = model.transform(test).withColumn(
            "churn_probability", vector_to_array(F.col("probability"))[1]
        )
        return name, model, evaluate_predictions(scored).withColumn("model_name", F.lit(name))

    # The candidate fits are independent distributed jobs: submit them from
    # parallel driver threads so small fits do not leave executors idle.
    with ThreadPoolExecutor(max_workers=len(candidates)) as pool:
        results = list(pool.map(fit_and_score, candidates.items()))
    fitted = {name: model for name, model, _ in results}
    rows = [metrics for _, _, metrics in results]
    table = rows[0]
    for more in rows[1:]:
        table = table.unionByName(more)
    collected = table.collect()  # one row per candidate model
    best = None
    for row in collected:
        if best is None or row["roc_auc"] > best["roc_auc"]:
            best = row
    for kept in (vectors, *([binned] if binned else [])):
        kept.unpersist()
    return best["model_name"], collected, fitted


def transformed_feature_names(model, sample: DataFrame) -> list[str]:
    """Names of the assembled vector slots from its ML attribute metadata."""
    out = model.transform(sample.limit(0)) if hasattr(model, "transform") else sample
    meta = out.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    slots = []
    for kind in ("numeric", "binary", "nominal"):
        for attr in meta.get(kind, []):
            slots.append((attr["idx"], attr["name"]))
    names = [name for _, name in sorted(slots)]
    return [
        "numeric__" + n[: -len("__std")] if n.endswith("__std") else n for n in names
    ]
