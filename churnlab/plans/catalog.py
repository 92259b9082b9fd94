"""Named queries over the driver tables: one per inventory group of SURVEY 7.4.

Each entry is ``fn(spark, sf_dir) -> DataFrame``.  The role tables are built
lazily from the parquet files, so a query reads only the tables and columns it
needs and its work grows with the data.  Computed columns are aliased to the
names used by the SQL oracle in :mod:`churnlab.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions.constants import QUOTA_REST_BAND, QUOTA_SHARES
from churnlab.functions.scalar import round_half_up, snake_case
from churnlab.operators import (
    clean,
    complaints,
    enrich,
    ensemble,
    explain,
    metrics,
    ml,
    quality,
    ranking,
    scoring,
    tree_explain,
    views,
)
from churnlab.operators import features as feat
from churnlab.operators import summaries as summ
from churnlab.plans import reports, serving
from churnlab.session import ensure_checkpoint_dir
from churnlab.sources import roles, schemas
from churnlab.sources.io import file_fingerprints

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return register


def tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return roles.domain_tables(spark, root)


# --- SQL track -------------------------------------------------------------


@query("kpi_summary")
def q_kpi_summary(spark, root):
    """The KPI row, read from its registered view."""
    roles.register_views(spark, root)
    return spark.table("kpi_summary")


@query("customer_360")
def q_customer_360(spark, root):
    roles.register_views(spark, root)
    return spark.table("customer_360")


def _summary_query(table: str, build) -> QueryFn:
    def run(spark, root):
        return views.to_edge_types(build(roles.ROLES[table](spark, root), "features"))

    return run


for _name, _table, _build in [
    ("summary_fixed", "fixed_subscriptions", summ.summarize_fixed),
    ("summary_mobile", "mobile_subscriptions", summ.summarize_mobile),
    ("summary_byod", "byod_devices", summ.summarize_byod),
    ("summary_usage", "monthly_usage", summ.summarize_usage),
    ("summary_billing", "billing_history", summ.summarize_billing),
    ("summary_network", "network_incidents", summ.summarize_network),
    ("summary_support", "support_tickets", summ.summarize_support),
    ("summary_retention", "retention_campaigns", summ.summarize_retention),
]:
    QUERIES[_name] = _summary_query(_table, _build)


# --- feature track ---------------------------------------------------------


def customer_features(spark: SparkSession, root: str, as_of_month: str | None = None) -> DataFrame:
    return feat.build_customer_features(
        tables(spark, root), overrides=roles.summary_overrides(spark, root, "features", as_of_month)
    )


@query("customer_features")
def q_customer_features(spark, root):
    return customer_features(spark, root)


AS_OF_MONTH = "1996-06"


@query("customer_features_as_of")
def q_customer_features_as_of(spark, root):
    """Point-in-time features: no fact dated after the month."""
    return customer_features(spark, root, AS_OF_MONTH)


# --- scoring, explanations, reports ----------------------------------------


DETAIL_CUSTOMER_ID = 42
DEMO_ROW_COUNT = 500


def risk_scores(spark: SparkSession, root: str, sort: bool = False) -> DataFrame:
    """Score table with the fixed scorecard probability (stands in for a model)."""
    return scoring.score_customers(
        customer_features(spark, root), scoring.scorecard_probability(), sort=sort
    )


SCORECARD_INPUTS = [
    "contract_type", "internet_service", "tenure_months", "monthly_charges",
    "support_ticket_count", "network_incident_count", "late_payment_count", "has_byod",
]


def explanations(spark: SparkSession, root: str, features: DataFrame | None = None) -> DataFrame:
    """Linear explanations of the scorecard.  Its inputs are computed once and
    checkpointed (nine narrow columns), so the background means and the rows
    both read that table instead of running the feature plan twice."""
    features = features if features is not None else customer_features(spark, root)
    ensure_checkpoint_dir(spark)
    inputs = features.select("customer_id", *SCORECARD_INPUTS).checkpoint(eager=True)
    background = explain.linear_background(inputs, scoring.SCORECARD)
    return explain.explanation_table(
        inputs,
        scoring.scorecard_probability(),
        explain.linear_impacts(inputs, scoring.SCORECARD, background),
    )


@query("risk_scores")
def q_risk_scores(spark, root):
    return risk_scores(spark, root, sort=True)


@query("priority_quartiles")
def q_priority_quartiles(spark, root):
    return reports.value_counts(risk_scores(spark, root), "retention_priority")


@query("risk_band_counts")
def q_risk_band_counts(spark, root):
    return reports.value_counts(scored_rows(spark, root), "risk_category")


@query("action_counts")
def q_action_counts(spark, root):
    return reports.top_actions(scored_rows(spark, root), 10)


def scored_rows(spark: SparkSession, root: str) -> DataFrame:
    """Every feature column plus the score columns but the priority rank."""
    return scoring.score_rows(
        customer_features(spark, root), scoring.scorecard_probability(), keep_features=True
    )


@query("executive_tiles")
def q_executive_tiles(spark, root):
    return reports.executive_tiles(scored_rows(spark, root))


@query("top25_at_risk")
def q_top25_at_risk(spark, root):
    """The 25 rows first; they alone are compared with the quartile cuts."""
    rows = scored_rows(spark, root)
    return reports.top_at_risk(rows, 25, scoring.priority_cuts(rows))


@query("customer_detail")
def q_customer_detail(spark, root):
    """One customer's page from the stored tables (J2 + J3 + L6)."""
    stored = serving.stored_tables(spark, root, customer_features(spark, root))
    c360 = reports.customer_scores(stored["features"], stored["scores"])
    return reports.customer_detail(
        reports.with_explanations(c360, stored["explanations"]), DETAIL_CUSTOMER_ID
    )


@query("explanations_linear")
def q_explanations_linear(spark, root):
    return explanations(spark, root)


@query("driver_rows")
def q_driver_rows(spark, root):
    return explain.driver_rows(explanations(spark, root))


@query("feature_labels")
def q_feature_labels(spark, root):
    """Business label of every one-hot slot seen in the data and every numeric input."""
    features = customer_features(spark, root)
    columns, _ = ml.split_features_target(features)
    categorical, numeric = ml.column_groups(features, columns)
    levels = features.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).alias("level"))
                    for c in categorical
                ]
            )
        ).alias("_l")
    ).select("_l.column", "_l.level").distinct()
    slot_names = levels.select(
        F.concat(F.lit("categorical__"), "column", F.lit("_"), "level").alias("feature_name")
    )
    numeric_names = spark.createDataFrame([(f"numeric__{c}",) for c in numeric], "feature_name string")
    names = slot_names.unionByName(numeric_names)
    return names.select("feature_name", explain.clean_feature_name("feature_name").alias("label"))


@query("class_weights")
def q_class_weights(spark, root):
    features = customer_features(spark, root).select("customer_id", "churned")
    return ml.class_weights(features, "churned")


STANDARDIZED_COLUMNS = [
    "tenure_months",
    "monthly_charges",
    "total_mrr",
    "support_ticket_count",
    "network_incident_count",
    "late_payment_count",
]


@query("standardized_features")
def q_standardized_features(spark, root):
    features = customer_features(spark, root).select("customer_id", *STANDARDIZED_COLUMNS)
    stats = ml.standardization_stats(features, STANDARDIZED_COLUMNS, exact_scale=2).first().asDict()
    return ml.standardize_with(features, stats, STANDARDIZED_COLUMNS)


def _split(spark, root):
    features = customer_features(spark, root).select(
        "customer_id", "churned", scoring.scorecard_probability().alias("churn_probability")
    )
    return ranking.stratified_split(features, "customer_id", "churned", 0.2, 42)


@query("stratified_split")
def q_stratified_split(spark, root):
    return _split(spark, root).select("customer_id", "churned", "split")


@query("eval_metrics")
def q_eval_metrics(spark, root):
    return metrics.evaluate_predictions(_split(spark, root).filter(F.col("split") == "test"))


@query("fraction_sample")
def q_fraction_sample(spark, root):
    """Retention-campaign targets: 45 % of eligible customers (churned or on a
    month-to-month contract), exact size, seeded."""
    customers = roles.customers(spark, root)
    eligible = customers.filter(F.col("churned") | (F.col("contract_type") == "month_to_month"))
    return ranking.exact_fraction_sample(eligible.select("customer_id"), "customer_id", 0.45, 42)


def demo_quotas(row_count: int = DEMO_ROW_COUNT) -> dict[str, int]:
    quotas = {band: int(row_count * share) for band, share in QUOTA_SHARES}
    quotas[QUOTA_REST_BAND] = row_count - sum(quotas.values())
    return quotas


def quota_sample(scores: DataFrame, row_count: int = DEMO_ROW_COUNT) -> DataFrame:
    return ranking.quota_top_k(
        scores,
        "risk_category",
        demo_quotas(row_count),
        [F.col("estimated_monthly_revenue_at_risk").desc(), F.col("customer_id").asc()],
        key="customer_id",
    )


QUOTA_COLUMNS = ["customer_id", "risk_category", "estimated_monthly_revenue_at_risk"]


@query("quota_sample")
def q_quota_sample(spark, root):
    """W3 over three columns: the tables behind the other features are not read."""
    return quota_sample(scored_rows(spark, root).select(*QUOTA_COLUMNS))


@query("quota_features")
def q_quota_features(spark, root):
    """The features of the quota-sampled customers, by id.  The sample is
    taken on three columns; the wide rows meet its ids only."""
    features = customer_features(spark, root)
    picked = quota_sample(scored_rows(spark, root).select(*QUOTA_COLUMNS)).select("customer_id")
    return features.join(picked, "customer_id", "left_semi").orderBy("customer_id")


@query("demo_subset")
def q_demo_subset(spark, root):
    """The explanations of the quota-sampled customers, by id."""
    ensure_checkpoint_dir(spark)
    narrow = ["customer_id", *SCORECARD_INPUTS, "churn_probability", "risk_category",
              "estimated_monthly_revenue_at_risk"]
    rows = scored_rows(spark, root).select(*narrow).checkpoint(eager=True)
    background = explain.linear_background(rows, scoring.SCORECARD)
    picked = quota_sample(rows).select("customer_id")
    explained = explain.explanation_table(
        rows, F.col("churn_probability"), explain.linear_impacts(rows, scoring.SCORECARD, background)
    )
    return explained.join(picked, "customer_id", "left_semi").orderBy("customer_id")


# --- quality and profiling ---------------------------------------------------


@query("key_audit")
def q_key_audit(spark, root):
    """V3 - V5: every key of a driver table comes from one scan of it."""
    return quality.key_audit_of(roles.key_sources(spark, root))


@query("fk_orphans")
def q_fk_orphans(spark, root):
    """V6: every reference of a driver table comes from one scan of it."""
    return quality.reference_orphans(roles.reference_sources(spark, root), schemas.FOREIGN_KEYS)


@query("range_audit")
def q_range_audit(spark, root):
    return quality.range_audit(tables(spark, root), schemas.RANGE_RULES)


@query("null_audit")
def q_null_audit(spark, root):
    return quality.null_audit(tables(spark, root))


@query("domain_audit")
def q_domain_audit(spark, root):
    """Every order status and priority outside the domains below, with counts."""
    return clean.domain_audit(roles.driver(spark, root, "orders"), ORDER_DOMAINS)


ORDER_DOMAINS = {
    "o_orderstatus": ("F", "O"),
    "o_orderpriority": ("1-URGENT", "2-HIGH", "3-MEDIUM"),
}


@query("profile_columns")
def q_profile_columns(spark, root):
    """Profile of the raw customer source table."""
    return quality.profile_columns(roles.driver(spark, root, "customer"))


@query("profile_events")
def q_profile_events(spark, root):
    """Profile of the raw event stream (JSON-ish ``props`` text included)."""
    return quality.profile_columns(roles.driver(spark, root, "events"))


@query("profile_labels")
def q_profile_labels(spark, root):
    label = F.when(F.col("churned"), "Yes").otherwise("No")
    return quality.label_distribution(roles.customers(spark, root), label, "churn_label")


@query("duplicate_report")
def q_duplicate_report(spark, root):
    return quality.duplicate_report(roles.monthly_usage(spark, root), "usage_id")


@query("snake_case")
def q_snake_case(spark, root):
    sources = [
        ("part", "p_type"),
        ("orders", "o_orderpriority"),
        ("customer", "c_mktsegment"),
    ]
    parts = [
        roles.driver(spark, root, table)
        .select(F.lit(column).alias("column_name"), F.col(column).alias("raw_value"))
        .distinct()
        for table, column in sources
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select("column_name", "raw_value", snake_case("raw_value").alias("snake_value"))


# --- enrichment steps ----------------------------------------------------------


@query("month_grid")
def q_month_grid(spark, root):
    return enrich.month_grid(roles.customers(spark, root))


@query("service_usage_union")
def q_service_usage_union(spark, root):
    return enrich.service_usage_grid(
        roles.customers(spark, root),
        roles.fixed_subscriptions(spark, root),
        roles.mobile_subscriptions(spark, root),
    )


@query("plan_mapping")
def q_plan_mapping(spark, root):
    fixed = roles.fixed_subscriptions(spark, root).select(
        F.col("fixed_subscription_id").alias("subscription_id"),
        "customer_id",
        "plan_name",
        F.col("download_speed_mbps").cast("bigint").alias("download_speed_mbps"),
        F.col("monthly_recurring_revenue").cast("double").alias("monthly_price"),
        "subscription_status",
    )
    mobile = roles.mobile_subscriptions(spark, root).select(
        F.col("mobile_subscription_id").cast("string").alias("subscription_id"),
        "customer_id",
        "plan_name",
        F.lit(None).cast("bigint").alias("download_speed_mbps"),
        enrich.plan_price("plan_name").alias("monthly_price"),
        "subscription_status",
    )
    return fixed.unionByName(mobile)


@query("surrogate_ids")
def q_surrogate_ids(spark, root):
    """Invoice numbers inv_00000001.. in (customer, month, order) order."""
    billing = roles.billing_history(spark, root).select("invoice_id", "customer_id", "billing_month")
    ranked = ranking.global_rank(
        billing,
        [F.col("customer_id").asc(), F.col("billing_month").asc(), F.col("invoice_id").asc()],
        rank_col="_n",
        total_col=None,
    )
    return ranked.select("invoice_id", enrich.padded_id("inv_", "_n", 8).alias("invoice_number"))


@query("clip_values")
def q_clip_values(spark, root):
    events = roles.driver(spark, root, "events")
    return events.select(
        "event_id",
        enrich.clip_round("value", 5.0, 720.0, None).alias("incident_minutes"),
        enrich.clip_round("value", 1.0, 168.0, 2).alias("resolution_hours"),
        enrich.clip_round("value", 25.0, 1200.0, 2).alias("fixed_data_gb"),
    )


# --- complaints -----------------------------------------------------------------


def classified_tickets(spark: SparkSession, root: str) -> DataFrame:
    return complaints.classify_support_tickets(
        roles.ticket_texts(spark, root), complaints.COMMON_WORD_LEXICON
    )


@query("complaints_classified")
def q_complaints_classified(spark, root):
    return classified_tickets(spark, root)


@query("conversation_complaints")
def q_conversation_complaints(spark, root):
    """The built-in classifier over every user turn of the chat logs."""
    return complaints.classify_support_tickets(
        roles.conversation_turns(spark, root), complaints.COMMON_WORD_LEXICON
    )


@query("complaints_udf")
def q_complaints_udf(spark, root):
    lexicon = complaints.COMMON_WORD_LEXICON
    return complaints.classify_with(
        roles.ticket_texts(spark, root), lambda: complaints.LexiconClassifier(lexicon)
    )


@query("complaint_tiles")
def q_complaint_tiles(spark, root):
    return complaints.complaint_tiles(classified_tickets(spark, root))


@query("complaint_counts")
def q_complaint_counts(spark, root):
    return reports.value_counts(
        classified_tickets(spark, root), "complaint_category_predicted", "ticket_count"
    )


@query("complaint_score_box")
def q_complaint_score_box(spark, root):
    return reports.score_distribution(
        classified_tickets(spark, root), "complaint_category_predicted", "complaint_category_score"
    )


@query("complaint_samples")
def q_complaint_samples(spark, root):
    """The first 100 tickets, then their classes: no other text is classified."""
    first = roles.ticket_texts(spark, root).orderBy("ticket_id").limit(100)
    return (
        complaints.classify_support_tickets(first, complaints.COMMON_WORD_LEXICON)
        .orderBy("ticket_id")
        .select(
            "ticket_id",
            "customer_id",
            "complaint_category_seed",
            "complaint_category_predicted",
            "complaint_category_score",
            "complaint_category_matches_seed",
            "ticket_text",
        )
    )


# --- run summaries ------------------------------------------------------------------


@query("run_summary")
def q_run_summary(spark, root):
    """The figures each batch step prints, as (metric, value) rows."""
    return reports.run_summary(scored_rows(spark, root))


@query("file_fingerprints")
def q_file_fingerprints(spark, root):
    """SHA-256 of every driver table file, one row per file."""
    return file_fingerprints(spark, f"{root.rstrip('/')}/*.parquet").select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "length", "sha256"
    )


# --- model training, scoring and tree explanations (rows-only checks) --------


# The fitted models of each (application, root, settings), with the listing of
# the driver tables they were fitted on.  Holds model objects only.
_TRAINED: dict[tuple, tuple] = {}


def train_config() -> ml.TrainConfig:
    """The original tool's hyper-parameters (300 trees, 300 boosting rounds, ...)."""
    return ml.TrainConfig()


def trained_models(spark: SparkSession, root: str, config: ml.TrainConfig | None = None):
    config = config or train_config()
    key = (spark.sparkContext.applicationId, root, repr(config))
    state = serving.state_of(spark, root)
    if key not in _TRAINED or _TRAINED[key][0] != state:
        _TRAINED[key] = (state, *ml.train_and_evaluate(customer_features(spark, root), config))
    return (*_TRAINED[key][1:], customer_features(spark, root))


@query("model_selection")
def q_model_selection(spark, root):
    best, rows, _models, _features = trained_models(spark, root)
    return spark.createDataFrame(rows).select(
        "model_name",
        (F.col("model_name") == F.lit(best)).alias("selected"),
        "roc_auc",
        "average_precision",
        "accuracy",
        "precision",
        "recall",
        "f1",
    )


@query("model_scores")
def q_model_scores(spark, root):
    best, _rows, models, features = trained_models(spark, root)
    scored = scoring.model_probability(models[best], features)
    return scoring.score_customers(scored, "churn_probability", sort=True)


@query("ensemble_scores")
def q_ensemble_scores(spark, root):
    """M9 and M10 with a tree ensemble compiled to column expressions."""
    return scoring.score_customers(
        customer_features(spark, root), ensemble.fixed_probability(), sort=True
    )


@query("ensemble_impacts")
def q_ensemble_impacts(spark, root):
    """M11 for trees: every input's attribution, one column each."""
    found = ensemble.fixed_impacts(customer_features(spark, root))
    return found.select(
        "customer_id",
        round_half_up("base_value", 6).alias("base_value"),
        round_half_up("model_output", 6).alias("model_output"),
        *[
            round_half_up(F.col("impacts")[i]["impact"], 6).alias(f"impact_{name}")
            for i, (name, _expr) in enumerate(ensemble.INPUTS)
        ],
    )


@query("explanations_tree")
def q_explanations_tree(spark, root):
    _best, _rows, models, features = trained_models(spark, root)
    model = models["gradient_boosted_trees"]
    transformed = model.transform(features)
    names = ml.transformed_feature_names(model, features)
    attributions = tree_explain.explain_trees(
        transformed, model.stages[-1], names, ensure_checkpoint_dir(spark)
    )
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("model_output")))
    return explain.explanation_table(attributions, probability, F.col("impacts"))


@query("explanations_model")
def q_explanations_model(spark, root):
    """M11 dispatched on the selected model: exact linear attributions when
    logistic regression wins, leaf-path tables for a forest or boosted trees."""
    best, _rows, models, features = trained_models(spark, root)
    attributions, unit = tree_explain.explain_model(models[best], features, ensure_checkpoint_dir(spark))
    output = F.col("model_output")
    probability = output if unit == "probability" else F.lit(1.0) / (F.lit(1.0) + F.exp(-output))
    return explain.explanation_table(attributions, probability, F.col("impacts"))
