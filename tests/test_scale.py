"""Skew and plan properties: a customer holding a third of all fact rows, and
partial aggregation before every shuffle of the roll-ups."""

from pyspark.sql import functions as F

from churnlab.operators.summaries import summarize_billing, summarize_usage
from churnlab.session import cluster_conf


def test_hot_customer_rollup_is_exact(spark):
    n = 30000
    rows = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("long").alias("customer_id"),
        F.col("id").alias("invoice_id"),
        (F.col("id") % 100 / 4).cast("decimal(10,2)").alias("invoice_amount"),
        F.when(F.col("id") % 5 == 0, "late").otherwise("paid").alias("payment_status"),
        (F.col("id") % 9).cast("int").alias("days_late"),
    )
    got = summarize_billing(rows.repartition(16)).filter("customer_id = 7").first()
    hot = [i for i in range(n) if i % 3 == 0 or i % 1000 == 7]
    assert got["invoice_count"] == len(hot)
    assert float(got["total_invoice_amount"]) == sum((i % 100) / 4 for i in hot)
    assert got["late_payment_count"] == sum(1 for i in hot if i % 5 == 0)


def test_rollups_aggregate_before_the_shuffle(spark):
    usage = spark.range(0, 1000).select(
        (F.col("id") % 10).alias("customer_id"),
        F.lit(1.5).cast("decimal(10,2)").alias("data_gb"),
        F.lit(1).alias("voice_minutes"),
        F.lit(1).alias("sms_count"),
    )
    plan = summarize_usage(usage)._jdf.queryExecution().executedPlan().toString()
    partial = plan.find("partial_sum")
    exchange = plan.find("Exchange hashpartitioning")
    assert partial > exchange > 0  # printed top-down: the partial aggregate sits below the exchange


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(100 * 1024**4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
    small = cluster_conf(10 * 1024**2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


ROW_LEVEL_QUERIES = [
    "customer_features", "customer_360", "kpi_summary", "risk_scores", "explanations_linear",
    "eval_metrics", "stratified_split", "fraction_sample", "quota_sample", "surrogate_ids",
    "top25_at_risk", "complaints_classified", "key_audit", "profile_columns",
]


def test_no_row_level_data_in_a_single_partition(spark):
    """Every SinglePartition exchange sits above a global partial aggregate (one
    row per task) or above a per-partition offset table (one row per range
    partition): never above customer-level rows."""
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    queries = entry.queries()
    for name in ROW_LEVEL_QUERIES:
        lines = queries[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" not in line:
                continue
            below = lines[i + 1]
            global_partial = "HashAggregate(keys=[]" in below and "partial_" in below
            offsets = "HashAggregate(keys=[_pid" in below or "HashAggregate(keys=[_cell" in below
            assert global_partial or offsets, (name, line.strip(), below.strip())


def test_row_queries_run_no_job_while_they_are_built(spark):
    """Scores without the priority rank, samples and text queries are plans
    only: nothing is ranked, checkpointed or shuffled before an action."""
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    queries = entry.queries()
    for name in ["executive_tiles", "risk_band_counts", "action_counts", "run_summary", "quota_sample",
                 "quota_features", "fraction_sample", "stratified_split", "complaints_classified",
                 "complaint_counts", "complaint_samples", "customer_features"]:
        queries[name](spark, SF_SMALL)  # reads the schemas
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        queries[name](spark, SF_SMALL)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}") == [], name


def test_quota_matches_a_window(spark):
    from pyspark.sql import Window

    from churnlab.operators.ranking import quota_top_k

    df = spark.range(0, 4000).select(
        F.col("id").alias("k"), (F.col("id") * 7919 % 31).alias("v"), F.when(F.col("id") % 9 > 0, "a").otherwise("b").alias("g")
    )
    order = [F.col("v").desc(), F.col("k")]
    ranked = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    for quotas in ({"a": 3, "b": 5}, {"a": 2500, "b": 10, "c": 4}, {"b": 100000}):
        want = {r["k"] for r in ranked.collect() if r["n"] <= quotas.get(r["g"], 0)}
        assert {r["k"] for r in quota_top_k(df, "g", quotas, order).collect()} == want


def test_customer_page_pushes_its_filter_to_every_scan(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    plan = entry.queries()["customer_detail"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("EqualTo(customer_id,42)" in line for line in scans)


def test_appended_files_are_read(spark, tmp_path):
    from churnlab.sources import roles

    spark.range(3).write.parquet(f"{tmp_path}/region.parquet")
    assert roles.driver(spark, str(tmp_path), "region").count() == 3
    spark.range(5).write.mode("append").parquet(f"{tmp_path}/region.parquet")
    assert roles.driver(spark, str(tmp_path), "region").count() == 8


def test_feature_plan_shuffle_count(spark):
    """Spine, orders (mobile + invoices), events (four roles), usage (line items
    per order, orders for that join, per customer), plus the two nation-join
    exchanges that a real run broadcasts: eight with broadcasts disabled."""
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()["customer_features"](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") <= 8, plan


def _plan(spark, name):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    return entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_audits_and_reports_scan_each_table_once(spark):
    for name, scans, exchanges in [("fk_orphans", 5, 5), ("key_audit", 5, 4), ("run_summary", 4, 5), ("quota_sample", 4, 5)]:
        plan = _plan(spark, name)
        assert plan.count("FileScan") == scans, name
        assert plan.count("Exchange hashpartitioning") <= exchanges, name
    assert "l_orderkey" not in _plan(spark, "quota_sample")
    # the usage key needs line items alone
    assert "SortMergeJoin" not in _plan(spark, "key_audit")


def test_quartiles_are_selected_without_a_sort_of_the_rows(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    for name in ("priority_quartiles", "top25_at_risk", "risk_scores"):
        query = entry.queries()[name]
        query(spark, SF_SMALL)  # reads the schemas
        spark.sparkContext.setJobGroup(f"select-{name}", name)
        query(spark, SF_SMALL)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(f"select-{name}") == [], name
        plan = _plan(spark, name)
        assert "Scan ExistingRDD" not in plan  # no checkpoint
        assert plan.count("rangepartitioning") <= 1, name  # the order of the result


def test_stored_pages_outlive_an_application(spark, monkeypatch, tmp_path):
    """A fitting version is read again; a half-written one is not; a new state
    of the inputs gets a new version and the one before stays."""
    import shutil

    from churnlab.plans import catalog, serving
    from tests.conftest import SF_SMALL

    root = tmp_path / "tables"
    shutil.copytree(SF_SMALL, root)
    features = catalog.customer_features(spark, str(root))
    first = serving.stored_tables(spark, str(root), features)
    store = serving.Store(spark, str(root))
    (folder, state), = store.versions()
    with monkeypatch.context() as m:  # as a second application: nothing in memory, nothing written
        m.setattr(serving.Store, "add", lambda *a: (_ for _ in ()).throw(AssertionError("written again")))
        again = serving.stored_tables(spark, str(root), features)
    assert again["scores"].count() == first["scores"].count() == features.count()
    # newer, but without a manifest
    half = f"{store.folder}/v-99999999999999999999-half"
    first["scores"].limit(1).write.parquet(f"{half}/scores")
    assert store.find(state) == folder
    (root / "customer.parquet").touch()
    serving.stored_tables(spark, str(root), features)
    assert len(store.versions()) == 2 and store.versions()[0][0] == folder
    (root / "customer.parquet").touch()
    serving.stored_tables(spark, str(root), features)
    assert len(store.versions()) == 2 and store.find(state) is None
