"""Spark session helpers.

Library code never creates a session on its own; these helpers are for tests,
the benchmark and command-line use.  ``ensure_checkpoint_dir`` is the one place
that decides where lineage is cut: the shared folder named by
``spark.checkpoint.dir`` when the cluster sets it, and a scratch folder only for
a local-mode session that has none.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry.  AQE re-plans joins and shuffle sizes at
# runtime and splits skewed join partitions; the UI is off (no web server).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files are deleted once the checkpointed frame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "churnlab",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``churnlab`` importable in Python workers (``addPyFile`` of a zip).

    Needed by the few Python stages (``mapInPandas``); done once per context.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil

    package_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="churnlab-pkg-")
    archive = shutil.make_archive(
        os.path.join(out_dir, "churnlab"),
        "zip",
        root_dir=os.path.dirname(package_dir),
        base_dir=os.path.basename(package_dir),
    )
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def cluster_conf(
    input_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Settings sized for a large input: shuffle and file partitions of about
    ``target_partition_bytes`` (so a task's share fits executor memory without
    spilling), at least two tasks per core, AQE coalescing small partitions and
    splitting skewed ones at five times the median.

    Example: 100 TB on 8,000 cores -> about 400,000 initial shuffle partitions,
    coalesced by AQE to ~256 MB each after the partial aggregates shrink the data.
    """
    partitions = max(2 * total_cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it on the context if needed.

    Order: a folder already set on the SparkContext; the session setting
    ``spark.checkpoint.dir`` (the shared folder a cluster names); a fresh scratch
    folder, allowed only for a local-mode master.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared "
            "folder (HDFS, S3, ...) so checkpointed data survives executor loss"
        )
    scratch = tempfile.mkdtemp(prefix="churnlab-ckpt-", dir=os.environ.get("TMPDIR"))
    spark.conf.set("spark.checkpoint.dir", scratch)
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()
