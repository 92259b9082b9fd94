"""Stored tables that the dashboards read: features, scores and explanations.

A store is a folder of versions, shared by all applications:

    <store>/v-<time>-<id>/features, scores, explanations   ordered by customer
    <store>/v-<time>-<id>/manifest.json                    written last

The manifest names the state of the driver tables (files, lengths, times) and of
the code that the version was made from.  A page reads the newest version whose
manifest fits the present state; if there is none, a new one is written.  A
version without a manifest was not finished and is never read.  The version
before the newest is kept for pages that are still reading it.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from churnlab.operators import explain, scoring
from churnlab.session import ensure_checkpoint_dir
from churnlab.sources import roles

# The driver tables behind the features.
SOURCES = ("customer", "nation", "orders", "lineitem", "events")
TABLES = ("features", "scores", "explanations")
KEPT_VERSIONS = 2


def _code_state() -> str:
    """Digest of the library's modules: other code may store other values."""
    digest = hashlib.sha256()
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for part in ("functions", "operators", "plans", "sources"):
        folder = os.path.join(package, part)
        for name in sorted(os.listdir(folder)):
            if name.endswith(".py"):
                with open(os.path.join(folder, name), "rb") as f:
                    digest.update(f.read())
    return digest.hexdigest()


def state_of(spark: SparkSession, root: str) -> str:
    listed = [roles.listing(spark, root, name) for name in SOURCES]
    return hashlib.sha256(json.dumps([listed, _code_state()]).encode()).hexdigest()


class Store:
    """The versions of the stored tables of one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        ensure_checkpoint_dir(spark)
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        shared = shared or spark.sparkContext.getCheckpointDir()
        name = hashlib.sha256(self.root.encode()).hexdigest()[:16]
        self.folder = f"{shared.rstrip('/')}/serving/{name}"
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[tuple[str, str]]:
        """(folder, state) of the finished versions, oldest first."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        found = []
        for name in sorted(f.getPath().getName() for f in self._fs.listStatus(self._path(self.folder))):
            manifest = f"{self.folder}/{name}/manifest.json"
            if name.startswith("v-") and self._fs.exists(self._path(manifest)):
                text = self.spark.read.text(manifest, wholetext=True).first()
                if text and text[0].endswith("}"):
                    found.append((f"{self.folder}/{name}", json.loads(text[0])["state"]))
        return found

    def find(self, state: str) -> str | None:
        return next((folder for folder, made_from in reversed(self.versions()) if made_from == state), None)

    def _write(self, df: DataFrame, path: str) -> None:
        df.repartitionByRange("customer_id").sortWithinPartitions("customer_id").write.parquet(path)

    def add(self, state: str, features: DataFrame) -> str:
        """Write a version; its manifest comes last, under its name at once."""
        folder = f"{self.folder}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self._write(features, f"{folder}/features")
        kept = self.spark.read.parquet(f"{folder}/features")
        probability = scoring.scorecard_probability()
        self._write(scoring.score_customers(kept, probability, sort=False), f"{folder}/scores")
        background = explain.linear_background(kept, scoring.SCORECARD)
        impacts = explain.linear_impacts(kept, scoring.SCORECARD, background)
        self._write(explain.explanation_table(kept, probability, impacts), f"{folder}/explanations")
        out = self._fs.create(self._path(f"{folder}/_manifest"))
        out.write(bytearray(json.dumps({"root": self.root, "state": state}).encode()))
        out.close()
        self._fs.rename(self._path(f"{folder}/_manifest"), self._path(f"{folder}/manifest.json"))
        for old, _ in self.versions()[:-KEPT_VERSIONS]:
            self._fs.delete(self._path(old), True)
        return folder


def stored_tables(spark: SparkSession, root: str, features: DataFrame) -> dict[str, DataFrame]:
    """The stored ``features``, ``scores`` and ``explanations``; written first if
    there is no version for the present driver tables."""
    store, state = Store(spark, root), state_of(spark, root)
    folder = store.find(state) or store.add(state, features)
    return {name: spark.read.parquet(f"{folder}/{name}") for name in TABLES}
