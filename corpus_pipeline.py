"""The corpus pipeline: from raw documents to packed training batches.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the result is
written as Parquet and read again as the next stage's docs.  Stages read the
rows that their predecessor kept; all but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlab.llm import jaccard, mixing, packing, quality, toxicity
from churnlab.llm.common import prepare, stage

THRESHOLD = 0.3  # a document is toxic, or good, from this score on


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold.  Null and empty
    texts are not toxic."""
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return docs.where(toxicity.score_udf(model)("text") < THRESHOLD)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    model = quality.fit(quality.measured(docs), _labels(spark, sf_dir))
    return docs.where(quality.score_udf(model)(quality.statistics_udf()("text")) >= THRESHOLD)


def _wrapped(docs: DataFrame) -> DataFrame:
    """Each row as a struct (row) beside its id, source and text, so that no
    column of the documents meets a name used here, and a hash of the row."""
    return docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        "doc_id",
        "source",
        "text",
        F.xxhash64(*(docs[c] for c in docs.columns)).alias("hash"),
    )


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each class of near-duplicates.

    Rows are told apart by all of their columns (a 64-bit hash): unrelated texts
    under one doc_id stay, rows without a doc_id are compared as others are and
    come last in their class, and equal rows stay as one.  Documents without words
    are in classes of their own and stay.
    """
    rows = _wrapped(docs)
    classes = jaccard.similarity_classes(rows.select(F.col("hash").alias("doc_id"), "text"))
    names = rows.groupBy("hash").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("name"))
    first = (
        classes.join(names, F.col("doc_id") == F.col("hash"))
        .groupBy("component_id")
        .agg(F.min(F.struct("name", "hash")).alias("first"))
        .select(F.col("first.hash").alias("kept"))
    )
    # the shuffle of the rows by hash serves the join and the dropping
    return (
        rows.drop("source", "text", "doc_id")
        .join(first, F.col("hash") == F.col("kept"), "left_semi")
        .dropDuplicates(["hash"])
        .select("row.*")
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it (0 to 3 times).

    The mix decides on narrow rows; its copies come back to the documents by
    doc_id and row hash.  Equal rows share the copies of their group.
    """
    prepare(spark)
    rows = _wrapped(docs)
    taken = mixing.mix_sources(rows, mixing.ranked_weights(rows), carry=["hash"])
    totals = taken.groupBy(F.col("doc_id").alias("id"), F.col("hash").alias("h")).agg(
        F.sum("copies").alias("total"), F.count(F.lit(1)).alias("equal")
    )
    within = Window.partitionBy("doc_id", "hash").orderBy("hash")
    copies = F.expr("total div equal") + (F.col("place") <= F.col("total") % F.col("equal")).cast("long")
    return (
        rows.drop("source", "text")
        .join(totals.where("total > 0"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h")))
        .withColumn("place", F.row_number().over(within))
        .withColumn("copies", copies)
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("row.*")
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and place of every document of the mix."""
    prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", one_of_each_class),
    ("mixing", mix),
    ("packing", pack),
]

# The classifiers and the shingle sets are beyond SQL; the tests hold the
# stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each stage's result is a table."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
