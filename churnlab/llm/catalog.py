"""The registered queries of this subpackage: thin calls of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    hyperplanes,
    jaccard,
    lines,
    mixing,
    negatives,
    packing,
    phrases,
    quality,
    sharding,
    template,
    topk,
    toxicity,
    warc,
)
from .common import prepare, stage
from .labels import remainder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs, mixing.ranked_weights(docs))


def op2_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), shards=8)


def op3_group_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(_table(spark, sf_dir, "documents"), width=5, percent=75)


def op4_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op5_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.extract_main_text(_table(spark, sf_dir, "pages"))


def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(warc.decide_records(pages, least_bytes=1000), folder)
    return warc.read_archives(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _scored(docs: DataFrame, score: Column, folds: int, held_out: int) -> DataFrame:
    return docs.select(
        "doc_id", (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op7_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(quality.measured(_table(spark, sf_dir, "documents")), "quality")
    model = quality.fit(rows, _table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return _scored(rows, quality.score_udf(model)("_x"), 5, 0)


def op8_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), folds=4, held_out=2)
    return _scored(docs, toxicity.score_udf(model)("text"), 4, 2)


def op9_hyperplane_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperplanes.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_reversible_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedupe_lines(_table(spark, sf_dir, "documents"), least=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_annulus_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(
        vectors.withColumn("label", shifted), anchors=F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100
    )


def op13_border_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), support=100, top=2000, longest=5)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_jump_shards,
        op3_group_matrix_join,
        op4_threshold_search,
        op5_template_text,
        op6_warc_round_trip,
        op7_quality_qda,
        op8_subword_toxicity,
        op9_hyperplane_dedup,
        op10_length_buckets,
        op11_reversible_lines,
        op12_annulus_negatives,
        op13_border_phrases,
    )
}
