"""Distributed connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _is_done(edges: DataFrame) -> bool:
    """Are the edges a forest of stars: one v for each u, and no v is a u?"""
    total, distinct = edges.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
    if total != distinct:
        return False
    ends = edges.select(F.col("u").alias("w"))
    return edges.join(ends, F.col("v") == F.col("w"), "left_semi").isEmpty()


def _lowest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each u; staged, so that the join with it reads two
    plain shuffles, which adaptive execution splits at a hot u."""
    return stage(edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "cc")


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id that it
    reaches.

    Alternates the large-star and small-star steps, which keep what is
    connected, until each component is a star around its smallest id; the rounds
    grow with the logarithm of the number of ids.  Each step is a
    map-side minimum and a join, and no list of neighbours is ever collected.
    Null ends are ignored; a loop makes an id known; no edges give no rows.
    """
    both = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    known = both.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    now = stage(
        both.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "cc",
    )
    while not _is_done(now):
        # large star: larger neighbours of u move to the smallest of u and its neighbours
        twice = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(twice)
        large = stage(
            twice.where(F.col("v") > F.col("u"))
            .join(low, F.col("u") == F.col("w"))
            .select(F.col("v").alias("u"), F.least("w", "m").alias("v"))
            .distinct(),
            "cc",
        )
        # small star: u and its smaller neighbours move to the smallest of them
        low = _lowest(large)
        now = stage(
            large.join(low, F.col("u") == F.col("w"))
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select(F.col("w").alias("u"), F.col("m").alias("v")))
            .distinct(),
            "cc",
        )
    return known.join(now, F.col("id") == F.col("u"), "left").select(
        "id", F.coalesce("v", "id").alias("component")
    )
