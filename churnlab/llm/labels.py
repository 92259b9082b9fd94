"""Which labelled rows a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def learning_rows(
    labels: DataFrame, label: str, folds: int, held_out: int, bound: int, seed: int = 17
) -> DataFrame:
    """At most ``bound`` labelled ids (_id, _label) outside the held-out fold.

    They are the first in the order of a seeded MD5 of the id, so a rerun
    takes the same rows.  Null labels and null ids don't count; a repeated id
    counts once and is positive if any of its labels is.
    """
    rows = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(remainder(F.col("doc_id"), folds) != held_out)
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(F.col(label).cast("int")).alias("_label"))
    )
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")))
    return rows.orderBy(key, "_id").limit(bound)
