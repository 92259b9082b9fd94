"""Packing documents into length buckets with the least padding.

A global histogram of lengths (map-side sums, a bounded number of bins) goes
to the driver, where dynamic programming places the bucket boundaries.  Within
a bucket, documents in seeded order form batches of a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, stage, word_count


def length_bin(length: Column, exact: int) -> Column:
    """Lengths up to ``exact`` are bins of their own; above, each doubling of
    the length has ``exact`` / 2 bins, so bins grow with the logarithm of the
    longest text only."""
    half = exact // 2
    # doubling of a length above ``exact``: length / 2^shift lies in [half, exact)
    shift = F.greatest(
        F.lit(0), F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double") / half)).cast("int")
    )
    step = F.pow(F.lit(2.0), shift).cast("long")
    return F.when(length < exact, length).otherwise(F.ceil(length / step).cast("long") * step)


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, words: np.ndarray, buckets: int) -> list[int]:
    """Boundaries (at most ``buckets``, ascending) with the least total padding.

    ``lengths`` are the bins' largest lengths, ascending; ``counts`` and
    ``words`` the documents and the words in each.  best[i] is the least
    padding of the first i bins with k buckets; a bucket over bins j..i pads
    each of its documents to lengths[i].
    """
    n = len(lengths)
    if n == 0:
        return []
    docs = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    total = np.concatenate([[0], np.cumsum(words)]).astype(np.float64)
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(min(buckets, n)):
        nxt, cut = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        nxt[0] = 0.0
        for i in range(1, n + 1):
            pad = best[:i] + lengths[i - 1] * (docs[i] - docs[:i]) - (total[i] - total[:i])
            cut[i] = int(np.argmin(pad))
            nxt[i] = pad[cut[i]]
        best = nxt
        cuts.append(cut)
    out, i = [], n
    for cut in reversed(cuts):
        if i == 0:
            break
        out.append(int(lengths[i - 1]))
        i = int(cut[i])
    return out[::-1]


def pack(
    docs: DataFrame,
    buckets: int = 16,
    token_budget: int = 65536,
    seed: int = 17,
    exact: int = 512,
    cells: int = 4096,
) -> DataFrame:
    """Assign every document a length bucket, a batch and its place in it.

    Returns doc_id, ``length`` (words; at least 1 slot is padded to), ``bucket``
    (from 0), ``bucket_length`` (what its documents are padded to), ``batch``
    (gapless from 0 in the bucket) and ``place`` (gapless from 0 in the batch).
    A batch holds ``token_budget // bucket_length`` documents, at least one, so
    a text longer than the budget is a batch of its own, uncut.

    Boundaries are optimal over the bins of ``length_bin``: exact lengths below
    ``exact``, relative steps of 2 / ``exact`` above; each bin counts as its
    longest document, so nothing is cut.  Null and empty texts have length 0
    and pad to 1.  Repeated rows get places of their own; no rows give none.
    """
    seeded = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select("doc_id", word_count(F.col("text")).alias("length"), seeded.alias("_key"))
    sized = stage(sized, "pack")
    histogram = (
        sized.groupBy(length_bin(F.col("length"), exact).alias("bin"))
        .agg(F.max("length").alias("longest"), F.count(F.lit(1)).alias("n"), F.sum("length").alias("words"))
        .orderBy("longest")
        .toPandas()
    )
    edges = best_boundaries(
        *(histogram[c].to_numpy(dtype=np.int64) for c in ("longest", "n", "words")), buckets
    )
    bucket, width = F.lit(0), F.lit(1).cast("long")
    for i in reversed(range(len(edges))):
        inside = F.col("length") <= edges[i]
        bucket = F.when(inside, i).otherwise(bucket)
        width = F.when(inside, F.lit(max(edges[i], 1)).cast("long")).otherwise(width)
    rows = sized.withColumn("bucket", bucket.cast("int")).withColumn("bucket_length", width)
    bits = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    cell = F.floor(bits * cells / F.lit(2**32)).cast("int")
    order = [F.col("_key"), F.col("doc_id"), F.col("length")]
    size = F.greatest(F.floor(F.lit(token_budget) / F.col("bucket_length")), F.lit(1)).cast("long")
    return (
        numbered(rows, "bucket", cell, order, "_n", cells)
        .withColumn("_size", size)
        .select(
            "doc_id", "length", "bucket", "bucket_length",
            F.floor(F.col("_n") / F.col("_size")).cast("long").alias("batch"),
            (F.col("_n") % F.col("_size")).alias("place"),
        )
    )
