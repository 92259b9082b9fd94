"""Sharding by jump consistent hashing, in SQL functions only.

A row's key walks through the jumps of the published algorithm: a linear
congruential step gives the next shard count at which the key would move; the
last jump below the shard count is its shard.  There is no ring table, and
appending a shard moves rows into the new shard only.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered

# Fixed value: multiplier of the algorithm's 64-bit congruential generator.
MULTIPLIER = 2862933555777941757


def jump_shard(key: Column, shards: int) -> Column:
    """Shard (0 to ``shards`` - 1) of an integer key; a null key counts as 0.

    The state is (generator, last jump, next jump).  Each jump goes at least
    one shard further, so ``shards`` steps always suffice.  The generator is a
    decimal because its 64-bit product would overflow a long.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    wide = "decimal(38,0)"
    wrap, low = F.lit(Decimal(2**64)).cast(wide), F.lit(Decimal(2**33)).cast(wide)
    long_key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    seed = F.when(long_key < 0, long_key.cast(wide) + wrap).otherwise(long_key.cast(wide))
    start = F.struct(
        seed.cast(wide).alias("g"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j")
    )

    def step(state: Column, _: Column) -> Column:
        nxt = ((state["g"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1)) % wrap).cast(wide)
        top = ((nxt - nxt % low) / low).cast("long")
        jump = F.floor((state["j"] + 1).cast("double") * (F.lit(float(2**31)) / (top + 1).cast("double")))
        return F.when(state["j"] >= shards, state).otherwise(
            F.struct(nxt.alias("g"), state["j"].alias("b"), jump.cast("long").alias("j"))
        )

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, step, lambda s: s["b"]).cast("int")


def shard_rows(
    docs: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    cells: int = 4096,
) -> DataFrame:
    """Place every row in a shard by its key and number the shard's rows.

    Returns the key, ``size`` (UTF-8 bytes + 1), ``text_crc32`` (unsigned),
    ``law``, ``shard``, ``slot`` (gapless from 0 in the shard) and
    ``grown_shard`` (the shard once one more is appended).  A null text has no
    bytes (size 1, crc 0); a null key counts as 0; repeated rows get a slot
    each; no rows give no rows; other columns are ignored.  ``cells`` bounds
    the offset rows of a shard; slots are numbered within cells, so no task
    holds a shard.
    """
    if cells < 1:
        raise ValueError("cells must be at least 1")
    rows = docs.select(
        F.col(key).alias("_key"),
        F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0)).alias("_bytes"),
        F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"),
    ).select(
        F.col("_key"),
        (F.col("_bytes") + 1).alias("size"),
        "text_crc32",
        F.lit("key").alias("law"),
        jump_shard(F.col("_key"), shards).alias("shard"),
        jump_shard(F.col("_key"), shards + 1).alias("grown_shard"),
    )
    cell = F.pmod(
        F.pmod(F.coalesce(F.col("_key").cast("long"), F.lit(0)), F.lit(cells))
        + F.pmod(F.col("text_crc32"), F.lit(cells)),
        F.lit(cells),
    ).cast("int")
    order = [F.col("_key"), F.col("text_crc32"), F.col("size")]
    return numbered(rows, "shard", cell, order, "slot", cells).select(
        F.col("_key").alias(key), "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
