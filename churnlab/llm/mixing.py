"""Mixing sources to target weights by capped water-filling.

Each source's share of the budget follows its weight.  A source is clamped at
``epochs`` passes over its words and the excess is shared again among the rest,
by weight, until no share is above its clamp.  A source then takes every
document ``floor(target / words)`` times, and once more a seeded sample of
documents that fills the remaining fraction.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, word_count


def _above(weight: Column, cap: Column, room: int, weights: int) -> Column:
    """Is the share ``weight * room / weights`` above ``cap``?  Exact."""
    wide = "decimal(38,0)"
    share = weight.cast(wide) * F.lit(Decimal(room))
    return share > cap.cast(wide) * F.lit(Decimal(weights))


def water_fill(sources: DataFrame, epochs: int = 3, budget: int | None = None) -> DataFrame:
    """Add ``target`` to ``sources`` (source, source_size, weight).

    Each round clamps every source whose share exceeds ``epochs`` times its
    size and takes the clamped words and weights out; only their sums come to
    the driver.  The share per unit of weight never falls from one round to the
    next, so the last round's level says which sources are clamped.  The
    default budget is the words of all sources.  A source without words or
    weight gets 0; no sources give no rows.
    """
    if epochs < 1:
        raise ValueError("epochs must be at least 1")
    cap, weight = F.col("source_size") * epochs, F.col("weight")
    words, all_weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, all_weights = words or 0 if budget is None else budget, all_weights or 0
    room, weights = budget, all_weights
    while weights > 0:
        clamped = sources.where(_above(weight, cap, room, weights))
        gone, gone_weights = clamped.agg(F.sum(cap), F.sum("weight")).first()
        after = budget - (gone or 0), all_weights - (gone_weights or 0)
        if after == (room, weights):
            break
        room, weights = after
    if weights <= 0:  # every source with weight is clamped
        return sources.withColumn("target", F.when(weight > 0, cap.cast("double")).otherwise(0.0))
    share = (weight.cast("decimal(19,0)") * F.lit(Decimal(room))).cast("double") / F.lit(float(weights))
    return sources.withColumn(
        "target", F.when(_above(weight, cap, room, weights), cap.cast("double")).otherwise(share)
    )


def _pass(rows: DataFrame, rooms: DataFrame) -> DataFrame:
    """One pass: ``_kind`` of each row is ``big`` (larger than its source's room),
    ``now`` (it and the fitting ones before it fit the room together) or ``rest``.

    ``rooms`` has ``_left`` for each (source, cell), so the rows of a hot source
    meet it in all of their cells; sums per cell become offsets.
    """
    fits = rows.join(rooms, ["_s", "_cell"])
    fits = fits.withColumn("_open", F.when(F.col("size") <= F.col("_left"), F.col("size")).otherwise(0))
    before = Window.partitionBy("_s").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fits.groupBy("_s", "_cell")
        .agg(F.sum("_open").alias("_sum"))
        .select("_s", "_cell", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    upto = Window.partitionBy("_s", "_cell").orderBy("_key", "doc_id", "size")
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)
    within = F.col("_before") + F.col("_upto") <= F.col("_left")
    kind = F.when(F.col("_open") == 0, "big").when(within, "now").otherwise("rest")
    marked = fits.withColumn("_upto", F.sum("_open").over(upto)).join(offsets, ["_s", "_cell"])
    return stage(marked.withColumn("_kind", kind).drop("_before", "_upto", "_open", "_left"), "mix")


def _nearest(rows: DataFrame) -> DataFrame:
    """Mark one more document of a source, if that comes nearer to its room:
    the one whose size is nearest to it (of equal rows, one)."""
    gap = F.abs(F.col("size") - F.col("_left"))
    best = (
        rows.where(~F.col("_extra") & (F.col("size") > 0) & (gap < F.col("_left")))
        .groupBy("_s")
        .agg(F.min(F.struct(gap.alias("gap"), "_key", "doc_id", "size", "_cell")).alias("_best"))
        .select("_s", F.col("_best._cell").alias("_cell"), "_best")
    )
    equal = Window.partitionBy("_s", "_cell", "_key", "doc_id", "size").orderBy("_extra")
    this = (
        (F.row_number().over(equal) == 1)
        & ~F.col("_extra")
        & (F.col("_key") == F.col("_best._key"))
        & F.col("doc_id").eqNullSafe(F.col("_best.doc_id"))
        & (F.col("size") == F.col("_best.size"))
    )
    return rows.join(best, ["_s", "_cell"], "left").withColumn(
        "_extra", F.col("_extra") | F.coalesce(this, F.lit(False))
    )


def mix_sources(
    docs: DataFrame,
    weights: DataFrame,
    epochs: int = 3,
    budget: int | None = None,
    seed: int = 17,
    cells: int = 4096,
    carry: list[str] | None = None,
) -> DataFrame:
    """Decide how often the mix takes each document.

    ``docs`` has doc_id, text and source; ``weights`` one row per source
    (source, weight; integers).  Returns doc_id, source, ``size`` (words),
    ``source_size``, ``target`` (words wanted of its source), ``copies`` (at
    most ``epochs``) and ``taken`` (copies x size), and the columns in
    ``carry``.  The order of the fractional sample is an MD5 of seed and
    doc_id: a source takes every document in that order that still fits what it
    wants; at last one document may go beyond that if it comes nearer to it.

    Passes over the documents that still fit find the sample: each takes them up
    to the first that is too large, which leaves it and all as large behind.
    They end when nothing fits any source (one check of a pass's rest a pass).

    A null or empty text has size 0 and, as a source without weight does, adds
    nothing (copies are the whole repetitions, taken is 0).  A null source is
    a source.  Repeated rows count and are taken singly.  No rows give no rows.
    """
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    named = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), *(carry or []), named.alias("_s")
    ).withColumn("_key", F.md5(seeded))
    # 12 bits of the key choose a cell; more cells for more rows in a source
    bits = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    sized = stage(
        sized.withColumn("_cell", F.floor(bits * cells / F.lit(2**32)).cast("int")), "mix"
    )
    met = stage(sized.groupBy("_s", "_cell").agg(F.sum("size").alias("size"), F.min("source").alias("source")), "mix")
    sources = met.groupBy("_s").agg(F.sum("size").alias("source_size"), F.min("source").alias("source"))
    given = weights.select(F.col("source").alias("_src"), F.col("weight").cast("long"))
    sources = sources.join(given, F.col("source").eqNullSafe(F.col("_src")), "left").select(
        "_s", "source_size", F.coalesce("weight", F.lit(0)).alias("weight")
    )
    targets = water_fill(stage(sources, "mix"), epochs, budget)
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    wanted = stage(
        targets.select("_s", "source_size", "target", whole.alias("_whole"), (F.col("target") - whole * size).alias("_left")),
        "mix",
    )

    def in_cells(of_source: DataFrame) -> DataFrame:
        return met.select("_s", "_cell").join(of_source, "_s")

    rooms, rest = wanted.select("_s", "_left"), sized.where("size > 0")
    parts = [sized.where("size = 0").withColumn("_extra", F.lit(False))]
    while not rest.isEmpty():
        now = _pass(rest, in_cells(rooms))
        took = now.where("_kind = 'now'").groupBy("_s").agg(F.sum("size").alias("_took"))
        rooms = stage(
            rooms.join(took, "_s", "left").select("_s", (F.col("_left") - F.coalesce("_took", F.lit(0))).alias("_left")), "mix"
        )
        parts.append(now.where("_kind <> 'rest'").withColumn("_extra", F.col("_kind") == "now").drop("_kind"))
        rest = now.where("_kind = 'rest'").drop("_kind")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.join(in_cells(wanted.drop("_left").join(rooms, "_s")), ["_s", "_cell"])
    rows = _nearest(rows)
    copies = F.col("_whole") + F.col("_extra").cast("long")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"), *(carry or []),
    )


def ranked_weights(docs: DataFrame, pattern: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Weights that repeat ``pattern`` over the sources by code point, null last.

    The window holds one row per source, not per document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*(F.lit(w) for w in pattern))
    place = F.row_number().over(order) - 1
    return docs.select("source").distinct().select("source", table[place % len(pattern)].alias("weight"))
