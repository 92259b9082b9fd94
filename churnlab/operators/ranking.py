"""Ranking, quantiles and sampling.

Global order statistics are the one place a naive Spark plan collapses into a
single task: ``row_number() over (order by x)`` shuffles every row to one
partition.  Here a total order is computed in parallel instead:

1. ``repartitionByRange`` on the order keys (ties broken by the caller's unique
   key) and ``sortWithinPartitions``: partition *i* holds a contiguous slice of
   the order; a key holding a third of the rows is split across partitions
   because the composite key is unique.
2. Each row is tagged with its partition id and ``monotonically_increasing_id``
   (strictly increasing inside a partition), then the frame is checkpointed to
   the reliable checkpoint folder.  Range bounds are sampled, so without this a
   recomputation (or a lost executor) could move rows between partitions and
   the counts of step 3 would no longer describe the rows being numbered.
3. Per-partition counts (one row per partition) give each partition's offset;
   that table is bounded by the partition count, and Spark's own size checks
   choose its join.  ``rank = offset + position in partition``.

Per-group ranks work the same way with the group key leading the order; the
offset table then has at most partitions + groups rows.

Quartiles need three rows of the order only; they are selected without a sort
(:func:`quartile_cuts`).

Samples and splits only need positions in a hash order.  They are counted per
cell of the hash range, with one shuffle and neither sort bounds nor checkpoint
(:func:`hash_positions`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions.scalar import col_
from churnlab.session import ensure_checkpoint_dir

PID, MID = "_pid", "_mid"
# Parts of the hash range in which positions are counted, and salts of a quota
# group: fixed, so a plan never depends on the size of the data.
HASH_CELLS = 4096
QUOTA_SALTS = 64


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_tagged(
    df: DataFrame, sort_exprs: Sequence[Column], num_partitions: int | None = None
) -> DataFrame:
    """Range-partition and sort by ``sort_exprs``; tag rows; reliable checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    n = _partitions(df, num_partitions)
    ranged = df.repartitionByRange(n, *sort_exprs).sortWithinPartitions(*sort_exprs)
    tagged = ranged.withColumn(PID, F.spark_partition_id()).withColumn(
        MID, F.monotonically_increasing_id()
    )
    return tagged.checkpoint(eager=True)


def _join_offsets(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` with null-safe equality (a NULL group is a group)."""
    renamed = small.select(*[F.col(c).alias(f"_s_{c}") if c in keys else F.col(c) for c in small.columns])
    cond = None
    for k in keys:
        term = big[k].eqNullSafe(renamed[f"_s_{k}"])
        cond = term if cond is None else cond & term
    return big.join(renamed, cond, "inner").drop(*[f"_s_{k}" for k in keys])


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    rank_col: str = "rank",
    total_col: str | None = "n_ranked",
    group_cols: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """1-based position of each row in ``order`` (within ``group_cols`` if given).

    ``order`` must be a total order (end it with a unique key).  Adds
    ``rank_col`` and, when ``total_col`` is set, the row count of the row's
    group.  Equivalent to ``row_number() over (partition by g order by ...)``.
    """
    groups = [F.col(g) for g in group_cols]
    tagged = range_tagged(df, [*(g.asc_nulls_first() for g in groups), *order], num_partitions)
    keys = [PID, *group_cols]
    counts = tagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min(MID).alias("_first_mid")
    )
    group_window = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(1))
    before = group_window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys,
        "_first_mid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"),
        F.sum("_cnt").over(group_window).alias("_total"),
    )
    joined = _join_offsets(tagged, offsets, keys)
    out = joined.withColumn(
        rank_col, (F.col("_offset") + F.col(MID) - F.col("_first_mid") + 1).cast("bigint")
    )
    if total_col:
        out = out.withColumn(total_col, F.col("_total").cast("bigint"))
    return out.drop(PID, MID, "_first_mid", "_offset", "_total")


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    measures: dict[str, Column],
    num_partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``measures`` along a total ``order``.

    Per-partition running sums (a window over one range partition each) plus
    the sum of all earlier partitions (a table with one row per partition).
    Also adds ``<name>_total`` with the grand total of each measure.
    """
    staged = df.select("*", *[m.alias(f"_m_{k}") for k, m in measures.items()])
    tagged = range_tagged(staged, list(order), num_partitions)
    part = tagged.groupBy(PID).agg(*[F.sum(f"_m_{k}").alias(f"_p_{k}") for k in measures])
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    offsets = part.select(
        PID,
        *[F.coalesce(F.sum(f"_p_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in measures],
        *[F.sum(f"_p_{k}").over(everything).alias(f"{k}_total") for k in measures],
    )
    running = Window.partitionBy(PID).orderBy(MID).rowsBetween(Window.unboundedPreceding, 0)
    inner = tagged.select(
        "*", *[F.sum(f"_m_{k}").over(running).alias(f"_r_{k}") for k in measures]
    )
    joined = _join_offsets(inner, offsets, [PID])
    out = joined.select(
        *[c for c in df.columns],
        *[(F.col(f"_o_{k}") + F.col(f"_r_{k}")).alias(k) for k in measures],
        *[F.col(f"{k}_total") for k in measures],
    )
    return out


# --- W1, W2: quartiles by selection ------------------------------------------

# Parts of the key range in which rows of one score are counted.
KEY_PARTS = 1 << 20


def _coarse(score: Column) -> Column:
    """A bin that never falls as the score rises: 2^14 to a doubling of 1 + |x|."""
    size = F.floor(F.log2(F.abs(score) + 1) * (1 << 14))
    ends = F.when(F.isnan(score), F.lit(1 << 50)).when(F.abs(score) == float("inf"), F.lit(1 << 49))
    return F.when(score < 0, -F.coalesce(ends, size)).otherwise(F.coalesce(ends, size)).cast("long")


def _holding(bins: DataFrame, order: Sequence[str]) -> DataFrame:
    """Of each cut's ``bins`` (``_c`` rows each) the one that holds its rank
    ``left``, which becomes the rank inside that bin."""
    upto = Window.partitionBy("cut").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = F.col("left") - F.sum("_c").over(upto) + F.col("_c")
    return bins.withColumn("left", inside).where((F.col("left") >= 1) & (F.col("left") <= F.col("_c"))).drop("_c")


def quartile_cuts(df: DataFrame, score: str | Column, key: str = "customer_id") -> DataFrame:
    """One row: the rows at the three quartile cuts in the order (score, key), as
    structs ``cut_1`` to ``cut_3``; of nulls where no row has a score.

    Exact selection without a sort.  The pairs (score, key) are shuffled once.
    Rows are counted per coarse bin of the score; in the bins that hold a cut,
    per score and part of the key range; and the rows of the one part that holds
    the cut are ordered.  So neither a score nor a bin that many rows share comes
    to one task - unless the key is no integer, when a score has one part.
    Nothing runs while this is built.
    """
    pairs = df.select(F.struct(col_(score).cast("double").alias("s"), F.col(key).alias("k")).alias("r"))
    pairs = pairs.where("r.s IS NOT NULL").repartition("r")
    s, k = F.col("r.s"), F.col("r.k")

    everywhere = Window.partitionBy(F.lit(1))
    counted = (
        pairs.withColumn("_cell", _coarse(s))
        .groupBy("_cell")
        .agg(F.count(F.lit(1)).alias("_c"), F.min(k).alias("k_lo"), F.max(k).alias("k_hi"))
        .select(
            "_cell", "_c", F.sum("_c").over(everywhere).alias("_n"),
            F.min("k_lo").over(everywhere).alias("k_lo"), F.max("k_hi").over(everywhere).alias("k_hi"),
        )
    )
    # quartile j + 1 starts behind rank 1 + floor(j * (n - 1) / 4)
    first = counted.withColumn("cut", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    first = _holding(first.withColumn("left", 1 + F.expr("(cut * (_n - 1)) div 4")).drop("_n"), ["_cell"])

    part = F.lit(0).cast("long")
    if isinstance(df.schema[key].dataType, T.IntegralType):
        along = [(x.cast("decimal(20,0)") - F.col("k_lo").cast("decimal(20,0)")).cast("double") for x in (k, F.col("k_hi"))]
        part = F.when(along[1] > 0, F.floor(along[0] / along[1] * (KEY_PARTS - 1))).otherwise(0).cast("long")
    met = pairs.join(F.broadcast(first), _coarse(s) == F.col("_cell"))  # three rows
    parts = met.groupBy("cut", "left", "k_lo", "k_hi", s.alias("at"), part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    second = _holding(parts, ["at", "_p"])

    met = pairs.join(F.broadcast(second), (s == F.col("at")) & (part == F.col("_p")))
    nth = met.withColumn("_rn", F.row_number().over(Window.partitionBy("cut").orderBy(k)))
    nth = nth.where(F.col("_rn") == F.col("left"))
    ends = [F.max(F.when(F.col("cut") == j, x)).alias(f"{n}_{j}") for j in (1, 2, 3) for n, x in (("s", s), ("k", k))]
    return nth.agg(*ends).select(
        *(F.struct(F.col(f"s_{j}").alias("s"), F.col(f"k_{j}").alias("k")).alias(f"cut_{j}") for j in (1, 2, 3))
    )


def with_quartiles(
    df: DataFrame, cuts: DataFrame, score: str | Column, key: str = "customer_id", out_col: str = "retention_priority"
) -> DataFrame:
    """Add the quartile label of each row by comparing it with the one row of
    ``cuts``; 'nan' for a null score."""
    s, k = col_(score).cast("double"), F.col(key)

    def behind(j: int) -> Column:
        at = F.col(f"cut_{j}")
        return (s > at["s"]) | ((s == at["s"]) & (k > at["k"]))

    label = F.when(s.isNull(), "nan").when(behind(3), "critical").when(behind(2), "high").when(behind(1), "medium").otherwise("low")
    return df.crossJoin(F.broadcast(cuts)).withColumn(out_col, label).drop("cut_1", "cut_2", "cut_3")


def priority_quartiles(
    df: DataFrame,
    score: str | Column,
    key: str = "customer_id",
    out_col: str = "retention_priority",
) -> DataFrame:
    """W1 + W2: quartile label of each row's rank by ``score`` (ties by ``key``).

    Rows with a null score get 'nan' and do not count.
    """
    return with_quartiles(df, quartile_cuts(df, score, key), score, key, out_col)


# --- W3 -------------------------------------------------------------------


def quota_top_k(
    df: DataFrame,
    group_col: str,
    quotas: dict[str, int],
    order: Sequence[Column],
    key: str | None = None,
) -> DataFrame:
    """Per group, the first ``quotas[g]`` rows in ``order``; no back-fill.

    Two levels: the best rows of each (group, salt), with the group's rows
    spread over ``QUOTA_SALTS`` salts by a hash of ``key`` (or of the row), then the best of those.  One
    final task gets at most salts x quota rows of a group, however many
    partitions the table has.
    """
    if not quotas:
        return df.limit(0)
    quota = F.create_map(*[x for g, k in quotas.items() for x in (F.lit(g), F.lit(k))])
    wanted = F.element_at(quota, F.col(group_col))
    salt = F.pmod(F.xxhash64(*([key] if key else df.columns)), F.lit(QUOTA_SALTS))
    top = F.lit(max(quotas.values()))
    parts = Window.partitionBy(group_col, "_salt").orderBy(*order)
    whole = Window.partitionBy(group_col).orderBy(*order)
    return (
        df.filter(F.col(group_col).isin(list(quotas)))
        .withColumn("_salt", salt)
        .withColumn("_rn", F.row_number().over(parts))
        .filter(F.col("_rn") <= top)
        .withColumn("_rn", F.row_number().over(whole))
        .filter((F.col("_rn") <= top) & (F.col("_rn") <= wanted))
        .drop("_rn", "_salt")
    )


# --- W6 / W7 ----------------------------------------------------------------


def seeded_hash(key: str | Column, seed: int) -> Column:
    """Deterministic pseudo-random order key: md5('<key>:<seed>')."""
    return F.md5(F.concat(col_(key).cast("string"), F.lit(f":{seed}")))


def hash_positions(
    df: DataFrame, key: str, seed: int, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Add ``_r``, each row's 1-based position in seeded hash order within its
    group, and ``_n``, the rows of the group.

    Rows are shuffled once by (group, cell of the hash).  The counts per cell
    and the positions within a cell both read that shuffle; only the counts
    (at most ``HASH_CELLS`` rows a group) are put in order across cells.
    """
    groups = list(group_cols)
    cell = F.conv(F.substring("_h", 1, 3), 16, 10).cast("int")  # 4096 values
    rows = df.withColumn("_h", seeded_hash(key, seed)).withColumn(
        "_cell", F.coalesce(cell % HASH_CELLS, F.lit(0))
    )
    dealt = rows.repartition(_partitions(df, None), *groups, "_cell")
    group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(1))
    before = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*groups, "_cell").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        *groups,
        "_cell",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"),
        F.sum("_cnt").over(group).alias("_n"),
    )
    within = Window.partitionBy(*groups, "_cell").orderBy(F.col("_h").asc(), F.col(key).asc())
    numbered = dealt.withColumn("_in_cell", F.row_number().over(within))
    return (
        _join_offsets(numbered, offsets, [*groups, "_cell"])
        .withColumn("_r", F.col("_offset") + F.col("_in_cell"))
        .drop("_h", "_cell", "_offset", "_in_cell")
    )


def exact_fraction_sample(
    df: DataFrame, key: str, fraction: float, seed: int = 42
) -> DataFrame:
    """Exactly round_half_even(fraction * n) rows, chosen by a seeded hash.

    Unlike ``df.sample`` (Bernoulli) the size is exact and the pick repeats for
    a seed on any cluster layout.
    """
    keep = F.bround(F.lit(fraction) * F.col("_n").cast("double"), 0)
    return hash_positions(df, key, seed).filter(F.col("_r") <= keep).drop("_r", "_n")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_fraction: float = 0.2,
    seed: int = 42,
    split_col: str = "split",
) -> DataFrame:
    """Per label value, the first ceil(test_fraction * n_label) rows in seeded
    hash order are 'test', the rest 'train'."""
    n_test = F.ceil(F.lit(test_fraction) * F.col("_n").cast("double"))
    return (
        hash_positions(df, key, seed, [label])
        .withColumn(split_col, F.when(F.col("_r") <= n_test, "test").otherwise("train"))
        .drop("_r", "_n")
    )
