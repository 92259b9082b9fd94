"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

# Fixed value: a word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> str:
    """Ship the package to the Python workers; return the shared folder."""
    ship_package(spark)
    return ensure_checkpoint_dir(spark).rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` by a Parquet table in the shared folder.

    Unlike a cached frame it survives lost executors, and unlike an RDD
    checkpoint later readers prune its columns.  The files go when the
    application ends.
    """
    spark = df.sparkSession
    path = f"{prepare(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a whole text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(
    df: DataFrame, group: str, cell: Column, order: list[Column], out: str, cells: int
) -> DataFrame:
    """Number the rows of every group from 0 without a gap, in the order
    (``cell``, ``order``), where ``cell`` is an int from 0 to ``cells`` - 1.

    A window per group would put a group in one task.  Here each (group, cell)
    is counted with map-side sums, the counts become offsets (at most ``cells``
    rows a group pass through that window), and rows are numbered within their
    (group, cell) only.
    """
    rows = df.withColumn("_cell", cell)
    before = Window.partitionBy("_g").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(F.col(group).alias("_g"), F.col("_cell").alias("_c"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_g", "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(group, "_cell").orderBy(*order)
    return (
        rows.withColumn("_row", F.row_number().over(within))
        .join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_cell") == F.col("_c")))
        .withColumn(out, (F.col("_offset") + F.col("_row") - 1).cast("long"))
        .drop("_cell", "_g", "_c", "_offset", "_row")
    )


def parts(count: Column, size: int) -> Column:
    """Number of parts of about ``size`` that ``count`` rows make."""
    return F.greatest(F.ceil(count / F.lit(size)), F.lit(1)).cast("long")


def in_cells(rows: DataFrame, m: str, key: str, row_id: str, size: int) -> DataFrame:
    """Deal the rows of each ``key`` into cells, so that any two of them meet in
    one cell and no cell holds more than about twice ``size`` rows.

    A key's ``m`` rows are cut into chunks by a hash; the cells are the pairs
    (i, j) of chunks.  Adds ``chunk``, ``i`` and ``j``; sorted by cell.
    """
    chunks = parts(F.col(m), size)
    return (
        rows.withColumn("chunk", F.pmod(F.xxhash64(row_id), chunks))
        .withColumn("_x", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        .withColumn("i", F.least("chunk", "_x"))
        .withColumn("j", F.greatest("chunk", "_x"))
        .drop("_x", m)
        .repartition(key, "i", "j")
        .sortWithinPartitions(key, "i", "j", row_id)
    )


def each_cell(
    batches: Iterator[pd.DataFrame], columns: list[str], work: Callable[[pd.DataFrame], pd.DataFrame | None]
) -> Iterator[pd.DataFrame]:
    """Apply ``work`` to every run of equal ``columns`` (integers) in sorted
    batches; a run may go on in the next batch.  Runs of one row are skipped."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        key = rows[columns].to_numpy()
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        found = [work(rows.iloc[s:e]) for s, e in zip(starts[:-1], starts[1:]) if e - s > 1]
        found = [f for f in found if f is not None]
        held = rows.iloc[starts[-1] :]
        if found:
            yield pd.concat(found, ignore_index=True)
    if held is not None and len(held) > 1:
        last = work(held)
        if last is not None:
            yield last
