"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

A node has a few split points; every vector goes to the subtree of its nearest
one.  For each pair of split points i and j the node stores the range of the
distances from point i to the vectors of subtree j.  A search wants vectors whose
distance from the query lies in a window; by the triangle inequality the
distances from the query to subtree j lie in a ring around each split point's
range, and a subtree goes as soon as one ring misses the window.  Leaves score
exactly, in integers.

Scores are inner products, windows are ranges of scores.  One more component
brings all vectors to the same length (and is 0 for queries), so that a
distance falls as the score rises and a score window is an annulus.

The top node's subtrees are blocks of the table, a large one dealt into several;
a block's tree is built in the task that searches it.  The top ranges decide
which blocks a query is sent to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stage

_WIDE = 2**63 - 1  # scores saturate at 64 bits
_EXACT = 2.0**53  # inner products below it are exact in doubles
_SLACK = 1e-6  # of the radius: far above what rounding moves a distance by


@dataclass
class Space:
    """Bounds of the whole table: components (``width``), the largest absolute
    component (``unit``) and the largest squared length in units (``radius2``)."""

    width: int
    unit: float
    radius2: float

    @property
    def slack(self) -> float:
        return _SLACK * np.sqrt(self.radius2)

    def whole(self, vectors: list) -> np.ndarray:
        """Rows of integers, padded to the width: doubles where every inner
        product is exact in them, else Python integers."""
        out = np.zeros((len(vectors), self.width))
        for row, v in zip(out, vectors):
            row[: len(v)] = v
        if self.radius2 * self.unit**2 < _EXACT:
            return out
        return np.array([[int(c) for c in row] for row in out], dtype=object).reshape(out.shape)

    def raised(self, whole: np.ndarray) -> np.ndarray:
        """Points of one length: in units, with the further component."""
        x = (whole / self.unit).astype(np.float64)
        rest = np.maximum(self.radius2 - (x * x).sum(axis=1), 0)
        return np.c_[x, np.sqrt(rest)]

    def level(self, whole: np.ndarray) -> np.ndarray:
        """Query points: in units, with 0 for the further component."""
        return np.c_[(whole / self.unit).astype(np.float64), np.zeros(len(whole))]

    def distance(self, points: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance of the query points to a vector with that score."""
        d2 = (points * points).sum(axis=1) + self.radius2 - 2 * (score.astype(np.float64) / self.unit / self.unit)
        return np.sqrt(np.maximum(d2, 0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d2, 0))


def far_apart(points: np.ndarray, count: int) -> np.ndarray:
    """Indices of up to ``count`` split points, each the farthest from those
    before it; fewer if the rest lie on them."""
    chosen = [0]
    near = distances(points, points[:1])[:, 0]
    while len(chosen) < min(count, len(points)):
        i = int(near.argmax())
        if near[i] <= 0:
            break
        chosen.append(i)
        near = np.minimum(near, distances(points, points[i : i + 1])[:, 0])
    return np.array(chosen)


@dataclass
class Node:
    """``rows`` of a leaf; or split ``points``, the ranges ``low`` and ``high``
    [point, subtree] of distances, and the ``subtrees``."""

    rows: np.ndarray | None = None
    points: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    subtrees: list | None = None


def grow(x: np.ndarray, rows: np.ndarray, ways: int = 8, leaf: int = 64) -> Node:
    if len(rows) <= leaf:
        return Node(rows=rows)
    drawn = rows[np.linspace(0, len(rows) - 1, min(len(rows), 16 * ways)).astype(int)]
    points = x[drawn][far_apart(x[drawn], ways)]
    d = distances(x[rows], points)
    home = d.argmin(axis=1)
    parts = [np.flatnonzero(home == j) for j in range(len(points))]
    points, parts = points[[len(p) > 0 for p in parts]], [p for p in parts if len(p)]
    if len(parts) < 2:  # equal vectors
        return Node(rows=rows)
    d = distances(x[rows], points)
    low = np.stack([d[p].min(axis=0) for p in parts], axis=1)
    high = np.stack([d[p].max(axis=0) for p in parts], axis=1)
    return Node(points=points, low=low, high=high, subtrees=[grow(x, rows[p], ways, leaf) for p in parts])


def reached(d: np.ndarray, low: np.ndarray, high: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """[query, subtree]: do all rings around the ranges meet the annulus from
    ``inner`` to ``outer`` of the query?  ``d`` holds its distances to the points."""
    near = np.maximum(d[:, :, None] - high[None], low[None] - d[:, :, None]).max(axis=1)
    far = (d[:, :, None] + high[None]).min(axis=1)
    return (near <= outer[:, None]) & (far >= inner[:, None])


class Search:
    """The best ``k`` rows of a block for each query of a batch: scores from
    ``floor`` to ``ceiling``, label alike or not, ties to the smaller id."""

    def __init__(self, space: Space, block: pd.DataFrame, ways: int = 8, leaf: int = 64):
        self.space = space
        self.ids, self.rids = block["vec_id"].to_numpy(), block["rid"].to_numpy()
        self.labels, self.dims = block["label"].to_numpy(), np.array([len(v) for v in block["v"]])
        self.whole = space.whole(block["v"].tolist())
        self.tree = grow(space.raised(self.whole), np.arange(len(block)), ways, leaf)
        self.scored = 0

    def best(self, queries: pd.DataFrame, k: int, alike: bool) -> pd.DataFrame:
        self.k, self.alike = k, alike
        self.q_rid, self.q_label = queries["self"].to_numpy(), queries["label"].to_numpy()
        self.q_dim = np.array([len(v) for v in queries["v"]])
        self.q_whole = self.space.whole(queries["v"].tolist())
        self.q_point = self.space.level(self.q_whole)
        self.floor = queries["floor"].to_numpy().copy()
        self.ceiling = queries["ceiling"].to_numpy()
        self.inner = self.space.distance(self.q_point, self.ceiling) - self.space.slack
        self.outer = self.space.distance(self.q_point, self.floor) + self.space.slack
        # the hits kept so far: query, score, row
        self.hits = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._visit(self.tree, np.arange(len(queries)))
        q, s, r = self.hits
        return pd.DataFrame({"qid": queries["qid"].to_numpy()[q], "rid": self.rids[r], "vec_id": self.ids[r], "score": s})

    def _visit(self, node: Node, live: np.ndarray) -> None:
        if not len(live):
            return
        if node.rows is not None:
            self._score(node.rows, live)
            return
        d = distances(self.q_point[live], node.points)
        home = d.argmin(axis=1)
        # first each query's own subtree, which draws its window in
        for own in (True, False):
            for j, subtree in enumerate(node.subtrees):
                turn = (home == j) == own
                meets = reached(d[turn], node.low[:, j : j + 1], node.high[:, j : j + 1], self.inner[live[turn]], self.outer[live[turn]])
                self._visit(subtree, live[turn][meets[:, 0]])

    def _score(self, rows: np.ndarray, live: np.ndarray) -> None:
        self.scored += len(rows) * len(live)
        exact = self.q_whole[live] @ self.whole[rows].T
        if exact.dtype == object:
            exact = np.clip(exact, -_WIDE, _WIDE)
        s = exact.astype(np.int64)
        ok = (self.labels[rows][None] == self.q_label[live][:, None]) == self.alike
        ok &= self.dims[rows][None] == self.q_dim[live][:, None]
        ok &= self.rids[rows][None] != self.q_rid[live][:, None]
        ok &= (s >= self.floor[live][:, None]) & (s <= self.ceiling[live][:, None])
        q, r = np.nonzero(ok)
        if not len(q):
            return
        q, s, r = live[q], s[q, r], rows[r]
        touched = np.zeros(len(self.floor), dtype=bool)
        touched[q] = True
        old = touched[self.hits[0]]
        q, s, r = (np.r_[h[old], new] for h, new in zip(self.hits, (q, s, r)))
        order = np.lexsort((self.rids[r], self.ids[r], -s, q))
        q, s, r = q[order], s[order], r[order]
        start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        place = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
        full = place == self.k - 1
        self.floor[q[full]] = s[full]
        at = q[full]
        self.outer[at] = self.space.distance(self.q_point[at], self.floor[at]) + self.space.slack
        kept = place < self.k
        self.hits = tuple(np.r_[h[~old], new[kept]] for h, new in zip(self.hits, (q, s, r)))


_QUERY = "qid long, self long, label long, floor long, ceiling long, v array<double>"
_HIT = "qid long, rid long, vec_id long, score long"


def _searched(space: Space, k: int, alike: bool, ways: int, leaf: int):
    """Rows sorted by (cell, role): the vectors of a block, then its queries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held, search = None, [], None
        for batch in batches:
            if not len(batch):
                continue
            key = batch["cell"].to_numpy()
            role = batch["role"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (role[1:] != role[:-1])])
            for start, end in zip(cuts, np.r_[cuts[1:], len(batch)]):
                if key[start] != cell:
                    cell, held, search = key[start], [], None
                part = batch.iloc[start:end]
                if role[start] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if search is None:
                    search = Search(space, pd.concat(held), ways, leaf)
                for at in range(0, len(part), 1024):
                    yield search.best(part.iloc[at : at + 1024], k, alike)

    return run


class Tree:
    """The table as blocks below one top node.

    ``rows`` has rid (unique), vec_id, label and v.  The split points come from a
    sample of ``drawn`` rows in hash order, which also gives every query a first
    floor for its scores; both are bounded by these parameters, whatever the
    size of the table, and decide only how much is searched.
    """

    def __init__(self, rows: DataFrame, tops: int = 32, drawn: int = 2048, block: int = 8192, ways: int = 8, leaf: int = 64):
        self.spark = rows.sparkSession
        self.ways, self.leaf = ways, leaf
        norm2 = F.aggregate("v", F.lit(0.0), lambda t, c: t + (c / F.col("unit")) * (c / F.col("unit")))
        unit = F.greatest(F.array_max(F.transform("v", F.abs)), F.lit(0.0))
        width, unit = rows.agg(F.max(F.size("v")), F.max(unit)).first()
        unit = max(float(unit or 0), 1.0)
        radius2 = rows.withColumn("unit", F.lit(unit)).agg(F.max(norm2)).first()[0]
        self.space = space = Space(int(width or 0), unit, float(radius2 or 0) * (1 + 1e-9))
        sample = rows.orderBy(F.xxhash64("rid"), "rid").limit(drawn).toPandas()
        points = space.raised(space.whole(sample["v"].tolist()))
        points = points[far_apart(points, tops)] if len(points) else points
        self.sample = self.spark.sparkContext.broadcast(sample)

        def homes(batches):
            for b in batches:
                d = distances(space.raised(space.whole(b["v"].tolist())), points)
                yield b.assign(top=d.argmin(axis=1))

        self.rows = stage(rows.mapInPandas(homes, f"{rows.schema.simpleString()[7:-1]}, top int"), "gnat")

        def ranges(batches):
            for b in batches:
                d = distances(space.raised(space.whole(b["v"].tolist())), points)
                for j, part in pd.DataFrame(d).groupby(b["top"].to_numpy()):
                    yield pd.DataFrame(
                        {"point": np.arange(len(points)), "top": j, "low": part.min(axis=0), "high": part.max(axis=0), "n": len(part)}
                    )

        # a row for each pair of split points: at most ``tops`` squared
        met = (
            self.rows.mapInPandas(ranges, "point int, top int, low double, high double, n long")
            .groupBy("point", "top")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
            .toPandas()
        )
        m = len(points)
        low, high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        low[met["point"], met["top"]], high[met["point"], met["top"]] = met["low"], met["high"]
        sizes = met.groupby("top")["n"].first().reindex(range(m), fill_value=0).to_numpy()
        self.points, self.low, self.high = points, low, high
        self.blocks = np.ceil(sizes / block).astype(np.int64)  # of each subtree; 0 for none
        self.starts = np.r_[0, np.cumsum(self.blocks)]

    def search(self, queries: DataFrame, k: int, alike: bool, together: int = 16384) -> DataFrame:
        """Up to ``k`` rows of each block that a query of ``queries`` (qid, self,
        label, floor, ceiling, v) reaches; the best of a query are among them.

        Queries go in groups of about ``together``; a block meets each group in
        one cell, so a task's memory and work are bounded."""
        space, points, low, high = self.space, self.points, self.low, self.high
        blocks, starts, sample = self.blocks, self.starts, self.sample
        total = int(starts[-1])
        groups = max(1, -(-queries.count() // together))

        def routed(batches):
            first = Search(space, sample.value, leaf=max(1, len(sample.value)))  # one leaf
            for batch in batches:
                for at in range(0, len(batch), 1024):
                    part = batch.iloc[at : at + 1024].reset_index(drop=True)
                    first.best(part, k, alike)
                    d = distances(first.q_point, points)
                    meets = reached(d, low, high, first.inner, first.outer)
                    q, top = np.nonzero(meets & (blocks > 0)[None])
                    each = blocks[top]
                    q, offset = np.repeat(q, each), np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                    out = part.iloc[q].assign(floor=first.floor[q], block=np.repeat(starts[top], each) + offset)
                    yield out

        if not total:
            return self.spark.createDataFrame([], _HIT)
        of_rows = self.rows.select("rid", "vec_id", "label", "v", "top")
        first, many = (F.array(*(F.lit(int(x)) for x in xs))[F.col("top")] for xs in (starts[:-1], np.maximum(blocks, 1)))
        group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        data = of_rows.withColumn("g", group).select(
            (F.col("g") * total + first + F.pmod(F.xxhash64("rid"), many)).cast("long").alias("cell"),
            F.lit(0).alias("role"), "rid", "vec_id", "label", "v",
            *(F.lit(0).cast("long").alias(c) for c in ("qid", "self", "floor", "ceiling")),
        )
        asked = queries.select("qid", "self", "label", "floor", "ceiling", "v").mapInPandas(routed, f"{_QUERY}, block long")
        asked = asked.select(
            (F.pmod(F.xxhash64("qid"), F.lit(groups)) * total + F.col("block")).cast("long").alias("cell"),
            F.lit(1).alias("role"), F.col("self").alias("rid"), F.lit(0).cast("long").alias("vec_id"), "label", "v",
            "qid", "self", "floor", "ceiling",
        )
        return (
            data.union(asked)
            .repartition("cell")
            .sortWithinPartitions("cell", "role", "rid")
            .mapInPandas(_searched(space, k, alike, self.ways, self.leaf), _HIT)
        )


def _valid(vectors: DataFrame, anchors: Column) -> DataFrame:
    """Rows that take part, their components as integers (in doubles, which hold
    them exactly), with an id of their own."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 256.0)
    whole = F.transform("scaled", lambda x: F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x))
    finite = F.forall("scaled", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        "vec_id", F.col("label").cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("wanted"), scaled.alias("scaled")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("scaled").isNotNull() & finite)
    return stage(
        rows.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), "label", "wanted", whole.alias("v")),
        "gnat",
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _percent(score: Column, percent: int, up: bool) -> Column:
    """``percent`` of a score, rounded down or up to an integer; exact."""
    wide = score.cast("decimal(38,0)") * F.lit(-percent if up else percent)
    hundred = F.lit(100).cast("decimal(38,0)")
    down = ((wide - F.pmod(wide, hundred)) / hundred).cast("long")
    return -down if up else down


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    **tree: int,
) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` marks.

    ``vectors`` has vec_id, label (an integer) and embedding; a component x
    counts as floor(256 * x).  An anchor's positives are its ``positives`` best
    other rows of the same label by inner product; for each, its negatives are
    the ``negatives`` best rows of other labels whose score is from ``low`` to
    ``high`` per cent (1 to 100) of the positive's.  Higher scores come first,
    ties by smaller vec_id.  Returns anchor_id, positive_id, ``rank`` (from 1),
    negative_id, positive_score and negative_score.

    Rows with a null vec_id, label or vector or with null or non-finite
    components take no part.  Only vectors of one length compare; empty ones have
    the score 0.  Rows of a repeated vec_id stand for themselves, so its rows may
    be each other's positives.  Scores saturate at 64 bits.  A positive without
    negatives (all, if its score is below 0) gives no rows, nor does an empty
    table.  Further columns are ignored.  ``tree`` has parameters of
    :class:`Tree`; they decide how much is searched, never the result.
    """
    if not 0 < low <= high <= 100:
        raise ValueError("low and high are per cent: 0 < low <= high <= 100")
    prepare(vectors.sparkSession)
    rows = _valid(vectors, anchors)
    index = Tree(rows.drop("wanted"), **tree)
    wanted = rows.where("wanted")
    every = wanted.select(
        F.col("rid").alias("qid"), F.col("rid").alias("self"), "label",
        F.lit(-_WIDE).alias("floor"), F.lit(_WIDE).alias("ceiling"), "v",
    )
    near = _best(index.search(every, positives, alike=True), positives)
    near = stage(
        near.select(
            F.monotonically_increasing_id().alias("qid"), F.col("qid").alias("self"),
            F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        ),
        "gnat",
    )
    score = F.col("positive_score")
    windows = near.join(wanted.select(F.col("rid").alias("self"), "label", "v"), "self").select(
        "qid", "self", "label", _percent(score, low, up=True).alias("floor"), _percent(score, high, up=False).alias("ceiling"), "v"
    )
    hard = _best(index.search(windows, negatives, alike=False), negatives)
    named = near.join(wanted.select(F.col("rid").alias("self"), F.col("vec_id").alias("anchor_id")), "self")
    return hard.select("qid", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        named, "qid"
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
