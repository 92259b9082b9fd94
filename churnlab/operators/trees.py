"""Tree ensembles grown from binned rows (M4, M5).

The same ensembles as Spark's ``GBTClassifier`` and ``RandomForestClassifier``
(losses, leaf values, draws of rows and of inputs per node), grown otherwise:
Spark runs a job for every level of a boosted tree and sends the statistics of
all open nodes of a forest through a shuffle, which costs far more than the
arithmetic.

* Split points come from all rows (:func:`split_points`): every distinct value
  of an input where there are few, else its quantiles.
* Rows become blocks of bin numbers, one byte an input (:class:`Binned`),
  that stay on the executors.  A block is sorted by content, so draws do not
  depend on the order in which a shuffle delivers rows.
* Boosted trees (:func:`boost`) need sums per (node, input, bin) of the rows,
  level by level.  One block is boosted inside its task; several send one sum
  each per level, and no row.
* A forest's trees are independent: a task grows a run of trees from all rows,
  which go from executor to executor.  Above ``FOREST_ROWS`` rows, too many for
  a task, Spark's own distributed forest is fitted.

The driver holds the finished trees only.
"""

from __future__ import annotations

import pickle
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
# Error of the quantiles' ranks: one in so many rows.
RANKS = 10_000
# Rows from which one task can grow whole trees (one byte an input and row).
FOREST_ROWS = 1 << 20
# Blocks whose sums go to the driver as they are; those of more are added up on the executors.
DIRECT_BLOCKS = 64
# Counts of class 1 in sums that hold both classes.
CLASS_1 = float(1 << 26)


# --- binned rows -----------------------------------------------------------


def _arrays(rows: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return rows.select(vector_to_array(F.col("features")).alias("x"), "label", "class_weight")


def _matrix(column, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def split_points(rows: DataFrame) -> list[np.ndarray]:
    """Thresholds of every slot of ``features``, over all rows: midpoints between
    its values where there are at most ``BINS``, else its quantiles.  A missing
    value (NaN) is above every threshold."""

    def values(batches):
        import pyarrow as pa

        seen: list = []
        for batch in batches:
            x = _matrix(batch.column("x"), batch.num_rows)
            seen = seen or [np.empty(0) for _ in range(x.shape[1])]
            for i, known in enumerate(seen):
                if len(known) <= BINS:
                    found = np.unique(np.concatenate([known, x[:, i]]))
                    seen[i] = found[~np.isnan(found)][: BINS + 1]
        slots = pa.array(range(len(seen)), pa.int32())
        yield pa.RecordBatch.from_arrays([slots, pa.array([list(v) for v in seen], pa.list_(pa.float64()))], ["slot", "v"])

    arrays = _arrays(rows)
    few = arrays.mapInArrow(values, "slot int, v array<double>").groupBy("slot")
    few = few.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("v")))).alias("v"))
    known = {r["slot"]: np.array(r["v"]) for r in few.select("slot", F.slice("v", 1, BINS + 1).alias("v")).collect()}
    many = [i for i, v in known.items() if len(v) > BINS]
    shares = [k / BINS for k in range(1, BINS)]
    quantiles = {}
    if many:
        slot = lambda i: F.when(~F.isnan(F.col("x")[i]), F.col("x")[i])
        ends = [F.percentile_approx(slot(i), shares, RANKS).alias(f"q{i}") for i in many]
        tops = [F.max(slot(i)).alias(f"m{i}") for i in many]
        row = arrays.agg(*ends, *tops).first()
        quantiles = {i: np.unique([q for q in row[f"q{i}"] if q < row[f"m{i}"]]) for i in many}
    return [
        quantiles[i] if i in quantiles else (known[i][1:] / 2 + known[i][:-1] / 2)
        for i in range(1 + max(known, default=-1))
    ]


def bin_numbers(x: np.ndarray, points: list[np.ndarray]) -> np.ndarray:
    """The thresholds below each value (``x <= points[b]`` is ``bin <= b``)."""
    out = np.empty(x.shape, dtype=np.uint8)
    for i, at in enumerate(points):
        out[:, i] = np.where(np.isnan(x[:, i]), len(at), np.searchsorted(at, x[:, i], side="left"))
    return out


class Binned:
    """Split points and blocks of bin numbers of the rows of a fit."""

    def __init__(self, rows: DataFrame):
        self.points = split_points(rows)
        points = self.points

        def blocks(batches):
            parts, labels, weights = [], [], []
            for batch in batches:
                parts.append(bin_numbers(_matrix(batch.column("x"), batch.num_rows), points))
                labels.append(batch.column("label").to_numpy(zero_copy_only=False))
                weights.append(batch.column("class_weight").to_numpy(zero_copy_only=False))
            if not parts:
                return
            if any(np.isnan(a).any() for a in (*labels, *weights)):
                raise ValueError("Labels MUST NOT be Null or NaN")
            block = TaskContext.get().partitionId()
            yield _block(block, np.concatenate(parts), np.concatenate(labels), np.concatenate(weights))

        schema = "block int, n long, bins binary, label binary, weight binary"
        self.blocks = _arrays(rows).mapInArrow(blocks, schema).persist()
        sizes = self.blocks.select("n").collect()
        self.n_blocks, self.n_rows = len(sizes), sum(r["n"] for r in sizes)

    def unpersist(self) -> None:
        self.blocks.unpersist()


def _block(number: int, bins: np.ndarray, label: np.ndarray, weight: np.ndarray):
    """A block as one Arrow row, its rows in the order of their content."""
    import pyarrow as pa

    whole = np.column_stack([label.astype(np.uint8), bins])
    order = np.argsort(np.ascontiguousarray(whole).view(f"V{whole.shape[1]}").ravel(), kind="stable")
    fields = [bins[order].tobytes(), label[order].astype(float).tobytes(), weight[order].astype(float).tobytes()]
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([len(order)], pa.int64()), *(pa.array([f], pa.binary()) for f in fields)],
        ["block", "n", "bins", "label", "weight"],
    )


def _opened(n: int, *fields: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins, label, weight = (np.frombuffer(f, dtype=t) for f, t in zip(fields, (np.uint8, float, float)))
    return bins.reshape(n, -1), label, weight


def _joined(batches):
    """All blocks of a task as one (bins, label, weight), by block number."""
    found = []
    for batch in batches:
        for r in batch.to_pylist():
            found.append((r["block"], _opened(r["n"], r["bins"], r["label"], r["weight"])))
    parts = [p for _, p in sorted(found, key=lambda f: f[0])]
    return tuple(np.concatenate(a) for a in zip(*parts)) if len(parts) > 1 else (parts[0] if parts else None)


# --- trees -----------------------------------------------------------------


class Tree:
    """A tree while it grows; node ids are positions, children stand together."""

    def __init__(self):
        self.left, self.feature, self.bin, self.value, self.cover = [-1], [-1], [0], [0.0], [0.0]

    def split(self, node: int, feature: int, at: int) -> int:
        first = len(self.left)
        self.left[node], self.feature[node], self.bin[node] = first, feature, at
        for name, empty in (("left", -1), ("feature", -1), ("bin", 0), ("value", 0.0), ("cover", 0.0)):
            getattr(self, name).extend([empty, empty])
        return first

    def arrays(self) -> tuple:
        return (
            np.array(self.left, dtype=np.int32), np.array(self.feature, dtype=np.int16),
            np.array(self.bin, dtype=np.uint8), np.array(self.value), np.array(self.cover),
        )


def packed(tree: tuple) -> bytes:
    """A finished tree as it is kept and shipped: a forest has millions of nodes."""
    return zlib.compress(pickle.dumps(tree), 1)


def unpacked(tree: bytes) -> tuple:
    return pickle.loads(zlib.decompress(tree))


def _descend(left, feature, at, values: np.ndarray, steps: int | None = None) -> np.ndarray:
    """The node each row of ``values`` (bin numbers or inputs) comes to; a missing input goes right."""
    flat, width = values.ravel(), values.shape[1]
    node = np.zeros(len(values), dtype=np.int64)
    rows = np.arange(len(values)) if left[0] >= 0 else np.empty(0, dtype=np.int64)
    while len(rows) and steps != 0:
        here = node[rows]
        goes_left = flat[rows * width + feature[here]] <= at[here]
        here = left[here] + np.where(goes_left, 0, 1)
        node[rows] = here
        rows = rows[left[here] >= 0]
        steps = None if steps is None else steps - 1
    return node


# --- boosting --------------------------------------------------------------


class Boosting:
    """Rows of a block while they are boosted."""

    def __init__(self, number: int, bins, label, margin=None, done: int = 0):
        self.number, self.bins, self.by_slot = number, bins, np.ascontiguousarray(bins.T)
        self.y = 2.0 * label - 1.0
        self.margin = np.zeros(len(label)) if margin is None else margin
        self.done, self.round = done, -1

    def reach(self, trees: list[tuple], rates: list[float]) -> None:
        for (left, feature, at, value, _), rate in zip(trees[self.done :], rates[self.done :]):
            self.margin = self.margin + rate * value[_descend(left, feature, at, self.bins)]
        self.done = len(trees)

    def sums(self, trees, rates, tree: tuple, nodes: list[int], share: float, seed: int) -> np.ndarray:
        """Rows and residuals per (node, input, bin): the next tree is ``tree`` so far."""
        if self.round != len(trees):
            self.reach(trees, rates)
            self.round = len(trees)
            # the first tree meets the labels, later ones the negative gradient of the log loss
            residual = self.y if not trees else 4 * self.y / (1 + np.exp(np.clip(2 * self.y * self.margin, -700, 700)))
            drawn = np.random.default_rng([seed, self.round, self.number]).random(len(self.y)) < share
            self.drawn, self.residual = drawn.astype(float), residual * drawn
        left, feature, at, _, _ = tree
        out = np.zeros((len(nodes), len(self.by_slot), BINS, 2))
        if left[0] < 0:
            by_slot, place, drawn, residual = self.by_slot, np.zeros(len(self.y), dtype=np.int64), self.drawn, self.residual
        else:
            where = np.full(len(left), -1)
            where[nodes] = np.arange(len(nodes))
            place = where[_descend(left, feature, at, self.bins)]
            rows = np.flatnonzero(place >= 0)
            by_slot, place = self.by_slot[:, rows], place[rows]
            drawn, residual = self.drawn[rows], self.residual[rows]
        place = place * BINS
        for i, column in enumerate(by_slot):
            key = place + column
            for k, amount in enumerate((drawn, residual)):
                out[:, i, :, k] = np.bincount(key, amount, minlength=len(nodes) * BINS).reshape(-1, BINS)
        return out


def boost(sums, slots: int, settings: dict) -> tuple[list[tuple], list[float]]:
    """Boosted regression trees; ``sums(trees, rates, tree, nodes)`` adds up the rows.

    As Spark's: the first tree meets the labels (-1, 1) at rate 1, a leaf holds the
    mean of its residuals, and a node chooses among a share of the inputs."""
    trees, rates = [], []
    chosen = int(np.ceil(settings["inputs"] * slots))
    for number in range(settings["rounds"]):
        draw = np.random.default_rng([settings["seed"], number])
        tree = Tree()
        level = {0: sums(trees, rates, tree.arrays(), [0])[0]}
        tree.cover[0], total = level[0][0].sum(axis=0) if slots else (0.0, 0.0)
        tree.value[0] = total / tree.cover[0] if tree.cover[0] else 0.0
        for depth in range(settings["depth"]):
            pairs = []  # smaller child, larger child, what the parent has
            for node, found in level.items():
                split = _best_regression_split(found, draw.permutation(slots)[:chosen])
                if split is None:
                    continue
                feature, at, sides = split
                first = tree.split(node, feature, at)
                for child, (count, amount) in zip((first, first + 1), sides):
                    tree.cover[child], tree.value[child] = count, amount / count
                small = first + (sides[1][0] < sides[0][0])
                pairs.append((small, 2 * first + 1 - small, found))
            if not pairs or depth + 1 == settings["depth"]:
                break
            part = sums(trees, rates, tree.arrays(), [small for small, _, _ in pairs])
            level = {}
            for (small, large, found), own in zip(pairs, part):
                level[small], level[large] = own, found - own
        trees.append(tree.arrays())
        rates.append(settings["rate"] if number else 1.0)
    return trees, rates


def _best_regression_split(found: np.ndarray, inputs: np.ndarray):
    """(input, bin, ((rows, residuals) left, right)) of the largest fall in variance, or None."""
    total = found[0].sum(axis=0) if len(found) else np.zeros(2)
    below = found[np.sort(inputs)].cumsum(axis=1)[:, :-1]
    count, amount = below[..., 0], below[..., 1]
    more, rest = total[0] - count, total[1] - amount
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = amount**2 / count + rest**2 / more - total[1] ** 2 / total[0]
    gain[(count < 0.5) | (more < 0.5)] = -np.inf
    if not gain.size:
        return None
    i, at = np.unravel_index(np.argmax(gain), gain.shape)
    if not gain[i, at] > 1e-9 * total[0]:
        return None
    sides = ((count[i, at], amount[i, at]), (more[i, at], rest[i, at]))
    return int(np.sort(inputs)[i]), int(at), sides


# Margins of the blocks that a worker has boosted last: kept between the jobs of
# a fit.  A worker that has none (another one did the block, or it was lost)
# makes them from the trees.
_MARGINS: dict = {}


def _sums_of_blocks(blocks, fit: str, trees, rates, tree, nodes, share, seed):
    for number, n, *fields in blocks:
        bins, label, _ = _opened(n, *fields)
        if any(key[0] != fit for key in _MARGINS):
            _MARGINS.clear()
        margin, done = _MARGINS.get((fit, number), (None, 0))
        rows = Boosting(number, bins, label, margin, done)
        out = rows.sums(trees, rates, tree, nodes, share, seed)
        _MARGINS[fit, number] = rows.margin, rows.done
        yield number, out


def boosted_trees(binned: Binned, settings: dict) -> tuple[list[tuple], list[float]]:
    slots = len(binned.points)
    share, seed = settings["rows"], settings["seed"]
    if binned.n_blocks <= 1:

        def whole(batches):
            import pyarrow as pa

            data = _joined(batches)
            if data is not None:
                rows = Boosting(0, data[0], data[1])
                found = boost(lambda *now: rows.sums(*now, share, seed), slots, settings)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], ["found"])

        found = binned.blocks.mapInArrow(whole, "found binary").collect()
        return pickle.loads(found[0]["found"]) if found else ([], [])

    fit = uuid.uuid4().hex
    blocks = binned.blocks.rdd.map(tuple).persist()

    def sums(trees, rates, tree, nodes):
        part = blocks.mapPartitions(lambda b: _sums_of_blocks(b, fit, trees, rates, tree, nodes, share, seed))
        if binned.n_blocks > DIRECT_BLOCKS:
            return part.values().treeReduce(np.add)
        return sum(found for _, found in sorted(part.collect(), key=lambda f: f[0]))

    try:
        return boost(sums, slots, settings)
    finally:
        blocks.unpersist()


# --- forests ---------------------------------------------------------------


def grow(bins, label, weights: tuple[float, float], settings: dict, number: int) -> tuple:
    """Tree ``number`` of a forest, level by level: rows drawn with replacement,
    Gini impurity of the classes by their ``weights``, the inputs of a node drawn anew."""
    draw = np.random.default_rng([settings["seed"], number])
    slots = bins.shape[1]
    times = draw.poisson(1.0, len(label))
    rows = np.flatnonzero(times)
    flat = bins.ravel()
    amount = times[rows] * np.where(label[rows] > 0.5, CLASS_1, 1.0)
    place = np.zeros(len(rows), dtype=np.int64)  # of each row, among the open nodes
    chosen = settings["inputs"](slots)
    parts = []  # (left, feature, bin, value, cover) of each level
    counts = np.array([_classes(amount.sum())])  # nodes of this level: rows of class 0 and 1
    least, first = settings["least"], 0
    for depth in range(settings["depth"] + 1):
        n = len(counts)
        weighted = counts * weights
        cover = weighted.sum(axis=1)
        value = np.divide(weighted[:, 1], cover, out=np.zeros(n), where=cover > 0)
        left, feature, at = np.full(n, -1, np.int32), np.full(n, -1, np.int16), np.zeros(n, np.uint8)
        parts.append((left, feature, at, value, cover))
        can = (counts.sum(axis=1) >= 2 * least) & (counts > 0).all(axis=1) & (depth < settings["depth"])
        if not can.any():
            break
        # ``place`` counts the nodes of this level: close those that cannot be split
        to = np.cumsum(can) - 1
        keep = can[place]
        rows, amount, place = rows[keep], amount[keep], to[place[keep]]
        ids = np.flatnonzero(can)
        inputs = np.argpartition(draw.random((len(ids), slots)), chosen - 1, axis=1)[:, :chosen]
        split, at_bin, sides = _best_gini_splits(flat, slots, rows, amount, place, inputs, weights, least)
        good = split >= 0
        if not good.any():
            break
        split_at = inputs[np.arange(len(ids)), np.maximum(split, 0)]
        order = np.cumsum(good) - 1
        first += n
        left[ids[good]] = first + 2 * order[good]
        feature[ids[good]], at[ids[good]] = split_at[good], at_bin[good]
        counts = sides[good].reshape(-1, 2)
        keep = good[place]
        rows, amount, place = rows[keep], amount[keep], place[keep]
        goes_right = flat[rows * slots + split_at[place]] > at_bin[place]
        place = 2 * order[place] + goes_right
    return tuple(np.concatenate(a) for a in zip(*parts))


def _classes(packed) -> tuple:
    one = np.floor(packed / CLASS_1)
    return packed - one * CLASS_1, one


# Numbers in one array while the nodes of a level are searched (32 MB).
CELLS = 1 << 22


def _best_gini_splits(flat, slots, rows, amount, place, inputs, weights, least):
    """Per open node: the drawn input (-1: none), the bin and the (left, right) x (class 0, 1) rows.

    Rows stand in runs of nodes, so that the arrays of a pass stay below ``CELLS`` numbers."""
    nodes, chosen = inputs.shape
    split, at_bin, sides = np.full(nodes, -1), np.zeros(nodes, dtype=np.int64), np.zeros((nodes, 2, 2))
    run = max(1, CELLS // (chosen * BINS))
    for begin in range(0, nodes, run):
        some = inputs[begin : begin + run]
        mine = slice(None) if nodes <= run else np.flatnonzero((place >= begin) & (place < begin + run))
        r, a, p = rows[mine], amount[mine], place[mine] - begin
        packed = np.zeros(len(some) * chosen * BINS)
        step = max(1, CELLS // chosen)
        for x in range(0, len(r), step):
            rr, aa, pp = r[x : x + step], a[x : x + step], p[x : x + step]
            key = (pp[:, None] * chosen + np.arange(chosen)) * BINS + flat[rr[:, None] * slots + some[pp]]
            packed += np.bincount(key.ravel(), np.repeat(aa, chosen), minlength=len(packed))
        below = packed.reshape(len(some), chosen, BINS).cumsum(axis=2)
        total = below[:, :1, -1:]
        low, high = _classes(below[:, :, :-1]), _classes(total - below[:, :, :-1])
        gain = 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            for zero, one in (low, high):
                zero, one = zero * weights[0], one * weights[1]
                gain = gain + (zero * zero + one * one) / (zero + one)
            zero, one = (c * w for c, w in zip(_classes(total), weights))
            gain = gain - (zero * zero + one * one) / (zero + one)
        small = np.minimum(low[0] + low[1], high[0] + high[1]) < least
        gain[small] = -np.inf
        gain = gain.reshape(len(some), -1)
        best = np.argmax(gain, axis=1)
        at = np.arange(len(some))
        good = gain[at, best] > 1e-9 * (zero + one).ravel()
        split[begin : begin + run] = np.where(good, best // (BINS - 1), -1)
        at_bin[begin : begin + run] = best % (BINS - 1)
        for side, classes in enumerate((low, high)):
            for k, c in enumerate(classes):
                sides[begin : begin + run, side, k] = c.reshape(len(some), -1)[at, best]
    return split, at_bin, sides


def forest_trees(binned: Binned, settings: dict) -> list[bytes]:
    """All trees of a forest (:func:`packed`), each grown from all rows by one task."""
    spark = binned.blocks.sparkSession
    trees = settings["trees"]
    runs = max(1, min(trees, 4 * spark.sparkContext.defaultParallelism))

    def together(batches):
        data = _joined(batches)
        if data is not None:
            yield _block(0, *data)

    schema = binned.blocks.schema
    # a run of trees with all rows, taken from the executor that has them: neither shuffled nor on the driver
    numbers = spark.range(0, runs, 1, runs).select(F.col("id").cast("int").alias("run"))
    rows = binned.blocks.coalesce(1).mapInArrow(together, schema).persist()
    pairs = numbers.hint("shuffle_replicate_nl").crossJoin(rows)

    def grown(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                bins, label, weight = _opened(r["n"], r["bins"], r["label"], r["weight"])
                one = label > 0.5
                weights = tuple(float(weight[c].max()) if c.any() else 1.0 for c in (~one, one))
                for number in range(r["run"], trees, runs):
                    found = packed(grow(bins, label, weights, settings, number))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int32()), pa.array([found], pa.binary())], ["tree", "found"]
                    )

    found = pairs.mapInArrow(grown, "tree int, found binary").collect()
    rows.unpersist()
    return [bytes(r["found"]) for r in sorted(found, key=lambda r: r["tree"])]


# --- estimators and models -------------------------------------------------


class GrownTrees(Model, MLWritable, MLReadable):
    """Trees (:func:`packed`) that add ``rawPrediction``, ``probability`` and ``prediction``."""

    kind = ""

    def __init__(self, trees: list[bytes] | None = None, weights: list[float] | None = None, points=None):
        super().__init__()
        self.trees, self.treeWeights, self.points = trees or [], weights or [], points or []

    @property
    def totalNumNodes(self) -> int:
        return sum(len(unpacked(t)[0]) for t in self.trees)

    def with_thresholds(self) -> list[tuple]:
        """(left, input, threshold, value, cover) of each tree."""
        table = np.full((max(1, len(self.points)), BINS), np.inf)
        for i, at in enumerate(self.points):
            table[i, : len(at)] = at
        return [(left, feature, table[feature, at], value, cover) for left, feature, at, value, cover in map(unpacked, self.trees)]

    def _output(self, total):
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector, vector_to_array

        # not kept with the model: it goes when the rows it scores are done with
        shipped = dataset.sparkSession.sparkContext.broadcast((self.trees, self.points, list(self.treeWeights)))

        def total(x: pd.Series) -> pd.Series:
            trees, points, weights = shipped.value
            if not len(x):
                return pd.Series([], dtype=float)
            values = bin_numbers(np.stack(x.to_numpy()), points)
            out = np.zeros(len(values))
            for tree, weight in zip(trees, weights):
                left, feature, at, value, _ = unpacked(tree)
                out += weight * value[_descend(left, feature, at, values)]
            return pd.Series(out)

        sum_of = F.pandas_udf(total, "double")(vector_to_array(F.col("features")))
        raw, probability = self._output(F.col("_total"))
        vector = lambda pair: array_to_vector(F.array(*pair))
        return dataset.select(
            "*", sum_of.alias("_total")
        ).select(
            *dataset.columns, vector(raw).alias("rawPrediction"), vector(probability).alias("probability"),
            F.when(probability[1] > 0.5, 1.0).otherwise(0.0).alias("prediction"),
        )

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def copy(self, extra=None):
        return self


class GBTTreesModel(GrownTrees):
    kind = "gbt"

    def _output(self, total):
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))
        return (-total, total), (F.lit(1.0) - p, p)


class ForestModel(GrownTrees):
    kind = "forest"

    def _output(self, total):
        n = float(max(1, len(self.trees)))
        return (F.lit(n) - total, total), (F.lit(1.0) - total / n, total / n)


class _Writer(MLWriter):
    def __init__(self, model: GrownTrees):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={
            "weights": list(m.treeWeights), "points": [[repr(float(v)) for v in p] for p in m.points]})
        rows = [(i, bytearray(t)) for i, t in enumerate(m.trees)]
        spark = self.sparkSession
        spark.createDataFrame(rows, "tree int, found binary").write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        spark = self.sparkSession
        about = DefaultParamsReader.loadMetadata(path, spark)
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        points = [np.array([float(v) for v in p]) for p in about["points"]]
        model = self.kind([bytes(r["found"]) for r in rows], about["weights"], points)
        model._resetUid(about["uid"])
        return model


class BinnedFit(Estimator):
    """Fits rows of (features, label, class_weight), one weight a class; ``binned``,
    where set, holds them."""

    def __init__(self, **settings):
        super().__init__()
        self.settings, self.binned = settings, None

    def _trees(self, binned: Binned, dataset: DataFrame):
        raise NotImplementedError

    def _fit(self, dataset: DataFrame):
        binned = self.binned or Binned(dataset)
        try:
            return self._trees(binned, dataset)
        finally:
            if binned is not self.binned:
                binned.unpersist()

    def copy(self, extra=None):
        return self


class BoostedTrees(BinnedFit):
    """Settings: rounds, depth, rate, rows and inputs (shares), seed."""

    def _trees(self, binned, dataset):
        trees, rates = boosted_trees(binned, self.settings)
        return GBTTreesModel([packed(t) for t in trees], rates, binned.points)


def root_of(slots: int) -> int:
    return int(np.ceil(np.sqrt(slots)))


class Forest(BinnedFit):
    """Settings: trees, least (rows of a leaf), depth, inputs (drawn for a node, of so many), seed."""

    def _trees(self, binned, dataset):
        if binned.n_rows > FOREST_ROWS:
            from pyspark.ml.classification import RandomForestClassifier

            s = self.settings
            return RandomForestClassifier(
                featuresCol="features", labelCol="label", weightCol="class_weight", numTrees=s["trees"],
                minInstancesPerNode=s["least"], maxDepth=s["depth"], seed=s["seed"],
            ).fit(dataset)
        trees = forest_trees(binned, self.settings)
        return ForestModel(trees, [1.0] * len(trees), binned.points)
