"""Set-similarity self-join on word shingles by a token-group matrix.

Documents become sets of hashed shingles.  Equal sets are one set.  Then:

1. Groups.  Min-hash bands propose, for each set, the few others it collides
   with most; those verified form groups of similar documents, each the
   connected component of its verified links.  A few such turns put nearly all
   of a large family of copies into one group.
2. Matrix.  Only pairs of documents in different groups can still join groups.
   Similar documents, those around one pivot, make blocks of bounded size.  The
   members of a block of many groups are compared with each other first; the
   proposals left are (query, block).  A block stores the union of its
   members' tokens; a query's overlap with the union bounds its overlap with
   every member, so a block below the bound stays closed, and the members of an
   open one are verified exactly.  Of the pairs found only those that join
   groups become links.

All sets share all their bands, so no set is dropped: a pair at the threshold
0.75 misses all 40 bands of 3 min-hashes with probability 3e-10, and the
estimate from 120 min-hashes is below one half with probability 1e-10.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import each_cell, parts, prepare, stage
from .components import connected_components

BANDS, ROWS = 40, 3
_SEEDS = np.random.default_rng(20240229).integers(1, 2**63, size=(2, BANDS * ROWS), dtype=np.uint64)
_MULTIPLY, _ADD = (_SEEDS[0] * np.uint64(2) + np.uint64(1))[:, None], _SEEDS[1][:, None]
_PLACE = np.random.default_rng(20240301).integers(1, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text.

    A-Z are lower-cased; words are runs of non-white-space.  A text with fewer
    words is one shingle, one without words or a null text the empty set.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(width, len(codes))
    count = len(codes) - span + 1
    mixed = np.full(count, span, dtype=np.uint64)
    for i in range(span):
        mixed += codes[i : i + count] * _PLACE[i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(tokens: np.ndarray) -> bytes:
    """120 min-hashes of a non-empty set, 16 bits of each (independent of the
    leading bits, which are small for large sets)."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(tokens), 4096):
        part = tokens[i : i + 4096][None, :]
        np.minimum(low, (part * _MULTIPLY + _ADD).min(axis=1), out=low)
    return (low >> np.uint64(16)).astype(np.uint16).tobytes()


def _sketches(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n": [len(s) for s in sets],
                    "same": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    "sig": [signature(s) if len(s) else None for s in sets],
                }
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = [shingle_set(t, width).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "tokens": tokens})

    return run


class Block:
    """The token-group matrix of one block: its distinct tokens, and for each of
    them the members that hold it."""

    def __init__(self, members: list[np.ndarray]):
        owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
        tokens = np.concatenate(members)
        order = np.argsort(tokens, kind="stable")
        self.union, self.starts = np.unique(tokens[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(tokens))
        self.owner = owner[order]
        self.sizes = np.array([len(m) for m in members])

    def similar(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members with a Jaccard similarity of ``percent`` % or more.  The
        overlap with the union bounds the overlap with each member, so a block
        below the bound is not opened."""
        place = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        hit = place[self.union[place] == query]
        if 100 * len(hit) < percent * len(query):
            return np.zeros(0, dtype=np.int64)
        held = self.ends[hit] - self.starts[hit]
        spots = np.repeat(self.starts[hit] - np.cumsum(held) + held, held) + np.arange(held.sum())
        shared = np.bincount(self.owner[spots], minlength=len(self.sizes))
        return np.flatnonzero(100 * shared >= percent * (len(query) + self.sizes - shared))


def _open_blocks(percent: int):
    """Rows sorted by (block, role): the members of a block, then its queries.
    A query gets a link to another group that the block holds members of, unless
    earlier links of the block connect the two groups already: the links of a
    block are a forest over the groups in it, fewer than its members and queries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, ids, groups, members, ready = None, [], [], [], None
        up: dict[int, int] = {}

        def root(group: int) -> int:
            while up.setdefault(group, group) != group:
                up[group] = group = up[up[group]]
            return group

        for batch in batches:
            a, b = [], []
            for r in batch.itertuples(index=False):
                if r.block != block:
                    block, ids, groups, members, ready = r.block, [], [], [], None
                    up.clear()
                tokens = np.frombuffer(r.tokens, dtype=np.uint64)
                if r.role == 0:
                    ids.append(r.id)
                    groups.append(r.comp)
                    members.append(tokens)
                    continue
                if ready is None:
                    ready = Block(members)
                linked = {groups[k]: ids[k] for k in ready.similar(tokens, percent)}
                for group, member in linked.items():
                    if (own := root(r.comp)) != (other := root(group)):
                        up[own] = other
                        a.append(r.id)
                        b.append(member)
            if a:
                yield pd.DataFrame({"a": a, "b": b})

    return run


def verify(
    proposed: DataFrame, members: DataFrame, groups: DataFrame, sets: DataFrame, percent: int, queries: int = 512
) -> DataFrame:
    """Links (a, b) between the queries and the members of proposed (q, g), where
    ``members`` lists (g, d), a bounded number for each g.

    The queries of a block are split into parts of about ``queries``, so a block
    that very many documents are proposed to is many tasks.
    """
    asked = stage(proposed.distinct(), "asked")
    sizes = asked.groupBy(F.col("g").alias("g1")).agg(F.count(F.lit(1)).alias("m"))
    part = F.pmod(F.xxhash64("q"), parts(F.col("m"), queries))
    wanted = stage(
        asked.join(stage(sizes, "sizes"), F.col("g") == F.col("g1")).select("q", "g", part.alias("part")), "wanted"
    )
    block = F.xxhash64("g", "part").alias("block")
    held = (
        wanted.select("g", "part").distinct().join(members.withColumnRenamed("g", "g1"), F.col("g") == F.col("g1"))
    )
    rows = held.select(block, F.lit(0).alias("role"), F.col("d").alias("id")).union(
        wanted.select(block, F.lit(1).alias("role"), F.col("q").alias("id"))
    )
    known = sets.join(groups.withColumnRenamed("id", "j"), F.col("i") == F.col("j"))
    rows = (
        rows.join(known, F.col("id") == F.col("i"))
        .select("block", "role", "id", F.col("component").alias("comp"), "tokens")
        .repartition("block")
        .sortWithinPartitions("block", "role", "id")
    )
    return stage(rows.mapInPandas(_open_blocks(percent), "a long, b long"), "links")


def _proposals_in_cells(least: int):
    """Rows sorted by cell: (query, block) for pairs of a cell whose min-hashes
    agree in ``least`` places, whose groups differ, and whose first shared band
    is the cell's; each block once a query and cell."""

    def pairs(cell: pd.DataFrame) -> pd.DataFrame | None:
        sig = np.frombuffer(b"".join(cell["sig"]), dtype=np.uint16).reshape(len(cell), BANDS, ROWS)
        ids, groups, blocks = (cell[c].to_numpy() for c in ("rep", "comp", "block"))
        chunk, band = cell["chunk"].to_numpy(), int(cell["band"].iloc[0])
        i, j = int(cell["i"].iloc[0]), int(cell["j"].iloc[0])
        q, g = [], []
        for x in range(len(cell)):
            if chunk[x] != i:
                continue
            others = (chunk == j) & (groups != groups[x])
            if i == j:
                others[: x + 1] = False
            y = np.flatnonzero(others)
            if not len(y):
                continue
            same = sig[y] == sig[x]
            bands = same.all(axis=2)
            keep = (same.sum(axis=(1, 2)) >= least) & (bands.argmax(axis=1) == band) & bands[:, band]
            near = np.unique(blocks[y[keep]])
            q.append(np.full(len(near), ids[x]))
            g.append(near)
        return pd.DataFrame({"q": np.concatenate(q), "g": np.concatenate(g)}) if q else None

    return lambda batches: each_cell(batches, ["key", "i", "j"], pairs)


def _cells_between_groups(rows: DataFrame, size: int) -> DataFrame:
    """Deal the rows of each key into cells of at most about twice ``size`` rows,
    so that any two of different groups (comp) meet in one cell.

    The largest group of a key is cut into chunks of its own, which meet the
    chunks of the other rows but not each other: a key held by one family and
    a few others costs a copy a row.  Keys of one group are left out.  Adds
    ``chunk``, ``i`` and ``j``; sorted by cell.
    """
    counts = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    keys = (
        counts.groupBy(F.col("key").alias("k"))
        .agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("m"), F.count(F.lit(1)).alias("found"))
        .where("found > 1")
        .select(
            "k",
            F.col("top.comp").alias("largest"),
            parts(F.col("m") - F.col("top.c"), size).alias("others"),
            parts(F.col("top.c"), size).alias("inside"),
        )
    )
    top = F.col("comp") == F.col("largest")
    chunk = F.when(top, F.col("others") + F.pmod(F.xxhash64("rep"), "inside")).otherwise(
        F.pmod(F.xxhash64("rep"), "others")
    )
    meets = F.when(top, F.col("others")).otherwise(F.col("others") + F.col("inside"))
    return (
        rows.join(stage(keys, "keys"), F.col("key") == F.col("k"))
        .withColumn("chunk", chunk)
        .withColumn("_x", F.explode(F.sequence(F.lit(0).cast("long"), meets - 1)))
        .withColumn("i", F.least("chunk", "_x"))
        .withColumn("j", F.greatest("chunk", "_x"))
        .drop("_x", "k", "largest", "others", "inside")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "rep")
    )


def _in_groups(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """Band rows with the present group (comp) of their set."""
    return stage(
        keyed.join(groups, F.col("rep") == F.col("id")).select(
            "key", "band", "rep", "m", F.col("component").alias("comp")
        ),
        "grouped",
    )


def _star_proposals(grouped: DataFrame, pivots: int, turn: int) -> DataFrame:
    """(q, g, place): each set against the pivots of other groups with which it
    shares most bands, at most ``pivots`` of them.

    Every band has one pivot, in the first turn its smallest id, later a
    pseudo-random one, so a band that thousands of sets share gives a proposal
    a set, and a large group of copies falls together within a few turns.
    Nothing is lost: pairs not proposed here are compared between groups.
    """
    place = F.col("rep") if turn == 0 else F.xxhash64(F.lit(turn), F.col("rep"))
    chosen = (
        grouped.groupBy(F.col("key").alias("k"))
        .agg(
            F.min(F.struct(place.alias("place"), "rep", "comp")).alias("p"),
            F.min("comp").alias("lo"),
            F.max("comp").alias("hi"),
        )
        .where("lo < hi")
        .select("k", F.col("p.rep").alias("pivot"), F.col("p.comp").alias("home"))
    )
    best = Window.partitionBy("rep").orderBy(F.desc("c"), "pivot")
    return stage(
        grouped.join(stage(chosen, "pivots"), F.col("key") == F.col("k"))
        .where("comp <> home")
        .groupBy("rep", "pivot")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("place", F.row_number().over(best))
        .where((F.col("place") <= pivots) & (F.col("c") > 1))
        .select(F.col("rep").alias("q"), F.col("pivot").alias("g"), "place"),
        "proposed",
    )


def _merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Groups (id, component) after the links (a, b): components of groups."""
    ends = groups.select(F.col("id").alias("i"), F.col("component").alias("c"))
    edges = links.join(ends, F.col("a") == F.col("i")).select(F.col("c").alias("a"), "b")
    edges = edges.join(ends, F.col("b") == F.col("i")).select("a", F.col("c").alias("b"))
    moved = connected_components(edges.where("a <> b")).select(
        F.col("id").alias("old"), F.col("component").alias("new")
    )
    return stage(
        groups.join(moved, F.col("component") == F.col("old"), "left").select(
            "id", F.coalesce("new", "component").alias("component")
        ),
        "groups",
    )


def _reduced(docs: DataFrame, ids: DataFrame, slots: int = 1 << 21) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) whose id is in ``ids`` (id).

    The occupied ones of a fixed number of hash slots are broadcast (at most
    ``slots`` rows, whatever the input) and thin out the texts before the
    exact join shuffles them.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(slots)).cast("int")
    taken = ids.select(slot("id").alias("_slot")).distinct()
    return (
        docs.withColumn("_s", slot("doc_id"))
        .join(F.broadcast(taken), F.col("_s") == F.col("_slot"), "left_semi")
        .join(ids, F.col("doc_id") == F.col("id"))
        .select("id", "text")
    )


def similarity_classes(
    docs: DataFrame, width: int = 5, percent: int = 75, pivots: int = 3, rounds: int = 1, cell: int = 256, members: int = 1024
) -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of ``percent`` % or
    more of their shingle sets.

    Returns doc_id, ``n_shingles`` and ``component_id`` (the smallest doc_id
    reachable by links), one row per row of ``docs`` (doc_id, text; other
    columns are ignored).  Null and wordless texts have no shingles and no
    links.  Equal texts are linked.  A repeated doc_id is one document of
    several texts; a row with a null doc_id only shares the component of equal
    texts.  No rows give no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sketches = stage(
        docs.mapInPandas(_sketches(width), "doc_id long, n long, same binary, sig binary"), "sketch"
    )
    full = sketches.where("n > 0")
    classes = stage(
        full.groupBy("n", "same").agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")), "classes"
    )
    unique = classes.where(F.col("rep").isNotNull()).select("rep", "sig")

    # bands that more than one set shares, of the sets that share two or more:
    # a pair at the threshold shares fewer than two with probability 1e-8
    band = F.sequence(F.lit(0), F.lit(BANDS - 1))
    key = lambda i: F.struct(
        i.alias("band"),
        F.xxhash64(i, F.substring("sig", i * (2 * ROWS) + 1, F.lit(2 * ROWS))).alias("key"),
    )
    keys = unique.select("rep", F.inline(F.transform(band, key)))
    shared = stage(
        keys.groupBy("key")
        .agg(F.count(F.lit(1)).alias("m"))
        .where("m > 1")
        .withColumnRenamed("key", "k"),
        "bands",
    )
    keyed = stage(keys.join(shared, F.col("key") == F.col("k")).select("key", "band", "rep", "m"), "bands")
    known = stage(
        keyed.groupBy(F.col("rep").alias("id")).agg(F.count(F.lit(1)).alias("bands")).where("bands > 1").select("id"),
        "known",
    )
    sets = stage(_reduced(docs, known).mapInPandas(_sets(width), "id long, tokens binary"), "sets")
    sets = sets.withColumnRenamed("id", "i")
    groups = known.withColumn("component", F.col("id"))
    home = None
    for turn in range(rounds):
        proposed = _star_proposals(_in_groups(keyed, groups), pivots, turn)
        home = proposed if home is None else home
        alone = proposed.select("g").distinct().withColumn("d", F.col("g"))
        groups = _merged(groups, verify(proposed.select("q", "g"), alone, groups, sets, percent))

    # the blocks: documents around one pivot of the first turn, split by a hash
    home = known.join(
        home.where("place = 1").select("q", "g"), F.col("id") == F.col("q"), "left"
    ).select("id", F.coalesce("g", "id").alias("pivot"))
    around = home.groupBy(F.col("pivot").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    part = F.pmod(F.xxhash64("id"), parts(F.col("n"), members))
    blocks = stage(
        home.join(stage(around, "around"), F.col("pivot") == F.col("p")).select(
            F.xxhash64("pivot", part).alias("g"), F.col("id").alias("d")
        ),
        "home",
    )

    # a family whose pivots are far from most of it is still many groups: they
    # meet within their blocks before the pairs between blocks are proposed
    crowded = (
        blocks.join(groups, F.col("d") == F.col("id"))
        .groupBy(F.col("g").alias("crowd"))
        .agg(F.count_distinct("component").alias("c"))
        .where(F.col("c") > max(members // 16, 1))
    )
    inside = stage(
        blocks.join(crowded, F.col("g") == F.col("crowd")).select(F.col("d").alias("q"), "g"), "inside"
    )
    if not inside.isEmpty():
        groups = _merged(groups, verify(inside, blocks, groups, sets, percent))

    # between groups: every pair that is left
    cells = _cells_between_groups(
        _in_groups(keyed, groups)
        .join(unique.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r"))
        .join(blocks, F.col("rep") == F.col("d"))
        .select("key", "band", "rep", "comp", "sig", F.col("g").alias("block")),
        cell,
    )
    left = stage(cells.mapInPandas(_proposals_in_cells(BANDS * ROWS // 2), "q long, g long"), "left")
    groups = _merged(groups, verify(left, blocks, groups, sets, percent))
    final = (
        unique.select("rep")
        .distinct()
        .join(groups, F.col("rep") == F.col("id"), "left")
        .select(F.col("rep").alias("final_rep"), F.coalesce("component", "rep").alias("component_id"))
    )
    named = classes.join(final, F.col("rep") == F.col("final_rep"), "left").select(
        F.col("n").alias("cn"), F.col("same").alias("csame"), "component_id"
    )
    return sketches.join(
        named, (F.col("n") == F.col("cn")) & (F.col("same") == F.col("csame")), "left"
    ).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
