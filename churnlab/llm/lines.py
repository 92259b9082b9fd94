"""Reversible line dedup: sharded cuckoo filters before exact reference counts.

An index knows which document holds which line.  It is a folder of epochs, one
for each batch of documents inserted or deleted, with the tables

- ``refs``: the line keys of every inserted document;
- ``counts``: the exact state of a key as of an epoch: ``n`` references and the
  first and last document holding it;
- ``filters``: a cuckoo filter for each shard of the keys, a fingerprint a key;
- ``gone``: the documents deleted.

An insertion asks the filters first.  A key they don't know is new: its counts
are appended without reading older ones.  Only keys that the filters may know are
joined with the counts; should one be new after all, its fingerprint is added
then.  A deletion subtracts references; a key without any leaves its filter, and
one that lost its first or last document gets the next from the documents that
remain.  So after any insertions and deletions the index decides as one built
from the remaining documents alone.

An epoch counts from when its last file is written; one that failed halfway is
never read and is written anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, stage
from .cuckoo import CuckooFilter

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOBODY = 2**63 - 1  # stands for a null doc_id: after all others
_STATE = "epoch long, n long, lo long, hi long"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _LOWER)


def _digest(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _keys(text: Column, least: int) -> Column:
    """Digest of the key of every line, null for keys below ``least`` code points."""
    return F.transform(
        F.transform(lines_of(text), line_key), lambda k: F.when(F.char_length(k) >= least, _digest(k))
    )


def line_refs(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, keys) of every document: its different keys that count."""
    keys = F.array_distinct(F.filter(_keys(F.col("text"), least), lambda k: k.isNotNull()))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), keys.alias("keys"))


def _states(refs: DataFrame) -> DataFrame:
    place = F.coalesce("doc_id", F.lit(_NOBODY)).alias("place")
    return (
        refs.select(place, F.explode("keys").alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("lo"), F.max("place").alias("hi"))
    )


def _filter_pass(bits: int):
    """Rows sorted by (shard, role): 0 a table of the shard's filter, 1 a hash to
    ask for and, if unknown, to add, 2 one to add, 3 one to remove.  Returns
    role 1 rows with ``known``, and the tables of the filter as role 0 rows."""
    columns = ["shard", "role", "level", "blob", "key", "hash", "known"]

    def tables(shard: int, held: CuckooFilter) -> pd.DataFrame:
        blobs = held.stored()
        return pd.DataFrame(
            {"shard": shard, "role": 0, "level": range(len(blobs)), "blob": blobs, "key": None, "hash": 0, "known": False},
            columns=columns,
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, blobs, held = None, [], None
        for batch in batches:
            if not len(batch):
                continue
            of, role = batch["shard"].to_numpy(), batch["role"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (role[1:] != role[:-1])])
            for start, end in zip(cuts, np.r_[cuts[1:], len(batch)]):
                if of[start] != shard:
                    if held is not None or blobs:
                        yield tables(shard, CuckooFilter(bits, blobs) if held is None else held)
                    shard, blobs, held = of[start], [], None
                part = batch.iloc[start:end]
                if role[start] == 0:
                    blobs += part["blob"].tolist()
                    continue
                if held is None:
                    held, blobs = CuckooFilter(bits, blobs), []
                h = part["hash"].to_numpy()
                if role[start] == 1:
                    known = held.contains(h)
                    held.add(h[~known])
                    yield part.assign(known=known, blob=None)[columns]
                elif role[start] == 2:
                    held.add(h)
                else:
                    held.remove(h)
        if held is not None or blobs:
            yield tables(shard, CuckooFilter(bits, blobs) if held is None else held)

    return run


_FILTERED = "shard long, role int, level int, blob binary, key binary, hash long, known boolean"


class LineIndex:
    """The index in ``folder`` (in a store that all executors reach).

    ``shards`` and ``bits`` (a filter table has 2^bits buckets of four) set how
    much a task holds: with about 150,000 keys a shard one table of 512 KB.  A
    shard with more keys gets more tables.  Both belong to the folder and must
    not change.  ``least`` is the length in code points from which a key counts.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: int = 64, bits: int = 16, least: int = 10):
        prepare(spark)
        self.spark, self.folder, self.shards, self.bits, self.least = spark, folder.rstrip("/"), shards, bits, least
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def epochs(self) -> list[int]:
        """The epochs that were written to their end."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.folder))]
        found = sorted(int(n.removeprefix("epoch=")) for n in names if n.startswith("epoch="))
        return [e for e in found if self._fs.exists(self._path(f"{self.folder}/epoch={e}/done/_SUCCESS"))]

    def _write(self, df: DataFrame, epoch: int, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/epoch={epoch}/{table}")

    def _read(self, table: str, schema: str) -> DataFrame:
        """A table over all epochs, with the column epoch."""
        paths = [f"{self.folder}/epoch={e}/{table}" for e in self.epochs()]
        paths = [p for p in paths if self._fs.exists(self._path(p))]
        if not paths:
            return self.spark.createDataFrame([], f"{schema}, epoch long")
        return self.spark.read.schema(f"{schema}, epoch long").option("basePath", self.folder).parquet(*paths)

    def counts(self) -> DataFrame:
        """(key, epoch, n, lo, hi) of every key with references: its last state."""
        last = self._read("counts", "key binary, n long, lo long, hi long")
        last = last.groupBy("key").agg(F.max(F.struct("epoch", "n", "lo", "hi")).alias("s"))
        return last.where("s.n > 0").select("key", "s.*")

    def refs(self) -> DataFrame:
        """(doc_id, keys) of the documents that are in the index."""
        rows = self._read("refs", "doc_id long, keys array<binary>")
        gone = self._read("gone", "doc_id long").groupBy(F.col("doc_id").alias("g")).agg(F.max("epoch").alias("until"))
        left = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("g")) & (F.col("epoch") < F.col("until")), "left_anti")
        return left.select("doc_id", "keys")

    def _filters(self) -> DataFrame:
        every = self._read("filters", "shard long, level int, blob binary")
        last = every.groupBy("shard", "level").agg(F.max_by("blob", "epoch").alias("blob"))
        return last.select("shard", F.lit(0).alias("role"), "level", "blob")

    def _asked(self, keys: DataFrame, role: int) -> DataFrame:
        """Keys as rows for the filters; the shard and the place in it come from
        different hashes."""
        shard = F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(self.shards)).alias("shard")
        return keys.select(shard, F.lit(role).alias("role"), "key", F.xxhash64("key").alias("hash"))

    def _filtered(self, tables: DataFrame, asked: DataFrame) -> DataFrame:
        # the tables go only where there is something to ask or change
        tables = tables.join(asked.select(F.col("shard").alias("s")).distinct(), F.col("shard") == F.col("s"), "left_semi")
        rows = tables.withColumn("hash", F.lit(0).cast("long")).unionByName(asked, allowMissingColumns=True)
        return (
            rows.select("shard", "role", "level", "blob", "key", "hash")
            .repartition("shard")
            .sortWithinPartitions("shard", "role", "level", "hash")
            .mapInPandas(_filter_pass(self.bits), _FILTERED)
        )

    def _finish(self, epoch: int, filters: DataFrame) -> None:
        self._write(filters.where("role = 0").select("shard", "level", "blob"), epoch, "filters")
        self._write(self.spark.createDataFrame([(epoch,)], "done long").coalesce(1), epoch, "done")

    def _next(self) -> int:
        return max(self.epochs(), default=0) + 1

    def insert(self, docs: DataFrame) -> None:
        """Add the documents (doc_id, text).  A row is a reference of its own, so
        a document inserted twice counts twice - and is one document."""
        self._insert(line_refs(docs, self.least))

    def _insert(self, refs: DataFrame) -> None:
        epoch = self._next()
        self._write(refs, epoch, "refs")
        refs = self.spark.read.schema(refs.schema).parquet(f"{self.folder}/epoch={epoch}/refs")
        batch = stage(_states(refs), "lines")
        probed = stage(self._filtered(self._filters(), self._asked(batch, 1)), "lines")
        maybe = probed.where("role = 1 AND known").select(F.col("key").alias("k"))
        # what the filters don't know is new; the rest meets its older state
        new = batch.join(maybe, F.col("key") == F.col("k"), "left_anti").withColumn("late", F.lit(False))
        older = self.counts().select(F.col("key").alias("o"), *(F.col(c).alias(f"o_{c}") for c in ("n", "lo", "hi")))
        met = batch.join(maybe, F.col("key") == F.col("k"), "left_semi").join(older, F.col("key") == F.col("o"), "left")
        met = met.select(
            "key",
            (F.col("n") + F.coalesce("o_n", F.lit(0))).alias("n"),
            F.least("lo", "o_lo").alias("lo"),
            F.greatest("hi", "o_hi").alias("hi"),
            F.col("o").isNull().alias("late"),
        )
        self._write(new.union(met), epoch, "counts")
        late = self.spark.read.parquet(f"{self.folder}/epoch={epoch}/counts").where("late")
        filters = probed.where("role = 0").select("shard", "role", "level", "blob")
        asked = stage(self._asked(late, 2), "lines")
        added = self._filtered(filters, asked).select("shard", "role", "level", "blob")
        same = filters.join(asked.select(F.col("shard").alias("s")).distinct(), F.col("shard") == F.col("s"), "left_anti")
        self._finish(epoch, added.union(same))

    def delete(self, doc_ids: DataFrame) -> None:
        """Take the documents out whose doc_id is in ``doc_ids`` (null: those
        without one).  Unknown ids change nothing."""
        epoch = self._next()
        gone = doc_ids.select(F.col("doc_id").cast("long").alias("g")).distinct()
        self._write(gone.select(F.col("g").alias("doc_id")), epoch, "gone")
        held, out = self.refs(), F.col("doc_id").eqNullSafe(F.col("g"))
        lost = _states(held.join(gone, out, "left_semi")).select(
            F.col("key").alias("x"), F.col("n").alias("x_n"), F.col("lo").alias("x_lo"), F.col("hi").alias("x_hi")
        )
        left = self.counts().join(lost, F.col("key") == F.col("x")).select(
            "key", (F.col("n") - F.col("x_n")).alias("n"), "lo", "hi",
            ((F.col("lo") == F.col("x_lo")) | (F.col("hi") == F.col("x_hi"))).alias("open"),
        )
        left = stage(left, "lines")
        # keys that lost an end: from the references that remain
        ends = left.where("open AND n > 0").select(F.col("key").alias("e"))
        rest = held.join(gone, out, "left_anti").select("doc_id", F.explode("keys").alias("key"))
        rest = rest.join(ends, F.col("key") == F.col("e"), "left_semi").select("doc_id", F.array("key").alias("keys"))
        rest = _states(rest).select(F.col("key").alias("r"), F.col("lo").alias("r_lo"), F.col("hi").alias("r_hi"))
        now = left.join(rest, F.col("key") == F.col("r"), "left").select(
            "key", "n", F.coalesce("r_lo", "lo").alias("lo"), F.coalesce("r_hi", "hi").alias("hi"), F.lit(False).alias("late")
        )
        self._write(now, epoch, "counts")
        self._finish(epoch, self._filtered(self._filters(), stage(self._asked(left.where("n = 0"), 3), "lines")))

    def decide(self, docs: DataFrame, salts: int = 256) -> DataFrame:
        """Drop from ``docs`` the lines that the index knows from a smaller
        doc_id: (doc_id, text, n_lines, n_dropped).

        Keys that hold more than a 1,024th of all references - so there are
        fewer than 1,024 - are broadcast, and their lines dealt over ``salts``.
        """
        known = stage(self.counts().where("lo < hi").select("key", "lo", "n"), "lines")
        total = known.agg(F.sum("n")).first()[0] or 0
        hot = F.col("n") * 1024 > total
        heavy = F.broadcast(known.where(hot).select(F.col("key").alias("h")))
        row = F.xxhash64("doc_id", "mark")
        lines = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            _digest(F.coalesce("text", F.lit(""))).alias("mark"),
            F.posexplode(_keys(F.col("text"), self.least)).alias("at", "key"),
        ).where(F.col("key").isNotNull())
        lines = lines.join(heavy, F.col("key") == F.col("h"), "left").withColumn(
            "salt", F.when(F.col("h").isNotNull(), F.pmod(row, F.lit(salts))).otherwise(0)
        )
        spread = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
        firsts = known.select(F.col("key").alias("f"), "lo", spread.alias("f_salt"))
        met = lines.join(firsts, (F.col("key") == F.col("f")) & (F.col("salt") == F.col("f_salt")))
        met = met.where(F.coalesce("doc_id", F.lit(_NOBODY)) != F.col("lo"))
        # equal rows share a mark, and what they lose
        dropped = met.groupBy(F.col("doc_id").alias("d"), F.col("mark").alias("m")).agg(F.collect_set("at").alias("drop"))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _digest(F.coalesce("text", F.lit(""))).alias("mark"))
        rows = rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")
        none = F.array().cast("array<int>")
        return (
            rows.withColumn("lines", lines_of(F.col("text")))
            .withColumn("drop", F.coalesce("drop", none))
            .select(
                "doc_id",
                F.array_join(
                    F.transform(
                        F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop")),
                        lambda i: F.get("lines", i),
                    ),
                    "\n",
                ).alias("text"),
                F.size("lines").cast("long").alias("n_lines"),
                F.size("drop").cast("long").alias("n_dropped"),
            )
        )


def dedupe_lines(docs: DataFrame, least: int = 10, batches: int = 2, per_shard: int = 150_000) -> DataFrame:
    """The documents without the lines that a smaller doc_id has.

    ``docs`` has doc_id and text.  A line's key is the line without blanks at
    both ends, A-Z in lower case.  A key of at least ``least`` code points in at
    least two documents loses all its lines except those of the smallest doc_id
    holding it.  Returns (doc_id, text, n_lines before dropping, n_dropped); a
    document that loses all lines has the empty text.

    The documents enter a new index in ``batches`` parts, so the later ones go
    through the filters of the earlier; the index goes when the application
    ends.  A null or empty text is one empty line.  Rows of one doc_id are one
    document; rows without an id are one document after all others.  No rows give
    no rows.
    """
    spark = docs.sparkSession
    folder = f"{prepare(spark)}/lines-{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("part")
    refs = stage(line_refs(docs, least).select("*", part), "lines")
    count = refs.agg(F.sum(F.size("keys"))).first()[0] or 0
    index = LineIndex(spark, folder, shards=max(8, -(-count // per_shard)), least=least)
    index._fs.deleteOnExit(index._path(folder))
    for i in range(batches):
        index._insert(refs.where(F.col("part") == i).drop("part"))
    return index.decide(docs)
