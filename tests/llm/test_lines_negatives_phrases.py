"""Operators 11, 12 and 13: line dedup, hard negatives, phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.llm import lines, negatives, phrases
from churnlab.llm.cuckoo import CuckooFilter

from .helpers import documents, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hashes(n, seed):
    return np.random.default_rng(seed).integers(-(2**63), 2**63 - 1, n)


def test_cuckoo_filter_adds_and_removes():
    h = hashes(3000, 1)
    held = CuckooFilter(bits=8)  # 1,024 places a table: three tables or more
    held.add(h)
    assert len(held) == 3000 and len(held.tables) > 2 and held.contains(h).all()
    assert held.contains(hashes(20000, 2)).mean() < 0.005
    held = CuckooFilter(8, held.stored())
    held.remove(h[:2000])
    assert len(held) == 1000 and held.contains(h[2000:]).all()
    held.add(h[:2000])
    held.remove(h)
    assert len(held) == 0
    with pytest.raises(ValueError):
        held.remove(h[:1])


def test_cuckoo_filter_keeps_a_copy_of_each_like_hash():
    twins = np.array([5, 5 | (7 << 20), 5 | (9 << 30)])  # one bucket, one fingerprint
    held = CuckooFilter(bits=8)
    held.add(twins)
    assert len(held) == 3
    held.remove(twins[:1])
    assert len(held) == 2 and held.contains(twins[1:]).all()


def deduped(rows, least=10):
    def key(line):
        return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOWER)

    def order(i):
        return (i is None, i or 0)

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, text in rows:
        old = (text or "").split("\n")
        kept = [x for x in old if len(key(x)) < least or min(holders[key(x)], key=order) == i]
        out.append((i, "\n".join(kept), len(old), len(old) - len(kept)))
    return sorted(out, key=str)


def line_rows():
    rng = random.Random(3)
    common = [words(6, i) for i in range(12)]
    rows = []
    for i in range(60):
        text = [rng.choice(common) if rng.random() < 0.5 else words(5, 100 + 40 * i + j) for j in range(rng.randint(1, 9))]
        rows.append((i, "\n".join(text)))
    rows += [(i, "The one very common line\n" + words(4, i)) for i in range(100, 180)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "short\nshort"), (204, "short"), (205, "nine char"), (206, "nine char")]
    rows += [(210, "Ten chars!"), (211, "\t ten CHARS! \x0b\r"), (212, "ten chars!\nten chars!"), (213, "ten chars! ")]
    rows += [(220, "éééééééééé"), (221, "éééééééééé"), (222, "ÉÉÉÉÉÉÉÉÉÉ"), (-5, common[0]), (-5, common[0]), (-5, words(9, 9999))]
    rows += [(230, "\n".join(words(7, 5000 + i % 900) for i in range(2000))), (231, words(7, 5001)), (None, common[1]), (None, words(8, 7))]
    return rows


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lines_match_brute_force(spark):
    rows = line_rows()
    got = lines.dedupe_lines(documents(spark, [(i, t, "s") for i, t in rows]), per_shard=200)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert as_rows(got) == deduped(rows)


def test_lines_of_no_documents(spark):
    assert lines.dedupe_lines(documents(spark, [])).count() == 0


def test_index_is_reversible(spark, tmp_path):
    """After insertions and deletions in any order the index decides as one of
    the remaining documents alone, and holds a fingerprint a key."""
    rows = line_rows()

    def frame(some):
        return documents(spark, [(i, t, "s") for i, t in some])

    index = lines.LineIndex(spark, str(tmp_path / "index"), shards=3, bits=4)
    assert index.decide(frame(rows[:3])).count() == 3  # an empty index knows no line
    index.insert(frame(rows[::2]))
    index.insert(frame(rows[1::2]))
    out = {i for i, _ in rows if i is not None and i % 3 == 0} | {-5, None}
    index.delete(spark.createDataFrame([(i,) for i in sorted(out - {None})] + [(None,), (99999,)], "doc_id long"))
    left = [r for r in rows if r[0] not in out]
    assert as_rows(index.decide(frame(left))) == deduped(left)

    def fingerprints():
        return sum(len(CuckooFilter(4, [bytes(r["blob"])])) for r in index._filters().collect())

    assert fingerprints() == index.counts().count()
    index.insert(frame([r for r in rows if r[0] in out]))
    assert as_rows(index.decide(frame(rows))) == deduped(rows)
    assert fingerprints() == index.counts().count()
    index.delete(spark.createDataFrame([(i,) for i, _ in rows], "doc_id long").distinct())
    assert index.counts().count() == 0 and fingerprints() == 0
    # a half-written epoch is not read and is written anew
    last = index.epochs()[-1]
    index.refs().write.parquet(f"{index.folder}/epoch={last + 1}/refs")
    assert index.epochs()[-1] == last
    index.insert(frame(rows[:5]))
    assert index.epochs()[-1] == last + 1 and as_rows(index.decide(frame(rows[:5]))) == deduped(rows[:5])


def test_filters_send_only_known_keys_to_the_counts(spark, tmp_path):
    index = lines.LineIndex(spark, str(tmp_path / "index"), shards=2)
    index.insert(documents(spark, [(i, words(9, i), "s") for i in range(50)]))
    index.insert(documents(spark, [(100 + i, words(9, 40 + i), "s") for i in range(50)]))
    written = spark.read.parquet(f"{index.folder}/epoch=2/counts")
    assert written.count() == 50 and written.where("n = 2").count() == 10
    assert index.counts().count() == 90


def mined(rows, anchors, positives=5, negatives=5, low=80, high=100):
    whole = [(n, i, y, [int(np.floor(256.0 * x)) for x in v]) for n, (i, y, v) in enumerate(rows)]
    out = []
    for n, a, label, v in whole:
        if not anchors(a):
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), i, m, y) for m, i, y, w in whole if m != n and len(w) == len(v)]
        scored.sort()
        for s, i, _, _ in [x for x in scored if x[3] == label][:positives]:
            window = [x for x in scored if x[3] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a, i, r, x[1], -s, -x[0]) for r, x in enumerate(window, 1)]
    return sorted(out)


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return frame.selectExpr("*", *(f"'x' AS {c}" for c in ("rid", "v", "top", "cell", "score", "qid", "wanted", "scaled")))


def vector_rows(n, seed, width=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    rows = []
    for i in range(n):
        v = centres[i % 4] + 0.4 * rng.normal(size=width)
        rows.append((i, int(rng.integers(3)), [float(np.float32(x)) for x in v / np.linalg.norm(v)]))
    return rows


@pytest.mark.parametrize("tree", [{}, {"tops": 5, "drawn": 20, "block": 30, "ways": 3, "leaf": 4}])
def test_negatives_match_brute_force(spark, tree):
    rows = vector_rows(400, 1)
    rows += [(1000 + i, i % 2, rows[0][2]) for i in range(150)]  # equal vectors
    rows += [(2000, 1, []), (2001, 1, []), (2002, 0, []), (2010, 0, [1.0, 2.0]), (2020, 0, [0.5, 2.0]), (2030, 1, [1.0, 1.5])]
    rows += [(2040, 2, [0.0] * 8), (7, 1, rows[3][2]), (10, 2, rows[10][2])]
    odd = [(None, 1, rows[0][2]), (3000, None, rows[0][2]), (3010, 1, None), (3020, 1, [None] * 8), (3030, 1, [float("nan")] * 8)]
    odd += [(3040, 1, [float("inf")] + [0.0] * 7)]
    got = negatives.hard_negatives(vectors(spark, rows + odd), F.col("vec_id") % 10 == 0, **tree)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i: i % 10 == 0)


def test_negatives_of_other_windows_and_none(spark):
    rows = vector_rows(120, 2)
    got = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") < 9, positives=3, negatives=2, low=35, high=60)
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i: i < 9, 3, 2, 35, 60)
    assert negatives.hard_negatives(vectors(spark, []), F.col("vec_id") < 9).count() == 0
    assert negatives.hard_negatives(vectors(spark, rows), F.lit(False)).count() == 0
    with pytest.raises(ValueError):
        negatives.hard_negatives(vectors(spark, rows), F.lit(True), low=50, high=40)


def test_negatives_with_large_components(spark):
    rows = [(i, y, [x * 2.0**40 for x in v]) for i, y, v in vector_rows(60, 3, 3)]
    got = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 7 == 0)
    wide = 2**63 - 1
    # beyond 64 bits all scores are one
    assert all(abs(r["positive_score"]) <= wide and r["negative_score"] <= r["positive_score"] for r in got.collect())


def test_tree_leaves_out_subtrees_and_stays_exact():
    import pandas as pd

    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 6)) * 100
    whole = np.floor(centres[rng.integers(40, size=3000)] + rng.normal(size=(3000, 6)))
    unit = np.abs(whole).max()
    space = negatives.Space(6, unit, float(((whole / unit) ** 2).sum(axis=1).max()) * (1 + 1e-9))
    block = pd.DataFrame({"rid": range(3000), "vec_id": range(3000), "label": rng.integers(3, size=3000), "v": list(whole)})
    score = (whole[:50] @ whole.T).astype(np.int64)
    top = np.sort(score, axis=1)[:, -1]
    queries = pd.DataFrame({
        "qid": range(50), "self": range(50), "label": block["label"][:50], "v": list(whole[:50]),
        "floor": top * 7 // 10, "ceiling": top * 9 // 10,
    })
    search = negatives.Search(space, block)
    got = search.best(queries, 5, alike=False)
    for q in range(50):
        fits = (score[q] >= queries["floor"][q]) & (score[q] <= queries["ceiling"][q]) & (block["label"] != block["label"][q])
        want = sorted((-score[q, r], r) for r in np.flatnonzero(fits))[:5]
        mine = got[got["qid"] == q]
        assert sorted(zip(-mine["score"], mine["vec_id"])) == want
    assert search.scored < 0.5 * 50 * 3000  # far less than all pairs


def collocated(rows, support, top, longest=5):
    count, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    count[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        inside = {p[i:j] for p, a in frequent.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1)
                  if j - i < len(p) and a >= f[p[i:j]]}
        ranked = []
        for p, a in frequent.items():
            if p not in inside:
                score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(5)
    vocabulary = [words(1, i) + str(i) for i in range(30)] + ["Élan", "日本", "a b", "Don't"]
    rows = []
    for i in range(240):
        text = []
        for _ in range(rng.randint(0, 30)):
            text.append(rng.choice(["New York City", "of the", "the United  States\tof America"]) if rng.random() < 0.3 else rng.choice(vocabulary))
            if rng.random() < 0.2:
                text[-1] += rng.choice([".", ",", "\n", "!?", "\r\n", "\x0b"])
        rows.append((i, " ".join(text), rng.choice(["en", "en", "en", "fr", None])))
    rows += [(300, None, "en"), (301, "", "en"), (302, " \t\n.,", "de"), (None, "new york city " * 30, "en"), (7, "of the", "en")]
    rows.append((303, "again and again " * 500, "es"))  # frequent in one document
    return rows


@pytest.mark.parametrize("one_in", [1, 3, 100000])
def test_phrases_match_brute_force(spark, one_in, monkeypatch):
    """Whatever the sample holds, all or next to nothing."""
    rows = phrase_rows()
    frame = documents(spark, [(i, t, "s") for i, t, _ in rows]).drop("lang", "n")
    langs = spark.createDataFrame([(i, lang) for i, _, lang in rows if i is not None], "doc_id long, lang string")
    frame = frame.join(langs.dropDuplicates(["doc_id"]), "doc_id", "left").withColumn("n", F.lit("x"))
    known = {i: lang for i, _, lang in reversed(rows) if i is not None}
    del monkeypatch
    seen = [(r["doc_id"], r["text"], r["lang"]) for r in frame.collect()]
    assert len(seen) == len(rows) and known
    got = phrases.collocations(frame, support=8, top=40, one_in=one_in)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == collocated(seen, 8, 40)


def test_border_failures_expand(spark):
    rows = [(i, "left hand side of it", "s") for i in range(20)]
    found, failures = phrases.frequent_phrases(documents(spark, rows), support=10, one_in=100000)
    assert failures > 0
    named = {(r["words"], r["phrase"]): r["a"] for r in found.collect()}
    assert named[5, "left hand side of it"] == 20 and named[2, "of it"] == 20 and named[0, ""] == 100
    assert len(named) == 1 + 5 + 4 + 3 + 2 + 1
    none, failures = phrases.frequent_phrases(documents(spark, rows), support=10, one_in=1)
    assert failures == 0 and none.count() == found.count()


def test_phrases_in_chunks(spark, monkeypatch):
    """Texts longer than a chunk are cut only where pieces end."""
    text = ("one two three. " * 700 + "four five " * 900 + "\n") * 2
    monkeypatch.setattr(phrases, "_CHUNK", 1000)
    chunks = list(phrases._chunks([text.encode(), b"six seven"]))
    assert b"".join(chunks).replace(b"\n", b"") == (text + "six seven").replace("\n", "").encode() and len(chunks) > 20
    seen = sum(len(phrases.Words(c, "en")) for c in chunks)
    assert seen == len(text.split()) + 2
    assert all(not c.endswith((b"on", b"tw", b"fou")) for c in chunks)


def test_phrases_of_no_documents(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, [(1, "a b c", "s")])).count() == 0
