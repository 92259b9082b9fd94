"""Operators 3, 4 and 9: similarity join, top-k search, near-duplicate vectors."""

from __future__ import annotations

import inspect
import random

import numpy as np

from churnlab.llm import hyperplanes, jaccard, topk
from churnlab.llm.components import connected_components

from .helpers import Union, documents, tokens, words


def shingles(text):
    w = [t.translate({c: c + 32 for c in range(65, 91)}) for t in tokens(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_classes(rows):
    union, sets = Union(), [(i, shingles(t)) for i, t, _ in rows]
    for k, (i, a) in enumerate(sets):
        union.root(i)
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                union.join(i, j)
    return sorted((i, len(a), union.root(i)) for i, a in sets)


def edited(text, rate, seed):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > rate else w + "x" for w in text.split(" "))


def test_similarity_classes_match_brute_force(spark):
    base, passage = words(146, 1), words(60, 2)
    rows = [(i, edited(base, 0.03, i), "s") for i in range(60)]  # near copies, some below the threshold
    rows += [(100 + i, passage + " " + words(5 + 4 * i, i), "s") for i in range(30)]  # a shared passage
    rows += [(200 + i, words(40, 300 + i // 2), "s") for i in range(10)]  # exact copies
    rows += [(300 + i, edited(words(200, 400 + i // 3), 0.02, i), "s") for i in range(30)]
    rows += [(400, "", "s"), (401, None, "s"), (402, " \n\t", "s"), (403, "Two words", "s"), (404, "two WORDS", "s")]
    rows += [(405, words(30000, 7), "s"), (406, words(30000, 7) + " more", "s"), (407, "é È " * 9, "s")]
    rows += [(407, "é È " * 9, "s"), (408, "É È " * 9, "s"), (-3, words(40, 300), "s")]
    got = jaccard.similarity_classes(documents(spark, rows), cell=16, members=8, pivots=1, rounds=1)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == brute_classes(rows)


def test_similarity_of_empty_and_nameless(spark):
    assert jaccard.similarity_classes(documents(spark, [])).count() == 0
    text = words(20, 1)
    got = jaccard.similarity_classes(documents(spark, [(None, text, "s"), (4, text, "s"), (None, "x", "s")]))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(
        map(str, [(None, 16, 4), (4, 16, 4), (None, 1, None)])
    )


def test_block_bound_opens_only_qualifying_blocks():
    import pandas as pd

    sets = [jaccard.shingle_set(words(50, s)) for s in (0, 1, 2, 0)]
    near = jaccard.shingle_set(words(50, 0) + " one more")
    far = jaccard.shingle_set(words(50, 7))
    block = jaccard.Block(sets)
    assert block.similar(near, 75).tolist() == [0, 3] and block.similar(far, 75).tolist() == []
    assert block.similar(near, 99).tolist() == []
    for i, s in enumerate(sets):  # the counts are exact
        share = len(set(s.tolist()) & set(near.tolist())) / len(set(s.tolist()) | set(near.tolist()))
        assert (i in block.similar(near, 75)) == (share >= 0.75)
    # one link a group, none to the own group
    rows = [(7, 0, i, i % 3, s.tobytes()) for i, s in enumerate(sets)] + [(7, 1, 9, 9, near.tobytes())]
    rows += [(7, 1, 10, 0, near.tobytes()), (8, 0, 5, 5, sets[0].tobytes()), (8, 1, 6, 6, far.tobytes())]
    frame = pd.DataFrame(rows, columns=["block", "role", "id", "comp", "tokens"])
    out = list(jaccard._open_blocks(75)(iter([frame])))
    assert [tuple(r) for r in out[0].itertuples(index=False)] == [(9, 3)]


def test_links_of_a_family_do_not_grow_with_its_square(spark, monkeypatch):
    import pandas as pd

    # a block whose members and queries are all alike: a forest over the groups
    near = [jaccard.shingle_set(words(100, 0) + " w%d" % i).tobytes() for i in range(60)]
    rows = [(7, 0, i, i, s) for i, s in enumerate(near)] + [(7, 1, i, i, s) for i, s in enumerate(near)]
    rows += [(8, 0, 100, 1, near[0]), (8, 1, 101, 2, near[1])]  # the next block starts anew
    frame = pd.DataFrame(rows, columns=["block", "role", "id", "comp", "tokens"])
    links = pd.concat(jaccard._open_blocks(75)(iter([frame.iloc[:70], frame.iloc[70:]])))
    assert len(links) == 60 and tuple(links.iloc[-1]) == (101, 100)
    union = Union()
    for a, b in links.itertuples(index=False):
        union.join(a, b)
    assert {union.root(i) for i in range(60)} == {0}

    # variants of one text, whose pivots are within reach of few of them
    base, counts, whole = words(150, 1), [], jaccard.connected_components
    monkeypatch.setattr(jaccard, "connected_components", lambda e: counts.append(e.count()) or whole(e))
    rows = [(i, edited(base, 0.022, i), "s") for i in range(150)]
    got = jaccard.similarity_classes(documents(spark, rows), pivots=1)
    assert sorted(map(tuple, got.collect())) == brute_classes(rows)
    assert sum(counts) <= 4 * len(rows)


def test_cells_compare_groups_not_a_family_with_itself(spark):
    rows = [(1, i, 5) for i in range(400)] + [(1, 400 + i, 400 + i) for i in range(12)]  # a family, 12 others
    rows += [(2, i, i // 3) for i in range(60)] + [(3, i, 8) for i in range(90)] + [(4, 1, 1), (4, 2, 1), (4, 3, 3)]
    frame = spark.createDataFrame(rows, "key long, rep long, comp long")
    got = [r.asDict() for r in jaccard._cells_between_groups(frame, 16).collect()]
    cells = {}
    for r in got:
        cells.setdefault((r["key"], r["i"], r["j"]), []).append(r)
    met = {}
    for (key, i, j), held in cells.items():
        assert len({r["rep"] for r in held}) == len(held) <= 4 * 16
        for x, a in enumerate(held):
            for b in held[x + 1 :]:
                if {a["chunk"], b["chunk"]} == {i, j} and a["comp"] != b["comp"]:
                    pair = (key, *sorted((a["rep"], b["rep"])))
                    met[pair] = met.get(pair, 0) + 1
    wanted = {(k, *sorted((a, b))) for k, a, c in rows for k2, b, d in rows if k == k2 and c != d}
    assert met == dict.fromkeys(wanted, 1)
    assert not [r for r in got if r["key"] == 3]  # one group: nothing to compare
    assert len([r for r in got if r["key"] == 1]) <= 400 + 12 * 27


def test_components(spark):
    rng, union = random.Random(5), Union()
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(180)]
    edges += [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + i, 2001 + i) for i in range(60)] + [(7000, 7000)]
    for a, b in edges:
        union.join(a, b)
    frame = spark.createDataFrame([*edges, (None, 5)], "a long, b long")
    got = {r["id"]: r["component"] for r in connected_components(frame).collect()}
    assert got == {x: union.root(x) for e in edges for x in e}
    assert connected_components(frame.limit(0)).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, code string, dim int, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 9, "y") for i, v in rows], VECTORS)


NAN, INF = float("nan"), float("inf")
ODD = [(900, None), (901, [0.0] * 8), (902, [1.0, NAN] + [0.0] * 6), (903, [INF] + [1.0] * 7),
       (904, [1.0, None] + [0.0] * 6), (905, []), (None, [1.0] * 8), (906, [1.0, 2.0])]


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    plain = [(i, [float(x) for x in rng.integers(-3, 4, 8) / 4]) for i in range(400)]  # many ties
    rows = plain + ODD + [(50, plain[50][1])]
    frame = vectors(spark, rows)
    got = topk.top_k(frame, frame.where("vec_id % 50 = 0"), 5, block=64, query_block=3).collect()
    known = [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v in rows if i is not None and usable(v)]
    want = []
    for n, (q, u) in enumerate(known):
        if q % 50 == 0:  # every row but its own is a candidate, also one of the same id
            scores = [(-sum(a * b for a, b in zip(u, v)), i) for m, (i, v) in enumerate(known) if m != n and len(v) == len(u)]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:5])]
    want.sort()
    assert sorted(map(tuple, got)) == want
    few = frame.where("vec_id < 3")
    assert topk.top_k(few, few.where("vec_id = 0"), 5).count() == 2
    assert topk.top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_top_k_keeps_the_rows_of_a_repeated_id(spark):
    rows = [(7, [0.5, 0.5]), (7, [0.9, 0.9]), (7, [0.9, 0.9]), (1, [1.0, 1.0]), (2, [0.1, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(frame, frame.where("vec_id in (1, 7)"), k=3)
    whole = [(i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v in rows]
    want = []
    for n, (i, v) in enumerate(whole):
        if i in (1, 7):
            best = sorted((-(v[0] * w[0] + v[1] * w[1]), j) for m, (j, w) in enumerate(whole) if m != n)[:3]
            want += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_threshold_algorithm_stops_early_and_stays_exact():
    rng = np.random.default_rng(2)
    block = rng.integers(0, 4, (5000, 6)).astype(np.int64)
    block[17] = 500  # far ahead on every list
    order = np.argsort(block, axis=0, kind="stable")
    ids = np.arange(5000)
    query = np.array([5, 1, 0, 2, 7, 3])
    got, scores = topk.best_of_block(ids, block, order, -1, query, 1)
    assert (got[0], scores[0]) == (17, 500 * query.sum())
    for sign in (1, -1):
        for k in (1, 5, 6000):
            want = sorted(zip(-(block @ (sign * query)), ids))[:k]
            got, scores = topk.best_of_block(ids, block, order, -1, sign * query, k)
            assert [(-s, i) for i, s in zip(got, scores)] == want
    zero, scores = topk.best_of_block(ids, block, order, 0, query * 0, 3)
    assert zero.tolist() == [1, 2, 3] and scores.tolist() == [0, 0, 0]


def test_near_vectors_match_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, base = [], rng.standard_normal((25, 8))
    for i in range(300):
        v = base[i % 25] + rng.standard_normal(8) * (0.02 if i % 3 else 0.3)
        rows.append((i, [float(np.float32(x)) for x in v]))
    rows += [(400 + i, rows[7][1]) for i in range(30)]  # equal vectors
    rows += [(500 + i, [float(np.float32(x)) for x in base[3] + rng.standard_normal(8) * 0.01]) for i in range(80)]
    all_rows = rows + ODD
    got = {r[0]: tuple(r[1:]) for r in hyperplanes.near_vectors(vectors(spark, all_rows), tables=40, cell=32).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    union = Union()
    for a, b in zip(*np.nonzero(linked)):
        union.join(rows[a][0], rows[b][0])
    for k, (i, _) in enumerate(rows):
        assert got[i] == (int(linked[k].sum()) - 1, union.root(i), union.root(i) == i)
    for i, _ in ODD:
        assert got[i] == (0, i, True)
    assert len(got) == len(all_rows)
    assert hyperplanes.near_vectors(vectors(spark, [])).count() == 0


def test_recall_by_cosine_with_the_parameters_of_the_query():
    bits, tables, seed = (inspect.signature(hyperplanes.near_vectors).parameters[n].default for n in ("bits", "tables", "seed"))
    rng = np.random.default_rng(8)
    for cosine, least in ((0.95, 0.99), (0.96, 0.995), (0.98, 0.999), (0.999, 1.0)):
        a, b = rng.standard_normal((2, 3000, 64))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b = cosine * a + (1 - cosine**2) ** 0.5 * b / np.linalg.norm(b, axis=1, keepdims=True)
        planes = hyperplanes.planes(64, bits * tables, seed)
        x, y = (((v @ planes) >= 0).reshape(len(v), tables, bits) for v in (a, b))
        assert (x == y).all(axis=2).any(axis=1).mean() >= least


def test_no_link_below_the_threshold(spark):
    a = [1.0, 0.0]
    rows = [(1, a), (2, [0.951, (1 - 0.951**2) ** 0.5]), (3, [0.949, -((1 - 0.949**2) ** 0.5)])]
    got = {r[0]: r[1] for r in hyperplanes.near_vectors(vectors(spark, rows), tables=200, bits=4).collect()}
    assert got == {1: 1, 2: 1, 3: 0}
