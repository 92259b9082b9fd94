"""Operators 7 and 8, and the corpus pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from churnlab.llm import jaccard, quality, toxicity

from .helpers import documents, tokens, words

TOXIC = ("vilegrub", "dirtlump", "nastyhog")


def corpus(n: int = 500):
    """(doc_id, text, source), quality and toxic labels of invented documents."""
    rows, marks = [], []
    for i in range(n):
        text, rng = words(30 + i % 50, i).capitalize() + ".", random.Random(i)
        good, toxic = i % 6 != 0, i % 5 == 1
        if not good:
            text = ("SHOUT!! " * 40) if i % 12 else "spam spam " * 30
        if toxic:
            parts = text.split(" ")
            parts.insert(rng.randrange(len(parts)), rng.choice(TOXIC))
            text = " ".join(parts)
        rows.append((i, text, f"s{i % 4}"))
        marks.append((i, int(good), int(toxic)))
    return rows, marks


def labels(spark, marks):
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text", "1 AS score")


def test_toxicity_is_learnt_from_subwords(spark):
    rows, marks = corpus()
    odd = [(9000, None, "s"), (9001, "", "s"), (9002, "!!! ???", "s"), (9003, "fine words " * 20000, "s"),
           (9004, "fine words " * 20000 + "vilegrub", "s"), (None, "vilegrub here", "s"), (9005, "you vilegrubs and dirtlumpp", "s")]
    docs = documents(spark, rows + odd + rows[:1])
    marks = marks + [(9001, None, None), (None, 1, 1), (77777, 1, 1), marks[0]]
    model = toxicity.fit(docs, labels(spark, marks))
    scored = docs.select("doc_id", toxicity.score_udf(model)("text").alias("p")).collect()
    assert len(scored) == len(rows) + len(odd) + 1
    p = {r["doc_id"]: r["p"] for r in scored}
    assert all(0 <= v <= 1 for v in p.values())
    held = [(p[i] >= 0.3) == bool(t) for i, _, t in marks[:500] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 80 and np.mean(held) > 0.97
    assert max(p[9000], p[9001], p[9002], p[9003]) < 0.3 <= min(p[9004], p[None], p[9005])


def test_toxicity_without_two_classes(spark):
    docs = documents(spark, [(1, "a b", "s"), (2, None, "s")])
    for marks, score in (([], 0.0), ([(1, 1, 1)], 1.0), ([(1, 1, 0)], 0.0)):
        model = toxicity.fit(docs, labels(spark, marks), held_out=9)
        assert {r[0] for r in docs.select(toxicity.score_udf(model)("text")).collect()} == {score}


def test_toxicity_learns_from_all_words(spark, monkeypatch):
    # 70,000 clean words of two documents each come before the toxic ones, which one document holds each
    plain = [f"a{i:x}q" for i in range(70_000)]
    rows = [(i, " ".join(plain[(i // 2) * 700 : (i // 2 + 1) * 700]), "s") for i in range(200)]
    rows += [(1000 + i, f"zvilegrub{'abcdefgh'[i % 8]}{i} zdirtlump{i}", "s") for i in range(100)]
    marks = [(i, 1, int(i >= 1000)) for i, _, _ in rows]
    seen, train = [], toxicity.train_subwords

    def trained(words, *rest):
        seen.extend(words)
        return train(words, *rest)

    monkeypatch.setattr(toxicity, "train_subwords", trained)
    docs = documents(spark, rows)
    model = toxicity.fit(docs, labels(spark, marks))
    learnt = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2 and zlib.crc32(f"curve:{i}".encode()) % 4]
    assert seen == sorted({w.encode() for t in learnt for w in t.split()})
    p = model.scores(pd.Series([t for _, t, _ in rows]))
    held = [(p[k] >= 0.3) == (i >= 1000) for k, (i, _, _) in enumerate(rows) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and np.mean(held) > 0.97


def test_toxicity_scores_by_brute_force(spark):
    # byte by byte: n-grams of each padded word, their margins averaged, the largest word, the curve
    rng = np.random.default_rng(4)
    model = toxicity.ToxicModel(rng.normal(size=1 << toxicity.BUCKET_BITS), -0.7, 1.3, -0.2)

    def bucket(gram):
        code = 0
        for n, byte in enumerate(gram, 1):
            code = (code * 0x01000193 + byte + n) % 2**32
        return ((code ^ (code >> 15)) * 0x9E3779B1) % 2**32 >> (32 - toxicity.BUCKET_BITS)

    def score(text):
        clean = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (text or "").lower())
        found = []
        for w in {w.encode() for w in clean.split(" ") if w}:
            line = b" " + w + b" "
            grams = [line[i : i + n] for n in toxicity.SIZES for i in range(len(line) - n + 1)]
            found.append(np.mean([model.margins[bucket(g)] for g in grams]) + model.bias)
        z = model.slope * max(found, default=model.bias) + model.offset
        return 1 / (1 + np.exp(-z))

    texts = [None, "", "!? ...", "a", "Ünï-codé wörds", "one Two, three", "x" * 5000, words(400, 3), "a a\tb\nc", "a"]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = docs.select("doc_id", toxicity.score_udf(model)("text").alias("p")).collect()
    assert {r["doc_id"]: pytest.approx(r["p"], abs=1e-9) for r in got} == {i: score(t) for i, t in enumerate(texts)}


def test_toxicity_margins_that_tell_nothing():
    # equal or reversed margins: the share of toxic labels, for wordless texts too
    label = np.array([1.0, 0, 0, 0])
    for margin in (np.zeros(4), np.array([-1.0, 0, 1, 2])):
        slope, offset = toxicity.logistic_curve(margin, label)
        model = toxicity.ToxicModel(np.ones(1 << toxicity.BUCKET_BITS), 0.4, slope, offset)
        p = model.scores(pd.Series([None, "", "!!", "some words"]))
        assert np.isfinite(p).all() and ((0 < p) & (p < 0.5)).all()


def test_inner_losses_read_no_held_out_label(spark):
    rows, marks = corpus(240)
    docs, grid = documents(spark, rows), [{"epochs": 8}, {"epochs": 8, "prior": 500.0}]
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in marks]
    found = [toxicity.inner_losses(docs, labels(spark, m), grid, rounds=1) for m in (marks, flipped)]
    assert found[0] == pytest.approx(found[1]) and found[0][0] < found[0][1] < 1
    assert np.isnan(toxicity.inner_losses(docs, labels(spark, []), grid[:1], rounds=1)).all()


def test_training_in_runs_is_training_at_once(monkeypatch):
    vocabulary = sorted({w.encode() for w in words(3000, 5).split()})
    toxic = np.array([float(b"ab" in w) for w in vocabulary])
    got = []
    for size in (1 << 18, 200, 1):
        monkeypatch.setattr(toxicity, "CHUNK_GRAMS", size)
        got.append(toxicity.train_subwords(vocabulary, toxic, 2.0 - toxic))
    for margins, bias in got[1:]:
        assert np.allclose(margins, got[0][0], atol=0.05) and bias == pytest.approx(got[0][1], abs=0.05)


def test_subwords_of_words():
    buckets, owners = toxicity.subwords([b"ab", b"a", b"hello"])
    # " ab " has 2 + 1 n-grams of 3 and 4 bytes, " a " one of 3
    assert Counter(owners.tolist()) == {0: 3, 1: 1, 2: 5 + 4 + 3 + 2}
    again, _ = toxicity.subwords([b"hello"])
    assert sorted(buckets[owners == 2]) == sorted(again)
    assert toxicity.words_of("Ab, aB! Ünï-x2") == {b"ab", "ünï".encode(), b"x2"}
    a, b = (np.array([1, 2.0, 3, 4]), np.array([0, 0, 1, 1.0]))
    slope, offset = toxicity.logistic_curve(a, b)
    assert slope > 0 and -offset / slope == pytest.approx(2.5, abs=0.1)


def test_quality_matches_gaussian_densities(spark):
    rows, marks = corpus()
    odd = [(9000, None, "s"), (9001, "", "s"), (9002, "x " * 300000, "s"), (None, "Plain words.", "s")]
    docs = documents(spark, rows + odd + rows[:1])
    marks = marks + [(9001, None, None), (None, 1, 1), (77777, 1, 1), marks[0]]
    measured = quality.measured(docs)
    model = quality.fit(measured, labels(spark, marks))
    scored = measured.select("doc_id", quality.score_udf(model)("_x").alias("p")).collect()
    p = {r["doc_id"]: r["p"] for r in scored}
    assert len(scored) == len(rows) + len(odd) + 1 and all(0 <= v <= 1 for v in p.values())
    held = [(p[i] >= 0.3) == bool(q) for i, q, _ in marks[:500] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 60 and np.mean(held) > 0.98
    # the same model from the definitions (a repeated document counts twice)
    kept = {i: q for i, q, _ in marks[:500] if zlib.crc32(str(i).encode()) % 5}
    learnt = [(t, kept[i]) for i, t, _ in rows + rows[:1] if i in kept]
    x, y = np.array([quality.statistics(t) for t, _ in learnt]), np.array([q for _, q in learnt])
    pooled = sum((y == k).sum() * np.cov(x[y == k].T, bias=True) for k in (0, 1)) / len(y)
    logs = []
    for k in (0, 1):
        cov = 0.95 * np.cov(x[y == k].T, bias=True) + 0.05 * pooled + 1e-3 * np.eye(x.shape[1])
        gap = np.array([quality.statistics(rows[7][1])]) - x[y == k].mean(axis=0)
        logs.append(np.log((y == k).mean()) - 0.5 * (gap @ np.linalg.solve(cov, gap.T) + np.linalg.slogdet(cov)[1]))
    assert p[7] == pytest.approx(float(1 / (1 + np.exp(logs[0] - logs[1])).item()), abs=1e-6)


def test_quality_without_two_classes(spark):
    rows = quality.measured(documents(spark, [(1, "a b", "s"), (2, None, "s")]))
    for marks, score in (([], 0.5), ([(1, 1, 1)], 1.0), ([(1, 0, 0)], 0.0)):
        model = quality.fit(rows, labels(spark, marks), held_out=9)
        assert {r[0] for r in rows.select(quality.score_udf(model)("_x")).collect()} == {score}
    assert quality.statistics(None) == quality.statistics("") and len(quality.NAMES) == len(quality.statistics("x"))


def test_pipeline_stages(spark, tmp_path):
    rows, marks = corpus()
    copies = [(1000 + i, rows[i][1], "s9") for i in range(100)]  # exact copies
    copies += [(2000 + i, rows[i][1] + " end", "s9") for i in range(100)]  # near copies of the longer ones
    odd = [(3000, None, None), (3001, "", "s1"), (None, words(50, 99999), "s1"), (None, words(50, 99999), "s1")]
    docs = documents(spark, rows + copies + odd)
    labels(spark, marks).write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    columns, now, results = docs.columns, docs, {}
    for name, function in corpus_pipeline.STAGES:
        function(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        results[name] = now.toPandas()
        if name != "packing":
            assert now.columns == columns
    first = results["toxicity"]
    toxic = {i for i, _, t in marks if t}
    left = {int(i) for i in first["doc_id"].dropna() if i < 500}
    assert len(left & toxic) <= 2 and len(left) >= 500 - len(toxic) - 2
    second = {int(i) for i in results["quality"]["doc_id"].dropna()}
    bad = {i for i, q, _ in marks if not q}
    assert len(second & bad) <= 2 and len({i for i in left if i not in bad} - second) <= 2
    # near-duplicates, against all pairs
    texts = {i: t for i, t in zip(results["quality"]["doc_id"], results["quality"]["text"]) if not pd.isna(i)}
    sets = {i: set(jaccard.shingle_set(t).tolist()) for i, t in texts.items()}
    kept = {int(i) for i in results["near_duplicates"]["doc_id"].dropna()}
    near = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    for i, s in sets.items():
        smaller = [j for j, o in sets.items() if j < i and near(s, o)]
        assert (int(i) in kept) == (not smaller)
    assert results["near_duplicates"]["doc_id"].isna().sum() == 1  # equal rows without an id
    # the mix: words near the targets, at most three copies
    mixed = results["mixing"]
    sizes, taken = defaultdict(int), defaultdict(int)
    for frame, total in ((results["near_duplicates"], sizes), (mixed, taken)):
        for text, source in zip(frame["text"], frame["source"]):
            total[source if isinstance(source, str) else None] += len(tokens(text if isinstance(text, str) else None))
    assert max(Counter(mixed["doc_id"].dropna()).values()) <= 3
    ranked = sorted(s for s in sizes if s is not None) + [None]
    total = sum(sizes.values())
    free = {s: (5, 2, 1)[k % 3] for k, s in enumerate(s for s in ranked if s in sizes)}
    room, capped = total, {}
    while over := [s for s in free if s not in capped and free[s] * room > 3 * sizes[s] * sum(w for q, w in free.items() if q not in capped)]:
        capped[over[0]] = 3 * sizes[over[0]]
        room = total - sum(capped.values())
    for s in free:
        want = capped.get(s, free[s] * room / max(1, sum(w for q, w in free.items() if q not in capped)))
        assert abs(taken[s] - want) <= 15
    packed = results["packing"]
    assert len(packed) == len(mixed) and (packed["length"] <= packed["bucket_length"]).all()
    whole = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert sorted(map(str, whole.itertuples(index=False))) == sorted(map(str, packed.itertuples(index=False)))


def test_near_duplicates_keep_unrelated_rows_of_an_id(spark):
    one, two = words(60, 1), words(60, 2)
    rows = [(1, one, "a"), (1, two, "a"), (1, one, "a"), (2, two + " end", "b"), (None, one, "c"), (None, words(60, 3), "c")]
    rows += [(5, "", "a"), (6, None, "a"), (None, None, "a")]
    kept = corpus_pipeline.one_of_each_class(spark, documents(spark, rows), "").collect()
    got = sorted(str((r["doc_id"], r["text"])) for r in kept)
    assert got == sorted(map(str, [(1, one), (1, two), (None, words(60, 3)), (5, ""), (6, None), (None, None)]))


def test_pipeline_of_no_documents(spark, tmp_path):
    now = documents(spark, [])
    labels(spark, []).write.parquet(f"{tmp_path}/labels.parquet")
    for _, function in corpus_pipeline.STAGES:
        now = function(spark, now, str(tmp_path))
        assert now.count() == 0
