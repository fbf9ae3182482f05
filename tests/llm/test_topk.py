"""Exact top-k against all inner products."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import topk


def brute(rows, k, chosen):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = np.array([math.floor(256 * np.float64(np.float32(x))) for x in v], dtype=np.int64)
    out = set()
    for q in usable:
        if chosen(q):
            best = sorted((-int(usable[q] @ usable[i]), i) for i in usable if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


def agree(spark, rows, k=5, every=5, **options):
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = topk.top_k(d, F.col("id") % every == 0, k=k, **options).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute([(r[0], r[1]) for r in rows], k, lambda q: q % every == 0)


def test_clusters_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (6, 8))
    vectors = [(centres[i % 6] * (1 + i % 3) + rng.normal(0, 0.05, 8)).astype(np.float32).tolist() for i in range(400)]
    vectors += [vectors[3]] * 60 + [[0.0] * 8] * 20 + [[0.5] + [0.0] * 7] * 3
    ids = list(range(len(vectors)))
    random.Random(2).shuffle(ids)
    rows = [(i, v, 0) for i, v in zip(ids, vectors, strict=True)]
    agree(spark, rows, pivots=8, sample=50, block=16)
    agree(spark, rows, k=3, pivots=1, sample=1, block=10_000)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (1, [0.5, -0.25], 0), (2, None, 0), (1 << 60, [0.1, 3.0], 0), (3, [None, 1.0], 0), (4, [nan, 1.0], 0), (6, [inf, 0.0], 0), (None, [9.0, 9.0], 0), (10, [-3.0, 0.001], 0), (5, [1.0, 2.0], 0)]
    agree(spark, rows)
    agree(spark, rows[:1])
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    assert topk.top_k(d.limit(0), F.col("id") % 5 == 0).count() == 0
    assert topk.top_k(d.where("vec_id = 2"), F.col("id") % 2 == 0).count() == 0


def test_given_vectors(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in d.collect()]
    got = {tuple(r) for r in topk.top_k(d, F.col("id") % 50 == 0).collect()}
    assert got == brute(rows, 5, lambda q: q % 50 == 0)


def test_large_components(spark):
    rows = [(i, [float(i * 150_000), 1.0], 0) for i in range(-6, 7)]
    agree(spark, rows)
    rows += [(i, [float(i << 16), -1.0], 0) for i in range(20, 31)]
    agree(spark, rows)
    agree(spark, rows[13:])


def test_scores_beyond_64_bits_become_the_end_of_the_range(spark):
    rows = [(0, [1e30, 1.0]), (1, [2.0, 0.5]), (2, [-1e30, 0.0]), (3, [-3.0, 1.0]), (5, [1.0, 1.0]), (7, [3e30, 2.0]), (8, [1e308, 1e308])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(d, F.col("id") % 5 == 0).collect()}
    most, least = (1 << 63) - 1, -(1 << 63)
    assert {n: got[0, n] for n in range(1, 6)} == {1: (1, most), 2: (5, most), 3: (7, most), 4: (2, least), 5: (3, least)}
    assert {n: got[5, n] for n in range(1, 6)} == {1: (0, most), 2: (7, most), 3: (1, 256 * 256 * 2 + 256 * 128), 4: (3, 256 * 256 * -3 + 65536), 5: (2, least)}
    assert len(got) == 10


def test_queries_meet_few_blocks_and_stop_early(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (40, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    vectors = (centres[np.arange(6_000) % 40] + rng.normal(0, 0.02, (6_000, 16))).astype(np.float32)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    rounds = []
    got = topk.top_k(d, F.col("id") % 50 == 0, pivots=40, sample=500, block=16, rounds=rounds).collect()
    whole = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    for r in got:
        assert r.score == whole[r.query_id] @ whole[r.vec_id]
    scores = whole[::50] @ whole.T
    scores[np.arange(120), np.arange(0, 6_000, 50)] = np.iinfo(np.int64).min
    assert sorted(r.score for r in got) == sorted(np.sort(scores, axis=1)[:, -5:].ravel().tolist())
    blocks = 6_000 // 16
    assert rounds[0] <= 120 * topk.SEEDS
    assert sum(rounds) < 0.06 * 120 * blocks  # a few of a hundred blocks, and rounds end before the last annulus
    assert rounds[-1] == 0 and len(rounds) <= 4


def test_many_equal_distances(spark):
    rows = [(i, [float(i == j) * (1 + i % 2) for j in range(60)], 0) for i in range(60)]
    agree(spark, rows, pivots=2, sample=4, block=4)
    agree(spark, [(i, [], 0) for i in range(8)])
