"""Quality classifier: gradients by differences, attention, held-out results, odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import quality
from strata.llm.common import held_out


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net, bag, y = quality.Network(1), np.array([0, 0, 0, 1, 2, 2]), np.array([1.0, 0.0, 1.0])
    x = rng.normal(0, 0.3, (6, quality.GRAMS + quality.STATS))

    def loss():
        p = net.forward(x, bag, 3)["y"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = net.gradients(x, bag, y)
    for k, v in net.p.items():
        for i in list(np.ndindex(v.shape))[:: max(1, v.size // 7)]:
            old, e = v[i], 1e-5
            v[i] = old + e
            up = loss()
            v[i] = old - e
            down = loss()
            v[i] = old
            assert abs((up - down) / (2 * e) - g[k][i]) < 1e-7, (k, i)


def test_attention_sums_to_one_and_a_bag_is_its_passages():
    texts = [("word%d " % i * 200).encode() for i in range(4)] + [b"", None]
    x, owner = quality.describe(texts)
    assert np.bincount(owner).tolist() == [4, 4, 4, 4, 1, 1]
    f = quality.Network().forward(x.astype(float), owner, 6)
    assert np.allclose(np.bincount(owner, f["w"]), 1)
    for k in range(6):
        alone, _ = quality.describe(texts[k : k + 1])
        assert np.allclose(alone, x[owner == k], atol=1e-6)


def test_runs_of_passages_score_as_a_whole():
    texts = [("word%d of the %d " % (i, i * 7) * 300).encode() for i in range(5)] + [b"", None, b"  one\x0btwo\n"]
    net = quality.Network(3)
    net.p = {k: v * 3 for k, v in net.p.items()}
    x, owner = quality.describe(texts)
    whole = net.forward(x.astype(float), owner, len(texts))["y"]
    for together in (1, 2, 7, 1000):
        runs = list(quality.described(texts, together))
        assert max(len(r) for r, _ in runs) <= together and sum(len(r) for r, _ in runs) == len(x)
        assert np.allclose(net.scores(runs, len(texts)), whole, atol=1e-9)
    words = (b" \t x\x0cy \xc2\xa0 z\n" * 50).split()
    assert sum(quality.passages_of(b" \t x\x0cy \xc2\xa0 z\n" * 50), []) == words


def test_sample_is_bounded_in_documents_and_passages(spark, monkeypatch):
    """A row that stands a thousand times is learned from once; a text longer than the bound, not at all."""
    seen = []
    monkeypatch.setattr(quality.Network, "fit", lambda self, bags, y: seen.append(([len(b) for b in bags], y.tolist())) or self)
    rows = [(1, "a b c")] * 1000 + [(1, "d e"), (2, "w " * 64 * 30), (None, "n"), (3, None), (4, "x " * 64 * 3), (5, "not labelled")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (4, 1), (None, 1)], "doc_id long, quality int")
    quality.learn(docs, labels, passages=10)
    quality.learn(docs, labels)
    quality.learn(docs, labels, sample=2)
    assert sorted(zip(*seen[0])) == [(1, 0.0), (1, 1.0), (1, 1.0), (3, 1.0)]
    assert sorted(zip(*seen[1])) == [(1, 0.0), (1, 1.0), (1, 1.0), (3, 1.0), (30, 0.0)]
    assert len(seen[2][0]) == 2
    assert quality.learn(docs.limit(0), labels) is None


@pytest.fixture(scope="module")
def weights(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return d, quality.learn(d, spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where(~held_out()))


def test_held_out_documents(spark, weights):
    d, w = weights
    rows = quality.score(d, w).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where(held_out()), "doc_id").collect()
    assert len(rows) > 40 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 1]) >= 0.97


def test_odd_rows(spark, weights):
    d, w = weights
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "the of and"), (2, "the of and"), (3, "w " * 100_000), (4, " \n")], "doc_id long, text string").withColumn("Predicted", F.lit(7)).withColumn("score", F.lit("x"))
    out = quality.score(odd, w)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    got = out.orderBy("doc_id").collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert got[0].score == got[1].score == got[5].score and got[2].score == got[3].score
    kept = quality.keep_good(odd, w)
    assert kept.columns == odd.columns and kept.count() == sum(r.predicted for r in got)
    assert quality.score(odd.limit(0), w).count() == 0
    none = quality.learn(odd, spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int"))
    assert {r.score for r in quality.score(odd, none).collect()} == {0.5}


def test_scores_equal_a_forward_pass_per_document(spark):
    """Each document by itself, passage by passage, with plain sums: the same score."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    weights = {k: v * 3 for k, v in quality.Network(seed=5).p.items()}
    for r in quality.score(d, weights).collect():
        x, owner = quality.describe([(r.text or "").encode() if r.text is not None else None])
        assert set(owner.tolist()) <= {0}
        hidden = [[math.tanh(sum(float(a) * b for a, b in zip(p, column)) + bias) for column, bias in zip(weights["W"].T.tolist(), weights["b"])] for p in x.astype(np.float64).tolist()]
        energy = []
        for h in hidden:
            v = [math.tanh(sum(a * b for a, b in zip(h, column))) for column in weights["V"].T.tolist()]
            u = [1 / (1 + math.exp(-sum(a * b for a, b in zip(h, column)))) for column in weights["U"].T.tolist()]
            energy.append(sum(a * b * c for a, b, c in zip(v, u, weights["a"])))
        share = [math.exp(e - max(energy)) for e in energy]
        bag = [sum(s * h[k] for s, h in zip(share, hidden)) / sum(share) for k in range(len(weights["c"]))] if hidden else [0.0] * len(weights["c"])
        want = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(bag, weights["c"])) + weights["c0"][0])))
        assert abs(r.score - want) < 2e-6 and r.predicted == (r.score >= 0.3)
