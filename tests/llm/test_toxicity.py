"""Toxicity: the label model on planted voters, held-out results, odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity as tox
from strata.llm.common import held_out


def test_label_model_finds_accuracies_and_dependent_voters():
    rng = np.random.default_rng(3)
    y = rng.random(60_000) < 0.15
    fire = np.where(y[:, None], 0.6, 0.03)
    v = rng.random((len(y), tox.VOTERS)) < fire
    v[:, 5] = np.where(rng.random(len(y)) < 0.9, v[:, 4], v[:, 5])  # voter 5 copies voter 4
    patterns, n = np.unique((v.astype(int) << np.arange(tox.VOTERS)).sum(axis=1), return_counts=True)
    model = tox.LabelModel(patterns, n)
    assert abs(model.prior[1] - 0.15) < 0.01
    for j in range(tox.VOTERS):
        assert abs(v[y, j].mean() - (v[:, j] * 1.0 @ model.expect(v.astype(int))) / model.expect(v.astype(int)).sum()) < 0.03
    assert model.parent[5] == 4 or model.parent[4] == 5
    assert sum(p >= 0 for p in model.parent) <= 2
    assert ((model.expect(v.astype(int)) >= 0.5) == y).mean() > 0.98


def test_hits_by_hand():
    hits = tox.Hits(["idiot", "lowe-", "xyz"])
    entries, distinct, densest, n = hits.of("Idiot! loweind LOWEISCHAFT idiot " + "w " * 60 + "idiot")
    assert (entries, distinct, densest, n) == ([0, 1], 3, 4, 65)
    assert hits.of(None) == ([], 0, 0, 0)


@pytest.fixture(scope="module")
def model(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return d, tox.learn(d, spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where(~held_out()))


def test_held_out_documents(spark, model):
    d, m = model
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where(held_out())
    rows = tox.score(d, m).join(labels, "doc_id").collect()
    assert len(rows) > 40
    caught = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(clean) <= 0.05 and (not caught or np.mean(caught) >= 0.7)


def test_odd_rows(spark, model):
    d, m = model
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "stupid idiot moron scum trash loser"), (2, "stupid idiot moron scum trash loser"), (3, "w " * 200_000)], "doc_id long, text string").withColumn("Score", F.lit(1))
    out = tox.score(odd, m)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    assert [r.predicted for r in out.orderBy("doc_id").collect()] == [0, 0, 1, 1, 0]
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert tox.score(odd.limit(0), m).count() == 0
    none = tox.learn(odd, spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int"))
    assert {r.score for r in tox.score(odd, none).collect()} == {0.0}
