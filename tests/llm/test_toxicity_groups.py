"""Toxicity per language: a rare one is learned however many toxic documents the others have."""

from __future__ import annotations

import numpy as np

from strata.llm import toxicity as tox

#: Toxic and clean documents of each language; the rare one has 3% of the toxic ones.
SIZES = {"a": (1_200, 2_400), "b": (40, 120)}


def _documents():
    rng = np.random.default_rng(5)
    rows = []
    for lang, sizes in SIZES.items():
        plain = [f"{lang}{i:03d}word" for i in range(300)]
        marks = [f"{c}{lang}mark" for c in "mnopqr"]
        for label, n in zip((1, 0), sizes, strict=True):
            for _ in range(n):
                words = [*rng.choice(plain, 30), *(rng.choice(marks, 2, replace=False) if label else ())]
                rows.append((len(rows), lang, label, " ".join(rng.permutation(words))))
    return rows


def test_held_out_recall_of_each_language(spark):
    docs = spark.createDataFrame(_documents(), "doc_id long, lang string, toxic int, text string").cache()
    model = tox.learn(docs, docs.where("doc_id % 4 > 0").select("doc_id", "toxic"))
    rows = tox.score(docs.where("doc_id % 4 = 0"), model).collect()
    for lang in SIZES:
        caught = [r.predicted for r in rows if r.lang == lang and r.toxic == 1]
        clean = [r.predicted for r in rows if r.lang == lang and r.toxic == 0]
        assert len(caught) >= 8 and np.mean(caught) >= 0.7, lang
        assert np.mean(clean) <= 0.05, lang


def test_chance_markers_are_no_entries(spark):
    rows = [(i, int(i < 40), f"w{i} " + ("few " if i < 5 else "") + ("often " if i < 10 or 40 <= i < 60 else "") + ("sign " if i < 9 else "")) for i in range(400)]
    sample = spark.createDataFrame(rows, "doc long, label int, text string")
    assert {u for u in tox.mine_lexicon(sample) if "-" not in u} == {"sign"}
