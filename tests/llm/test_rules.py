"""Quality rules against a plain re-count, and the ratio against its formula."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    at = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if at[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(covered)


def test_statistics():
    rng = random.Random(4)
    texts = [None, "", " \n", "a b", "a a a a", "x\x1cy \x85 \xa0 z", "ä ö\nä ö\n\nä ö\n \n", "<| |> ## 🙂"]
    texts += ["".join(rng.choice(["a", "b", "é", " ", " ", "\n", "#", "\t", "\x0b", "🙂"]) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    for t in texts:
        assert rules.statistics(t) == brute(t), t


def grams(word):
    s = f"\x02{word}\x03"
    return [s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)]


def hashed(word):
    return rules.features([word.encode()])[0].tolist()


def test_score_is_the_mean_log_ratio(spark):
    texts = {1: "good words here", 2: "good text éà", 3: "bad### stuff!!", 4: None, 5: "", 6: "bad### good"}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("kept", F.lit("mine"))
    good = spark.createDataFrame([(1,), (2,), (2,), (None,)], "doc_id long")
    out = rules.apply_rules(d, good)
    assert out.columns == ["doc_id", "text", *rules.ADDED]

    counts = {k: Counter(g for i, t in texts.items() if k == "raw" or i in (1, 2) for w in (t or "").split() for g in hashed(w)) for k in ("good", "raw")}
    total = {k: sum(c.values()) + rules.PRIOR * rules.BUCKETS for k, c in counts.items()}
    ratio = lambda g: math.log((counts["good"][g] + rules.PRIOR) / total["good"]) - math.log((counts["raw"][g] + rules.PRIOR) / total["raw"])
    for r in out.collect():
        gs = [g for w in (r.text or "").split() for g in hashed(w)]
        assert math.isclose(r.score, sum(map(ratio, gs)) / max(1, len(gs)), abs_tol=1e-8)
        assert r.base_failed and not r.kept


def test_features_do_not_depend_on_the_other_words():
    words = ["a", "ab", "abc", "é🙂", "x" * 40]
    every, owner = rules.features([w.encode() for w in words])
    for i, w in enumerate(words):
        alone, _ = rules.features([w.encode()])
        assert np.array_equal(np.sort(every[owner == i]), np.sort(alone)) and len(alone) == len(grams(w))


def test_documents_held_against_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = rules.apply_rules(d, labels.where("quality = 1").select("doc_id"))
    rows = out.join(labels, "doc_id").collect()
    assert {r.kept for r in rows if r.quality == 0 and not r.base_failed} == {False}
    assert {r.kept for r in rows if r.quality == 1 and not r.base_failed} == {True}
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_empty_table_and_no_target(spark):
    d = spark.createDataFrame([(1, "a b c " * 30 + " ".join(f"w{i}" for i in range(200)))], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert [r.kept for r in rules.apply_rules(d, none).collect()] == [True]
    assert rules.apply_rules(d.limit(0), none).count() == 0


def test_target_is_a_bounded_sample_and_no_text_is_shuffled(spark):
    docs = spark.range(0, 2000, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"))
    good = spark.range(0, 2000).select(F.col("id").alias("doc_id")).unionByName(spark.createDataFrame([(None,), (3,)], "doc_id long"))
    assert rules.trusted(good).count() == 2000
    some = rules.trusted(good, size=500)
    assert 400 < some.count() < 600 and sorted(some.collect()) == sorted(rules.trusted(good.repartition(3), size=500).collect())
    plan = rules.ngram_counts(docs, good, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_every_good_document_counts(spark):
    """More good documents than any bound on ids that travel: all of them are counted, by either join."""
    docs = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"))
    good = docs.select("doc_id").where("doc_id >= 4000")
    for limit in (rules.BROADCAST_IDS, 1000):
        counts = rules.ngram_counts(docs, good, "doc_id", "text", limit)
        assert counts.count() and {(r.target, r.raw) for r in counts.collect()} == {(56_000, 60_000)}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
