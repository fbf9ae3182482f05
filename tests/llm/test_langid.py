"""Language filters: no false negatives, corrected counts, held-out accuracy, odd rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm import langid
from strata.llm.common import held_out


def test_ngrams_are_those_of_the_words():
    words = ["ab", "é", "abcde"]
    names, owner = langid.ngrams(words)
    for i, w in enumerate(words):
        s = f" {w} "
        want = [s[k : k + n] for n in langid.LENGTHS for k in range(len(s) - n + 1) if s[k : k + n] != " "]
        alone, _ = langid.ngrams([w])
        assert len(alone) == len(want) and len(set(alone.tolist())) == len(set(want))
        assert sorted(names[owner == i].tolist()) == sorted(alone.tolist())


def test_every_learned_ngram_is_found_and_others_rarely(spark):
    rows = [("der die das und nicht", "de")] * 5 + [("the and of with that", "en")] * 5 + [("x", None), (None, "de")]
    d = spark.createDataFrame(rows, "text string, lang string")
    langs, masks, false = langid.learn(d, slots=4096, contrast=1e9)
    assert langs == ["de", "en"] and masks.shape == (4096, 1)
    for bit, text in enumerate(("der die das und nicht", "the and of with that")):
        names, _ = langid.ngrams(text.split())
        found = np.bitwise_and.reduce(masks[langid.slot_numbers(names, 4096, langid.HASHES)], axis=0)
        assert ((found[:, 0] >> np.uint64(bit)) & np.uint64(1)).all()
    strange = np.arange(200_000, dtype=np.uint64) * np.uint64(2654435761)
    found = np.bitwise_and.reduce(masks[langid.slot_numbers(strange, 4096, langid.HASHES)], axis=0)[:, 0]
    for bit in (0, 1):
        assert abs(float(((found >> np.uint64(bit)) & np.uint64(1)).mean()) - false[bit]) < 1e-3


def test_more_than_64_languages(spark):
    rows = [(" ".join([chr(0x4E00 + 7 * k) + chr(0x4E01 + 7 * k)] * 3), f"l{k:02d}") for k in range(70)]
    d = spark.createDataFrame(rows, "text string, lang string")
    model = langid.learn(d, slots=1 << 14)
    assert model[1].shape[1] == 2
    assert all(r.lang == r.lang_pred for r in langid.predict(d, model).collect())


def test_odd_rows(spark):
    d = spark.createDataFrame([("the and of", "en"), ("der die das", "de"), ("the and of", "en")], "text string, lang string")
    odd = spark.createDataFrame([(None,), ("",), ("123 !!",), ("́",), ("中文",), ("The AND",)], "text string").withColumn("Score", F.lit("mine")).withColumn("lang", F.lit(None).cast("string"))
    out = langid.predict(odd, langid.learn(d))
    assert out.columns == ["text", "lang", "lang_pred", "score"]
    assert [r.lang_pred for r in out.collect()] == ["und"] * 4 + ["de", "en"]
    nothing = langid.learn(d.limit(0))
    assert [r.lang_pred for r in langid.predict(odd, nothing).collect()] == ["und"] * 6
    assert langid.predict(odd.limit(0), nothing).count() == 0


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.predict(d, langid.learn(d.where(~held_out()))).where(held_out()).collect()
    assert len(out) > 100 and np.mean([r.lang == r.lang_pred for r in out]) >= 0.97


def test_predictions_equal_a_plain_recount(spark):
    """Exact sets of n-grams in plain Python: the same decisions, and the same scores but for the filters' rare false finds."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    learned = d.where(~held_out()).where("lang IS NOT NULL AND text IS NOT NULL").collect()

    def grams(text):
        for w in langid.words_of(text):
            s = f" {w} "
            yield from (s[k : k + n] for n in langid.LENGTHS for k in range(len(s) - n + 1) if s[k : k + n] != " ")

    counts = {}
    for r in learned:
        counts.setdefault(r.lang, Counter()).update(grams(r.text))
    rates = {lang: {g: n / c.total() for g, n in c.items()} for lang, c in counts.items()}
    best = Counter()
    for rate in rates.values():
        for g, x in rate.items():
            best[g] = max(best[g], x)
    sets = {lang: {g for g, x in rate.items() if x >= langid.SHARE and x * langid.CONTRAST >= best[g]} for lang, rate in rates.items()}
    out = langid.predict(d, langid.learn(d.where(~held_out()))).collect()
    assert len(out) == 200
    for r in out:
        found = list(grams(r.text or ""))
        hits = {lang: sum(g in s for g in found) for lang, s in sorted(sets.items())}
        if not found:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        top = max(hits.values())
        if sorted(hits.values())[-2] < top - 2:
            assert hits[r.lang_pred] == top
        assert abs(r.score - top / sum(hits.values())) < 0.01
