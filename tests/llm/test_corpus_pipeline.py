"""The pipeline stage by stage: decisions take effect, clean documents stay, odd rows pass."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import mixing, substring

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, None, None, None, None), (10**9, "", "en", "src0", 0), (10**9 + 1, None, None, None, 0), (10**9 + 2, "short", "en", None, 5), (10**9 + 2, "short", "en", None, 5)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("size", F.lit("clash")).withColumn("kept", F.lit(1))
    out = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], SF), "test"))
    return out


def test_columns(steps):
    assert all(d.columns == steps[0].columns for d in steps[:-1])


def test_rejected_documents_go_and_good_ones_stay(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = (Counter(r.doc_id for r in d.select("doc_id").collect()) for d in steps[:2])
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(after[i] > 0 for i in good) >= 0.95 * len(good)
    assert sum(after[i] == 0 for i in bad) >= 0.8 * len(bad)


def test_one_document_of_each_class(steps):
    def sets(d):
        out = {}
        for r in d.collect():
            w = (r.text or "").encode().split()
            out[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        return out

    before, after = sets(steps[1]), sets(steps[2])
    near = lambda a, b: a and b and len(a & b) >= 0.8 * len(a | b)
    kept = list(after.values())
    assert not any(near(a, b) for i, a in enumerate(kept) for b in kept[:i])
    for i, s in before.items():  # what went has a near duplicate among the others
        assert i in after or any(near(s, t) for j, t in before.items() if j != i)
    assert len(after) == steps[2].count()


def test_no_window_is_left_twice(steps):
    before = {r.doc_id: r for r in steps[2].collect()}
    want, seen = {}, set()
    for i in sorted(before, key=lambda i: (i is None, i or 0)):
        words, gone = (before[i].text or "").encode().split(), set()
        for a in range(len(words) - substring.K + 1):
            w = tuple(words[a : a + substring.K])
            if w in seen:
                gone.update(range(a, a + substring.K))
            seen.add(w)
        want[i] = b" ".join(w for a, w in enumerate(words) if a not in gone).decode() if gone else before[i].text
    got = {r.doc_id: r for r in steps[3].collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == (len(r.text) if r.text != before[i].text else before[i].n_chars) for i, r in got.items())


def test_documents_are_taken_as_planned(steps):
    plan = {r.doc_id: r.copies for r in mixing.plan_mix(steps[3]).collect()}
    taken = Counter(r.doc_id for r in steps[4].collect())
    assert taken == {i: n for i, n in plan.items() if n}


def test_ids_and_text_are_the_library_s(steps):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    rows = steps[5].collect()
    assert len(rows) == steps[4].count()
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(spark, steps):
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "test")
    assert docs.count() == 0
