import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % importance.BUCKETS


def brute_force(docs, target):
    s, t = [0] * importance.BUCKETS, [0] * importance.BUCKETS
    for counts, texts in ((s, [x[1] for x in docs]), (t, target)):
        for text in texts:
            for f in features(text)[1]:
                counts[bucket(f)] += 1
    total_s, total_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log(((b + 1) * (total_s + 10000)) / ((a + 1) * (total_t + 10000)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        n_words, found = features(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    eligible = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2]))
    drawn = eligible[: 5 * len(eligible) // 100]
    out = {}
    for k, r in enumerate(drawn):
        out.setdefault(tuple(r[:4]), []).append(k + 1)
    for r in rows:
        ranks = out.get(tuple(r[:4]), [])
        yield (*r[:4], ranks.pop(0) if ranks and r[4] >= 20 else None)


def as_multiset(rows):
    return sorted(rows, key=repr)


def check(spark, docs, target):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([(x,) for x in target], "text string")
    result = importance.resample(d, t)
    got = result.rows.select("id", "n_features", "weight", "score", "rank").collect()
    assert as_multiset(map(tuple, got)) == as_multiset(brute_force(docs, target))
    return d, result


def some_text(r, words):
    return " ".join(r.choice(["The", "a", "über", "naïve", "42", "x-ray", "don't", "日本語", "é"]) + str(r.randint(0, 30)) for _ in range(words))


def test_against_brute_force(spark):
    r = random.Random(1)
    docs = [(i, some_text(r, r.randint(0, 60))) for i in range(300)] + [(None, some_text(r, 30)), (1000, None), (1001, ""), (1002, "\x00 ., \t"), (-3, some_text(r, 5000))]
    d, result = check(spark, docs, [some_text(r, 40) for _ in range(10)] + [None])
    drawn = importance.drawn_documents(d, result)
    assert drawn.columns == d.columns
    ids = [x.id for x in result.rows.where("rank is not null").collect()]
    assert sorted(x.doc_id for x in drawn.collect()) == sorted(ids) and len(ids) == result.draws > 0


def test_repeated_rows_and_ids(spark):
    r = random.Random(2)
    same = some_text(r, 25)
    docs = [(7, same)] * 60 + [(7, some_text(r, 25)) for _ in range(20)] + [(None, same)] * 30 + [(i, same) for i in range(100, 140)]
    check(spark, docs, [same])


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "too short")]])
def test_empty_inputs(spark, docs):
    check(spark, docs, [])
    check(spark, docs, ["a target"])


def test_odd_columns(spark):
    d = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(20 + i)), 9, "x") for i in range(40)], "doc_id long, text string, rank int, `n_words` string")
    result = importance.resample(d, d.limit(3))
    out = importance.drawn_documents(d, result)
    assert out.columns == d.columns and out.count() == result.draws == 2
    assert {x["rank"] for x in out.collect()} == {9}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40), min_size=1, max_size=60))
def test_crc_of_many_equals_crc_of_each(parts):
    data, sizes = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    got = importance.crc32_by_length(data, np.cumsum(sizes) - sizes, sizes)
    assert got.tolist() == [zlib.crc32(p) for p in parts]


def test_crc_matrix_in_parts(monkeypatch):
    monkeypatch.setattr(importance, "CELLS", 100)
    r = random.Random(3)
    parts = [r.randbytes(r.choice([3, 9, 5000])) for _ in range(300)]
    data, sizes = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    assert importance.crc32_by_length(data, np.cumsum(sizes) - sizes, sizes).tolist() == [zlib.crc32(p) for p in parts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=8))
def test_runs_of_any_text(texts):
    runs = importance.word_runs([None if t is None else t.encode() for t in texts])
    for k, t in enumerate(texts):
        n_words, found = features(t)
        assert runs.n_words[k] == n_words
        assert sorted(runs.bucket[runs.doc == k].tolist()) == sorted(map(bucket, found))
