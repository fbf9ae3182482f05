"""Substring dedup against a brute-force count of all windows."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import substring


def brute(rows, k):
    """{(doc, text): (n_words, n_removed, kept)} by looking at every window of the input."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, substring_version(r[1])))
    seen, out = set(), {}
    for doc, text in order:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - k + 1):
            w = tuple(words[i : i + k])
            if w in seen:
                gone.update(range(i, i + k))
            seen.add(w)
        out[doc, text] = (len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    return out


VERSIONS: dict = {}


def substring_version(text):
    return VERSIONS[text]


def agree(spark, rows, k, **options):
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    VERSIONS.update({r.text: r.v for r in d.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("v")).collect()})
    want = brute(rows, k)
    got = substring.remove_repeats(d, k=k, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id, r.text], (r.doc_id, r.text)


def corpus(rng, n, vocabulary, lengths, passages):
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice(lengths))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    return rows


def test_random_texts_small_windows(spark):
    rng = random.Random(1)
    passages = [[f"p{j}x{i}" for i in range(12)] for j in range(4)]
    rows = corpus(rng, 150, ["a", "b", "c", "dé"], [0, 3, 8, 30], passages)
    agree(spark, rows, 5, m=2, hot=10, per_bucket=50)
    agree(spark, rows, 5, m=2, hot=100_000, per_bucket=10**9)


def test_copies_common_passage_and_20_words(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    common = [f"common{i}" for i in range(45)]
    rows = corpus(rng, 120, vocabulary, [5, 60, 200], [common])
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [(2000, "x " * 500), (2001, "x " * 19), (2002, "x " * 20)]
    agree(spark, rows, 20, hot=50)
    agree(spark, rows, 20)


def test_odd_rows(spark):
    line = " ".join(f"q{i}" for i in range(30))
    rows = [(None, line), (None, line + " z"), (5, line), (5, line), (5, "q " + line), (6, None), (7, ""), (None, None), (8, " \x0b\x0c ")]
    agree(spark, rows, 20)
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).withColumn("extra", F.array(F.lit(1)))
    out = substring.remove_repeats(d)
    assert out.columns == ["doc_id", "text", "extra", "n_words", "n_removed", "kept"] and out.count() == len(rows)
    assert substring.remove_repeats(d.limit(0)).count() == 0


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(substring, "substring_hashes", lambda values, at, size: np.zeros(len(at), np.uint64))
    texts = [b"a b c d e f", b"x b c d y z", b"b c d"]
    sent = list(substring._send(np.arange(3), np.zeros(3, np.int64), texts, np.zeros(0, np.uint64), {b"c": 0}, 1, 3, 2))
    packed = [p for _, p, _ in sent if p is not None]
    ranges = [np.frombuffer(g, substring._RANGE) for _, _, g in sent if g is not None] + [substring._removed(packed, 1, 3)]
    got = {(int(r["doc"]), int(r["first"]), int(r["last"])) for r in substring._joined(np.concatenate(ranges))}
    assert got == {(1, 1, 4), (2, 0, 3)}


def test_texts_cut_together_as_one_by_one():
    rng = np.random.default_rng(4)
    lengths = [0, 3, 25, 0, 40, 19, 20, 21, 0, 200, 1]
    starts = np.concatenate([[0], np.cumsum(lengths)])
    hashes = rng.integers(0, 30, starts[-1]).astype(np.uint64)
    hot = np.sort(np.unique(substring.run_hashes(hashes, 3))[:20])
    alone = [substring.super_kmers(hashes[a:z], hot) for a, z in zip(starts[:-1], starts[1:], strict=True)]
    want = [np.concatenate(x) for x in zip(*[(f + a, n, m) for a, (f, n, m) in zip(starts[:-1], alone, strict=True)], strict=True)]
    for got, expected in zip(substring.super_kmers(hashes, hot, starts=starts), want, strict=True):
        assert got.tolist() == expected.tolist()


def test_strings_of_one_name_are_compared():
    codes = np.array([1, 2, 1, 2, 1, 3, 1, 2, 9])
    at, size = np.array([0, 2, 4, 6, 8]), np.array([2, 2, 2, 2, 1])
    assert substring._leads(np.array([7, 7, 7, 7, 7]), at, size, codes).tolist() == [0, 0, 2, 0, 4]
