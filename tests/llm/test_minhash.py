"""DartMinHash: signatures against true similarities, classes against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm import minhash as mh


def words(text):
    return (text or "").encode().split()


def shingle_counts(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows, counted=True):
    """{id: least id of its class} over all pairs; sets without counts."""
    sets = {}
    for i, t in rows:
        found = shingle_counts(t)
        sets.setdefault(i, []).append(found if counted else Counter(found.keys()))
    ids = sorted(sets)
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and (x & y).total() >= 0.8 * (x | y).total() for x in sets[a] for y in sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: root(i) for i in ids}


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    names = mh.mix64(np.arange(400, dtype=np.uint64))
    for weighted in (False, True):
        a = rng.integers(0, 6, 400) if weighted else rng.integers(0, 2, 400)
        b = np.where(rng.random(400) < 0.8, a, rng.integers(0, 6 if weighted else 2, 400))
        elements = np.concatenate([names[a > 0], names[b > 0]])
        owner = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = mh.throw(elements, np.concatenate([a[a > 0], b[b > 0]]).astype(float), owner, 2, coordinates=4096)
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((s[0] == s[1]).mean() - true) < 4 * (true * (1 - true) / 4096) ** 0.5


def test_signatures_do_not_depend_on_company():
    texts = [b"a b c d e f g h", b"x", b"", None, b" ".join(b"w%d" % i for i in range(5000))]
    e, o, w = mh.shingles(texts)
    every = mh.throw(e, w, o, 5)
    for i, t in enumerate(texts):
        e, o, w = mh.shingles([t])
        assert (mh.throw(e, w, o, 1)[0] == every[i]).all()
    assert (every[:2] > 0).all() and (every[2:4] == 0).all()


def test_occurrences_carry_the_weights():
    texts = [b"a b c d e " * 30 + b"x y z", b"a b c d e " * 24 + b"x y z w", b"p q r s t u v", b""]
    names, of = mh.occurrences(*mh.shingles(texts))
    for i in range(4):
        for j in range(4):
            x, y = shingle_counts(texts[i].decode()), shingle_counts(texts[j].decode())
            if x and y:
                a, b = names[of == i], names[of == j]
                assert (np.diff(a.astype(object)) > 0).all() and len(a) == x.total()
                assert abs(mh.similarity(a, b) - (x & y).total() / (x | y).total()) < 1e-12
    plain = mh.shingles(texts, counted=False)
    assert mh.occurrences(*plain)[0] is plain[0]


def test_repeated_shingles_weigh(spark):
    """Texts of one set and other counts: apart by their weights, alike as plain sets."""
    rng = random.Random(3)
    rows = []
    for k in range(12):
        line = " ".join(f"l{k}-{i}" for i in range(8))
        tail = " ".join(f"t{k}-{i}" for i in range(60))
        rows += [(10 * k + j, f"{line} " * n + tail) for j, n in enumerate((2, 3, 40, 41, 47, 90))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for counted in (True, False):
        got = {r.doc: r["class"] for r in mh.near_duplicates(docs, counted=counted).collect()}
        assert got == brute(rows, counted)
        assert len(set(got.values())) == 12 * (3 if counted else 1)


def edit(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.random()}"
    return w


def test_classes_against_all_pairs(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(200)]
    rows, i = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 6, 40])):
            rows.append((i, " ".join(edit(rng, base, rng.choice([0, 0, 1, 2, 3]) if len(base) > 20 else 0))))
            i += 1
    star = [rng.choice(vocabulary) for _ in range(300)]  # copies near the base, less so each other
    rows += [(1000 + k, " ".join(edit(rng, star, 6))) for k in range(60)] + [(2000, " ".join(star))]
    chain = [f"c{k}" for k in range(400)]
    rows += [(3000 + k, " ".join(chain[15 * k : 15 * k + 200])) for k in range(12)]
    rng.shuffle(rows)
    want = brute(rows)
    got = {r.doc: r["class"] for r in mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == want


def test_groups_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(mh, "CHUNK", 7)
    monkeypatch.setattr(mh, "WIDE", 5)
    monkeypatch.setattr(mh, "BIN", 20)
    test_classes_against_all_pairs(spark)


def test_odd_rows(spark):
    t = " ".join(f"q{i}" for i in range(60))
    rows = [(None, t), (7, t), (3, t + " end"), (7, t), (9, ""), (10, None), (11, ""), (None, "alone here"), (12, "alone here"), (13, "One"), (14, " One\n"), (None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("x")).withColumn("node", F.lit(1))
    got = mh.near_duplicates(d).collect()
    assert len(got) == len(rows)
    by = {r.doc: r["class"] for r in got if r.doc >= 0}
    assert by == {7: 3, 3: 3, 9: 9, 10: 10, 11: 11, 12: 12, 13: 13, 14: 13}
    kept = mh.one_of_each(d)
    assert kept.columns == d.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, i) for i in (3, 9, 10, 11, 12, 13)] + [(True, 0)]
    assert mh.near_duplicates(d.limit(0)).count() == 0


def test_one_id_with_several_texts(spark):
    """Each text is judged by itself: no link is lost, and no text goes that no other stands for."""
    rng = random.Random(11)
    a, b, c, d = (" ".join(rng.choice("abcdefghij") + str(rng.randrange(1000)) for _ in range(80)) for _ in range(4))
    rows = [(5, a), (5, b), (7, c), (6, b + " end"), (5, ""), (8, d), (4, d), (8, a)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").withColumns({"__number": F.lit(1), "version": F.lit(2), "stands": F.lit(3)})
        kept = mh.one_of_each(docs.repartition(3))
        assert kept.columns == docs.columns
        texts = [r.text for r in kept.collect()]
        near = [t for t in texts if t in (b, b + " end")]
        assert len(near) == 1 and sorted(t for t in texts if t not in near) == sorted([a, c, "", d])
        found = mh.classify(docs).join(docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("version"), "text"), ["doc", "version"]).collect()
        of = {}
        for r in found:
            of.setdefault(r["class"], set()).add(r.text)
        assert sorted(map(sorted, (v - {""} for v in of.values() if v - {""}))) == sorted(map(sorted, ([a], [b, b + " end"], [c], [d])))
        assert sum(r.stands for r in found) == 5 and len(found) == len(rows)


def test_classes_of_repeated_ids_stay_apart(spark):
    """Two texts under one id are two classes, with two numbers; copies elsewhere join their own."""
    texts = [" ".join(f"{k}-{i}" for i in range(40)) for k in range(3)]
    rows = [(1, t) for t in texts] + [(10 + k, t) for k, t in enumerate(texts)]
    got = mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    classes = {r.doc: r["class"] for r in got if r.doc >= 10}
    assert len(set(classes.values())) == 3 and sorted(r["class"] for r in got if r.doc == 1) == sorted(classes.values())
