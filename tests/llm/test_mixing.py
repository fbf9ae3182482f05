"""Systematic sampling: targets, whole prefix sums, odd rows."""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import functions as F

from strata.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def water(sizes: list[int], weights, share=1.5, cap=2) -> list[float]:
    """Targets by the stated rule: stop at the cap, share the excess anew until none is above."""
    total, stopped = share * sum(sizes), set()
    while True:
        left = total - sum(cap * sizes[i] for i in stopped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in stopped)
        out = [cap * s if i in stopped else left * weights[i] / w for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in stopped and out[i] > cap * sizes[i]}
        if not over:
            return out
        stopped |= over


def corpus(spark, per_source: dict):
    rows, i = [], 0
    for source, sizes in per_source.items():
        for n in sizes:
            rows.append((i, " ".join(["w"] * n), source))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_follow_the_rule(spark):
    per = {"b": [5] * 30, "a": [7] * 80, "é": [40] * 9, "c": [3] * 500, None: [11] * 33, "B": [2]}
    got = {r.source: r.target for r in mixing.plan_mix(corpus(spark, per)).select("source", "target").distinct().collect()}
    names = sorted((s for s in per if s is not None), key=lambda s: s.encode()) + [None]
    want = water([sum(per[s]) for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    for name, w in zip(names, want, strict=True):
        assert math.isclose(got[name], w, rel_tol=1e-12), name


def test_copies_are_floor_or_ceiling_and_add_up(spark):
    per = {"a": list(range(1, 400)), "b": [1, 2, 3] * 50, "c": [10] * 200}
    rows = mixing.plan_mix(corpus(spark, per)).collect()
    expect, copies, taken = defaultdict(float), defaultdict(int), defaultdict(int)
    for r in rows:
        rate = r.target / r.source_size
        assert r.copies in (math.floor(rate), math.ceil(rate)) and r.copies <= 2
        expect[r.source] += rate
        copies[r.source] += r.copies
        taken[r.source] += r.copies * r.size
    targets = {r.source: r.target for r in rows}
    for s in per:
        assert abs(copies[s] - expect[s]) <= 1
        assert abs(taken[s] - targets[s]) <= 0.05 * targets[s] + max(per[s])


def test_many_salts_give_the_same_totals_and_reruns_agree(spark):
    d = corpus(spark, {"a": [3] * 500, "b": [5] * 100, "c": [9] * 40})
    for salts in (1, 7):
        first = mixing.plan_mix(d, salts=salts).orderBy("doc_id").collect()
        again = mixing.plan_mix(d.repartition(5), salts=salts).orderBy("doc_id").collect()
        assert first == again
        rate = {r.source: r.target / r.source_size for r in first}
        for s, n in {"a": 500, "b": 100, "c": 40}.items():
            assert abs(sum(r.copies for r in first if r.source == s) - n * rate[s]) <= 1


def test_null_empty_repeated_and_clashing(spark):
    rows = [(None, "a b", "x"), (1, None, "x"), (2, "", None), (2, "", None), (3, "q r s", "x"), (3, "q r s", "x"), (4, " \t\n", "y")]
    d = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("mine")).withColumn("Target", F.lit(1))
    plan = mixing.plan_mix(d)
    assert plan.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies"]
    got = plan.collect()
    assert len(got) == 7 and {r.size for r in got if not (r.text or "").strip()} == {0}
    assert all(r.target == 0 and r.copies == 0 for r in got if r.source != "x")
    mixed = mixing.mix(d)
    assert mixed.columns == d.columns
    assert mixed.count() == sum(r.copies for r in got) and {r["size"] for r in mixed.collect()} == {"mine"}
    assert mixing.plan_mix(d.limit(0)).count() == 0


def test_rows_without_id_fill_many_cells(spark):
    d = spark.range(50_000).selectExpr("cast(null as bigint) AS doc_id", "concat('a b w', id) AS text", "'x' AS source")
    cells = mixing._planned(d).groupBy("__mix_class", "__mix_salt").count()
    assert cells.count() == mixing.SALTS
    assert cells.agg({"count": "max"}).first()[0] < 2 * 50_000 / mixing.SALTS
    assert mixing.plan_mix(d).agg({"copies": "sum"}).first()[0] == 75_000


def test_columns_named_as_inner_ones_pass_through(spark):
    rows = [(i, "a b c", "x", 9, "n", "c") for i in range(10)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, __mix_size int, __mix_name string, c1 string")
    out = mixing.mix(d)
    assert out.columns == d.columns
    assert {tuple(r)[3:] for r in out.collect()} == {(9, "n", "c")} and out.count() == 15


def test_a_very_long_text(spark):
    d = spark.createDataFrame([(1, "w " * 2_000_000, "x"), (2, "v", "x")], "doc_id long, text string, source string")
    assert {(r.doc_id, r.size, r.copies in (1, 2)) for r in mixing.plan_mix(d).collect()} == {(1, 2_000_000, True), (2, 1, True)}
