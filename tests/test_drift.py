"""Quantiles, Kolmogorov-Smirnov distances and profiles against plain Python, whatever the task count."""

import random

from pyspark.sql import functions as F

from strata.operators.drift import drift_distance, drift_quantiles
from strata.operators.median import exact_quantiles, running_counts, value_counts
from strata.session import conf_override

PERCENTS = (1, 5, 50, 75, 95, 100)


def rows_of(r):
    rows = [(r.choice([1, 2, 3]), r.choice([-2.5, 0.0, 0.5, 1.0, 7.25, None]) if r.random() < 0.5 else r.uniform(-9, 9)) for _ in range(900)]
    return rows + [(None, 1.0), (None, None), (4, None), (5, 3.0)] + [(6, 2.0)] * 500  # a NULL period, one without values, single values, one value only


def percentile(values, p):
    values = sorted(values)
    return values[max(1, (p * len(values) + 99) // 100) - 1] if values else None


def test_quantiles(spark):
    rows = rows_of(random.Random(1))
    df = spark.createDataFrame(rows, "m int, v double").repartition(7)
    for tasks in ("1", "5", "64"):
        with conf_override(spark, **{"spark.sql.shuffle.partitions": tasks}):
            got = {r.m: r for r in exact_quantiles(value_counts(df, ["m"], "v"), ["m"], PERCENTS).collect()}
            for m in {m for m, v in rows if v is not None}:
                own = [v for k, v in rows if k == m and v is not None]
                assert [got[m][f"p{p}"] for p in PERCENTS] == [percentile(own, p) for p in PERCENTS]
            assert set(got) == {m for m, v in rows if v is not None}


def test_running_counts_of_one_group(spark):
    df = spark.range(0, 5000, 1, 6).select((F.col("id") * 7919 % 1000).alias("v"))
    got = running_counts(value_counts(df, [], "v"), []).orderBy("_v").collect()
    assert [(r._v, r._n, r._upto, r._total) for r in got] == [(v, 5, 5 * (v + 1), 5000) for v in range(1000)]


def test_profile_quantiles_and_baseline(spark):
    rows = rows_of(random.Random(2))
    df = spark.createDataFrame(rows, "m int, v double")
    got = {r.m: r for r in drift_quantiles(df, ["m"], "v", (25, 50), F.col("m") <= 2).collect()}
    base = [v for m, v in rows if m in (1, 2) and v is not None]
    for m, r in got.items():
        own = [v for k, v in rows if k == m and v is not None]
        assert (r.p25, r.p50, r.base_p25, r.base_p50) == (percentile(own, 25), percentile(own, 50), percentile(base, 25), percentile(base, 50))


def distance(own, base):
    points = {x for v in {*own, *base} for x in (v, v - 1e-9)}
    share = lambda values, x: sum(v <= x for v in values) / len(values)
    return max(abs(share(own, x) - share(base, x)) for x in points)


def test_distance_equals_the_greatest_gap_anywhere(spark):
    rows = rows_of(random.Random(3))[::3]
    df = spark.createDataFrame(rows, "m int, v double")
    for baseline, inside in ((None, lambda m: True), (F.col("m") == 2, lambda m: m == 2)):
        got = {r.m: r for r in drift_distance(df, ["m"], "v", baseline).collect()}
        base = [v for m, v in rows if inside(m) and v is not None]
        assert set(got) == {m for m, v in rows if v is not None}
        for m, r in got.items():
            own = [v for k, v in rows if k == m and v is not None]
            assert r["values"] == len(own) and abs(r.distance - distance(own, base)) < 1e-12


def test_no_baseline_and_no_rows(spark):
    df = spark.createDataFrame([(1, 2.0)], "m int, v double")
    assert [(r.m, r.distance) for r in drift_distance(df, ["m"], "v", F.lit(False)).collect()] == [(1, None)]
    assert [tuple(r) for r in drift_quantiles(df, ["m"], "v", (50,), F.lit(False)).collect()] == [(1, 2.0, None)]
    assert drift_distance(df.limit(0), ["m"], "v").count() == drift_quantiles(df.limit(0), ["m"], "v").count() == 0
