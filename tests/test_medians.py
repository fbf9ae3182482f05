"""Medians stay exact above any sketch's size: drift profile, key skew, hot keys."""

from statistics import median_low

from pyspark.sql import functions as F

from strata.operators import skew
from strata.operators.drift import drift_profile

N = 400_001


def _values(spark):
    """Distinct values far from evenly spread, in no order."""
    x = (F.col("id") * 48_271) % N
    return spark.range(0, N, 1, 8).select(F.when(x % 5 == 0, -x).otherwise(x).alias("x"))


def test_drift_medians_are_exact_in_large_groups(spark):
    t = _values(spark).select(
        F.when(F.col("x") % 4 != 0, F.col("x") % 4).alias("m"), "x",
        F.when(F.col("x") % 7 != 0, F.pow(F.col("x") / 1000.0, F.lit(3)).cast("double")).alias("v"), F.lit(1).alias("c"),
    )
    t = t.unionByName(spark.createDataFrame([(9, 1, None, 1)], t.schema))
    rows = t.collect()
    got = {r.m: r for r in drift_profile(t, ["m"], "v", "c").collect()}
    assert len(got) == len({r.m for r in rows}) and None in got
    base = median_low([x.v for x in rows if x.v is not None])
    for m, r in got.items():
        own = [x.v for x in rows if x.m == m and x.v is not None]
        assert r.median == (median_low(own) if own else None)  # percentile_approx left this above 10,000 values
        assert r.base_median == base


def test_key_skew_and_hot_keys_use_the_exact_median(spark, monkeypatch):
    counts = _values(spark).select(F.col("x").alias("k"), (F.abs("x") * F.abs("x") + 1).alias("rows"))
    monkeypatch.setattr(skew, "key_counts", lambda df, key: counts)
    rows = [r.rows for r in counts.collect()]
    s = skew.key_skew(counts, "k", hot_factor=2.5).first()
    median = median_low(rows)
    assert s.median_rows == median
    hot = sorted(n for n in rows if n > 2.5 * median)
    assert s.hot_keys == len(hot)
    assert (s.keys, s.total_rows, s.max_rows) == (len(rows), sum(rows), max(rows))
    assert sorted(r.rows for r in skew.hot_keys(counts, "k", hot_factor=2.5).collect()) == hot


def test_no_rows(spark):
    none = spark.range(0).select(F.col("id").alias("k"))
    assert tuple(skew.key_skew(none, "k").first()) == (0, None, None, 0, None, 0)
    assert skew.hot_keys(none, "k").count() == 0
