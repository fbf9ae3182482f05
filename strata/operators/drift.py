"""Data-drift profile against a baseline (D-tier, supports "is the unusable fraction steady").

Per period: rows, exact mean, exact quantiles, null rate and distinct categories of a
column, next to the same statistics over the baseline rows (all by default) and the
difference, and the Kolmogorov-Smirnov distance between the two distributions.  All but the
categories come from one table of value counts per period, written once from one scan.
Category shares are compared the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import safe_ratio
from strata.operators.median import exact_median, exact_quantiles, running_counts, same_keys, written


def histogram(df: DataFrame, period: Sequence[str], value: str, baseline: Column | None = None) -> DataFrame:
    """(period, _v, _ref, _n), written: rows per period and value, NULL included, in the baseline or not."""
    ref = F.lit(True) if baseline is None else F.coalesce(baseline, F.lit(False))
    return written(df.groupBy(*period, F.col(value).alias("_v"), ref.alias("_ref")).agg(F.count(F.lit(1)).alias("_n")), "histogram")


def _value_counts(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    return hist.where(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(F.sum("_n").alias("_n"))


def _stats(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, rows, mean, median and null rate, from the histogram alone."""
    exact = F.sum(F.col("_v").cast("decimal(18,4)") * F.col("_n").cast("decimal(18,0)"))
    known = F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")))
    stats = hist.groupBy(*keys).agg(
        F.sum("_n").alias("rows"), safe_ratio(exact, known).alias("mean"),
        safe_ratio(F.sum(F.when(F.col("_v").isNull(), F.col("_n")).otherwise(0)), F.sum("_n")).alias("null_rate"),
    )
    names = [f"_m{i}" for i in range(len(keys))]
    medians = exact_median(_value_counts(hist, keys), keys)
    medians = medians.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "median")
    return stats.join(medians, same_keys(stats, medians, keys, names), "left").select(*keys, "rows", "mean", "median", "null_rate")


def drift_profile(
    df: DataFrame, period: list[str], value: str, category: str,
    baseline: Column | None = None,
) -> DataFrame:
    """One row per period: its statistics, the baseline's and the deltas.

    ``baseline`` selects the reference rows (default: every row).  The baseline
    is a single aggregated row, attached to every period.
    """
    hist = histogram(df, period, value, baseline)
    ref = F.lit(True) if baseline is None else F.coalesce(baseline, F.lit(False))
    found = written(df.groupBy(*period, F.col(category).alias("_c")).agg(F.max(ref).alias("_ref")), "categories")
    names = [f"_c{i}" for i in range(len(period))]
    kinds = found.groupBy(*[F.col(k).alias(n) for k, n in zip(period, names)]).agg(F.countDistinct("_c").alias("categories"))
    per = _stats(hist, period)
    per = per.join(kinds, same_keys(per, kinds, period, names)).select(*period, "rows", "mean", "median", "null_rate", "categories")
    base = _stats(hist.where("_ref").withColumn("_k", F.lit(1)), ["_k"])
    base = base.join(found.where("_ref").agg(F.countDistinct("_c").alias("categories"), F.lit(1).alias("_k")), "_k")  # one row each
    base = base.select("_k", *[F.col(c).alias(f"base_{c}") for c in ("mean", "median", "null_rate", "categories")])
    return per.withColumn("_k", F.lit(1)).join(F.broadcast(base), "_k", "left").drop("_k").withColumns({
        "mean_delta": F.col("mean") - F.col("base_mean"),
        "null_rate_delta": F.col("null_rate") - F.col("base_null_rate"),
    })


def drift_quantiles(df: DataFrame, period: list[str], value: str, percents: Sequence[int] = (5, 25, 50, 75, 95), baseline: Column | None = None) -> DataFrame:
    """One row per period: exact percentiles of ``value``, and the baseline's as ``base_p<percent>``."""
    hist = histogram(df, period, value, baseline)
    per = exact_quantiles(_value_counts(hist, period), period, percents)
    base = exact_quantiles(_value_counts(hist.where("_ref").withColumn("_k", F.lit(1)), ["_k"]), ["_k"], percents)
    base = base.select("_k", *[F.col(f"p{p}").alias(f"base_p{p}") for p in percents])  # one row
    return per.withColumn("_k", F.lit(1)).join(F.broadcast(base), "_k", "left").drop("_k")


def drift_distance(df: DataFrame, period: list[str], value: str, baseline: Column | None = None) -> DataFrame:
    """(period, values, distance): the greatest gap between a period's share of values up to any point and the baseline's.

    Between two values of a period its share stands still and the baseline's only rises, so the gap is
    greatest at one of the period's values or just below one: these few are compared, not all points.  Periods without
    a value have none; without a baseline the distance is NULL.
    """
    hist = histogram(df, period, value, baseline)
    per = running_counts(_value_counts(hist, period), period)
    base = _value_counts(hist.withColumn("_n", F.when(F.col("_ref"), F.col("_n")).otherwise(0)), [])  # every value, to be met by each period's
    base = running_counts(base, []).select(F.col("_v").alias("_point"), F.col("_n").alias("_there"), F.col("_upto").alias("_base"), F.col("_total").alias("_all"))
    share = lambda n, of: n.cast("double") / F.nullif(of, F.lit(0)).cast("double")
    at = F.abs(share(F.col("_upto"), F.col("_total")) - share(F.col("_base"), F.col("_all")))
    below = F.abs(share(F.col("_upto") - F.col("_n"), F.col("_total")) - share(F.col("_base") - F.col("_there"), F.col("_all")))
    return per.join(base, F.col("_v") == F.col("_point")).groupBy(*period).agg(F.sum("_n").alias("values"), F.max(F.greatest(at, below)).alias("distance"))


def category_shift(df: DataFrame, period: list[str], category: str) -> DataFrame:
    """Share of each category per period next to its share over all periods.

    One pass over ``df`` counts rows per period and category; every total is a
    window sum over those few counts.
    """
    per = df.groupBy(*period, category).agg(F.count(F.lit(1)).alias("rows"))
    total = lambda *keys: F.sum("rows").over(Window.partitionBy(*keys))
    return per.select(
        *period, category,
        safe_ratio(F.col("rows"), total(*period)).alias("share"),
        safe_ratio(total(category), total()).alias("base_share"),
    ).withColumn("share_delta", F.col("share") - F.col("base_share"))
