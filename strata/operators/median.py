"""Exact quantiles at any size, from one table of value counts.

Rows are counted per group and value, once.  Counts are then sorted by ranges over all tasks, and a
value's running count is what stands in the ranges before (a few numbers a range) plus its place in its
own range: no task sees all values of a group, and nothing is approximate.

The quantile of p percent is the least value that at least p percent of the group's non-NULL values do
not exceed (for 50: the lower median), in the value's own type.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import shared_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, whatever reads it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, _v, _n): how often each non-NULL value stands in each group."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], names: Sequence[str]) -> Column:
    """Left keys equal right names, NULL equal to NULL."""
    on = F.lit(True)
    for k, n in zip(keys, names):
        on = on & left[k].eqNullSafe(right[n])
    return on


def running_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``counts`` (keys, _v, _n) plus ``_upto``: the group's rows up to and with this value, and ``_total``: all of them."""
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartitionByRange(tasks, *keys, "_v").withColumn("_range", F.spark_partition_id())
    dealt = written(dealt, "value-counts")  # fixes the ranges
    group, names = Window.partitionBy(*keys), [f"_k{i}" for i in range(len(keys))]
    ranges = dealt.groupBy(*keys, "_range").agg(F.sum("_n").alias("_sum"))  # of a group: one row a range at most
    before = F.sum("_sum").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_range").alias("_at"), F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_sum").over(group).alias("_total"))
    within = F.sum("_n").over(Window.partitionBy("_range", *keys).orderBy("_v"))
    rows = dealt.withColumn("_within", within)
    joined = rows.join(ranges, (rows["_range"] == ranges["_at"]) & same_keys(rows, ranges, keys, names))
    return joined.select(*[rows[k] for k in keys], "_v", "_n", (F.col("_before") + F.col("_within")).alias("_upto"), "_total")


def rank_of(percent: int, total: str) -> Column:
    """The place of a percentile among ``total`` (a column) sorted values, from 1, in whole numbers."""
    return F.expr(f"greatest(1L, ({total} * {percent} + 99) div 100)")


def exact_quantiles(counts: DataFrame, keys: Sequence[str], percents: Sequence[int]) -> DataFrame:
    """(keys, p<percent> ...): exact percentiles of each group of ``counts``, a table (keys, _v, _n)."""
    rows = running_counts(counts, keys)
    reached = lambda p: F.col("_upto") >= rank_of(p, "_total")
    return rows.groupBy(*keys).agg(*[F.min(F.when(reached(p), F.col("_v"))).alias(f"p{p}") for p in percents])


def exact_median(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, median) of each group of ``counts``, a table (keys, _v, _n)."""
    return exact_quantiles(counts, keys, [50]).withColumnRenamed("p50", "median")
