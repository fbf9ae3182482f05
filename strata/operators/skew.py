"""Key skew: measure it, and aggregate through it.

``key_skew`` summarises the per-key row counts (max, median, ratio, number of
hot keys) from one grouped aggregate; ``hot_keys`` lists them as rows.  The
per-key counts never leave the cluster.

``salted_agg`` is the two-stage aggregate for a hot key: stage 1 groups by
``(key, salt)`` with a deterministic salt, so one key's rows are combined by
``salts`` tasks; stage 2 merges at most ``salts`` partial rows per key.  Only
decomposable aggregates are offered (count, sum, min, max), so the result is
identical to a plain ``groupBy``.  Spark's own partial aggregation already
combines map-side for these functions; the salt additionally bounds the work
of the *reduce* task that owns a hot key, which matters once the partials of a
key are themselves many (wide, high-cardinality inputs), and it keeps the
skew-splitting explicit when AQE is off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import exact_sum
from strata.operators.median import rank_of


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def _by_rows(c: DataFrame) -> DataFrame:
    """(rows, _n, median_rows): ``c`` counted by its rows per key, with the exact median of all keys beside it.

    A table of fewer rows than ``sqrt(2 x total rows)``, so that one window over all of it will do.
    """
    by_rows = c.groupBy("rows").agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy()
    upto = F.sum("_n").over(everything.orderBy("rows"))
    half = F.col("_upto") >= rank_of(50, "_all")
    counted = by_rows.withColumns({"_upto": upto, "_all": F.sum("_n").over(everything)})
    return counted.withColumn("median_rows", F.min(F.when(half, F.col("rows"))).over(everything)).drop("_upto", "_all")


def key_skew(df: DataFrame, key: str, hot_factor: float = 10.0) -> DataFrame:
    """One row: keys, total rows, max, median, max/median and how many keys are hot.

    The median is exact at every size.  All figures come from the rows per key counted
    by value, in one pass over ``df``.  Hot keys are
    those above ``hot_factor`` x median; :func:`hot_keys` returns them as rows.
    """
    hot = F.col("rows") > F.col("median_rows") * F.lit(float(hot_factor))
    stats = _by_rows(key_counts(df, key)).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("keys"),
        F.sum(F.col("rows") * F.col("_n")).alias("total_rows"),
        F.max("rows").alias("max_rows"),
        F.coalesce(F.max("median_rows"), F.lit(0)).alias("median_rows"),
        F.coalesce(F.sum(F.when(hot, F.col("_n"))), F.lit(0)).alias("hot_keys"),
    )
    return stats.select(
        "keys", "total_rows", "max_rows", "median_rows",
        F.try_divide(F.col("max_rows").cast("double"), F.col("median_rows").cast("double")).alias("skew_ratio"),
        "hot_keys",
    )


def hot_keys(df: DataFrame, key: str, hot_factor: float = 10.0) -> DataFrame:
    """The hot keys as rows (``key, rows``): more than ``hot_factor`` x the median rows per key."""
    c = key_counts(df, key)
    median = _by_rows(c).agg(F.max("median_rows").alias("median_rows"))
    hot = F.col("rows") > F.col("median_rows") * F.lit(float(hot_factor))
    return c.join(F.broadcast(median), hot).select(c.columns)  # one row


def salted_agg(df: DataFrame, key: str, value: str, salts: int = 16, salt_cols: list[str] | None = None) -> DataFrame:
    """Two-stage ``count / sum / min / max`` of ``value`` per ``key``.

    The salt is ``pmod(xxhash64(salt_cols), salts)``: deterministic, so a
    retried task recomputes the same partials.
    """
    cols = salt_cols or df.columns
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salts)))
    stage1 = salted.groupBy(key, "_salt").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col(value).cast("decimal(18,4)")).alias("_s"),
        F.min(value).alias("_lo"),
        F.max(value).alias("_hi"),
    )
    return stage1.groupBy(key).agg(
        F.sum("_n").alias("rows"),
        F.sum("_s").cast("double").alias("total"),
        F.min("_lo").alias("min_value"),
        F.max("_hi").alias("max_value"),
    )


def plain_agg(df: DataFrame, key: str, value: str) -> DataFrame:
    """The one-stage aggregate ``salted_agg`` must equal."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        exact_sum(value).alias("total"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def task_skew(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Rows per reduce task when ``df`` is hash-partitioned on ``key`` (P3, "max vs median task").

    One row: ``tasks`` (non-empty), ``max_rows``, ``median_rows``, ``skew_ratio``.
    The per-task counts come from one shuffle and one grouped count; only the
    one-row summary reaches the driver.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_task = (
        df.select(key).repartition(n, key)
        .groupBy(F.spark_partition_id().alias("task"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return _by_rows(per_task).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("tasks"),
        F.max("rows").alias("max_rows"),
        F.max("median_rows").alias("median_rows"),
    ).withColumn("skew_ratio", F.try_divide(F.col("max_rows").cast("double"), F.col("median_rows").cast("double")))
