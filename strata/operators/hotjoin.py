"""Joins through hot keys (P3): only keys that are hot are salted and replicated.

A plain shuffled join sends all rows of a key to one task.  Here a mergeable
summary of frequent items (Spark's ``approx_top_k``: a bounded number of counters a
task, merged across tasks) names every key that could hold more than ``share`` of the
left rows; those few are counted exactly.  A hot key gets a salt for every ``1 / PIECES`` of
an average task's rows it has (small pieces fall evenly on tasks); its left rows are dealt over
them and its right rows repeated once a salt.  All other rows carry salt 0 and travel as in a plain join, so that one
shuffle of each side does it, with or without adaptive execution.

Left rows without a key never match: where the join keeps them they are dealt over all tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Joins whose result has every left row in one place: the right side may be repeated.
KINDS = ("inner", "left", "left_semi", "left_anti")
PIECES = 4


def _any_null(keys: list[str]) -> Column:
    none = F.lit(False)
    for k in keys:
        none = none | F.col(k).isNull()
    return none


def frequent_keys(df: DataFrame, keys: list[str], share: float) -> tuple[DataFrame, int]:
    """Every key with more than ``share`` of the rows of ``df`` (keys, rows: exact), and the number of rows.

    The summary's error is below 3.5 / counters of the rows, and it lists every item
    above twice its error: 8 / share counters miss none.  Items are hashes of the keys; the
    fewer than 2 / share listed are counted by key in a second pass that shuffles nothing else.
    """
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    counters = math.ceil(8 / share)
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_h"), _any_null(keys).alias("_none"))
    summary = f"approx_top_k(_h, {counters}, {counters}) FILTER (WHERE NOT _none)"
    found = hashed.agg(F.expr(summary).alias("items"), F.count(F.lit(1)).alias("rows")).first()
    named = [r["item"] for r in found["items"] or [] if r["item"] is not None]
    counts = hashed.where(F.col("_h").isin(named) & ~F.col("_none")).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counts.where(F.col("rows") > F.lit(share) * found["rows"]), found["rows"]


def hot_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner", share: float = 0.01, tasks: int | None = None) -> DataFrame:
    """``left.join(right, on, how)`` with the left side's hot keys spread over tasks.

    ``tasks`` (the shuffle partitions by default) says what an average task holds.  Equal
    rows of a hot key are dealt by their map task, so that copies spread as well.
    """
    if how not in KINDS:
        raise ValueError(f"a {how} join would repeat unmatched right rows; use one of {KINDS}")
    keys = [on] if isinstance(on, str) else list(on)
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot, rows = frequent_keys(left.select(*keys), keys, share)
    found = hot.collect()  # fewer than 1 / share
    if not found and how == "inner":
        return left.join(right, keys, how)
    taken = {c.lower() for c in [*left.columns, *right.columns]}
    salt = next(n for n in (f"salt{i}" for i in range(len(taken) + 1)) if n not in taken)
    fair = max(1, math.ceil(rows / tasks / PIECES))
    number = F.lit(1)
    for r in found:  # a few literal keys: no join needed to look them up
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(k) == F.lit(r[k]))
        number = F.when(same, F.lit(math.ceil(r["rows"] / fair))).otherwise(number)
    spread = F.xxhash64(*left.columns, F.spark_partition_id())
    dealt = left.withColumn(salt, F.pmod(spread, F.when(_any_null(keys), F.lit(tasks)).otherwise(number)))
    repeated = right.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), (F.coalesce(number, F.lit(1)) - 1).cast("long"))))
    return dealt.join(repeated, [*keys, salt], how).drop(salt)
