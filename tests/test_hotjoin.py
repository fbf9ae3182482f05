"""Joins through hot keys: the summary misses none, results equal a plain join, the largest task falls."""

import collections

import pytest
from pyspark.sql import functions as F

from strata.operators.hotjoin import frequent_keys, hot_join
from strata.session import conf_override

PLAIN_PLAN = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}


def bag(df):
    return collections.Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def sides(spark):
    """60% of the rows have key 0 (half of them equal rows), 8% no key, the others are spread."""
    i = F.col("id")
    left = spark.range(0, 20_000, 1, 6).select(
        F.when(i % 25 < 15, 0).when(i % 25 < 17, None).otherwise(i % 700 + 1).cast("long").alias("k"),
        F.when(i % 2 == 0, 5).otherwise(i).alias("v"),
    )
    right = spark.range(0, 3000).select((F.col("id") % 600).alias("k"), F.col("id").alias("w")).unionByName(
        spark.createDataFrame([(None, 1), (None, 2)], "k long, w long")
    )
    return left, right


@pytest.mark.parametrize("order", ["id", "id % 97", "-id"])
def test_frequent_keys_are_exact_in_any_order(spark, order):
    """Keys just above and just below the share, among many rare ones, sorted the worst ways."""
    n = 40_000
    x = F.col("id")
    df = spark.range(0, n, 1, 4).select("id", F.when(x % 100 < 3, -1).when(x % 100 < 5, -2).when(x % 200 == 199, -3).otherwise(x).alias("k"))
    df = df.repartitionByRange(5, F.expr(order)).sortWithinPartitions(F.expr(order)).select("k", F.concat(F.lit("é"), F.col("k")).alias("s"))
    counts = collections.Counter(r.k for r in df.collect())
    for share in (0.01, 0.019, 0.021, 0.4):
        hot, rows = frequent_keys(df, ["k", "s"], share)
        assert rows == n
        assert {(r.k, r.s): r["rows"] for r in hot.collect()} == {(k, f"é{k}"): c for k, c in counts.items() if c > share * n}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_a_plain_join(spark, sides, how):
    left, right = sides
    with conf_override(spark, **PLAIN_PLAN):
        assert bag(hot_join(left, right, "k", how)) == bag(left.join(right, "k", how))


def test_largest_task_falls(spark, sides):
    left, right = sides
    with conf_override(spark, **PLAIN_PLAN):
        def largest(joined):
            return max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())

        assert largest(left.join(right, "k")) > 55_000  # 12,000 rows x 5 in one task
        assert largest(hot_join(left, right, "k")) < 25_000
        # rows without a key are kept by a left join, and are no task of their own either
        none = left.where("k IS NULL")
        assert largest(none.join(right, "k", "left")) == none.count()
        assert largest(hot_join(none, right, "k", "left")) < none.count() / 2


def test_several_key_columns_and_clashing_names(spark):
    left = spark.createDataFrame([("a", 1, i, 9) for i in range(50)] + [("a", None, 1, 9), ("b", 2, 1, 9)], "k string, j int, salt0 int, salt1 int")
    right = spark.createDataFrame([("a", 1, 7), ("a", 1, 8), ("b", 2, 9), ("c", 3, 1)], "k string, j int, SALT2 int")
    with conf_override(spark, **PLAIN_PLAN):
        for how in ("inner", "left"):
            got = hot_join(left, right, ["k", "j"], how, share=0.1)
            assert got.columns == left.join(right, ["k", "j"], how).columns
            assert bag(got) == bag(left.join(right, ["k", "j"], how))


def test_no_rows_and_refused_kinds(spark, sides):
    left, right = sides
    assert hot_join(left.limit(0), right, "k").count() == 0
    assert hot_join(left.limit(0), right, "k", "left").count() == 0
    with pytest.raises(ValueError, match="repeat"):
        hot_join(left, right, "k", "full_outer")
    with pytest.raises(ValueError, match="share"):
        frequent_keys(left, ["k"], 0.0)
