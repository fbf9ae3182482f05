"""One-variable-at-a-time tuning experiments.

An ``Experiment`` runs the same query under each value of one variable
(shuffle partitions, join strategy, AQE, caching, ...) and records the median
wall time of ``runs`` executions through the ``noop`` sink, which executes the
whole plan without collecting rows to the driver.  Each setting is restored
afterwards, so experiments do not leak into each other.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.plans import plan_facts
from strata.session import conf_override


def run_noop(df: DataFrame) -> float:
    """Execute the whole plan, discard the rows; returns seconds."""
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


#: Shuffle files of a run are deleted when it ends: runs leave the next ones as much disk as they found.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class Experiment:
    """Same query, one variable, several values.

    ``variable`` is a Spark conf key, or any label when ``setup`` applies the
    value itself (e.g. a join hint or a cache decision baked into ``query``).
    ``query(spark, value)`` returns the DataFrame to time.
    """

    name: str
    variable: str
    values: list
    query: Callable[[SparkSession, object], DataFrame]
    runs: int = 3
    results: list[tuple] = field(default_factory=list)

    def run(self, spark: SparkSession) -> DataFrame:
        for value in self.values:
            settings = {self.variable: str(value)} if self.variable.startswith("spark.") else {}
            with conf_override(spark, **{FREED: "true"}, **settings):
                df = self.query(spark, value)
                facts = plan_facts(df)
                times = [run_noop(df) for _ in range(self.runs)]
            self.results.append(
                (self.name, self.variable, str(value), statistics.median(times), min(times), max(times),
                 facts.exchanges, ",".join(facts.joins))
            )
        return results_frame(spark, self.results)


def results_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The change, before and after, as rows."""
    return spark.createDataFrame(
        rows,
        "experiment string, variable string, value string, median_sec double, "
        "min_sec double, max_sec double, exchanges int, joins string",
    )


def cached_reuse(spark: SparkSession, silver: DataFrame, builds: list[Callable[[DataFrame], DataFrame]], cache: bool) -> float:
    """P5: several gold builds over one silver frame, cached or not; returns seconds."""
    src = silver.cache() if cache else silver
    try:
        t0 = time.perf_counter()
        for b in builds:
            run_noop(b(src))
        return time.perf_counter() - t0
    finally:
        if cache:
            src.unpersist()


def standard_experiments(
    spark: SparkSession, trips: DataFrame, dim: DataFrame, silver: DataFrame, runs: int = 3
) -> list[Experiment]:
    """The reference's tuning questions, one variable each.

    * P1 shuffle partitions for a gold aggregate;
    * P2 broadcast vs sort-merge for the dimension join;
    * P3 a hot key (8% of rows): plain vs two-stage salted aggregate;
    * P4 AQE off vs on for the same aggregate;
    * C9 read split size for a full scan.
    """
    from pyspark.sql import functions as F

    from strata.operators import dims, gold, skew

    hot = trips.withColumn(
        "zone_key", F.when(F.col("trip_id") % 100 < 8, F.lit(-1).cast("bigint")).otherwise(F.col("pu_location_id"))
    )
    return [
        Experiment("shuffle_partitions", "spark.sql.shuffle.partitions", [8, 64, 200],
                   lambda s, v: gold.zone_daily(silver), runs),
        Experiment("join_strategy", "strategy", ["broadcast", "merge"],
                   lambda s, v: dims.enrich_zones(trips, dim, key="pu_location_id", strategy=v), runs),
        Experiment("skewed_key", "method", ["plain", "salted"],
                   lambda s, v: (skew.plain_agg if v == "plain" else skew.salted_agg)(hot, "zone_key", "fare_amount"), runs),
        Experiment("aqe", "spark.sql.adaptive.enabled", ["false", "true"],
                   lambda s, v: gold.zone_daily(silver), runs),
        Experiment("read_split", "spark.sql.files.maxPartitionBytes", ["1m", "16m", "128m"],
                   lambda s, v: trips.select("trip_id", "fare_amount"), runs),
    ]


def run_experiments(spark: SparkSession, experiments: list[Experiment]) -> DataFrame:
    """Run every experiment; one row per (experiment, value)."""
    rows: list[tuple] = []
    for e in experiments:
        e.run(spark)
        rows += e.results
    return results_frame(spark, rows)


def hot_join_experiment(spark: SparkSession, facts: DataFrame, key: str, root: str, fan_out: int = 200, runs: int = 3, name: str = "hot_join") -> list[tuple]:
    """P3 bench row: a join through one key with a third of the rows, plain vs salted for that key only.

    Both sides are written tables joined by shuffle, without adaptive execution; the hot key meets
    ``fan_out`` rows, so the task that owns it in the plain join makes a third of all rows times that.
    """
    import uuid

    from pyspark.sql import functions as F

    from strata.operators.hotjoin import hot_join

    tag = uuid.uuid4().hex[:8]
    left, right = f"{root}/hot_left_{tag}", f"{root}/hot_right_{tag}"
    facts.withColumn(key, F.when(F.xxhash64(*facts.columns) % 3 == 0, F.lit(-1)).otherwise(F.col(key))).write.parquet(left)
    once = spark.read.parquet(left).select(key).distinct()
    many = spark.range(fan_out).select(F.col("id").alias("cell"))
    once.join(F.broadcast(many), (F.col(key) == -1) | (F.col("cell") == 0)).write.parquet(right)
    rows = []
    with conf_override(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        variants = {
            "plain": lambda: spark.read.parquet(left).join(spark.read.parquet(right), key),
            "salted": lambda: hot_join(spark.read.parquet(left), spark.read.parquet(right), key),  # finding the keys is part of it
        }
        for value, make in variants.items():
            times, facts_of = [], plan_facts(make())
            for _ in range(runs):
                t0 = time.perf_counter()
                joined = make()
                run_noop(joined.groupBy("cell").agg(F.sum(F.hash(*joined.columns)).alias("n")))
                times.append(time.perf_counter() - t0)
            rows.append((name, "join", value, statistics.median(times), min(times), max(times), facts_of.exchanges, ",".join(facts_of.joins)))
    return rows


def bucketed_join_experiment(
    spark: SparkSession, left: DataFrame, right: DataFrame, key: str, root: str,
    buckets: int = 16, runs: int = 3, name: str = "bucketed_join",
) -> list[tuple]:
    """D-tier bench row: the same join over plain vs bucketed tables.

    Both sides are written ``bucketBy(buckets, key)`` as catalog tables whose
    files live under ``root`` (the shared folder); joining equal bucketings
    needs no exchange.  Rows: (experiment, variable, value, median, min, max,
    exchanges, joins).
    """
    import uuid

    tag = uuid.uuid4().hex[:8]
    names = []
    for side, df in (("l", left), ("r", right)):
        t = f"strata_bkt_{side}_{tag}"
        df.write.bucketBy(buckets, key).sortBy(key).option("path", f"{root}/{t}").saveAsTable(t)
        names.append(t)
    variants = {
        "plain": lambda: left.join(right, key),
        "bucketed": lambda: spark.table(names[0]).join(spark.table(names[1]), key),
    }
    rows = []
    with conf_override(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for value, make in variants.items():
            df = make()
            facts = plan_facts(df)
            times = [run_noop(df) for _ in range(runs)]
            rows.append((name, "layout", value, statistics.median(times), min(times), max(times),
                         facts.exchanges, ",".join(facts.joins)))
    for t in names:
        spark.sql(f"DROP TABLE IF EXISTS {t}")  # catalog entry only; files stay under root
    return rows


def clustering_experiment(
    spark: SparkSession, df: DataFrame, key: str, value, root: str, runs: int = 3,
    name: str = "clustered_filter",
) -> list[tuple]:
    """D-tier bench row: a point filter on ``key`` over unsorted vs clustered files.

    The clustered copy is range-partitioned and sorted on ``key`` so Parquet
    min/max statistics let the pushed filter skip files and row groups.
    """
    import uuid

    from pyspark.sql import functions as F

    tag = uuid.uuid4().hex[:8]
    n = max(1, spark.sparkContext.defaultParallelism)
    paths = {"unsorted": f"{root}/unsorted_{tag}", "clustered": f"{root}/clustered_{tag}"}
    df.repartition(n).write.parquet(paths["unsorted"])
    df.repartitionByRange(n, key).sortWithinPartitions(key).write.parquet(paths["clustered"])
    rows = []
    for variant, path in paths.items():
        q = spark.read.parquet(path).where(F.col(key) == F.lit(value))
        times = [run_noop(q) for _ in range(runs)]
        rows.append((name, "layout", variant, statistics.median(times), min(times), max(times), 0, ""))
    return rows
