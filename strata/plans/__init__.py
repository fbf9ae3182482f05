"""Plan inspection and partition facts.

Everything is read off ``explain("formatted")`` -- what a Spark user sees --
or computed by a grouped count on the cluster; no UI, no internals.
"""

from __future__ import annotations

import contextlib
import io
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@dataclass
class PlanFacts:
    exchanges: int = 0
    broadcast_exchanges: int = 0
    joins: list[str] = field(default_factory=list)
    pushed_filters: list[str] = field(default_factory=list)
    partition_filters: list[str] = field(default_factory=list)
    read_schemas: list[str] = field(default_factory=list)
    codegen_stages: int = 0
    top_k: bool = False

    @property
    def stages(self) -> int:
        """Stage rule (O5): one stage per shuffle exchange, plus one."""
        return self.exchanges + 1


_JOIN = re.compile(r"\b(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)\b")


def plan_facts(df: DataFrame) -> PlanFacts:
    """O1: shuffles, join kinds, pushed filters and read columns of the physical plan.

    With AQE on, the formatted plan is the initial one (``isFinalPlan=false``)
    until the query ran; the shape (exchanges, joins, scans) is what matters.
    """
    text = explain_text(df)
    head = text.split("\n\n(1)")[0]  # the tree; the numbered details follow
    facts = PlanFacts()
    facts.exchanges = len(re.findall(r"(?<!Broadcast)Exchange\b", head))
    facts.broadcast_exchanges = len(re.findall(r"BroadcastExchange\b", head))
    facts.joins = _JOIN.findall(head)
    facts.pushed_filters = re.findall(r"PushedFilters: \[(.*?)\]\n", text)
    facts.partition_filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", text)
    facts.read_schemas = re.findall(r"ReadSchema: (struct<.*?>)\n", text)
    facts.codegen_stages = len(set(re.findall(r"WholeStageCodegen \((\d+)\)", text)))
    facts.top_k = "TakeOrderedAndProject" in head
    return facts


def plan_facts_frame(spark: SparkSession, named: dict[str, DataFrame]) -> DataFrame:
    """Plan facts of several queries as rows (for reports and benches)."""
    rows = []
    for name, df in named.items():
        f = plan_facts(df)
        rows.append((name, f.exchanges, f.broadcast_exchanges, f.stages, ",".join(f.joins), len(f.pushed_filters), f.top_k))
    return spark.createDataFrame(
        rows, "query string, exchanges int, broadcast_exchanges int, stages int, joins string, scans_with_pushdown int, top_k boolean"
    )


def partition_rows(df: DataFrame) -> DataFrame:
    """O2: rows per Spark partition (skew and empty-partition check)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def num_partitions(df: DataFrame) -> int:
    """O2: ``rdd.getNumPartitions()`` of the scan/plan."""
    return df.rdd.getNumPartitions()


def predicted_split_bytes(
    total_bytes: int, n_files: int, cores: int,
    max_partition_bytes: int = 128 * 1024 * 1024, open_cost: int = 4 * 1024 * 1024,
) -> int:
    """O3: Spark's read split size, ``min(maxPartitionBytes, max(openCost, bytesPerCore))``."""
    bytes_per_core = (total_bytes + n_files * open_cost) // max(cores, 1)
    return min(max_partition_bytes, max(open_cost, bytes_per_core))


def predicted_split_bytes_for(spark: SparkSession, total_bytes: int, n_files: int) -> int:
    """O3 with the session's settings."""
    conf = spark.conf
    def size(key: str, default: str) -> int:
        v = conf.get(key, default).strip().lower()
        units = {"b": 1, "k": 1024, "kb": 1024, "m": 1024**2, "mb": 1024**2, "g": 1024**3, "gb": 1024**3}
        m = re.fullmatch(r"(\d+)\s*([a-z]*)", v)
        return int(m.group(1)) * units.get(m.group(2) or "b", 1) if m else int(v)
    return predicted_split_bytes(
        total_bytes, n_files, spark.sparkContext.defaultParallelism,
        size("spark.sql.files.maxPartitionBytes", "128m"), size("spark.sql.files.openCostInBytes", "4m"),
    )
