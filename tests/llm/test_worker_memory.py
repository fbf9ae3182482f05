"""What a Python worker keeps between tasks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import types as T

from strata.llm import common


def test_only_the_named_owner_keeps_its_cache():
    one, other = common.worker_cache("test-one"), common.worker_cache("test-other")
    one["k"], other["k"] = 1, 2
    common.forget(but="test-one")
    assert one == {"k": 1} and other == {}
    common.forget()
    assert one == {}
    common.give_back()  # never fails, whatever the platform


def test_a_task_of_another_operator_finds_no_cache(spark):
    def make():
        kept = common._CACHES.get("test-task") or [common.worker_cache("test-task")]
        had = len(kept[0])
        kept[0]["k"] = "x" * 100
        return lambda values: [pa.array([had] * len(values), pa.int64())]

    rows = spark.range(4).selectExpr("cast(id as string) as text").coalesce(1)
    seen = [common.add_columns(rows, "text", {"had": T.LongType()}, make, cache="").agg({"had": "max"}).first()[0] for _ in range(2)]
    assert seen == [0, 0]
