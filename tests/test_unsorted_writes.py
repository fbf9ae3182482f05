"""Partitioned writes do not sort (and spill) a task's rows; the session's own setting is left as it was."""

import threading

import pytest
from conftest import SF_SMALL
from pyspark.sql.readwriter import DataFrameWriter

from strata import build
from strata.operators import bronze as bronze_ops
from strata.session import OPEN_FILES, unsorted_write
from strata.sources import stage_landing

KEY = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture()
def writes(spark, monkeypatch):
    """(path, open files a task may hold) of every Parquet write."""
    seen, plain = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kw):
        seen.append((path, int(spark.conf.get(KEY, "0"))))
        return plain(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_layers_are_written_without_a_sort(spark, layout, writes):
    before = spark.conf.get(KEY, None)
    stage_landing(spark, SF_SMALL, layout)
    bronze_ops.run_bronze(spark, layout, "b1")
    bronze_ops.write_plain(bronze_ops.enriched_landing(spark, layout, "b2"), f"{layout.root}/plain", "overwrite")
    data = [n for p, n in writes if p in (layout.landing, f"{layout.bronze}/data", f"{layout.root}/plain")]
    assert data == [OPEN_FILES] * 3
    assert spark.conf.get(KEY, None) == before


def test_history_and_null_deliveries_are_written_without_a_sort(spark, writes):
    """The runs behind ``version_diff`` and ``snapshots``, and the delivery of ``nullability_change``."""
    import __spark_entry__ as entry

    b = build.build_layers(spark, SF_SMALL)
    assert b.history_table().current_version() == b.hist()["undo"]
    assert entry.queries()["nullability_change"](spark, SF_SMALL).count() > 0
    runs = [n for p, n in writes if p == f"{b.hist_root}/data"]
    nulls = [n for p, n in writes if "/nulls-" in p]
    assert runs == [OPEN_FILES] * 3 and nulls == [OPEN_FILES]


def test_more_partitions_than_open_files_lose_no_row(spark, layout):
    path = f"{layout.root}/many"
    with unsorted_write(spark):
        spark.range(0, 3000, 1, 1).selectExpr("id", f"id % {3 * OPEN_FILES} AS p").write.partitionBy("p").parquet(path)
    got = spark.read.parquet(path)
    assert got.count() == 3000 and got.where(f"id % {3 * OPEN_FILES} <> p").isEmpty()


def test_overlapping_writes_restore_the_setting(spark):
    before = spark.conf.get(KEY, None)
    inside, leave = threading.Event(), threading.Event()

    def other():
        with unsorted_write(spark):
            inside.set()
            leave.wait(60)

    thread = threading.Thread(target=other)
    with unsorted_write(spark):
        thread.start()
        assert inside.wait(60)
    assert spark.conf.get(KEY) == str(OPEN_FILES)  # the other write goes on
    leave.set()
    thread.join()
    assert spark.conf.get(KEY, None) == before
