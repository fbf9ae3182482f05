"""Writes of many small files: nothing beside a file, its rows counted from its footer."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from strata.layout import Layout
from strata.operators import bronze, dims, silver
from strata.operators.history import SMALL_FILE, VersionedTable
from strata.plans import explain_text

from conftest import land, trip, zones_frame


@pytest.fixture(scope="module")
def layout(spark):
    return Layout.fresh(spark, "small-files")


@pytest.fixture(scope="module")
def small(spark, layout):
    """Silver of 500 kept rows and 50 rejects in files of 10."""
    day = dt.datetime(2024, 3, 5)
    rows = [trip(l_orderkey=i, o_orderdate=day, l_shipdate=day, l_extendedprice=-1.0 if i % 11 == 0 else 1.0) for i in range(550)]
    land(spark, layout, 2024, 3, rows)
    bronze.run_bronze(spark, layout, "b1")
    silver.run_silver(spark, layout, dims.build_dim_zone(dims.conform_zones(zones_frame(spark))), "s1", rows_per_file=10)
    return VersionedTable(spark, layout.silver)


def data_files(table, ending):
    return [p for p in Path(table.data_path.removeprefix("file:")).rglob(f"*{ending}") if "_version=" in str(p)]


def test_small_files_have_no_file_beside_them(spark, layout, small):
    assert len(data_files(small, ".parquet")) >= 50 and not data_files(small, ".crc")
    assert sorted(r.trip_id for r in silver.read_kept(small).collect()) == [i for i in range(550) if i % 11]
    assert sorted(r.trip_id for r in silver.read_rejected(small).collect()) == list(range(0, 550, 11))
    assert data_files(VersionedTable(spark, layout.bronze), ".crc")  # ordinary files are written as ever


def test_a_damaged_small_file_is_found_by_its_page_checksums(spark, small, tmp_path):
    file = data_files(small, ".parquet")[0]
    column = pq.ParquetFile(file).metadata.row_group(0).column(0)
    content = bytearray(file.read_bytes())
    content[(column.dictionary_page_offset or column.data_page_offset) + column.total_compressed_size - 1] ^= 1  # of its last page
    file = tmp_path / "damaged.parquet"
    file.write_bytes(bytes(content))
    read = spark.read.option("parquet.page.verify-checksum.enabled", "true").parquet(str(file))
    with pytest.raises(Exception, match="(?i)crc|checksum"):
        read.collect()


def test_only_small_files_on_hadoops_own_local_file_system(spark, small):
    assert small._small_file_options(SMALL_FILE) and not small._small_file_options(SMALL_FILE + 1) and not small._small_file_options(None)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.file.impl", "org.apache.hadoop.fs.LocalFileSystem")
    try:
        assert small._small_file_options(10) == {}
    finally:
        conf.unset("fs.file.impl")


def test_records_are_counted_from_footers(spark, small):
    counted = small._written(small.current_version(), small.schema())
    assert "PushedAggregation: [COUNT(*)]" in explain_text(counted)
    march = dt.date(2024, 3, 1)
    assert {tuple(r) for r in counted.collect()} == {(march, None, 500), (None, march, 50)}
    assert {(r.event_month, r.reject_month, r.records) for r in small.pin_rows(small.current_version())} == {(march, None, 500), (None, march, 50)}
