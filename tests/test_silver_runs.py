"""Silver as one dataset: atomic runs, sized files, lineage and what a backfill reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import bronze, dims, silver
from strata.operators.history import VersionedTable

from conftest import land, trip, zones_frame

D = dt.datetime


def dim(spark):
    return dims.build_dim_zone(dims.conform_zones(zones_frame(spark)))


def ids(df):
    return sorted(r.trip_id for r in df.collect())


def month(m, *rows):
    """Trips picked up in month ``m`` of 2024: (id, extra columns)."""
    return [trip(l_orderkey=i, o_orderdate=D(2024, m, 5), l_shipdate=D(2024, m, 6), **kw) for i, kw in rows]


def test_a_write_that_fails_midway_publishes_nothing(spark, layout, monkeypatch):
    """Kept rows and rejects are one commit: after a crash both are as before, and the next run is whole."""
    land(spark, layout, 2024, 3, month(3, (1, {}), (2, dict(l_extendedprice=-1.0))))
    bronze.run_bronze(spark, layout, "b1")
    silver.run_silver(spark, layout, dim(spark), "s1")
    land(spark, layout, 2024, 3, month(3, (3, {}), (4, {}), (5, dict(l_extendedprice=-1.0))))
    bronze.run_bronze(spark, layout, "b2")

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit_pins", crash)  # all data files are written, the commit is not
        with pytest.raises(RuntimeError, match="lost"):
            silver.run_silver(spark, layout, dim(spark), "s2")
    assert ids(silver.read_silver(spark, layout)) == [1] and ids(silver.read_rejects(spark, layout)) == [2]
    with monkeypatch.context() as m:
        m.setattr(silver, "enrich_zones", lambda rows, _: rows.withColumns({c: F.raise_error(F.lit("broken row")).cast("string") for c in ("pu_zone", "pu_borough")}))
        with pytest.raises(Exception, match="broken row"):  # fails in a task of the write
            silver.run_silver(spark, layout, dim(spark), "s2")
    assert ids(silver.read_silver(spark, layout)) == [1] and ids(silver.read_rejects(spark, layout)) == [2]
    silver.run_silver(spark, layout, dim(spark), "s2")
    assert ids(silver.read_silver(spark, layout)) == [3, 4] and ids(silver.read_rejects(spark, layout)) == [5]


def test_one_rollback_takes_both_back(spark, layout):
    land(spark, layout, 2024, 3, month(3, (1, {}), (2, dict(l_extendedprice=-1.0))))
    bronze.run_bronze(spark, layout, "b1")
    good = silver.run_silver(spark, layout, dim(spark), "s1").silver_version
    land(spark, layout, 2024, 3, month(3, (3, dict(l_extendedprice=-1.0))))
    bronze.run_bronze(spark, layout, "b2")
    silver.run_silver(spark, layout, dim(spark), "s2")
    assert ids(silver.read_silver(spark, layout)) == [] and ids(silver.read_rejects(spark, layout)) == [3]
    VersionedTable(spark, layout.silver).rollback(good)
    assert ids(silver.read_silver(spark, layout)) == [1] and ids(silver.read_rejects(spark, layout)) == [2]


def test_row_without_trip_id_is_rejected_with_a_reason(spark, layout):
    land(spark, layout, 2024, 3, month(3, (None, {}), (2, dict(l_tax=None))))
    bronze.run_bronze(spark, layout, "b1")
    run = silver.run_silver(spark, layout, dim(spark), "s1")
    assert (run.rows, run.rejected) == (2, 1)
    assert [r._reject_reasons for r in silver.read_rejects(spark, layout).collect()] == [["missing_key"]]
    assert [r.tip_amount for r in silver.read_silver(spark, layout).collect()] == [0.0]


def files_of(table, month_start):
    pins = [r for r in table.pin_rows(table.current_version()) if r.event_month == month_start]
    return table.scan_pins(pins, metadata=True).groupBy("_metadata_file").count().collect()


def test_files_hold_at_least_a_file_of_rows(spark, layout):
    """Copies of one row, many input tasks: as many files as the rows fill, and small months have one."""
    land(spark, layout, 2024, 3, [])
    many = spark.range(0, 3000, 1, 12).select(F.lit(7).cast("long").alias("l_orderkey"))
    row = trip(o_orderdate=D(2024, 3, 5), l_shipdate=D(2024, 3, 6))
    from conftest import LANDING_SCHEMA

    cols = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in LANDING_SCHEMA.fields if f.name != "l_orderkey"]
    many.select("l_orderkey", *cols).write.mode("overwrite").parquet(layout.unit_path(2024, 3))  # 12 files
    land(spark, layout, 2024, 4, month(4, *[(i, {}) for i in range(50)]))
    bronze.run_bronze(spark, layout, "b1")
    silver.run_silver(spark, layout, dim(spark), "s1", rows_per_file=1000)
    t = VersionedTable(spark, layout.silver)
    march = files_of(t, dt.date(2024, 3, 1))
    assert 1 < len(march) <= 3 and sum(r["count"] for r in march) == 3000
    assert [r["count"] for r in files_of(t, dt.date(2024, 4, 1))] == [50]


def test_small_files_share_tasks(spark, layout):
    """3000 rows in files of 10: no file is larger than it may be, no more of them than the rows fill, in a few tasks."""
    land(spark, layout, 2024, 3, month(3, *[(i, {}) for i in range(3000)]))
    bronze.run_bronze(spark, layout, "b1")
    for run in ("s1", "s2"):  # the second run knows the months' rows
        silver.run_silver(spark, layout, dim(spark), run, rows_per_file=10)
        march = [r["count"] for r in files_of(VersionedTable(spark, layout.silver), dt.date(2024, 3, 1))]
        assert sum(march) == 3000 and max(march) <= 11 and 3000 / 11 <= len(march) <= 300
    pins = VersionedTable(spark, layout.bronze).pin_rows(2)
    kept, _ = silver.files_per_month(VersionedTable(spark, layout.silver), pins, 0, silver._setup(silver.default_rules(0, "pickup_at"), 0, "pickup_at"), 10)
    assert sum(kept.values()) <= 3000 // 10 // 50  # tasks: one for 100 files, not one for each


def test_rows_that_stay_in_their_month_are_not_dealt(spark, layout, monkeypatch):
    """One bronze file a month: no shuffle, the same rows, one file.  With late rows: dealt."""
    plans, write = [], VersionedTable.write

    def watched(self, df, *args, **kw):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, df, *args, **kw)

    for m in (3, 4):
        land(spark, layout, 2024, m, month(m, (m, {}), (10 * m, dict(l_suppkey=99)), (100 * m, dict(l_extendedprice=-1.0))))
    bronze.run_bronze(spark, layout, "b1")
    monkeypatch.setattr(VersionedTable, "write", watched)
    silver.run_silver(spark, layout, dim(spark), "s1")
    silver.run_silver(spark, layout, dim(spark), "s2", tolerance_months=3, silver_root=f"{layout.root}/late")
    assert ["Repartition" in p for p in plans] == [False, True]
    assert ids(silver.read_silver(spark, layout)) == [3, 4, 30, 40] and ids(silver.read_rejects(spark, layout)) == [300, 400]
    t = VersionedTable(spark, layout.silver)
    assert [r["count"] for r in files_of(t, dt.date(2024, 3, 1))] == [2]
    assert ids(silver.read_kept(VersionedTable(spark, f"{layout.root}/late"))) == [3, 4, 30, 40]


def test_a_month_in_more_files_than_its_rows_fill_is_dealt(spark, layout):
    land(spark, layout, 2024, 3, month(3, (1, {}), (2, {})))
    land(spark, layout, 2024, 4, month(4, (3, {})))
    bronze.run_bronze(spark, layout, "b1")
    t = VersionedTable(spark, layout.bronze)
    t.append(t.read().where("month = 3"))
    pins = t.pin_rows(t.current_version())
    rows = t.scan_pins(pins)
    assert len(rows.inputFiles()) == 3
    assert not silver.well_filed(rows, pins, 1000) and silver.well_filed(rows, pins, 2)
    silver.run_silver(spark, layout, dim(spark), "s1")
    assert [r["count"] for r in files_of(VersionedTable(spark, layout.silver), dt.date(2024, 3, 1))] == [4]
    assert ids(silver.read_silver(spark, layout)) == [1, 1, 2, 2, 3]


def test_a_dimension_too_large_to_broadcast_is_dealt_after_its_join(spark, layout, monkeypatch):
    seen, write = [], VersionedTable.write

    def watched(self, df, *args, **kw):
        seen.append("Repartition" in df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, df, *args, **kw)

    land(spark, layout, 2024, 3, month(3, (1, {})))
    bronze.run_bronze(spark, layout, "b1")
    monkeypatch.setattr(VersionedTable, "write", watched)
    monkeypatch.setattr(silver, "broadcast_fits", lambda _: False)
    silver.run_silver(spark, layout, dim(spark), "s1")
    assert seen == [True] and ids(silver.read_silver(spark, layout)) == [1]


def test_lineage_narrows_what_a_backfill_reads(spark, layout):
    """Months 1-6, tolerance 3; only April holds a late row of March."""
    for m in range(1, 7):
        rows = month(m, (m, {}))
        if m == 4:
            rows += [trip(l_orderkey=40, o_orderdate=D(2024, 3, 30), l_shipdate=D(2024, 4, 1))]
        land(spark, layout, 2024, m, rows)
    bronze.run_bronze(spark, layout, "b1")
    kw = dict(tolerance_months=3)
    silver.run_silver(spark, layout, dim(spark), "s1", **kw)
    t, b = VersionedTable(spark, layout.silver), VersionedTable(spark, layout.bronze)
    got = {(r.event_month.month, r.src_month): r["rows"] for r in silver.lineage(t).collect()}
    assert got == {(m, m): 1 for m in range(1, 7)} | {(3, 4): 1}
    setup = silver._setup(silver.default_rules(3), 3, "pickup_at")
    scope = lambda m, s=setup: silver.source_scope(t, b, b.current_version(), [(2024, m)], 3, s)
    assert scope(4)[1] == [(2024, 1), (2024, 2), (2024, 3), (2024, 4)]  # the calendar would add 5, 6 and 7
    assert scope(4, "other rules")[1] == [(2024, m) for m in range(1, 8)]
    frame = silver.backfill_scopes(silver.lineage(t), [(2024, 4), (2024, 6)], 3)
    assert {(r.month, r.src_month) for r in frame.collect()} == {(4, m) for m in (1, 2, 3, 4)} | {(6, m) for m in (3, 4, 5, 6)}

    # a month whose bronze changed since is read again, whatever the lineage says
    land(spark, layout, 2024, 5, month(5, (5, {})) + [trip(l_orderkey=50, o_orderdate=D(2024, 3, 1), l_shipdate=D(2024, 5, 1))])
    bronze.run_bronze(spark, layout, "b2", months=[(2024, 5)])
    b = VersionedTable(spark, layout.bronze)
    assert scope(4)[1] == [(2024, 1), (2024, 2), (2024, 3), (2024, 4), (2024, 5)]
    silver.run_silver(spark, layout, dim(spark), "s2", months=[(2024, 4)], **kw)
    assert ids(silver.read_silver(spark, layout)) == [1, 2, 3, 4, 5, 6, 40, 50]
    # rebuilt from a narrow scope or from everything: the same rows
    silver.run_silver(spark, layout, dim(spark), "s3", **kw)
    assert ids(silver.read_silver(spark, layout)) == [1, 2, 3, 4, 5, 6, 40, 50]
