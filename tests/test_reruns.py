"""Run-twice properties per layer and recovery from a bad silver rule (layer method, step 5 and 8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import bronze, dims, gold, quality, silver
from strata.operators.history import VersionedTable

from conftest import land, trip, zones_frame

D = dt.datetime


def _dim(spark):
    return dims.build_dim_zone(dims.conform_zones(zones_frame(spark)))


def test_new_unit_is_picked_up_without_code_change(spark, layout):
    land(spark, layout, 2024, 3, [trip(), trip(l_orderkey=2)])
    bronze.run_bronze(spark, layout, "b1")
    land(spark, layout, 2024, 4, [trip(l_orderkey=3, o_orderdate=D(2024, 4, 1), l_shipdate=D(2024, 4, 2))])
    bronze.run_bronze(spark, layout, "b2")
    df = VersionedTable(spark, layout.bronze).read()
    assert df.count() == 3
    assert df.where(F.col("_source_file").isNull() | F.col("_ingested_at").isNull()).count() == 0


def test_silver_twice_and_rollback_of_a_bad_rule(spark, layout):
    rows = [trip(l_orderkey=i, l_extendedprice=-1.0 if i % 3 == 0 else 10.0 * i) for i in range(1, 10)]
    land(spark, layout, 2024, 3, rows)
    bronze.run_bronze(spark, layout, "b1")
    counts = []
    for b in ("s1", "s2"):
        run = silver.run_silver(spark, layout, _dim(spark), b)
        assert (run.rows, run.rejected) == (9, 3)  # observed during the write
        counts.append((silver.read_silver(spark, layout).count(), silver.read_rejects(spark, layout).count()))
    assert counts[0] == counts[1] == (6, 3)
    with pytest.raises(quality.RejectRateExceeded):
        silver.run_silver(spark, layout, _dim(spark), "s2b", max_reject_rate=0.2)
    good = VersionedTable(spark, layout.silver).current_version()
    # a bad rule rejects everything; roll silver back to the version before it
    bad_rule = quality.Rule("too_strict", "rejects every trip", F.lit(True))
    silver.run_silver(spark, layout, _dim(spark), "s3", rules=[bad_rule])
    assert silver.read_silver(spark, layout).count() == 0
    VersionedTable(spark, layout.silver).rollback(good)
    assert silver.read_silver(spark, layout).count() == 6


def test_gold_rebuild_changes_no_number(spark, layout):
    land(spark, layout, 2024, 3, [trip(l_orderkey=i, l_suppkey=i % 3 + 1, l_extendedprice=10.5 * i) for i in range(1, 20)])
    bronze.run_bronze(spark, layout, "b1")
    sv = silver.run_silver(spark, layout, _dim(spark), "s1").silver_version
    s = silver.read_silver(spark, layout)
    paths = gold.build_gold(spark, s, sv, layout.gold)
    first = {n: sorted(spark.read.parquet(p).collect()) for n, p in paths.items()}
    gold.build_gold(spark, s, sv, layout.gold)
    second = {n: sorted(spark.read.parquet(p).collect()) for n, p in paths.items()}
    assert first == second
    total = spark.read.parquet(paths["zone_daily"]).agg(F.sum("trips")).first()[0]
    assert total == s.count()
    # rolled-up tables equal the same question asked of silver directly
    direct = sorted(gold.borough_summary(gold.zone_daily(s)).collect())
    stored = sorted(spark.read.parquet(paths["borough_summary"]).drop("_silver_version").collect())
    assert direct == stored


def test_gold_holds_the_latest_build_only(spark, layout):
    land(spark, layout, 2024, 3, [trip()])
    bronze.run_bronze(spark, layout, "b1")
    for run in ("s1", "s2"):  # two silver versions
        sv = silver.run_silver(spark, layout, _dim(spark), run).silver_version
        paths = gold.build_gold(spark, silver.read_silver(spark, layout), sv, layout.gold)
    stored = spark.read.parquet(paths["zone_daily"])
    assert stored.agg(F.sum("trips")).first()[0] == 1
    assert {r._silver_version for r in stored.collect()} == {sv}
    assert [r.report_month for r in stored.collect()] == [D(2024, 3, 1).date()]


def test_gold_that_fails_its_checks_is_not_published(spark, layout, monkeypatch):
    land(spark, layout, 2024, 3, [trip()])
    bronze.run_bronze(spark, layout, "b1")
    sv = silver.run_silver(spark, layout, _dim(spark), "s1").silver_version
    s = silver.read_silver(spark, layout)
    path = gold.build_gold(spark, s, sv, layout.gold)["zone_daily"]
    before = spark.read.parquet(path).collect()
    doubled = gold.zone_daily(s.union(s))
    monkeypatch.setattr(gold, "zone_daily", lambda _: doubled)
    with pytest.raises(AssertionError, match="add up"):
        gold.build_gold(spark, s, sv + 1, layout.gold)
    assert spark.read.parquet(path).collect() == before


def test_builds_are_published_as_a_whole(spark, layout, monkeypatch):
    """One row makes all tables of a build current; a build that fails in its last table changes nothing."""
    land(spark, layout, 2024, 3, [trip()])
    bronze.run_bronze(spark, layout, "b1")
    sv = silver.run_silver(spark, layout, _dim(spark), "s1").silver_version
    s = silver.read_silver(spark, layout)
    assert gold.current_tables(spark, layout.gold) == {}
    first = gold.build_gold(spark, s, sv, layout.gold)
    assert gold.current_tables(spark, layout.gold) == first
    with monkeypatch.context() as m:
        def twice(df):
            out = gold.hourly_trips(df)
            return out.union(out)
        m.setitem(gold.ROLLUPS, "hourly_demand", (twice, ["weekday", "hour"]))
        with pytest.raises(AssertionError, match="grain"):
            gold.build_gold(spark, s, sv, layout.gold)
    assert gold.current_tables(spark, layout.gold) == first
    second = gold.build_gold(spark, s, sv, layout.gold)
    assert gold.current_tables(spark, layout.gold) == second
    assert spark.read.parquet(first["zone_daily"]).count() == 1  # still there for a reader that has just looked it up
    gold.build_gold(spark, s, sv, layout.gold)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(first["zone_daily"])


def test_kept_rows_per_source_month_from_lineage_equal_a_scan(spark, layout):
    for m in (3, 4):
        land(spark, layout, 2024, m, [trip(l_orderkey=i, o_orderdate=D(2024, m, 2), l_shipdate=D(2024, m, 3), l_extendedprice=-1.0 if i % 3 == 0 else 1.0) for i in range(5 * m)])
    bronze.run_bronze(spark, layout, "b1")
    silver.run_silver(spark, layout, _dim(spark), "s1")
    table = VersionedTable(spark, layout.silver)
    s, r = silver.read_silver(spark, layout), silver.read_rejects(spark, layout)
    by_lineage = sorted(gold.reject_rate(s, r, silver.kept_by_source(table)).collect())
    assert by_lineage == sorted(gold.reject_rate(s, r).collect()) and len(by_lineage) == 2


def test_land_month_lands_one_unit_per_commit(spark, layout):
    land(spark, layout, 2024, 3, [trip(), trip(l_orderkey=2)])
    land(spark, layout, 2024, 4, [trip(l_orderkey=3, o_orderdate=D(2024, 4, 1), l_shipdate=D(2024, 4, 2))])
    v1 = bronze.land_month(spark, layout, 2024, 3, "b1")
    t = VersionedTable(spark, layout.bronze)
    assert [(r.year, r.month) for r in t.read().select("year", "month").distinct().collect()] == [(2024, 3)]
    v2 = bronze.land_month(spark, layout, 2024, 4, "b1")
    t = VersionedTable(spark, layout.bronze)
    assert v2 == v1 + 1 and t.read().count() == 3
    assert t.read(version=v1).count() == 2  # the earlier version is unchanged
