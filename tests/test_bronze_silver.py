"""Bronze runs and silver rules on hand-made reload units (FIXTURES §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import bronze, dims, quality, silver
from strata.operators.contract import SchemaContractError
from strata.operators.history import VersionedTable

from conftest import LANDING_SCHEMA, land, trip, zones_frame

D = dt.datetime


def dim(spark):
    return dims.build_dim_zone(dims.conform_zones(zones_frame(spark)))


BAD_TRIPS = {
    "negative_fare": trip(l_orderkey=1, l_extendedprice=-5.0),
    "zero_distance_with_fare": trip(l_orderkey=2, l_discount=0.0),
    "zero_distance_no_fare": trip(l_orderkey=3, l_discount=0.0, l_extendedprice=0.0),
    "dropoff_before_pickup": trip(l_orderkey=4, l_shipdate=D(2024, 3, 9)),
    "pickup_2009": trip(l_orderkey=5, o_orderdate=D(2009, 3, 10), l_shipdate=D(2009, 3, 11)),
    "two_faults": trip(l_orderkey=6, c_acctbal=-1.0, l_shipdate=D(2024, 3, 1)),
    "null_fare": trip(l_orderkey=7, l_extendedprice=None),
    "clean": trip(l_orderkey=8),
}
EXPECTED_REASONS = {
    1: ["negative_amount"],
    2: ["zero_distance_with_fare"],
    4: ["dropoff_before_pickup"],
    5: ["outside_period"],
    6: ["negative_amount", "dropoff_before_pickup"],
}


def test_bronze_run_is_idempotent_and_faithful(spark, layout):
    land(spark, layout, 2024, 3, list(BAD_TRIPS.values()))
    land(spark, layout, 2024, 4, [trip(l_orderkey=9, o_orderdate=D(2024, 4, 2), l_shipdate=D(2024, 4, 3))])
    v1 = bronze.run_bronze(spark, layout, "b1")
    v2 = bronze.run_bronze(spark, layout, "b2")
    t = VersionedTable(spark, layout.bronze)
    df = t.read()
    assert df.count() == 9  # nothing dropped, nothing doubled
    assert {r._batch_id for r in df.select("_batch_id").distinct().collect()} == {"b2"}
    assert (v1, v2) == (2, 3)
    # partition values come from the unit name, never from the row's time
    assert df.where(F.col("l_orderkey") == 5).select("year", "month").first() == (2024, 3)
    assert df.where(F.col("_source_file").isNull()).count() == 0


def test_broken_unit_fails_before_any_write(spark, layout):
    land(spark, layout, 2024, 3, [trip()])
    bad = spark.createDataFrame([(1, "x")], "l_orderkey bigint, l_returnflag string")
    bad.write.parquet(layout.unit_path(2024, 4))
    with pytest.raises(SchemaContractError):
        bronze.run_bronze(spark, layout, "b1")
    t = VersionedTable(spark, layout.bronze)
    assert t.current_version() == 1 and t.read().count() == 0


def test_rules_split_with_reasons(spark, layout):
    land(spark, layout, 2024, 3, list(BAD_TRIPS.values()))
    bronze.run_bronze(spark, layout, "b1")
    silver.run_silver(spark, layout, dim(spark), "s1")
    kept = {r.trip_id for r in silver.read_silver(spark, layout).collect()}
    rej = {r.trip_id: r[quality.REASONS] for r in silver.read_rejects(spark, layout).collect()}
    assert rej == EXPECTED_REASONS
    assert kept == {3, 7, 8}  # zero distance without fare and NULL fare are kept
    assert len(kept) + len(rej) == len(BAD_TRIPS)


def test_null_predicate_does_not_reject(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "fare_amount double")
    kept, rejected = quality.split(df, [quality.Rule("neg", "negative", F.col("fare_amount") < 0)])
    assert kept.count() == 2 and rejected.count() == 1


def test_late_trip_rejected_by_default_kept_with_tolerance(spark, layout):
    late = trip(l_orderkey=1, o_orderdate=D(2024, 3, 31, 23), l_shipdate=D(2024, 4, 1, 1))
    land(spark, layout, 2024, 4, [late, trip(l_orderkey=2, o_orderdate=D(2024, 4, 2), l_shipdate=D(2024, 4, 2, 1))])
    bronze.run_bronze(spark, layout, "b1")
    silver.run_silver(spark, layout, dim(spark), "s1")
    assert {r.trip_id for r in silver.read_rejects(spark, layout).collect()} == {1}

    s_root = f"{layout.root}/silver_tol"
    kw = dict(tolerance_months=1, silver_root=s_root)
    silver.run_silver(spark, layout, dim(spark), "s1", **kw)
    got = {r.trip_id: r.event_month for r in VersionedTable(spark, s_root).read().collect()}
    assert got == {1: dt.date(2024, 3, 1), 2: dt.date(2024, 4, 1)}
    silver.run_silver(spark, layout, dim(spark), "s2", months=[(2024, 4)], **kw)  # rerun: unchanged
    again = {r.trip_id: r.event_month for r in VersionedTable(spark, s_root).read().collect()}
    assert again == got


def test_vanished_month_is_emptied(spark, layout):
    land(spark, layout, 2024, 4, [trip(o_orderdate=D(2024, 4, 2), l_shipdate=D(2024, 4, 3))])
    bronze.run_bronze(spark, layout, "b1")
    silver.run_silver(spark, layout, dim(spark), "s1")
    assert silver.read_silver(spark, layout).count() == 1
    # the republished unit only holds a rejected row: April must not keep the stale trip
    land(spark, layout, 2024, 4, [trip(o_orderdate=D(2024, 4, 2), l_shipdate=D(2024, 4, 3), l_extendedprice=-1.0)])
    bronze.run_bronze(spark, layout, "b2")
    silver.run_silver(spark, layout, dim(spark), "s2", months=[(2024, 4)])
    assert silver.read_silver(spark, layout).count() == 0
    assert silver.read_rejects(spark, layout).count() == 1


def test_unknown_zone_is_kept_with_null_zone(spark, layout):
    land(spark, layout, 2024, 3, [trip(l_suppkey=99), trip(l_orderkey=2, l_suppkey=1)])
    bronze.run_bronze(spark, layout, "b1")
    silver.run_silver(spark, layout, dim(spark), "s1")
    rows = {r.pu_location_id: r.pu_zone for r in silver.read_silver(spark, layout).collect()}
    assert rows == {99: None, 1: "Zone 1"}


def test_additive_column_reads_null_for_older_units(spark, layout):
    land(spark, layout, 2024, 1, [trip(o_orderdate=D(2024, 1, 5), l_shipdate=D(2024, 1, 6))])
    df = spark.createDataFrame([tuple(trip(o_orderdate=D(2024, 2, 5), l_shipdate=D(2024, 2, 6)).values())], LANDING_SCHEMA)
    df.withColumn("surge_fee", F.lit(2.5)).coalesce(1).write.parquet(layout.unit_path(2024, 2))
    bronze.run_bronze(spark, layout, "b1")
    got = {(r.month, r.surge_fee) for r in VersionedTable(spark, layout.bronze).read().select("month", "surge_fee").collect()}
    assert got == {(1, None), (2, 2.5)}


def test_plain_append_doubles_and_dynamic_overwrite_does_not(spark, layout):
    land(spark, layout, 2024, 3, [trip(), trip(l_orderkey=2)])
    for mode, expected in (("append", 4), ("overwrite", 2)):
        path = f"{layout.root}/plain_{mode}"
        for b in ("b1", "b2"):
            bronze.write_plain(bronze.enriched_landing(spark, layout, b), path, mode)
        assert bronze.read_plain(spark, path).count() == expected


def test_static_overwrite_drops_other_partitions(spark, layout):
    land(spark, layout, 2024, 3, [trip()])
    land(spark, layout, 2024, 4, [trip(o_orderdate=D(2024, 4, 2), l_shipdate=D(2024, 4, 3))])
    path = f"{layout.root}/plain_static"
    bronze.write_plain(bronze.enriched_landing(spark, layout, "b1"), path, "overwrite")
    march = bronze.read_plain(spark, path).where("month = 3")
    bronze.write_plain(march, f"{path}_copy", "overwrite")
    bronze.write_plain(bronze.read_plain(spark, f"{path}_copy"), path, "overwrite", overwrite_mode="static")
    assert [r.month for r in bronze.read_plain(spark, path).select("month").distinct().collect()] == [3]


def test_silver_for_a_month_without_bronze_rows_is_empty(spark, layout):
    land(spark, layout, 2024, 3, [trip()])
    bronze.run_bronze(spark, layout, "b1")
    run = silver.run_silver(spark, layout, dim(spark), "s1", months=[(2023, 1)])
    assert (run.rows, run.rejected) == (0, 0)
    assert silver.read_silver(spark, layout).count() == 0


def test_every_row_is_kept_or_rejected(spark, layout):
    """A NULL pickup, and an old trip under rules without the period rule, go to the rejects."""
    from strata.operators.quality import negative_amount

    old = dt.datetime(2009, 1, 1)
    land(spark, layout, 2024, 3, [trip(), trip(o_orderdate=None), trip(o_orderdate=old, l_shipdate=old)])
    bronze.run_bronze(spark, layout, "b1")
    run = silver.run_silver(spark, layout, dim(spark), "s1", rules=[negative_amount()])
    kept, lost = silver.read_silver(spark, layout).count(), silver.read_rejects(spark, layout).collect()
    assert (run.rows, run.rejected, kept, len(lost)) == (3, 2, 1, 2)
    assert {tuple(r._reject_reasons) for r in lost} == {(silver.UNPLACEABLE,)}


def test_reject_rate_counts_the_requested_months_only(spark, layout):
    from strata.operators.quality import RejectRateExceeded

    land(spark, layout, 2024, 3, [trip() for _ in range(4)])
    bad = dict(o_orderdate=dt.datetime(2024, 4, 5), l_shipdate=dt.datetime(2024, 4, 6), l_extendedprice=-1.0)
    land(spark, layout, 2024, 4, [trip(**bad), trip(**bad)])
    bronze.run_bronze(spark, layout, "b1")
    with pytest.raises(RejectRateExceeded):
        silver.run_silver(spark, layout, dim(spark), "s1", months=[(2024, 4)], tolerance_months=1, max_reject_rate=0.9)
