"""Per-layer entry points, namespace, coalesce, reject alerts and time-zone conform."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strata import cli
from strata.operators import bronze, gold, silver
from strata.operators.history import VersionedTable
from strata.operators.quality import RejectRateExceeded
from strata.sources import zone_lookup_rows

from conftest import LANDING_SCHEMA, SF_SMALL, land, trip

D = dt.datetime


def test_cli_runs_each_layer_from_storage(spark, layout, capsys):
    land(spark, layout, 2024, 3, [trip(l_orderkey=i, l_suppkey=i % 3 + 1) for i in range(6)])
    zones = f"{layout.root}/landing/zone_lookup"
    zone_lookup_rows(spark, SF_SMALL).write.option("header", "true").csv(zones)
    b = cli.main(["bronze", "--root", layout.root, "--batch-id", "b1"])
    s = cli.main(["silver", "--root", layout.root, "--batch-id", "b1"])
    g = cli.main(["gold", "--root", layout.root, "--max-reject-rate", "0.5"])
    assert (b["version"], s["version"]) == (2, 2)
    assert set(g["tables"]) == {
        "zone_daily", "borough_summary", "zone_rank", "running_total", "hourly_demand", "grid_demand", "reject_rate", "reject_delta", "reject_reasons",
    }
    assert all(spark.read.parquet(p).count() >= 0 for p in g["tables"].values())
    demand = gold.read_gold(spark, g["tables"]["hourly_demand"])
    assert [(r.weekday, r.hour, r.trips) for r in demand.collect()] == [(6, 9, 6)]
    daily = spark.read.parquet(g["tables"]["zone_daily"])
    assert daily.agg(F.sum("trips")).first()[0] == 6
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["layer"] == "gold"


def test_reject_rate_alert(spark):
    rate = spark.createDataFrame([(2024, 1, 100, 1, 0.01), (2024, 2, 100, 11, 0.11)],
                                 "src_year int, src_month int, input_rows bigint, rejected bigint, reject_rate double")
    assert [r.src_month for r in gold.reject_alerts(rate, 0.05).collect()] == [2]
    with pytest.raises(RejectRateExceeded, match="2024-02"):
        gold.raise_on_reject_rate(rate, 0.05)
    gold.raise_on_reject_rate(rate, 0.2)


def test_strange_landing_folders_are_an_error_everywhere(spark, layout):
    from strata.layout import available_months, source_units

    land(spark, layout, 2024, 3, [trip()])
    assert [tuple(r) for r in source_units(spark, layout).select("year", "month", "files").collect()] == [(2024, 3, 1)]
    spark.range(1).write.parquet(f"{layout.landing}/period=2024-3")
    for ask in (available_months, source_units):
        with pytest.raises(ValueError, match="period=2024-3"):
            ask(spark, layout)


def test_namespace_and_registered_view(spark, layout):
    bronze.create_namespace(spark, "strata_bronze")
    assert "strata_bronze" in [d.name for d in spark.catalog.listDatabases()]
    land(spark, layout, 2024, 3, [trip(), trip(l_orderkey=2)])
    bronze.run_bronze(spark, layout, "b1")
    VersionedTable(spark, layout.bronze).register("bronze_trips_view")
    assert spark.sql("SELECT count(*) AS n FROM bronze_trips_view").first().n == 2


def test_coalesce_write_reduces_files(spark, layout):
    land(spark, layout, 2024, 3, [trip(l_orderkey=i) for i in range(10)])
    df = bronze.enriched_landing(spark, layout, "b1").repartition(5)
    path = f"{layout.root}/plain_coalesced"
    bronze.write_plain(df, path, "overwrite", coalesce_to=1)
    files = [f for f in spark.read.format("binaryFile").load(f"{path}/year=2024/month=3").select("path").collect()]
    assert len(files) == 1


def test_conform_converts_source_time_zone(spark):
    df = spark.createDataFrame([tuple(trip(o_orderdate=D(2024, 3, 10, 9)).values())], LANDING_SCHEMA)
    raw = df.withColumns({"_batch_id": F.lit("b"), "year": F.lit(2024), "month": F.lit(3)})
    utc = silver.conform(raw).first().pickup_at
    ny = silver.conform(raw, "America/New_York").first().pickup_at
    assert utc == D(2024, 3, 10, 9) and ny == D(2024, 3, 10, 13)  # EDT = UTC-4 on 10 March 2024
