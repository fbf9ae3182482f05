from __future__ import annotations

import datetime as dt
import sys
import tempfile
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from strata.layout import Layout  # noqa: E402
from strata.operators.contract import TRIP_CONTRACT, contract_schema  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = (
        SparkSession.builder.master("local[*]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-warehouse-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-tests-"))
    yield s


@pytest.fixture()
def layout(spark) -> Layout:
    return Layout.fresh(spark, f"test-{uuid.uuid4().hex[:6]}")


LANDING_SCHEMA = contract_schema(TRIP_CONTRACT)


def trip(**kw) -> dict:
    """One landed trip row with harmless defaults (a clean trip on 2024-03-10)."""
    row = {
        "l_orderkey": 1, "l_linenumber": 1, "l_suppkey": 1, "l_quantity": 1.0,
        "l_extendedprice": 100.0, "l_discount": 0.05, "l_tax": 0.02, "l_returnflag": "N",
        "l_shipdate": dt.datetime(2024, 3, 10, 12), "o_orderdate": dt.datetime(2024, 3, 10, 9),
        "o_orderstatus": "F", "o_orderpriority": "1-URGENT", "c_acctbal": 10.0,
    }
    row.update(kw)
    return row


def land(spark, layout: Layout, year: int, month: int, rows: list[dict], schema=LANDING_SCHEMA, mode="overwrite"):
    """Write hand-made rows as one reload unit."""
    df = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
    df.coalesce(1).write.mode(mode).parquet(layout.unit_path(year, month))


def zones_frame(spark, ids=(1, 2, 3)):
    rows = [(str(i), f"zone {i}", "north" if i % 2 else "south") for i in ids]
    return spark.createDataFrame(rows, "location_id string, zone_name string, borough string")
