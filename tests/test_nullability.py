"""NULL counts come from footers, and what changed between deliveries is found."""

import logging
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from strata.operators import bronze, nullability
from strata.operators.contract import TRIP_CONTRACT, contract_schema

from conftest import land, trip


def three_months(spark, layout):
    land(spark, layout, 2024, 1, [trip(), trip(l_tax=None)])
    land(spark, layout, 2024, 2, [trip(l_returnflag=None), trip()])
    land(spark, layout, 2024, 3, [trip(l_returnflag=None, c_acctbal=None), trip(l_returnflag=None, c_acctbal=None)])


EXPECTED = [
    (2024, 2, "l_tax", "no null", 1, 0, 2), (2024, 2, "l_returnflag", "some null", 0, 1, 2),
    (2024, 3, "l_returnflag", "turned null", 1, 2, 2), (2024, 3, "c_acctbal", "turned null", 0, 2, 2),
]


def test_changes_between_units(spark, layout):
    three_months(spark, layout)
    assert [tuple(c) for c in nullability.null_changes(spark, layout)] == EXPECTED
    assert [tuple(c) for c in nullability.null_changes(spark, layout, [(2024, 3)])] == EXPECTED[2:]
    assert nullability.null_changes(spark, layout, [(2024, 1)]) == []
    assert sorted(map(tuple, nullability.changes_frame(spark, nullability.null_changes(spark, layout)).collect())) == sorted(EXPECTED)


def test_counts_are_answered_from_footers(spark, layout):
    three_months(spark, layout)
    schema = contract_schema(TRIP_CONTRACT)
    df = nullability.footer_counts(spark, layout, [(2024, 1), (2024, 2)], list(TRIP_CONTRACT), schema)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(" in plan
    assert sorted((r.period, r["rows"]) for r in df.collect()) == [("2024-01", 2), ("2024-02", 2)]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as before


def test_files_without_statistics_are_read(spark, layout):
    """One file was written without column statistics: only its unit is counted by rows, with the same result."""
    three_months(spark, layout)
    month = spark.read.parquet(layout.unit_path(2024, 2))
    rows = pa.Table.from_pylist([r.asDict() for r in month.collect()], schema=pa.schema([
        pa.field(f.name, {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "timestamp_ntz": pa.timestamp("us")}[f.dataType.simpleString()])
        for f in contract_schema(TRIP_CONTRACT).fields
    ]))
    unit = Path(layout.unit_path(2024, 2).removeprefix("file:"))
    for f in unit.glob("*.parquet"):
        pq.write_table(rows if f == next(iter(sorted(unit.glob("*.parquet")))) else rows.slice(0, 0), f, write_statistics=False)
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    assert [tuple(c) for c in nullability.null_changes(spark, layout)] == EXPECTED


def test_a_run_logs_what_changed(spark, layout, caplog):
    three_months(spark, layout)
    with caplog.at_level(logging.WARNING):
        bronze.run_bronze(spark, layout, "b1")
    assert [m for m in caplog.messages if "c_acctbal" in m] == ["period=2024-03: `c_acctbal` has turned null: 2 of 2, before 0 NULLs"]


def test_empty_units_are_passed_over(spark, layout):
    land(spark, layout, 2024, 1, [trip()])
    land(spark, layout, 2024, 2, [])
    land(spark, layout, 2024, 3, [trip(l_tax=None)])
    assert [(c.month, c.column, c.kind) for c in nullability.null_changes(spark, layout)] == [(3, "l_tax", "turned null")]
    assert nullability.null_counts(spark, layout, []) == []
