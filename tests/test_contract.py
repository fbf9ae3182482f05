"""Schema contract cases (E1-E7): ok / added / missing / retyped / reordered / renamed / two faults."""

import pytest
from pyspark.sql import functions as F

from strata.operators.contract import (
    TRIP_CONTRACT,
    SchemaContractError,
    check_schema,
    describe_schema,
    null_profile,
)

from strata.layout import available_months
from strata.operators.bronze import check_units

from conftest import LANDING_SCHEMA, land, trip


@pytest.fixture()
def probe(spark):
    return spark.createDataFrame([tuple(trip().values())], LANDING_SCHEMA)


def test_unchanged_passes(probe):
    assert check_schema(probe) == []


def test_added_column_passes_and_is_reported(probe):
    found = check_schema(probe.withColumn("surge_fee", F.lit(1.0)))
    assert [(f.column, f.kind, f.actual) for f in found] == [("surge_fee", "added", "double")]


def test_missing_column_raises(probe):
    with pytest.raises(SchemaContractError, match="l_quantity"):
        check_schema(probe.drop("l_quantity"))


def test_retyped_column_raises_with_both_types(probe):
    with pytest.raises(SchemaContractError, match="`l_discount` is string, agreed is double"):
        check_schema(probe.withColumn("l_discount", F.col("l_discount").cast("string")))


def test_reordered_columns_pass(probe):
    assert check_schema(probe.select(*reversed(probe.columns))) == []


def test_rename_is_missing_plus_added(probe):
    with pytest.raises(SchemaContractError, match=r"`l_tax` \(double\) is missing"):
        check_schema(probe.withColumnRenamed("l_tax", "tax_rate"))


def test_two_faults_in_one_error(probe):
    bad = probe.drop("l_quantity").withColumn("l_tax", F.col("l_tax").cast("string"))
    with pytest.raises(SchemaContractError) as e:
        check_schema(bad)
    assert "l_quantity" in str(e.value) and "l_tax" in str(e.value)


def test_contract_printer_round_trips(probe):
    assert describe_schema(probe.schema) == TRIP_CONTRACT


def test_null_profile_counts_in_one_pass(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    got = {r.column: (r.nulls, r.rows) for r in null_profile(df).collect()}
    assert got == {"a": (1, 3), "b": (2, 3)}


def test_one_bad_file_fails_the_unit(spark, layout):
    land(spark, layout, 2024, 3, [trip(), trip()])
    land(spark, layout, 2024, 4, [trip()])
    bad = spark.createDataFrame([tuple(trip().values())], LANDING_SCHEMA).drop("l_tax")
    bad.coalesce(1).write.mode("append").parquet(layout.unit_path(2024, 3))
    for _ in range(3):
        with pytest.raises(SchemaContractError, match="period=2024-03/.*`l_tax`"):
            check_units(spark, layout, [(2024, 3), (2024, 4)])
    assert check_units(spark, layout, [(2024, 4)]) == []


def test_a_folder_that_is_no_unit_is_reported(spark, layout):
    land(spark, layout, 2024, 3, [trip()])
    spark.range(1).write.parquet(f"{layout.landing}/period=2024-1")
    with pytest.raises(ValueError, match="period=2024-1'"):
        available_months(spark, layout)
