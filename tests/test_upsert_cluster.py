"""Upserts touch only the ranges they meet; clustering by several columns lets each of them skip files."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import cluster, upsert
from strata.operators.dims import DimensionKeyError

DIM = "id long, name string"
CHANGES = "id long, name string, op string"


def files_of(table):
    rows = table.scan_pins(table.pin_rows(table.current_version()), metadata=True).select("_metadata_file").distinct().collect()
    return {r[0] for r in rows}


def test_untouched_ranges_keep_their_files(spark, layout):
    t = upsert.create_keyed(spark, f"{layout.root}/dim", spark.range(0, 100).select("id", F.concat(F.lit("n"), "id").alias("name")), "id", 10)
    before = files_of(t)
    v = t.current_version()
    changes = spark.createDataFrame([(5, "five", "update"), (7, None, "delete"), (95, "x", "update"), (1000, "new", "insert"), (-1, "minus", None), (999, None, "delete")], CHANGES)
    upsert.upsert(t, changes, "id", 10, "op")
    after = files_of(t)
    expected = {i: f"n{i}" for i in range(100)} | {5: "five", 95: "x", 1000: "new", -1: "minus"}
    del expected[7]
    assert {r.id: r["name"] for r in t.read().collect()} == expected
    assert len(before & after) == 8 and not any("key_range=0/" in f or "key_range=9/" in f for f in before & after)
    assert {r.id: r["name"] for r in t.read(version=v).collect()} == {i: f"n{i}" for i in range(100)}  # the old version is as it was
    assert upsert.upsert(t, changes.limit(0), "id", 10, "op") == t.current_version()


def test_many_ranges_share_folders_and_keep_the_version_that_wrote_them(spark, layout, monkeypatch):
    """200 ranges in 20 folders at most, written by several tasks; a range that no change meets keeps its version."""
    monkeypatch.setattr(upsert, "FOLDERS", 20, raising=False)
    rows = spark.range(0, 2000).select("id", F.concat(F.lit("n"), "id").alias("name"))
    t = upsert.create_keyed(spark, f"{layout.root}/dim", rows, "id", 10)
    assert len(t.pin_rows(t.current_version())) <= 20 and 4 <= len(files_of(t)) <= 20
    changes = spark.createDataFrame([(i, "new", "update") for i in range(0, 2000, 20)] + [(15, None, "delete"), (-3, "minus", "insert")], CHANGES)
    upsert.upsert(t, changes, "id", 10, "op")
    expected = {i: ("n" + str(i), 3 if i // 10 % 2 == 0 or i // 10 == 1 else 2) for i in range(2000)} | {i: ("new", 3) for i in range(0, 2000, 20)} | {-3: ("minus", 3)}
    del expected[15]
    assert {r.id: (r["name"], r[upsert.WRITTEN]) for r in t.read().collect()} == expected


def test_a_range_can_be_emptied_and_bad_changes_are_refused(spark, layout):
    t = upsert.create_keyed(spark, f"{layout.root}/dim", spark.createDataFrame([(1, "a"), (11, "b")], DIM), "id", 10)
    upsert.upsert(t, spark.createDataFrame([(1, None, "delete")], CHANGES), "id", 10, "op")
    assert [tuple(r) for r in t.read().select("id", "name").collect()] == [(11, "b")]
    upsert.upsert(t, spark.createDataFrame([(1, "delete")], DIM), "id", 10)  # without an op every change is an upsert
    assert sorted(tuple(r) for r in t.read().select("id", "name").collect()) == [(1, "delete"), (11, "b")]
    with pytest.raises(DimensionKeyError):
        upsert.upsert(t, spark.createDataFrame([(2, "a"), (2, "b")], DIM), "id", 10)
    with pytest.raises(ValueError, match="without"):
        upsert.upsert(t, spark.createDataFrame([(None, "a")], DIM), "id", 10)


def test_numbers_and_interleaving(spark):
    cuts = [2, 5, 5.5, 9]
    df = spark.createDataFrame([(float(v),) for v in range(12)] + [(None,)], "v double")
    got = {r.v: r.n for r in df.select("v", cluster.range_number(F.col("v"), cuts).alias("n")).collect()}
    assert got == {float(v): sum(v > c for c in cuts) for v in range(12)} | {None: 0}
    one = spark.range(1).select(cluster.interleave([F.lit(0b101).cast("long"), F.lit(0b011).cast("long")], 3).alias("z")).first().z
    assert one == 0b100111


def test_each_column_skips_files_and_no_row_is_lost(spark, layout):
    r = random.Random(1)
    rows = [(r.randint(0, 499), r.randint(0, 499), i) for i in range(8000)] + [(None, 3, -1), (4, None, -2)]
    df = spark.createDataFrame(rows, "a int, b int, z0 int").repartition(5)
    path = f"{layout.root}/clustered"
    cluster.cluster_by(df, ["a", "b"], 64).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.columns == df.columns and sorted(map(repr, stored.collect())) == sorted(map(repr, df.collect()))
    for column in ("a", "b"):
        met, files = cluster.files_met(stored, column, 250, 252)
        assert files == 64 and met <= 24
    df.repartitionByRange(64, "a", "b").write.parquet(f"{layout.root}/sorted")
    met, files = cluster.files_met(spark.read.parquet(f"{layout.root}/sorted"), "b", 250, 252)
    assert met == files  # sorted by (a, b), a filter on b skips nothing
    with pytest.raises(ValueError, match="63"):
        cluster.cluster_by(df, ["a", "b"], 4, bits=40)


def test_one_value_and_no_rows(spark):
    same = spark.range(100).select(F.lit(1).alias("a"), F.lit(2).alias("b"), "id")
    assert cluster.cluster_by(same, ["a", "b"], 4).count() == 100
    assert cluster.cluster_by(same.limit(0), ["a", "b"], 4).count() == 0
