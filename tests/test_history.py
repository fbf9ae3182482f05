"""Versioned table: snapshots, time travel, rollback, undo, diff, compaction, expiry, crash."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.history import HistoryError, VersionedTable, list_subdirs

T0 = dt.datetime(2024, 1, 1)


def at(h):
    return T0 + dt.timedelta(hours=h)


def rows(spark, months, batch, per_month=3):
    data = [(i, y, m, batch) for (y, m) in months for i in range(per_month)]
    return spark.createDataFrame(data, "id bigint, year int, month int, batch string")


@pytest.fixture()
def table(spark, layout):
    schema = rows(spark, [(2024, 1)], "x").schema
    return VersionedTable.create(spark, f"{layout.root}/t", schema, ["year", "month"], committed_at=at(0))


def count(t, **kw):
    return t.read(**kw).count()


def test_lifecycle_counts_parents_and_expiry(spark, table):
    t = table
    assert count(t) == 0  # version 1 is the empty table
    v2 = t.write(rows(spark, [(2024, 1), (2024, 2)], "a"), batch_id="a", committed_at=at(1))
    v3 = t.write(rows(spark, [(2024, 2), (2024, 3)], "b", per_month=5), batch_id="b", committed_at=at(2))
    assert (count(t, version=v2), count(t, version=v3)) == (6, 13)  # month 2 replaced, 1 kept, 3 added
    t.rollback(v2, committed_at=at(3))
    assert t.current_version() == v2 and count(t) == 6
    v4 = t.write(rows(spark, [(2024, 4)], "c"), batch_id="c", committed_at=at(4))
    assert [r.parent for r in t.snapshots().where(F.col("version") == v4).collect()] == [v2]
    assert v4 == 4  # a fresh number even though the pointer went back
    t.set_current(v3, committed_at=at(5))
    assert count(t) == 13
    with pytest.raises(HistoryError):
        t.rollback(v4)  # v4 is not an ancestor of v3
    t.expire(older_than=at(10), retain_last=2, expired_at=at(6))
    live = [r.version for r in t.snapshots().collect()]
    assert v3 in live and len(live) == 2
    assert count(t) == 13  # the current version survives expiry
    with pytest.raises(HistoryError):
        t.read(version=1)


def test_as_of_time_and_snapshot_records(spark, table):
    t = table
    t.write(rows(spark, [(2024, 1)], "a"), batch_id="a", committed_at=at(1))
    t.write(rows(spark, [(2024, 1)], "b", per_month=4), batch_id="b", committed_at=at(2))
    assert count(t, as_of=at(1.5)) == 3
    with pytest.raises(HistoryError):
        t.read(as_of=T0 - dt.timedelta(days=1))
    snap = {r.version: (r.added_records, r.deleted_records) for r in t.snapshots().collect()}
    assert snap == {1: (0, 0), 2: (3, 0), 3: (4, 3)}


def test_scope_empties_a_partition(spark, table):
    t = table
    t.write(rows(spark, [(2024, 1), (2024, 2)], "a"), committed_at=at(1))
    t.write(rows(spark, [(2024, 1)], "b"), scope=[(2024, 1), (2024, 2)], committed_at=at(2))
    assert {(r.month, r.batch) for r in t.read().select("month", "batch").distinct().collect()} == {(1, "b")}


def test_undo_batch_keeps_later_good_partitions(spark, table):
    t = table
    t.write(rows(spark, [(2024, 1), (2024, 2)], "good"), batch_id="good", committed_at=at(1))
    t.write(rows(spark, [(2024, 2)], "bad"), batch_id="bad", committed_at=at(2))
    t.write(rows(spark, [(2024, 3)], "later"), batch_id="later", committed_at=at(3))
    t.undo_batch("bad", committed_at=at(4))
    got = {(r.month, r.batch) for r in t.read().select("month", "batch").distinct().collect()}
    assert got == {(1, "good"), (2, "good"), (3, "later")}


def test_diff_and_commit_delta(spark, table):
    t = table
    a = t.write(rows(spark, [(2024, 1), (2024, 2)], "a"), committed_at=at(1))
    b = t.write(rows(spark, [(2024, 2)], "b"), committed_at=at(2))
    d = {(r._change, r.batch) for r in t.diff(a, b).select("_change", "batch").distinct().collect()}
    assert d == {("removed", "a"), ("added", "b")}
    assert t.diff(a, b).count() == 6
    delta = {(r.month, r.data_version, r.status) for r in t.commit_delta(b).collect()}
    assert delta == {(1, a, "existing"), (2, a, "deleted"), (2, b, "added")}
    m = t.manifests(b).first()
    assert (m.added_partitions, m.existing_partitions, m.deleted_partitions) == (1, 1, 1)
    assert (m.added_records, m.deleted_records) == (3, 3)


def test_compact_keeps_rows_and_writes_few_files(spark, table):
    t = table
    for i in range(4):
        t.append(rows(spark, [(2024, 1)], f"r{i}").repartition(3), committed_at=at(i + 1))
    before = t.read().groupBy("batch").count().collect()
    files_before = t.files().count()
    t.compact(rows_per_file=1000, sort_by=["id"], committed_at=at(9))
    assert sorted(before) == sorted(t.read().groupBy("batch").count().collect())
    assert t.files().count() == 1 < files_before
    ids = [r.id for r in t.read().collect()]
    assert ids == sorted(ids)  # clustered inside the file


def test_crashed_write_is_invisible_and_an_orphan(spark, table):
    t = table
    t.write(rows(spark, [(2024, 1)], "a"), committed_at=at(1))
    crashed = t.next_version()
    (rows(spark, [(2024, 1)], "crash").withColumn("_version", F.lit(crashed))
     .write.mode("append").partitionBy("_version", "year", "month").parquet(t.data_path))
    assert count(VersionedTable(spark, t.root)) == 3
    assert [r.data_version for r in t.orphans().collect()] == [crashed]
    assert t.next_version() == crashed + 1  # the crashed number is never reused
    assert t.remove_orphans(older_than=dt.datetime(2999, 1, 1)) == [crashed]
    assert t.orphans().count() == 0


def test_expire_keeps_data_a_retained_version_needs(spark, table):
    t = table
    v2 = t.write(rows(spark, [(2024, 1), (2024, 2)], "a"), committed_at=at(1))
    t.write(rows(spark, [(2024, 2)], "b"), committed_at=at(2))
    _, plan = t.expire_plan(older_than=at(10), retain_last=1)
    # month 1 of v2 is still pinned by the current version: only month 2 of v2 goes
    assert {(r.data_version, r.month) for r in plan.collect()} == {(v2, 2)}


@pytest.mark.parametrize("kind", ["int", "string", "date", "boolean"])
def test_null_partition_values_are_read(spark, layout, kind):
    df = spark.range(6)
    value = {"int": "id", "string": "concat('a ', id)", "date": "date_add(DATE'2024-01-01', CAST(id AS INT))", "boolean": "id > 2"}[kind]
    df = df.selectExpr("id", f"CAST(IF(id % 3 = 0, NULL, {value}) AS {kind}) AS p")
    t = VersionedTable.create(spark, f"{layout.root}/n-{kind}", df.schema, ["p"], committed_at=at(0))
    t.write(df, committed_at=at(1))
    want = sorted(map(str, df.collect()))
    assert sorted(map(str, VersionedTable(spark, t.root).read().collect())) == want
    t.write(df.where("p IS NULL").selectExpr("id + 100 AS id", "p"), committed_at=at(2))
    assert sorted(r.id for r in t.read().where("p IS NULL").collect()) == [100, 103]
    assert t.read().count() == 6
    t.compact(rows_per_file=1, committed_at=at(3))
    assert sorted(r.id for r in t.read().collect()) == [1, 2, 4, 5, 100, 103]


def test_partition_type_without_a_stable_spelling_is_refused(spark, layout):
    with pytest.raises(HistoryError, match="cannot partition"):
        VersionedTable.create(spark, f"{layout.root}/d", spark.createDataFrame([], "id int, p double").schema, ["p"])


def test_undo_batch_that_wrote_a_partition_twice(spark, table):
    t = table
    t.write(rows(spark, [(2024, 1)], "bad", per_month=1), batch_id="bad", committed_at=at(1))
    t.write(rows(spark, [(2024, 1)], "good", per_month=3), batch_id="good", committed_at=at(2))
    t.write(rows(spark, [(2024, 1)], "bad", per_month=2), batch_id="bad", committed_at=at(3))
    t.undo_batch("bad", committed_at=at(4))
    assert t.read().count() == 3


def test_undo_after_the_needed_version_expired_is_refused(spark, table):
    t = table
    t.write(rows(spark, [(2024, 1)], "good"), batch_id="good", committed_at=at(1))
    t.write(rows(spark, [(2024, 1)], "bad"), batch_id="bad", committed_at=at(2))
    t.expire(at(9), retain_last=1)
    with pytest.raises(HistoryError, match="expired"):
        t.undo_batch("bad")
    assert t.read().count() == 3


def test_compact_rewrites_the_latest_version(spark, table):
    t = table
    t.write(rows(spark, [(2024, 1)], "a", per_month=1), committed_at=at(1))
    stale = VersionedTable(spark, t.root)
    assert stale.read().count() == 1
    t.write(rows(spark, [(2024, 1)], "b", per_month=2), committed_at=at(2))
    stale.compact(committed_at=at(3))
    assert VersionedTable(spark, t.root).read().count() == 2


def test_later_columns_do_not_show_in_earlier_versions_or_after_a_rollback(spark, table):
    t = table
    v = t.write(rows(spark, [(2024, 1)], "a"), committed_at=at(1))
    before = t.read().columns
    w = t.write(rows(spark, [(2024, 2)], "b").withColumn("added", F.lit(1)), committed_at=at(2))
    assert t.read(version=v).columns == before and "added" in t.read(version=w).columns
    t.rollback(v, committed_at=at(3))
    assert t.read().columns == before


def test_an_older_shape_lands_again_and_another_type_does_not(spark, table):
    t = table
    t.write(rows(spark, [(2024, 2)], "b").withColumn("added", F.lit(1)), committed_at=at(1))
    t.write(rows(spark, [(2024, 1)], "a"), committed_at=at(2))
    got = t.read().groupBy("month").agg(F.count("added").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    assert {(r.month, r.n, r.rows) for r in got} == {(1, 0, 3), (2, 3, 3)}
    with pytest.raises(HistoryError, match="other types"):
        t.write(rows(spark, [(2024, 3)], "c").withColumn("added", F.lit("x")))
    assert t.read().count() == 6


def test_string_partition_column(spark, layout):
    df = spark.createDataFrame([(1, "a b"), (2, "c/d"), (3, "a b")], "id bigint, region string")
    t = VersionedTable.create(spark, f"{layout.root}/s", df.schema, ["region"], committed_at=at(0))
    t.write(df, committed_at=at(1))
    t.write(spark.createDataFrame([(9, "c/d")], df.schema), committed_at=at(2))
    got = sorted((r.id, r.region) for r in t.read().collect())
    assert got == [(1, "a b"), (3, "a b"), (9, "c/d")]


def test_expire_deletes_escaped_string_partition_folders(spark, layout):
    df = spark.createDataFrame([(1, "a b"), (2, "c/d")], "id bigint, region string")
    t = VersionedTable.create(spark, f"{layout.root}/e", df.schema, ["region"], committed_at=at(0))
    v1 = t.write(df, committed_at=at(1))
    t.write(spark.createDataFrame([(9, "c/d")], df.schema), committed_at=at(2))
    done = t.expire(older_than=at(10), retain_last=1, expired_at=at(3))
    assert [(r.data_version, r.region) for r in done.collect()] == [(v1, "c/d")]
    folders = set(list_subdirs(spark, f"{t.data_path}/_version={v1}"))
    assert folders == {"region=a b"}  # region=c%2Fd was deleted, the retained one stays
    assert sorted(r.id for r in t.read().collect()) == [1, 9]


def test_replace_always_covers_written_partitions(spark, table):
    t = table
    t.write(rows(spark, [(2024, 1), (2024, 2)], "a"), committed_at=at(1))
    # scope names month 1 only, but month 2 is written too: both are replaced
    t.write(rows(spark, [(2024, 2)], "b"), scope=[(2024, 1)], committed_at=at(2))
    got = sorted((r.month, r.batch) for r in t.read().select("month", "batch").distinct().collect())
    assert got == [(2, "b")]


def test_recent_orphans_survive_the_safety_window(spark, table):
    t = table
    t.write(rows(spark, [(2024, 1)], "a"), committed_at=at(1))
    crashed = t.next_version()
    (rows(spark, [(2024, 1)], "crash").withColumn("_version", F.lit(crashed))
     .write.mode("append").partitionBy("_version", "year", "month").parquet(t.data_path))
    assert t.remove_orphans(older_than=dt.datetime(2000, 1, 1)) == []  # written just now: kept
    assert [r.data_version for r in t.orphans().collect()] == [crashed]


def test_two_instances_never_reuse_a_commit_number(spark, table):
    t = table
    other = VersionedTable(spark, t.root)
    assert other.current_version() == 1  # other caches the log now
    t.write(rows(spark, [(2024, 1)], "a"), committed_at=at(1))
    v = other.write(rows(spark, [(2024, 2)], "b"), committed_at=at(2))  # stale instance writes next
    log = [(r.seq, r.version, r.parent) for r in VersionedTable(spark, t.root).history().collect()]
    assert log == [(1, 1, None), (2, 2, 1), (3, v, 2)]
    assert VersionedTable(spark, t.root).read().count() == 6  # month 1 from "a" kept, month 2 added
