"""Dimension history and change feeds: order of arrival never matters, as-of joins equal a nested loop."""

import datetime as dt
import itertools
import random

import pytest

from strata.operators import cdc, scd2

D = dt.datetime
KEYS = ["zone"]
FEED = "zone int, effective timestamp_ntz, recorded timestamp_ntz, tariff string"
HISTORY = "zone int, tariff string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED)


def history_of(spark, batches):
    known = feed(spark, [])
    for b in batches:
        known = scd2.merge_changes(known, feed(spark, b), KEYS)
    return scd2.intervals(known, KEYS)


def plain_history(changes):
    """By hand: last record of each moment, runs of equal tariffs joined."""
    last = {}
    for z, e, r, t in sorted(changes, key=lambda c: (c[2], c[3] is not None, c[3] or "")):
        if e is not None:
            last[z, e] = t
    out = []
    for z in {z for z, _ in last}:
        runs = []
        for e in sorted(e for k, e in last if k == z):
            if not runs or runs[-1][1] != last[z, e]:
                runs.append((e, last[z, e]))
        for (e, t), following in itertools.zip_longest(runs, runs[1:]):
            out.append((z, t, e, following[0] if following else None, following is None))
    return out


CHANGES = [
    (1, D(2024, 1, 1), D(2024, 1, 2), "a"), (1, D(2024, 2, 1), D(2024, 2, 2), "a"), (1, D(2024, 3, 1, 12), D(2024, 3, 2), "b"),
    (1, D(2024, 2, 1), D(2024, 5, 1), "c"),  # a correction of February, known in May
    (2, D(2024, 1, 1), D(2024, 1, 2), "a"), (2, D(2023, 6, 1), D(2024, 6, 1), "z"),  # a late, earlier moment
    (3, D(2024, 1, 1), D(2024, 1, 2), None), (3, D(2024, 4, 1), D(2024, 1, 2), "q"),
    (4, D(2024, 1, 1), D(2024, 1, 2), "x"), (4, D(2024, 1, 1), D(2024, 1, 2), "y"),  # known at the same time
    (5, None, D(2024, 1, 2), "no moment"),
]


def test_history_is_the_same_in_any_order_of_batches(spark):
    expected = sorted(plain_history(CHANGES), key=repr)
    assert (1, "c", D(2024, 2, 1), D(2024, 3, 1, 12), False) in expected and (2, "z", D(2023, 6, 1), D(2024, 1, 1), False) in expected
    r = random.Random(1)
    for _ in range(4):
        rows = CHANGES + r.sample(CHANGES, 3)  # repeated changes
        r.shuffle(rows)
        cut = sorted(r.sample(range(len(rows)), 2))
        h = history_of(spark, [rows[: cut[0]], rows[cut[0] : cut[1]], rows[cut[1] :]])
        assert sorted(map(tuple, h.collect()), key=repr) == expected
        assert scd2.overlaps(h, KEYS).count() == 0


def test_overlaps_are_found(spark):
    rows = [(1, "a", D(2024, 1, 1), D(2024, 3, 1), False), (1, "b", D(2024, 2, 1), None, True), (2, "a", D(2024, 1, 1), D(2024, 1, 1), False), (3, "a", D(2024, 1, 1), None, True)]
    assert {r.zone for r in scd2.overlaps(spark.createDataFrame(rows, HISTORY), KEYS).collect()} == {1, 2}


def test_as_of_join_equals_a_nested_loop(spark):
    r = random.Random(2)
    changes = [(r.randint(1, 6), D(2023, 1, 1) + dt.timedelta(hours=r.randint(0, 20_000)), D(2026, 1, 1), r.choice("abc")) for _ in range(150)]
    history = history_of(spark, [changes])
    rows = history.collect()
    trips = [(i, r.randint(0, 7) or None, D(2022, 12, 1) + dt.timedelta(minutes=r.randint(0, 1_300_000)) if r.random() < 0.95 else None) for i in range(400)]
    trips += [(1000 + i, h.zone, t) for i, h in enumerate(rows) for t in (h.valid_from, h.valid_to or h.valid_from)]  # on the edges
    facts = spark.createDataFrame(trips, "id int, zone int, at timestamp_ntz")
    expected = sorted(
        ((i, z, t, next((h.tariff for h in rows if h.zone == z and t and h.valid_from <= t and (h.valid_to is None or t < h.valid_to)), None)) for i, z, t in trips), key=repr
    )
    for step in ("month", "quarter", "year"):
        got = scd2.as_of_join(facts, history, [("zone", "zone")], "at", prefix="zone_", step=step)
        assert got.columns == ["id", "zone", "at", "zone_tariff"]
        assert sorted(map(tuple, got.collect()), key=repr) == expected
    with pytest.raises(ValueError, match="prefix"):
        scd2.as_of_join(got, history, [("zone", "zone")], "at", prefix="zone_")


def test_as_of_join_has_no_cross_join_and_takes_no_rows(spark):
    history = history_of(spark, [CHANGES])
    facts = spark.createDataFrame([(1, 1, D(2024, 2, 5))], "id int, zone int, at timestamp_ntz")
    plan = scd2.as_of_join(facts, history, [("zone", "zone")], "at")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert scd2.as_of_join(facts.limit(0), history, [("zone", "zone")], "at").count() == 0
    assert [r.tariff for r in scd2.as_of_join(facts, history.limit(0), [("zone", "zone")], "at").collect()] == [None]


CDC = "key int, seq int, op string, price double"


def plain_state(rows):
    rank = lambda r: (r[1] is not None, r[1] or 0, r[2] == "delete", r[2] or "", r[3] or 0)
    last = {}
    for row in rows:
        if row[0] not in last or rank(row) > rank(last[row[0]]):
            last[row[0]] = row
    return sorted(((k, s, p) for k, s, op, p in last.values() if op != "delete"), key=repr)


def test_state_is_the_same_in_any_order_of_batches(spark):
    r = random.Random(3)
    rows = [(r.randint(1, 12), r.choice([None, *range(8)]), r.choice(["insert", "update", "delete"]), float(r.randint(0, 9))) for _ in range(120)]
    expected = plain_state(rows)
    batches = [rows[:40], rows[40:80], rows[80:]]
    for order in itertools.permutations(batches):
        frames = [spark.createDataFrame(b, CDC) for b in order]
        assert sorted(map(tuple, cdc.current(cdc.apply_all(frames, ["key"], "seq")).collect()), key=repr) == expected
    twice = [spark.createDataFrame(b, CDC) for b in (rows, rows[::-1])]  # delivered again
    assert sorted(map(tuple, cdc.current(cdc.apply_all(twice, ["key"], "seq")).collect()), key=repr) == expected


def test_a_late_older_change_does_not_bring_a_row_back(spark):
    state = cdc.apply_changes(None, spark.createDataFrame([(1, 5, "delete", 0.0), (2, 1, "insert", 1.0)], CDC), ["key"], "seq")
    state = cdc.apply_changes(state, spark.createDataFrame([(1, 4, "update", 9.0)], CDC), ["key"], "seq")
    assert [tuple(r) for r in cdc.current(state).collect()] == [(2, 1, 1.0)]
    again = cdc.apply_changes(state, spark.createDataFrame([(1, 6, "insert", 3.0)], CDC), ["key"], "seq")
    assert sorted(map(tuple, cdc.current(again).collect())) == [(1, 6, 3.0), (2, 1, 1.0)]
    assert sorted(r.key for r in cdc.compact_tombstones(state, "seq", 6).collect()) == [2]
    assert sorted(r.key for r in cdc.compact_tombstones(state, "seq", 5).collect()) == [1, 2]


def test_empty_feed(spark):
    empty = spark.createDataFrame([], CDC)
    assert cdc.current(cdc.apply_all([empty, empty], ["key"], "seq")).count() == 0
    assert scd2.intervals(feed(spark, []), KEYS).count() == 0
