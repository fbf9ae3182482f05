"""The experiment behind ``bench_table`` runs whole: every value three times, and its seconds are reported."""

from collections import Counter

import __spark_entry__ as entry
from strata.plans import tuning

from conftest import SF_SMALL

PARTITIONS = "spark.sql.shuffle.partitions"


def test_every_value_runs_three_times_and_is_reported(spark, monkeypatch):
    runs, plain = [], tuning.run_noop

    def watched(df):
        runs.append((spark.conf.get(PARTITIONS), spark.conf.get(tuning.FREED)))
        return plain(df)

    before = spark.conf.get(PARTITIONS), spark.conf.get(tuning.FREED)
    monkeypatch.setattr(tuning, "run_noop", watched)
    rows = entry.queries()["bench_table"](spark, SF_SMALL).collect()
    assert Counter(runs) == {(str(v), "true"): 3 for v in (2, 8, 64, 200)}
    assert [r.value for r in rows] == ["2", "8", "64", "200"] and {r.variable for r in rows} == {PARTITIONS}
    assert all(0 < r.min_sec <= r.median_sec <= r.max_sec and r.exchanges > 0 and r.joins for r in rows)
    assert (spark.conf.get(PARTITIONS), spark.conf.get(tuning.FREED)) == before
