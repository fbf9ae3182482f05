"""Build the stored layers once per session and scale factor (Q14-Q17).

``build_layers`` returns an object that stages the landing zone from the given
tables, lands it in bronze, rebuilds silver (with rejects) and gold, and plays
a fixed history on further bronze tables (reruns, a partial reload, rollback,
roll-forward, undo of a batch, compaction, expiry) -- each stage on first use.  Batch ids and commit times are fixed so every
result is reproducible.  Everything is written under the session's shared
checkpoint folder; the returned object only holds paths and version numbers.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.layout import Layout, available_months
from strata.operators import bronze as bronze_ops
from strata.operators import dims, gold, history, silver
from strata.operators.quality import outside_period
from strata.sources import read_zone_csv, stage_landing, stage_zone_csv

# The scenario's clock and batch ids.
T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
RUN_1, RUN_2, RUN_3 = "run-1", "run-2", "run-3"
PARTIAL_RELOAD_YEAR = 1996
LATE_TOLERANCE_MONTHS = 3
SMALL_FILE_ROWS = 600


def at(hours: float) -> dt.datetime:
    return T0 + dt.timedelta(hours=hours)


class Built:
    """Stored layers of one scale factor in one session, each built on first use.

    landing -> bronze -> silver (+ rejects) -> gold; the late-data silver, the
    time-travel table and the maintenance table hang off bronze.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.layout = Layout.fresh(spark, "layers")
        self._done: dict[str, object] = {}
        self._lock = threading.RLock()

    def _once(self, name: str, fn):
        with self._lock:
            if name not in self._done:
                self._done[name] = fn()
            return self._done[name]

    # ---------------------------------------------------------------- stages
    def landing(self) -> str:
        def go():
            stage_landing(self.spark, self.sf_dir, self.layout)
            return self.layout.landing
        return self._once("landing", go)

    def landing_layout(self) -> Layout:
        self.landing()
        return self.layout

    def landing_months(self) -> list[tuple[int, int]]:
        return self._once("landing_months", lambda: available_months(self.spark, self.landing_layout()))

    def zone_csv(self) -> str:
        return self._once("zone_csv", lambda: stage_zone_csv(self.spark, self.sf_dir, self.layout))

    def zones(self) -> DataFrame:
        return dims.conform_zones(read_zone_csv(self.spark, self.zone_csv()))

    def dim_zone(self) -> DataFrame:
        """The stored zone dimension (built from the zone CSV once per layout)."""
        def go():
            dims.store_dim_zone(dims.build_dim_zone(self.zones()), self.layout.dim_zone)
            return self.layout.dim_zone
        return self.spark.read.parquet(self._once("dim_zone", go))

    def bronze_version(self) -> int:
        def go():
            self.landing()
            return bronze_ops.run_bronze(self.spark, self.layout, RUN_1, committed_at=at(1))
        return self._once("bronze", go)

    def bronze_table(self) -> history.VersionedTable:
        self.bronze_version()
        return history.VersionedTable(self.spark, self.layout.bronze)

    def bronze(self) -> DataFrame:
        return self.bronze_table().read()

    def months(self) -> list[tuple[int, int]]:
        return sorted({(r.year, r.month) for r in self.bronze_table().pin_rows(self.bronze_version())})

    def silver_versions(self) -> silver.SilverRun:
        def go():
            self.bronze_version()
            return silver.run_silver(self.spark, self.layout, self.dim_zone(), RUN_1, committed_at=at(1))
        return self._once("silver", go)

    def silver(self) -> DataFrame:
        self.silver_versions()
        return silver.read_silver(self.spark, self.layout)

    def rejects(self) -> DataFrame:
        self.silver_versions()
        return silver.read_rejects(self.spark, self.layout)

    @property
    def late_silver_root(self) -> str:
        return f"{self.layout.root}/silver/trips_by_dropoff"

    def late_silver(self) -> DataFrame:
        """Silver placed by dropoff time with a 3-month tolerance, then one month reprocessed."""
        def go():
            self.bronze_version()
            months = self.months()
            self._run_late(self.late_silver_root, RUN_1, at(1))
            self._run_late(self.late_silver_root, RUN_2, at(2), months=[months[len(months) // 2]])
            return True
        self._once("late", go)
        return silver.read_kept(self.late_table())

    def _run_late(self, root: str, batch: str, when: dt.datetime, **options) -> None:
        rules = [outside_period("dropoff_at", "src_year", "src_month", LATE_TOLERANCE_MONTHS)]
        silver.run_silver(
            self.spark, self.layout, self.dim_zone(), batch, committed_at=when, tolerance_months=LATE_TOLERANCE_MONTHS,
            event="dropoff_at", rules=rules, silver_root=root, **options,
        )

    def sized_table(self) -> history.VersionedTable:
        """Late-data silver built twice with small files: the second run knows each month's rows."""
        root = f"{self.layout.root}/silver/trips_sized"
        def go():
            self.bronze_version()
            for batch, when in ((RUN_1, at(1)), (RUN_2, at(2))):
                self._run_late(root, batch, when, rows_per_file=SMALL_FILE_ROWS)
            return root
        return history.VersionedTable(self.spark, self._once("sized", go))

    def late_table(self) -> history.VersionedTable:
        return history.VersionedTable(self.spark, self.late_silver_root)

    @property
    def hist_root(self) -> str:
        return f"{self.layout.root}/bronze/trips_history"

    @property
    def maint_root(self) -> str:
        return f"{self.layout.root}/bronze/trips_maintenance"

    def hist(self) -> dict:
        def go():
            self.bronze_version()
            return play_history(self.spark, self.layout, self.hist_root, self.months())
        return self._once("hist", go)

    def history_table(self) -> history.VersionedTable:
        self.hist()
        return history.VersionedTable(self.spark, self.hist_root)

    def maint(self) -> dict:
        def go():
            self.bronze_version()
            return play_maintenance(self.spark, self.layout, self.maint_root, self.months())
        return self._once("maint", go)

    def maintenance_table(self) -> history.VersionedTable:
        self.maint()
        return history.VersionedTable(self.spark, self.maint_root)

    def gold_paths(self) -> dict:
        def go():
            sv = self.silver_versions().silver_version
            return gold.build_gold(
                self.spark, self.silver(), sv, self.layout.gold,
                rejects=self.rejects(), bridge=dims.zone_cells(self.zones()),
                kept=silver.kept_by_source(history.VersionedTable(self.spark, self.layout.silver)),
            )
        return self._once("gold", go)


_CACHE: dict[tuple[str, str], Built] = {}
_LOCK = threading.Lock()


def build_layers(spark: SparkSession, sf_dir: str) -> Built:
    """The (lazily built) stored layers for ``sf_dir`` in this session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        hit = _CACHE.get(key)
        if hit is None or not history.path_exists(spark, hit.layout.root) and hit._done:
            hit = _CACHE[key] = Built(spark, sf_dir)
        return hit


def play_history(spark: SparkSession, layout: Layout, root: str, months: list[tuple[int, int]]) -> dict:
    """The fixed time-travel scenario; returns the version reached by each step.

    create -> run-1 (all months) -> run-2 (all months) -> run-3 (reload of one
    year) -> rollback to run-1 -> set_current to run-3 -> undo run-3.
    """
    h: dict = {}
    schema = history.VersionedTable(spark, layout.bronze).schema()
    t = history.VersionedTable.create(spark, root, schema, ["year", "month"], committed_at=at(0))
    h["create"] = 1
    h["run1"] = t.replace_partitions(_landed(spark, layout, months, RUN_1), batch_id=RUN_1, committed_at=at(1))
    h["run2"] = t.replace_partitions(_landed(spark, layout, months, RUN_2), batch_id=RUN_2, committed_at=at(2))
    partial = [ym for ym in months if ym[0] == PARTIAL_RELOAD_YEAR]
    h["partial"] = t.replace_partitions(_landed(spark, layout, partial, RUN_3), batch_id=RUN_3, committed_at=at(3))
    t.rollback(h["run1"], committed_at=at(4))
    h["after_rollback"] = t.current_version()
    t.set_current(h["partial"], committed_at=at(5))
    h["after_set_current"] = t.current_version()
    h["undo"] = t.undo_batch(RUN_3, committed_at=at(6))
    return h


def play_maintenance(spark: SparkSession, layout: Layout, root: str, months: list[tuple[int, int]]) -> dict:
    """The fixed maintenance scenario on its own table (expiry removes versions).

    create -> run-1 -> run-3 (reload of one year) -> undo run-3 -> compact ->
    expire (keep the last two versions).
    """
    h: dict = {}
    schema = history.VersionedTable(spark, layout.bronze).schema()
    t = history.VersionedTable.create(spark, root, schema, ["year", "month"], committed_at=at(0))
    h["run1"] = t.replace_partitions(_landed(spark, layout, months, RUN_1), batch_id=RUN_1, committed_at=at(1))
    partial = [ym for ym in months if ym[0] == PARTIAL_RELOAD_YEAR]
    h["partial"] = t.replace_partitions(_landed(spark, layout, partial, RUN_3), batch_id=RUN_3, committed_at=at(2))
    h["undo"] = t.undo_batch(RUN_3, committed_at=at(3))
    h["compact"] = t.compact(rows_per_file=250_000, committed_at=at(4))
    plan = t.expire(older_than=at(3.5), retain_last=2, expired_at=at(5))
    h["expired_partitions"] = [tuple(r) for r in plan.collect()]
    # a crashed writer: data files of a new version, but no pins and no commit row
    crashed = t.next_version()
    (
        _landed(spark, layout, months[:1], "crashed")
        .withColumn("_version", F.lit(crashed))
        .write.mode("append").partitionBy("_version", "year", "month").parquet(t.data_path)
    )
    h["crashed"] = crashed
    return h


def _landed(spark: SparkSession, layout: Layout, months: list[tuple[int, int]], batch_id: str) -> DataFrame:
    return bronze_ops.enrich(bronze_ops.read_units(spark, layout, months, merge=False), batch_id)
