"""

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables or over layers Spark built from them (landing -> bronze ->
silver -> gold, written under the session's shared checkpoint folder and
built once per session and scale factor, see :mod:`strata.build`).

Oracle SQL runs in DuckDB over the same parquet tables.  Computed columns carry
the same names on both sides; money sums go through decimal(18,4) on both
sides, and integer results are cast to the Spark type.  Keys whose result
depends on file names, clocks or plans have no oracle (rows-only check).
"""

from __future__ import annotations

import datetime as dt
import importlib
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata import build  # noqa: E402
from strata.functions import event_date, hour_of, is_weekend, month_start, path_segment, string_tail, weekday_of  # noqa: E402
from strata.layout import Layout, source_units  # noqa: E402
from strata.operators import bronze as bronze_ops  # noqa: E402
from strata.operators import cdc, cluster, contract, dims, gold, grid, hotjoin, nullability, quality, reconcile, scd2, skew, upsert  # noqa: E402
from strata.operators import silver as silver_ops  # noqa: E402
from strata.operators.history import VersionedTable  # noqa: E402
from strata.plans import partition_rows, plan_facts_frame  # noqa: E402
from strata.plans.tuning import Experiment  # noqa: E402
from strata.session import unsorted_write  # noqa: E402
from strata.sources import glob_scan, table, trip_records  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"

# Key columns of a landed row that are stable across runs (no path, no clock).
BRONZE_COLS = [
    "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_shipdate", "o_orderdate", "o_orderstatus", "o_orderpriority",
    "c_acctbal", "_batch_id", "year", "month",
]
ROW_KEY = ["l_orderkey", "l_linenumber", "l_suppkey", "_batch_id", "year", "month"]


LINE_FACTS = ("trip_id", "line_no", "pu_location_id", "fare_amount", "trip_distance")


def _layers(spark: SparkSession, sf_dir: str) -> build.Built:
    return build.build_layers(spark, sf_dir)


def _conformed(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The raw trip feed in silver spelling (no table written)."""
    raw = trip_records(spark, sf_dir, partitions).withColumns(
        {"_batch_id": F.lit(None).cast("string"), "year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    )
    return silver_ops.with_event_month(silver_ops.conform(raw), "pickup_at")


def _line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip columns that come from ``lineitem`` alone, in silver spelling: one table, no join."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(*[F.expr(e).alias(n) for n, e in silver_ops.CONFORM if n in LINE_FACTS])


def _skewed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with a derived hot key: 8% of orders map to zone -1."""
    t = _conformed(spark, sf_dir)
    return t.withColumn("zone_key", F.when(F.col("trip_id") % 100 < 8, F.lit(-1).cast("bigint")).otherwise(F.col("pu_location_id")))


# ----------------------------------------------------------------------------- direct queries
def q_scan_count(spark, sf):
    return glob_scan(spark, f"{sf.rstrip('/')}/lineitem*.parquet").agg(F.count(F.lit(1)).alias("n"))


def q_filter_count(spark, sf):
    return _line_facts(spark, sf).filter("trip_distance > 5").groupBy().count()


def q_filter_select(spark, sf):
    return _line_facts(spark, sf).filter("trip_distance > 5").select("trip_id", "line_no", "fare_amount", "trip_distance")


def q_group_count(spark, sf):
    return _line_facts(spark, sf).groupBy("pu_location_id").count()


def q_sorted_groups(spark, sf):
    return _line_facts(spark, sf).groupBy("pu_location_id").count().orderBy(F.desc("count"), "pu_location_id")


def q_topk(spark, sf):
    return (
        _line_facts(spark, sf).groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("trips"))
        .orderBy(F.desc("trips"), "pu_location_id").limit(10)
    )


def q_union_by_name(spark, sf):
    o = table(spark, sf, "orders")
    early = o.where(F.year("o_orderdate") < 1998).select("o_orderkey", "o_orderdate")
    late = o.where(F.year("o_orderdate") >= 1998).select("o_orderpriority", "o_orderdate", "o_orderkey")
    return early.unionByName(late, allowMissingColumns=True)


def _with_nulls(spark, sf):
    return _conformed(spark, sf).withColumns(
        {"trip_distance": F.nullif("trip_distance", F.lit(0.0)), "tip_amount": F.nullif("tip_amount", F.lit(0.0))}
    )


def q_null_policy(spark, sf):
    return silver_ops.null_policy(_with_nulls(spark, sf)).select("trip_id", "line_no", "trip_distance", "tip_amount")


def q_null_profile(spark, sf):
    return contract.null_profile(_with_nulls(spark, sf), ["trip_id", "trip_distance", "tip_amount", "passenger_count"])


def q_string_conform(spark, sf):
    return _conformed(spark, sf).select("status_code", "priority_code", "priority_name", "return_flag").distinct()


def q_time_parts(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        event_date("ts").alias("day"),
        hour_of("ts").alias("hour"),
        weekday_of("ts").alias("weekday"),
        is_weekend("ts").alias("is_weekend"),
        month_start("ts").alias("month_start"),
        F.expr("timestampdiff(MINUTE, CAST(to_date(ts) AS TIMESTAMP_NTZ), ts)").alias("minute_of_day"),
    )


def q_gold_hourly_demand(spark, sf):
    return gold.hourly_demand(table(spark, sf, "events"), "ts", "value")


def q_key_skew(spark, sf):
    return skew.key_skew(_skewed_trips(spark, sf), "zone_key", hot_factor=5.0)


def q_hot_keys(spark, sf):
    return skew.hot_keys(_skewed_trips(spark, sf), "zone_key", hot_factor=5.0)


def q_task_skew(spark, sf):
    return skew.task_skew(_skewed_trips(spark, sf), "zone_key", partitions=16)


def q_salted_agg(spark, sf):
    return skew.salted_agg(_skewed_trips(spark, sf), "zone_key", "fare_amount", salts=8, salt_cols=["trip_id", "line_no"])


#: Cells of the hot zone of ``_skewed_trips``.
HOT_CELLS = [(-1, 1000 + k) for k in range(4)]


def q_hot_join(spark, sf):
    """Trips joined with the cells of their zone, through a hot zone: demand per cell."""
    cells = dims.zone_cells(_layers(spark, sf).zones()).withColumnRenamed("location_id", "zone_key")
    cells = cells.unionByName(spark.createDataFrame(HOT_CELLS, "zone_key bigint, cell_id bigint"))
    trips = _skewed_trips(spark, sf).select("zone_key", "trip_id", "line_no", "fare_amount")
    joined = hotjoin.hot_join(trips, cells, "zone_key", share=0.02)
    return joined.groupBy("cell_id").agg(F.count(F.lit(1)).alias("trips"), F.sum(F.col("fare_amount").cast("decimal(18,4)")).cast("double").alias("revenue"))


def q_frequent_keys(spark, sf):
    """Zones with more than 2% of the trips, exactly counted after one mergeable summary."""
    return hotjoin.frequent_keys(_skewed_trips(spark, sf).select("zone_key"), ["zone_key"], 0.02)[0]


# ----------------------------------------------------------------------------- dimension history, change feed
ZONE_KEY = ["location_id"]


def _zone_changes(spark, sf) -> list[DataFrame]:
    """Tariffs of zones as a change feed, in the order the batches arrive: corrections first, then what they correct."""
    years = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    years = years.groupBy(F.col("l_suppkey").alias("location_id"), F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    tariff = lambda n: F.concat(F.lit("T"), (n % 3).cast("string"))
    moment = lambda text: F.concat(F.col("y").cast("string"), F.lit(text)).cast("timestamp_ntz")
    feed = lambda df, attribute, effective, recorded: df.select("location_id", effective.alias("effective"), recorded.alias("recorded"), attribute.alias("tariff"))
    regular = feed(years, tariff(F.col("n")), moment("-01-01 00:00:00"), moment("-01-02 00:00:00"))
    corrected = feed(years.where("y = 1995 AND location_id % 5 = 0"), tariff(F.col("n") + 1), moment("-01-01 00:00:00"), moment("-06-01 00:00:00"))
    late = feed(years.where("y = 1996 AND location_id % 7 = 0"), F.lit("X"), moment("-07-01 06:30:00"), F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
    return [corrected.unionByName(late), regular]


def _zone_history(spark, sf) -> DataFrame:
    first, second = _zone_changes(spark, sf)
    return scd2.intervals(scd2.merge_changes(first, second, ZONE_KEY), ZONE_KEY)


def q_dim_zone_scd2(spark, sf):
    return _zone_history(spark, sf)


def q_trip_zone_asof(spark, sf):
    """Every trip with the tariff its pickup zone had at pickup time."""
    trips = _conformed(spark, sf).select("trip_id", "line_no", "pu_location_id", "pickup_at")
    return scd2.as_of_join(trips, _zone_history(spark, sf), [("pu_location_id", "location_id")], "pickup_at", prefix="pu_")


def _order_feed(spark, sf) -> list[DataFrame]:
    """Lines of an order as changes of it, in three batches that do not arrive in order."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("seq"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 2 == 0), cdc.DELETE).when(F.col("l_linenumber") == 1, "insert").otherwise("update").alias("op"),
        F.col("l_extendedprice").alias("price"), F.col("l_suppkey").alias("location_id"),
    )
    return [lines.where(F.col("location_id") % 3 == k) for k in (2, 0, 1)]


def q_cdc_current(spark, sf):
    return cdc.current(cdc.apply_all(_order_feed(spark, sf), ["order_key"], "seq"))


#: Zones of a key range of the stored dimension.
ZONE_RANGE = 4


def q_dim_upsert(spark, sf):
    """The zone dimension after an upsert: some zones renamed, some gone, some new; with the version each range was written by."""
    b = _layers(spark, sf)
    zones = b.zones().select("location_id", "zone_name", "borough")
    t = upsert.create_keyed(spark, f"{b.layout.root}/dims/zones-{uuid.uuid4().hex[:8]}", zones, "location_id", ZONE_RANGE, batch_id=build.RUN_1, committed_at=build.at(1))
    changed = zones.where("floor(location_id / 4) % 2 = 1 AND location_id % 4 < 2").select(
        "location_id", F.concat("zone_name", F.lit(" New")).alias("zone_name"), "borough",
        F.when(F.col("location_id") % 4 == 0, cdc.DELETE).otherwise("update").alias("op"),
    )
    added = zones.select((-F.col("location_id")).alias("location_id"), "zone_name", F.lit("Nowhere").alias("borough"), F.lit("insert").alias("op")).where("location_id % 5 = 0 AND location_id <> 0")
    upsert.upsert(t, changed.unionByName(added), "location_id", ZONE_RANGE, "op", batch_id=build.RUN_2, committed_at=build.at(2))
    return t.read().select("location_id", "zone_name", "borough", F.col(upsert.WRITTEN).alias("written_by"))


def q_clustered_two_columns(spark, sf):
    """Lines clustered by supplier and ship date: single-column filters return their rows and meet at most half of the files."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    path = f"{_layers(spark, sf).layout.root}/clustered-{uuid.uuid4().hex[:8]}"
    cluster.cluster_by(lines, ["l_suppkey", "l_shipdate"], 64).write.parquet(path)
    stored = spark.read.parquet(path)
    filters = [("l_suppkey", 3, 3), ("l_shipdate", dt.datetime(1996, 3, 1), dt.datetime(1996, 3, 31))]
    parts = []
    for column, low, high in filters:
        met, files = cluster.files_met(stored, column, low, high)
        rows = stored.where(F.col(column).between(F.lit(low), F.lit(high))).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("l_orderkey").alias("orders"))
        parts.append(rows.select(F.lit(column).alias("filter"), "rows", "orders", F.lit(2 * met <= files).alias("skips")))
    return parts[0].unionByName(parts[1])


def q_drift_profile(spark, sf):
    """Per source month: mean, exact count, nulls and distinct zones of the fare (D-tier drift profile)."""
    t = _conformed(spark, sf)
    return t.groupBy("src_year", "src_month").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("fare_amount").cast("decimal(18,4)")).cast("double").alias("fare_sum"),
        F.min("fare_amount").alias("fare_min"),
        F.max("fare_amount").alias("fare_max"),
        F.count_if(F.col("fare_amount").isNull()).alias("fare_nulls"),
        F.countDistinct("pu_location_id").alias("zones"),
    )


def q_drift_vs_baseline(spark, sf):
    """Per source month vs all months: mean, median, null rate and distinct zones of the fare."""
    from strata.operators.drift import drift_profile
    return drift_profile(_conformed(spark, sf), ["src_year", "src_month"], "fare_amount", "pu_location_id")


def q_drift_quantiles(spark, sf):
    """Per source month and over all: exact percentiles of the fare."""
    from strata.operators.drift import drift_quantiles
    return drift_quantiles(_conformed(spark, sf), ["src_year", "src_month"], "fare_amount")


def q_drift_distance(spark, sf):
    """Per source month: Kolmogorov-Smirnov distance of its fares from the fares up to 1996."""
    from strata.operators.drift import drift_distance
    return drift_distance(_conformed(spark, sf), ["src_year", "src_month"], "fare_amount", F.col("src_year") <= 1996)


def q_category_shift(spark, sf):
    from strata.operators.drift import category_shift
    return category_shift(_conformed(spark, sf), ["src_year", "src_month"], "status_code")


def q_plan_facts(spark, sf):
    c = _conformed(spark, sf)
    return plan_facts_frame(spark, {
        "filter_count": c.filter("trip_distance > 5").groupBy().count(),
        "group_count": c.groupBy("pu_location_id").count(),
        "topk": c.groupBy("pu_location_id").count().orderBy(F.desc("count")).limit(10),
        "full_sort": c.groupBy("pu_location_id").count().orderBy(F.desc("count")),
    })


def q_partition_rows(spark, sf):
    return partition_rows(table(spark, sf, "lineitem"))


def q_bench_table(spark, sf):
    """Trips per zone by shuffle partitions: plan and seconds, the median of three runs of each number."""
    # the experiment varies the aggregate's partitions; the join below it keeps the session's number
    c = _conformed(spark, sf, int(spark.conf.get("spark.sql.shuffle.partitions")))
    exp = Experiment(
        "shuffle_partitions", "spark.sql.shuffle.partitions", [2, 8, 64, 200],
        lambda s, v: c.groupBy("pu_location_id").count(),
    )
    return exp.run(spark).select("experiment", "variable", "value", "exchanges", "joins", "median_sec", "min_sec", "max_sec")


# ----------------------------------------------------------------------------- landing / bronze
def q_source_months(spark, sf):
    return source_units(spark, _layers(spark, sf).landing_layout()).select("year", "month", "unit", "files")


def q_filename_parts(spark, sf):
    b = _layers(spark, sf)
    b.landing()
    return reconcile.source_counts(spark.read.parquet(*[b.layout.unit_path(y, m) for y, m in b.landing_months()]))


def q_string_tail(spark, sf):
    br = _layers(spark, sf).bronze()
    tail = string_tail(F.substring_index("_source_file", "/", -2)).alias("file")
    unit = F.substring_index(F.substring_index("_source_file", "/", -2), "/", 1).alias("source_unit")
    return br.select(unit, tail).groupBy("source_unit").agg(F.count(F.lit(1)).alias("rows"))


def q_contract_report(spark, sf):
    b = _layers(spark, sf)
    b.landing()
    probe = spark.read.parquet(b.layout.unit_path(*b.landing_months()[0]))
    cases = {
        "unchanged": probe,
        "added": probe.withColumn("surcharge", F.lit(1.0)),
        "missing": probe.drop("l_quantity"),
        "retyped": probe.withColumn("l_discount", F.col("l_discount").cast("string")),
        "renamed": probe.withColumnRenamed("l_tax", "tax_rate"),
    }
    found = [f for name, df in cases.items() for f in contract.findings(df.schema, contract.TRIP_CONTRACT, name)]
    return contract.findings_frame(spark, found)


def q_nullability_change(spark, sf):
    """NULLs that came and went: one unit in the middle is landed with a column partly and one wholly NULL."""
    b = _layers(spark, sf)
    b.landing()
    changed = Layout(f"{b.layout.root}/nulls-{uuid.uuid4().hex[:8]}")  # fresh per call
    months = b.months()
    period = "{:04d}-{:02d}".format(*months[len(months) // 2])
    src = spark.read.parquet(*[b.layout.unit_path(y, m) for y, m in months]).withColumn("period", F.date_format("o_orderdate", "yyyy-MM"))
    there = F.col("period") == period
    nulled = src.withColumns({
        "l_tax": F.when(~(there & (F.col("l_linenumber") == 1)), F.col("l_tax")),
        "c_acctbal": F.when(~there, F.col("c_acctbal")),
    })
    with unsorted_write(spark):
        nulled.repartition("period").write.partitionBy("period").parquet(changed.landing)
    return nullability.changes_frame(spark, nullability.null_changes(spark, changed))


def q_bronze_readback(spark, sf):
    return _layers(spark, sf).bronze().select(*BRONZE_COLS)


def q_bronze_run(spark, sf):
    t = _layers(spark, sf).bronze_table()
    return t.snapshots().where(F.col("operation") != "create").select(
        "version", "operation", "batch_id", "added_records", "deleted_records"
    )


def q_enrich(spark, sf):
    br = _layers(spark, sf).bronze()
    return br.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        path_segment("_source_file", -2).alias("source_unit"), "_batch_id", "year", "month",
    )


def q_batch_profile(spark, sf):
    return reconcile.batch_profile(_layers(spark, sf).bronze())


def q_distinct_months(spark, sf):
    return _layers(spark, sf).bronze().select("year", "month").distinct()


def q_group_by_expr(spark, sf):
    br = _layers(spark, sf).bronze()
    return br.groupBy(path_segment("_source_file", -2).alias("source_unit")).agg(F.count(F.lit(1)).alias("rows"))


def q_trace(spark, sf):
    return reconcile.trace(_layers(spark, sf).bronze())


def q_reconcile(spark, sf):
    b = _layers(spark, sf)
    landing = spark.read.parquet(*[b.layout.unit_path(y, m) for y, m in b.months()])
    return reconcile.reconcile(landing, b.bronze())


def q_partition_prune(spark, sf):
    br = _layers(spark, sf).bronze()
    return br.where((F.col("year") == 1996) & F.col("month").isin(1, 2, 3)).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _plain_twice(spark, sf, mode):
    b = _layers(spark, sf)
    b.landing()
    path = f"{b.layout.root}/plain/{mode}-{uuid.uuid4().hex[:8]}"  # fresh per call: reruns stay comparable
    for batch in (build.RUN_1, build.RUN_2):
        bronze_ops.write_plain(bronze_ops.enriched_landing(spark, b.landing_layout(), batch), path, mode)
    return bronze_ops.read_plain(spark, path)


def q_overwrite_twice(spark, sf):
    df = _plain_twice(spark, sf, "overwrite")
    return df.groupBy("year", "month", "_batch_id").agg(F.count(F.lit(1)).alias("rows"))


def q_append_twice(spark, sf):
    df = _plain_twice(spark, sf, "append")
    return df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


def q_file_count(spark, sf):
    b = _layers(spark, sf)
    b.landing()
    path = f"{b.layout.root}/plain/two_files-{uuid.uuid4().hex[:8]}"
    bronze_ops.write_plain(bronze_ops.enriched_landing(spark, b.landing_layout(), build.RUN_1), path, "overwrite",
                           files_per_partition=2)
    from strata.layout import list_files
    files = list_files(spark, path)
    return files.groupBy(F.regexp_extract("path", r"(year=\d+/month=\d+)", 1).alias("partition")).agg(
        F.count(F.lit(1)).alias("files")
    )


def q_schema_evolve(spark, sf):
    """Units from 1998 on carry an extra column; bronze reads it by name, NULL before."""
    b = _layers(spark, sf)
    b.landing()
    from strata.layout import Layout
    evo = Layout(f"{b.layout.root}/evolve-{uuid.uuid4().hex[:8]}")  # fresh per call
    src = spark.read.parquet(*[b.layout.unit_path(y, m) for y, m in b.months()])
    src = src.withColumn("period", F.date_format("o_orderdate", "yyyy-MM"))
    old = src.where(F.year("o_orderdate") < 1998)
    new = src.where(F.year("o_orderdate") >= 1998).withColumn("surcharge", F.col("l_tax") * 10)
    for part in (old, new):
        with unsorted_write(spark):
            part.write.mode("append").partitionBy("period").parquet(evo.landing)
    bronze_ops.run_bronze(spark, evo, build.RUN_1, committed_at=build.at(1))
    t = VersionedTable(spark, evo.bronze)
    return t.read().groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.count("surcharge").alias("with_surcharge")
    )


def q_storage_size(spark, sf):
    t = _layers(spark, sf).bronze_table()
    t.files().createOrReplaceTempView("strata_bronze_files")
    return spark.sql(
        "SELECT count(*) AS files, sum(record_count) AS records, "
        "sum(file_size_in_bytes) / 1024 / 1024 AS size_mb FROM strata_bronze_files"
    )


# ----------------------------------------------------------------------------- history
def _hist(spark, sf):
    b = _layers(spark, sf)
    return b.history_table(), b.hist()


def q_table_current(spark, sf):
    t, _ = _hist(spark, sf)
    return t.read().select(*ROW_KEY)


def q_as_of_version(spark, sf):
    t, h = _hist(spark, sf)
    return t.read(version=h["run1"]).select(*ROW_KEY)


def q_as_of_time(spark, sf):
    t, _ = _hist(spark, sf)
    return t.read(as_of=build.at(2.5)).select(*ROW_KEY)


def q_replace_partitions(spark, sf):
    t, h = _hist(spark, sf)
    return t.read(version=h["partial"]).select(*ROW_KEY)


def q_rollback(spark, sf):
    t, h = _hist(spark, sf)
    return t.read(version=h["after_rollback"]).select(*ROW_KEY)


def q_set_current(spark, sf):
    t, h = _hist(spark, sf)
    return t.read(version=h["after_set_current"]).select(*ROW_KEY)


def q_undo_batch(spark, sf):
    t, h = _hist(spark, sf)
    return t.read(version=h["undo"]).select(*ROW_KEY)


def q_version_diff(spark, sf):
    t, h = _hist(spark, sf)
    return t.diff(h["run2"], h["partial"], columns=ROW_KEY)


def q_commit_delta(spark, sf):
    t, h = _hist(spark, sf)
    return t.commit_delta(h["partial"])


def q_manifests(spark, sf):
    t, h = _hist(spark, sf)
    return t.manifests(h["partial"])


def q_snapshots(spark, sf):
    t, _ = _hist(spark, sf)
    return t.snapshots()


def q_history(spark, sf):
    t, _ = _hist(spark, sf)
    return t.history()


def q_describe(spark, sf):
    t, _ = _hist(spark, sf)
    return t.describe()


def q_files(spark, sf):
    t, _ = _hist(spark, sf)
    return t.files()


def q_map_struct(spark, sf):
    t, _ = _hist(spark, sf)
    s = t.snapshots().select(
        "version",
        F.create_map(F.lit("added-records"), F.col("added_records").cast("string"),
                     F.lit("deleted-records"), F.col("deleted_records").cast("string")).alias("summary"),
        F.struct("operation", "batch_id").alias("info"),
    )
    return s.select(
        "version",
        F.col("summary")["added-records"].alias("added"),
        F.col("info").getField("operation").alias("operation"),
    )


def q_compact(spark, sf):
    b = _layers(spark, sf)
    t = b.maintenance_table()
    return t.read(version=b.maint()["compact"]).select(*ROW_KEY)


def q_expire_plan(spark, sf):
    m = _layers(spark, sf).maint()
    return spark.createDataFrame(m["expired_partitions"], "data_version int, year int, month int, records bigint")


def q_orphans(spark, sf):
    return _layers(spark, sf).maintenance_table().orphans().select("data_version", "files")


# ----------------------------------------------------------------------------- silver
def _classified(spark, sf):
    b = _layers(spark, sf)
    c = silver_ops.with_event_month(silver_ops.conform(b.bronze()), "pickup_at")
    return quality.classify(c, quality.default_rules())


def _rule_rows(spark, sf, rule: quality.Rule):
    c = silver_ops.conform(_layers(spark, sf).bronze())
    return c.where(rule.predicate).select("trip_id", "line_no", "src_year", "src_month")


def q_silver_conform(spark, sf):
    c = silver_ops.conform(_layers(spark, sf).bronze())
    return silver_ops.with_event_month(c, "pickup_at")


def q_rule_negative(spark, sf):
    return _rule_rows(spark, sf, quality.negative_amount())


def q_rule_zero_distance(spark, sf):
    return _rule_rows(spark, sf, quality.zero_distance_with_fare())


def q_rule_time_order(spark, sf):
    return _rule_rows(spark, sf, quality.dropoff_before_pickup())


def q_rule_out_of_period(spark, sf):
    return _rule_rows(spark, sf, quality.outside_period("dropoff_at", "src_year", "src_month", 0))


def q_silver_trips(spark, sf):
    return _layers(spark, sf).silver()


def q_silver_rejects(spark, sf):
    r = _layers(spark, sf).rejects()
    return r.select("trip_id", "line_no", "src_year", "src_month", F.array_join(quality.REASONS, ",").alias("reasons"))


def q_observe_counts(spark, sf):
    df, obs = quality.observed(_classified(spark, sf))
    df.write.format("noop").mode("overwrite").save()
    m = obs.get
    return spark.createDataFrame([(m["rows"], m["rejected"])], "rows bigint, rejected bigint")


def q_silver_late(spark, sf):
    return _layers(spark, sf).late_silver().select(
        "trip_id", "line_no", "dropoff_at", "event_month", "src_year", "src_month", "_batch_id"
    )


def q_late_file_count(spark, sf):
    """Files per event month of late-data silver rebuilt with a small file size, against what its rows need."""
    t = _layers(spark, sf).sized_table()
    pins = [r for r in t.pin_rows(t.current_version()) if r[silver_ops.REJECT_MONTH] is None]
    per_month = t.scan_pins(pins, metadata=True).groupBy("event_month").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("_metadata_file").alias("files")
    )
    allowed = F.ceil(F.col("rows") / build.SMALL_FILE_ROWS).cast("bigint")
    return per_month.select("event_month", "rows", allowed.alias("allowed"), (F.col("files") <= allowed).alias("within"))


def q_backfill_scope(spark, sf):
    """For every source month: the source months a reload of it reads, by the stored lineage of late-data silver."""
    b = _layers(spark, sf)
    b.late_silver()
    return silver_ops.backfill_scopes(silver_ops.lineage(b.late_table()), b.months(), build.LATE_TOLERANCE_MONTHS)


def q_silver_lineage(spark, sf):
    """Rows of each event month by the source month they came from, as the runs stored it."""
    b = _layers(spark, sf)
    b.late_silver()
    return silver_ops.lineage(b.late_table()).select("event_month", "src_year", "src_month", "rows")


def q_affected_periods(spark, sf):
    """Source months (bronze partitions) holding rows of the event months that
    reprocessing the middle source month touches, placed by dropoff time."""
    b = _layers(spark, sf)
    months = b.months()
    events, _ = silver_ops.affected_periods([months[len(months) // 2]], build.LATE_TOLERANCE_MONTHS)
    starts = [f"{y:04d}-{m:02d}-01" for y, m in events]
    ev = F.trunc(F.to_date("l_shipdate"), "month")
    return (
        b.bronze().where(ev.isin(*[F.to_date(F.lit(s)) for s in starts]))
        .select("year", "month").distinct()
    )


def _enriched(spark, sf, strategy):
    b = _layers(spark, sf)
    c = silver_ops.conform(b.bronze())
    return dims.enrich_zones(c, b.dim_zone(), strategy=strategy).select(
        "trip_id", "line_no", "pu_location_id", "pu_zone", "pu_borough"
    )


def q_zone_enrich(spark, sf):
    return _enriched(spark, sf, "auto")


def q_join_broadcast(spark, sf):
    return _enriched(spark, sf, "broadcast")


def q_join_sortmerge(spark, sf):
    return _enriched(spark, sf, "merge")


def q_dim_zone(spark, sf):
    d = _layers(spark, sf).dim_zone()
    return d.select(
        "location_id", "zone_name", "borough",
        F.array_join(F.transform("cells", lambda x: x.cast("string")), ",").alias("cells"),
        "n_cells",
    )


def q_grid_apportion(spark, sf):
    b = _layers(spark, sf)
    z = grid.apportion(grid.zone_demand(b.silver(), []), dims.zone_cells(b.zones()))
    return z.select("pu_location_id", "cell_id", "trips", "weight")


def q_gold_grid_demand(spark, sf):
    return gold.read_gold(spark, _layers(spark, sf).gold_paths()["grid_demand"]).drop("_silver_version")


def _event_grid(spark, sf):
    e = table(spark, sf, "events")
    cell = F.pmod("user_id", F.lit(dims.CELL_GROUPS)) * 10 + F.pmod("user_id", F.lit(dims.CELL_SPREAD))
    return e.groupBy(cell.alias("cell_id"), weekday_of("ts").alias("weekday")).agg(F.count(F.lit(1)).alias("events"))


def q_grid_join(spark, sf):
    b = _layers(spark, sf)
    s = b.silver().withColumn("weekday", weekday_of("pickup_at"))
    cells = grid.grid_demand(s, dims.zone_cells(b.zones()), ["weekday"])
    return grid.grid_join(cells, _event_grid(spark, sf), ["weekday"])


# ----------------------------------------------------------------------------- no row lost or doubled
def _own_table(spark, rows, partition):
    """A fresh versioned table for rows of this shape."""
    layout = Layout.fresh(spark, "own")
    return VersionedTable.create(spark, f"{layout.root}/t", rows.schema, [partition])


def q_null_partition(spark, sf):
    """Orders partitioned by a status that is NULL for some; then the NULL partition is replaced."""
    o = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    t = _own_table(spark, o, "status")
    t.write(o)
    t.write(o.where("status IS NULL AND o_orderkey % 2 = 0"))
    return t.read()


def q_undo_batch_twice(spark, sf):
    """A batch writes, a good one replaces it, the batch writes again and is undone."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    t = _own_table(spark, o, "o_orderstatus")
    t.write(o, batch_id="bad")
    t.write(o.where("o_orderkey % 3 = 0"), batch_id="good")
    t.write(o.where("o_orderkey % 5 = 0"), batch_id="bad")
    t.undo_batch("bad")
    return t.read()


def q_evolve_reland(spark, sf):
    """One status lands, another with a new column, then the first again in its old shape."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    old = o.where("o_orderstatus = 'F'").drop("o_orderpriority")
    t = _own_table(spark, old, "o_orderstatus")
    t.write(old)
    t.write(o.where("o_orderstatus = 'O'"))
    t.write(old)
    return t.read()


def q_silver_null_event(spark, sf):
    """Trips without a pickup time under a rule that does not look at it: kept or rejected, none lost."""
    t = _conformed(spark, sf).withColumn("pickup_at", F.when(F.col("trip_id") % 7 != 0, F.col("pickup_at")))
    classified = quality.classify(silver_ops.with_event_month(t, "pickup_at"), [quality.negative_amount()])
    flagged = silver_ops.flag_unplaceable(classified, 0)
    return flagged.groupBy(F.coalesce(F.get(quality.REASONS, 0), F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


# ----------------------------------------------------------------------------- gold
def q_gold_zone_daily(spark, sf):
    return gold.zone_daily(_layers(spark, sf).silver())


def _gold(spark, sf, name):
    """A table of the stored gold layer, without the version stamp."""
    return gold.read_gold(spark, _layers(spark, sf).gold_paths()[name]).drop("_silver_version")


def q_gold_borough_summary(spark, sf):
    return _gold(spark, sf, "borough_summary")


def q_gold_reject_rate(spark, sf):
    return _gold(spark, sf, "reject_rate")


def q_reject_by_reason(spark, sf):
    return _gold(spark, sf, "reject_reasons")


def q_reject_rate_delta(spark, sf):
    return _gold(spark, sf, "reject_delta")


def q_zone_rank(spark, sf):
    return _gold(spark, sf, "zone_rank")


def q_running_total(spark, sf):
    return _gold(spark, sf, "running_total")


def q_gold_trip_demand(spark, sf):
    return _gold(spark, sf, "hourly_demand")


def q_gold_grain(spark, sf):
    return gold.grain_violations(_gold(spark, sf, "zone_daily"), ["pu_location_id", "pickup_date", "pickup_hour"])


def q_gold_reconcile(spark, sf):
    return gold.totals_reconcile(_layers(spark, sf).silver(), _gold(spark, sf, "zone_daily"))


def q_gold_lineage(spark, sf):
    b = _layers(spark, sf)
    return gold.read_gold(spark, b.gold_paths()["zone_daily"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in dict(globals()).items() if name.startswith("q_") and callable(fn)
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: revenue per pickup zone and day, landing -> bronze -> silver -> gold on sf0.001."""
    return q_gold_lineage(spark, SF_SMOKE)


#: What may be missing: the package of the training-data operators, and the pipeline, which needs it.
_TAKEN_OUT = {"strata.llm", "strata.llm.queries", "corpus_pipeline"}


def _corpus() -> list:
    """The modules with the training-data queries; none where that part was taken out.

    Any other import that fails there is an error, not a part taken out.
    """
    found = []
    for name in ("strata.llm.queries", "corpus_pipeline"):
        try:
            found.append(importlib.import_module(name))
        except ModuleNotFoundError as e:
            if e.name not in _TAKEN_OUT:
                raise
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | {k: f for m in _corpus() for k, f in m.queries().items()}


# ============================================================================= oracle SQL
_TRIPS = """
trips AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount,
         l.l_tax, l.l_returnflag, l.l_shipdate, o.o_orderdate, o.o_orderstatus, o.o_orderpriority,
         c.c_acctbal,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""


def _initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


_CONFORMED = _TRIPS + f""",
conformed AS (
  SELECT l_orderkey AS trip_id, l_linenumber AS line_no, o_orderdate AS pickup_at, l_shipdate AS dropoff_at,
         l_suppkey AS pu_location_id, TRY_CAST(l_quantity AS INTEGER) AS passenger_count,
         round(l_discount * 100 + 0.0, 2) AS trip_distance, l_extendedprice AS fare_amount,
         l_extendedprice * l_tax AS tip_amount, c_acctbal AS balance_amount,
         nullif(upper(trim(l_returnflag)), '') AS return_flag,
         nullif(upper(trim(o_orderstatus)), '') AS status_code,
         TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_code,
         {_initcap("substr(o_orderpriority, instr(o_orderpriority, '-') + 1)")} AS priority_name,
         BATCH AS _batch_id, year AS src_year, month AS src_month,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS event_month
  FROM trips
)"""

_RULES = """
  (fare_amount < 0 OR tip_amount < 0 OR balance_amount < 0) AS r_neg,
  (trip_distance = 0 AND fare_amount > 0) AS r_zero,
  (dropoff_at < pickup_at) AS r_order,
  (CAST(pickup_at AS DATE) < make_date(src_year, src_month, 1)
   OR CAST(pickup_at AS DATE) >= make_date(src_year, src_month, 1) + INTERVAL 1 MONTH) AS r_period"""

_ZONES = f""",
zones AS (
  SELECT s.s_suppkey AS location_id, {_initcap("s.s_name")} AS zone_name, {_initcap("r.r_name")} AS borough
  FROM supplier s LEFT JOIN (nation n JOIN region r ON n.n_regionkey = r.r_regionkey) ON s.s_nationkey = n.n_nationkey
),
bridge AS (
  SELECT location_id, (location_id % 7) * 10 + unnest(generate_series(0, location_id % 3)) AS cell_id FROM zones
)"""

_CLASSIFIED = (_CONFORMED.replace("BATCH", "'run-1'") + _ZONES + f""",
flagged AS (SELECT *, {_RULES} FROM conformed),
classified AS (
  SELECT *, list_filter([CASE WHEN r_neg THEN 'negative_amount' END,
                         CASE WHEN r_zero THEN 'zero_distance_with_fare' END,
                         CASE WHEN r_order THEN 'dropoff_before_pickup' END,
                         CASE WHEN r_period THEN 'outside_period' END], lambda x: x IS NOT NULL) AS reasons
  FROM flagged
),
silver AS (
  SELECT c.trip_id, c.line_no, c.pickup_at, c.dropoff_at, c.pu_location_id, c.passenger_count, c.trip_distance,
         c.fare_amount, c.tip_amount, c.balance_amount, c.return_flag, c.status_code, c.priority_code,
         c.priority_name, c._batch_id, c.src_year, c.src_month, z.zone_name AS pu_zone, z.borough AS pu_borough,
         c.event_month
  FROM classified c LEFT JOIN zones z ON c.pu_location_id = z.location_id
  WHERE len(c.reasons) = 0
),
rejects AS (SELECT * FROM classified WHERE len(reasons) > 0)""")


def _with(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body}"


def _dec(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


_ROWKEY_SQL = "l_orderkey, l_linenumber, l_suppkey, {b} AS _batch_id, year, month"
_CONF_NOBATCH = _CONFORMED.replace("BATCH", "CAST(NULL AS VARCHAR)")
_SKEW = _CONF_NOBATCH + """,
skewed AS (SELECT *, CASE WHEN trip_id % 100 < 8 THEN CAST(-1 AS BIGINT) ELSE pu_location_id END AS zone_key FROM conformed),
kc AS (SELECT zone_key, count(*) AS rows FROM skewed GROUP BY zone_key)"""

_ZONE_DAILY = """SELECT pu_location_id, pu_zone, pu_borough, CAST(pickup_at AS DATE) AS pickup_date,
       CAST(hour(pickup_at) AS INTEGER) AS pickup_hour, count(*) AS trips,
       """ + _dec("fare_amount") + " AS revenue, " + _dec("tip_amount") + """ AS tips
FROM silver GROUP BY ALL"""

_REJECT_RATE = """rate AS (
  SELECT src_year, src_month, count(*) AS input_rows, count(*) FILTER (WHERE len(reasons) > 0) AS rejected,
         CAST(count(*) FILTER (WHERE len(reasons) > 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS reject_rate
  FROM classified GROUP BY src_year, src_month
)"""

_GRID = """zd AS (SELECT pu_location_id, count(*) AS trips FROM silver GROUP BY pu_location_id),
nc AS (SELECT location_id, count(*) AS n_cells FROM bridge GROUP BY location_id),
ap AS (
  SELECT zd.pu_location_id, b.cell_id, zd.trips, CASE WHEN nc.n_cells IS NULL THEN 1.0 ELSE 1.0::DOUBLE / nc.n_cells END AS weight
  FROM zd LEFT JOIN bridge b ON zd.pu_location_id = b.location_id LEFT JOIN nc ON zd.pu_location_id = nc.location_id
)"""


_LATE = _CONF_NOBATCH + """,
late AS (SELECT *EXCLUDE (event_month), CAST(date_trunc('month', dropoff_at) AS DATE) AS event_month FROM conformed
         WHERE CAST(dropoff_at AS DATE) >= make_date(src_year, src_month, 1) - INTERVAL 3 MONTH
           AND CAST(dropoff_at AS DATE) < make_date(src_year, src_month, 1) + INTERVAL 1 MONTH)"""

_ZONE_HISTORY = """
years AS (SELECT l_suppkey AS location_id, year(o_orderdate) AS y, count(*) AS n
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
changes AS (
  SELECT location_id, make_timestamp(y, 1, 1, 0, 0, 0) AS effective, make_timestamp(y, 1, 2, 0, 0, 0) AS recorded, 'T' || (n % 3) AS tariff FROM years
  UNION ALL SELECT location_id, make_timestamp(y, 1, 1, 0, 0, 0), make_timestamp(y, 6, 1, 0, 0, 0), 'T' || ((n + 1) % 3) FROM years WHERE y = 1995 AND location_id % 5 = 0
  UNION ALL SELECT location_id, make_timestamp(y, 7, 1, 6, 30, 0), TIMESTAMP '1999-01-01 00:00:00', 'X' FROM years WHERE y = 1996 AND location_id % 7 = 0),
latest AS (SELECT *, row_number() OVER (PARTITION BY location_id, effective ORDER BY recorded DESC, tariff DESC) AS k FROM changes),
news AS (SELECT location_id, effective, tariff, lag(tariff) OVER (PARTITION BY location_id ORDER BY effective) AS before FROM latest WHERE k = 1),
history AS (
  SELECT location_id, tariff, effective AS valid_from, lead(effective) OVER w AS valid_to, lead(effective) OVER w IS NULL AS is_current
  FROM news WHERE tariff IS DISTINCT FROM before WINDOW w AS (PARTITION BY location_id ORDER BY effective))"""


def _hist_rows(batch_of_year: str) -> str:
    return _with(_TRIPS, f"SELECT {_ROWKEY_SQL.format(b=batch_of_year)} FROM trips")


ORACLE: dict[str, str] = {
    "scan_count": "SELECT count(*) AS n FROM lineitem",
    "filter_count": _with(_CONF_NOBATCH, 'SELECT count(*) AS "count" FROM conformed WHERE trip_distance > 5'),
    "filter_select": _with(_CONF_NOBATCH, "SELECT trip_id, line_no, fare_amount, trip_distance FROM conformed WHERE trip_distance > 5"),
    "group_count": _with(_CONF_NOBATCH, 'SELECT pu_location_id, count(*) AS "count" FROM conformed GROUP BY 1'),
    "sorted_groups": _with(_CONF_NOBATCH, 'SELECT pu_location_id, count(*) AS "count" FROM conformed GROUP BY 1 ORDER BY 2 DESC, 1'),
    "topk": _with(_CONF_NOBATCH, "SELECT pu_location_id, count(*) AS trips FROM conformed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "union_by_name": """SELECT o_orderkey, o_orderdate, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "null_policy": _with(_CONF_NOBATCH, """SELECT trip_id, line_no, nullif(trip_distance, 0.0) AS trip_distance,
       coalesce(nullif(tip_amount, 0.0), 0.0) AS tip_amount FROM conformed"""),
    "null_profile": _with(_CONF_NOBATCH, """, n AS (SELECT nullif(trip_distance, 0.0) AS td, nullif(tip_amount, 0.0) AS ta, * FROM conformed)
SELECT 'trip_id' AS "column", count(*) FILTER (WHERE trip_id IS NULL) AS nulls, count(*) AS rows FROM n
UNION ALL SELECT 'trip_distance', count(*) FILTER (WHERE td IS NULL), count(*) FROM n
UNION ALL SELECT 'tip_amount', count(*) FILTER (WHERE ta IS NULL), count(*) FROM n
UNION ALL SELECT 'passenger_count', count(*) FILTER (WHERE passenger_count IS NULL), count(*) FROM n"""),
    "string_conform": _with(_CONF_NOBATCH, "SELECT DISTINCT status_code, priority_code, priority_name, return_flag FROM conformed"),
    "time_parts": """SELECT event_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(isodow(ts) - 1 AS INTEGER) AS weekday, isodow(ts) >= 6 AS is_weekend,
       CAST(date_trunc('month', ts) AS DATE) AS month_start,
       date_diff('minute', date_trunc('day', ts), ts) AS minute_of_day
FROM events""",
    "gold_hourly_demand": f"""SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour,
       isodow(ts) >= 6 AS is_weekend, count(*) AS events, {_dec("value")} AS total_value
FROM events GROUP BY ALL""",
    "key_skew": _with(_SKEW, """, st AS (SELECT count(*) AS keys, sum(rows) AS total_rows, max(rows) AS max_rows,
                   quantile_disc(rows, 0.5) AS median_rows FROM kc)
SELECT keys, CAST(total_rows AS BIGINT) AS total_rows, max_rows, median_rows,
       CAST(max_rows AS DOUBLE) / CAST(median_rows AS DOUBLE) AS skew_ratio,
       (SELECT count(*) FROM kc WHERE rows > (SELECT median_rows FROM st) * 5.0) AS hot_keys
FROM st"""),
    "hot_keys": _with(_SKEW, """SELECT zone_key, rows FROM kc
WHERE rows > (SELECT quantile_disc(rows, 0.5) FROM kc) * 5.0"""),
    "salted_agg": _with(_SKEW, f"""SELECT zone_key, count(*) AS rows, {_dec("fare_amount")} AS total,
       min(fare_amount) AS min_value, max(fare_amount) AS max_value FROM skewed GROUP BY zone_key"""),
    "hot_join": _with(_SKEW + _ZONES, f""", cells AS (
  SELECT location_id AS zone_key, cell_id FROM bridge UNION ALL SELECT * FROM (VALUES {", ".join(map(str, HOT_CELLS))}) AS h(zone_key, cell_id))
SELECT CAST(cell_id AS BIGINT) AS cell_id, count(*) AS trips, {_dec("fare_amount")} AS revenue FROM skewed JOIN cells USING (zone_key) GROUP BY cell_id"""),
    "frequent_keys": _with(_SKEW, "SELECT zone_key, rows FROM kc WHERE rows > 0.02 * (SELECT sum(rows) FROM kc)"),
    "dim_zone_scd2": _with(_ZONE_HISTORY, "SELECT * FROM history"),
    "trip_zone_asof": _with(_ZONE_HISTORY + "," + _CONF_NOBATCH, """SELECT c.trip_id, c.line_no, c.pu_location_id, c.pickup_at, h.tariff AS pu_tariff
FROM conformed c LEFT JOIN history h ON h.location_id = c.pu_location_id AND h.valid_from <= c.pickup_at
     AND (h.valid_to IS NULL OR c.pickup_at < h.valid_to)"""),
    "dim_upsert": _with(_TRIPS + _ZONES, """, met AS (
  SELECT DISTINCT CAST(floor(location_id / 4.0) AS BIGINT) AS r FROM zones WHERE floor(location_id / 4.0) % 2 = 1 AND location_id % 4 < 2
  UNION SELECT CAST(floor(-location_id / 4.0) AS BIGINT) FROM zones WHERE location_id % 5 = 0 AND location_id <> 0),
after AS (
  SELECT location_id, CASE WHEN floor(location_id / 4.0) % 2 = 1 AND location_id % 4 = 1 THEN zone_name || ' New' ELSE zone_name END AS zone_name, borough
  FROM zones WHERE NOT (floor(location_id / 4.0) % 2 = 1 AND location_id % 4 = 0)
  UNION ALL SELECT -location_id, zone_name, 'Nowhere' FROM zones WHERE location_id % 5 = 0 AND location_id <> 0)
SELECT a.*, CASE WHEN CAST(floor(location_id / 4.0) AS BIGINT) IN (SELECT r FROM met) THEN 3 ELSE 2 END AS written_by FROM after a"""),
    "clustered_two_columns": """SELECT 'l_suppkey' AS filter, count(*) AS rows, count(DISTINCT l_orderkey) AS orders, true AS skips FROM lineitem WHERE l_suppkey = 3
UNION ALL SELECT 'l_shipdate', count(*), count(DISTINCT l_orderkey), true FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1996-03-01 00:00:00' AND TIMESTAMP '1996-03-31 00:00:00'""",
    "cdc_current": """WITH feed AS (
  SELECT l_orderkey AS order_key, l_linenumber AS seq, l_returnflag = 'R' AND l_linenumber % 2 = 0 AS gone,
         l_extendedprice AS price, l_suppkey AS location_id FROM lineitem),
last AS (SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY seq DESC, gone DESC, price DESC, location_id DESC) AS k FROM feed)
SELECT order_key, seq, price, location_id FROM last WHERE k = 1 AND NOT gone""",
    "drift_profile": _with(_CONF_NOBATCH, f"""SELECT src_year, src_month, count(*) AS rows, {_dec("fare_amount")} AS fare_sum,
       min(fare_amount) AS fare_min, max(fare_amount) AS fare_max,
       count(*) FILTER (WHERE fare_amount IS NULL) AS fare_nulls, count(DISTINCT pu_location_id) AS zones
FROM conformed GROUP BY ALL"""),
    "drift_vs_baseline": _with(_CONF_NOBATCH, """,
per AS (
  SELECT src_year, src_month, count(*) AS rows,
         CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) / CAST(count(fare_amount) AS DOUBLE) AS mean,
         quantile_disc(fare_amount, 0.5) AS median,
         CAST(count(*) FILTER (WHERE fare_amount IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS null_rate,
         count(DISTINCT pu_location_id) AS categories
  FROM conformed GROUP BY src_year, src_month),
base AS (
  SELECT CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) / CAST(count(fare_amount) AS DOUBLE) AS mean,
         quantile_disc(fare_amount, 0.5) AS median,
         CAST(count(*) FILTER (WHERE fare_amount IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS null_rate,
         count(DISTINCT pu_location_id) AS categories
  FROM conformed)
SELECT per.*, base.mean AS base_mean, base.median AS base_median, base.null_rate AS base_null_rate,
       base.categories AS base_categories, per.mean - base.mean AS mean_delta,
       per.null_rate - base.null_rate AS null_rate_delta
FROM per JOIN base ON true"""),
    "drift_quantiles": _with(_CONF_NOBATCH, f""",
r AS (SELECT src_year, src_month, fare_amount AS v,
             row_number() OVER (PARTITION BY src_year, src_month ORDER BY fare_amount) AS k, count(*) OVER (PARTITION BY src_year, src_month) AS n,
             row_number() OVER (ORDER BY fare_amount) AS bk, count(*) OVER () AS bn
      FROM conformed WHERE fare_amount IS NOT NULL),
base AS (SELECT {", ".join(f"min(v) FILTER (WHERE bk >= greatest(1, ({p} * bn + 99) // 100)) AS base_p{p}" for p in (5, 25, 50, 75, 95))} FROM r)
SELECT src_year, src_month, {", ".join(f"min(v) FILTER (WHERE k >= greatest(1, ({p} * n + 99) // 100)) AS p{p}" for p in (5, 25, 50, 75, 95))},
       any_value(base) AS b FROM r, base GROUP BY src_year, src_month""").replace("any_value(base) AS b", ", ".join(f"any_value(base_p{p}) AS base_p{p}" for p in (5, 25, 50, 75, 95))),
    "drift_distance": _with(_CONF_NOBATCH, """,
h AS (SELECT src_year, src_month, fare_amount AS v, count(*) AS n FROM conformed WHERE fare_amount IS NOT NULL GROUP BY ALL),
p AS (SELECT *, sum(n) OVER (PARTITION BY src_year, src_month ORDER BY v) AS upto, sum(n) OVER (PARTITION BY src_year, src_month) AS total FROM h),
b AS (SELECT v, sum(CASE WHEN src_year <= 1996 THEN n ELSE 0 END) AS there FROM h GROUP BY v),
c AS (SELECT *, sum(there) OVER (ORDER BY v) AS base, sum(there) OVER () AS everything FROM b)
SELECT src_year, src_month, CAST(sum(n) AS BIGINT) AS values, max(greatest(
         abs(CAST(upto AS DOUBLE) / CAST(total AS DOUBLE) - CAST(base AS DOUBLE) / CAST(everything AS DOUBLE)),
         abs(CAST(upto - n AS DOUBLE) / CAST(total AS DOUBLE) - CAST(base - there AS DOUBLE) / CAST(everything AS DOUBLE)))) AS distance
FROM p JOIN c USING (v) GROUP BY src_year, src_month"""),
    "category_shift": _with(_CONF_NOBATCH, """,
per AS (SELECT src_year, src_month, status_code, count(*) AS rows FROM conformed GROUP BY ALL),
tot AS (SELECT src_year, src_month, count(*) AS period_rows FROM conformed GROUP BY ALL),
ov AS (SELECT status_code, count(*) AS base_rows FROM conformed GROUP BY ALL),
n AS (SELECT count(*) AS all_rows FROM conformed)
SELECT per.src_year, per.src_month, per.status_code,
       CAST(per.rows AS DOUBLE) / CAST(tot.period_rows AS DOUBLE) AS share,
       CAST(ov.base_rows AS DOUBLE) / CAST(n.all_rows AS DOUBLE) AS base_share,
       CAST(per.rows AS DOUBLE) / CAST(tot.period_rows AS DOUBLE) - CAST(ov.base_rows AS DOUBLE) / CAST(n.all_rows AS DOUBLE) AS share_delta
FROM per JOIN tot USING (src_year, src_month) LEFT JOIN ov USING (status_code) JOIN n ON true"""),
    # ---- landing / bronze
    "source_months": _with(_TRIPS, """SELECT year, month, 'period=' || strftime(o_orderdate, '%Y-%m') AS unit,
       CAST(1 AS BIGINT) AS files FROM trips GROUP BY ALL"""),
    "map_struct": _with(_TRIPS, """, n AS (SELECT CAST(count(*) AS VARCHAR) AS total, CAST(count(*) FILTER (WHERE year = 1996) AS VARCHAR) AS y96 FROM trips)
SELECT 1 AS version, '0' AS added, 'create' AS operation FROM n
UNION ALL SELECT 2, total, 'replace' FROM n
UNION ALL SELECT 3, total, 'replace' FROM n
UNION ALL SELECT 4, y96, 'replace' FROM n
UNION ALL SELECT 5, '0', 'revert' FROM n"""),
    "filename_parts": _with(_TRIPS, "SELECT year, month, count(*) AS source_rows FROM trips GROUP BY ALL"),
    "string_tail": _with(_TRIPS, """SELECT 'period=' || strftime(o_orderdate, '%Y-%m') AS source_unit, count(*) AS rows
FROM trips GROUP BY ALL"""),
    "bronze_readback": _with(_TRIPS, "SELECT * EXCLUDE (year, month), 'run-1' AS _batch_id, year, month FROM trips"),
    "bronze_run": _with(_TRIPS, """SELECT 2 AS version, 'replace' AS operation, 'run-1' AS batch_id,
       count(*) AS added_records, CAST(0 AS BIGINT) AS deleted_records FROM trips"""),
    "enrich": _with(_TRIPS, """SELECT l_orderkey, l_linenumber, l_suppkey, 'period=' || strftime(o_orderdate, '%Y-%m') AS source_unit,
       'run-1' AS _batch_id, year, month FROM trips"""),
    "batch_profile": _with(_TRIPS, """SELECT year, month, 'run-1' AS _batch_id, count(*) AS rows, CAST(1 AS BIGINT) AS distinct_ingested_at
FROM trips GROUP BY ALL"""),
    "distinct_months": _with(_TRIPS, "SELECT DISTINCT year, month FROM trips"),
    "group_by_expr": _with(_TRIPS, """SELECT 'period=' || strftime(o_orderdate, '%Y-%m') AS source_unit, count(*) AS rows
FROM trips GROUP BY ALL"""),
    "trace": _with(_TRIPS, """SELECT 'period=' || strftime(o_orderdate, '%Y-%m') AS source_unit, count(*) AS rows,
       CAST(0 AS BIGINT) AS untraced FROM trips GROUP BY ALL"""),
    "reconcile": _with(_TRIPS, """SELECT year, month, count(*) AS source_rows, count(*) AS table_rows, true AS matches
FROM trips GROUP BY ALL"""),
    "partition_prune": _with(_TRIPS, """SELECT year, month, count(*) AS rows FROM trips
WHERE year = 1996 AND month IN (1, 2, 3) GROUP BY ALL"""),
    "overwrite_twice": _with(_TRIPS, "SELECT year, month, 'run-2' AS _batch_id, count(*) AS rows FROM trips GROUP BY ALL"),
    "append_twice": _with(_TRIPS, "SELECT year, month, 2 * count(*) AS rows FROM trips GROUP BY ALL"),
    "schema_evolve": _with(_TRIPS, """SELECT year, month, count(*) AS rows,
       CASE WHEN year >= 1998 THEN count(*) ELSE 0 END AS with_surcharge FROM trips GROUP BY year, month"""),
    # ---- history (fixed scenario, see strata.build)
    "table_current": _hist_rows("'run-2'"),
    "as_of_version": _hist_rows("'run-1'"),
    "as_of_time": _hist_rows("'run-2'"),
    "replace_partitions": _hist_rows("CASE WHEN year = 1996 THEN 'run-3' ELSE 'run-2' END"),
    "rollback": _hist_rows("'run-1'"),
    "set_current": _hist_rows("CASE WHEN year = 1996 THEN 'run-3' ELSE 'run-2' END"),
    "undo_batch": _hist_rows("'run-2'"),
    "compact": _hist_rows("'run-1'"),
    "version_diff": _with(_TRIPS, f"""SELECT {_ROWKEY_SQL.format(b="'run-2'")}, 'removed' AS _change FROM trips WHERE year = 1996
UNION ALL
SELECT {_ROWKEY_SQL.format(b="'run-3'")}, 'added' AS _change FROM trips WHERE year = 1996"""),
    "commit_delta": _with(_TRIPS, """, m AS (SELECT year, month, count(*) AS records FROM trips GROUP BY ALL)
SELECT 4 AS version, year, month, 4 AS data_version, records, 'added' AS status FROM m WHERE year = 1996
UNION ALL SELECT 4, year, month, 3, records, 'deleted' FROM m WHERE year = 1996
UNION ALL SELECT 4, year, month, 3, records, 'existing' FROM m WHERE year <> 1996"""),
    "manifests": _with(_TRIPS, """, m AS (SELECT year, count(*) AS records FROM trips GROUP BY year, month)
SELECT 4 AS version,
       count(*) FILTER (WHERE year = 1996) AS added_partitions,
       count(*) FILTER (WHERE year <> 1996) AS existing_partitions,
       count(*) FILTER (WHERE year = 1996) AS deleted_partitions,
       CAST(coalesce(sum(records) FILTER (WHERE year = 1996), 0) AS BIGINT) AS added_records,
       CAST(coalesce(sum(records) FILTER (WHERE year = 1996), 0) AS BIGINT) AS deleted_records
FROM m"""),
    "snapshots": _with(_TRIPS, """, n AS (SELECT count(*) AS total, count(*) FILTER (WHERE year = 1996) AS y96 FROM trips)
SELECT CAST(1 AS BIGINT) AS seq, 1 AS version, CAST(NULL AS INTEGER) AS parent, 'create' AS operation,
       CAST(NULL AS VARCHAR) AS batch_id, CAST(0 AS BIGINT) AS added_records, CAST(0 AS BIGINT) AS deleted_records,
       TIMESTAMP '2024-01-01 00:00:00' AS committed_at FROM n
UNION ALL SELECT 2, 2, 1, 'replace', 'run-1', total, 0, TIMESTAMP '2024-01-01 01:00:00' FROM n
UNION ALL SELECT 3, 3, 2, 'replace', 'run-2', total, total, TIMESTAMP '2024-01-01 02:00:00' FROM n
UNION ALL SELECT 4, 4, 3, 'replace', 'run-3', y96, y96, TIMESTAMP '2024-01-01 03:00:00' FROM n
UNION ALL SELECT 7, 5, 4, 'revert', 'run-3', 0, 0, TIMESTAMP '2024-01-01 06:00:00' FROM n"""),
    "history": """SELECT * FROM (VALUES
  (CAST(1 AS BIGINT), 1, CAST(NULL AS INTEGER), 'create', CAST(NULL AS VARCHAR), TIMESTAMP '2024-01-01 00:00:00'),
  (2, 2, 1, 'replace', 'run-1', TIMESTAMP '2024-01-01 01:00:00'),
  (3, 3, 2, 'replace', 'run-2', TIMESTAMP '2024-01-01 02:00:00'),
  (4, 4, 3, 'replace', 'run-3', TIMESTAMP '2024-01-01 03:00:00'),
  (5, 2, 4, 'rollback', NULL, TIMESTAMP '2024-01-01 04:00:00'),
  (6, 4, 2, 'set_current', NULL, TIMESTAMP '2024-01-01 05:00:00'),
  (7, 5, 4, 'revert', 'run-3', TIMESTAMP '2024-01-01 06:00:00')
) AS t(seq, version, parent, operation, batch_id, committed_at)""",
    "describe": """SELECT * FROM (VALUES
  ('l_orderkey', 'bigint', false),
  ('l_linenumber', 'int', false),
  ('l_suppkey', 'bigint', false),
  ('l_quantity', 'double', false),
  ('l_extendedprice', 'double', false),
  ('l_discount', 'double', false),
  ('l_tax', 'double', false),
  ('l_returnflag', 'string', false),
  ('l_shipdate', 'timestamp_ntz', false),
  ('o_orderdate', 'timestamp_ntz', false),
  ('o_orderstatus', 'string', false),
  ('o_orderpriority', 'string', false),
  ('c_acctbal', 'double', false),
  ('_source_file', 'string', false),
  ('_ingested_at', 'timestamp', false),
  ('_batch_id', 'string', false),
  ('year', 'int', true),
  ('month', 'int', true)
) AS t(col_name, data_type, is_partition)""",
    "contract_report": """SELECT * FROM (VALUES
  ('added', 'surcharge', 'added', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)),
  ('missing', 'l_quantity', 'missing', NULL, NULL),
  ('retyped', 'l_discount', 'retyped', 'double', 'string'),
  ('renamed', 'l_tax', 'missing', NULL, NULL),
  ('renamed', 'tax_rate', 'added', NULL, NULL)
) AS t(source, "column", kind, expected, actual)""",
    "expire_plan": _with(_TRIPS, """SELECT 3 AS data_version, year, month, count(*) AS records FROM trips
WHERE year = 1996 GROUP BY ALL"""),
    # ---- silver
    "silver_conform": _with(_CONFORMED.replace("BATCH", "'run-1'"), "SELECT * FROM conformed"),
    "rule_negative": _with(_CONF_NOBATCH, """SELECT trip_id, line_no, src_year, src_month FROM conformed
WHERE fare_amount < 0 OR tip_amount < 0 OR balance_amount < 0"""),
    "rule_zero_distance": _with(_CONF_NOBATCH, """SELECT trip_id, line_no, src_year, src_month FROM conformed
WHERE trip_distance = 0 AND fare_amount > 0"""),
    "rule_time_order": _with(_CONF_NOBATCH, "SELECT trip_id, line_no, src_year, src_month FROM conformed WHERE dropoff_at < pickup_at"),
    "rule_out_of_period": _with(_CONF_NOBATCH, """SELECT trip_id, line_no, src_year, src_month FROM conformed
WHERE CAST(dropoff_at AS DATE) < make_date(src_year, src_month, 1)
   OR CAST(dropoff_at AS DATE) >= make_date(src_year, src_month, 1) + INTERVAL 1 MONTH"""),
    "silver_trips": _with(_CLASSIFIED, "SELECT * FROM silver"),
    "silver_rejects": _with(_CLASSIFIED, """SELECT trip_id, line_no, src_year, src_month, array_to_string(reasons, ',') AS reasons
FROM rejects"""),
    "observe_counts": _with(_CLASSIFIED, """SELECT count(*) AS rows, count(*) FILTER (WHERE len(reasons) > 0) AS rejected
FROM classified"""),
    "silver_late": _with(_CONF_NOBATCH, """SELECT trip_id, line_no, dropoff_at, CAST(date_trunc('month', dropoff_at) AS DATE) AS event_month,
       src_year, src_month, 'run-1' AS _batch_id
FROM conformed
WHERE CAST(dropoff_at AS DATE) >= make_date(src_year, src_month, 1) - INTERVAL 3 MONTH
  AND CAST(dropoff_at AS DATE) < make_date(src_year, src_month, 1) + INTERVAL 1 MONTH"""),
    "late_file_count": _with(_LATE, f"""SELECT event_month, count(*) AS rows,
       CAST(ceil(count(*) / {build.SMALL_FILE_ROWS}.0) AS BIGINT) AS allowed, true AS within FROM late GROUP BY event_month"""),
    "silver_lineage": _with(_LATE, "SELECT event_month, src_year, src_month, count(*) AS rows FROM late GROUP BY ALL"),
    "backfill_scope": _with(_LATE, """, m AS (SELECT DISTINCT src_year AS year, src_month AS month FROM conformed),
f AS (SELECT DISTINCT event_month, src_year, src_month FROM late)
SELECT year, month, src_year, src_month FROM m JOIN f
  ON f.event_month BETWEEN make_date(year, month, 1) - INTERVAL 3 MONTH AND make_date(year, month, 1)
UNION SELECT year, month, year, month FROM m"""),
    "nullability_change": _with(_TRIPS, """, ms AS (SELECT year, month, row_number() OVER (ORDER BY year, month) AS k, count(*) OVER () AS n
                                        FROM (SELECT DISTINCT year, month FROM trips)),
u AS (SELECT ms.k, any_value(year) AS year, any_value(month) AS month, count(*) AS rows, count(*) FILTER (WHERE l_linenumber = 1) AS firsts
      FROM trips JOIN ms USING (year, month) WHERE ms.k - 1 - n // 2 IN (0, 1) GROUP BY ms.k, n),
t AS (SELECT *, k = min(k) OVER () AS there, lag(rows) OVER (ORDER BY k) AS all_before, lag(firsts) OVER (ORDER BY k) AS firsts_before FROM u)
SELECT year, month, 'c_acctbal' AS "column", CASE WHEN there THEN 'turned null' ELSE 'no null' END AS kind,
       CASE WHEN there THEN 0 ELSE all_before END AS before, CASE WHEN there THEN rows ELSE 0 END AS nulls, rows FROM t
UNION ALL
SELECT year, month, 'l_tax', CASE WHEN there AND firsts = rows THEN 'turned null' WHEN there THEN 'some null' ELSE 'no null' END,
       CASE WHEN there THEN 0 ELSE firsts_before END, CASE WHEN there THEN firsts ELSE 0 END, rows
FROM t WHERE CASE WHEN there THEN firsts ELSE firsts_before END > 0"""),
    "affected_periods": _with(_TRIPS, """SELECT DISTINCT year, month FROM trips
WHERE CAST(date_trunc('month', l_shipdate) AS DATE) BETWEEN MIDMONTH - INTERVAL 3 MONTH AND MIDMONTH"""),
    "zone_enrich": _with(_CONF_NOBATCH + _ZONES, """SELECT c.trip_id, c.line_no, c.pu_location_id, z.zone_name AS pu_zone, z.borough AS pu_borough
FROM conformed c LEFT JOIN zones z ON c.pu_location_id = z.location_id"""),
    "dim_zone": _with(_TRIPS + _ZONES, """SELECT z.location_id, z.zone_name, z.borough,
       (SELECT string_agg(CAST(cell_id AS VARCHAR), ',' ORDER BY cell_id) FROM bridge b WHERE b.location_id = z.location_id) AS cells,
       CAST((SELECT count(*) FROM bridge b WHERE b.location_id = z.location_id) AS INTEGER) AS n_cells
FROM zones z"""),
    "grid_apportion": _with(_CLASSIFIED + ",\n" + _GRID, "SELECT pu_location_id, cell_id, trips, weight FROM ap"),
    "gold_grid_demand": _with(_CLASSIFIED + ",\n" + _GRID, "SELECT cell_id, round(sum(trips * weight), 6) AS demand FROM ap GROUP BY cell_id"),
    "grid_join": _with(_CLASSIFIED + ",\n" + _GRID.replace(
        "zd AS (SELECT pu_location_id, count(*) AS trips FROM silver GROUP BY pu_location_id)",
        "zd AS (SELECT pu_location_id, CAST(isodow(pickup_at) - 1 AS INTEGER) AS weekday, count(*) AS trips FROM silver GROUP BY ALL)",
    ).replace("SELECT zd.pu_location_id, b.cell_id,", "SELECT zd.pu_location_id, zd.weekday, b.cell_id,"), """,
ev AS (SELECT (user_id % 7) * 10 + user_id % 3 AS cell_id, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, count(*) AS events
       FROM events GROUP BY ALL),
gd AS (SELECT cell_id, weekday, round(sum(trips * weight), 6) AS demand FROM ap GROUP BY ALL)
SELECT gd.cell_id, gd.weekday, gd.demand, ev.events FROM gd JOIN ev ON gd.cell_id = ev.cell_id AND gd.weekday = ev.weekday"""),
    # ---- gold
    "gold_zone_daily": _with(_CLASSIFIED, _ZONE_DAILY),
    "gold_borough_summary": _with(_CLASSIFIED, """SELECT pu_borough, count(*) AS trips,
       CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_fare,
       CAST(sum(CAST(tip_amount AS DECIMAL(18,4))) AS DOUBLE) / CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) AS tip_rate
FROM silver GROUP BY pu_borough"""),
    "gold_reject_rate": _with(_CLASSIFIED + ",\n" + _REJECT_RATE, "SELECT * FROM rate"),
    "reject_by_reason": _with(_CLASSIFIED, """SELECT src_year, src_month, reason, count(*) AS rows
FROM (SELECT src_year, src_month, unnest(reasons) AS reason FROM rejects) GROUP BY ALL"""),
    "reject_rate_delta": _with(_CLASSIFIED + ",\n" + _REJECT_RATE, """SELECT src_year, src_month, reject_rate,
       lag(reject_rate) OVER (ORDER BY src_year, src_month) AS prev_rate,
       reject_rate - lag(reject_rate) OVER (ORDER BY src_year, src_month) AS delta
FROM rate"""),
    "zone_rank": _with(_CLASSIFIED, """, r AS (SELECT event_month, pu_location_id, sum(CAST(fare_amount AS DECIMAL(18,4))) AS rev
           FROM silver GROUP BY ALL)
SELECT event_month, pu_location_id, CAST(rev AS DOUBLE) AS revenue,
       CAST(rank() OVER (PARTITION BY event_month ORDER BY rev DESC, pu_location_id) AS INTEGER) AS rank,
       CAST(dense_rank() OVER (PARTITION BY event_month ORDER BY rev DESC, pu_location_id) AS INTEGER) AS dense_rank
FROM r"""),
    "running_total": _with(_CLASSIFIED, """, d AS (SELECT pu_location_id, CAST(pickup_at AS DATE) AS pickup_date,
                  sum(CAST(fare_amount AS DECIMAL(18,4))) AS rev FROM silver GROUP BY ALL)
SELECT pu_location_id, pickup_date, CAST(rev AS DOUBLE) AS revenue,
       CAST(sum(rev) OVER (PARTITION BY pu_location_id ORDER BY pickup_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_revenue
FROM d"""),
    "gold_grain": _with(_CLASSIFIED, """SELECT pu_location_id, pickup_date, pickup_hour, count(*) AS n
FROM (""" + _ZONE_DAILY + """) GROUP BY pu_location_id, pickup_date, pickup_hour HAVING count(*) > 1"""),
    "gold_reconcile": _with(_CLASSIFIED, """SELECT count(*) AS silver_trips, CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) AS silver_revenue,
       count(*) AS gold_trips, CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) AS gold_revenue,
       CAST(0 AS BIGINT) AS trips_diff, CAST(0.0 AS DOUBLE) AS revenue_diff FROM silver"""),
    "gold_lineage": _with(_CLASSIFIED, "SELECT *, 2 AS _silver_version FROM (" + _ZONE_DAILY + ")"),
}
ORACLE["join_broadcast"] = ORACLE["zone_enrich"]
ORACLE["join_sortmerge"] = ORACLE["zone_enrich"]


def _mid_month_sql() -> str:
    """The source month the late-data scenario reprocesses (middle of the order months)."""
    return """(SELECT make_date(CAST(year(m) AS INTEGER), CAST(month(m) AS INTEGER), 1) FROM (
  SELECT m FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders)
  ORDER BY m LIMIT 1 OFFSET (SELECT count(DISTINCT date_trunc('month', o_orderdate)) // 2 FROM orders)))"""


for _k in ("affected_periods",):
    ORACLE[_k] = ORACLE[_k].replace("MIDMONTH", _mid_month_sql())


ORACLE |= {
    "null_partition": """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders
WHERE o_orderstatus <> 'P' OR o_orderkey % 2 = 0""",
    "undo_batch_twice": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0",
    "evolve_reland": """SELECT o_orderkey, o_totalprice, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "silver_null_event": _with(_CONF_NOBATCH, """SELECT CASE WHEN fare_amount < 0 OR tip_amount < 0 OR balance_amount < 0 THEN 'negative_amount'
            WHEN trip_id % 7 = 0 THEN 'unplaceable_event' ELSE 'kept' END AS outcome, count(*) AS rows FROM conformed GROUP BY 1"""),
    "gold_trip_demand": _with(_CLASSIFIED, """SELECT CAST(isodow(pickup_at) - 1 AS INTEGER) AS weekday, CAST(hour(pickup_at) AS INTEGER) AS hour,
       isodow(pickup_at) >= 6 AS is_weekend, count(*) AS trips, CAST(sum(CAST(fare_amount AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM silver GROUP BY ALL"""),
}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES} | {k: v for m in _corpus() for k, v in m.oracle_sql().items()}
