"""Gold: one table per question, built only from silver.

Silver is aggregated **once**, at the finest gold grain (zone x day x hour);
the borough summary, zone ranks, running totals and grid demand are rolled up
from that table, so a gold build scans silver once instead of once per table.
Windows therefore run over a few rows per zone and day, never over trips.
Money sums go through decimal(18,4) -- and back to it when rolling up -- so
the same input always gives the same number; ratios are taken from sums,
never averaged (they are not additive).  Gold asserts its grain; it never
filters for quality.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions import exact_sum, hour_of, is_weekend, safe_ratio, weekday_of
from strata.operators.history import delete_path, list_subdirs, path_exists
from strata.operators.quality import REASONS, RejectRateExceeded
from strata.session import unsorted_write


def zone_daily(silver: DataFrame) -> DataFrame:
    """Revenue per pickup zone x day x hour."""
    return (
        silver.withColumns({"pickup_date": F.to_date("pickup_at"), "pickup_hour": hour_of("pickup_at")})
        .groupBy("pu_location_id", "pu_zone", "pu_borough", "pickup_date", "pickup_hour")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            exact_sum("fare_amount").alias("revenue"),
            exact_sum("tip_amount").alias("tips"),
        )
    )


def hourly_demand(df: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    """Demand by weekday (Monday = 0) and hour, with a weekend flag."""
    return (
        df.withColumns({"weekday": weekday_of(ts), "hour": hour_of(ts), "is_weekend": is_weekend(ts)})
        .groupBy("weekday", "hour", "is_weekend")
        .agg(F.count(F.lit(1)).alias("events"), exact_sum(value).alias("total_value"))
    )


def _dec(c: str):
    """A money column of a gold table back as the exact decimal it was summed as."""
    return F.col(c).cast("decimal(18,4)")


def _measures(df: DataFrame):
    """(day, revenue, tips, trips) for silver trips or for ``zone_daily`` rows.

    The roll-ups below accept either: asked of silver they aggregate trips once;
    inside ``build_gold`` they roll up the stored ``zone_daily`` table instead.
    """
    if "fare_amount" in df.columns:  # silver: one row per trip
        return F.to_date("pickup_at"), _dec("fare_amount"), _dec("tip_amount"), F.count(F.lit(1))
    return F.col("pickup_date"), _dec("revenue"), _dec("tips"), F.sum("trips")


def borough_summary(df: DataFrame) -> DataFrame:
    """Volume, average fare and tipping rate per borough (ratios of exact sums)."""
    _, revenue, tips, trips = _measures(df)
    fare, tip = F.sum(revenue), F.sum(tips)
    return df.groupBy("pu_borough").agg(
        trips.alias("trips"),
        safe_ratio(fare, trips).alias("avg_fare"),
        safe_ratio(tip, fare).alias("tip_rate"),
    )


def reject_rate(silver: DataFrame, rejects: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """Input, rejected and the unusable fraction per source month.

    ``kept`` (src_year, src_month, kept) saves the scan of silver.
    """
    keys = ["src_year", "src_month"]
    kept = silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("kept")) if kept is None else kept
    bad = rejects.groupBy(*keys).agg(F.count(F.lit(1)).alias("rejected"))
    j = kept.join(bad, keys, "full_outer").fillna(0, ["kept", "rejected"])
    return j.select(
        *keys,
        (F.col("kept") + F.col("rejected")).alias("input_rows"),
        "rejected",
        safe_ratio(F.col("rejected"), F.col("kept") + F.col("rejected")).alias("reject_rate"),
    )


def reject_alerts(rate: DataFrame, threshold: float) -> DataFrame:
    """Q8: source months whose unusable fraction is above ``threshold``."""
    return rate.where(F.col("reject_rate") > F.lit(threshold))


def raise_on_reject_rate(rate: DataFrame, threshold: float) -> None:
    """Q8: fail the run when any month is above the threshold (one small job)."""
    bad = reject_alerts(rate, threshold).orderBy("src_year", "src_month").collect()  # one row per month
    if bad:
        months = ", ".join(f"{r.src_year:04d}-{r.src_month:02d} ({r.reject_rate:.2%})" for r in bad)
        raise RejectRateExceeded(f"reject rate above {threshold:.2%} in {months}")


def reject_by_reason(rejects: DataFrame) -> DataFrame:
    """Rejected rows per source month and reason (a row may carry several)."""
    return (
        rejects.select("src_year", "src_month", F.explode(REASONS).alias("reason"))
        .groupBy("src_year", "src_month", "reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def reject_rate_delta(rate: DataFrame) -> DataFrame:
    """Change of the reject fraction against the previous source month.

    Ordered by month over the whole (one row per month) table: a tiny window.
    """
    w = Window.orderBy("src_year", "src_month")
    prev = F.lag("reject_rate").over(w)
    return rate.select(
        "src_year", "src_month", "reject_rate",
        prev.alias("prev_rate"),
        (F.col("reject_rate") - prev).alias("delta"),
    )


def zone_rank(df: DataFrame) -> DataFrame:
    """Zones ranked by revenue within each month (ties broken by zone id)."""
    day, revenue, _, _ = _measures(df)
    monthly = df.groupBy(F.trunc(day, "month").alias("event_month"), "pu_location_id").agg(
        F.sum(revenue).alias("_rev")
    )
    w = Window.partitionBy("event_month").orderBy(F.desc("_rev"), "pu_location_id")
    return monthly.select(
        "event_month", "pu_location_id",
        F.col("_rev").cast("double").alias("revenue"),
        F.rank().over(w).alias("rank"),
        F.dense_rank().over(w).alias("dense_rank"),
    )


def running_total(df: DataFrame) -> DataFrame:
    """Cumulative revenue by day per zone (exact decimal accumulation)."""
    day, revenue, _, _ = _measures(df)
    per_day = df.groupBy("pu_location_id", day.alias("pickup_date")).agg(F.sum(revenue).alias("_rev"))
    w = Window.partitionBy("pu_location_id").orderBy("pickup_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return per_day.select(
        "pu_location_id", "pickup_date",
        F.col("_rev").cast("double").alias("revenue"),
        F.sum("_rev").over(w).cast("double").alias("cumulative_revenue"),
    )


def hourly_trips(daily: DataFrame) -> DataFrame:
    """Demand by weekday (Monday = 0) and hour over all trips, rolled up from ``zone_daily``."""
    days = daily.withColumns({"weekday": weekday_of("pickup_date"), "is_weekend": is_weekend("pickup_date")})
    return days.groupBy("weekday", F.col("pickup_hour").alias("hour"), "is_weekend").agg(
        F.sum("trips").alias("trips"), F.sum(_dec("revenue")).cast("double").alias("revenue")
    )


def grain_violations(df: DataFrame, grain: list[str]) -> DataFrame:
    """Q13: grain keys that occur more than once (must be empty)."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def totals_reconcile(silver: DataFrame, gold_zone_daily: DataFrame) -> DataFrame:
    """Q13: gold totals against silver totals, one row; differences must be 0.

    Two global aggregates are stacked and folded into one row (no join).
    """
    none = F.lit(None)
    s = silver.agg(
        F.count(F.lit(1)).alias("silver_trips"),
        F.sum(F.col("fare_amount").cast("decimal(18,4)")).alias("silver_revenue"),
    ).select("*", none.cast("bigint").alias("gold_trips"), none.cast("decimal(38,4)").alias("gold_revenue"))
    g = gold_zone_daily.agg(
        F.sum("trips").alias("gold_trips"),
        F.sum(F.col("revenue").cast("decimal(18,4)")).alias("gold_revenue"),
    ).select(none.cast("bigint").alias("silver_trips"), none.cast("decimal(38,4)").alias("silver_revenue"), "*")
    one = s.unionByName(g).agg(*[F.max(c).alias(c) for c in ("silver_trips", "silver_revenue", "gold_trips", "gold_revenue")])
    return one.select(
        "silver_trips",
        F.col("silver_revenue").cast("double").alias("silver_revenue"),
        "gold_trips",
        F.col("gold_revenue").cast("double").alias("gold_revenue"),
        (F.col("gold_trips") - F.col("silver_trips")).alias("trips_diff"),
        (F.col("gold_revenue") - F.col("silver_revenue")).cast("double").alias("revenue_diff"),
    )


def with_lineage(df: DataFrame, silver_version: int) -> DataFrame:
    """Q19: stamp the silver version that fed a gold table."""
    return df.withColumn("_silver_version", F.lit(silver_version).cast("int"))


#: The month a stored table's rows report on; such a table is partitioned by it.
REPORT_MONTH = "report_month"
_MONTHS = {
    "zone_daily": "trunc(pickup_date, 'month')",
    "running_total": "trunc(pickup_date, 'month')",
    "zone_rank": "event_month",
    "reject_rate": "make_date(src_year, src_month, 1)",
    "reject_delta": "make_date(src_year, src_month, 1)",
    "reject_reasons": "make_date(src_year, src_month, 1)",
}
# Tables rolled up from zone_daily: name -> (builder, grain).
ROLLUPS = {
    "borough_summary": (borough_summary, ["pu_borough"]),
    "zone_rank": (zone_rank, ["event_month", "pu_location_id"]),
    "running_total": (running_total, ["pu_location_id", "pickup_date"]),
    "hourly_demand": (hourly_trips, ["weekday", "hour"]),
}
DAILY_GRAIN = ["pu_location_id", "pickup_date", "pickup_hour"]


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """A stored gold table without its partition column."""
    return spark.read.parquet(path).drop(REPORT_MONTH)


# ------------------------------------------------------------------ publication
PUBLISHED = "seq bigint, build string, silver_version int, tables array<string>"


def _published(spark: SparkSession, root: str) -> list:
    """Published builds, the latest first (one small row each)."""
    path = f"{root}/published"
    if not path_exists(spark, path):
        return []
    return sorted(spark.read.schema(PUBLISHED).parquet(path).collect(), key=lambda r: -r.seq)


def current_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """The gold tables of the latest published build: name -> path."""
    builds = _published(spark, root)
    return {name: f"{root}/build={builds[0].build}/{name}" for name in builds[0].tables} if builds else {}


def _publish(spark: SparkSession, root: str, build: str, silver_version: int, tables: list[str]) -> None:
    """Make ``build`` the current one: one new row, which names all its tables at once.

    Data of builds before the previous one is deleted afterwards: a reader that has just looked up
    the previous one still finds it.
    """
    before = _published(spark, root)
    row = (before[0].seq + 1 if before else 1, build, silver_version, sorted(tables))
    spark.createDataFrame([row], PUBLISHED).coalesce(1).write.mode("append").parquet(f"{root}/published")
    keep = {build, *[r.build for r in before[:1]]}
    for name in list_subdirs(spark, root):
        if name.startswith("build=") and name.removeprefix("build=") not in keep:
            delete_path(spark, f"{root}/{name}")


def build_gold(
    spark: SparkSession, silver: DataFrame, silver_version: int, root: str,
    *, rejects: DataFrame | None = None, bridge: DataFrame | None = None, kept: DataFrame | None = None,
) -> dict[str, str]:
    """Q17: rebuild gold from silver and publish the build as a whole; returns name -> path.

    1. ``zone_daily`` is aggregated from silver.
    2. Every other table is rolled up from the written ``zone_daily`` (lineage
       cut by storage), concurrently: borough summary, zone ranks, running
       totals, demand by weekday and hour, plus grid demand when a zone -> cell
       ``bridge`` is given and reject rate, reasons and deltas when ``rejects`` are.
       Beside them the totals are checked: a second look at silver, at one column.
       Kept rows per source month come from ``kept`` (silver's lineage) if it is given.

    Each table is stamped with its silver version, partitioned by reporting month where it has one,
    in files that adaptive execution sizes, and its grain is asserted where it was written.  One
    row then publishes all tables of the build (:func:`current_tables`): readers see the previous
    build or this one, never a mixture, and never a build that failed a check.
    """
    build = uuid.uuid4().hex[:12]

    def write(name: str, df: DataFrame, grain: list[str]) -> tuple[str, str]:
        path = f"{root}/build={build}/{name}"
        stamped, parts = with_lineage(df, silver_version), []
        if name in _MONTHS:  # a large month is split, small ones share a task
            stamped, parts = stamped.withColumn(REPORT_MONTH, F.expr(_MONTHS[name])).hint("rebalance", F.col(REPORT_MONTH)), [REPORT_MONTH]
        with unsorted_write(spark):
            stamped.write.partitionBy(*parts).parquet(path)
        written = spark.read.schema(stamped.schema).parquet(path)
        if parts and written.isEmpty():  # a partitioned write of no rows leaves no file to read the columns from
            spark.createDataFrame([], stamped.schema).coalesce(1).write.mode("append").parquet(path)
        if not grain_violations(written, grain).isEmpty():
            raise AssertionError(f"gold {name}: grain {grain} is not unique")
        return name, path

    def totals(daily: DataFrame) -> None:
        one = totals_reconcile(silver, daily).first()
        if one.trips_diff or one.revenue_diff:
            raise AssertionError(f"gold zone_daily does not add up to silver: {one}")

    out = dict([write("zone_daily", zone_daily(silver), DAILY_GRAIN)])
    daily = read_gold(spark, out["zone_daily"])
    jobs = [(name, fn(daily), grain) for name, (fn, grain) in ROLLUPS.items()]
    if bridge is not None:
        from strata.operators.grid import grid_demand_from_daily

        jobs.append(("grid_demand", grid_demand_from_daily(daily, bridge), ["cell_id"]))
    months = ["src_year", "src_month"]
    if rejects is not None:
        name, path = write("reject_rate", reject_rate(silver, rejects, kept), months)
        out[name] = path
        jobs += [("reject_delta", reject_rate_delta(read_gold(spark, path)), months), ("reject_reasons", reject_by_reason(rejects), [*months, "reason"])]
    # independent tables: built as concurrent Spark jobs from driver threads
    with ThreadPoolExecutor(max_workers=max(1, min(6, len(jobs) + 1))) as pool:
        checked = pool.submit(totals, daily)
        out.update(pool.map(lambda j: write(*j), jobs))
        checked.result()
    _publish(spark, root, build, silver_version, list(out))
    return out
