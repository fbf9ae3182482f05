"""Given tables and the landing zone built from them.

The test data is a TPC-H-like star schema.  The trip feed of the medallion
layers is ``lineitem JOIN orders JOIN customer``; its landing month is the
month of ``o_orderdate``.  The zone dimension is ``supplier`` with its borough
taken from ``region`` through ``nation``.  Everything here derives from the
given tables, so the work grows with them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.layout import Layout
from strata.session import unsorted_write

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# The columns of one landed trip record, in source spelling.
LANDING_COLUMNS = (
    "l_orderkey",
    "l_linenumber",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_shipdate",
    "o_orderdate",
    "o_orderstatus",
    "o_orderpriority",
    "c_acctbal",
)

# Explicit schema of the zone lookup CSV: strings in, cast in silver.
ZONE_CSV_SCHEMA = T.StructType(
    [
        T.StructField("location_id", T.StringType()),
        T.StructField("zone_name", T.StringType()),
        T.StructField("borough", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Single-file scan of one given table (B2)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def glob_scan(spark: SparkSession, pattern: str) -> DataFrame:
    """Read every file matching a glob as one DataFrame (B1)."""
    return spark.read.parquet(pattern)


def trip_records(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The raw trip feed: one row per line item, with its order and customer.

    ``orders JOIN customer`` is joined first so the largest input (lineitem)
    crosses a shuffle once; the planner picks broadcast or sort-merge for each
    join from the measured sizes (no blind broadcast hint on a fact table).  With
    ``partitions`` lineitem meets its orders in that many, whatever the session's number.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey)
    if partitions:
        li, oc = li.repartition(partitions, "l_orderkey"), oc.repartition(partitions, "o_orderkey")
    return li.join(oc, li.l_orderkey == oc.o_orderkey).select(*LANDING_COLUMNS)


def stage_landing(
    spark: SparkSession, sf_dir: str, layout: Layout, *, rows_per_file: int = 4_000_000
) -> str:
    """Write the trip feed as one reload unit per order month.

    ``landing/trips/period=YYYY-MM/part-*.parquet``.  Each period gets
    ``ceil(estimated rows / rows_per_file)`` files: the estimate is the period's
    order count times the average lines per order, taken from ``orders`` and
    ``lineitem`` counts (one small aggregate, one row per calendar month, used
    as a literal map), so a hot month is written by several tasks and the join
    is not computed twice.
    Rows are assigned to files by a deterministic hash, so a retried task
    writes the same rows.  Returns the landing path.
    """
    trips = trip_records(spark, sf_dir).withColumn("period", F.date_format("o_orderdate", "yyyy-MM"))
    orders = table(spark, sf_dir, "orders")
    lines_per_order = table(spark, sf_dir, "lineitem").count() / max(1, orders.count())
    per_month = (
        orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("period"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .collect()  # one row per calendar month: metadata-sized
    )
    files = {r.period: max(1, math.ceil(r.orders * lines_per_order / rows_per_file)) for r in per_month}
    # a literal map lookup: no join, nothing to broadcast
    lookup = F.create_map(*[x for p, k in sorted(files.items()) for x in (F.lit(p), F.lit(k))])
    n_files = F.coalesce(F.element_at(lookup, F.col("period")), F.lit(1)).cast("long")
    salt = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey"), n_files)
    with unsorted_write(spark):
        (
            trips.withColumn("_salt", salt)
            .repartition("period", "_salt")
            .drop("_salt")
            .write.mode("overwrite")
            .partitionBy("period")
            .parquet(layout.landing)
        )
    return layout.landing


def zone_lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup rows as text: ``location_id, zone_name, borough``."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return supplier.join(geo, supplier.s_nationkey == geo.n_nationkey, "left").select(
        F.col("s_suppkey").cast("string").alias("location_id"),
        F.col("s_name").alias("zone_name"),
        F.col("r_name").alias("borough"),
    )


def stage_zone_csv(spark: SparkSession, sf_dir: str, layout: Layout) -> str:
    """Write the zone lookup as a headed CSV in landing, like the source's."""
    path = f"{layout.root}/landing/zone_lookup"
    zone_lookup_rows(spark, sf_dir).coalesce(1).write.mode("overwrite").option(
        "header", "true"
    ).csv(path)
    return path


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Dimension scan of the zone CSV (B8): header row, explicit string schema."""
    return spark.read.option("header", "true").schema(ZONE_CSV_SCHEMA).csv(path)
