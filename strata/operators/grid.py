"""Demand on a grid instead of by zone.

A trip carries every cell of its zone, each with weight ``1 / n_cells``, so
the weights of one trip sum to 1 and grid totals reconcile to trip counts.
Trips are **pre-aggregated per zone** before they meet the bridge table: the
many-to-many expansion then multiplies zone rows (thousands), never trip
rows, and a hot zone costs one row like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import exact_sum
from strata.operators.dims import join_hint


def zone_demand(trips: DataFrame, keys: list[str], zone: str = "pu_location_id") -> DataFrame:
    """Trips and revenue per zone (and extra keys): the only row-level pass."""
    return trips.groupBy(zone, *keys).agg(
        F.count(F.lit(1)).alias("trips"),
        exact_sum("fare_amount").alias("revenue"),
    )


def apportion(zone_rows: DataFrame, bridge: DataFrame, zone: str = "pu_location_id") -> DataFrame:
    """Spread per-zone rows over the zone's cells with weight ``1 / n_cells``.

    Zones without a cell keep a NULL cell so nothing is silently lost.
    """
    n = bridge.groupBy("location_id").agg(F.count(F.lit(1)).alias("n_cells"))
    b = bridge.join(n, "location_id").withColumnRenamed("location_id", zone)
    out = zone_rows.join(join_hint(b), zone, "left")
    return out.withColumn("weight", F.when(F.col("n_cells").isNull(), F.lit(1.0)).otherwise(1.0 / F.col("n_cells")))


def grid_demand(trips: DataFrame, bridge: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Weighted trips per cell (G12): ``cell_id, <keys>, demand``."""
    keys = keys or []
    z = apportion(zone_demand(trips, keys), bridge)
    return z.groupBy("cell_id", *keys).agg(
        F.round(F.sum(F.col("trips") * F.col("weight")), 6).alias("demand")
    )


def grid_demand_from_daily(daily: DataFrame, bridge: DataFrame) -> DataFrame:
    """G12 rolled up from gold ``zone_daily`` (trip counts per zone) instead of silver."""
    z = apportion(daily.groupBy("pu_location_id").agg(F.sum("trips").alias("trips")), bridge)
    return z.groupBy("cell_id").agg(F.round(F.sum(F.col("trips") * F.col("weight")), 6).alias("demand"))


def cells_without_zone_trips(bridge: DataFrame, dim: DataFrame) -> DataFrame:
    """Zones of the dimension that have no cell (reported, not dropped)."""
    return dim.join(bridge.select("location_id").distinct(), "location_id", "left_anti")


def grid_join(cell_demand: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join two gridded datasets on the shared cell key (and time bucket)."""
    return cell_demand.join(other, ["cell_id", *keys], "inner")
