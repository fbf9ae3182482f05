"""Zone dimension: build once, join once, in silver.

The dimension is small by nature (one row per location id), but its size is
still *checked* before it is broadcast: above ``BROADCAST_ROW_LIMIT`` rows the
join falls back to sort-merge instead of shipping a growing table to every
executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import conform_name

BROADCAST_ROW_LIMIT = 2_000_000

# Fixed values of the synthetic zone -> grid-cell rule (a stand-in for the
# polygon polyfill): a zone covers ``location_id % CELL_SPREAD + 1`` cells,
# numbered ``(location_id % CELL_GROUPS) * 10 + k``; zones in the same group
# share cells.
CELL_SPREAD = 3
CELL_GROUPS = 7


class DimensionKeyError(Exception):
    """The dimension key is not unique: an enrich join would multiply rows."""


def conform_zones(zone_csv: DataFrame) -> DataFrame:
    """CSV strings -> typed, conformed columns: location_id, zone_name, borough."""
    return zone_csv.select(
        F.col("location_id").try_cast("bigint").alias("location_id"),
        conform_name("zone_name").alias("zone_name"),
        conform_name("borough").alias("borough"),
    )


def zone_cells(zones: DataFrame) -> DataFrame:
    """Bridge table ``location_id, cell_id`` (many-to-many)."""
    k = F.explode(F.sequence(F.lit(0).cast("bigint"), F.pmod("location_id", F.lit(CELL_SPREAD))))
    return zones.select("location_id", k.alias("k")).select(
        "location_id", (F.pmod("location_id", F.lit(CELL_GROUPS)) * 10 + F.col("k")).alias("cell_id")
    )


def build_dim_zone(zones: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """One row per location id: zone, borough, sorted cell set, cell count."""
    bridge = zone_cells(zones) if bridge is None else bridge
    cells = bridge.groupBy("location_id").agg(F.sort_array(F.collect_set("cell_id")).alias("cells"))
    return zones.join(cells, "location_id", "left").withColumn(
        "n_cells", F.when(F.col("cells").isNull(), 0).otherwise(F.size("cells")).cast("int")
    )


def store_dim_zone(dim: DataFrame, path: str) -> DataFrame:
    """Store the dimension, replacing it whole (type 1), and return the stored table.

    The key is asserted unique first; silver then joins the stored copy, so every
    silver run of a batch sees the same dimension.
    """
    assert_unique(dim, "location_id")
    dim.write.mode("overwrite").parquet(path)
    return dim.sparkSession.read.parquet(path)


def assert_unique(dim: DataFrame, key: str | list[str]) -> None:
    """Fail before any enrich join if the key repeats (one small job)."""
    keys = [key] if isinstance(key, str) else key
    dup = dim.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DimensionKeyError(f"duplicate dimension key {keys}: {dup[0]}")


def broadcast_fits(dim: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> bool:
    return dim.count() <= limit


def join_hint(dim: DataFrame, strategy: str = "auto", limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Return the dimension with a join hint (F2).

    ``auto``: broadcast when the counted size is under ``limit`` rows, else
    sort-merge.  ``broadcast`` / ``merge`` force a plan for comparison.
    """
    if strategy == "broadcast":
        return F.broadcast(dim)
    if strategy == "merge":
        return dim.hint("merge")
    if strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy}")
    return F.broadcast(dim) if broadcast_fits(dim, limit) else dim.hint("merge")


def enrich_zones(
    trips: DataFrame, dim: DataFrame, *, key: str = "pu_location_id", prefix: str = "pu_",
    strategy: str = "auto",
) -> DataFrame:
    """Left join: every trip survives, unknown ids get NULL zone (F1).

    Call once per role (pickup, dropoff) with a different ``key``/``prefix``.
    """
    d = dim.select(
        F.col("location_id").alias(key),
        F.col("zone_name").alias(f"{prefix}zone"),
        F.col("borough").alias(f"{prefix}borough"),
    )
    return trips.join(join_hint(d, strategy), key, "left")
