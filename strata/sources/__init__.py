"""Scans and sources: the given tables, the landing zone and the zone CSV."""

from strata.sources.tables import (
    LANDING_COLUMNS,
    TABLES,
    glob_scan,
    read_zone_csv,
    stage_landing,
    stage_zone_csv,
    table,
    trip_records,
    zone_lookup_rows,
)

__all__ = [
    "LANDING_COLUMNS",
    "TABLES",
    "glob_scan",
    "read_zone_csv",
    "stage_landing",
    "stage_zone_csv",
    "table",
    "trip_records",
    "zone_lookup_rows",
]
