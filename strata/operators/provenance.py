"""Provenance enrichment for bronze.

``enrich`` is a pure function of its input: it adds where a row came from and
where it goes, and reshapes nothing.  Partition values come from the reload
unit's *path*, never from a timestamp in the row, so a March file holding a
trip dated 2009 still lands under March.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.layout import COL_BATCH_ID, COL_INGESTED_AT, COL_SOURCE_FILE, unit_month, unit_year


def enrich(df: DataFrame, batch_id: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Add ``_source_file, _ingested_at, _batch_id, year, month``.

    With ``year``/``month`` given the unit is known (one reload unit read on
    its own).  Without them, they are extracted per file from
    ``_metadata.file_path``, which lets one job land many units at once.
    ``_ingested_at`` is ``current_timestamp()``: constant within one query.
    """
    path = F.col("_metadata.file_path")
    return df.withColumns(
        {
            COL_SOURCE_FILE: path,
            COL_INGESTED_AT: F.current_timestamp(),
            COL_BATCH_ID: F.lit(batch_id),
            "year": F.lit(year).cast("int") if year is not None else unit_year(path),
            "month": F.lit(month).cast("int") if month is not None else unit_month(path),
        }
    )
