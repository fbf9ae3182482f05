"""Faithfulness, traceability and run coherence checks (Q9-Q13).

Each check is one grouped aggregate per side -- never a Python loop over
months -- and returns a small DataFrame that a caller can assert on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import path_segment, string_tail
from strata.layout import COL_BATCH_ID, COL_INGESTED_AT, COL_SOURCE_FILE, unit_month, unit_year


def source_counts(landing: DataFrame) -> DataFrame:
    """Rows per reload unit of a landing scan, from the file path."""
    path = F.col("_metadata.file_path")
    return (
        landing.select(unit_year(path).alias("year"), unit_month(path).alias("month"))
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("source_rows"))
    )


def reconcile(landing: DataFrame, table: DataFrame) -> DataFrame:
    """Q9: source rows vs table rows per month (full outer join, so gaps show)."""
    t = table.groupBy("year", "month").agg(F.count(F.lit(1)).alias("table_rows"))
    j = source_counts(landing).join(t, ["year", "month"], "full_outer").fillna(0, ["source_rows", "table_rows"])
    return j.withColumn("matches", F.col("source_rows") == F.col("table_rows"))


def batch_profile(bronze: DataFrame) -> DataFrame:
    """Rows and distinct ingest times per month and batch."""
    return bronze.groupBy("year", "month", COL_BATCH_ID).agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(COL_INGESTED_AT).alias("distinct_ingested_at"),
    )


def trace(bronze: DataFrame) -> DataFrame:
    """Q11: rows per source unit, with the count of rows lacking a file or batch."""
    unit = path_segment(COL_SOURCE_FILE, -2)
    untraced = F.col(COL_SOURCE_FILE).isNull() | F.col(COL_BATCH_ID).isNull()
    return bronze.groupBy(unit.alias("source_unit")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(untraced).alias("untraced"),
    )


def rows_per_file(bronze: DataFrame) -> DataFrame:
    """Rows grouped by the last path segment (the file name)."""
    return bronze.groupBy(string_tail(COL_SOURCE_FILE).alias("source_file")).agg(
        F.count(F.lit(1)).alias("rows")
    )
