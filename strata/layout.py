"""Where each layer lives, and how reload units are named.

There is no global root: a ``Layout`` is built per run from a root folder that
the caller owns (normally a sub-folder of the cluster's shared checkpoint dir,
see :func:`strata.session.shared_dir`).  One dataset per source.

The landing zone holds one *reload unit* per period.  The folder name is the
contract for (year, month): ``<source>/period=YYYY-MM/part-*.parquet``.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_dir

# The provenance and partition column names added by bronze.
COL_SOURCE_FILE = "_source_file"
COL_INGESTED_AT = "_ingested_at"
COL_BATCH_ID = "_batch_id"
PARTITION_COLS = ("year", "month")

# Fixed value: the reload-unit naming pattern (year and month groups).
UNIT_PATTERN = r"period=(\d{4})-(\d{2})"


@dataclass(frozen=True)
class Layout:
    """Paths of every stored layer under one root, for one source."""

    root: str
    source: str = "trips"

    @property
    def landing(self) -> str:
        return f"{self.root}/landing/{self.source}"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/{self.source}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/{self.source}"

    @property
    def dim_zone(self) -> str:
        return f"{self.root}/silver/dim_zone"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def unit_path(self, year: int, month: int) -> str:
        """Path of one reload unit (A4)."""
        return f"{self.landing}/period={year:04d}-{month:02d}"

    @staticmethod
    def fresh(spark: SparkSession, name: str) -> Layout:
        """A new, empty layout under the shared folder (one per run)."""
        return Layout(f"{shared_dir(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}")


def unit_year(path: Column) -> Column:
    """Year of the reload unit named in a file path."""
    return F.regexp_extract(path, UNIT_PATTERN, 1).cast("int")


def unit_month(path: Column) -> Column:
    """Month of the reload unit named in a file path."""
    return F.regexp_extract(path, UNIT_PATTERN, 2).cast("int")


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """One row per file under ``path``: ``path, length, modificationTime``.

    Uses the ``binaryFile`` source with only metadata columns selected, so no
    file content is read; listing works the same on HDFS and object stores.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def source_units(spark: SparkSession, layout: Layout) -> DataFrame:
    """Files and bytes of each landed unit (A5): ``year, month, unit, files, bytes``.

    Landing folders named otherwise are an error, as in :func:`available_months`.
    """
    available_months(spark, layout)
    files = list_files(spark, layout.landing)
    return (
        files.withColumn("year", unit_year(F.col("path")))
        .withColumn("month", unit_month(F.col("path")))
        .where(F.col("year").isNotNull())
        .groupBy("year", "month")
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
        )
        .withColumn("unit", F.format_string("period=%04d-%02d", "year", "month"))
    )


def available_months(spark: SparkSession, layout: Layout) -> list[tuple[int, int]]:
    """The landed units in order of time (A5), from one listing of the landing root.

    A folder that is not named like a unit is a delivery nobody would ever read:
    all such names are reported in one error.  Names that start with ``_`` or ``.``
    are Spark's own and no deliveries.
    """
    from strata.operators.history import list_subdirs

    names = {n: re.fullmatch(UNIT_PATTERN, n) for n in list_subdirs(spark, layout.landing) if n[0] not in "_."}
    if strange := sorted(n for n, m in names.items() if m is None):
        raise ValueError(f"not named like a reload unit (period=YYYY-MM) in {layout.landing}: {strange}")
    return sorted((int(m[1]), int(m[2])) for m in names.values())
