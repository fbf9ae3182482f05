"""Bronze: land reload units faithfully, idempotently, atomically.

``run_bronze`` is the unit of work: discover units -> check the footer of every
file of every unit against the contract (on driver threads, before anything is
written) -> one scan over all accepted units -> enrich -> one ``replace``
commit.  The whole run is one pass over the data (plus a footer-only count
of what was written) and one atomic commit, so landing 1,000 months costs one
write job, not 1,000.  Rows are never filtered, renamed or retyped here.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.layout import PARTITION_COLS, Layout, available_months
from strata.operators.contract import TRIP_CONTRACT, Finding, contract_schema, file_schema, findings, parquet_files, settle
from strata.operators.history import VersionedTable
from strata.operators.nullability import as_findings, null_changes
from strata.operators.provenance import enrich
from strata.session import job_description, unsorted_write


def bronze_schema(landing_schema: T.StructType) -> T.StructType:
    """Landing columns + provenance + partition columns (the declared table shape)."""
    return T.StructType(
        list(landing_schema.fields)
        + [
            T.StructField("_source_file", T.StringType()),
            T.StructField("_ingested_at", T.TimestampType()),
            T.StructField("_batch_id", T.StringType()),
            T.StructField("year", T.IntegerType()),
            T.StructField("month", T.IntegerType()),
        ]
    )


def check_units(
    spark: SparkSession, layout: Layout, months: list[tuple[int, int]],
    expected: dict[str, str] = TRIP_CONTRACT,
) -> list[Finding]:
    """Check every file of every unit against the contract; raises on any that is refused.

    Spark reads one footer of a folder, which would let a unit with one bad file
    pass; here each file's footer is read, on a pool of driver threads and before
    anything is written.  Returns the accepted findings (added columns, logged).
    """
    def one(unit_file: tuple[str, str]) -> list[Finding]:
        unit, path = unit_file
        return list(findings(file_schema(spark, path), expected, f"{unit}/{path.rsplit('/', 1)[-1]}"))

    units = [layout.unit_path(*ym) for ym in months]
    with ThreadPoolExecutor(max_workers=max(1, min(32, len(units)))) as pool:
        files = [(u.rsplit("/", 1)[-1], f) for u, fs in zip(units, pool.map(lambda u: parquet_files(spark, u), units)) for f in fs]
        return settle(f for found in pool.map(one, files) for f in found)


def read_units(spark: SparkSession, layout: Layout, months: list[tuple[int, int]], merge: bool) -> DataFrame:
    """One scan over the given units; ``merge`` unions additive columns by name."""
    paths = [layout.unit_path(y, m) for y, m in months]
    reader = spark.read.option("mergeSchema", "true") if merge else spark.read
    return reader.parquet(*paths)


def ensure_bronze_table(
    spark: SparkSession, layout: Layout, *, committed_at: dt.datetime | None = None,
    expected: dict[str, str] = TRIP_CONTRACT,
) -> VersionedTable:
    """Open bronze, or declare it (empty version 1) from the contract (C4)."""
    if VersionedTable.exists(spark, layout.bronze):
        return VersionedTable(spark, layout.bronze)
    landing = contract_schema(expected)
    return VersionedTable.create(
        spark, layout.bronze, bronze_schema(landing), PARTITION_COLS, committed_at=committed_at
    )


def run_bronze(
    spark: SparkSession,
    layout: Layout,
    batch_id: str,
    *,
    months: list[tuple[int, int]] | None = None,
    committed_at: dt.datetime | None = None,
    expected: dict[str, str] = TRIP_CONTRACT,
) -> int:
    """Land every discovered unit (or ``months``) as one commit; returns the version.

    Re-running replaces exactly the partitions of the units read, so a rerun
    never changes the row count (idempotent); only the last batch id survives.
    """
    months = months if months is not None else available_months(spark, layout)
    if not months:
        raise ValueError("no reload unit found in landing")
    # declaring the (empty) table, checking footers and comparing NULLs with the delivery
    # before (E6) are metadata work: run them side by side; no data is written before every unit passed
    with ThreadPoolExecutor(max_workers=2) as pool:
        opened = pool.submit(ensure_bronze_table, spark, layout, committed_at=committed_at, expected=expected)
        nulls = pool.submit(null_changes, spark, layout, months, expected)
        try:
            added = check_units(spark, layout, months, expected)
        finally:
            table = opened.result()
        settle(as_findings(nulls.result()))
    raw = read_units(spark, layout, months, merge=bool(added))
    with job_description(spark, f"land {len(months)} unit(s) as {batch_id}"):
        return table.replace_partitions(enrich(raw, batch_id), batch_id=batch_id, committed_at=committed_at)


def land_month(
    spark: SparkSession, layout: Layout, year: int, month: int, batch_id: str,
    *, committed_at: dt.datetime | None = None,
) -> int:
    """One reload unit: read -> check -> enrich -> commit (Q14)."""
    return run_bronze(spark, layout, batch_id, months=[(year, month)], committed_at=committed_at)


# --------------------------------------------------------------------------
# Plain Parquet writes (the failure modes the versioned table avoids).

def enriched_landing(spark: SparkSession, layout: Layout, batch_id: str) -> DataFrame:
    months = available_months(spark, layout)
    check_units(spark, layout, months)
    return enrich(read_units(spark, layout, months, merge=False), batch_id)


def write_plain(
    df: DataFrame, path: str, mode: str, *, overwrite_mode: str = "dynamic",
    partition_cols: tuple[str, ...] = PARTITION_COLS, files_per_partition: int | None = None,
    coalesce_to: int | None = None, repartition_to: int | None = None,
) -> None:
    """Partitioned Parquet write.

    * ``mode="append"``: a rerun silently doubles the rows (C1).
    * ``mode="overwrite"`` with ``overwrite_mode="dynamic"``: only partitions
      present in ``df`` are replaced (C2) -- set on the writer, not trusted
      from the session.  ``"static"`` deletes the whole table first (C3).
    * ``files_per_partition``: hash-distribute by partition key (plus a
      deterministic salt) before writing, so each table partition gets that
      many files instead of one per input task (C7, C10).
    * ``coalesce_to``: merge input partitions without a shuffle (C8); cheaper,
      but can leave tasks uneven and lowers write parallelism.
    """
    if repartition_to:  # full shuffle into n tasks: up to n files per partition (C7)
        df = df.repartition(repartition_to)
    if coalesce_to:
        df = df.coalesce(coalesce_to)
    if files_per_partition:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        df = df.repartition(*partition_cols, salt)
    w = df.write.mode(mode).partitionBy(*partition_cols)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", overwrite_mode)
    with unsorted_write(df.sparkSession):
        w.parquet(path)


def create_namespace(spark: SparkSession, name: str) -> None:
    """``CREATE NAMESPACE IF NOT EXISTS`` in the session catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def read_plain(spark: SparkSession, path: str) -> DataFrame:
    """Hive-partitioned read: partition columns rebuilt from folder names."""
    return spark.read.parquet(path)
