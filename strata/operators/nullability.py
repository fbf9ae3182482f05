"""NULLs of a delivery against the one before, from column statistics.

Spark marks every Parquet column nullable, so that a column which starts to hold NULLs is no
change of schema.  Parquet files carry a NULL count per column in their footers: Spark's
Parquet source answers ``count(column)`` grouped by folder from them alone
(aggregate pushdown), in tasks, whatever store the files are in.  Rows are read only of units
with a file that lacks the counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.layout import Layout, available_months
from strata.operators.contract import TRIP_CONTRACT, Finding, contract_schema
from strata.session import footer_session

#: Fixed value: what Spark says of a file whose footer holds no NULL counts.
NO_COUNTS = "Number of nulls not set"


class NullCount(NamedTuple):
    year: int
    month: int
    column: str
    rows: int
    nulls: int


def _counts(spark: SparkSession, layout: Layout, months: Sequence[tuple[int, int]], columns: Sequence[str], schema: T.StructType) -> DataFrame:
    """(period, rows, one count of values per column) of the given units."""
    units = T.StructType([schema[c] for c in columns] + [T.StructField("period", T.StringType())])
    df = spark.read.schema(units).option("basePath", layout.landing).parquet(*[layout.unit_path(*ym) for ym in months])
    return df.groupBy("period").agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"v{i}") for i, c in enumerate(columns)])


def footer_counts(spark: SparkSession, layout: Layout, months: Sequence[tuple[int, int]], columns: Sequence[str], schema: T.StructType) -> DataFrame:
    """:func:`_counts` in a session of its own, where the Parquet source answers from footers."""
    return _counts(footer_session(spark), layout, months, columns, schema)


def null_counts(spark: SparkSession, layout: Layout, months: Sequence[tuple[int, int]], contract: dict[str, str] = TRIP_CONTRACT) -> list[NullCount]:
    """NULLs of each contract column in each unit (one entry per unit and column).

    A job that meets a file without counts fails as a whole: its units are halved until the unit
    is found, and that one is read.
    """
    columns, schema = list(contract), contract_schema(contract)
    if not months:
        return []
    try:
        rows = footer_counts(spark, layout, months, columns, schema).collect()
    except (PySparkException, Py4JJavaError) as e:
        if NO_COUNTS not in str(e):
            raise
        if len(months) > 1:
            half = len(months) // 2
            return [n for part in (months[:half], months[half:]) for n in null_counts(spark, layout, part, contract)]
        rows = _counts(spark, layout, months, columns, schema).collect()
    return [NullCount(int(r.period[:4]), int(r.period[5:]), c, r.rows, r.rows - r[f"v{i}"]) for r in rows for i, c in enumerate(columns)]


class NullChange(NamedTuple):
    """A column whose NULLs came or went between a unit and the one before it."""

    year: int
    month: int
    column: str
    kind: str
    before: int
    nulls: int
    rows: int


def kind_of(before: NullCount, now: NullCount) -> str | None:
    """``turned null``: no value left; ``some null``: NULLs where none were; ``no null``: none where some were."""
    if now.nulls == now.rows > 0 and before.nulls < before.rows:
        return "turned null"
    if now.nulls and not before.nulls:
        return "some null"
    return "no null" if before.nulls and not now.nulls else None


def null_changes(spark: SparkSession, layout: Layout, months: Sequence[tuple[int, int]] | None = None, contract: dict[str, str] = TRIP_CONTRACT) -> list[NullChange]:
    """What changed in each of ``months`` (all landed ones by default) against the landed unit before it.

    The first unit has none before it.  Empty units change nothing and are passed over.
    """
    landed = available_months(spark, layout)
    asked = set(landed if months is None else months)
    needed = sorted(asked | {b for b, m in zip(landed, landed[1:]) if m in asked})
    counted: dict[tuple[int, int], dict[str, NullCount]] = {}
    for n in null_counts(spark, layout, needed, contract):
        if n.rows:
            counted.setdefault((n.year, n.month), {})[n.column] = n
    out, order = [], sorted(counted)
    for b, m in zip(order, order[1:]):
        if m in asked:
            for c in contract:
                before, now = counted[b][c], counted[m][c]
                if kind := kind_of(before, now):
                    out.append(NullChange(*m, c, kind, before.nulls, now.nulls, now.rows))
    return out


def as_findings(changes: Sequence[NullChange]) -> list[Finding]:
    """Changes as contract findings (``expected`` and ``actual``: NULLs before and now), to be settled by its policy."""
    return [Finding(f"period={c.year:04d}-{c.month:02d}", c.column, c.kind, f"{c.before} NULLs", f"{c.nulls} of {c.rows}") for c in changes]


def changes_frame(spark: SparkSession, changes: Sequence[NullChange]) -> DataFrame:
    """Changes as rows, a few per unit."""
    return spark.createDataFrame([tuple(c) for c in changes], "year int, month int, column string, kind string, before bigint, nulls bigint, rows bigint")
