"""Clustering by several columns at once: rows in the order of their interleaved bits.

A sort by (a, b) lets a filter on a skip files, but not one on b.  Here each column is cut into 2^bits
ranges of about equal numbers of rows, the bits of the range numbers are dealt out in turn, and rows
are laid out in ranges of that number: files are small in every column, so that the minima and maxima
in Parquet footers let filters on any of them skip files.  Built-in functions only; the cuts decide the layout,
never the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6


def range_number(value: Column, cuts: Sequence, bits: int = BITS) -> Column:
    """How many of the ascending ``cuts`` a value exceeds, by halving: ``bits`` comparisons; NULL counts as least."""
    def below(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value > F.lit(cuts[mid]), below(mid + 1, hi)).otherwise(below(lo, mid))

    return below(0, len(cuts)).cast("long")


def interleave(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """One number from the bits of several, the highest bits first, columns in turn."""
    out, n = F.lit(0).cast("long"), len(numbers)
    for i in range(bits):
        for j, c in enumerate(numbers):
            bit = F.shiftright(c, i).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, i * n + (n - 1 - j)))
    return out


def cuts_of(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list]:
    """For each column up to 2^bits - 1 ascending values that cut its rows into about equal parts (one pass)."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(row[f"q{i}"] or [])) for i in range(len(columns))]


def cluster_by(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """``df`` dealt to ``files`` tasks in the order of the interleaved bits, sorted by it within each."""
    if not 1 <= bits * len(columns) <= 63:
        raise ValueError("bits of all columns must fit 63")
    numbers = [range_number(F.col(f"`{c}`"), cuts, bits) for c, cuts in zip(columns, cuts_of(df, columns, bits))]
    taken = {c.lower() for c in df.columns}
    name = next(n for n in (f"z{i}" for i in range(len(taken) + 1)) if n not in taken)
    ordered = df.withColumn(name, interleave(numbers, bits))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])  # rows of one cell may be cut anywhere
    return ordered.repartitionByRange(files, name, spread).sortWithinPartitions(name).drop(name)


def files_met(table: DataFrame, column: str, low, high) -> tuple[int, int]:
    """(files whose minimum and maximum of ``column`` meet [low, high], all files)."""
    spans = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    met = F.count_if((F.col("hi") >= F.lit(low)) & (F.col("lo") <= F.lit(high)))
    return tuple(spans.agg(met.alias("met"), F.count(F.lit(1)).alias("files")).first())
