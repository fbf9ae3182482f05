"""Column-expression helpers (N1-N8).  All built-in, all JVM-side.

Nothing here is a UDF (N9): every helper returns a ``Column`` that Catalyst
can push down, fold and compile into whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def string_tail(path: str | Column, sep: str = "/") -> Column:
    """Last segment of a path (N3): ``substring_index(x, sep, -1)``."""
    return F.substring_index(_c(path), sep, -1)


def path_segment(path: str | Column, index: int, sep: str = "/") -> Column:
    """Segment ``index`` of a path, negative from the end (N3, ``element_at(split)``)."""
    return F.element_at(F.split(_c(path), sep), index)


def exact_sum(x: str | Column) -> Column:
    """Sum of a money column without float drift: decimal(18,4) then double."""
    return F.sum(_c(x).cast("decimal(18,4)")).cast("double")


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` that is NULL, not an error, when ``den`` is 0 (ANSI mode)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def conform_name(x: str | Column) -> Column:
    """One spelling for names (N7): trimmed, lower-cased, each word capitalised."""
    return F.initcap(F.lower(F.trim(_c(x))))


def conform_code(x: str | Column) -> Column:
    """One spelling for codes and flags (N7): trimmed, upper-case, empty -> NULL."""
    return F.nullif(F.upper(F.trim(_c(x))), F.lit(""))


def event_date(ts: str | Column) -> Column:
    """Calendar date of a timestamp (no time-zone shift for timestamp_ntz)."""
    return F.to_date(_c(ts))


def month_start(ts: str | Column) -> Column:
    """First day of the timestamp's month as a DATE (avoids date_trunc's type change)."""
    return F.trunc(F.to_date(_c(ts)), "month")


def hour_of(ts: str | Column) -> Column:
    """Hour of day 0-23."""
    return F.hour(_c(ts))


def weekday_of(ts: str | Column) -> Column:
    """Day of week, Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts))


def is_weekend(ts: str | Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(_c(ts)) >= 5


def period_label(year: str | Column, month: str | Column) -> Column:
    """``YYYY-MM`` label for a (year, month) pair."""
    return F.format_string("%04d-%02d", _c(year), _c(month))


__all__ = [
    "conform_code",
    "conform_name",
    "event_date",
    "exact_sum",
    "hour_of",
    "is_weekend",
    "month_start",
    "path_segment",
    "period_label",
    "safe_ratio",
    "string_tail",
    "weekday_of",
]
