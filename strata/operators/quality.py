"""Quality rules as data, split into kept and quarantined rows (Q1-Q8).

A rule is a code, a description and a ``Column`` predicate that is TRUE for a
bad row.  Rules are pure expressions -- unit-testable on a hand-made frame and
independent of any Spark state.  A predicate that evaluates to NULL does *not*
reject: NULL is a legitimate business value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASONS = "_reject_reasons"


@dataclass(frozen=True)
class Rule:
    code: str
    description: str
    predicate: Column


def negative_amount(*money: str) -> Rule:
    """Q1: any money column below zero."""
    cols = money or ("fare_amount", "tip_amount", "balance_amount")
    pred = F.lit(False)
    for c in cols:
        pred = pred | (F.col(c) < 0)
    return Rule("negative_amount", "a money amount is negative", pred)


def zero_distance_with_fare(distance: str = "trip_distance", fare: str = "fare_amount") -> Rule:
    """Q2: no distance travelled, yet a fare was charged."""
    return Rule("zero_distance_with_fare", "zero distance with a fare", (F.col(distance) == 0) & (F.col(fare) > 0))


def dropoff_before_pickup(pickup: str = "pickup_at", dropoff: str = "dropoff_at") -> Rule:
    """Q3: the trip ends before it starts."""
    return Rule("dropoff_before_pickup", "dropoff before pickup", F.col(dropoff) < F.col(pickup))


def outside_period(
    event: str = "pickup_at", year: str = "year", month: str = "month", tolerance_months: int = 0
) -> Rule:
    """Q4: event time outside its file's month.

    ``tolerance_months >= 1`` lets events up to that many months *before* the
    file's month pass (late data, re-mapped by event time in silver); events
    after the file's month are always rejected.
    """
    start = F.make_date(F.col(year), F.col(month), F.lit(1))
    day = F.to_date(F.col(event))
    bad = (day < F.add_months(start, -tolerance_months)) | (day >= F.add_months(start, 1))
    return Rule("outside_period", "event outside the file's period", bad)


def default_rules(tolerance_months: int = 0, event: str = "pickup_at") -> list[Rule]:
    return [
        negative_amount(),
        zero_distance_with_fare(),
        dropoff_before_pickup(),
        outside_period(event, "src_year", "src_month", tolerance_months),
    ]


def reject_reasons(rules: Sequence[Rule]) -> Column:
    """``array<string>`` of the codes of every rule the row fails (empty when clean)."""
    flagged = F.array(*[F.when(r.predicate, F.lit(r.code)) for r in rules])
    return F.filter(flagged, lambda x: x.isNotNull())


def classify(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_reject_reasons`` in one projection."""
    return df.withColumn(REASONS, reject_reasons(rules))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected); kept + rejected = input, row for row (Q6)."""
    c = classify(df, rules)
    bad = F.size(F.col(REASONS)) > 0
    return c.where(~bad).drop(REASONS), c.where(bad)


def observed(df: DataFrame, name: str = "quality", counted: Column | None = None) -> tuple[DataFrame, Observation]:
    """Count rows and rejects while the frame is written: no second pass (Q7).

    ``df`` must carry ``_reject_reasons``; ``counted`` restricts the counts, not the
    rows.  Read ``obs.get`` after the action.
    """
    counted = F.lit(True) if counted is None else counted
    obs = Observation(name)
    out = df.observe(
        obs,
        F.count_if(counted).alias("rows"),
        F.count_if(counted & (F.size(F.col(REASONS)) > 0)).alias("rejected"),
    )
    return out, obs


class RejectRateExceeded(Exception):
    """The reject fraction is above the agreed threshold (Q8)."""


def check_reject_rate(rows: int, rejected: int, threshold: float) -> float:
    """Raise when ``rejected / rows`` exceeds ``threshold``; returns the rate."""
    rate = (rejected / rows) if rows else 0.0
    if rate > threshold:
        raise RejectRateExceeded(f"reject rate {rate:.4f} above threshold {threshold:.4f}")
    return rate
