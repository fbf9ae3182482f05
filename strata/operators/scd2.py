"""Dimension history: validity intervals from changes, and as-of joins (SCD type 2).

A change says what a key's attributes are from a moment on (``effective``), and when that became
known (``recorded``).  For one key and moment the change recorded last holds, whatever order
changes arrive in.  A history row is valid from its moment up to, and not including, the next one of
its key; moments that change no attribute make no row of their own.

Histories are kept as the surviving changes (:func:`merge_changes`), so that a late or corrected
change only rewrites its key's intervals: state after some batches is the same in any order of batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM, VALID_TO = "valid_from", "valid_to"
STEPS = {"week": "interval 7 days", "month": "interval 1 month", "quarter": "interval 3 months", "year": "interval 1 year"}


def merge_changes(known: DataFrame, batch: DataFrame, keys: Sequence[str], effective: str = "effective", recorded: str = "recorded") -> DataFrame:
    """Known changes and a batch of further ones: of each key and moment, the one recorded last.

    Equal records are one; of several recorded at the same time the greatest by its attributes holds, so that
    the result does not depend on order.  Combines in tasks before it shuffles.
    """
    cols = known.columns
    attributes = [c for c in cols if c not in (*keys, effective, recorded)]
    last = F.max(F.struct(recorded, *attributes)).alias("last")
    both = known.unionByName(batch.select(*cols))
    both = both.where(F.col(effective).isNotNull()).groupBy(*keys, effective).agg(last)
    return both.select(*[F.col(c) if c in (*keys, effective) else F.col("last")[c].alias(c) for c in cols])


def intervals(changes: DataFrame, keys: Sequence[str], effective: str = "effective", recorded: str = "recorded") -> DataFrame:
    """History rows: keys, attributes, ``valid_from``, ``valid_to`` (NULL: still valid), ``is_current``.

    ``changes`` hold one per key and moment, as :func:`merge_changes` leaves them.  Runs of moments with equal
    attributes become one interval.
    """
    attributes = [c for c in changes.columns if c not in (*keys, effective, recorded)]
    of_key = Window.partitionBy(*keys).orderBy(effective)
    state = F.struct(*attributes)
    news = changes.withColumn("_before", F.lag(state).over(of_key)).where(~state.eqNullSafe(F.col("_before")))
    upto = F.lead(effective).over(of_key)
    return news.select(*keys, *attributes, F.col(effective).alias(VALID_FROM), upto.alias(VALID_TO), upto.isNull().alias("is_current"))


def overlaps(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Neighbouring intervals of a key that overlap, are empty, or leave a gap (must be none for a built history)."""
    of_key = Window.partitionBy(*keys).orderBy(VALID_FROM)
    following = F.lead(VALID_FROM).over(of_key)
    wrong = (F.col(VALID_TO) <= F.col(VALID_FROM)) | ~F.col(VALID_TO).eqNullSafe(F.col("_next"))
    return history.withColumn("_next", following).where(wrong).drop("_next")


def valid_at(at: Column | str) -> Column:
    """Whether a history row is valid at a moment."""
    at = F.col(at) if isinstance(at, str) else at
    return (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (at < F.col(VALID_TO)))


def as_of_join(facts: DataFrame, history: DataFrame, on: Sequence[tuple[str, str]], at: str, prefix: str = "", step: str = "month") -> DataFrame:
    """Every fact with the attributes valid at its time ``at``; NULLs where none was.

    ``on`` pairs columns of facts and history.  The join is on the key **and** the time step (``step``: week,
    month, quarter or year): an interval stands once in every step that it meets and that facts fall
    in, so a fact meets the versions of its key within one step only, however long the key's history is.
    No task sees all pairs of a key, and there is no cross join.
    """
    taken = {c.lower() for c in facts.columns}
    attributes = [c for c in history.columns if c not in (VALID_FROM, VALID_TO, "is_current", *[h for _, h in on])]
    clash = sorted(f"{prefix}{c}" for c in attributes if f"{prefix}{c}".lower() in taken)
    if clash:
        raise ValueError(f"facts already have columns {clash}: choose another prefix")
    start = lambda c: F.trunc(F.to_date(c), step)
    first, last = facts.agg(F.min(start(at)), F.max(start(at))).first()  # the steps facts fall in
    right = history.select(*[F.col(h).alias(f"_k{i}") for i, (_, h) in enumerate(on)], VALID_FROM, VALID_TO, *[F.col(c).alias(f"_a{i}") for i, c in enumerate(attributes)])
    day = lambda v: F.lit(v).cast("date")
    low = F.greatest(start(VALID_FROM), day(first))
    high = F.least(F.coalesce(start(VALID_TO), day(last)), day(last))
    steps = F.when(low <= high, F.sequence(low, high, F.expr(STEPS[step])))
    right = right.withColumn("_step", F.explode(steps))
    left = facts.withColumn("_step", start(at))
    meets = left["_step"] == right["_step"]
    for i, (f, _) in enumerate(on):
        meets = meets & (left[f] == right[f"_k{i}"])
    time = left[at]
    meets = meets & (right[VALID_FROM] <= time) & (right[VALID_TO].isNull() | (time < right[VALID_TO]))
    joined = left.join(right, meets, "left")
    return joined.select(*[left[c] for c in facts.columns], *[right[f"_a{i}"].alias(f"{prefix}{c}") for i, c in enumerate(attributes)])
