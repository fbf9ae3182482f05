"""Applying a change feed (CDC): latest change per key, deletes kept as tombstones.

State holds, per key, the change with the highest sequence number seen so far, deletes included: a
late older change can then never bring a deleted row back.  Applying a batch keeps
the greater of the two per key, an aggregate that combines in tasks first, so that
a key with very many changes is no task of its own, and that gives the same state
for batches in any order, repeated or overlapping.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import shared_dir

DELETE = "delete"


def latest(changes: DataFrame, keys: Sequence[str], sequence: str, op: str = "op") -> DataFrame:
    """One change per key: the one with the highest sequence number.

    A NULL sequence number comes before all others.  Of several with one number a delete holds, then the
    greatest by its other columns: fixed, whatever the order.
    """
    rest = [c for c in changes.columns if c not in (*keys, sequence, op)]
    rank = F.when(F.col(op) == DELETE, 1).otherwise(0).alias("_delete")
    last = F.max(F.struct(F.col(sequence), rank, F.col(op), *rest)).alias("last")
    return changes.groupBy(*keys).agg(last).select(*[F.col(c) if c in keys else F.col("last")[c].alias(c) for c in changes.columns])


def apply_changes(state: DataFrame | None, batch: DataFrame, keys: Sequence[str], sequence: str, op: str = "op") -> DataFrame:
    """The state after a batch.  The batch is reduced before it meets the state."""
    news = latest(batch, keys, sequence, op)
    return news if state is None else latest(state.unionByName(news.select(*state.columns)), keys, sequence, op)


def current(state: DataFrame, op: str = "op") -> DataFrame:
    """Live rows: the state without its tombstones."""
    return state.where(F.col(op).isNull() | (F.col(op) != DELETE)).drop(op)


def apply_all(batches: Sequence[DataFrame], keys: Sequence[str], sequence: str, op: str = "op") -> DataFrame:
    """Batches applied one after the other, each state a written table in the shared folder."""
    spark, state = batches[0].sparkSession, None
    root = f"{shared_dir(spark)}/strata/cdc-{uuid.uuid4().hex[:12]}"
    for i, batch in enumerate(batches):
        path = f"{root}/state={i}"
        new = apply_changes(state, batch, keys, sequence, op)
        new.write.parquet(path)
        state = spark.read.schema(new.schema).parquet(path)
    return state


def compact_tombstones(state: DataFrame, sequence: str, before: int, op: str = "op") -> DataFrame:
    """State without tombstones older than ``before``: safe once no change with a lower number can still arrive."""
    return state.where(~((F.col(op) == DELETE) & (F.col(sequence) < before)) | F.col(op).isNull() | F.col(sequence).isNull())
