"""Keyed upsert on a dimension: only the partitions whose key range meets the changes are rewritten.

The table is partitioned by ranges of its key (:func:`key_range`).  The ranges of the changes, a list no longer
than the table's, say which partitions are read and replaced, in one commit; all others
keep their files, name for name.  Facts have no row key and are not upserted.

Where a table has more ranges than ``FOLDERS``, a partition holds several neighbouring ones, so that the number of
folders does not grow with the table.  Every row carries the version its own range was written
by (``WRITTEN``): rows of ranges that no change meets keep it when their partition is rewritten.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.cdc import DELETE
from strata.operators.dims import assert_unique
from strata.operators.history import VersionedTable

RANGE = "key_range"
#: Column of a keyed table: the version that last wrote the row's range.
WRITTEN = "_written_by"
#: Partitions of a new keyed table, about, at most.
FOLDERS = 256


def key_range(key: str, width: int) -> Column:
    """The range of ``width`` whole numbers that a key lies in (negative keys too)."""
    return F.expr(f"floor(`{key}` / {width}D)").cast("bigint")


def create_keyed(spark: SparkSession, root: str, rows: DataFrame, key: str, width: int, *, batch_id: str | None = None, committed_at: dt.datetime | None = None) -> VersionedTable:
    """A versioned table of ``rows``, unique by ``key``, partitioned by key range."""
    if rows.where(F.col(key).isNull()).limit(1).count():
        raise ValueError(f"rows without {key}")
    assert_unique(rows, key)
    n = rows.select(key_range(key, width)).distinct().count()
    wide = width * max(1, math.ceil(n / FOLDERS))
    schema = T.StructType([*rows.schema.fields, T.StructField(WRITTEN, T.IntegerType()), T.StructField(RANGE, T.LongType(), metadata={"width": wide})])
    table = VersionedTable.create(spark, root, schema, [RANGE], committed_at=committed_at)
    placed = rows.withColumns({WRITTEN: F.lit(table.next_version()).cast("int"), RANGE: key_range(key, wide)})
    table.replace_partitions(_spread(placed, min(n, FOLDERS)), batch_id=batch_id, committed_at=committed_at)
    return table


def _spread(rows: DataFrame, folders: int) -> DataFrame:
    """A partition's rows in one task, the partitions over several: small ones cost their folder, not their bytes."""
    return rows.repartition(max(1, min(folders, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))), RANGE)


def upsert(table: VersionedTable, changes: DataFrame, key: str, width: int, op: str | None = None, *, batch_id: str | None = None, committed_at: dt.datetime | None = None) -> int:
    """Apply ``changes`` (one per key; ``op`` names a column that is ``delete`` for keys that go); returns the version.

    A changed row replaces the stored one whole, an unknown key is added, deleting an unknown key does nothing.  Changes
    without a key are refused.  No changes, no commit.
    """
    table.refresh()
    if changes.where(F.col(key).isNull()).limit(1).count():
        raise ValueError(f"changes without {key}")
    assert_unique(changes, key)
    wide = table.declared_schema()[RANGE].metadata["width"]
    placed = changes.withColumn(RANGE, key_range(key, wide))
    met = {r[RANGE] for r in placed.select(RANGE).distinct().collect()}  # partitions, not keys
    if not met:
        return table.current_version()
    version, v = table.current_version(), F.lit(table.next_version()).cast("int")
    stored = table.scan_pins([r for r in table.pin_rows(version) if r[RANGE] in met])
    columns = stored.columns
    own = key_range(key, width).alias("_own")  # the row's own range, one of several in its partition
    ranges = changes.select(own).distinct().withColumn("_met", F.lit(True))
    kept = stored.join(placed.select(key), key, "left_anti").select(*columns, own).join(ranges, "_own", "left")
    kept = kept.withColumn(WRITTEN, F.when(F.col("_met"), v).otherwise(F.col(WRITTEN)))
    gone = F.lit(False) if op is None else F.coalesce(F.col(op) == DELETE, F.lit(False))
    rows = kept.select(*columns).unionByName(placed.where(~gone).withColumn(WRITTEN, v).select(*columns))
    return table.write(_spread(rows, len(met)), "replace", batch_id=batch_id, committed_at=committed_at, scope=[(r,) for r in sorted(met)], parent=version)
