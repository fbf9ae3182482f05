"""Silver: conform, quarantine, enrich, and place rows by event time.

* Conform is a declarative mapping (target name -> SQL expression over the
  bronze columns), applied in one ``select``: one naming convention, one set of
  types, strings conformed, no UDF.
* Kept rows are partitioned by **event month** (first day of the event's
  month).  Rejects are partitioned by the **source** period they arrived in:
  the reject rate is a property of a delivery, not of event time.  Both are
  partitions of one dataset, written by one job and published by one commit: there is
  no moment at which one of them is new and the other old.
* Files have a size: a month gets as many as its expected rows fill, known from the
  lineage of the run before or else from bronze's row counts.  Rows are dealt over tasks
  before the write, and a task writes up to ``FILES_PER_TASK`` files one after the other: small
  files do not cost a task each.  Without tolerance a source month's rows stay in that month: where
  bronze holds it in no more files than its rows fill, they are written by the tasks that
  read them and nothing is dealt.
* Every run stores its lineage, (event month, source month, rows), read back from what it
  wrote.  A later run of a few source months reads only source months that hold rows of
  the event months it rebuilds, and those whose bronze has changed since.
* Late data: with ``tolerance_months = t`` an event may arrive up to ``t``
  months after its own month.  Reprocessing source months ``M`` therefore
  touches event months ``A = {m - k | m in M, 0 <= k <= t}``, and those are
  rebuilt from every bronze month that can hold them,
  ``S = {a + k | a in A, 0 <= k <= t}``, narrowed by the lineage where there is one.
  Both become literal partition paths on bronze.  No row key
  is needed and nothing is merged or de-duplicated.
* Each commit replaces an explicit partition scope, so an event month whose
  rows all vanished is emptied too.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections import Counter
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import conform_code, conform_name
from strata.layout import Layout
from strata.operators.dims import broadcast_fits, enrich_zones
from strata.operators.history import HistoryError, VersionedTable, path_exists
from strata.operators.quality import REASONS, Rule, check_reject_rate, classify, default_rules, observed

# Time zone the source writes its wall-clock timestamps in; silver holds UTC.
SOURCE_TIME_ZONE = "UTC"

# The conform mapping, target column -> SQL expression on bronze.
CONFORM: list[tuple[str, str]] = [
    ("trip_id", "l_orderkey"),
    ("line_no", "l_linenumber"),
    ("pickup_at", "convert_timezone('{tz}', 'UTC', o_orderdate)"),
    ("dropoff_at", "convert_timezone('{tz}', 'UTC', l_shipdate)"),
    ("pu_location_id", "l_suppkey"),
    ("passenger_count", "try_cast(l_quantity AS INT)"),
    ("trip_distance", "round(l_discount * 100 + 0.0, 2)"),
    ("fare_amount", "l_extendedprice"),
    ("tip_amount", "l_extendedprice * l_tax"),
    ("balance_amount", "c_acctbal"),
    ("return_flag", "l_returnflag"),
    ("status_code", "o_orderstatus"),
    ("priority_code", "try_cast(substring_index(o_orderpriority, '-', 1) AS INT)"),
    ("priority_name", "substr(o_orderpriority, instr(o_orderpriority, '-') + 1)"),
    ("_batch_id", "_batch_id"),
    ("src_year", "year"),
    ("src_month", "month"),
]
CODE_COLUMNS = ("return_flag", "status_code")
NAME_COLUMNS = ("priority_name",)


def conform(bronze: DataFrame, source_time_zone: str = SOURCE_TIME_ZONE) -> DataFrame:
    """One projection from bronze spelling to silver spelling, types and time zone.

    Source wall-clock times (``timestamp_ntz``) are converted to UTC wall-clock
    times, so silver has one time zone whatever the session's zone is.
    """
    out = bronze.select(*[F.expr(e.format(tz=source_time_zone)).alias(n) for n, e in CONFORM])
    return out.withColumns(
        {**{c: conform_code(c) for c in CODE_COLUMNS}, **{c: conform_name(c) for c in NAME_COLUMNS}}
    )


def fill_missing(df: DataFrame) -> DataFrame:
    """NULL handling (D10): a missing tip means none was recorded, 0; a missing passenger count is unknown and stays NULL."""
    return df.na.fill({"tip_amount": 0.0})


def missing_key() -> Rule:
    """A row without a trip id is rejected with a reason, never dropped uncounted."""
    return Rule("missing_key", "no trip id", F.col("trip_id").isNull())


def null_policy(df: DataFrame) -> DataFrame:
    """What the NULL handling keeps of ``df`` by itself: rows with a trip id and a pickup time, missing tips filled.

    A run rejects the others: as ``missing_key``, or as ``unplaceable_event`` without a time.
    """
    return fill_missing(df.where(~missing_key().predicate & F.col("pickup_at").isNotNull()))


def with_event_month(df: DataFrame, event: str) -> DataFrame:
    return df.withColumn("event_month", F.trunc(F.to_date(F.col(event)), "month"))


# ------------------------------------------------------------------ periods
def _month_index(y: int, m: int) -> int:
    return y * 12 + (m - 1)


def _from_index(i: int) -> tuple[int, int]:
    return i // 12, i % 12 + 1


def affected_periods(
    months: Sequence[tuple[int, int]], tolerance_months: int
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(event months to rebuild, source months to read) for reprocessing ``months`` (Q18)."""
    idx = {_month_index(y, m) for y, m in months}
    events = sorted({i - k for i in idx for k in range(tolerance_months + 1)})
    sources = sorted({e + k for e in events for k in range(tolerance_months + 1)})
    return [_from_index(i) for i in events], [_from_index(i) for i in sources]


def events_span(months: Sequence[tuple[int, int]]) -> int:
    """Number of calendar months from the first to the last of ``months``."""
    idx = [_month_index(y, m) for y, m in months]
    return max(idx) - min(idx) + 1 if idx else 0


# ------------------------------------------------------------------- tables
def silver_schema(dim_cols: bool = True) -> T.StructType:
    fields = [
        T.StructField("trip_id", T.LongType()),
        T.StructField("line_no", T.IntegerType()),
        T.StructField("pickup_at", T.TimestampNTZType()),
        T.StructField("dropoff_at", T.TimestampNTZType()),
        T.StructField("pu_location_id", T.LongType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("balance_amount", T.DoubleType()),
        T.StructField("return_flag", T.StringType()),
        T.StructField("status_code", T.StringType()),
        T.StructField("priority_code", T.IntegerType()),
        T.StructField("priority_name", T.StringType()),
        T.StructField("_batch_id", T.StringType()),
        T.StructField("src_year", T.IntegerType()),
        T.StructField("src_month", T.IntegerType()),
    ]
    if dim_cols:
        fields += [T.StructField("pu_zone", T.StringType()), T.StructField("pu_borough", T.StringType())]
    return T.StructType(fields + [T.StructField("event_month", T.DateType())])


def rejects_schema() -> T.StructType:
    base = [f for f in silver_schema(dim_cols=False).fields if f.name not in ("src_year", "src_month", "event_month")]
    return T.StructType(
        base
        + [
            T.StructField(REASONS, T.ArrayType(T.StringType())),
            T.StructField("src_year", T.IntegerType()),
            T.StructField("src_month", T.IntegerType()),
        ]
    )


#: Partition of a reject: the first day of its source month.  NULL for kept rows, whose partition is the event month.
REJECT_MONTH = "reject_month"
PARTS = ["event_month", REJECT_MONTH]


def stored_schema() -> T.StructType:
    """Kept rows and rejects as one dataset."""
    columns = [f for f in silver_schema().fields if f.name != "event_month"]
    added = [T.StructField(REASONS, T.ArrayType(T.StringType())), *[T.StructField(c, T.DateType()) for c in PARTS]]
    return T.StructType(columns + added)


def open_table(spark: SparkSession, root: str, committed_at: dt.datetime | None = None) -> VersionedTable:
    if VersionedTable.exists(spark, root):
        return VersionedTable(spark, root)
    return VersionedTable.create(spark, root, stored_schema(), PARTS, committed_at=committed_at)


# ------------------------------------------------------------------ lineage
LINEAGE = "event_month date, src_year int, src_month int, rows bigint, silver_version int, bronze_version int, setup string"


def _lineage_path(root: str) -> str:
    return f"{root}/lineage"


def _setup(rules: Sequence[Rule], tolerance_months: int, event: str) -> str:
    """What decides where a row goes; lineage of another setup says nothing about this one."""
    return f"{event}|{tolerance_months}|" + ",".join(r.code for r in rules)


def store_lineage(table: VersionedTable, version: int, bronze_version: int, setup: str) -> None:
    """Write which source months each event month of ``version`` was filled from, from the written files (two columns)."""
    spark = table.spark
    new = [r for r in table.pin_rows(version) if r.data_version == version and r[REJECT_MONTH] is None]
    counts = table.scan_pins(new).groupBy("event_month", "src_year", "src_month").agg(F.count(F.lit(1)).alias("rows"))
    stamped = counts.withColumns({"silver_version": F.lit(version).cast("int"), "bronze_version": F.lit(bronze_version).cast("int"), "setup": F.lit(setup)})
    stamped.coalesce(1).write.mode("append").parquet(_lineage_path(table.root))  # a row per pair of months


def lineage(table: VersionedTable, version: int | None = None) -> DataFrame:
    """The stored lineage of a version's live partitions (the current version by default)."""
    spark = table.spark
    version = table.current_version() if version is None else version
    pins = [(r.event_month, r.data_version) for r in table.pin_rows(version) if r[REJECT_MONTH] is None]
    if not pins or not path_exists(spark, _lineage_path(table.root)):
        return spark.createDataFrame([], LINEAGE)
    live = spark.createDataFrame(pins, "event_month date, silver_version int")  # a row per month
    stored = spark.read.schema(LINEAGE).parquet(_lineage_path(table.root))
    return stored.join(F.broadcast(live), ["event_month", "silver_version"], "left_semi").select(*[c.split()[0] for c in LINEAGE.split(", ")])


def kept_by_source(table: VersionedTable) -> DataFrame:
    """(src_year, src_month, kept): kept rows per source month, from lineage; from the rows if a run left none behind."""
    found = lineage(table)
    live = {r.event_month for r in table.pin_rows(table.current_version()) if r[REJECT_MONTH] is None}
    if live - {r.event_month for r in found.select("event_month").distinct().collect()}:  # months
        found = read_kept(table).groupBy("src_year", "src_month").agg(F.count(F.lit(1)).alias("rows"))
    return found.groupBy("src_year", "src_month").agg(F.sum("rows").alias("kept"))


def backfill_scopes(found: DataFrame, months: Sequence[tuple[int, int]], tolerance_months: int) -> DataFrame:
    """(year, month, src_year, src_month): the source months to read for each reloaded month, by lineage ``found``.

    A reloaded month is always read itself; its new rows may go to any event month within the
    tolerance.  Every pair of months meets by range, a few per event month.
    """
    spark = found.sparkSession
    asked = spark.createDataFrame([(y, m, y * 12 + m - 1) for y, m in months], "year int, month int, _i int")
    rebuilt = asked.select("year", "month", F.explode(F.sequence(F.col("_i") - tolerance_months, "_i")).alias("_e"))
    index = (F.year("event_month") * 12 + F.month("event_month") - 1).alias("_e")
    filled = found.where("rows > 0").select(index, "src_year", "src_month").distinct()
    itself = asked.select("year", "month", F.col("year").alias("src_year"), F.col("month").alias("src_month"))
    return rebuilt.join(filled, "_e").drop("_e").unionByName(itself).distinct()


def source_scope(
    table: VersionedTable, bronze: VersionedTable, bronze_version: int,
    months: Sequence[tuple[int, int]], tolerance_months: int, setup: str,
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(event months to rebuild, source months to read): the calendar's, narrowed by lineage (Q18).

    A source month is left out when the lineage of all event months it could have fed names no
    row of it, under the same setup, and its bronze partition is still the one that was read.
    """
    events, sources = affected_periods(months, tolerance_months)
    rows = [r for r in lineage(table).collect() if r.setup == setup]  # a row per pair of months
    if not rows:
        return events, sources
    live = {(r.event_month.year, r.event_month.month) for r in rows}
    holds = {((r.event_month.year, r.event_month.month), (r.src_year, r.src_month)) for r in rows if r.rows}
    read_at = {(r.event_month.year, r.event_month.month): r.bronze_version for r in rows}
    pins = lambda v: {((r.year, r.month), r.data_version) for r in bronze.pin_rows(v)}
    now = pins(bronze_version)
    changed = {v: {ym for ym, _ in now ^ pins(v)} for v in set(read_at.values())}

    def needed(s: tuple[int, int]) -> bool:
        feeds = [e for e in events if 0 <= _month_index(*s) - _month_index(*e) <= tolerance_months]
        return s in months or any(e not in live or (e, s) in holds or s in changed[read_at[e]] for e in feeds)

    return events, [s for s in sources if needed(s)]


def files_per_month(
    table: VersionedTable, pins: Sequence, tolerance_months: int, setup: str, rows_per_file: int,
) -> tuple[dict[dt.date, int], dict[dt.date, int]]:
    """How many tasks write an event month and a source month's rejects, where it is more than one.

    An event month's rows are those it had before; without lineage, an even share
    of each source month that can feed it.  Rejects are taken to be a share of
    their month below one file unless it alone holds more.
    """
    per_source: dict[int, int] = {}
    for r in pins:
        per_source[_month_index(r.year, r.month)] = per_source.get(_month_index(r.year, r.month), 0) + r.records
    expected: dict[int, float] = {}
    for i, n in per_source.items():
        for k in range(tolerance_months + 1):
            expected[i - k] = expected.get(i - k, 0) + n / (tolerance_months + 1)
    before: dict[int, int] = {}
    for r in lineage(table).where(F.col("setup") == setup).groupBy("event_month").agg(F.sum("rows").alias("rows")).collect():
        before[_month_index(r.event_month.year, r.event_month.month)] = r["rows"]
    day = lambda i: dt.date(*_from_index(i), 1)
    number = lambda n: tasks_of(n, rows_per_file)
    kept = {day(i): number(n) for i, n in (expected | before).items() if number(n) > 1}
    return kept, {day(i): number(n) for i, n in per_source.items() if number(n) > 1}


#: Files that a task writes of a partition, at most, before another task takes a share of its rows.
FILES_PER_TASK = 100


def _files_of_task(rows_per_file: int) -> int:
    return min(FILES_PER_TASK, max(1, ROWS_PER_FILE // rows_per_file))


def tasks_of(rows: float, rows_per_file: int) -> int:
    """Tasks that write a partition of ``rows``: one file each where files are large, many where they are small."""
    files = _files_of_task(rows_per_file)
    return math.ceil(rows / rows_per_file) if files == 1 else max(1, int(rows // (files * rows_per_file)))


def most_rows(rows_per_file: int) -> int | None:
    """Rows at which a task begins another file; None where each task writes one.

    Each task's last file may be part filled.  With a little more than ``rows_per_file`` in the others
    a partition still has no more files than its rows fill, however unevenly they are dealt.
    """
    files = _files_of_task(rows_per_file)
    return None if files == 1 else math.ceil(rows_per_file * files / (files - 1))


def sized(rows: DataFrame, kept: dict[dt.date, int], rejected: dict[dt.date, int]) -> DataFrame:
    """Deal rows so that a partition is written by its number of tasks (one if not named).

    Equal rows of one partition are dealt by their map task.
    """
    number = F.lit(1)
    for column, files in (("event_month", kept), (REJECT_MONTH, rejected)):
        if files:  # calendar-sized map
            known = F.create_map(*[F.lit(x) for pair in files.items() for x in pair])
            number = F.coalesce(known[F.col(column)], number)
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns], F.spark_partition_id()), number)
    total = sum(kept.values()) + sum(rejected.values())
    tasks = max(total, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, *PARTS, salt)


def well_filed(rows: DataFrame, pins: Sequence, rows_per_file: int) -> bool:
    """Whether the bronze scan ``rows`` of ``pins`` reads no month from more files than its rows fill."""
    records, files = Counter(), Counter()
    for r in pins:
        records[f"year={r.year}", f"month={r.month}"] += r.records
    for path in rows.inputFiles():  # listed by the scan already
        files[tuple(path.split("/")[-3:-1])] += 1
    return all(n <= max(1, math.ceil(records[month] / rows_per_file)) for month, n in files.items())


#: Reason of a row that no rule rejects but that has no event month it could be stored under.
UNPLACEABLE = "unplaceable_event"


def flag_unplaceable(classified: DataFrame, tolerance_months: int) -> DataFrame:
    """Rows without a reason whose event month is NULL or outside their delivery's months get one.

    Without it such a row would be neither kept nor rejected.
    """
    index = lambda y, m: y * 12 + m - 1
    late = index(F.col("src_year"), F.col("src_month")) - index(F.year("event_month"), F.month("event_month"))
    placeable = F.coalesce(late.between(0, tolerance_months), F.lit(False))
    lost = (F.size(F.col(REASONS)) == 0) & ~placeable
    return classified.withColumn(REASONS, F.when(lost, F.array(F.lit(UNPLACEABLE))).otherwise(F.col(REASONS)))


class SilverRun(NamedTuple):
    silver_version: int  # holds kept rows and rejects
    rows: int  # rows of the requested source months (observed during the write, no second pass)
    rejected: int


#: Rows of a file that is worth a second one beside it.
ROWS_PER_FILE = 2_000_000


def run_silver(
    spark: SparkSession,
    layout: Layout,
    dim: DataFrame,
    batch_id: str,
    *,
    months: Sequence[tuple[int, int]] | None = None,
    tolerance_months: int = 0,
    event: str = "pickup_at",
    rules: Sequence[Rule] | None = None,
    silver_root: str | None = None,
    committed_at: dt.datetime | None = None,
    bronze_version: int | None = None,
    max_reject_rate: float | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> SilverRun:
    """Rebuild silver and rejects for source ``months`` (all when None) (Q16).

    One pass over bronze, one write, one commit.  Every row of the requested months is
    kept or rejected: one that passes the rules but has no event month to be stored
    under is rejected as ``unplaceable_event``, one without a trip id (D10) as ``missing_key``.
    Rows and rejects of the requested months are counted by an ``Observation`` during the
    write (Q7).  With ``max_reject_rate`` a run whose reject fraction is higher raises
    ``RejectRateExceeded`` after committing (Q8): the alert points upstream, and the
    commit can be rolled back.
    """
    table = open_table(spark, silver_root or layout.silver, committed_at)
    rules = list(rules) if rules is not None else default_rules(tolerance_months, event)
    setup = _setup(rules, tolerance_months, event)
    bronze = VersionedTable(spark, layout.bronze)
    bv = bronze.current_version() if bronze_version is None else bronze_version
    pins = bronze.pin_rows(bv)
    if months is None:
        months = sorted({(r.year, r.month) for r in pins})
    months = [tuple(m) for m in months]
    events, sources = source_scope(table, bronze, bv, months, tolerance_months, setup)

    # exactly the folders of the source months that can hold the affected event months are read
    wanted = set(sources)
    src_pins = [r for r in pins if (r.year, r.month) in wanted]
    read = bronze.scan_pins(src_pins)
    conformed = with_event_month(fill_missing(conform(read)), event)
    classified = flag_unplaceable(classify(conformed, [*rules, missing_key()]), tolerance_months)
    bad = F.size(F.col(REASONS)) > 0
    requested = F.lit(True)
    if set(months) != wanted:  # other months are read for late rows only
        requested = (F.col("src_year") * 12 + F.col("src_month") - 1).isin(*[_month_index(y, m) for y, m in months])
    # counts ride along with the write (nothing to observe without input)
    watched, obs = observed(classified, f"silver-{uuid.uuid4().hex[:8]}", requested) if src_pins else (classified, None)

    event_scope = [dt.date(y, m, 1) for y, m in events]
    if len(events) == events_span(events):
        rebuilt = F.col("event_month").between(F.lit(event_scope[0]), F.lit(event_scope[-1]))
    else:  # calendar-sized literal list
        rebuilt = F.col("event_month").isin(*event_scope)
    delivered = F.make_date("src_year", "src_month", F.lit(1))
    placed = watched.where(F.when(bad, requested).otherwise(rebuilt)).withColumns({
        REJECT_MONTH: F.when(bad, delivered), "event_month": F.when(~bad, F.col("event_month")),
        REASONS: F.when(bad, F.col(REASONS)),
    })
    placed = enrich_zones(placed, dim)
    # a sort-merge join with the dimension would scatter a month's rows
    at_home = tolerance_months == 0 and _files_of_task(rows_per_file) == 1 and broadcast_fits(dim)
    if at_home and well_filed(read, src_pins, rows_per_file):
        most = rows_per_file
    else:
        placed, most = sized(placed, *files_per_month(table, src_pins, tolerance_months, setup, rows_per_file)), most_rows(rows_per_file)
    version = table.write(
        placed.select(*stored_schema().fieldNames()), "replace",
        batch_id=batch_id, committed_at=committed_at, rows_per_file=most,
        scope=[(m, None) for m in event_scope] + [(None, dt.date(y, m, 1)) for y, m in months],
    )
    store_lineage(table, version, bv, setup)
    counts = obs.get if obs is not None else {"rows": 0, "rejected": 0}
    run = SilverRun(version, int(counts.get("rows", 0)), int(counts.get("rejected", 0)))
    if max_reject_rate is not None:
        check_reject_rate(run.rows, run.rejected, max_reject_rate)
    return run


def read_kept(table: VersionedTable, version: int | None = None) -> DataFrame:
    """The kept rows of a version: exactly their folders are read."""
    version = table.current_version() if version is None else version
    pins = [r for r in table.pin_rows(version) if r[REJECT_MONTH] is None]
    return table.scan_pins(pins, schema=table.schema(version)).select(*silver_schema().fieldNames())


def read_rejected(table: VersionedTable, version: int | None = None) -> DataFrame:
    version = table.current_version() if version is None else version
    pins = [r for r in table.pin_rows(version) if r[REJECT_MONTH] is not None]
    return table.scan_pins(pins, schema=table.schema(version)).select(*rejects_schema().fieldNames())


def read_silver(spark: SparkSession, layout: Layout, version: int | None = None) -> DataFrame:
    return read_kept(VersionedTable(spark, layout.silver), version)


def read_rejects(spark: SparkSession, layout: Layout, version: int | None = None) -> DataFrame:
    return read_rejected(VersionedTable(spark, layout.silver), version)


def silver_version(spark: SparkSession, layout: Layout) -> int:
    try:
        return VersionedTable(spark, layout.silver).current_version()
    except HistoryError:
        return 0
