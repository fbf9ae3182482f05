"""Table history as DataFrame operations over a versioned Parquet dataset.

Layout of one table under ``root``::

    data/_version=V/<part cols>/part-*.parquet    rows; a write never touches old files
    commits/seq=N/*.parquet                       one row per pointer move (append-only); a
                                                  commit that creates version V also holds
                                                  V's pins: one entry per live table partition
                                                  (partition values, data_version, records)
    expired/*.parquet                             versions removed by ``expire``

Order of a write: data first, then the commit row (with its pins) **last**, as
one atomic file; a crashed write has no commit row, so readers never see it and
``orphans`` lists it.  Every version stores its complete pin list, so reading a
version never walks a chain and expiring one version cannot break another.  The current version is the
``version`` of the highest ``seq``; a rollback only appends a commit row.

Single writer only.  The bookkeeping tables hold one row per commit or per
table partition -- metadata, like a table format's manifests -- so a table
object reads them once, keeps them on the driver and plans data reads from
them; row data itself never leaves the cluster.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import FOOTER_COST, footer_session, unsorted_write

LOG_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("operation", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("added_records", T.LongType()),
        T.StructField("deleted_records", T.LongType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("partition_cols", T.StringType()),
    ]
)
# A stored commit also carries the complete pin list of the version it creates:
# partition values as text (cast back to the column types on read).
PIN_TYPE = T.StructType(
    [
        T.StructField("values", T.ArrayType(T.StringType())),
        T.StructField("data_version", T.IntegerType()),
        T.StructField("records", T.LongType()),
    ]
)
COMMITS_SCHEMA = T.StructType(LOG_SCHEMA.fields + [T.StructField("pins", T.ArrayType(PIN_TYPE))])
EXPIRED_SCHEMA = "version int, expired_at timestamp_ntz"

# Operations that create a new table version; "rollback" and "set_current"
# only move the pointer.
VERSIONING_OPS = ("create", "overwrite", "append", "replace", "compact", "revert")

#: Files of at most this many rows take less work to fill than Hadoop's local file system takes beside it.
SMALL_FILE = 10_000

# Types whose values are spelled the same in a folder name and in a pin.
PARTITION_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.StringType, T.BooleanType)


class HistoryError(Exception):
    """Invalid history operation (unknown version, not an ancestor, ...)."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # Hadoop FileSystem API: works on HDFS and object stores
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return bool(fs.delete(p, True))


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-folders of ``path`` (one listing call)."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


# Characters Spark escapes as %XX in partition folder names, and
# the folder name of a NULL or empty partition value.
_ESCAPED = set(chr(c) for c in range(1, 32)) | set('"#%\'*/:=?\\\x7f{[]^')
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _fmt_value(v) -> str:
    """A partition value as Spark spells it in a folder name."""
    if v is None or v == "":
        return _NULL_PARTITION
    if isinstance(v, bool):
        v = str(v).lower()
    if isinstance(v, dt.datetime):
        v = v.isoformat(sep=" ")
    elif isinstance(v, dt.date):
        v = v.isoformat()
    return "".join(f"%{ord(ch):02X}" if ch in _ESCAPED else ch for ch in str(v))


def _as_text(v) -> str | None:
    """A partition value as text that casts back to its column type."""
    if v is None:
        return None
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    return str(v)


class VersionedTable:
    """A partitioned Parquet dataset with commits, pins and time travel."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.data_path = f"{self.root}/data"
        self.commits_path = f"{self.root}/commits"
        self.expired_path = f"{self.root}/expired"
        self._log: list[Row] | None = None
        self._expired: set[int] | None = None
        self._pin_cache: dict[int, list[Row]] = {}

    # ------------------------------------------------------------------ create
    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        partition_cols: Sequence[str],
        *,
        batch_id: str | None = None,
        committed_at: dt.datetime | None = None,
    ) -> VersionedTable:
        """Declare schema and partition spec; version 1 is the empty table (C4)."""
        missing = [c for c in partition_cols if c not in schema.fieldNames()]
        if missing:
            raise HistoryError(f"partition columns not in schema: {missing}")
        odd = [c for c in partition_cols if not isinstance(schema[c].dataType, PARTITION_TYPES)]
        if odd:
            raise HistoryError(f"columns of these types cannot partition a table: {odd}")
        t = cls(spark, root)
        if path_exists(spark, t.commits_path):
            raise HistoryError(f"table already exists at {root}")
        t._write_commit(
            version=1, parent=None, operation="create", batch_id=batch_id,
            added=0, deleted=0, committed_at=committed_at, schema=schema,
            partition_cols=list(partition_cols),
        )
        return t

    @staticmethod
    def exists(spark: SparkSession, root: str) -> bool:
        return path_exists(spark, f"{root.rstrip('/')}/commits")

    # ------------------------------------------------------------- bookkeeping
    def commits(self) -> DataFrame:
        """Every commit row, incl. pointer moves (J4 history); pins not selected."""
        return self.spark.read.schema(COMMITS_SCHEMA).parquet(self.commits_path).select(*LOG_SCHEMA.fieldNames())

    def _commit_rows(self) -> list[Row]:
        """The commit log ordered by ``seq`` (read once, then kept in step by this writer)."""
        if self._log is None:
            if not path_exists(self.spark, self.commits_path):
                self._log = []
            else:
                self._log = sorted(self.commits().collect(), key=lambda r: r.seq)
        return self._log

    def refresh(self) -> VersionedTable:
        """Forget cached metadata.  Reads see the table as of an instance's first
        use (a stable snapshot); every mutating operation refreshes first."""
        self._log, self._expired, self._pin_cache = None, None, {}
        return self

    def _expired_versions(self) -> set[int]:
        if self._expired is None:
            if not path_exists(self.spark, self.expired_path):
                self._expired = set()
            else:
                rows = self.spark.read.schema(EXPIRED_SCHEMA).parquet(self.expired_path).select("version").collect()
                self._expired = {r.version for r in rows}
        return self._expired

    def _head(self) -> Row:
        rows = self._commit_rows()
        if not rows:
            raise HistoryError(f"no table at {self.root}")
        return rows[-1]

    def current_version(self) -> int:
        return self._head().version

    def _creation(self) -> dict[int, Row]:
        """version -> the commit that created it."""
        out: dict[int, Row] = {}
        for r in self._commit_rows():
            if r.operation in VERSIONING_OPS and r.version not in out:
                out[r.version] = r
        return out

    @property
    def partition_cols(self) -> list[str]:
        for r in self._commit_rows():
            if r.operation == "create":
                return json.loads(r.partition_cols)
        raise HistoryError(f"no table at {self.root}")

    def schema(self, version: int | None = None) -> T.StructType:
        """Table schema of a version (the current one by default).

        The nearest one declared on the version's own chain of parents: columns that
        another branch or a later commit added are not part of it.
        """
        created = self._creation()
        chain = [created[v] for v in self.ancestors(version)] or list(created.values())[:1]
        for r in chain:
            if r.schema_json is not None:
                return T.StructType.fromJson(json.loads(r.schema_json))
        raise HistoryError(f"no schema for version {version} at {self.root}")

    def declared_schema(self) -> T.StructType:
        """The schema the table was created with: its contract columns."""
        for r in self._commit_rows():
            if r.operation == "create":
                return T.StructType.fromJson(json.loads(r.schema_json))
        raise HistoryError(f"no table at {self.root}")

    def _pins_schema(self) -> T.StructType:
        schema = self.declared_schema()
        fields = [schema[c] for c in self.partition_cols]
        return T.StructType(
            [T.StructField("version", T.IntegerType())]
            + [T.StructField(f.name, f.dataType) for f in fields]
            + [T.StructField("data_version", T.IntegerType()), T.StructField("records", T.LongType())]
        )

    def pin_rows(self, version: int | None) -> list[Row]:
        """Live partitions of ``version`` as rows (metadata: one per table partition).

        Read from the single commit folder that created the version.
        """
        if version is None:
            return []
        if version not in self._pin_cache:
            created = self._creation().get(version)
            rows: list[Row] = []
            if created is not None:
                schema = self.declared_schema()
                parts = self.partition_cols
                rows = (
                    self.spark.read.schema(COMMITS_SCHEMA)
                    .option("basePath", self.commits_path)
                    .parquet(f"{self.commits_path}/seq={created.seq}")
                    .select(F.explode("pins").alias("p"))
                    .select(
                        *[F.col("p.values")[i].cast(schema[c].dataType).alias(c) for i, c in enumerate(parts)],
                        "p.data_version", "p.records",
                    )
                    .collect()
                )
            self._pin_cache[version] = rows
        return self._pin_cache[version]

    def pins(self, version: int | None) -> DataFrame:
        """Live partitions of ``version``: part cols, data_version, records."""
        schema = T.StructType([f for f in self._pins_schema().fields if f.name != "version"])
        return self.spark.createDataFrame(self.pin_rows(version), schema)

    def next_version(self) -> int:
        """1 + max over commits, pins and data folders (a crashed write's number is never reused)."""
        seen = [r.version for r in self._commit_rows()]
        for name in list_subdirs(self.spark, self.data_path):
            key, _, val = name.partition("=")
            if key in ("version", "_version") and val.isdigit():
                seen.append(int(val))
        return max(seen, default=0) + 1

    def _write_commit(
        self, *, version: int, parent: int | None, operation: str, batch_id: str | None,
        added: int, deleted: int, committed_at: dt.datetime | None,
        schema: T.StructType | None = None, partition_cols: list[str] | None = None,
        pins: Sequence[Row] | None = None,
    ) -> None:
        log = self._commit_rows()
        seq = (log[-1].seq if log else 0) + 1
        row = (
            seq, version, parent, operation, batch_id, int(added), int(deleted),
            committed_at or _now(),
            json.dumps(schema.jsonValue()) if schema is not None else None,
            json.dumps(partition_cols) if partition_cols is not None else None,
        )
        parts = self.partition_cols if partition_cols is None else partition_cols
        stored = None
        if pins is not None:
            stored = [([_as_text(r[c]) for c in parts], r.data_version, r.records) for r in pins]
        (
            self.spark.createDataFrame([(*row, stored)], COMMITS_SCHEMA)
            .coalesce(1)
            .write.mode("append")
            .partitionBy("seq")
            .parquet(self.commits_path)
        )
        log.append(Row(**dict(zip(LOG_SCHEMA.fieldNames(), row))))

    # -------------------------------------------------------------------- read
    def _data_schema(self, schema: T.StructType | None = None) -> T.StructType:
        """Read schema of the data folder: data columns, then _version, then partition columns."""
        schema = schema or self.schema()
        parts = self.partition_cols
        data = [f for f in schema.fields if f.name not in parts]
        return T.StructType(data + [T.StructField("_version", T.IntegerType())] + [schema[c] for c in parts])

    def _pin_paths(self, pins: Sequence[Row]) -> list[str]:
        parts = self.partition_cols
        keys = {(r.data_version, *[_fmt_value(r[c]) for c in parts]) for r in pins}
        return [f"{self.data_path}/_version={v}/" + "/".join(f"{c}={x}" for c, x in zip(parts, k)) for v, *k in sorted(keys)]

    def scan_pins(self, pins: Sequence[Row], *, metadata: bool = False, schema: T.StructType | None = None) -> DataFrame:
        """Rows of the given pins, with the columns of ``schema`` (the current one by default).

        Reads exactly the pinned folders, nothing else is even listed; a NULL partition
        value is a folder like any other.  Columns a file lacks are NULL.
        """
        schema = schema or self.schema()
        if pins:
            reader = self.spark.read.schema(self._data_schema(schema)).option("basePath", self.data_path)
            df = reader.parquet(*self._pin_paths(pins))
        else:
            df = self.spark.createDataFrame([], schema)
        if metadata:
            file = {"_metadata_file": "_metadata.file_path", "_metadata_size": "_metadata.file_size"}
            kinds = {"_metadata_file": "string", "_metadata_size": "bigint"}
            df = df.withColumns({k: F.col(v) if pins else F.lit(None).cast(kinds[k]) for k, v in file.items()})
        cols = schema.fieldNames() + (["_metadata_file", "_metadata_size"] if metadata else [])
        return df.select(*cols)

    def _pins_schema_nov(self) -> T.StructType:
        return T.StructType([f for f in self._pins_schema().fields if f.name != "version"])

    def version_as_of(self, timestamp: dt.datetime) -> int:
        """Version current at ``timestamp``: last commit with committed_at <= t."""
        rows = [r for r in self._commit_rows() if r.committed_at <= timestamp]
        if not rows:
            raise HistoryError(f"no commit at or before {timestamp}")
        return rows[-1].version

    def read(self, version: int | None = None, as_of: dt.datetime | None = None) -> DataFrame:
        """Current rows, or rows of a version / a point in time (B5-B7, J5).  Never alters the table."""
        if version is not None and as_of is not None:
            raise HistoryError("give version or as_of, not both")
        if as_of is not None:
            version = self.version_as_of(as_of)
        if version is None:
            version = self.current_version()
        elif version in self._expired_versions():
            raise HistoryError(f"version {version} has been expired")
        elif version not in self._creation():
            raise HistoryError(f"unknown version {version}")
        return self.scan_pins(self.pin_rows(version), schema=self.schema(version))

    # ------------------------------------------------------------------- write
    def write(
        self,
        df: DataFrame,
        mode: str = "replace",
        *,
        batch_id: str | None = None,
        committed_at: dt.datetime | None = None,
        scope: DataFrame | Sequence[tuple] | None = None,
        operation: str | None = None,
        parent: int | None = None,
        rows_per_file: int | None = None,
    ) -> int:
        """Commit ``df`` as a new version; returns its number.

        * ``replace`` (C5, ``overwritePartitions``): partitions present in ``df``
          -- or every partition in ``scope`` -- are replaced; others keep their
          data.  With ``scope`` a partition can be emptied.
        * ``append`` (C1): rows are added next to the existing ones.
        * ``overwrite``: the whole table becomes ``df``.

        Columns that an earlier commit added and ``df`` lacks are NULL (an older
        shape landed again); a missing contract column, or a column of another type
        than the table's, fails before anything is written.  With ``parent`` the
        commit fails if the table has moved on from that version.  No file gets more than
        ``rows_per_file`` rows: a task begins another one.

        One job writes the data; one metadata scan of the new folder counts
        records per partition; pins and the commit row are tiny writes.
        """
        if mode not in ("replace", "append", "overwrite"):
            raise HistoryError(f"unknown mode {mode}")
        self.refresh()  # a writer always starts from the latest commit
        parts = self.partition_cols
        schema = self.schema()
        extra = [c for c in df.columns if c not in schema.fieldNames()]
        missing = [c for c in self.declared_schema().fieldNames() if c not in df.columns]
        if missing:
            raise HistoryError(f"input lacks table columns {missing}")
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns})
        odd = [
            f"{f.name}: {df.schema[f.name].dataType.simpleString()} for {f.dataType.simpleString()}"
            for f in schema.fields if df.schema[f.name].dataType.simpleString() != f.dataType.simpleString()
        ]
        if odd:
            raise HistoryError(f"input has other types than the table: {odd}")
        new_schema = None
        if extra:  # additive evolution (E7): accepted, recorded with this commit
            new_schema = T.StructType(schema.fields + [df.schema[c] for c in extra])
            schema = new_schema
        data_cols = [c for c in schema.fieldNames() if c not in parts]
        head = self._head().version
        if parent is not None and parent != head:
            raise HistoryError(f"the table moved from version {parent} to {head}")
        parent = head
        v = self.next_version()

        # 1. data: a new _version folder; no existing file is touched.  Task
        #    output may become visible before the job ends (committer v2): no
        #    reader looks at a version before its commit row exists.
        with unsorted_write(self.spark):
            (
                df.select(*data_cols, *parts)
                .withColumn("_version", F.lit(v).cast("int"))
                .write.mode("append")
                .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
                .option("maxRecordsPerFile", rows_per_file or 0)
                .options(**self._small_file_options(rows_per_file))
                .partitionBy("_version", *parts)
                .parquet(self.data_path)
            )
        # 2. records per partition of what was written (row counts from footers)
        written: list[Row] = []
        if path_exists(self.spark, f"{self.data_path}/_version={v}"):
            written = self._written(v, schema).collect()
        new = [(*[r[c] for c in parts], v, r.records) for r in written]
        old = self.pin_rows(parent)
        if mode == "overwrite":
            kept = []
        elif mode == "append":
            kept = old
        else:
            # every partition written is replaced, plus any extra scope (which
            # may name partitions that are now empty)
            touched = {t[: len(parts)] for t in new}
            if isinstance(scope, DataFrame):
                touched |= {tuple(r[c] for c in parts) for r in scope.select(*parts).distinct().collect()}
            elif scope is not None:
                touched |= {tuple(t) for t in scope}
            kept = [r for r in old if tuple(r[c] for c in parts) not in touched]
        rows = [(*[r[c] for c in parts], r.data_version, r.records) for r in kept] + new
        self._commit_pins(
            v, parent, rows, operation=operation or mode, batch_id=batch_id,
            committed_at=committed_at, schema=new_schema,
        )
        return v

    def _small_file_options(self, rows_per_file: int | None) -> dict[str, str]:
        """Options of a write of small files: none, unless the table is on Hadoop's local file system.

        That keeps a checksum file beside each file and starts a process (``chmod``) for either, which
        takes longer than writing a few hundred rows.  Here the files go without the second one; the
        checksums that Parquet keeps within a file, one a page, are left.  A cluster that names a
        class of its own for ``file:`` paths keeps it.
        """
        fs, _ = _hadoop_path(self.spark, self.root)
        named = self.spark.sparkContext._jsc.hadoopConfiguration().get("fs.file.impl")
        if not rows_per_file or rows_per_file > SMALL_FILE or fs.getUri().getScheme() != "file" or named:
            return {}
        raw = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
        return raw | {"parquet.page.write-checksum.enabled": "true"}

    def _written(self, v: int, schema: T.StructType) -> DataFrame:
        """Records of each partition in the data folder of ``v``, from the files' footers alone."""
        session = footer_session(self.spark)
        session.conf.set("spark.sql.files.openCostInBytes", str(FOOTER_COST))
        parts = self.partition_cols
        rows = session.read.schema(self._data_schema(schema)).option("basePath", self.data_path).parquet(f"{self.data_path}/_version={v}")
        # grouped by every folder column, or footers do not answer
        return rows.groupBy("_version", *parts).agg(F.count(F.lit(1)).alias("records")).select(*parts, "records")

    def _commit_pins(
        self, v: int, parent: int | None, pins: Sequence[tuple], *, operation: str,
        batch_id: str | None, committed_at: dt.datetime | None, schema: T.StructType | None = None,
    ) -> None:
        """Write the commit row of version ``v`` with its pins: (parts..., data_version, records)."""
        nov = self._pins_schema_nov()
        rows = [Row(**dict(zip(nov.fieldNames(), t))) for t in pins]
        added = sum(r.records for r in rows if r.data_version == v)
        kept = sum(r.records for r in rows if r.data_version != v)
        before = sum(r.records for r in self.pin_rows(parent))
        self._write_commit(
            version=v, parent=parent, operation=operation, batch_id=batch_id,
            added=added, deleted=before - kept, committed_at=committed_at, schema=schema, pins=rows,
        )
        self._pin_cache[v] = rows

    def replace_partitions(self, df: DataFrame, **kw) -> int:
        """``overwritePartitions()``: one atomic commit replacing the partitions present."""
        return self.write(df, "replace", **kw)

    def append(self, df: DataFrame, **kw) -> int:
        return self.write(df, "append", **kw)

    # ---------------------------------------------------------------- metadata
    def _log_frame(self) -> DataFrame:
        return self.spark.createDataFrame(self._commit_rows(), LOG_SCHEMA)

    def snapshots(self) -> DataFrame:
        """Live versions with their creating commit (J1), ordered by commit."""
        expired = self._expired_versions()
        created = self._creation()
        rows = [created[v] for v in created if v not in expired]
        return (
            self.spark.createDataFrame(rows, LOG_SCHEMA)
            .select("seq", "version", "parent", "operation", "batch_id",
                    "added_records", "deleted_records", "committed_at")
            .orderBy("seq")
        )

    def history(self) -> DataFrame:
        """Every pointer move, incl. rollbacks."""
        return self._log_frame().select(
            "seq", "version", "parent", "operation", "batch_id", "committed_at"
        ).orderBy("seq")

    def files(self, version: int | None = None) -> DataFrame:
        """Data files of a version with their record counts."""
        v = self.current_version() if version is None else version
        df = self.scan_pins(self.pin_rows(v), metadata=True)
        return (
            df.groupBy(*self.partition_cols, "_metadata_file", "_metadata_size")
            .agg(F.count(F.lit(1)).alias("record_count"))
            .select(
                *self.partition_cols, "record_count",
                F.col("_metadata_size").alias("file_size_in_bytes"),
                F.substring_index("_metadata_file", "/", -1).alias("file"),
            )
        )

    def commit_delta(self, version: int) -> DataFrame:
        """Per partition: file sets added / existing / deleted by a commit."""
        parent = self._creation()[version].parent
        parts = self.partition_cols
        new = self.pins(version).alias("n")
        old = self.pins(parent).alias("o")
        key = [*parts, "data_version"]
        status = (
            F.when(F.col("o.records").isNull(), "added")
            .when(F.col("n.records").isNull(), "deleted")
            .otherwise("existing")
        )
        return new.join(old, key, "full_outer").select(
            F.lit(version).cast("int").alias("version"),
            *key,
            F.coalesce("n.records", "o.records").alias("records"),
            status.alias("status"),
        )

    def register(self, name: str, version: int | None = None) -> DataFrame:
        """Expose a version (current by default) to SQL as a temp view."""
        df = self.read(version)
        df.createOrReplaceTempView(name)
        return df

    def manifests(self, version: int) -> DataFrame:
        """Per-commit summary (J3): partition folders and records added / kept / deleted."""
        d = self.commit_delta(version)
        def n(status: str, what):
            return F.sum(F.when(F.col("status") == status, what).otherwise(0))
        return d.agg(
            n("added", F.lit(1)).alias("added_partitions"),
            n("existing", F.lit(1)).alias("existing_partitions"),
            n("deleted", F.lit(1)).alias("deleted_partitions"),
            n("added", F.col("records")).alias("added_records"),
            n("deleted", F.col("records")).alias("deleted_records"),
        ).select(F.lit(version).cast("int").alias("version"), "*")

    def describe(self) -> DataFrame:
        """``DESCRIBE TABLE`` (J11): column, type, partition flag."""
        parts = self.partition_cols
        rows = [(f.name, f.dataType.simpleString(), f.name in parts) for f in self.schema().fields]
        return self.spark.createDataFrame(rows, "col_name string, data_type string, is_partition boolean")

    # ---------------------------------------------------------- pointer moves
    def ancestors(self, version: int | None = None) -> list[int]:
        """Versions on the parent chain of ``version`` (current by default), itself first."""
        created = self._creation()
        v = self.current_version() if version is None else version
        chain = []
        while v is not None and v in created and v not in chain:
            chain.append(v)
            v = created[v].parent
        return chain

    def rollback(self, version: int, *, committed_at: dt.datetime | None = None) -> None:
        """Point the table at an ancestor version (J6).  No data is written."""
        self.refresh()
        if version not in self.ancestors():
            raise HistoryError(f"version {version} is not an ancestor of the current version")
        self._move(version, "rollback", committed_at)

    def set_current(self, version: int, *, committed_at: dt.datetime | None = None) -> None:
        """Point the table at any retained version, e.g. forward again."""
        self.refresh()
        if version not in self._creation():
            raise HistoryError(f"unknown version {version}")
        self._move(version, "set_current", committed_at)

    def _move(self, version: int, operation: str, committed_at: dt.datetime | None) -> None:
        self.refresh()
        if version in self._expired_versions():
            raise HistoryError(f"version {version} has been expired")
        self._write_commit(
            version=version, parent=self.current_version(), operation=operation,
            batch_id=None, added=0, deleted=0, committed_at=committed_at,
        )

    # --------------------------------------------------------------- undo, diff
    def undo_batch(self, batch_id: str, *, committed_at: dt.datetime | None = None) -> int:
        """Revert what one run wrote (J12), keeping later good partitions.

        A partition that holds the batch's data gets the pins of the newest
        earlier version in which it held none, besides later good ones; a
        pins-only ``revert`` commit.  Fails when that version has been expired.
        """
        self.refresh()
        created = self._creation()
        bad = {v for v, r in created.items() if r.batch_id == batch_id and r.operation != "revert"}
        if not bad:
            raise HistoryError(f"no version written by batch {batch_id}")
        parts = self.partition_cols
        key = lambda r: tuple(r[c] for c in parts)
        cur = self.current_version()
        pins = self.pin_rows(cur)
        keep = {(key(r), r.data_version): r for r in pins if r.data_version not in bad}
        lost = {key(r) for r in pins if r.data_version in bad}
        for v in self.ancestors(cur)[1:]:  # newest first
            if not lost:
                break
            if v in self._expired_versions():
                raise HistoryError(f"cannot undo batch {batch_id}: version {v}, which it replaced, has been expired")
            then: dict[tuple, list[Row]] = {k: [] for k in lost}
            for r in self.pin_rows(v):
                if key(r) in then:
                    then[key(r)].append(r)
            for k, rows in then.items():
                if not any(r.data_version in bad for r in rows):  # the partition as it was before the batch came
                    keep.update({(k, r.data_version): r for r in rows})
                    lost.discard(k)
        keep = list(keep.values())
        v_new = self.next_version()
        rows = [(*key(r), r.data_version, r.records) for r in keep]
        self._commit_pins(v_new, cur, rows, operation="revert", batch_id=batch_id, committed_at=committed_at)
        return v_new

    def diff(self, a: int, b: int, columns: Sequence[str] | None = None) -> DataFrame:
        """Rows removed and added between versions ``a`` and ``b``.

        Only partitions whose pins differ are read; multiset semantics via
        ``exceptAll``.  Output: ``_change`` ('removed' / 'added') + columns.
        """
        parts = self.partition_cols
        key = lambda r: tuple(r[c] for c in parts)
        def pinsets(v: int) -> dict:
            out: dict = {}
            for r in self.pin_rows(v):
                out.setdefault(key(r), set()).add(r.data_version)
            return out
        sa, sb = pinsets(a), pinsets(b)
        differing = {k for k in set(sa) | set(sb) if sa.get(k) != sb.get(k)}
        both = self.schema(a)
        both = T.StructType(both.fields + [f for f in self.schema(b).fields if f.name not in both.fieldNames()])
        ra = self.scan_pins([r for r in self.pin_rows(a) if key(r) in differing], schema=both)
        rb = self.scan_pins([r for r in self.pin_rows(b) if key(r) in differing], schema=both)
        if columns is not None:
            ra, rb = ra.select(*columns), rb.select(*columns)
        return ra.exceptAll(rb).withColumn("_change", F.lit("removed")).unionByName(
            rb.exceptAll(ra).withColumn("_change", F.lit("added"))
        )

    # ------------------------------------------------------------ maintenance
    def expire_plan(self, older_than: dt.datetime, retain_last: int = 1) -> tuple[list[int], DataFrame]:
        """Which versions expire and which data partitions nobody retained needs.

        Retained: the current version, the last ``retain_last`` versions and any
        version committed after ``older_than``.  A data partition is deleted only
        when no retained version's pins name it (anti-join of pins).
        """
        created = self._creation()
        expired_before = self._expired_versions()
        live = [v for v in sorted(created, key=lambda v: created[v].seq) if v not in expired_before]
        keep = set(live[-retain_last:]) if retain_last > 0 else set()
        keep.add(self.current_version())
        keep |= {v for v in live if created[v].committed_at > older_than}
        expire = [v for v in live if v not in keep]
        parts = self.partition_cols
        pkey = ["data_version", *parts]
        def frame(versions) -> DataFrame:
            rows = [r for v in versions for r in self.pin_rows(v)]
            return self.spark.createDataFrame(rows, self._pins_schema_nov())
        plan = (
            frame(expire).groupBy(*pkey).agg(F.max("records").alias("records"))
            .join(frame(sorted(keep)).select(*pkey).distinct(), pkey, "left_anti")
        )
        return expire, plan

    def expire(self, older_than: dt.datetime, retain_last: int = 1, *, expired_at: dt.datetime | None = None) -> DataFrame:
        """Expire versions and delete data no retained version needs.

        Returns the executed plan (partitions deleted).  The commit log is kept
        as history; expired versions disappear from ``snapshots``.
        """
        self.refresh()
        expire, plan = self.expire_plan(older_than, retain_last)
        if not expire:
            return plan.limit(0)
        parts = self.partition_cols
        doomed = plan.collect()  # one row per table partition: bounded metadata
        for path in self._pin_paths(doomed):  # before the mark: after a crash the next call finds the same plan
            delete_path(self.spark, path)
        self.spark.createDataFrame(
            [(v, expired_at or _now()) for v in expire], EXPIRED_SCHEMA
        ).coalesce(1).write.mode("append").parquet(self.expired_path)
        self._expired = (self._expired or set()) | set(expire)
        return self.spark.createDataFrame(doomed, plan.schema) if doomed else plan.limit(0)

    def orphans(self) -> DataFrame:
        """Data folders no commit references, e.g. a crashed write.

        ``data_version, files, bytes, modified`` from a metadata-only listing.
        """
        from strata.layout import list_files

        committed = sorted(self._creation())
        if not path_exists(self.spark, self.data_path):
            return self.spark.createDataFrame([], "data_version int, files bigint, bytes bigint, modified timestamp")
        files = list_files(self.spark, self.data_path)
        dv = F.regexp_extract("path", r"/_version=(\d+)/", 1).cast("int")
        return (
            files.withColumn("data_version", dv)
            .where(~F.col("data_version").isin(*committed))
            .groupBy("data_version")
            .agg(
                F.count(F.lit(1)).alias("files"),
                F.sum("length").alias("bytes"),
                F.max("modificationTime").alias("modified"),
            )
        )

    def remove_orphans(self, older_than: dt.datetime) -> list[int]:
        """Delete orphan data older than a safety window; returns the versions removed."""
        rows = self.orphans().where(F.col("modified") < F.lit(older_than)).select("data_version").collect()
        for r in rows:
            delete_path(self.spark, f"{self.data_path}/_version={r.data_version}")
        return [r.data_version for r in rows]

    def compact(
        self, rows_per_file: int = 1_000_000, *, sort_by: Sequence[str] | None = None,
        batch_id: str | None = None, committed_at: dt.datetime | None = None,
    ) -> int:
        """Rewrite the current version into few, evenly sized files.

        Each partition gets ``ceil(records / rows_per_file)`` output files; rows
        are spread over them by a deterministic hash, so a large partition is
        written by several tasks and a retried task rewrites the same rows.
        ``sort_by`` clusters rows inside each file, so Parquet min/max statistics
        let pushed-down filters on those columns skip row groups.
        """
        self.refresh()  # the version that is rewritten is the one that is replaced
        parent = self.current_version()
        parts = self.partition_cols
        pins = self.pin_rows(parent)
        per_part: dict = {}
        for r in pins:
            k = tuple(r[c] for c in parts)
            per_part[k] = per_part.get(k, 0) + r.records
        sizes = self.spark.createDataFrame(  # a row per table partition
            [(*k, max(1, math.ceil(n / rows_per_file))) for k, n in per_part.items()],
            T.StructType([self.schema()[c] for c in parts] + [T.StructField("_k", T.LongType())]),
        )
        rows = self.read(parent)
        total = max(1, sum(math.ceil(n / rows_per_file) for n in per_part.values()))
        same = [rows[c].eqNullSafe(sizes[c]) for c in parts]
        salted = rows.join(F.broadcast(sizes), same, "left").select(*[rows[c] for c in rows.columns], "_k").withColumn(
            "_salt", F.pmod(F.xxhash64(*rows.columns), F.col("_k"))
        )
        out = salted.repartition(total, *parts, "_salt").drop("_k", "_salt")
        if sort_by:
            out = out.sortWithinPartitions(*parts, *sort_by)
        return self.write(
            out, "replace", batch_id=batch_id, committed_at=committed_at, operation="compact",
            scope=list(per_part), parent=parent,
        )
