"""Schema contract: fail on shape before anything is written.

The contract is a code-held ``{column: simpleString type}`` mapping.  Walking the
contract and a schema side by side gives one finding per column that differs;
``POLICY`` says what each kind of finding means for the delivery.  Order never
matters (nothing in this library reads by position), and a renamed column shows
as one that is missing and one that was added.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The contract of the landed trip feed (name -> type).
TRIP_CONTRACT: dict[str, str] = {
    "l_orderkey": "bigint",
    "l_linenumber": "int",
    "l_suppkey": "bigint",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_shipdate": "timestamp_ntz",
    "o_orderdate": "timestamp_ntz",
    "o_orderstatus": "string",
    "o_orderpriority": "string",
    "c_acctbal": "double",
}


_SIMPLE_TYPES = {
    "tinyint": T.ByteType(), "smallint": T.ShortType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "binary": T.BinaryType(),
}


def contract_schema(expected: dict[str, str]) -> T.StructType:
    """The contract as a ``StructType`` (flat types; no session needed)."""
    return T.StructType([T.StructField(c, _SIMPLE_TYPES[t]) for c, t in expected.items()])


log = logging.getLogger(__name__)

#: What a finding does to the delivery that shows it.
POLICY = {
    "missing": "refuse", "retyped": "refuse", "added": "accept and log",
    "turned null": "accept and log", "some null": "accept and log", "no null": "accept and log",
}


class Finding(NamedTuple):
    """One column of one source that is not as agreed."""

    source: str
    column: str
    kind: str
    expected: str | None
    actual: str | None

    def __str__(self) -> str:
        if self.kind == "retyped":
            return f"{self.source}: `{self.column}` is {self.actual}, agreed is {self.expected}"
        if self.kind.endswith(" null"):
            return f"{self.source}: `{self.column}` has {self.kind}: {self.actual}, before {self.expected}"
        return f"{self.source}: `{self.column}` ({self.expected or self.actual}) is {self.kind}"


class SchemaContractError(Exception):
    """A delivery that ``POLICY`` refuses (E2); carries its findings."""

    def __init__(self, findings: Iterable[Finding]):
        self.findings = list(findings)
        super().__init__("\n".join(map(str, self.findings)))


def describe_schema(schema: T.StructType) -> dict[str, str]:
    """Contract printer (E4): ``{name: simpleString}`` of a schema."""
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def findings(schema: T.StructType, contract: dict[str, str] = TRIP_CONTRACT, source: str = "input") -> Iterator[Finding]:
    """Every column on which a schema and the contract differ, in one pass by name."""
    found = describe_schema(schema)
    for column in sorted(contract.keys() | found.keys()):
        agreed, got = contract.get(column), found.get(column)
        if agreed != got:
            kind = "missing" if got is None else "added" if agreed is None else "retyped"
            yield Finding(source, column, kind, agreed, got)


def settle(all_findings: Iterable[Finding]) -> list[Finding]:
    """Apply ``POLICY``: raise on anything refused, log and return what is accepted."""
    accepted, refused = [], []
    for f in all_findings:
        (refused if POLICY[f.kind] == "refuse" else accepted).append(f)
    if refused:
        raise SchemaContractError(refused)
    for f in accepted:
        log.warning("%s", f)
    return accepted


def check_schema(df: DataFrame | T.StructType, contract: dict[str, str] = TRIP_CONTRACT, source: str = "input") -> list[Finding]:
    """The accepted findings of one schema; raises ``SchemaContractError`` on refused ones."""
    return settle(findings(df if isinstance(df, T.StructType) else df.schema, contract, source))


def findings_frame(spark: SparkSession, all_findings: Iterable[Finding]) -> DataFrame:
    """Findings as rows: ``source, column, kind, expected, actual`` (one type where only one side has the column: NULL)."""
    rows = [(f.source, f.column, f.kind, *((f.expected, f.actual) if f.kind == "retyped" else (None, None))) for f in all_findings]
    return spark.createDataFrame(rows, "source string, column string, kind string, expected string, actual string")


# ------------------------------------------------------------------ files
_SPARK_SCHEMA = "org.apache.spark.sql.parquet.row.metadata"  # fixed value: where Spark keeps a file's schema


def file_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of one Parquet file: its footer, through Hadoop; no job if Spark wrote the file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(conf, jvm.org.apache.hadoop.fs.Path(path))
    stored = footer.getFileMetaData().getKeyValueMetaData().get(_SPARK_SCHEMA)
    return T.StructType.fromJson(json.loads(stored)) if stored else spark.read.parquet(path).schema


def parquet_files(spark: SparkSession, folder: str) -> list[str]:
    """The Parquet files of one reload unit."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return sorted(str(s.getPath()) for s in path.getFileSystem(conf).listStatus(path) if s.getPath().getName().endswith(".parquet"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per-column NULL counts in one pass (E6): ``column, nulls, rows``.

    Spark marks Parquet columns nullable, so a nullability change is a data
    fact, measured here with one aggregate and unpivoted with ``stack``.
    """
    cols = columns or df.columns
    agg = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)],
    )
    pairs = ", ".join(f"'{c}', __n{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, nulls)", "__rows AS rows")
