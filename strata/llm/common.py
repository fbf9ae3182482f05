"""Helpers several operators share: words, row keys, folds, the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import zipfile
from collections import defaultdict
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word: a run of characters that are not ASCII white space.  On UTF-8 bytes
#: this is exactly what ``bytes.split()`` yields.
WORD = r"[^\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on every executor (once per application).

    Python functions of these modules are pickled by reference, so workers must
    be able to import them even when the driver put the repository on its own
    ``sys.path`` only.  The zip travels with Spark's own ``addPyFile``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    Read from the session.  Only a session without it (local tests) gets a
    private one, which is then set as the context's checkpoint folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    d = d or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp())
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage: what was written is read, not recomputed, when an
    executor is lost.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def most_frequent(counts: DataFrame, size: int, n: str = "n") -> DataFrame:
    """The most frequent rows of a stored table of counts, ``size`` at most.

    A histogram of frequency classes (a sixteenth of a doubling) gives the least
    class that still fits; a class is in or out as a whole.  A sorted limit would send
    ``size`` rows of every task to the driver instead.
    """
    frequency = F.floor(F.log2(n) * 16).cast("int")
    least = 1 << 30
    for r in counts.groupBy(frequency.alias("class")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("class")).collect():
        size -= r.rows
        if size < 0:
            break
        least = r["class"]
    return counts.where(frequency >= least)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5, is 0.  A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


# ------------------------------------------------------------------ a worker's memory
_CACHES: dict[str, list[dict]] = {}


def worker_cache(owner: str) -> dict:
    """A dict that a Python worker keeps from task to task, as long as its tasks are of ``owner``."""
    _CACHES.setdefault(owner, []).append({})
    return _CACHES[owner][-1]


def forget(but: str = "") -> None:
    """Empty the caches of all owners but one: Spark gives a worker to one operator after another."""
    for owner, caches in _CACHES.items():
        if owner != but:
            for c in caches:
                c.clear()


def give_back() -> None:
    """Return what is free to the system; the allocators would keep it for as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: What a value that is no text counts in a run of rows.
TYPICAL = 4_000


def slices(texts: list, max_chars: int = 2_000_000):
    """Cut a batch of texts into runs of about ``max_chars`` characters, in order.

    Bounds what a Python task holds at once; a longer text is a run of its own.
    """
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if isinstance(t, (str, bytes)) else TYPICAL
        if i > start and size + n > max_chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def coded_words(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts -> distinct words, the code of every word, and where each text starts."""
    codes: defaultdict[bytes, int] = defaultdict()
    codes.default_factory = codes.__len__  # a new word gets the next number
    parts, starts = [], np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        words = (t or b"").split()
        parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
        starts[i + 1] = starts[i] + len(words)
    return list(codes), np.concatenate(parts) if parts else np.zeros(0, np.int32), starts


def add_columns(df: DataFrame, read: str, added: dict[str, T.DataType], make: Callable, keep: list[str] | None = None, as_bytes: bool = False, max_chars: int = 2_000_000, cache: str = "") -> DataFrame:
    """``df`` (its columns ``keep``, all by default) plus columns made of column ``read``, in runs of rows.

    ``make()`` is called once per task and gives a function from the values of a run to the
    arrays of ``added``; ``as_bytes`` hands strings over as UTF-8; a run has about ``max_chars``.  A column named as an
    added one is replaced.  Columns travel under numbers, so that any names will do.  Of the worker
    caches, only those of ``cache`` stay.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in added]
    at = keep.index(read) if read in keep else len(keep)
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep + [read] * (at == len(keep)))])
    schema = T.StructType([rows.schema[i] for i in range(len(keep))] + [T.StructField(k, v) for k, v in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(but=cache)
        work = make()
        for b in batches:
            values = b.column(at)
            values = (values.cast(pa.binary()) if as_bytes else values).to_pylist()
            for i, j in slices(values, max_chars):
                yield pa.RecordBatch.from_arrays([b.column(k).slice(i, j - i) for k in range(len(keep))] + work(values[i:j]), schema.fieldNames())
        give_back()

    return rows.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *added)


# ------------------------------------------------------------------ hashing
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an array of 64-bit values."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """The upper 53 bits of 64-bit values as doubles in [0, 1)."""
    return (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))
