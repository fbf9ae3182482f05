"""Target-distribution importance resampling over hashed word n-grams.

Two bags of hashed features are counted over all texts: one of the raw corpus, one
of a target.  A bucket's gain is the (scaled, floored) log of its probability in the
target over that in the corpus; a document's weight is the sum of the gains of its
features.  Gumbel noise drawn from a hash of the id is added to the weight, and the
highest scores are drawn: sampling without replacement in proportion to the
importance weights, the same on every run.

Features are all runs of 1 to 3 consecutive words, joined by one space, repeats
counted; a feature's bucket is the CRC-32 of its bytes modulo ``BUCKETS``.  CRCs
are computed for the distinct features of a run of texts only, and by length: features of
equal length form a two-dimensional array of bytes, all their CRCs advance together
one column of bytes at a time, and each length's results are scattered back to where its
features stand.

Ranks come from a range-partitioned table: the highest classes of scores that hold
enough documents are sorted by ranges, ranges are counted, and a document's rank is its
place in its range plus all that stands in the ranges before.

Defined results: NULL and empty texts have no features, weight 0 and no rank unless
``min_words`` is 0.  A NULL id hashes as the empty string and stands behind all ids of its score.
Repeated rows are counted as often as they occur and get a rank each; where rows agree in score and id but
not in the rest, the smaller weight comes first.  An empty target or corpus gives
gains from the added ones alone.  The memory of a task follows its longest text (some 25
bytes a byte).  Columns of ``docs`` other than id and text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import add_columns, slices, stored

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of one matrix of equally long features, and the rows below which a length is not worth a matrix.
CELLS = 8_000_000
FEW = 16

#: Word bytes as they are, A-Z in lower case, every other byte a space.
SPELLING = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _crc_table() -> np.ndarray:
    """What each byte does to a CRC-32 (polynomial 0xEDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> np.uint32(1)), t >> np.uint32(1))
    return t


CRC = _crc_table()


def crc32_by_length(data: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of many stretches ``data[offset : offset + length]``, lengths of 1 or more."""
    out = np.empty(len(offsets), np.uint32)
    order = np.argsort(lengths, kind="stable")
    ends = np.flatnonzero(np.diff(lengths[order], append=-1)) + 1
    for a, b in zip(np.r_[0, ends[:-1]], ends):
        size = int(lengths[order[a]])
        if b - a < FEW:
            for k in order[a:b]:
                out[k] = zlib.crc32(data[offsets[k] : offsets[k] + size])
            continue
        for i in range(a, b, max(FEW, CELLS // size)):
            rows = order[i : min(b, i + max(FEW, CELLS // size))]
            columns = data[offsets[rows] + np.arange(size)[:, None]]  # one line a column of bytes
            crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
            for column in columns:
                crc = CRC[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
            out[rows] = ~crc
    return out


class Runs(NamedTuple):
    """Bucket and document of every feature of a run of texts; words per document."""

    bucket: np.ndarray
    doc: np.ndarray
    n_words: np.ndarray


def word_runs(texts: list[bytes | None], buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> Runs:
    words = [t.translate(SPELLING).split() if t else [] for t in texts]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    flat = list(chain.from_iterable(words))
    names = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    code = np.fromiter(map(names.__getitem__, flat), np.int64, len(flat))
    size = np.fromiter(map(len, names), np.int64, len(names))[code]
    data = np.frombuffer(b" ".join(flat), np.uint8)
    end = np.cumsum(size + 1) - 1  # where each word ends in ``data``
    start, doc = end - size, np.repeat(np.arange(len(texts)), n_words)

    name, found, owners = code, [], []  # name: the number of the run that starts at a word
    for n in range(1, longest + 1):
        at = np.arange(max(0, len(flat) - n + 1))
        at = at[doc[at] == doc[at + n - 1]]
        run = name[at] if n == 1 else name[at] * len(names) + code[at + n - 1]
        _, first, which = np.unique(run, return_index=True, return_inverse=True)
        where = at[first]
        crc = crc32_by_length(data, start[where], end[where + n - 1] - start[where]) if len(at) else np.zeros(0, np.uint32)
        found.append((crc % np.uint32(buckets)).astype(np.int64)[which])
        owners.append(doc[at])
        name = np.zeros(len(flat), np.int64)
        name[at] = which
    return Runs(np.concatenate(found), np.concatenate(owners), n_words)


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of each bucket in all texts; a task passes on one number a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            texts = b.column(0).cast(pa.binary()).to_pylist()
            for i, j in slices(texts):
                total += np.bincount(word_runs(texts[i:j], buckets).bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r.bucket] = r.n
    return out


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the ratio of the smoothed probabilities) of every bucket."""
    of_all, of_target = float(raw.sum() + len(raw)), float(target.sum() + len(raw))
    return np.array([math.floor(1000 * math.log((t + 1) * of_all / ((s + 1) * of_target))) for t, s in zip(map(float, target), map(float, raw))], np.int64)


def noise(id_col: str, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 8 hex digits of sha256(``seed:id``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_features`` and ``weight`` of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def work(texts: list[bytes | None]) -> list[pa.Array]:
        runs, n = word_runs(texts, len(shared.value)), len(texts)
        weight = np.bincount(runs.doc, shared.value[runs.bucket], n).astype(np.int64)  # whole numbers below 2^53: exact
        return [pa.array(runs.n_words), pa.array(np.bincount(runs.doc, minlength=n)), pa.array(weight)]

    added = {"n_words": T.LongType(), "n_features": T.LongType(), "weight": T.LongType()}
    return add_columns(docs, text_col, added, lambda: work, keep, as_bytes=True)


def score_class(score: str = "score") -> Column:
    """A coarse class that never falls as the score rises: a sixteenth of a doubling of its size."""
    return (F.signum(score) * F.floor(F.log2(F.abs(F.col(score)).cast("double") + 1) * 16)).cast("int")


def ranked(scored: DataFrame, eligible: Column, draws: int) -> DataFrame:
    """A stored table (id, n_features, weight, score, ...) plus ``rank``: 1, 2, ... of the ``draws`` highest scores among the eligible, NULL for the others."""
    spark = scored.sparkSession
    cols, least, room = scored.columns, None, draws
    histogram = scored.where(eligible).groupBy(score_class().alias("class")).agg(F.count(F.lit(1)).alias("n"))
    for r in histogram.orderBy(F.desc("class")).collect():  # some 2,000 classes at most
        if room <= 0:
            break
        least, room = r["class"], room - r.n
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    candidate = F.coalesce(eligible & (score_class() >= least), F.lit(False))
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("weight"), *[F.asc(c) for c in cols if c not in ("score", "id", "weight")]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # equal rows travel as one row and their number, so that no range is one repeated row
    rows = scored.where(candidate).groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
    placed = stored(rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "ranges")
    before, total = [], 0
    for r in placed.groupBy("range").agg(F.sum("copies").alias("n")).orderBy("range").collect():  # one row a range
        before.append((r["range"], total))
        total += r.n
    starts = spark.createDataFrame(before, "range int, before long")
    earlier = F.coalesce(F.sum("copies").over(Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    out = placed.withColumn("earlier", earlier).join(F.broadcast(starts), "range").select(*cols, (F.col("before") + F.col("earlier")).alias("past"), place)
    rank = F.col("past") + F.col("copy")
    out = out.select(*cols, F.when(rank <= draws, rank).alias("rank"))
    return out.unionByName(scored.where(~candidate).withColumn("rank", F.lit(None).cast("long")))


class Resampled(NamedTuple):
    """``rows``: id, n_words, n_features, weight, score, rank of every document; ``gain``: of every bucket; ``draws``: how many are drawn."""

    rows: DataFrame
    gain: np.ndarray
    draws: int


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> Resampled:
    """Draw ``percent`` of the documents with ``min_words`` words or more, by importance towards ``target``."""
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    gain = gains(bucket_counts(target, target_text), bucket_counts(plain))
    scored = stored(weigh(plain, gain, keep=["id"]).withColumn("score", F.col("weight") + noise("id", seed)), "importance")
    eligible = F.col("n_words") >= min_words
    draws = percent * scored.where(eligible).count() // 100
    return Resampled(ranked(scored, eligible, draws), gain, draws)


def drawn_documents(docs: DataFrame, result: Resampled, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn documents with all their columns; no text is shuffled.

    Every text is weighed again and compared with the last rank drawn.  Rows that
    share id and score with that one are all returned.
    """
    last = result.rows.where(F.col("rank") == result.draws).select("score", "id").head()
    if last is None:
        return docs.limit(0)
    numbered = docs.select(*[F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    rows = weigh(numbered, result.gain, at[text_col]).withColumn("score", F.col("weight") + noise(at[id_col], seed))
    here = F.col(at[id_col])
    not_behind = here.isNull() | here.isNotNull() if last["id"] is None else F.coalesce(here <= F.lit(last["id"]), F.lit(False))
    inside = (F.col("n_words") >= min_words) & ((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & not_behind))
    return rows.where(inside).select(*[F.col(d).alias(c) for c, d in at.items()])
