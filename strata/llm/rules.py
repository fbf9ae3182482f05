"""Quality rules: word statistics, and a hashed n-gram likelihood ratio.

Two multinomials over ``BUCKETS`` hashed features are counted over all texts:
one of the trusted target (every document labelled good), one of the raw corpus (every document).  A document's score is the mean over its features of
log(p_target / p_raw): length-normalised, so that one threshold holds for
every length.  Every document is decided by the same comparison.

Features of a word are the word's n-grams of characters (1 to 3, with its borders),
in a spelling that keeps case and symbols: junk shows in how words are
written.  Each occurrence counts.  Counts are smoothed by ``PRIOR`` per bucket.

Defined results: NULL and empty texts have no words, fail the base rules (too
few words) and have score 0.  Repeated rows are counted as often as they occur;
a document with several labels is in the target if any of them is 1.
Extra columns pass through; one named like an added one is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import add_columns, coded_words, mix64, slices, stored

BUCKETS = 16_384
PRIOR = 0.5
#: Ids of the target that are broadcast (some 60 bytes each); with more of them texts meet their ids by a shuffle.
BROADCAST_IDS = 8_000_000
#: A document is kept when its score is at least this (natural logarithm per feature).
THRESHOLD = -0.25
#: The base rules.
SYMBOLS = re.compile(r"[#*$%&|<>]")
MIN_WORDS = 50
MAX_REPEAT = 50
#: Columns that the operator adds.
ADDED = {
    "n_words": T.LongType(), "word_chars": T.LongType(), "n_symbols": T.LongType(), "n_dup_lines": T.LongType(),
    "n_repeat_words": T.LongType(), "base_failed": T.BooleanType(), "score": T.DoubleType(), "kept": T.BooleanType(),
}


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    raw = (text or "").encode()
    words = raw.split()
    lines = Counter(line for line in raw.split(b"\n") if line.split())
    n_words = len(words)
    white = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    return n_words, len(text or "") - white, len(SYMBOLS.findall(text or "")), sum(lines.values()) - len(lines), repeat_words(words)


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that stand twice or more in the text."""
    if len(words) < width:
        return 0
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    c = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    names = c[: len(c) - width + 1]
    for j in range(1, width):  # the rank of a longer and longer run: exact, whatever the number of words
        names = np.unique(names * len(codes) + c[j : len(c) - width + 1 + j], return_inverse=True)[1].ravel()
    twice = np.bincount(names)[names] > 1
    covered = np.zeros(len(words), bool)
    for j in range(width):
        covered[j : j + len(twice)] |= twice
    return int(covered.sum())


# -------------------------------------------------------------- features
def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of many words, and the word of each."""
    spelled = [f"\x02{w.decode()}\x03" for w in words]
    chars = np.frombuffer("".join(spelled).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) for w in spelled], np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.cumsum(lengths)[word] - np.arange(len(chars))  # characters from here to the word's end
    h, buckets, owners = np.zeros(len(chars), np.uint64), [], []
    for n in (1, 2, 3):
        h = mix64(h[: max(0, len(chars) - n + 1)] * np.uint64(3) + chars[n - 1 :])
        inside = left[: len(h)] >= n
        buckets.append((mix64(h[inside] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(word[: len(h)][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def trusted(good: DataFrame, size: int | None = None) -> DataFrame:
    """The ids of the target (good_id), each once: all of them, or about ``size`` if a caller asks for a sample, those of the least hashes."""
    ids = good.select(F.col(f"`{good.columns[0]}`").alias("good_id")).where("good_id IS NOT NULL").distinct()
    found = stored(ids, "trusted")
    if size is None:
        return found
    share = min(1.0, size / max(1, found.count()))
    return found.where(F.pmod(F.xxhash64(F.lit("trusted"), "good_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def ngram_counts(docs: DataFrame, good: DataFrame, id_col: str, text_col: str, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """(bucket, target, raw): occurrences in the documents whose id is in ``good``, and in all.

    Every document of ``good`` counts.  Up to ``broadcast_ids`` ids are broadcast, so that no text is shuffled; more
    are joined by a shuffle, with the same counts.
    """
    ids = trusted(good)
    ids = F.broadcast(ids) if ids.count() <= broadcast_ids else ids.hint("merge")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    flagged = rows.join(ids, F.col("id") == F.col("good_id"), "left").select(F.col("good_id").isNotNull().alias("good"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS))
        for b in batches:
            good, texts = np.asarray(b.column(0).to_pylist(), bool), b.column(1).cast(pa.binary()).to_pylist()
            for i, j in slices(texts):
                words, codes, starts = coded_words(texts[i:j])
                if words:
                    buckets, owner = features(words)
                    by_good = np.repeat(good[i:j], np.diff(starts))
                    for k, part in enumerate((codes[by_good], codes)):
                        total[k] += np.bincount(buckets, np.bincount(part, minlength=len(words))[owner], BUCKETS)
        some = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(t[some].astype(np.int64)) for t in total)], ["bucket", "target", "raw"])

    counts = flagged.mapInArrow(count, "bucket long, target long, raw long")
    return counts.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log(p_target / p_raw) of each of the BUCKETS buckets."""
    found = counts.toPandas()
    n = np.zeros((2, BUCKETS))
    n[:, found["bucket"]] = found[["target", "raw"]].to_numpy(float).T
    p = np.log(n + PRIOR) - np.log((n + PRIOR).sum(axis=1, keepdims=True))
    return p[0] - p[1] if n[0].sum() else np.zeros(BUCKETS)


def apply_rules(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus the columns of ``ADDED``; ``good`` holds the ids of the trusted target."""
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(log_ratios(ngram_counts(docs, good, id_col, text_col)))

    def judge(texts: list[str | None]) -> list[pa.Array]:
        n = len(texts)
        numbers = [statistics(t) for t in texts]
        words, codes, starts = coded_words([t.encode() if t else b"" for t in texts])
        sums = counts = np.zeros(n)
        if words:
            buckets, owner = features(words)
            doc = np.repeat(np.arange(n), np.diff(starts))
            sums, counts = (np.bincount(doc, v[codes], n) for v in (np.bincount(owner, shared.value[buckets], len(words)), np.bincount(owner, minlength=len(words))))
        scores = np.round(sums / np.maximum(counts, 1), 9)
        failed = np.array([x[0] < MIN_WORDS or 100 * x[4] > MAX_REPEAT * x[0] for x in numbers], bool)
        return [pa.array([x[k] for x in numbers], pa.int64()) for k in range(5)] + [pa.array(failed), pa.array(scores), pa.array(~failed & (scores >= threshold))]

    return add_columns(docs, text_col, ADDED, lambda: judge, keep)
