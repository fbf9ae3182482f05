"""Language ID by bit-sliced Bloom filters of character n-grams.

One filter per language, stored slice by slice: slot ``s`` holds one bit per
language.  The n-grams of a text address ``HASHES`` slots each; the AND of
their masks is the set of languages that have the n-gram, for all languages at
once.  Per language, the set bits are counted over all n-grams of the text,
corrected for the filter's false positives, and the largest count decides.

An n-gram is put into the filter of a language when it makes up at least
``SHARE`` of that language's n-grams and is not at least ``CONTRAST`` times as
frequent in some other: texts are labelled by their main language and may quote others.
The counts behind this cover all learning documents and are added up by Spark;
only the slots, whose number is fixed, reach the driver and the workers.

A language's corrected count is (c - n * f) / (1 - f), with c bits among n
n-grams and f the chance that an absent n-gram finds all its slots set.  The
score is the decided language's share of all corrected counts.

Defined results: ``und`` with score 0 where the text is NULL or has no letter, or
no language was learned; ties, and texts without any known n-gram (score 0), go to
the language that sorts first.  Repeated
rows count as often as they occur in learning.  Extra columns pass through, one named
like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import add_columns, mix64, slices, stored

SLOTS = 1 << 20
HASHES = 3
#: Lengths of the n-grams, borders of words included.
LENGTHS = (1, 2, 3, 4)
SHARE = 2e-6
CONTRAST = 3.0
#: A learning task adds n-grams up until it holds that many distinct ones.
HELD = 500_000
ADDED = {"lang_pred": T.StringType(), "score": T.DoubleType()}

#: Words: runs of letters and marks.
_LETTERS = regex.compile(r"[\p{L}\p{M}]+")
_HAS_LETTER = regex.compile(r"\p{L}")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of the n-grams of many words, and the word of each."""
    spelled = [f" {w} " for w in words]
    chars = np.frombuffer("".join(spelled).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) for w in spelled], np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.cumsum(lengths)[word] - np.arange(len(chars))
    h, names, owners = np.zeros(len(chars), np.uint64), [], []
    for n in range(1, max(LENGTHS) + 1):
        h = mix64(h[: max(0, len(chars) - n + 1)] * np.uint64(3) + chars[n - 1 :])
        if n in LENGTHS:
            inside = left[: len(h)] >= n
            if n == 1:
                inside &= chars != ord(" ")
            names.append(mix64(h[inside] + np.uint64(n)))
            owners.append(word[: len(h)][inside])
    return np.concatenate(names), np.concatenate(owners)


def coded_runs(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of many texts, the code of every word, and its text."""
    codes: dict[str, int] = {}
    parts, sizes = [], []
    for t in texts:
        words = words_of(t) if t else []
        for w in set(words).difference(codes):
            codes[w] = len(codes)
        parts.append(np.fromiter(map(codes.__getitem__, words), np.int64, len(words)))
        sizes.append(len(words))
    return list(codes), np.concatenate(parts) if parts else np.zeros(0, np.int64), np.repeat(np.arange(len(texts)), sizes)


def ngram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, ngram, n) over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            for lang, (names, numbers) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names)), pa.array(names.view(np.int64)), pa.array(numbers)], ["lang", "ngram", "n"])
            held.clear()

        for b in batches:
            texts, langs = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), dtype=object)
            for i, j in slices(texts):
                words, codes, row = coded_runs(texts[i:j])
                if not words:
                    continue
                names, owner = ngrams(words)
                of = langs[i:j][row]
                for lang in sorted(set(langs[i:j])):
                    times = np.bincount(codes[of == lang], minlength=len(words))[owner]
                    old = held.get(lang, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
                    at, distinct = pd.factorize(np.concatenate([old[0], names[times > 0]]))
                    held[lang] = distinct, np.bincount(at, np.concatenate([old[1], times[times > 0]]), len(distinct)).astype(np.int64)
                if sum(len(x) for x, _ in held.values()) > HELD:
                    yield from flush()
        yield from flush()

    counts = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    return counts.mapInArrow(count, "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))


def slot_numbers(names: np.ndarray, slots: int, hashes: int) -> np.ndarray:
    """The slots of each n-gram, one row per hash: multiples of a step from a start, both parts of its (mixed) name.

    ``slots`` is a power of two, and the step odd.
    """
    start, step = names, (names >> np.uint64(32)) | np.uint64(1)
    return np.stack([((start + np.uint64(k) * step) & np.uint64(slots - 1)).view(np.int64) for k in range(hashes)])


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", slots: int = SLOTS, hashes: int = HASHES, share: float = SHARE, contrast: float = CONTRAST):
    """(languages, masks, false positive rates): masks is slots x words of 64 languages."""
    if slots & (slots - 1):
        raise ValueError("slots must be a power of two")
    counts = stored(ngram_counts(docs, text_col, lang_col), "language-ngrams")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()}
    langs = sorted(totals)
    masks = np.zeros((slots, max(1, -(-len(langs) // 64))), np.uint64)
    if langs:
        spark = docs.sparkSession
        sizes = spark.createDataFrame([(k, i, float(totals[k])) for i, k in enumerate(langs)], "lang string, bit int, total double")
        rates = counts.join(F.broadcast(sizes), "lang").select("ngram", "bit", (F.col("n") / F.col("total")).alias("rate"))
        best = rates.groupBy("ngram").agg(F.max("rate").alias("best"), F.collect_list(F.struct("bit", "rate")).alias("langs"))
        kept = best.select("ngram", "best", F.explode("langs").alias("l")).where((F.col("l.rate") >= share) & (F.col("l.rate") * contrast >= F.col("best")))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bits = np.asarray(b.column(1)).astype(np.int64)
                at = slot_numbers(np.asarray(b.column(0)).view(np.uint64), slots, hashes)
                yield pa.RecordBatch.from_arrays([pa.array(at.ravel()), pa.array(np.tile(bits // 64, hashes)), pa.array(np.tile(np.left_shift(np.int64(1), bits % 64), hashes))], ["slot", "word", "mask"])

        placed = kept.select("ngram", "l.bit").mapInArrow(place, "slot long, word long, mask long")
        part = placed.groupBy("slot", "word").agg(F.expr("bit_or(mask)").alias("mask")).toPandas()  # at most a row per slot and 64 languages
        masks[part["slot"].to_numpy(), part["word"].to_numpy()] = part["mask"].to_numpy().view(np.uint64)
    fill = np.array([((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))])
    return langs, masks, fill**hashes


def predict(docs: DataFrame, model, text_col: str = "text", hashes: int = HASHES, keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(texts: list[str | None]) -> list[pa.Array]:
        langs, masks, false = shared.value
        words, codes, row = coded_runs(texts)
        counts, total = np.zeros((len(texts), len(langs))), np.zeros(len(texts))
        if words and langs:
            names, owner = ngrams(words)
            found = np.bitwise_and.reduce(masks[slot_numbers(names, len(masks), hashes)], axis=0)
            total = np.bincount(row, np.bincount(owner, minlength=len(words))[codes], len(texts))
            for k in range(len(langs)):
                bits = ((found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).astype(float)
                counts[:, k] = np.bincount(row, np.bincount(owner, bits, len(words))[codes], len(texts))
        true = np.maximum(0, (counts - total[:, None] * false) / (1 - np.minimum(false, 0.999)))
        lettered = [bool(langs) and bool(t) and _HAS_LETTER.search(t) is not None for t in texts]
        named = [langs[int(c.argmax())] if ok else "und" for ok, c in zip(lettered, true, strict=True)]
        scores = [float(c.max() / c.sum()) if ok and c.sum() else 0.0 for ok, c in zip(lettered, true, strict=True)]
        return [pa.array(named, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(docs, text_col, ADDED, lambda: decide, keep)
