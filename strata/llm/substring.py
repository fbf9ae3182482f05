"""Substring dedup by super-k-mer partitioning.

A window is ``k`` consecutive words of one document.  A word goes when a window
covers it whose word sequence also starts earlier: in a document with a smaller
id, or further up in the same one.  All windows of the input are judged.

Every window has a minimiser: among its runs of ``M`` words, the one with the
smallest hash.  Consecutive windows with the same minimiser share most of their
words, so they travel together as one packed string to the bucket that
the minimiser names, and equal windows always meet there.  (Its words are written as
numbers: of a broadcast list of frequent words, or of a list packed with it.)  In a
bucket the windows are sorted and equal neighbours compared word by word; all
but the first of equal windows are reported as removed ranges of words.

Hot passages.  Runs of words that are frequent in the whole corpus
(found in a pass of their own, as at least ``1 / HOT`` of the runs of some task)
are chosen as minimisers only by windows made of them alone.  A window that
reaches beyond a common line thus follows its other words, and the windows inside the
line form the same packed string wherever the line stands; equal strings are sent once
per task, from the earliest place, and the later ones are reported at once.
So a bucket gets a passage at most once per task.

Rows of one document.  Documents are ordered by id, NULL last, then by the hash of
the text; rows with the same id and text are one document and get the same
answer.  NULL and texts without words keep nothing; texts below ``k`` words keep all.
Extra columns pass through, one named like an added one is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import add_columns, coded_words, give_back, mix64, most_frequent, slices, stored

K = 20
#: Words of a minimiser.
M = 3
#: A run of words is hot when it makes up 1 / HOT of the runs of a task, or of all.
HOT = 4_096
#: Windows a bucket holds on average; the number of buckets follows from it.
WINDOWS_PER_BUCKET = 600_000
MIN_BUCKETS = 256
#: Characters of the texts that a task cuts into super-k-mers together.
SLICE = 24_000_000
#: Words whose super-k-mers are found together.
TOGETHER = 100_000
#: Frequent words that every worker knows by number (about 2 MB).
FREQUENT = 65_536
#: Columns that remove_repeats adds.
ADDED = ("n_words", "n_removed", "kept")

_LAST = np.iinfo(np.int64).max


# ------------------------------------------------------------------- words
def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)


def run_hashes(hashes: np.ndarray, m: int) -> np.ndarray:
    """A hash of each run of ``m`` neighbours (the order of the words matters)."""
    n = len(hashes) - m + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(m):
        out = mix64(out * np.uint64(3) + hashes[j : j + n])
    return out


def _minimum_over(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in each window of ``width`` values."""
    n = len(values) - width + 1
    best = np.arange(len(values))
    have = 1
    while have < width:  # windows of doubling width
        step = min(have, width - have)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        have += step
    return best[:n]


def _within(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether ``size`` neighbours from each of the first ``n`` places lie in one text."""
    crossing = np.zeros(n + 1, np.int32)  # +1 where places begin that reach over the end of their text, -1 behind
    ends = starts[1:]
    np.add.at(crossing, np.clip(np.maximum(ends - size + 1, starts[:-1]), 0, n), 1)
    np.add.at(crossing, np.clip(ends, 0, n), -1)
    return np.cumsum(crossing[:n]) == 0


def super_kmers(hashes: np.ndarray, hot: np.ndarray, k: int = K, m: int = M, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of texts -> first window, number of windows and minimiser of each super-k-mer.

    ``starts``: where the texts begin, and the end of the last; one text if not given.
    """
    if len(hashes) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = run_hashes(hashes, m)
    order = runs >> np.uint64(1)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, runs), len(hot) - 1)
        order = np.where(hot[at] == runs, order | np.uint64(1 << 63), order)
    chosen = runs[_minimum_over(order, k - m + 1)]
    starts = np.array([0, len(hashes)]) if starts is None else starts
    windows = np.flatnonzero(_within(starts, k, len(chosen)))
    if not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # another minimiser begins a super-k-mer, and so does another text, whose windows never follow on
    head = np.concatenate([[True], (chosen[windows][1:] != chosen[windows][:-1]) | (np.diff(windows) > 1)])
    first = np.flatnonzero(head)
    return windows[first], np.diff(np.append(first, len(windows))), chosen[windows[first]]


# --------------------------------------------------------- the map side
def _place(id_col: str, text_col: str) -> list[Column]:
    """What names a document, in the order of documents: its id, NULL last, and the hash of its text."""
    version = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST)).alias("doc"), version.alias("version")]


def _frequent(names: np.ndarray, numbers: np.ndarray, seen: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Counted values with those newly seen, without what stays below ``least``."""
    values, at = np.unique(np.concatenate([names, *seen]), return_inverse=True)
    counts = np.bincount(at[len(names) :], minlength=len(values)).astype(np.int64)
    counts[at[: len(names)]] += numbers
    return values[counts >= least], counts[counts >= least]


def corpus_statistics(docs: DataFrame, text_col: str = "text", hot: int = HOT, size: int = FREQUENT, k: int = K, m: int = M) -> tuple[np.ndarray, list[bytes], int]:
    """Hashes of the hot runs, sorted; frequent words, the most frequent first; the number of windows.

    A run with a share of 1 / hot of all runs has that share in at least one task, so
    each task passes on only the few runs that have half of it there, and
    of the words a Misra-Gries summary of ``size / 2`` counters.  Both lists only
    decide how things travel.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, numbers, seen = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        held = total = windows = 0
        often: Counter[bytes] = Counter()
        for b in batches:
            texts = b.column(0).cast(pa.binary()).to_pylist()
            for i, j in slices(texts, SLICE // 3):
                words, codes, starts = coded_words(texts[i:j])
                often.update(dict(zip(words, np.bincount(codes, minlength=len(words)).tolist(), strict=True)))
                if len(often) > size // 2:
                    floor = np.partition(np.fromiter(often.values(), np.int64, len(often)), -(size // 2) - 1)[-(size // 2) - 1]
                    often = Counter({w: n - int(floor) for w, n in often.items() if n > floor})
                hashes = word_hashes(words)[codes]
                runs = run_hashes(hashes, m)
                seen.append(runs[_within(starts, m, len(runs))])
                held += len(seen[-1])
                total += len(seen[-1])
                windows += int(np.maximum(0, np.diff(starts) - k + 1).sum())
                if held > 2_000_000:
                    names, numbers = _frequent(names, numbers, seen, total / (2 * hot))
                    seen, held = [], 0
        names, numbers = _frequent(names, numbers, seen, max(1, total / (2 * hot)))
        rows = [(None, None, total, windows), *((r, None, n, 0) for r, n in zip(names.view(np.int64).tolist(), numbers.tolist(), strict=True)), *((None, w, n, 0) for w, n in often.items())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["run", "word", "n", "windows"])

    per_task = docs.select(F.col(f"`{text_col}`")).mapInArrow(count, "run long, word binary, n long, windows long")
    summed = stored(per_task.groupBy("run", "word").agg(F.sum("n").alias("n"), F.sum("windows").alias("windows")), "substring-statistics")
    totals = summed.where("run IS NULL AND word IS NULL").first()
    if totals is None:
        return np.zeros(0, np.uint64), [], 0
    runs = summed.where(F.col("run").isNotNull() & (F.col("n") * hot >= totals.n)).select("run").collect()  # `hot` rows at most
    words = most_frequent(summed.where("word IS NOT NULL"), size).select("word", "n").collect()
    return np.sort(np.array([r.run for r in runs], np.int64).view(np.uint64)), [bytes(r.word) for r in sorted(words, key=lambda r: (-r.n, r.word))], totals.windows


# Substring hashes: a polynomial modulo 2^64, read off prefix sums.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def substring_hashes(values: np.ndarray, at: np.ndarray, size) -> np.ndarray:
    """A hash of ``values[at : at + size]`` for every place, the same wherever the substring stands."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(len(values), _BASE), dtype=np.uint64)])
    return (sums[at + size] - sums[at]) * _powers(len(values) + 1, _INVERSE)[at]


def _planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second bytes, and so on: alike bytes stand together and compress well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _pack(doc, version, start, size, codes, words, own) -> bytes:
    """Super-k-mers of one bucket and task: their places, and their words as codes.

    ``codes`` below ``own`` name frequent words; the others name ``words[code - own]``, and
    are coded anew by the list of those that occur here.
    """
    used, local, times = np.unique(codes[codes >= own], return_inverse=True, return_counts=True)
    by = np.argsort(-times, kind="stable")
    rank = np.empty(len(by), np.uint32)
    rank[by] = np.arange(len(by), dtype=np.uint32)
    codes = codes.astype(np.uint32)
    codes[codes >= own] = own + rank[local]
    text = b" ".join([words[c - own] for c in used[by].tolist()])
    parts = [np.asarray(doc, np.int64), np.asarray(version, np.int64), np.asarray(start, np.int32), np.asarray(size, np.int32), codes]
    head = np.array([len(doc), len(codes), len(text)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(map(_planes, parts)) + text)


def _unpack(packed: bytes):
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n, n_codes, n_text = np.frombuffer(raw, np.int64, 3).tolist()
    out, at = [], 24
    for kind, length in ((np.int64, n), (np.int64, n), (np.int32, n), (np.int32, n), (np.uint32, n_codes)):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, length * width, at).reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += length * width
    return *out, raw[at : at + n_text].split()


_SENT = "bucket long, packed binary, gone binary"
_RANGE = np.dtype([("doc", np.int64), ("version", np.int64), ("first", np.int32), ("last", np.int32)])


def _grouped(bucket: np.ndarray):
    """(bucket, its rows) for each bucket."""
    by = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], bucket[by][1:] != bucket[by][:-1], [True]]))
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(bucket[by[a]]), by[a:z]


def _leads(name: np.ndarray, at: np.ndarray, size: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """For each string, in the order of names, the first equal one; strings are compared, not only names."""
    head = np.concatenate([[True], name[1:] != name[:-1]])
    lead = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    dup = np.flatnonzero(~head)
    differ = size[dup] != size[lead[dup]]
    for a in range(0, len(dup), 20_000):
        i, n = dup[a : a + 20_000], np.where(differ[a : a + 20_000], 0, size[dup[a : a + 20_000]])
        ends = np.cumsum(n)
        step = np.arange(int(ends[-1])) - np.repeat(ends - n, n)
        unlike = codes[np.repeat(at[i], n) + step] != codes[np.repeat(at[lead[i]], n) + step]
        differ[a : a + 20_000] |= np.bincount(np.repeat(np.arange(len(i)), n)[unlike], minlength=len(i)) > 0
    for i in dup[differ].tolist():  # another string of the same name: none of its equals is looked for, which is rare and safe
        lead[i] = i
    return lead


def _send(doc, version, texts, hot, frequent: dict[bytes, int], buckets: int, k: int, m: int) -> Iterator[tuple]:
    """(bucket, packed super-k-mers or None, removed ranges or None) of a run of documents."""
    words, codes, starts = coded_words(texts)
    hashes = word_hashes(words)[codes]
    found, a = [], 0
    while a < len(starts) - 1:  # texts of about TOGETHER words at once
        z = max(a + 1, int(np.searchsorted(starts, starts[a] + TOGETHER, "right")) - 1)
        at, n, minimiser = super_kmers(hashes[starts[a] : starts[z]], hot, k, m, starts[a : z + 1] - starts[a])
        found.append((starts[a] + at, n, minimiser))
        a = z
    at, n, minimiser = (np.concatenate(x) for x in zip(*found, strict=True))
    if not len(at):
        return
    row = np.searchsorted(starts, at, "right") - 1
    first, size = at - starts[row], n + k - 1
    name = substring_hashes(hashes, at, size) + size.astype(np.uint64)
    order = np.lexsort((first, version[row], doc[row], name))
    row, first, size, at, minimiser, name = (x[order] for x in (row, first, size, at, minimiser, name))
    place = np.empty(len(row), _RANGE)
    place["doc"], place["version"], place["first"], place["last"] = doc[row], version[row], first, first + size
    sent, lead = np.ones(len(row), bool), _leads(name, at, size, codes)
    sent[lead != np.arange(len(lead))] = False
    gone = ~sent  # but for the same place in a repeated row, which is no earlier start
    gone[gone] = (doc[row[gone]] != doc[row[lead[gone]]]) | (version[row[gone]] != version[row[lead[gone]]]) | (first[gone] != first[lead[gone]])
    for bucket, rows in _grouped((mix64(place["doc"][gone].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)) if gone.any() else ():
        yield bucket, None, place[gone][rows].tobytes()
    named = np.array([frequent.get(w, -1) for w in words], np.int64)
    named = np.where(named < 0, len(frequent) + np.arange(len(words)), named)[codes]
    kept = np.flatnonzero(sent)
    kept = kept[np.lexsort((first[kept], doc[row[kept]]))]
    for bucket, rows in _grouped((mix64(minimiser[kept]) % np.uint64(buckets)).astype(np.int64)):
        r = kept[rows]
        took = np.repeat(at[r] - np.cumsum(size[r]) + size[r], size[r]) + np.arange(int(size[r].sum()))
        yield bucket, _pack(doc[row[r]], version[row[r]], first[r], size[r], named[took], words, len(frequent)), None


def _removed(packed: list[bytes], own: int, k: int) -> np.ndarray:
    """Sort all windows of a bucket; the ranges covered by those that start earlier, too."""
    known: dict[bytes, int] = {}  # the words that are not frequent, by their code in this bucket
    parts = []
    for p in packed:
        doc, version, start, size, codes, words = _unpack(p)
        for w in words:
            known.setdefault(w, own + len(known))
        here = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        codes = codes.astype(np.int64)
        codes[codes >= own] = here[codes[codes >= own] - own]
        parts.append((doc, version, start, size, codes))
    doc, version, start, size, codes = (np.concatenate(x) for x in zip(*parts, strict=True))
    ends = np.cumsum(size)
    n = size - k + 1
    which = np.repeat(np.arange(len(size)), n)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    at = (ends - size)[which] + offset
    name = substring_hashes(mix64(codes.astype(np.uint64)), at, k)
    by = np.argsort(name, kind="stable")
    same = name[by][1:] == name[by][:-1]
    twice = by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]  # windows with an equal neighbour
    if not len(twice):
        return np.empty(0, _RANGE)
    which, place, name = which[twice], start[which[twice]] + offset[twice], name[twice]
    window = codes.astype(np.int32)[at[twice][:, None] + np.arange(k)]
    for exact in (False, True):
        order = np.lexsort((place, version[which], doc[which], name))
        head = np.concatenate([[True], name[order][1:] != name[order][:-1]])
        lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        if exact or (window[order] == window[lead]).all():
            break
        name = np.unique(window, axis=0, return_inverse=True)[1].ravel()  # two windows with one hash: sort the words themselves
    out = np.empty(len(order), _RANGE)
    out["doc"], out["version"], out["first"], out["last"] = doc[which[order]], version[which[order]], place[order], place[order] + k
    leads = np.empty_like(out)
    leads["doc"], leads["version"], leads["first"], leads["last"] = doc[which[lead]], version[which[lead]], place[lead], place[lead] + k
    return out[out != leads]


def _joined(ranges: np.ndarray) -> np.ndarray:
    """Ranges of each document, overlapping ones as one."""
    if not len(ranges):
        return ranges
    r = ranges[np.lexsort((ranges["first"], ranges["version"], ranges["doc"]))]
    new_doc = np.concatenate([[True], (r["doc"][1:] != r["doc"][:-1]) | (r["version"][1:] != r["version"][:-1])])
    # ends so far within the document: documents are lifted apart, so that one running maximum serves all
    lift = np.cumsum(new_doc).astype(np.int64) << np.int64(32)
    reach = np.maximum.accumulate(lift + r["last"])
    head = np.concatenate([[True], (lift + r["first"])[1:] > reach[:-1]])
    out = r[head].copy()
    out["last"] = (reach & np.int64(0xFFFFFFFF))[np.append(np.flatnonzero(head)[1:] - 1, len(r) - 1)]
    return out


def removed_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, m: int = M, hot: int = HOT, per_bucket: int = WINDOWS_PER_BUCKET) -> DataFrame:
    """(doc, version, ranges): the removed words of each document, as ranges [first, last)."""
    runs, frequent, windows = corpus_statistics(docs, text_col, hot, k=k, m=m)
    buckets, own = max(MIN_BUCKETS, windows // per_bucket), len(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((runs, frequent))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, frequent = shared.value
        code = {w: i for i, w in enumerate(frequent)}
        for b in batches:
            texts = b.column(2).cast(pa.binary()).to_pylist()
            doc, version = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for i, j in slices(texts, SLICE):
                rows = list(_send(doc[i:j], version[i:j], texts[i:j], runs, code, buckets, k, m))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["bucket", "packed", "gone"])
        give_back()

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        packed = [p for p in rows["packed"] if p is not None]
        found = [np.frombuffer(g, _RANGE) for g in rows["gone"] if g is not None]
        out = _joined(np.concatenate([np.empty(0, _RANGE), *found] + ([_removed(packed, own, k)] if packed else [])))
        return pd.DataFrame({c: out[c] for c in _RANGE.names})

    sent = docs.select(*_place(id_col, text_col), F.col(f"`{text_col}`").alias("text")).mapInArrow(send, _SENT)
    ranges = sent.groupBy("bucket").applyInPandas(judge, "doc long, version long, first int, last int")
    return ranges.groupBy("doc", "version").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, **options) -> DataFrame:
    """``docs`` (its columns ``keep``, all by default) plus ``n_words``, ``n_removed`` and ``kept`` (kept words joined by one space)."""
    ranges = removed_ranges(docs, id_col, text_col, **options)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ADDED]
    others = [c for c in keep if c != text_col]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], *_place(id_col, text_col), F.col(f"`{text_col}`").alias("text"))
    squeezed = add_columns(rows, "text", {"squeezed": T.BinaryType()}, _squeeze, rows.columns[:-1], as_bytes=True)  # the only text that is shuffled
    joined = squeezed.join(ranges, ["doc", "version"], "left").select(*rows.columns[: len(others)], F.struct("squeezed", "ranges").alias("cut"))
    out = add_columns(joined, "cut", {"text": T.StringType(), "n_words": T.LongType(), "n_removed": T.LongType(), "kept": T.StringType()}, _cut, rows.columns[: len(others)])
    named = {c: f"c{i}" for i, c in enumerate(others)} | {text_col: "text"}
    return out.select(*[F.col(named[c]).alias(c) for c in keep], *ADDED)


def _squeeze():
    pack = zstandard.ZstdCompressor(level=1).compress
    return lambda texts: [pa.array([None if t is None else pack(t) for t in texts], pa.binary())]


def _cut():
    unpack = zstandard.ZstdDecompressor().decompress

    def cut(rows: list[dict]) -> list[pa.Array]:
        texts, n_words, n_removed, kept = [], [], [], []
        for row in rows:
            texts.append(None if row["squeezed"] is None else unpack(row["squeezed"]))
            words = (texts[-1] or b"").split()
            n_words.append(len(words))
            for r in row["ranges"] or ():
                words[r["first"] : r["last"]] = [None] * (r["last"] - r["first"])
            words = [w for w in words if w is not None] if row["ranges"] else words
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        strings = (pa.array(x, pa.binary()).cast(pa.string()) for x in (texts, kept))
        return [next(strings), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), next(strings)]

    return cut
