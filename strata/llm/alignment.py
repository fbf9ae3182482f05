"""Alignment of two tokenizers over one text, by the byte offsets where both end a token.

Every text, with a space before it, is cut into tokens by a byte-level vocabulary A
and a piece vocabulary B.  Places where a token of each ends (shared cuts) divide both
sequences into groups that cover the same bytes.  They are found by divide and conquer: in a
stretch of tokens, look for a shared cut near the middle, by bisecting B's ends for A's
ends there and further out; divide there and go on with both halves.  A stretch without
one is a leaf: one group.  All stretches of a run of texts are worked on together, a
level of halves at a time.

Two tokens are linked where their bytes overlap.  Each pair of ids has a count, the number of
documents that hold it linked.  A text's pairs are stored packed, pairs are counted in tasks first and then
by pair, and looked up in two tiers: the most frequent pairs (``TABLE``, whole
frequency classes) are broadcast, and only the others are joined by pair, so that no pair of the
join is frequent.  Both tiers give the same numbers.

Text is cut before single spaces between two other characters, where both vocabularies
always begin a token (``Pair`` checks that they do); the pieces are encoded by the two libraries
once per worker and remembered.  A's ids must follow its merges (``Pair`` checks it): its pieces are then
encoded by rank, many at a time, with the same ids.

Defined results: NULL and empty texts, and texts whose bytes the tokens of A or B do not
give back (B may normalise), have no tokens: zeros, and an empty string of groups.
Strings of special tokens are plain text.  Repeated rows count as often as they occur.
Added columns replace those of the same name; other columns pass through.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from strata.llm.common import add_columns, most_frequent, slices, stored

#: Pairs that are broadcast (17 bytes each), pieces a worker remembers, characters of a piece worth remembering, and of one that A's own library encodes.
TABLE = 262_144
REMEMBERED = 150_000
SHORT = 24
LONG = 4_096
#: Characters of texts that are aligned together: some 150 bytes of arrays each.
RUN = 500_000
CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE = "▁"


def byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 itself, the others from U+0100 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Pair:
    """Both vocabularies, in one worker, and what it has encoded.

    ``seen`` holds the ids of a piece in A and in B, four bytes each; None where their tokens do
    not give back the piece.
    """

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as f:
            described = json.load(f)
        pre, model = described["pre_tokenizer"] or {}, described["model"]
        if described["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError("the first tokenizer must be byte-level, without a normalizer or prefix space")
        byte, vocab = byte_of_char(), model["vocab"]
        parts = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(vocab.get(l + r) != 256 + i for i, (l, r) in enumerate(parts)) or any(vocab.get(c, 256) >= 256 for c in byte):
            raise ValueError("the first tokenizer must number all bytes first, then its merges in order")
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if i < 256 + len(parts)}
        # ids follow the merges, so the vocabulary is also one of ranks: encoded many pieces at a time
        self.a = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(a_path)
        self.exact.encode_special_tokens = True
        self.a_bytes = np.zeros(len(ranks), np.int64)
        self.a_bytes[list(ranks.values())] = list(map(len, ranks))
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in n.lstrip(SPACE) for n in names):
            raise ValueError("the second tokenizer has pieces that reach over a space")
        self.b_spelled = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.b_bytes = np.array(list(map(len, self.b_spelled)), np.int64)
        self.seen: dict[str, tuple[bytes, bytes] | None] = {}

    def encode_a(self, pieces: list[str]) -> list[bytes]:
        """A's ids of each piece and the space before it.

        Pieces that begin and end with no white space are cut apart anywhere: they are encoded as one text.
        """
        out: list[bytes] = [b""] * len(pieces)
        plain = []
        for k, p in enumerate(pieces):
            if p and len(p) <= LONG and not p[0].isspace() and not p[-1].isspace():
                plain.append(k)
            else:
                out[k] = np.array(self.exact.encode(" " + p, add_special_tokens=False).ids, "<u4").tobytes()
        if plain:
            ids = np.array(self.a.encode_ordinary(" " + " ".join([pieces[k] for k in plain])), np.int64)
            size = np.fromiter((len(pieces[k].encode()) + 1 for k in plain), np.int64, len(plain))
            ends = (np.searchsorted(np.cumsum(self.a_bytes[ids]), np.cumsum(size)) + 1).tolist()
            data, start = ids.astype("<u4").tobytes(), 0
            for k, end in zip(plain, ends):
                out[k] = data[4 * start : 4 * end]
                start = end
        return out

    def encode(self, pieces: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Pieces of text, each but the space that stands before it."""
        spelled, out = self.b_spelled, []
        for p, a, b in zip(pieces, self.encode_a(pieces), self.b.encode(pieces, num_threads=1), strict=True):
            whole = b"".join([spelled[i] for i in b]) == b" " + p.encode()
            out.append((a, array("I", b).tobytes()) if whole else None)
        return out

    def pieces(self, text: str | None) -> list[str]:
        return CUT.split(text) if text else []

    def lookup(self, wanted: set[str]) -> list[tuple[bytes, bytes] | None]:
        """Every wanted piece, in the set's order; short ones are remembered."""
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        new = list(wanted.difference(self.seen))
        made = dict(zip(new, self.encode(new))) if new else {}
        self.seen.update(made if all(len(p) <= SHORT for p in new) else {p: e for p, e in made.items() if len(p) <= SHORT})
        seen = self.seen
        return [made[p] if p in made else seen[p] for p in wanted] if made else [seen[p] for p in wanted]


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_for(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _PAIRS:
        _PAIRS[a_path, b_path] = Pair(a_path, b_path)
    return _PAIRS[a_path, b_path]


# ---------------------------------------------------------------- alignment
def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """start[k], start[k]+1, ... of every k, size[k] of them; and the k of each."""
    owner = np.repeat(np.arange(len(start)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + start[owner], owner


def _near_middle(ends: np.ndarray, other: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each stretch [lo, hi) of ``ends`` the index nearest its middle whose end is in ``other``; -1 without one."""
    middle, found, reach = (lo + hi) // 2, np.full(len(lo), -1), 1
    open_ = np.arange(len(lo))
    while len(open_):
        left, right = np.maximum(middle[open_] - reach + 1, lo[open_]), np.minimum(middle[open_] + reach, hi[open_])
        at, owner = _spread(left, right - left)
        place = np.searchsorted(other, ends[at])  # the bisect
        hit = (place < len(other)) & (other[np.minimum(place, len(other) - 1)] == ends[at])
        far = np.where(hit, np.abs(at - middle[open_][owner]) * 2 + (at < middle[open_][owner]), np.iinfo(np.int64).max)
        best = np.full(len(open_), np.iinfo(np.int64).max)
        np.minimum.at(best, owner, far)
        some = best < np.iinfo(np.int64).max
        found[open_[some]] = middle[open_[some]] + np.where(best[some] & 1, -(best[some] >> 1), best[some] >> 1)
        open_ = open_[~some & ((left > lo[open_]) | (right < hi[open_]))]
        reach *= 4
    return found


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Marks A's tokens that end where one of B's ends.

    Texts hold the A tokens ``first[k]`` to ``last[k]``; both sequences of a text end
    together.  Ends are offsets in all texts, one after the other.
    """
    cut = np.zeros(len(a_ends), bool)
    cut[last] = True
    lo, hi = first, last  # inner ends of a stretch: those of its tokens but the last
    while len(lo):
        some = lo < hi
        lo, hi = lo[some], hi[some]
        found = _near_middle(a_ends, b_ends, lo, hi)
        lo, hi, found = lo[found >= 0], hi[found >= 0], found[found >= 0]  # the others are leaves
        cut[found] = True
        lo, hi = np.concatenate([lo, found + 1]), np.concatenate([found, hi])
    return cut


class Aligned(NamedTuple):
    """Tokens of a run of texts in both vocabularies, and their groups."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_doc: np.ndarray
    docs: int


def align(pair: Pair, texts: list[str | None]) -> Aligned:
    cut = [pair.pieces(t) for t in texts]
    wanted = set(chain.from_iterable(cut))
    found = pair.lookup(wanted)
    number = dict(zip(wanted, range(len(wanted))))
    flat = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
    doc = np.repeat(np.arange(len(texts)), [len(pieces) for pieces in cut])
    lost = np.fromiter((e is None for e in found), bool, len(found))
    if lost.any():  # a text with one such piece has no tokens
        keep = (np.bincount(doc, lost[flat], len(texts)) == 0)[doc]
        flat, doc = flat[keep], doc[keep]

    def sequence(which: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        each = [e[which] if e else b"" for e in found]
        n = np.fromiter(map(len, each), np.int64, len(each)) // 4
        at, owner = _spread((np.cumsum(n) - n)[flat], n[flat])
        values = np.frombuffer(b"".join(each), "<u4").astype(np.int64)[at]
        return values, np.cumsum(sizes[values]), doc[owner]

    a, a_ends, a_doc = sequence(0, pair.a_bytes)
    b, b_ends, b_doc = sequence(1, pair.b_bytes)
    n = np.bincount(a_doc, minlength=len(texts))
    last = (np.cumsum(n) - 1)[n > 0]
    marks = shared_cuts(a_ends, b_ends, last - n[n > 0] + 1, last)
    return Aligned(a, b, a_ends, b_ends, a_doc, b_doc, np.cumsum(marks) - marks, np.searchsorted(a_ends[marks], b_ends), a_doc[marks], len(texts))


def group_strings(x: Aligned) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text: decimal ids in order, A's and B's of each group."""
    total, groups = len(x.a) + len(x.b), len(x.group_doc)
    before_b = np.cumsum(np.bincount(x.b_group, minlength=groups)) - np.bincount(x.b_group, minlength=groups)
    upto_a = np.cumsum(np.bincount(x.a_group, minlength=groups))
    ids, mark, doc = np.zeros(total, np.int64), np.full(total, ord(","), np.uint8), np.zeros(total, np.int64)
    for values, group, at, owner, opens in (
        (x.a, x.a_group, np.arange(len(x.a)) + before_b[x.a_group], x.a_doc, ";"),
        (x.b, x.b_group, np.arange(len(x.b)) + upto_a[x.b_group], x.b_doc, "|"),
    ):
        ids[at], doc[at] = values, owner
        mark[at[np.flatnonzero(np.diff(group, prepend=-1))]] = ord(opens)
    mark[np.flatnonzero(np.diff(doc, prepend=-1))] = 0  # the first token of a text has no mark
    width = len(str(ids.max(initial=0)))
    tens = 10 ** np.arange(width - 1, -1, -1)
    known = np.arange(10**width if width < 6 else ids.max(initial=0) + 1)[:, None]  # every id spelled once
    digits, used = (known // tens % 10 + ord("0")).astype(np.uint8), known >= np.r_[tens[:-1], 0]
    cells, shown = np.empty((total, width + 1), np.uint8), np.empty((total, width + 1), bool)
    cells[:, 0], cells[:, 1:] = mark, digits[ids]
    shown[:, 0], shown[:, 1:] = mark > 0, used[ids]
    size = np.bincount(doc, used.sum(axis=1)[ids] + (mark > 0), minlength=x.docs).astype(np.int64)
    written, end = cells[shown].tobytes(), np.cumsum(size)
    return [written[e - s : e] for s, e in zip(size.tolist(), end.tolist())]


def linked_pairs(x: Aligned, a_size: int, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, id pair as a * b_size + b, how often) of the linked tokens, sorted."""
    starts = np.r_[0, x.a_ends[:-1]] if len(x.a_ends) else x.a_ends
    first = np.searchsorted(x.b_ends, starts, "right")  # B's tokens that reach into each of A's
    j, i = _spread(first, np.searchsorted(x.b_ends, x.a_ends) - first + 1)
    span = a_size * b_size
    code = x.a_doc[i] * span + x.a[i] * b_size + x.b[j]
    code.sort()
    at = np.flatnonzero(np.diff(code, prepend=-1))
    return code[at] // span, code[at] % span, np.diff(at, append=len(code))


ADDED = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(), "groups": T.StringType(), "groups_sha256": T.StringType(), "pairs": T.BinaryType()}


def packed(key: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending pairs as differences, by byte planes, then how often each: what is alike stands together and compresses."""
    steps = np.diff(key, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8)
    planes = 8 - int(np.argmax(np.r_[steps.any(axis=0)[::-1], True]))
    return bytes([planes]) + steps[:, :planes].T.tobytes() + times.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    planes, body = data[0], np.frombuffer(data, np.uint8, offset=1)
    n = len(body) // (planes + 4)
    steps, times = np.zeros((n, 8), np.uint8), np.zeros((n, 4), np.uint8)
    steps[:, :planes] = body[: planes * n].reshape(planes, n).T
    times[:] = body[planes * n :].reshape(4, n).T
    return np.cumsum(steps.view("<u8").ravel().astype(np.int64)), times.view("<u4").ravel().astype(np.int64)


def align_texts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: list[str] | None = None, added: tuple[str, ...] = tuple(ADDED)) -> DataFrame:
    """``docs`` plus the ``added`` of n_a, n_b, n_groups, n_links, groups (as text), groups_sha256, pairs (packed)."""

    def make():
        pair = pair_for(a_path, b_path)

        def work(texts: list[str | None]) -> list[pa.Array]:
            x = align(pair, texts)
            n_a, n_b, n_groups = (np.bincount(d, minlength=x.docs) for d in (x.a_doc, x.b_doc, x.group_doc))
            out = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups}  # within a group each next end adds one link
            if "groups" in added or "groups_sha256" in added:
                strings = group_strings(x)
                out["groups"] = [s.decode() for s in strings] if "groups" in added else None
                out["groups_sha256"] = [hashlib.sha256(s).hexdigest() if s else "" for s in strings]
            if "pairs" in added:
                doc, key, times = linked_pairs(x, len(pair.a_bytes), len(pair.b_bytes))
                end = np.cumsum(np.bincount(doc, minlength=x.docs))
                out["pairs"] = [packed(key[i:j], times[i:j]) if j > i else b"" for i, j in zip(np.r_[0, end[:-1]].tolist(), end.tolist())]
            return [pa.array(out[c], pa.string() if c.startswith("groups") else pa.binary() if c == "pairs" else pa.int64()) for c in added]

        return work

    return add_columns(docs, text_col, {c: ADDED[c] for c in added}, make, keep, max_chars=RUN)


# ------------------------------------------------------------------- counts
def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether no pair of its A id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = b.column(0).to_pylist()
            for i, j in slices(data):
                keys, n = np.unique(np.concatenate([unpacked(d)[0] for d in data[i:j]]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])

    rows = aligned.select("pairs").mapInArrow(count, "pair long, n long")
    counts = stored(rows.groupBy("pair").agg(F.sum("n").alias("n")), "pairs").withColumn("a", F.floor(F.col("pair") / b_size).cast("int"))
    most = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))  # a row per id of A, no more than its vocabulary
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def pair_sums(aligned: DataFrame, counts: DataFrame, table: int = TABLE) -> DataFrame:
    """``aligned`` without its pairs, plus n_best and count_sum.  Its ``row`` names each row."""
    spark = aligned.sparkSession
    tier = most_frequent(counts, table)
    found = tier.toPandas().sort_values("pair")
    shared = spark.sparkContext.broadcast(tuple(found[c].to_numpy(t) for c, t in (("pair", np.int64), ("n", np.int64), ("best", bool))))

    def split(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        key, times = unpacked(data)
        known = shared.value[0]
        at = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
        return key, times, at, known[at] == key if len(known) else np.zeros(len(key), bool)

    def work(values: list[bytes]) -> list[pa.Array]:
        best, total = [], []
        for data in values:
            _, times, at, hit = split(data)
            _, n, is_best = shared.value
            best.append(int(times[hit][is_best[at[hit]]].sum()))
            total.append(int((times[hit] * n[at[hit]]).sum()))
        return [pa.array(best, pa.int64()), pa.array(total, pa.int64())]

    def misses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, data = b.column(0).to_numpy(), b.column(1).to_pylist()
            for i, j in slices(data):
                parts = [(row, *split(d)) for row, d in zip(rows[i:j].tolist(), data[i:j])]
                out = [(np.full((~hit).sum(), row, np.int64), key[~hit], times[~hit]) for row, key, times, _, hit in parts]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["row", "pair", "times"])

    rest = aligned.select("row", "pairs").mapInArrow(misses, "row long, pair long, times long").join(counts, "pair")
    rest = rest.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rest_best"), F.sum(F.col("times") * F.col("n")).alias("rest_sum"))
    near = add_columns(aligned, "pairs", {"n_best": T.LongType(), "count_sum": T.LongType()}, lambda: work, [c for c in aligned.columns if c != "pairs"])
    plus = {c: F.col(c) + F.coalesce(F.col(r), F.lit(0)) for c, r in (("n_best", "rest_best"), ("count_sum", "rest_sum"))}
    return near.join(rest, "row", "left").withColumns(plus).drop("row", "rest_best", "rest_sum")


def align_corpus(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", table: int = TABLE) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every document."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    wanted = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs")
    aligned = align_texts(rows, a_path, b_path, keep=["id"], added=wanted).withColumn("row", F.monotonically_increasing_id())
    aligned = stored(aligned, "aligned")  # numbers the rows once and for all
    b_size = len(pair_for(a_path, b_path).b_bytes)
    return pair_sums(aligned, pair_counts(aligned, b_size), table).withColumnRenamed("id", id_col)
