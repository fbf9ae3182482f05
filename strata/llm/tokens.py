"""Exact token counts by a two-tier lookup on the map side.

Tier one is a hash table of the corpus's frequent pre-tokens and the number of
tokens of each, broadcast to every worker.  Tier two is a bounded cache per
worker: a pre-token outside the table is encoded once by the tokenizer's own
BPE model and remembered.  Pre-tokens are never shuffled.

The table is found in one pass over all texts: every task keeps a
Misra-Gries summary of ``SUMMARY`` counters and passes only that on, so that
what is added up across tasks is bounded per task whatever the texts hold.  It
only decides which tier answers; counts are the same with any table.

A text is cut at single spaces between two characters that are not white space:
there a byte-level pre-tokenizer always starts a new pre-token, with
the space as its first character.  The pieces are counted once per run of
texts, and their pre-tokens looked up.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; a special
token written in a text counts as one token, as the library's default has it.
Other columns pass through, a column named like an added one is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from strata.llm.bpe import SETTLED, spelled
from strata.llm.common import add_columns, most_frequent, stored

#: Counters of a task's summary, and entries of the broadcast table (about 2 MB).
SUMMARY = 8_192
TABLE = 65_536
#: Pre-tokens and pieces a worker remembers before it forgets them all.
REMEMBERED = 200_000
#: Fixed value: the split pattern of byte-level vocabularies of this kind.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space beside a space, or a space at either end: such a text is cut by the pattern below.
CLOSE = re.compile(r" \s|\s |^ | $")
CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> list[str]:
    """A text cut before single inner spaces; each piece but the first has lost its space."""
    return CUT.split(text) if CLOSE.search(text) else text.split(" ")


class Counts:
    """Token counts of one byte-level vocabulary, in one worker.

    ``table`` is tier one, ``cache`` tier two; ``sums`` remembers whole pieces.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(a.lstrip or a.rstrip or a.single_word or a.normalized for a in added):
            raise ValueError("only plain special tokens are supported")
        special = sorted((a.content for a in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pre, self.merge = self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.model.tokenize
        self.table: dict[str, int] = {}
        self.cache: dict[str, int] = {}
        self.sums: dict[str, int] = {}

    def pretokens(self, piece: str) -> list[str]:
        if piece.isascii():
            if piece[piece[:1] == " " :].isalpha():
                return [piece]
        elif max(piece) >= SETTLED:
            return [piece[a:b] for _, (a, b) in self.pre(piece)]
        return PATTERN.findall(piece)

    def of(self, pretoken: str) -> int:
        n = self.table.get(pretoken)
        if n is None:
            n = self.cache.get(pretoken)
        if n is None:
            if len(self.cache) >= REMEMBERED:
                self.cache.clear()
            n = self.cache[pretoken] = self.encoded(pretoken)
        return n

    def encoded(self, pretoken: str) -> int:
        return len(self.merge(spelled(pretoken.encode())))

    def segments(self, text: str) -> tuple[list[str], int]:
        """Pieces of the text between special tokens, with their spaces, and the number of special tokens."""
        parts = self.special.split(text) if self.special else [text]
        out: list[str] = []
        for part in parts:
            first, *rest = pieces(part) if part else [""]
            if first:
                out.append(first)
            out += [" " + p for p in rest]
        return out, len(parts) - 1

    def count(self, texts: list[str | None]) -> list[int]:
        cut = [self.segments(t) if t else ([], 0) for t in texts]
        if len(self.sums) > REMEMBERED:
            self.sums.clear()
        sums = self.sums
        for p in set(chain.from_iterable(c for c, _ in cut)).difference(sums):
            sums[p] = sum([self.of(t) for t in self.pretokens(p)])
        return [sum([sums[p] for p in c]) + n for c, n in cut]


_COUNTS: dict[str, Counts] = {}


def counts_for(path: str) -> Counts:
    if path not in _COUNTS:
        _COUNTS[path] = Counts(path)
    return _COUNTS[path]


def frequent_pretokens(docs: DataFrame, tokenizer: str, text_col: str = "text", summary: int = SUMMARY, size: int = TABLE) -> DataFrame:
    """(pretoken, n): merged summaries of all tasks, ``size`` rows at most."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kept, seen = counts_for(tokenizer), Counter(), Counter()

        def absorb():
            for piece, n in seen.items():
                for t in counts.pretokens(piece):
                    kept[t] += n
            seen.clear()
            if len(kept) > summary:  # Misra-Gries: what the first one left out has is taken from all
                floor = sorted(kept.values(), reverse=True)[summary]
                for t in [t for t, n in kept.items() if n <= floor]:
                    del kept[t]
                kept.subtract(dict.fromkeys(kept, floor))

        for b in batches:
            for text in b.column(0):
                if t := text.as_py():
                    seen.update(counts.segments(t)[0])
                    if len(seen) > REMEMBERED:
                        absorb()
        absorb()
        yield pa.record_batch([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["pretoken", "n"])

    found = docs.select(text_col).mapInArrow(summarise, "pretoken string, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))
    return most_frequent(stored(found.where(F.length("pretoken") <= 64), "pretokens"), size)


def frequent_lengths(docs: DataFrame, tokenizer: str, text_col: str = "text", **options) -> Broadcast:
    """The broadcast table: frequent pre-tokens, with the number of tokens of each in one byte."""
    names = [r.pretoken for r in frequent_pretokens(docs, tokenizer, text_col, **options).select("pretoken").collect()]
    counts = counts_for(tokenizer)
    return docs.sparkSession.sparkContext.broadcast((names, bytes(min(255, counts.encoded(n)) for n in names)))


def count_tokens(docs: DataFrame, tokenizer: str, text_col: str = "text", table: Broadcast | None = None, keep: list[str] | None = None, **options) -> DataFrame:
    """``docs`` plus ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text."""
    table = table or frequent_lengths(docs, tokenizer, text_col, **options)

    def make():
        counts = counts_for(tokenizer)
        names, lengths = table.value
        counts.table = {n: k for n, k in zip(names, lengths, strict=True) if k < 255}
        return lambda texts: [pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()), pa.array(counts.count(texts), pa.int64())]

    return add_columns(docs, text_col, {"n_bytes": T.LongType(), "n_tokens": T.LongType()}, make, keep)
