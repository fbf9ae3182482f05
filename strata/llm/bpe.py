"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

All words (pre-tokens after normalisation) of the corpus are counted by Spark;
the ``LEXICON`` most frequent ones are compiled into one minimal acyclic
automaton: words with equal suffixes share states, and every arc carries how
many words of its state come before it, so that the sum along a word's path is
the word's number, under which its token ids stand.  The file travels to the executors
with ``addFile`` and every Python worker maps it into memory.  All new words of
a run of texts walk the automaton together, one array operation per byte;
words outside it are merged exactly by the tokenizer's own BPE model.

White space never crosses a pre-token of this kind of vocabulary and is dropped,
so a text is encoded as the sequence of its white-space-delimited chunks; a
worker keeps the ids of chunks it has met (bounded, emptied when full).

Defined results: NULL and empty texts have no ids and decode to ''.  Special
tokens written in a text are encoded as the library does, to their ids.  Rows
keep their other columns; repeated rows are encoded alike; a column named like an added
one is replaced.
"""

from __future__ import annotations

import re
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from strata.llm.common import add_columns, forget, give_back, most_frequent, stored, worker_cache

#: Words in the lexicon: bounds the automaton (about 10 MB) and what the driver collects.
LEXICON = 131_072
#: Distinct chunks a worker remembers, and counts before it passes them on.
REMEMBERED = 300_000
COUNTED = 600_000
#: Words longer than that (bytes) are merged rather than looked up.
LONGEST = 48
#: Below this code point the pattern's classes are the same in every Unicode version
#: in use; a text above it is split by the tokenizer's own pre-tokenizer.
SETTLED = "԰"
#: Fixed value: the vocabulary's split pattern.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte.

    Bytes that are visible in Latin-1 stand for themselves; the others take the
    characters from U+0100 on, in order.
    """
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


_BYTE_CHARS = byte_chars()


def spelled(word: bytes) -> str:
    """A word in the vocabulary's byte characters."""
    return word.decode() if word.isalnum() else "".join([_BYTE_CHARS[b] for b in word])


# -------------------------------------------------------------- the automaton
def compile_words(words: list[bytes], outputs: list[list[int]]) -> np.ndarray:
    """Sorted distinct words and their ids -> the automaton as one int64 array.

    Built in one pass over the sorted words: when the next word leaves the
    current path, the states below the fork can no longer change and are
    replaced by an equal registered state if there is one.  Layout: the five
    lengths, then arc keys (state * 256 + byte, ascending), arc targets, words before
    each arc, final flags by state, output starts, ids.
    """
    register: dict[tuple, int] = {}
    frozen: list[tuple] = []  # by state: final, ((byte, state), ...)
    path: list[list] = [[False, []]]  # open states along the current word
    before = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            state = register.get(key)
            if state is None:
                state = register[key] = len(frozen)
                frozen.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], state)

    for word in words:
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        close(common)
        for b in word[common:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        before = word
    close(0)
    root = len(frozen)
    frozen.append((path[0][0], tuple(path[0][1])))

    below = np.zeros(len(frozen), np.int64)  # words that start at a state; targets come before sources
    keys, targets, skips = [], [], []
    for state, (final, arcs) in enumerate(frozen):
        n = int(final)
        for b, to in arcs:
            keys.append(state * 256 + b)
            targets.append(to)
            skips.append(n)
            n += int(below[to])
        below[state] = n
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(o) for o in outputs], out=starts[1:])
    ids = np.array([i for o in outputs for i in o] + [0] * (int(starts[-1]) % 2), "<u4").view(np.int64)  # two to a cell
    flat = [np.asarray(p, np.int64) for p in (keys, targets, skips, [f for f, _ in frozen], starts, ids)]
    return np.concatenate([[len(p) for p in flat], [root], *flat]).astype(np.int64)


class Lexicon:
    """The memory-mapped automaton: many words in, their ids or None out."""

    def __init__(self, flat: np.ndarray):
        sizes, self.root = flat[:6], int(flat[6])
        ends = 7 + np.cumsum(sizes)
        self.keys, self.targets, self.skips, self.finals, self.starts, ids = (
            np.asarray(flat[e - n : e]) for e, n in zip(ends, sizes, strict=True)
        )
        self.ids = memoryview(ids).cast("B")

    @classmethod
    def open(cls, path: str) -> Lexicon:
        return cls(np.load(path, mmap_mode="r"))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it is not in the lexicon."""
        out = np.full(len(words), -1, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        rows = np.flatnonzero((lengths > 0) & (lengths <= LONGEST))
        if not len(rows) or not len(self.keys):
            return out
        rows = rows[np.argsort(-lengths[rows], kind="stable")]  # longest first: the live words are a prefix
        lengths = lengths[rows]
        text = np.array([words[i] for i in rows], dtype=f"S{LONGEST}").view(np.uint8).reshape(len(rows), LONGEST)
        state = np.full(len(rows), self.root, np.int64)
        number = np.zeros(len(rows), np.int64)
        alive = np.arange(len(rows))
        for j in range(int(lengths[0])):
            alive = alive[lengths[alive] > j]
            key = state[alive] * 256 + text[alive, j]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            state[alive[~found]] = -1
            alive, at = alive[found], at[found]
            number[alive] += self.skips[at]
            state[alive] = self.targets[at]
        ok = (state >= 0) & (self.finals[np.maximum(state, 0)] == 1)
        out[rows[ok]] = number[ok]
        return out

    def look_up(self, words: list[bytes]) -> list[bytes | None]:
        """Each word's ids as little-endian unsigned 32-bit integers, None where it is not in the lexicon."""
        numbers = self.numbers(words)
        ids, starts = self.ids, self.starts
        ends = (4 * starts[numbers + 1]).tolist()
        begins = (4 * starts[numbers]).tolist()
        return [bytes(ids[a:z]) if n >= 0 else None for n, a, z in zip(numbers.tolist(), begins, ends, strict=True)]


# ---------------------------------------------------------------- the words
class Words:
    """How this vocabulary turns a chunk of text into words, and words into ids."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(a.lstrip or a.rstrip or a.single_word or a.normalized for a in added.values()):
            raise ValueError("only plain special tokens are supported")
        self.special = {a.content: i for i, a in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.marks = {s[0] for s in self.special}
        self.normalize, self.pre = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = self.tokenizer.model.tokenize

    def plain(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if text.isascii():
            text = text.lower()
        elif max(text) < SETTLED and "Σ" not in text:  # the library writes no final sigma
            text = unicodedata.normalize("NFC", text).lower()
        else:
            text = self.normalize(text)
        if not text or max(text) < SETTLED:
            return PATTERN.findall(text)
        return [text[a:b] for _, (a, b) in self.pre(text)]

    def of(self, chunk: bytes) -> list[bytes | int]:
        """The words of a chunk; a special token is its id."""
        if chunk.isalpha():  # bytes: letters of ASCII only
            return [chunk.lower()]
        if chunk[-1:] in (b",", b".") and chunk[:-1].isalpha():
            return [chunk[:-1].lower(), chunk[-1:]]
        text = chunk.decode()
        if self.cut is None or self.marks.isdisjoint(text) or not self.cut.search(text):
            return [w.encode() for w in self.plain(text)]
        out: list[bytes | int] = []
        for part in self.cut.split(text):
            out += [self.special[part]] if part in self.special else [w.encode() for w in self.plain(part)]
        return out

    def merged(self, word: bytes) -> list[int]:
        return [t.id for t in self.merge(spelled(word))]


def chunks(text: bytes | None) -> list[bytes]:
    """The chunks of a UTF-8 text between ASCII white space."""
    return (text or b"").split()


_WORDS: dict[str, Words] = worker_cache("bpe")


def words_for(path: str) -> Words:
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


def word_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts, counted per task before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(but="bpe")
        words, seen = words_for(tokenizer), Counter()

        def flush():
            out = Counter()
            for chunk, n in seen.items():
                for w in words.of(chunk):
                    if isinstance(w, bytes):
                        out[w] += n
            seen.clear()
            names = list(out)
            for i in range(0, len(names), 50_000):
                part = names[i : i + 50_000]
                yield pa.record_batch([pa.array(part, pa.binary()).cast(pa.string()), pa.array([out[w] for w in part], pa.int64())], ["word", "n"])

        for b in batches:
            for text in b.column(0).cast(pa.binary()):
                seen.update(chunks(text.as_py()))
                if len(seen) > COUNTED:
                    yield from flush()
        yield from flush()
        give_back()

    return docs.select(text_col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", size: int = LEXICON) -> str:
    """Compile at most ``size`` of the most frequent words; returns the name executors find the file by."""
    spark = docs.sparkSession
    counts = stored(word_counts(docs, tokenizer, text_col).where(F.octet_length("word") <= LONGEST), "words")
    words = words_for(tokenizer)
    entries = sorted(r.word.encode() for r in most_frequent(counts, size).select("word").collect())
    flat = compile_words(entries, [words.merged(w) for w in entries])
    name = f"lexicon-{uuid.uuid4().hex}.npy"
    file = Path(tempfile.mkdtemp()) / name
    np.save(file, flat)
    spark.sparkContext.addFile(str(file))
    return name


class Encoder:
    """Texts to packed ids in one worker."""

    def __init__(self, tokenizer: str, lexicon: str):
        self.words, self.lexicon = words_for(tokenizer), Lexicon.open(SparkFiles.get(lexicon))
        self.special = {i: np.array([i], "<u4").tobytes() for i in self.words.special.values()}
        self.known: dict[bytes, bytes] = {}

    def learn(self, new: list[bytes]) -> None:
        parts = [self.words.of(c) for c in new]
        distinct = list(set(chain.from_iterable(parts)).difference(self.special))
        packed: dict[bytes | int, bytes] = dict(self.special)
        packed.update(zip(distinct, self.lexicon.look_up(distinct), strict=True))
        for w in [w for w in distinct if packed[w] is None]:
            packed[w] = np.array(self.words.merged(w), "<u4").tobytes()
        for c, p in zip(new, parts, strict=True):
            self.known[c] = packed[p[0]] if len(p) == 1 else b"".join([packed[w] for w in p])

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """UTF-8 texts to their packed ids."""
        cut = [chunks(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set(chain.from_iterable(cut)).difference(self.known)
        self.learn(list(new))
        known = self.known
        return [b"".join([known[c] for c in cs]) for cs in cut]


_ENCODERS: dict[tuple[str, str], Encoder] = worker_cache("bpe")


def _encoder(tokenizer: str, lexicon: str) -> Encoder:
    if (tokenizer, lexicon) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer, lexicon] = Encoder(tokenizer, lexicon)
    return _ENCODERS[tokenizer, lexicon]


def _token_table(tokenizer: str) -> np.ndarray:
    t = words_for(tokenizer).tokenizer
    return np.array([t.id_to_token(i) for i in range(t.get_vocab_size(with_added_tokens=True))], dtype=object)


def decode_ids(packed: bytes, table: np.ndarray) -> str:
    """Ids to text: a vocabulary without a decoder writes its tokens with one space between."""
    return " ".join(table[np.frombuffer(packed, "<u4")])


def encode(df: DataFrame, tokenizer: str, lexicon: str, text_col: str = "text", decode: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``df`` plus ``ids`` (packed little-endian uint32), ``n_tokens`` and, if asked, ``decoded``."""

    def build():
        encoder = _encoder(tokenizer, lexicon)
        table = _token_table(tokenizer) if decode else None

        def work(texts):
            ids = encoder.encode(texts)
            out = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            return out + ([pa.array([decode_ids(x, table) for x in ids], pa.string())] if decode else [])

        return work

    added = {"ids": T.BinaryType(), "n_tokens": T.LongType()} | ({"decoded": T.StringType()} if decode else {})
    return add_columns(df, text_col, added, build, keep, as_bytes=True, cache="bpe")


def decode(df: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """``df`` plus ``decoded``, the text of packed ids (NULL: '')."""

    def build():
        table = _token_table(tokenizer)
        return lambda packed: [pa.array([decode_ids(x or b"", table) for x in packed], pa.string())]

    return add_columns(df, ids_col, {"decoded": T.StringType()}, build, cache="bpe")


def round_trip(docs: DataFrame, tokenizer: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Fit the lexicon on ``docs``, encode every text and decode its ids, in one pass after the count."""
    return encode(docs, tokenizer, fit_lexicon(docs, tokenizer, text_col), text_col, True, keep)
