"""Toxicity by weak supervision.

1. Lexicon.  Words and word beginnings whose document frequency differs most
   between toxic and clean labelled documents (counted by Spark over a bounded
   sample of labelled rows) are dealt, by rank, to ``LEXICONS`` voters; each
   fires when a text holds one of its entries.  Pattern voters fire on several
   different entries, on a dense run of them, and on ways of writing.
2. Label model.  Every document of the corpus casts its votes; Spark counts the
   vote patterns, of which there are at most 2 ^ voters.  A generative model
   of pattern and unseen label is fitted to these counts by
   expectation-maximisation: each voter's accuracy in either class, and, for the
   pairs that stay dependent given the label, the correlation along the
   strongest tree of such pairs.  It sees no labels.
3. Classifier.  A logistic regression over lexicon entries and densities is trained
   on the label model's posteriors of the sample's documents, and scores
   every whole text.

Defined results: NULL and empty texts score as texts without any entry.  A
document with several labels is toxic if any of them is 1; NULL labels and ids are not
learned from.  Without any lexicon entry (no labels) every score is 0.  Extra
columns pass through; one named like an added one is replaced.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import add_columns, slices, stored

#: Bound of the labelled sample (documents), taken in the order of a hash of the id.
SAMPLE = 20_000
#: Lexicon entries, and lexicon voters they are dealt to.
ENTRIES = 3_000
LEXICONS = 8
#: An entry stands in that many of the sample's toxic documents at least, with that log odds ratio, and its documents are toxic
#: more often than the sample's by that log likelihood ratio (twice it: the square of 4 standard errors).  No share of the toxic
#: documents is asked for: a marker of a rare group needs no more of them than any other.
SUPPORT_LEAST = 6
LOG_ODDS = 2.5
SURE = 8.0
#: Lengths of the word beginnings that may become entries.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Vote patterns: 2 ^ VOTERS at most.
VOTERS = LEXICONS + 6
#: Pairs of voters with more dependence given the label (nats) are modelled together.
DEPENDENT = 0.002
ADDED = {"score": T.DoubleType(), "predicted": T.IntegerType()}

_WORD = regex.compile(r"\w+")
_ASCII_GAPS = {c: " " for c in range(128) if not _WORD.match(chr(c))}


def units(word: str) -> list[str]:
    """The word, and its beginnings (written with a hyphen)."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) >= n)]


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    # the same words, without a regular expression where all characters are ASCII
    return text.lower().translate(_ASCII_GAPS).split() if text.isascii() else _WORD.findall(text.lower())


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, size: int = SAMPLE) -> DataFrame:
    """(doc, label, text) of at most ``size`` labelled ids, the first by a hash of the id."""
    per_id = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc")).agg(F.max(label_col).cast("int").alias("label"))
    ids = per_id.orderBy(F.xxhash64("doc"), "doc").limit(size)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    return rows.join(F.broadcast(ids), "doc").select("doc", "label", "text")


# ----------------------------------------------------------------- lexicon
def mine_lexicon(sample: DataFrame, entries: int = ENTRIES) -> list[str]:
    """Entries by falling log odds of standing in a toxic document (weighed by their support)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b.column(1).to_pylist()):
                seen: dict[str, list[int]] = {}
                labels, texts = b.column(0).to_pylist()[i:j], b.column(1).to_pylist()[i:j]
                for label, t in zip(labels, texts, strict=True):
                    for u in {u for w in set(words_of(t)) for u in units(w)}:
                        seen.setdefault(u, [0, 0])[label] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *(pa.array([n[k] for n in seen.values()], pa.int64()) for k in (0, 1))], ["unit", "clean", "toxic"])

    counts = sample.select("label", "text").where("label IN (0, 1)").mapInArrow(count, "unit string, clean long, toxic long")
    counts = counts.groupBy("unit").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n = sample.agg(F.count(F.when(F.col("label") == 0, 1)).alias("clean"), F.count(F.when(F.col("label") == 1, 1)).alias("toxic")).first()
    odds = F.log((F.col("toxic") + 0.5) / (n.toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n.clean + 1.0))
    share, both = (n.toxic + 0.5) / (n.toxic + n.clean + 1.0), F.col("toxic") + F.col("clean")
    likelihood = [F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (both * p))).otherwise(0.0) for k, p in (("toxic", share), ("clean", 1 - share))]
    strong = counts.withColumn("odds", odds).where((F.col("odds") >= LOG_ODDS) & (F.col("toxic") >= SUPPORT_LEAST) & (likelihood[0] + likelihood[1] >= SURE))
    return [r.unit for r in strong.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "unit").limit(entries).collect()]


class Hits:
    """Which lexicon entries stand in a text."""

    def __init__(self, lexicon: list[str]):
        self.place = {u: k for k, u in enumerate(lexicon)}
        self.starts = {u[: BEGINNINGS[0]] for u in lexicon if u.endswith("-")}
        self.seen: set[str] = set()
        self.known: dict[str, tuple[int, ...]] = {}

    def look_up(self, words: set[str]) -> None:
        if len(self.seen) > 300_000:
            self.seen, self.known = set(), {}
        for w in words - self.seen:
            if w in self.place or w[: BEGINNINGS[0]] in self.starts:
                found = tuple(k for u in units(w) if (k := self.place.get(u)) is not None)
                if found:
                    self.known[w] = found
        self.seen |= words

    def of(self, text: str | None) -> tuple[list[int], int, int, int]:
        """Distinct entries, words that hold any, the most of them among 50 neighbours, number of words."""
        words = words_of(text)
        distinct = set(words)
        self.look_up(distinct)
        marked = self.known.keys() & distinct if len(self.known) < len(distinct) else {w for w in distinct if w in self.known}
        if not marked:
            return [], 0, 0, len(words)
        hit = [i for i, w in enumerate(words) if w in marked]
        entries = sorted({k for w in marked for k in self.known[w]})
        densest, a = 0, 0
        for z, i in enumerate(hit):
            while i - hit[a] >= 50:
                a += 1
            densest = max(densest, z - a + 1)
        return entries, len(marked), densest, len(words)


@functools.cache
def _cases() -> np.ndarray:
    """For every code point, whether it is a letter (1) and whether it is upper case (2)."""
    every = [chr(c) for c in range(sys.maxunicode + 1)]
    return np.array([c.isalpha() + 2 * c.isupper() for c in every], np.uint8)


def letters_and_capitals(text: str | None) -> tuple[int, int]:
    n = np.bincount(_cases()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=4)
    return int(n[1] + n[3]), int(n[2] + n[3])


def votes(text: str | None, hits: tuple[list[int], int, int, int]) -> int:
    """All votes of a text as bits: the lexicons, then the patterns."""
    entries, distinct, densest, n = hits
    bits = 0
    for k in entries:
        bits |= 1 << (k % LEXICONS)
    letters, upper = letters_and_capitals(text)
    patterns = (distinct >= 2, distinct >= 4, densest >= 3, n > 0 and distinct * 100 >= n * 2, 2 * upper > letters > 0, bool(text) and text.count("!") * 20 > n > 0)
    for k, fires in enumerate(patterns):
        bits |= int(fires) << (LEXICONS + k)
    return bits


def vote_counts(docs: DataFrame, text_col: str, lexicon: list[str]) -> DataFrame:
    """(pattern, n) over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, n = Hits(shared.value), np.zeros(1 << VOTERS, np.int64)
        for b in batches:
            for t in b.column(0):
                t = t.as_py()
                n[votes(t, hits.of(t))] += 1
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["pattern", "n"])

    return docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(cast, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------- label model
class LabelModel:
    """Votes given an unseen label: a tree of dependent voters in each class."""

    def __init__(self, patterns: np.ndarray, n: np.ndarray, rounds: int = 60):
        self.votes = (patterns[:, None] >> np.arange(VOTERS)) & 1
        self.n = n.astype(float)
        self.parent = np.full(VOTERS, -1)
        fired = self.votes[:, :LEXICONS].sum(axis=1) + self.votes[:, LEXICONS : LEXICONS + 4].sum(axis=1)
        self.posterior = np.clip(0.02 + 0.12 * fired, 0.02, 0.98)  # a start: the more votes, the likelier
        self.fit(rounds)
        self.parent = self.tree()
        self.fit(rounds)

    def fit(self, rounds: int) -> None:
        for _ in range(rounds):
            self.maximise()
            self.posterior = self.expect(self.votes)

    def maximise(self) -> None:
        weights = np.stack([self.n * (1 - self.posterior), self.n * self.posterior])
        self.prior = (weights.sum(axis=1) + 1) / (self.n.sum() + 2)
        self.table = np.zeros((2, VOTERS, 2))  # class, voter, the parent's vote: chance to fire
        for j in range(VOTERS):
            of = self.votes[:, self.parent[j]] if self.parent[j] >= 0 else np.zeros(len(self.n), int)
            for v in (0, 1):
                w = weights * (of == v)
                self.table[:, j, v] = ((w * self.votes[:, j]).sum(axis=1) + 0.5) / (w.sum(axis=1) + 1.0)

    def expect(self, votes: np.ndarray) -> np.ndarray:
        """The chance of label 1 given votes."""
        of = np.where(self.parent >= 0, votes[:, self.parent], 0)
        fire = self.table[:, np.arange(VOTERS)[None], of]
        log = np.log(np.where(votes[None] == 1, fire, 1 - fire)).sum(axis=2) + np.log(self.prior)[:, None]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))

    def dependence(self) -> np.ndarray:
        """Mutual information of each pair of voters given the label."""
        out = np.zeros((VOTERS, VOTERS))
        for y, w in enumerate((self.n * (1 - self.posterior), self.n * self.posterior)):
            total = w.sum() + 4
            one = (self.votes * w[:, None]).sum(axis=0)
            both = (self.votes * w[:, None]).T @ self.votes
            joint = {(1, 1): both, (1, 0): one[:, None] - both, (0, 1): one[None] - both, (0, 0): w.sum() - one[:, None] - one[None] + both}
            for (a, b), c in joint.items():
                p = (c + 1) / total
                pa_, pb = ((one if x else w.sum() - one) + 2 for x in (a, b))
                out += self.prior[y] * p * np.log(p / (pa_[:, None] / total) / (pb[None] / total))
        return out

    def tree(self) -> np.ndarray:
        """The strongest tree over the dependent pairs; -1 where a voter has no parent."""
        strength, parent = self.dependence(), np.full(VOTERS, -1)
        np.fill_diagonal(strength, 0)
        free = set(range(VOTERS))
        while free:
            inside = [j for j in range(VOTERS) if j not in free]
            s, j, i = max(((strength[i, j], -j, i) for j in free for i in inside), default=(0.0, -min(free), -1))
            if s > DEPENDENT:
                parent[-j] = i
                free.discard(-j)
            else:
                free.discard(min(free))
        return parent


# -------------------------------------------------------------- classifier
DENSITIES = 6


def densities(hits: tuple[list[int], int, int, int]) -> list[float]:
    entries, distinct, densest, n = hits
    return [np.log1p(len(entries)), np.log1p(distinct), np.log1p(densest), min(1.0, 10 * distinct / max(n, 1)), float(distinct >= 2), np.log1p(n) / 10]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(rows: list[list[int]], dense: np.ndarray, target: np.ndarray, entries: int, rounds: int = 300, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression on soft labels by full-batch Adam: weights of entries, densities and the constant."""
    indices = np.fromiter((k for r in rows for k in r), np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w = np.zeros(entries + DENSITIES + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(owner, w[indices], len(rows)) + dense @ w[entries:-1] + w[-1]
        error = (_sigmoid(z) - target) / max(1, len(rows))
        g = np.concatenate([np.bincount(indices, error[owner], entries), error @ dense, [error.sum()]])
        g[:entries] += decay * w[:entries] / 10
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE):
    """(lexicon, weights); ``labels`` are the rows that may be learned from, ``docs`` the whole corpus."""
    some = stored(labelled_sample(docs, labels, label_col, id_col, text_col, sample), "toxicity-sample")  # read twice more
    lexicon = mine_lexicon(some)
    if not lexicon:
        return [], np.zeros(0)
    counts = vote_counts(docs, text_col, lexicon).orderBy("pattern").toPandas()
    model = LabelModel(counts["pattern"].to_numpy(), counts["n"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(shared.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            found = [hits.of(t) for t in texts]
            columns = [b.column(0), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([densities(f) for f in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array([votes(t, f) for t, f in zip(texts, found, strict=True)], pa.int64())], ["doc", "entries", "dense", "pattern"])

    rows = some.select("doc", "text").mapInArrow(represent, "doc long, entries array<long>, dense array<double>, pattern long").toPandas()
    rows = rows.assign(order=[tuple(e) for e in rows["entries"]]).sort_values(["doc", "pattern", "order"], ignore_index=True)  # any order of tasks trains the same
    posterior = model.expect((rows["pattern"].to_numpy()[:, None] >> np.arange(VOTERS)) & 1)
    return lexicon, train([list(e) for e in rows["entries"]], np.array(rows["dense"].tolist()).reshape(-1, DENSITIES), posterior, len(lexicon))


def score(docs: DataFrame, model, text_col: str = "text", threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        lexicon, w = shared.value
        hits = Hits(lexicon)

        def chance(text: str | None) -> float:
            found = hits.of(text)
            z = w[found[0]].sum() + np.dot(densities(found), w[len(lexicon) : -1]) + w[-1]
            return round(float(_sigmoid(z)), 9)

        def work(texts: list[str | None]) -> list[pa.Array]:
            scores = [chance(t) if lexicon else 0.0 for t in texts]
            return [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]

        return work

    return add_columns(docs, text_col, ADDED, make, keep)
