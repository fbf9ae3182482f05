"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of them, in order.
Every passage is encoded (hashed character n-grams and shape statistics through a
tanh layer); a gated attention, tanh(V h) * sigmoid(U h), learned from document
labels alone, weighs the passages; the weighted mean of their encodings is
scored by a logistic layer.  So a document with one bad stretch among good
ones is judged by what the model learned to look at.

Passages are described by Spark's tasks.  The network is fitted with Adam to a
bounded sample of labelled documents (the first ``SAMPLE`` by a hash of
the id, as far as ``PASSAGES`` go: one with more than are left is not learned from),
on the driver, from a fixed seed; all documents are scored by the
tasks.  A text is read ``TOGETHER`` passages at a time, and the weighted mean is
kept up as they pass, so that a task holds no more of a very long one.

Defined results: a NULL text, and one without words, is a bag of one empty
passage.  Rows with the same id and text are learned from once.  A document with several labels is good if any of them is 1; NULL labels
and ids are not learned from.  Without labelled rows every score is 0.5.
Extra columns pass through; one named like an added one is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import add_columns, forget, give_back, mix64, slices, stored

#: Bounds of the labelled sample, in documents and in their passages (about 400 bytes each).
SAMPLE = 6_000
PASSAGES = 400_000
#: Words of a passage, and passages that are described at once.
PASSAGE = 64
TOGETHER = 4_096
#: Dimensions: hashed n-grams, statistics, encoding, attention.
GRAMS = 192
STATS = 12
HIDDEN = 32
ATTENTION = 16
STEPS = 1_100
BATCH = 64
SEED = 7
ADDED = {"score": T.DoubleType(), "predicted": T.IntegerType()}

# Classes of characters by code point, up to U+024F; above that only letters matter.
_KNOWN = [chr(c) for c in range(0x250)]
_CLASSES = np.array([[c.isupper() for c in _KNOWN], [c.islower() for c in _KNOWN], [c.isdigit() for c in _KNOWN], [c in "#*$%&|<>" for c in _KNOWN], [c in "!?" for c in _KNOWN], [c in ".,;:" for c in _KNOWN], [ord(c) > 0x7F for c in _KNOWN]])


_PASSAGE = re.compile(rb"(?:\S++\s*+){1,%d}" % PASSAGE)


def passages_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of each passage, one passage after another."""
    some = False
    for found in _PASSAGE.finditer(text or b""):
        some = True
        yield found.group().split()
    if not some:
        yield []


def described(texts: list[bytes | None], together: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of passages: a row of GRAMS + STATS numbers for each, and the text it belongs to."""
    flat, owner = [], []
    for i, text in enumerate(texts):
        for p in passages_of(text):
            flat.append(p)
            owner.append(i)
            if len(flat) == (together or TOGETHER):
                yield _numbers(flat), np.array(owner)
                flat, owner = [], []
    if flat:
        yield _numbers(flat), np.array(owner)


def describe(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All runs of :func:`described` together."""
    runs = list(described(texts))
    return np.concatenate([x for x, _ in runs]), np.concatenate([owner for _, owner in runs])


def _numbers(flat: list[list[bytes]]) -> np.ndarray:
    n = len(flat)
    spelled = [(b" " + b" ".join(p) + b" ").decode() for p in flat]
    chars = np.frombuffer("".join(spelled).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.array([len(s) for s in spelled], np.int64)
    row = np.repeat(np.arange(n), lengths)
    grams = np.zeros(n * GRAMS)
    h = chars
    for k in (2, 3):
        h = mix64(h[: max(0, len(chars) - k + 1)] * np.uint64(3) + chars[k - 1 :])
        inside = row[: len(h)] == row[k - 1 :][: len(h)]
        grams += np.bincount(row[: len(h)][inside] * GRAMS + (h[inside] % np.uint64(GRAMS)).astype(np.int64), minlength=n * GRAMS)
    grams = np.sqrt(grams.reshape(n, GRAMS))
    grams /= np.maximum(np.linalg.norm(grams, axis=1, keepdims=True), 1e-9)
    low = np.minimum(chars, np.uint64(0x24F)).astype(np.int64)
    stats = np.zeros((n, STATS))
    for k, of in enumerate(_CLASSES):
        stats[:, k] = np.bincount(row, of[low], n) / np.maximum(lengths, 1)
    size = np.array([len(p) for p in flat], float)
    stats[:, 7] = [len(set(p)) / max(1, len(p)) for p in flat]
    stats[:, 8] = [sum(a == b for a, b in zip(p, p[1:], strict=False)) / max(1, len(p)) for p in flat]
    stats[:, 9] = size / PASSAGE
    stats[:, 10] = np.minimum(lengths / np.maximum(size, 1) / 10, 3)
    stats[:, 11] = [sum(not w.isalpha() and w.isascii() for w in p) / max(1, len(p)) for p in flat]
    return np.hstack([grams, stats]).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Network:
    """Encoder, gated attention and logistic layer; bags are rows with a segment number."""

    SHAPES = {"W": (GRAMS + STATS, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "a": (ATTENTION,), "c": (HIDDEN,), "c0": (1,)}

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {k: rng.normal(0, (1 / s[0]) ** 0.5, s) if len(s) == 2 else (rng.normal(0, 0.1, s) if k in "ac" else np.zeros(s)) for k, s in self.SHAPES.items()}

    def forward(self, x: np.ndarray, bag: np.ndarray, n: int) -> dict[str, np.ndarray]:
        p, f = self.p, {}
        f["h"] = np.tanh(x @ p["W"] + p["b"])
        f["v"], f["u"] = np.tanh(f["h"] @ p["V"]), _sigmoid(f["h"] @ p["U"])
        e = (f["v"] * f["u"]) @ p["a"]
        top = np.full(n, -np.inf)
        np.maximum.at(top, bag, e)
        e = np.exp(e - top[bag])
        f["w"] = e / np.bincount(bag, e, n)[bag]
        f["z"] = np.zeros((n, HIDDEN))
        np.add.at(f["z"], bag, f["w"][:, None] * f["h"])
        f["y"] = _sigmoid(f["z"] @ p["c"] + p["c0"])
        return f

    def scores(self, runs: Iterable[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
        """The ``y`` of :meth:`forward`, from runs of passages: sums so far fade as a greater attention comes."""
        p, top, total, z = self.p, np.full(n, -np.inf), np.zeros(n), np.zeros((n, HIDDEN))
        for x, bag in runs:
            h = np.tanh(x.astype(np.float64) @ p["W"] + p["b"])
            e = (np.tanh(h @ p["V"]) * _sigmoid(h @ p["U"])) @ p["a"]
            was, top = top, top.copy()
            np.maximum.at(top, bag, e)
            fade = np.exp(was - np.where(np.isfinite(top), top, 0))
            w = np.exp(e - top[bag])
            total = total * fade + np.bincount(bag, w, n)
            z *= fade[:, None]
            np.add.at(z, bag, w[:, None] * h)
        return _sigmoid(z / total[:, None] @ p["c"] + p["c0"])

    def gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the bags."""
        p, n = self.p, len(y)
        f = self.forward(x, bag, n)
        error = (f["y"] - y) / n
        g = {"c": f["z"].T @ error, "c0": error.sum(keepdims=True)}
        dz = error[:, None] * p["c"]
        dw = (dz[bag] * f["h"]).sum(axis=1)
        de = f["w"] * (dw - np.bincount(bag, f["w"] * dw, n)[bag])
        g["a"] = (f["v"] * f["u"]).T @ de
        gate = de[:, None] * p["a"]
        dv, du = gate * f["u"] * (1 - f["v"] ** 2), gate * f["v"] * f["u"] * (1 - f["u"])
        g["V"], g["U"] = f["h"].T @ dv, f["h"].T @ du
        dh = f["w"][:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T
        d = dh * (1 - f["h"] ** 2)
        g["W"], g["b"] = x.T @ d, d.sum(axis=0)
        return g

    def fit(self, bags: list[np.ndarray], y: np.ndarray, steps: int = STEPS, rate: float = 3e-3, decay: float = 1e-4) -> Network:
        rng = np.random.default_rng(SEED)
        m = {k: np.zeros(s) for k, s in self.SHAPES.items()}
        v = {k: np.zeros(s) for k, s in self.SHAPES.items()}
        order = np.zeros(0, np.int64)
        for t in range(1, steps + 1):
            if not len(order):
                order = rng.permutation(len(bags))
            some, order = order[:BATCH], order[BATCH:]
            g = self.gradients(np.concatenate([bags[k] for k in some]).astype(np.float64), np.repeat(np.arange(len(some)), [len(bags[k]) for k in some]), y[some])
            for k in self.p:
                g[k] += decay * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return self


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, passages: int = PASSAGES) -> dict[str, np.ndarray] | None:
    """The fitted weights; ``labels`` are the rows that may be learned from."""
    per_id = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc")).agg(F.max(label_col).cast("int").alias("label"))
    ids = per_id.orderBy(F.xxhash64("doc"), "doc").limit(sample)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"), text.alias("text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in batches:
            texts = b.column(3).cast(pa.binary()).to_pylist()
            for i, j in slices(texts):
                count, packed = np.zeros(j - i, np.int64), [[] for _ in range(j - i)]
                for x, owner in described(texts[i:j]):
                    for k in np.unique(owner).tolist():
                        mine = x[owner == k]
                        count[k] += len(mine)
                        if count[k] <= passages:
                            packed[k].append(mine.astype(np.float16).tobytes())
                        else:
                            packed[k] = []
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in range(3)), pa.array(count), pa.array([b"".join(x) for x in packed], pa.binary())], ["doc", "version", "label", "n", "bag"])
        give_back()

    found = rows.join(F.broadcast(ids), "doc").select("doc", "version", "label", "text").mapInArrow(bags, "doc long, version long, label int, n long, bag binary")
    found = stored(found, "quality-sample")
    first = found.groupBy("doc", "version").agg(F.max("n").alias("n")).orderBy(F.xxhash64("doc"), "doc", "version").limit(sample).collect()
    chosen, left = [], passages
    for r in first:
        if r.n <= left:
            chosen.append((r.doc, r.version))
            left -= r.n
    if not chosen:
        return None
    those = docs.sparkSession.createDataFrame(chosen, "doc long, version long")
    bag = found.join(F.broadcast(those), ["doc", "version"]).groupBy("doc", "version").agg(F.max("label").alias("label"), F.first("bag").alias("bag")).toPandas()
    bag = bag.sort_values(["doc", "version"])
    return Network().fit([np.frombuffer(x, np.float16).reshape(-1, GRAMS + STATS) for x in bag["bag"]], bag["label"].to_numpy(float)).p


def score(docs: DataFrame, weights: dict[str, np.ndarray] | None, text_col: str = "text", threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``score`` and ``predicted`` (1: good)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        network = Network()
        if shared.value is not None:
            network.p = shared.value

        def work(texts: list[bytes | None]) -> list[pa.Array]:
            scores = np.full(len(texts), 0.5)
            if shared.value is not None:
                scores = np.round(network.scores(described(texts), len(texts)), 6)
            return [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]

        return work

    return add_columns(docs, text_col, ADDED, make, keep, as_bytes=True)


def keep_good(docs: DataFrame, weights, text_col: str = "text", **options) -> DataFrame:
    """The documents that the classifier keeps, columns of ``docs``."""
    inner = {c: f"q{i}" for i, c in enumerate(docs.columns)}  # free of the names the score adds
    scored = score(docs.select(*[F.col(f"`{c}`").alias(q) for c, q in inner.items()]), weights, inner[text_col], **options)
    return scored.where("predicted = 1").select(*[F.col(q).alias(c) for c, q in inner.items()])
