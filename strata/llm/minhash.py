"""Near-duplicate detection with DartMinHash signatures.

A text is a weighted set of word shingles (runs of five words; a shingle weighs
as often as it occurs, or 1 with ``counted=False``, for the similarity of plain
sets).  Two texts are alike by sum(min) / sum(max) of their weights, which is
that of sets where no shingle repeats.  Hashed darts are thrown
into every element's region of weight x rank, the same darts wherever the
element occurs: cells of doubling size hold a Poisson number of darts, each
with a coordinate, a weight position and a rank.  A text keeps the darts below
its elements' weights, cell after cell, until each of the ``COORDINATES`` has
one; the earliest of each coordinate is its signature.  Two signatures agree in a
coordinate with the chance sum(min) / sum(max) of their weights, and few
darts are looked at whatever the size of the text.

Texts with equal shingle sets are one node.  Nodes that share a band of
coordinates are compared:

* first with the node that shares most bands in its bucket, in groups of
  bounded size, in which all pairs not yet connected are checked exactly;
* then, in buckets that still hold several components, all pairs across components:
  signatures decide which can reach the threshold (an agreement below
  ``AGREEMENT`` excludes it but for about one in a million), shingles decide the rest.

Large buckets are cut into chunks and every pair of chunks is a group.  Only links
that join two components leave a group, so that a group of copies never becomes its pairs.
Classes are the connected components of all links, found by label propagation
in the shared folder; nothing but counts reaches the driver.

Defined results: a text below five words is one shingle, one without words (or
NULL) is a class of its own.  The class id is the least id in the class.  Rows
with the same id and text are one document; rows with the same id and other texts are
judged each by its own, and may have several classes: where an id would name two, one of them has a
number above 2^62 instead.  A row without id is known by its text, and
has a negative number.  Other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import coded_words, give_back, mix64, slices, stored, unit
from strata.llm.substring import run_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 4
COORDINATES = BANDS * ROWS
#: Share of equal coordinates that two nodes have at least if their similarity is SIMILARITY.
AGREEMENT = 0.6
#: Members of a group whose shingles, or whose signatures only, are compared in one call.
CHUNK = 512
WIDE = 2_048
#: Members that a call gets (several small groups), and the least number of calls.
BIN = 4_000
BINS = 64

#: The first cell of ranks is [0, FIRST), each later one as large as all before it.
FIRST = 1 / 16


# ---------------------------------------------------------------- shingles
def shingles(texts: list[bytes | None], counted: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed shingles of many texts, ascending within a text; the text of each; its weight."""
    words, codes, starts = coded_words(texts)
    hashes = word_hashes(words)[codes]
    names, owners, weights = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for i, (a, z) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        if z > a:
            found, n = np.unique(run_hashes(hashes[a:z], min(SHINGLE, z - a)), return_counts=True)
            names.append(found)
            owners.append(np.full(len(found), i))
            weights.append(n.astype(float) if counted else np.ones(len(found)))
    return np.concatenate(names), np.concatenate(owners), np.concatenate(weights)


def occurrences(elements: np.ndarray, owner: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sets as plain ones: a name for each occurrence, ascending within a text; the text of each.

    The first occurrence keeps the element's name, so that common names of two texts are the
    sum of the lesser weights, and all names that of the greater.
    """
    times = weights.astype(np.int64)
    if not (times > 1).any():
        return elements, owner
    turn = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    names, of = np.repeat(elements, times), np.repeat(owner, times)
    again = turn > 0
    names[again] = mix64(names[again] ^ mix64(turn[again].astype(np.uint64)))
    order = np.lexsort((names, of))
    return names[order], of[order]


# ------------------------------------------------------------------- darts
_CHANCES: dict[float, np.ndarray] = {}


def poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """The number of darts in a region of that size, from a uniform number."""
    if mean not in _CHANCES:
        k = np.arange(int(mean + 12 * mean**0.5 + 24))
        log = k * np.log(mean) - mean - np.cumsum(np.log(np.maximum(k, 1)))
        _CHANCES[mean] = np.cumsum(np.exp(log))
    return np.searchsorted(_CHANCES[mean], u, side="right")


def throw(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, coordinates: int = COORDINATES) -> np.ndarray:
    """The signatures of ``n`` sets: the names of the earliest darts, 0 where a set is empty."""
    signature = np.zeros(n * coordinates, np.uint32)
    filled = np.zeros(n * coordinates, bool)
    filled.reshape(n, coordinates)[np.bincount(owner, minlength=n) == 0] = True
    cell, low, high = 0, 0.0, FIRST
    while True:
        open_sets = ~filled.reshape(n, coordinates).all(axis=1)
        if not open_sets.any():
            return signature.reshape(n, coordinates)
        live = np.flatnonzero(open_sets[owner])
        thrown = []
        floor, ceiling, level = 0.0, 1.0, 0
        while len(live):  # cells of weight: [0, 1), [1, 2), [2, 4) ...
            seed = mix64(elements[live] ^ mix64(np.uint64(cell * 64 + level) + np.zeros(1, np.uint64)))
            count = poisson(unit(seed), (ceiling - floor) * (high - low))
            which = np.repeat(np.arange(len(live)), count)
            turn = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            dart = mix64(seed[which] + (turn + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            at = floor + (ceiling - floor) * unit(mix64(dart + np.uint64(1)))
            hit = at < weights[live[which]]
            thrown.append((owner[live[which[hit]]], dart[hit]))
            floor, ceiling, level = ceiling, ceiling * 2, level + 1
            live = live[weights[live] > floor]
        of, dart = (np.concatenate(x) for x in zip(*thrown, strict=True))
        place = of * coordinates + (dart % np.uint64(coordinates)).astype(np.int64)
        rank = mix64(dart + np.uint64(2))
        order = np.lexsort((dart, rank, place))
        first = order[np.concatenate([np.ones(min(1, len(order)), bool), place[order][1:] != place[order][:-1]])]
        first = first[~filled[place[first]]]
        signature[place[first]] = (mix64(dart[first] + np.uint64(3)) >> np.uint64(32)).astype(np.uint32)
        filled[place[first]] = True
        cell, low, high = cell + 1, high, high * 2


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different bands apart."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None] + np.zeros((len(signatures), 1), np.uint64)
    for r in range(ROWS):
        key = mix64(key * np.uint64(3) + parts[:, :, r])
    return key.view(np.int64)


# -------------------------------------------------------------- comparison
def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common elements of two ascending arrays of distinct elements."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


class Union:
    def __init__(self, labels):
        self.up = {x: x for x in labels}

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a, b) -> None:
        self.up[self.root(a)] = self.root(b)


def _across(component: np.ndarray, signatures: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each member outside the largest component, and those of other components it may be similar to.

    The most alike come first.
    """
    values, at, sizes = np.unique(component, return_inverse=True, return_counts=True)
    largest = int(sizes.argmax())
    for x in np.flatnonzero(at != largest).tolist():
        agree = (signatures == signatures[x]).sum(axis=1)
        some = np.flatnonzero((agree >= AGREEMENT * signatures.shape[1]) & (at != at[x]))
        yield x, some[np.argsort(-agree[some], kind="stable")]


def _groups(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, components and signatures of each group in a bin, every node once."""
    frame_g, nodes = pd.factorize(frame["g"])[0], frame["node"].to_numpy()
    signatures = np.frombuffer(b"".join(frame["signature"]), np.uint32).reshape(len(frame), -1)
    component = frame["component"].to_numpy()
    order = np.lexsort((nodes, frame_g))
    new = np.concatenate([[True], (frame_g[order][1:] != frame_g[order][:-1]) | (nodes[order][1:] != nodes[order][:-1])])
    order = order[new]
    edges = np.flatnonzero(np.concatenate([[True], frame_g[order][1:] != frame_g[order][:-1], [True]]))
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield order[a:z], component[order[a:z]], signatures[order[a:z]]


def _alike(frame: pd.DataFrame) -> pd.DataFrame:
    """The members of each group that may be similar to one of another component."""
    found = []
    for rows, component, signatures in _groups(frame):
        seen: set[int] = set()
        for x, some in _across(component, signatures):
            if len(some):
                seen.update([x, *some.tolist()])
        found += rows[sorted(seen)].tolist()
    return frame.iloc[found][["g", "node", "component"]]


def _links(frame: pd.DataFrame) -> pd.DataFrame:
    """Links of each group: pairs above the threshold that join what was not connected."""
    nodes, elements, out = frame["node"].to_numpy(), frame["elements"].to_numpy(), []
    for rows, component, signatures in _groups(frame):
        sets = [np.frombuffer(e, np.uint64) for e in elements[rows]]
        union = Union(component.tolist())
        for x, some in _across(component, signatures):
            for y in some.tolist():
                if union.root(component[x]) != union.root(component[y]) and similarity(sets[x], sets[y]) >= SIMILARITY:
                    union.join(component[x], component[y])
                    out.append((int(nodes[rows[x]]), int(nodes[rows[y]])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


# ------------------------------------------------------------------- Spark
def _known(id_col: str, text_col: str) -> Column:
    """A document's number: its id, or a negative hash of its text."""
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), -1 - F.pmod(F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), F.lit(1 << 62)))


def _version(text_col: str) -> Column:
    """Tells texts apart that stand under one number."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> DataFrame:
    """(doc, version, set_a, set_b, signature): a 128-bit name of the shingle set (NULL: no words) and the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.binary()).to_pylist()
            for i, j in slices(texts):
                elements, owner, weights = shingles(texts[i:j], counted)
                signatures = throw(elements, weights, owner, j - i)
                some = np.bincount(owner, minlength=j - i) > 0
                names = []
                for k in (1, 2):  # a sum over the elements names the set
                    name = np.zeros(j - i, np.uint64)
                    np.add.at(name, owner, mix64(mix64(elements + np.uint64(k)) + weights.astype(np.uint64)))
                    names.append(pa.array(name.view(np.int64), mask=~some))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), *names, pa.array([s.tobytes() if ok else None for s, ok in zip(signatures, some, strict=True)], pa.binary())], ["doc", "version", "set_a", "set_b", "signature"])
        give_back()

    rows = docs.select(_known(id_col, text_col).alias("doc"), _version(text_col).alias("version"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc long, version long, set_a long, set_b long, signature binary")


def _nodes(some: DataFrame) -> DataFrame:
    """(node, doc, version, set_a, set_b, signature): every shingle set once, with the row that stands for it.

    A set is known by the least number of its rows (a number below 0, of a row without id, only if it has
    no other).  Of several sets with one least number the first has it, the others one of their own.
    """
    row = F.struct((F.col("doc") < 0).alias("unnamed"), "doc", "version")
    sets = some.groupBy("set_a", "set_b").agg(F.min(row).alias("row"), F.first("signature").alias("signature"))
    sets = stored(sets.select("row.doc", "row.version", "set_a", "set_b", "signature"), "sets")
    name = F.struct("set_a", "set_b")
    first = sets.groupBy("doc").agg(F.min(name).alias("first"))
    own = F.lit(1 << 62) + F.pmod(F.xxhash64("set_a", "set_b"), F.lit(1 << 62))
    node = F.when(name == F.col("first"), F.col("doc")).otherwise(own).alias("node")
    return sets.join(first, "doc").select(node, "doc", "version", "set_a", "set_b", "signature")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(key, node, size) of the band buckets with two nodes or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                keys = band_keys(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(len(b), -1))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(np.asarray(b.column(0)), BANDS))], ["key", "node"])

    bands = nodes.select("node", "signature").mapInArrow(run, "key long, node long")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return bands.join(shared, "key")


def _elements(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, counted: bool) -> DataFrame:
    """(node, elements) of the wanted nodes (node, doc, version): their shingles, each as often as it weighs, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            for i, j in slices(texts):
                elements, owner = occurrences(*shingles(texts[i:j], counted))
                edges = np.searchsorted(owner, np.arange(j - i + 1))
                packed = [elements[a:z].tobytes() for a, z in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(packed, pa.binary())], ["node", "elements"])

    rows = docs.select(_known(id_col, text_col).alias("doc"), _version(text_col).alias("version"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.join(wanted, ["doc", "version"]).select("node", "text")
    return rows.mapInArrow(run, "node long, elements binary").dropDuplicates(["node"])


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of the links (a, b) is connected to."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("over"), F.col("component").alias("further"))
        moved = stored(step.join(jump, step["component"] == jump["over"]).select("node", F.least("component", "further").alias("component"), "was"), "labels")
        if moved.where("component <> was").isEmpty():
            return moved.select("node", "component")
        labels = moved.select("node", "component")


def _binned(groups: DataFrame) -> DataFrame:
    """Groups dealt to bins of about BIN members, each bin one call; no group is cut."""
    return groups.withColumn("bin", F.pmod(F.xxhash64("g"), F.lit(max(BINS, groups.count() // BIN))))


def _grouped_links(groups: DataFrame, nodes: DataFrame, elements: DataFrame) -> DataFrame:
    """The links within stored groups (g, node, component)."""
    full = _binned(groups).join(nodes.select("node", "signature"), "node").join(elements, "node")
    return full.select("bin", "g", "node", "component", "signature", "elements").groupBy("bin").applyInPandas(_links, "a long, b long")


def _pair_with_hubs(buckets: DataFrame) -> DataFrame:
    """Groups (g, node, component): each bucket's nodes with the one that shares most bands, in chunks."""
    shares = buckets.groupBy("node").agg(F.sum("size").alias("shares"))
    top = F.max(F.struct(F.col("shares"), (-F.col("node")).alias("minus"))).alias("top")
    hubs = buckets.join(shares, "node").groupBy("key").agg(top).select("key", (-F.col("top.minus")).alias("hub"))
    pairs = stored(buckets.join(hubs, "key").where("node <> hub").select("hub", "node").distinct(), "pairs")
    chunks = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    dealt = pairs.join(chunks, "hub").withColumn("g", F.concat_ws(":", "hub", F.pmod(F.xxhash64("node"), F.col("chunks"))))
    members = dealt.select("g", "node").unionByName(dealt.select("g", F.col("hub").alias("node")).distinct())
    return members.withColumn("component", F.col("node"))


def _still_apart(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Groups (g, node, component) that hold every pair across components of every bucket.

    Members of a bucket's largest component meet only the others, in chunks;
    chunks of the others meet each other.
    """
    apart = stored(buckets.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component")), "apart")
    sizes = apart.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("name"))
    keys = sizes.groupBy("key").agg(
        F.count(F.lit(1)).alias("components"), F.sum("n").alias("size"), F.sum("name").alias("name"),
        F.max(F.struct("n", "component")).alias("top"),
    ).where("components > 1")
    keys = keys.groupBy("components", "size", "name", "top").agg(F.min("key").alias("key"))  # buckets of the same members once
    keys = keys.select("key", F.col("top.component").alias("largest"), F.ceil(F.col("top.n") / WIDE).alias("large"), F.ceil((F.col("size") - F.col("top.n")) / WIDE).alias("small"))
    dealt = apart.join(keys, "key").withColumn("inside", F.col("component") == F.col("largest"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("inside"), F.col("large")).otherwise(F.col("small"))))
    to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    with_largest = F.when(F.col("inside"), F.transform(to("small"), lambda i: F.concat_ws(":", "key", F.lit("L"), i, "own")))
    with_largest = with_largest.otherwise(F.transform(to("large"), lambda j: F.concat_ws(":", "key", F.lit("L"), "own", j)))
    others = F.when(F.col("inside"), F.array().cast("array<string>")).otherwise(
        F.transform(to("small"), lambda j: F.concat_ws(":", F.col("key"), F.least("own", j), F.greatest("own", j)))
    )
    return dealt.select(F.explode(F.concat(with_largest, others)).alias("g"), "node", "component")


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> DataFrame:
    """(doc, version, class, stands): every row's number, the hash of its text, its class, and whether it stands for the class."""
    sketched = stored(sketch(docs, id_col, text_col, counted), "sketches")
    some = sketched.where("signature IS NOT NULL")
    nodes = stored(_nodes(some), "nodes")
    buckets = stored(_buckets(nodes), "buckets")
    wanted = nodes.select("node", "doc", "version").join(buckets.select("node").distinct(), "node")
    elements = stored(_elements(docs, wanted, id_col, text_col, counted), "shingles")

    links = stored(_grouped_links(stored(_pair_with_hubs(buckets), "groups"), nodes, elements), "links")
    apart = stored(_still_apart(buckets, components(links)), "groups")
    alike = _binned(apart).join(nodes.select("node", "signature"), "node").select("bin", "g", "node", "component", "signature")
    alike = stored(alike.groupBy("bin").applyInPandas(_alike, "g string, node long, component long"), "alike")
    more = stored(_grouped_links(alike, nodes, elements), "links")

    labels = components(links.unionByName(more))
    named = nodes.join(labels, "node", "left").select("set_a", "set_b", F.coalesce("component", "node").alias("class"), "node", F.struct("doc", "version").alias("row"))
    stands = (F.col("node") == F.col("class")) & (F.struct("doc", "version") == F.col("row"))
    judged = some.select("doc", "version", "set_a", "set_b").join(named, ["set_a", "set_b"]).select("doc", "version", "class", stands.alias("stands"))
    alone = sketched.where("signature IS NULL").select("doc", "version", F.col("doc").alias("class"), F.lit(True).alias("stands"))
    return judged.unionByName(alone)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> DataFrame:
    """(doc, class): every document's number and the least number in its class."""
    return classify(docs, id_col, text_col, counted).select("doc", "class")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> DataFrame:
    """One document of each class, once; columns of ``docs``."""
    place = {c: f"d{i}" for i, c in enumerate(docs.columns)}  # free of the names added here
    rows = docs.select(*[F.col(f"`{c}`").alias(d) for c, d in place.items()])
    key = [_known(place[id_col], place[text_col]).alias("doc"), _version(place[text_col]).alias("version")]
    chosen = classify(rows, place[id_col], place[text_col], counted).where("stands").select("doc", "version").distinct()
    kept = rows.select("*", *key).join(chosen, ["doc", "version"], "left_semi").dropDuplicates(["doc", "version"])
    return kept.select(*[F.col(d).alias(c) for c, d in place.items()])
