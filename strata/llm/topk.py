"""Exact top-k search by inner product over a pivot-distance index.

Vectors become integers, floor(256 x).  The largest inner product is the
smallest distance once every vector gets one more component, so that all have
the same length R: |q - v|^2 = |q|^2 + R^2 - 2 q.v, with 0 as the query's.  In that space

* index: every distinct vector is keyed by its nearest pivot and its distance to
  it; the distances of a pivot are cut into annuli with about as many vectors
  each, and an annulus into blocks, again stretches of the sorted distances;
* seed: a query meets the block next to it in its nearest annuli, which bounds its k-th best score;
* expansion: annuli stand in the order of their distance from the query, by the
  triangle inequality that of its own distance to the pivot from the annulus.  A query
  meets them in rounds, each some times as many as before, outward from the nearest;
  within an annulus only the blocks whose distances its bound allows.  Every round tightens the bounds;
* stop: the first annulus that cannot hold a score as good as the bound ends a
  query's search, since all others are farther still.  The rounds end with the last query.

Scores are sums of integers and exact; distances only exclude, with a margin
for rounding.  Equal vectors are one row of the index with their ``k + 1``
least ids, which is all that a result can hold, gathered within tasks before
they are shuffled.  Queries travel to a block packed together, as one row a run of queries.

Vectors without any structure (random directions in many dimensions) lie at
nearly equal distances; there the bounds exclude little, and most blocks are
scored, still in rounds and exactly.

Defined results: vectors that are NULL, or hold a NULL or non-finite component (a
product 256 x that is infinite counts as such), or have another number of components
than most rows, take no part; neither does a row without id.  Vectors with a component
of 2^20 and more are kept apart from the pivots: every query meets them, and they, as queries, meet all rows.  A score
beyond the range of a 64-bit integer becomes the end of that range, and ties there.
Ties go to the smaller id.  Repeated rows are one; one id with several
vectors is as many candidates, and as many queries.  A query never finds its own id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

#: Pivots, and the sample they are chosen from (distinct vectors, by a hash).
PIVOTS = 64
SAMPLE = 4_000
#: Index rows of a block, queries that meet it at once, and annuli of a pivot at most.
BLOCK = 512
QUERIES = 2_048
ANNULI = 64
#: Annuli that seed a bound, annuli of the first round, and how many times more each next round has come to.
SEEDS = 2
FIRST = 16
GROWTH = 8
SCALE = 256
#: Distinct vectors a task holds before it passes them on.
HELD = 50_000
#: Whole numbers of this size and more are wide: packed as 64-bit floats, which hold them exactly, and kept apart.
WIDE = float(1 << 28)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec, width): the rows that take part, with floor(SCALE x) as packed 32-bit integers, or floats where one is wide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, packed, width = [], [], []
            for i, v in enumerate(b.column(1)):
                if not v.values.null_count:
                    with np.errstate(over="ignore"):
                        x = np.floor(SCALE * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                    if np.isfinite(x).all():
                        rows.append(i)
                        packed.append((x if np.abs(x).max(initial=0) >= WIDE else x.astype(np.int32)).tobytes())
                        width.append(len(x))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(packed, pa.binary()), pa.array(width, pa.int32())], ["id", "vec", "width"])

    used = table.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return used.where("id IS NOT NULL AND v IS NOT NULL").mapInArrow(run, "id long, vec binary, width int")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(vec, ids): every distinct vector once with its k + 1 least ids, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.list_(pa.int64()))], ["vec", "ids"])
            held.clear()

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = held.setdefault(v, [])
                if i not in ids and (len(ids) <= k or i < ids[-1]):
                    ids.append(i)
                    ids.sort()
                    del ids[k + 1 :]
            if len(held) > HELD:
                yield from flush()
        yield from flush()

    merged: Column = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")
    partial = rows.mapInArrow(run, "vec binary, ids array<long>")
    salted = partial.groupBy("vec", F.pmod(F.xxhash64("ids"), F.lit(64)).alias("salt")).agg(merged)
    return salted.groupBy("vec").agg(merged)


# ------------------------------------------------------------------ geometry
def matrix(packed, width: int) -> np.ndarray:
    """Vectors of one kind, all wide or none."""
    packed = list(packed)
    kind = np.float64 if packed and len(packed[0]) > 4 * width else np.int32
    return np.frombuffer(b"".join(packed), kind).reshape(len(packed), width).astype(np.float64)


def is_wide(packed, width: int) -> np.ndarray:
    return np.array([len(v) > 4 * width for v in packed], bool)


class Pivots:
    """Pivots in the space with one more component, and distances to them."""

    def __init__(self, points: np.ndarray, radius2: float):
        self.points, self.radius2 = points, radius2

    def lifted(self, v: np.ndarray) -> np.ndarray:
        return np.hstack([v, np.sqrt(np.maximum(0.0, self.radius2 - (v * v).sum(axis=1, keepdims=True)))])

    def distances(self, x: np.ndarray) -> np.ndarray:
        """From lifted vectors, or queries with a last component of 0, to every pivot."""
        return np.sqrt(np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (self.points**2).sum(axis=1)[None] - 2 * x @ self.points.T))

    def keys(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = self.distances(self.lifted(v))
        nearest = d.argmin(axis=1)
        return nearest, d[np.arange(len(v)), nearest]

    @classmethod
    def fit(cls, sample: np.ndarray, radius2: float, n: int, rounds: int = 5) -> Pivots:
        """Centres of the sample, started from points that lie far apart."""
        space = cls(np.zeros((0, sample.shape[1] + 1)), radius2)
        if not len(sample):
            return space
        x = space.lifted(sample)
        chosen, far = [0], np.full(len(x), np.inf)
        while len(chosen) < min(n, len(x)):
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
            if far.max() <= 0:
                break
            chosen.append(int(far.argmax()))
        space.points = x[chosen]
        for _ in range(rounds):
            near = space.distances(x).argmin(axis=1)
            space.points = np.stack([x[near == p].mean(axis=0) if (near == p).any() else space.points[p] for p in range(len(space.points))])
        return space


def best_possible(q2: np.ndarray, radius2: float, distance: np.ndarray) -> np.ndarray:
    """The largest inner product at that distance or beyond, with a margin for rounding."""
    near = np.maximum(0.0, distance - 1e-6 * math.sqrt(radius2 + 1))
    return (q2 + radius2 - near**2) / 2 + 1e-9 * (q2 + radius2) + 1e-3


class Annuli:
    """Where the distances of each pivot are cut; annuli are numbered through, wide vectors have the last one."""

    def __init__(self, spans: list[tuple[int, int, list[float]]], pivots: int, block: int):
        """``spans``: (pivot, rows, its distances at equal shares of the rows, least and greatest included)."""
        self.base, self.edges, pivot, subs, edge, width = {}, {}, [], [], [], []
        for p, n, shares in sorted(spans):
            some = min(len(shares) - 1, -(-n // block))
            cuts = np.unique(np.array(shares)[np.linspace(0, len(shares) - 1, some + 1).round().astype(int)])
            cuts = cuts if len(cuts) > 1 else np.repeat(cuts, 2)
            self.base[p], self.edges[p] = len(pivot), cuts
            cells = len(cuts) - 1
            pivot += [p] * cells
            subs += [max(1, -(-n // (cells * block)))] * cells
            edge += cuts[:-1].tolist()
            width += np.maximum(np.diff(cuts), 1e-300).tolist()
        self.wide = len(pivot)
        self.pivot, self.subs = np.array([*pivot, 0]), np.array([*subs, 1])
        self.edge, self.width = np.array([*edge, 0.0]), np.array([*width, 1.0])
        self.low, self.high = np.full(self.wide + 1, np.inf), np.full(self.wide + 1, -np.inf)  # of the rows, once they are there

    def sub(self, cell: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """The block of an annulus that a distance falls to; never falls where the distance grows."""
        with np.errstate(over="ignore"):
            share = np.clip((distance - self.edge[cell]) / self.width[cell], 0.0, 1.0)
        return np.minimum((share * self.subs[cell]).astype(np.int64), self.subs[cell] - 1)

    def place(self, pivot: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = np.full(len(pivot), self.wide)
        for p, cuts in self.edges.items():
            of = pivot == p
            cell[of] = self.base[p] + np.searchsorted(cuts[1:-1], distance[of], "right")
        return cell, self.sub(cell, distance)


# ------------------------------------------------------------------- blocks
def scores_of(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, within the range of 64 bits."""
    largest = int(np.abs(q).max(initial=0)) * int(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    if largest < 1 << 53:
        return (q @ v.T).astype(np.int64)
    if largest < 1 << 63:
        return q.astype(np.int64) @ v.astype(np.int64).T
    whole = [np.array([[int(x) for x in row] for row in m.tolist()], dtype=object).reshape(m.shape) for m in (q, v)]
    return np.clip(whole[0] @ whole[1].T, _LEAST, _MOST).astype(np.int64)


def top_of_block(own: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, v: np.ndarray, distance: np.ndarray, ids: list, k: int) -> list[tuple[int, int, int]]:
    """(row of the query, id, score): the k best of a block, sorted by distance to its pivot.

    Only rows with a distance within [low, high] of a query can reach its bound.
    """
    first, last = np.searchsorted(distance, low, "left"), np.searchsorted(distance, high, "right")
    some = np.flatnonzero(first < last)
    if not len(some):
        return []
    a, z = int(first[some].min()), int(last[some].max())
    scores, leading, out = scores_of(q[some], v[a:z]), np.array([i[0] for i in ids[a:z]]), []
    need = min(k + 1, z - a)
    least = np.partition(scores, z - a - need, axis=1)[:, z - a - need]
    for r, s in enumerate(some.tolist()):
        at = np.flatnonzero(scores[r] >= least[r])
        at = at[np.lexsort((leading[at], ~scores[r, at]))][:need]
        found = sorted((-int(scores[r, c]), i) for c in at.tolist() for i in ids[a + c] if i != own[s])
        out += [(s, i, -n) for n, i in found[:k]]
    return out


_FOUND = "query long, turn long, id long, score long"
#: A run of queries for one block: their number, ids, texts, vectors and bounds on distances, each packed.
_PACKED = "cell int, sub long, n int, query binary, turn binary, vec binary, low binary, high binary"


def _judge(k: int, width: int):
    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        index, found = frame[frame["n"] == 0].sort_values("distance"), []
        v, distance, ids = matrix(index["vec"], width), index["distance"].to_numpy(), list(index["ids"])
        for p in frame[frame["n"] > 0].itertuples():
            own, turn = np.frombuffer(p.query, np.int64), np.frombuffer(p.turn, np.int64)
            q = matrix([p.vec], width * p.n).reshape(p.n, width)
            best = top_of_block(own, q, np.frombuffer(p.low), np.frombuffer(p.high), v, distance, ids, k) if len(index) else []
            found += [(own[s], turn[s], i, score) for s, i, score in best]
        return pd.DataFrame(found, columns=["query", "turn", "id", "score"], dtype="int64")

    return judge


def _visits(q: np.ndarray, wide: bool, bound: np.ndarray, space: Pivots, annuli: Annuli, ranks: tuple[int, int] | None) -> tuple[np.ndarray, ...]:
    """(query, annulus, first and last block, least and greatest distance) of a run of queries.

    ``ranks``: from which to which annulus in the order of their distance; None: the blocks that seed a bound.
    """
    cells = np.flatnonzero(annuli.low <= annuli.high)
    if wide or not len(space.points):
        d, away = np.zeros((len(q), len(cells))), np.zeros((len(q), len(cells)))
        best, reach = np.full(away.shape, np.inf), np.full(len(q), np.inf)
    else:
        q2 = (q * q).sum(axis=1)
        d = space.distances(np.hstack([q, np.zeros((len(q), 1))]))[:, annuli.pivot[cells]]
        away = np.maximum(0.0, np.maximum(annuli.low[cells][None] - d, d - annuli.high[cells][None]))  # no row of the annulus is nearer
        apart = cells == annuli.wide
        best = np.where(apart[None], np.inf, best_possible(q2[:, None], space.radius2, away))
        d[:, apart], away[:, apart] = 0.0, -1.0
        # a row at a distance beyond this one scores less than the bound
        reach = np.sqrt(np.maximum(0.0, q2 + space.radius2 - 2 * bound)) + 1e-6 * math.sqrt(space.radius2 + 1) + 1e-3
    rank = np.argsort(np.argsort(away, axis=1, kind="stable"), axis=1, kind="stable")
    start, stop = ranks or (0, SEEDS)
    r, c = np.nonzero((rank >= start) & (rank < stop) & (best >= bound[:, None]))
    low, high, cell = d[r, c] - reach[r], d[r, c] + reach[r], cells[c]
    if ranks is None:
        here = annuli.sub(cell, d[r, c])
        return r, cell, here, here, low, high
    return r, cell, annuli.sub(cell, low), annuli.sub(cell, high), low, high


def _route(asked: DataFrame, space: Pivots, annuli: Annuli, width: int, ranks: tuple[int, int] | None) -> DataFrame:
    """Runs of queries, packed, for every block that they meet."""
    shared = asked.sparkSession.sparkContext.broadcast((space, annuli))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, annuli = shared.value
        for b in batches:
            for start in range(0, len(b), QUERIES // 4):
                part = b.slice(start, QUERIES // 4)
                query, turn = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                vec = part.column(2).to_pylist()
                bound = part.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
                kinds = is_wide(vec, width)
                for wide in (False, True):
                    of = np.flatnonzero(kinds == wide)
                    rows, mine = [], [vec[i] for i in of]
                    r, cell, first, last, low, high = _visits(matrix(mine, width), wide, bound[of], space, annuli, ranks)
                    times = last - first + 1
                    sub = np.repeat(first, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                    visit = np.repeat(np.arange(len(r)), times)
                    order = np.lexsort((sub, cell[visit]))
                    sub, visit = sub[order], visit[order]
                    edges = np.flatnonzero(np.concatenate([[True], (cell[visit][1:] != cell[visit][:-1]) | (sub[1:] != sub[:-1]), [True]])) if len(visit) else [0]
                    for a, z in zip(edges[:-1], edges[1:], strict=True):
                        at = visit[a:z]
                        who = of[r[at]]
                        rows.append((int(cell[at[0]]), int(sub[a]), len(at), query[who].tobytes(), turn[who].tobytes(), b"".join(vec[i] for i in who), low[at].tobytes(), high[at].tobytes()))
                    if rows:
                        kind = (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5)
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kind, strict=True)], [x.split()[0] for x in _PACKED.split(", ")])

    return asked.mapInArrow(run, _PACKED)


def _score(index: DataFrame, blocks: DataFrame, packs: DataFrame, k: int, width: int) -> DataFrame:
    """(query, turn, id, score): the k best of every block for the queries packed for it.

    A block that many queries meet is there several times, for QUERIES of them each.
    """
    place = ["cell", "sub", "slice"]
    sent = packs.join(blocks, ["cell", "sub"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    load = sent.groupBy(*place).agg(F.ceil(F.sum("n") / QUERIES).cast("int").alias("parts"))
    columns = [*place, "part", "n", "query", "turn", "vec", "low", "high", "ids", "distance"]
    asked = sent.join(load, place).withColumn("part", F.pmod(F.xxhash64("query", "turn"), F.col("parts")).cast("int"))
    asked = asked.withColumns({"ids": F.lit(None).cast("array<long>"), "distance": F.lit(0.0)})
    rows = index.join(load, place).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumns({"n": F.lit(0)} | {c: F.lit(None).cast("binary") for c in ("query", "turn", "low", "high")})
    return asked.select(*columns).unionByName(rows.select(*columns)).groupBy(*place, "part").applyInPandas(_judge(k, width), _FOUND)


def build(distinct: DataFrame, width: int, pivots: int = PIVOTS, sample: int = SAMPLE, block: int = BLOCK):
    """(index, blocks, pivots, annuli) of distinct vectors; annuli are at most pivots x ANNULI, and one of wide vectors."""
    narrow = distinct.where(F.octet_length("vec") == 4 * width)
    few = narrow.orderBy(F.xxhash64("vec"), "vec").limit(sample).select("vec").collect()

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max((float((matrix(b.column(0).to_pylist(), width) ** 2).sum(axis=1).max()) for b in batches if len(b)), default=0.0)
        yield pa.RecordBatch.from_arrays([pa.array([most])], ["most"])

    radius2 = narrow.select("vec").mapInArrow(longest, "most double").agg(F.max("most")).first()[0] or 0.0
    space = Pivots.fit(matrix([r.vec for r in few], width), radius2, pivots)
    spark = distinct.sparkSession
    shared = spark.sparkContext.broadcast(space)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = b.column(0).to_pylist()
            pivot, distance, of = np.full(len(vec), -1, np.int32), np.zeros(len(vec)), np.flatnonzero(~is_wide(vec, width))
            if len(of):
                pivot[of], distance[of] = shared.value.keys(matrix([vec[i] for i in of], width))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pivot), pa.array(distance)], ["vec", "ids", "pivot", "distance"])

    keyed = stored(distinct.mapInArrow(key, "vec binary, ids array<long>, pivot int, distance double"), "vectors")
    inner = F.percentile_approx("distance", F.array(*[F.lit(i / ANNULI) for i in range(1, ANNULI)]), F.lit(2_000))
    spans = keyed.where("pivot >= 0").groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("near"), F.max("distance").alias("far"), inner.alias("inner")).collect()
    annuli = Annuli([(r.pivot, r.n, [r.near, *r.inner, r.far]) for r in spans], len(space.points), block)
    cut = spark.sparkContext.broadcast(annuli)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, sub = cut.value.place(*(b.column(c).to_numpy(zero_copy_only=False) for c in (2, 3)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(cell.astype(np.int32)), pa.array(sub)], ["vec", "ids", "distance", "cell", "sub"])

    placed = stored(keyed.mapInArrow(put, "vec binary, ids array<long>, distance double, cell int, sub long"), "placed")
    # many equal distances can fill a block beyond its size; it is then cut by a hash
    slices = F.ceil(F.count(F.lit(1)) / (4 * block)).cast("int").alias("slices")
    blocks = stored(placed.groupBy("cell", "sub").agg(slices, F.min("distance").alias("low"), F.max("distance").alias("high")), "blocks")
    for r in blocks.groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        annuli.low[r.cell], annuli.high[r.cell] = r.low, r.high
    index = placed.join(blocks.select("cell", "sub", "slices"), ["cell", "sub"]).withColumn("slice", F.pmod(F.xxhash64("vec"), F.col("slices")).cast("int")).drop("slices")
    return stored(index, "index"), blocks.select("cell", "sub", "slices"), space, annuli


def top_k(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", rounds: list[int] | None = None, **options) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``table`` chosen by ``is_query`` (over ``id``), against all rows.

    ``rounds``, where given, receives for the seeds and each round the number of times that a query met a block.
    """
    rows = vectors(table, id_col, vector_col)
    usual = rows.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    width = usual.width if usual else 0
    rows = stored(rows.where(F.col("width") == width).drop("width"), "integers")
    distinct = stored(distinct_vectors(rows, k), "distinct")
    index, blocks, space, annuli = build(distinct, width, **options)
    asked = stored(rows.where(is_query).distinct().select(F.col("id").alias("query"), F.xxhash64("vec").alias("turn"), "vec"), "queries")

    order = Window.partitionBy("query", "turn").orderBy(F.desc("score"), "id")
    best = stored(asked.sparkSession.createDataFrame([], _FOUND + ", rank int"), "best")
    ranks: tuple[int, int] | None = None
    while ranks is None or ranks[0] < annuli.wide + 1:
        # the end of the range says nothing about what lies beyond it
        bounds = best.where((F.col("rank") == k) & (F.col("score") > _LEAST)).select("query", "turn", F.col("score").cast("double").alias("bound"))
        bounded = asked.join(bounds, ["query", "turn"], "left").select("query", "turn", "vec", F.coalesce("bound", F.lit(-math.inf)).alias("bound"))
        packs = stored(_route(bounded, space, annuli, width, ranks), "packs")
        met = packs.agg(F.sum("n")).first()[0] or 0
        if rounds is not None:
            rounds.append(met)
        if not met:  # annuli stand in order: who meets none now meets none later
            break
        found = best.drop("rank").unionByName(_score(index, blocks, packs, k, width)).distinct()
        best = stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        ranks = (0, FIRST) if ranks is None else (ranks[1], ranks[1] * GROWTH)
    return best.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
