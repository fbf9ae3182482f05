"""Mixing sources to target weights by systematic sampling (built-in functions only).

Every source gets a target share of words by weight, bounded by ``max_repeat``
times its size; within a source, each document expects ``target / source size``
copies.  Documents stand in a fixed order, their expected copies are summed
along it, one random offset per source is added, and a document is emitted once
for each integer the running sum crosses.  The number of copies of a document
is therefore the floor or the ceiling of its expectation, and every stretch of
the order contributes its expectation to within one copy.

The order is (size class, salt, size, md5 of the id, text hash).  Size classes
(powers of two) stratify, so that taken words come near the target even when a
few documents hold most words.  Salts cut a class, and with it a group of
equal copies or a hot source, into cells small enough for one task: the number
of documents is counted per cell first, so that the prefix sum is a sum over
cells plus a rank within one cell, and no window ever holds a whole source.

Defined results: NULL text has size 0; a NULL source is a source of its own and
stands last; sources of size 0 have target 0 and are not taken; repeated rows
are taken independently.  Rows without id are dealt to cells by their text, so
that many of them fill many cells; rows of one id stand in one cell, which is
sorted (and spilled, where large) and numbered row by row, never held.  An empty table
gives an empty table.  Extra columns pass through; a column of ``docs`` named as
one of the four added ones is replaced by it in :func:`plan_mix` and kept in
:func:`mix`; any other names will do, as columns travel under numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, stored

#: Weights of the sources in order of code point, repeating.
WEIGHTS = (5, 2, 1)
#: Salts of a size class: SALTS at least, more where the corpus has more documents
#: than that many times DOCS_PER_SALT.  They are part of the fixed order.
SALTS = 64
DOCS_PER_SALT = 200_000
#: Columns that plan_mix adds.
ADDED = ("size", "source_size", "target", "copies")
SEED = "mix-1"

_C = "__mix_"  # prefix of columns that exist only inside


def words_in(text: str | Column) -> Column:
    """Number of words; NULL counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _unit16(text: Column) -> Column:
    """A multiple of 2^-16 in [0, 1), fixed by the text.

    So coarse that rank x rate + offset stays exact where rate is an integer.
    """
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("double") / 65536.0


def source_targets(per_source: DataFrame, share: float, max_repeat: int, weights=WEIGHTS) -> DataFrame:
    """(key, name, size) rows -> the same plus ``target``: shares by weight, capped.

    A source is capped when its weighted share would pass ``max_repeat`` x its
    size; what it leaves is shared among the others by weight, until none is
    above.  In order of cap / weight the capped sources are a prefix, so one
    running sum finds the common level.  One row per source goes through one
    task, never documents.
    """
    order = Window.orderBy(F.col(f"{_C}null"), F.encode(f"{_C}name", "UTF-8"))
    rank = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank + 1).cast("int"))
    everyone = Window.partitionBy()
    d = (
        per_source.withColumn(f"{_C}w", weight.cast("double"))
        .withColumn(f"{_C}cap", (F.col(f"{_C}source_size") * max_repeat).cast("double"))
        .withColumn(f"{_C}ratio", F.col(f"{_C}cap") / F.col(f"{_C}w"))
    )
    before = Window.orderBy(f"{_C}ratio", f"{_C}null", F.encode(f"{_C}name", "UTF-8")).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(f"{_C}source_size").over(everyone) * F.lit(float(share))
    d = (
        d.withColumn(f"{_C}left", total - F.coalesce(F.sum(f"{_C}cap").over(before), F.lit(0.0)))
        .withColumn(f"{_C}wleft", F.sum(f"{_C}w").over(everyone) - F.coalesce(F.sum(f"{_C}w").over(before), F.lit(0.0)))
        .withColumn(f"{_C}level", F.col(f"{_C}left") / F.col(f"{_C}wleft"))
    )
    # The level is the first one that its own source, and so every later one, does not reach.
    level = F.min(F.when(F.col(f"{_C}level") <= F.col(f"{_C}ratio"), F.struct(f"{_C}ratio", f"{_C}level"))).over(everyone)
    d = d.withColumn(f"{_C}at", level[f"{_C}level"])
    target = F.least(F.col(f"{_C}cap"), F.coalesce(F.col(f"{_C}at") * F.col(f"{_C}w"), F.col(f"{_C}cap")))
    return d.withColumn(f"{_C}target", target).drop(f"{_C}w", f"{_C}cap", f"{_C}ratio", f"{_C}left", f"{_C}wleft", f"{_C}level", f"{_C}at")


def _planned(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    share: float = 1.5, max_repeat: int = 2, weights=WEIGHTS, salts: int | None = None, seed: str = SEED,
) -> DataFrame:
    """Columns of ``docs`` under their numbers, and size, source_size, target and copies under the inner prefix."""
    salts = salts or max(SALTS, docs.count() // DOCS_PER_SALT)
    key = [f"{_C}null", f"{_C}name", f"{_C}class", f"{_C}salt"]
    text, source = F.col(f"c{docs.columns.index(text_col)}"), F.col(f"c{docs.columns.index(source_col)}")
    idt = F.coalesce(F.col(f"c{docs.columns.index(id_col)}").cast("string"), F.concat(F.lit("|"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    rows = (
        docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
        .withColumn(f"{_C}size", words_in(text))
        .withColumn(f"{_C}null", source.isNull())
        .withColumn(f"{_C}name", F.coalesce(source.cast("string"), F.lit("")))
        .withColumn(f"{_C}class", F.length(F.bin(f"{_C}size")))
        .withColumn(f"{_C}hash", F.md5(F.concat(F.lit(seed), idt).cast("binary")))
        .withColumn(f"{_C}salt", F.conv(F.substring(f"{_C}hash", 1, 8), 16, 10).cast("long") % salts)
    )
    # written, as three sums are read off it: a row for each cell, so that texts are gone through once for them
    cells = stored(rows.groupBy(*key).agg(F.count(F.lit(1)).alias(f"{_C}n"), F.sum(f"{_C}size").alias(f"{_C}s")), "mix-cells")
    classes = cells.groupBy(*key[:3]).agg(F.sum(f"{_C}n").alias(f"{_C}cn"), F.sum(f"{_C}s").alias(f"{_C}cs"))
    targets = source_targets(
        classes.groupBy(*key[:2]).agg(F.sum(f"{_C}cs").alias(f"{_C}source_size")), share, max_repeat, weights
    )
    down = Window.partitionBy(*key[:2]).orderBy(f"{_C}class").rowsBetween(Window.unboundedPreceding, -1)
    starts = classes.withColumn(f"{_C}cbase", F.coalesce(F.sum(f"{_C}cn").over(down), F.lit(0))).drop(f"{_C}cn", f"{_C}cs")
    along = Window.partitionBy(*key[:3]).orderBy(f"{_C}salt").rowsBetween(Window.unboundedPreceding, -1)
    rate = F.when(F.col(f"{_C}source_size") > 0, F.col(f"{_C}target") / F.col(f"{_C}source_size")).otherwise(0.0)
    placed = (
        cells.withColumn(f"{_C}sbase", F.coalesce(F.sum(f"{_C}n").over(along), F.lit(0)))
        .join(starts, key[:3]).join(targets, key[:2])
        .select(
            *key, f"{_C}source_size", f"{_C}target", rate.alias(f"{_C}rate"),
            (F.col(f"{_C}cbase") + F.col(f"{_C}sbase")).alias(f"{_C}base"),
            _unit16(F.concat(F.lit(seed), F.col(f"{_C}null").cast("string"), F.lit("|"), F.col(f"{_C}name"))).alias(f"{_C}offset"),
        )
    )
    order = Window.partitionBy(*key).orderBy(f"{_C}size", f"{_C}hash", F.xxhash64(text))
    ranked = rows.withColumn(f"{_C}rank", F.row_number().over(order))
    upto = lambda n: F.floor(n * F.col(f"{_C}rate") + F.col(f"{_C}offset"))
    position = F.col(f"{_C}base") + F.col(f"{_C}rank")
    return ranked.join(placed, key).withColumn(f"{_C}copies", (upto(position) - upto(position - 1)).cast("long"))


def _named(docs: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in but]


def plan_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` plus ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``max_repeat``)."""
    return _planned(docs, **options).select(*_named(docs, ADDED), *[F.col(f"{_C}{c}").alias(c) for c in ADDED])


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as many times as it is taken, columns of ``docs``."""
    copies = F.explode(F.array_repeat(F.lit(1), F.col(f"{_C}copies").cast("int")))
    return _planned(docs, **options).withColumn(f"{_C}copy", copies).select(*_named(docs))
