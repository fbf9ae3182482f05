"""Main text of web pages: the contiguous stretch of a page with the highest score.

A page is read as a sequence of tags and words.  Words score by where they stand (their
block element, its class words, inside a link or not), mostly above zero; tags score
below zero; one linear scan finds the contiguous stretch with the highest sum.  Scores
are whole thousandths, so that sums are exact; of equal stretches the one that starts
first, then the longest, is taken.

Weights are log odds learned from labelled pages: pages that mark their own main
part (``article``, ``main``, ``role=main``, ``itemprop=articleBody``).  They are counted over all
such pages, and the ``CONTEXTS`` most frequent kinds of words and of tags get a weight (whole
frequency classes).  Other words score by being in a link or not, other tags as the mildest.
A page's own mark, where it has one, settles the sign of its words.

Elements that are by name, role or class no part of an article (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, comments) score nothing and are left out, so
that one amid an article does not cut it.  Blocks at the ends of the stretch are kept whole.

Defined results: NULL, empty and wordless pages give an empty text.  Markup may be
broken: unclosed, stray and cut-off tags, quotes and comments are read as browsers do, roughly.
Character references are decoded after tags are found; white space inside a block, line
breaks (``br``) included, is one space.  Repeated rows are extracted alike, other columns pass
through, a column named like an added one is replaced.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import add_columns, most_frequent, stored

CONTEXTS = 4_096
#: Thousandths: the highest weight in size, the least and most that a tag costs, what a word in or out of a page's own mark scores at least, and a tag inside it.
HIGHEST, MILDEST, COSTLIEST, MARKED, TAG_IN_MARK = 4_000, 100, 500, 500, 1

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noframes noembed".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
# What is no part of an article, by element, role, and words of class or id.
NEVER = frozenset("head nav footer aside form button select input label fieldset menu dialog svg canvas object audio video map".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
REMARKS = frozenset("comment comments disqus discussion reply replies respond".split())
ASIDES = REMARKS | frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead "
    "notice notices cookie cookies consent gdpr banner popup modal overlay newsletter subscribe signup login share sharing social related recommended widget toolbar "
    "pagination pager form hidden".split()
)
PAGE = frozenset({"html", "body", "main"})

MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>?|</?[a-zA-Z](?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+>?", re.S)
NAME = re.compile(r"</?([^\s/>]+)")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|(?<=\s)(hidden)(?=[\s/>])""", re.I)
CLASS_WORDS = re.compile(r"[a-zA-Z]+"), re.compile(r"[a-z]+|[A-Z][a-z]*")  # sideBar: itself, and its parts


class Tag(NamedTuple):
    """A tag: its kind for the weights, whether it stands in a left-out element, and in the page's own mark."""

    kind: str
    out: bool
    marked: bool
    block: int


class Words(NamedTuple):
    """Text between tags: its kind, its place and its text, references decoded."""

    kind: str
    out: bool
    marked: bool
    block: int
    text: str
    count: int


class Open(NamedTuple):
    """An open element and what holds inside it."""

    name: str
    out: bool
    marked: bool
    link: bool
    kind: str


def _attributes(tag: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(tag)} if "=" in tag or "hidden" in tag else {}


def _opened(name: str, attrs: dict[str, str], top: Open) -> Open:
    """The state inside a new element."""
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    words = {w.lower() for pattern in CLASS_WORDS for w in pattern.findall(names)}
    role = attrs.get("role", "").lower()
    is_mark = name in ("article", "main") or role == "main" or attrs.get("itemprop") == "articleBody"
    out = top.out or name in NEVER or role in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true"
    out = out or (name == "header" and not top.marked)
    if name not in PAGE:
        out = out or bool(words & (REMARKS if is_mark else ASIDES))
    kind = top.kind if name in INLINE else ".".join([name, *sorted(words)[:3]])
    return Open(name, out, not out and (top.marked or is_mark), top.link or name == "a", kind)


def _close(stack: list[Open], names: frozenset[str] | set[str], until: frozenset[str] | set[str] = frozenset()) -> None:
    """Close the innermost open element of ``names`` and all inside it, unless one of ``until`` is met first."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            del stack[k:]
            return
        if stack[k].name in until:
            return


def read_page(page: str | None) -> list[Tag | Words]:
    """The tags and words of a page in order; words of one block carry its number."""
    page, out, at, block = page or "", [], 0, 0
    stack = [Open("", False, False, False, "")]

    def words(text: str) -> None:
        if text:
            top = stack[-1]
            out.append(Words(f"{top.kind}{' a' * top.link}", top.out, top.marked, block, html.unescape(text), len(text.split())))

    while m := MARKUP.search(page, at):
        words(page[at : m.start()])
        at, tag = m.end(), m[0]
        if tag[1] in "!?":
            continue
        name = NAME.match(tag)[1].lower()
        if name not in INLINE:
            block += 1
        elif name in ("br", "wbr") and tag[1] != "/":
            words(" " if name == "br" else "")
        top = stack[-1]
        if tag[1] == "/":
            _close(stack, {name}, PAGE if name in INLINE else frozenset())
            out.append(Tag(f"<{name}>", top.out, top.marked, block))
            continue
        if name not in INLINE:
            _close(stack, {"p"}, {"article", "section", "div", "td", "table", "button"})
        if name in CLOSES:
            _close(stack, CLOSES[name], HOLDS[name])
        state = _opened(name, _attributes(tag), stack[-1])
        out.append(Tag(f"<{name}>", state.out, state.marked, block))
        if name in RAW:  # its content is no markup
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            end = page.find(">", at)
            at = end + 1 if end >= 0 else len(page)
        elif name not in VOID and not tag.endswith("/>"):
            stack.append(state)
    words(page[at:])
    return out


# ----------------------------------------------------------------- weights
def context_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(kind, inside, outside, n): how often each kind of word and tag stands in and out of the main part of labelled pages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def flush() -> pa.RecordBatch:
            kinds = list(seen[True] | seen[False])
            columns = [pa.array(kinds, pa.string())] + [pa.array([seen[k][c] for c in kinds], pa.int64()) for k in (True, False)]
            for c in seen.values():
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["kind", "inside", "outside"])

        for b in batches:
            for page in b.column(0):
                items = read_page(page.as_py())
                if any(i.marked and isinstance(i, Words) and i.count for i in items):
                    for i in items:
                        seen[i.marked][i.kind] += i.count if isinstance(i, Words) else 1
            if len(seen[True]) + len(seen[False]) > 16 * CONTEXTS:
                yield flush()
        yield flush()

    rows = pages.select(F.col(f"`{html_col}`").alias("html")).mapInArrow(count, "kind string, inside long, outside long")
    return rows.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).withColumn("n", F.col("inside") + F.col("outside")).where("n > 0")


class Weights(NamedTuple):
    """Thousandths by kind, and of words of an unknown kind outside and inside links."""

    known: dict[str, int]
    plain: int
    link: int

    def of(self, item: Tag | Words, page_marked: bool) -> int:
        if item.out:
            return 0
        if isinstance(item, Tag):
            return -TAG_IN_MARK if item.marked else self.known.get(item.kind, -MILDEST)
        w = self.known.get(item.kind, self.link if item.kind.endswith(" a") else self.plain)
        if page_marked:
            w = max(w, MARKED) if item.marked else min(w, -MARKED)
        return w * item.count


def log_odds(inside: int, outside: int) -> int:
    return max(-HIGHEST, min(HIGHEST, round(1000 * math.log((inside + 0.5) / (outside + 0.5)))))


def learn(pages: DataFrame, html_col: str = "html", contexts: int = CONTEXTS) -> Weights:
    """Weights from all pages that mark their main part."""
    rows = most_frequent(stored(context_counts(pages, html_col), "contexts"), contexts).collect()
    known, sums = {}, {True: [0, 0], False: [0, 0]}
    for r in rows:
        w = log_odds(r.inside, r.outside)
        if r.kind.startswith("<"):
            known[r.kind] = max(-COSTLIEST, min(w, -MILDEST))
        else:
            known[r.kind] = w
            for k, n in enumerate((r.inside, r.outside)):
                sums[r.kind.endswith(" a")][k] += n
    # with nothing to learn from, words outside links count for, words in links against
    plain, link = (log_odds(*sums[k]) if any(sums[k]) else d for k, d in ((False, 1000), (True, -1000)))
    return Weights(known, max(plain, MILDEST), link)


# --------------------------------------------------------------- extraction
def best_stretch(scores: list[int]) -> tuple[int, int]:
    """[start, end) with the highest sum: the first start, then the longest; (0, 0) if no sum is above 0."""
    best, found, total, start = 0, (0, 0), 0, 0
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0, i
        total += s
        if total > best or total == best > 0 and start == found[0]:
            best, found = total, (start, i + 1)
    return found


def main_text(page: str | None, weights: Weights) -> str:
    items = read_page(page)
    marked = any(i.marked and isinstance(i, Words) and i.count for i in items)
    start, end = best_stretch([weights.of(i, marked) for i in items])
    chosen = [i.block for i in items[start:end] if isinstance(i, Words) and i.count and not i.out]
    if not chosen:
        return ""
    blocks: dict[int, list[str]] = {}
    for i in items:
        if isinstance(i, Words) and not i.out and (i.marked or not marked) and chosen[0] <= i.block <= chosen[-1]:
            blocks.setdefault(i.block, []).append(i.text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, weights: Weights, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` plus ``text`` and ``n_chars`` (code points)."""

    def work(values: list[str | None]) -> list[pa.Array]:
        texts = [main_text(v, weights) for v in values]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return add_columns(pages, html_col, {"text": T.StringType(), "n_chars": T.LongType()}, lambda: work, keep)
