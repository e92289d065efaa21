"""Main text of web pages: page structure first, then a host suffix array.

Each page is cut into blocks.  Blocks inside <article> or <main> are its text; blocks
inside menus, headers, footers, sidebars, notices, adverts, forms and comments are not.
Blocks that the markup does not place are decided by the host's suffix array: the token
streams of the host's pages are concatenated, every suffix is ranked by its first
MIN_TOKENS tokens, and suffixes of distinct pages that share them are repeated
boilerplate.  Tokens that such a repeat covers are removed; the unique runs stay.
A page of which the markup shows the article keeps that article whole, so that equal
articles on one host are not lost.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.arrow import slices_of
from factloom.llm.url_filter import host_of
from factloom.session import written

#: Tokens of the shortest repeat that counts; shorter blocks count whole.
MIN_TOKENS = 8

_TAG = re.compile(r"<(?:!--(?:.*?-->|.*\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)", re.DOTALL)
_MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "select", "option", "canvas", "audio", "video"}
_NOISE = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head", "fieldset"}
_BLOCK = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"} | _NOISE
_CELL = {"br", "td", "th"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Whole names of class, id and role that mark what is not the article.
_NOISE_MARKS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "contentinfo", "cookie", "cookies", "disclaimer", "footer", "gdpr", "masthead", "menu", "menu-item", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promoted", "related", "reply", "replies", "respond", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
#: Pairs that sites use for the same.
_NOISE_MARKS |= {f"{a}-{b}" for a in ("ad", "ads", "advert", "banner", "comment", "comments", "cookie", "footer", "menu", "nav", "newsletter", "notice", "promo", "related", "search", "share", "sidebar", "social", "sponsor", "subscribe", "widget") for b in ("area", "bar", "block", "box", "buttons", "container", "content", "form", "links", "list", "section", "slot", "unit", "wrapper")} | {f"{a}-{b}" for a in ("cookie", "site", "page", "main", "top", "left", "right", "share", "social", "nav", "author") for b in ("banner", "footer", "menu", "nav", "navigation", "sidebar", "bar", "notice", "consent")} | {"related-posts", "related-articles", "back-to-top", "skip-link", "site-header", "page-header", "top-header"}
_PLACED = re.compile(r"<(?:article|main)(?=[\s/>])|\brole\s*=\s*[\"']?main\b|\barticlebody\b", re.IGNORECASE)


def _marks(attributes: str) -> set[str]:
    if "=" not in attributes:
        return set()
    return {part.replace("_", "-") for m in _MARK.finditer(attributes) for part in (m[1] or m[2] or m[3] or "").lower().split()}


#: What opening an element closes, if its end tag was left out: elements, and where the search for them stops.
_CELLS = ({"td", "th", "caption"}, {"table", "tr"})
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": _CELLS, "th": _CELLS, "tr": ({"tr"}, {"table"}), **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot"}, {"table"}))}
_P = ({"p"}, {"button", "td", "th", "table", "caption", "object"})
_OPTIONAL = ("p", "li", "dt", "dd", "td", "th", "tr", "caption", "thead", "tbody", "tfoot")


def _closed_by(name: str, stack: list[tuple[str, int]]) -> int:
    """How many open elements stay when one of this name opens."""
    depth = len(stack)
    for wanted, stop in ((_P,) if name in _BLOCK else ()) + ((_IMPLIED[name],) if name in _IMPLIED else ()):
        for k in range(depth - 1, -1, -1):
            if stack[k][0] in wanted:
                depth = k
                break
            if stack[k][0] in stop:
                break
    return depth


def _holders(page: str) -> set[int]:
    """Where the tags end that are noise by name of class, id or role only and still hold an article or main element."""
    out: set[int] = set()
    if not _PLACED.search(page):
        return out
    stack: list[tuple[str, int]] = []
    lower = page.lower() if len(page.lower()) == len(page) else page
    at, raw_end = 0, {}
    while m := _TAG.search(page, at):
        at = m.end()
        name, attributes = (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        if not name:
            continue
        if m[1] or m[4]:
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
            continue
        if name in _RAW:
            if name not in raw_end or 0 <= raw_end[name] < at:
                raw_end[name] = lower.find(f"</{name}", at)
            at = raw_end[name] if raw_end[name] >= 0 else (len(page) if name in {"script", "style"} else at)
            continue
        del stack[_closed_by(name, stack) :]
        if name in _VOID or attributes.endswith("/"):
            continue
        if _article(name, _marks(attributes)):
            out.update(x for _, x in stack)
        stack.append((name, at))
    return out


def _article(name: str, marks: set[str]) -> bool:
    return name in {"article", "main"} or "main" in marks or "articlebody" in marks


def blocks_of(page: str) -> tuple[list[str], list[str]]:
    """The blocks of the page's article, and the blocks that the markup does not place.

    End tags that HTML allows to leave out are implied, so noise ends with its element.
    """
    article: list[str] = []
    loose: list[str] = []
    text: list[str] = []
    holders = _holders(page)
    #: open elements: name, +1 for an article, -1 for noise, 0 else
    stack: list[tuple[str, int]] = []
    open_names: dict[str, int] = {}
    inside = noise = 0
    raw_end: dict[str, int] = {}
    lower = page.lower()
    if len(lower) != len(page):  # a character whose lower case is longer
        lower = page

    def close() -> None:
        if text:
            if not noise:
                block = " ".join(entities.unescape("".join(text)).split())
                if block:
                    (article if inside else loose).append(block)
            text.clear()

    def pop_to(depth: int) -> None:
        nonlocal inside, noise
        while len(stack) > depth:
            n, kind = stack.pop()
            open_names[n] -= 1
            if kind:
                close()
                inside -= kind > 0
                noise -= kind < 0

    at = 0
    while True:
        m = _TAG.search(page, at)
        end = m.start() if m else len(page)
        if end > at and not noise:
            text.append(page[at:end])
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name in _BLOCK:
                close()
            if open_names.get(name):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        pop_to(k)
                        break
            continue
        if name in _RAW:
            if name not in raw_end or raw_end[name] < at and raw_end[name] >= 0:
                raw_end[name] = lower.find(f"</{name}", at)
            at = raw_end[name] if raw_end[name] >= 0 else (len(page) if name in {"script", "style"} else at)
            continue
        if name in _BLOCK:
            close()
        elif name in _CELL and not noise:
            text.append(" ")
        if (name in _BLOCK or name in _IMPLIED) and any(map(open_names.get, _OPTIONAL)):
            pop_to(_closed_by(name, stack))
        if name in _VOID or (m[3] or m[6] or "").endswith("/"):
            continue
        kind = 0
        attributes = m[3] or m[6] or ""
        marks = _marks(attributes)
        if name in _NOISE or name == "header" and not inside:  # an article's own header holds its title
            kind = -1
        elif _article(name, marks):
            kind = 1
        elif marks & _NOISE_MARKS and name not in {"html", "body"} and at not in holders:
            kind = -1
        stack.append((name, kind))
        open_names[name] = open_names.get(name, 0) + 1
        inside += kind > 0
        noise += kind < 0
    close()
    return article, loose


def _tokens(block: str) -> list[str]:
    return block.split(" ")


def prefixes(block: str) -> list[int]:
    """The name of every suffix's first MIN_TOKENS tokens; a shorter block has one name for the whole."""
    from xxhash import xxh3_64_intdigest

    words = _tokens(block)
    return [xxh3_64_intdigest(" ".join(words[i : i + MIN_TOKENS])) - (1 << 63) for i in range(max(1, len(words) - MIN_TOKENS + 1))]


def unique_runs(block: str, repeated: set[int]) -> list[str]:
    """The runs of the block's tokens that no repeated prefix covers."""
    words = _tokens(block)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for i, name in enumerate(prefixes(block)):
        if name in repeated:
            covered[i] += 1
            covered[min(len(words), i + MIN_TOKENS)] -= 1
    keep = np.cumsum(covered)[:-1] == 0
    runs: list[str] = []
    for i, w in enumerate(words):
        if keep[i]:
            if i and keep[i - 1]:
                runs[-1] += " " + w
            else:
                runs.append(w)
    return runs


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    A null html counts as empty; a page without text gets an empty one; a null or odd
    url has the empty host; rows of one page_id count as one page when repeats are
    sought, and so do pages of equal text; repeated rows stay; other columns are ignored; an empty table stays empty.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 128):
            found = [blocks_of(x or "") for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(["\n".join(a) for a, _ in found], pa.string()), pa.array([None if a else x for a, x in found], pa.list_(pa.string()))],
                names=["page_id", "url", "host", "text", "loose"],
            )

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")
    made = written(slim.mapInArrow(parsed, "page_id long, url string, host string, text string, loose array<string>").withColumn("row", F.monotonically_increasing_id()), "blocks")
    placed = made.where("loose IS NULL OR size(loose) = 0").select("page_id", "url", F.coalesce("text", F.lit("")).alias("text"))
    unplaced = made.where("size(loose) > 0").select("row", "page_id", "url", "host", "loose", F.xxhash64("loose").alias("whole"))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 128):
            out = [(row, page, host, whole, name) for row, page, host, loose, whole in zip(*(c.to_pylist() for c in b.columns), strict=True) for name in {n for block in loose for n in prefixes(block)}]
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["row", "page_id", "host", "whole", "name"])

    suffixes = unplaced.select("row", "page_id", "host", "loose", "whole").mapInArrow(named, "row long, page_id long, host string, whole long, name long")
    # Suffixes of one host with one name are neighbours in its suffix array; a partial minimum and maximum tell whether they are of distinct pages; pages whose whole text is equal are one.
    page = F.coalesce(F.col("page_id"), F.lit(-1))
    repeats = suffixes.groupBy("host", "name").agg(F.min(page).alias("a"), F.max(page).alias("b"), F.min("whole").alias("c"), F.max("whole").alias("d")).where("a < b AND c < d").select("host", "name")
    covered = suffixes.select("row", "host", "name").join(repeats, ["host", "name"]).groupBy("row").agg(F.collect_list("name").alias("names"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 128):
            texts = ["\n".join(run for block in loose for run in unique_runs(block, set(names or ()))) for loose, names in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    decided = unplaced.join(covered, "row", "left").select("page_id", "url", "loose", "names").mapInArrow(kept, "page_id long, url string, text string")
    return placed.unionByName(decided).withColumn("n_chars", F.length("text").cast("long"))
