"""Main text of web pages (operator 4).

A page is cut into flat text blocks; a block is described by its number of
words and its link density, those of the blocks before and after it, and the
kind of element it stands in; a decision tree (Kohlschuetter et al. 2010)
tells article text from the rest.  The tree is grown on the labelled blocks
of ``html_labels.PAGES``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivernet.llm.common import ship

#: Elements whose content is never shown as text of the page.
HIDDEN = ("script", "style", "title", "noscript", "template", "iframe", "svg", "textarea", "select", "object", "math")
#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose kind is a feature of the blocks inside.
KINDS = {"article": "article", "main": "article", "nav": "menu", "menu": "menu", "footer": "foot", "header": "head",
         "aside": "side", "dialog": "side", "form": "form", "button": "form", "label": "form", "fieldset": "form"}
#: Words in class, id or role that tell what an element holds.
HINTS = {
    "notice": "ad ads advert advertisement adverts banner sponsor sponsored promo promotion cookie cookies consent "
              "notice popup modal newsletter subscribe alert gdpr overlay paywall",
    "comments": "comment comments reply replies respond disqus discussion reader",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toolbar",
    "side": "sidebar side related widget share social recommended trending popular teaser aside complementary",
    "foot": "footer foot copyright legal colophon contentinfo",
    "head": "header masthead topbar logo",
    "article": "article post entry content story main",
}
HINT_OF = {word: kind for kind, words in HINTS.items() for word in words.split()}
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading",
            "article", "menu", "foot", "head", "side", "form", "notice", "comments")
_KIND_AT = {k: i for i, k in enumerate(FEATURES)}

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?<=/)>"  # empty: hides nothing after it
    r"|<(?P<hidden>" + "|".join(HIDDEN) + r")\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</(?P=hidden)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/][^>]*>", re.I | re.S)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HINT_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    kinds: frozenset[str]


def _kinds(name: str, rest: str) -> frozenset[str]:
    found = {KINDS[name]} if name in KINDS else set()
    if rest and "=" in rest:
        for values in _NAMED.findall(rest):
            for word in _HINT_WORDS.findall("".join(values).lower()):
                if word in HINT_OF:
                    found.add(HINT_OF[word])
    return frozenset(found)


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in page order; blocks without a word are left out."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    pieces: list[str] = []
    linked: list[str] = []
    anchor, heading, at = 0, False, 0

    def close() -> None:
        nonlocal heading
        text = " ".join("".join(pieces).split())
        if text:
            kinds = frozenset().union(*(k for _, k in stack))
            out.append(Block(text, text.count(" ") + 1, len("".join(linked).split()), heading, kinds))
        pieces.clear()
        linked.clear()

    def text_piece(piece: str) -> None:
        if piece:
            piece = html.unescape(piece)
            pieces.append(piece)
            if anchor:
                linked.append(piece)

    for mark in _MARK.finditer(page):
        text_piece(page[at:mark.start()])
        at = mark.end()
        name = (mark["name"] or "").lower()
        if not name:
            continue
        if name == "a":
            linked.append(" ")
            anchor = max(0, anchor - 1) if mark["close"] else anchor + 1
        elif name == "br":
            pieces.append(" ")
            linked.append(" ")
        elif name in BLOCKS:
            close()
            anchor = 0
            if re.fullmatch("h[1-6]", name):
                heading = not mark["close"]
            elif mark["close"]:
                if any(n == name for n, _ in stack):
                    while stack.pop()[0] != name:
                        pass
            elif name not in ("p", "hr", "li", "dt", "dd", "option") and not mark["rest"].endswith("/"):
                stack.append((name, _kinds(name, mark["rest"])))
            if name in ("p", "li"):
                heading = False
    text_piece(page[at:])
    close()
    return out


def describe(found: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block of one page."""
    out = np.zeros((len(found), len(FEATURES)))
    for i, b in enumerate(found):
        out[i, 0], out[i, 1], out[i, 6] = min(b.words, 1000), min(1.0, b.linked / b.words), b.heading
        for kind in b.kinds:
            out[i, _KIND_AT[kind]] = 1
    out[1:, 2:4] = out[:-1, 0:2]
    out[:-1, 4:6] = out[1:, 0:2]
    return out


@dataclass
class Node:
    main: bool
    feature: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10) -> Node:
    """A CART tree by Gini impurity; of equal cuts the first feature's lowest."""
    node = Node(main=bool(2 * y.sum() >= len(y)))
    best = 0.0
    if depth and 0 < y.sum() < len(y):
        whole = 2 * y.mean() * (1 - y.mean()) * len(y)
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            for cut_at in (values[:-1] + values[1:]) / 2:
                low = x[:, j] <= cut_at
                a, b = y[low], y[~low]
                gain = whole - sum(2 * s.mean() * (1 - s.mean()) * len(s) for s in (a, b))
                if gain > best + 1e-9:
                    best, node.feature, node.limit = gain, j, float(cut_at)
    if node.feature >= 0:
        low = x[:, node.feature] <= node.limit
        node.low, node.high = grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)
    return node


def decide(node: Node, x: np.ndarray) -> np.ndarray:
    if node.low is None or node.high is None:
        return np.full(len(x), node.main)
    low = x[:, node.feature] <= node.limit
    out = np.empty(len(x), dtype=bool)
    out[low], out[~low] = decide(node.low, x[low]), decide(node.high, x[~low])
    return out


@lru_cache(maxsize=1)
def tree() -> Node:
    """Grown on the labelled pages: a block is main if it stands in the page's list."""
    from rivernet.llm.html_labels import PAGES

    x, y = [], []
    for page, main in PAGES:
        found = blocks(page)
        x.append(describe(found))
        y += [b.text in main for b in found]
    return grow(np.concatenate(x), np.array(y, dtype=float))


def main_text(page: str) -> str:
    found = blocks(page)
    if not found:
        return ""
    keep = decide(tree(), describe(found))
    return " ".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    A null or empty page, and a page without article text, has an empty text
    and 0 characters.  Character references are decoded, white space inside a
    block is one blank, blocks are joined by one blank.  Repeated rows give
    one row each; other columns are not read.  No shuffle.
    """
    ship(pages.sparkSession)
    source = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"),
                          F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(got, pa.string()),
                 pa.array(map(len, got), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    return source.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
