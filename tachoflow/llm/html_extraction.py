"""Main text of web pages by a tree-structured graphical model.

A page is a tree of blocks and text runs, each with a hidden label: content or not.
Potentials between parent and child and the features of a node given its label are counted
by Spark over the labelled pages; messages passed up and down the tree (sum-product) then
give the probability that a node is content, exactly. Runs of PROBABLE at least are the text.

Labelled pages are those that mark their main text themselves (an ``article`` or ``main``
element): what lies inside it is content. All of them are counted; the tables have a few
dozen rows. What is never content (menus, footers, hidden blocks) is known by its element, is
counted as not content and stands outside the tree when a page is read. So are forms and blocks
whose class has a word for adverts, notices and the like, but only where they hold less than
half of the text around them: a body that is one form, or "content no-sidebar", is left to the
model. The counts of Laplace's kind in PRIOR keep every potential
away from 0, so that pages without such marks are judged by length, links and sentence ends.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.dom import Node, read

PROBABLE = 0.5
NEVER = frozenset("nav footer aside form button menu dialog fieldset head".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = frozenset("p pre blockquote li dd dt td th figcaption".split())
#: Words in class, id or role of blocks that are never content.
BAD_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pager pagination footer masthead topbar toolbar sidebar side aside widget widgets"
    " related recommended recommendations more trending popular ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " comment comments commentlist respond replies reply disqus discussion share sharing social cookie cookies consent gdpr notice notices alert warning"
    " newsletter subscribe subscription signup login register popup modal overlay search form contentinfo complementary hidden skip tags tagcloud".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_NAMED = re.compile(r"\b(?:class|id|role|style|hidden|aria-hidden)\b", re.IGNORECASE)

#: Shares of not content and content by length, links and sentence end of a text run.
_LENGTH = ((0.3, 0.15), (0.35, 0.2), (0.2, 0.25), (0.15, 0.4))
_LINKS = ((0.4, 0.8), (0.1, 0.15), (0.5, 0.05))
_SENTENCE = ((0.6, 0.35), (0.4, 0.65))
#: Counts that stand for what is known before any page: feature value -> (not content, content).
PRIOR = {
    "run": tuple(tuple(100 * a[k] * b[k] * c[k] for k in (0, 1)) for a in _LENGTH for b in _LINKS for c in _SENTENCE),
    "element": ((50, 50), (30, 60), (1, 30), (5, 20)),
    "edge": ((90, 10), (10, 90)),
}
#: No edge is so certain that the features below it could not speak against it.
LEAST_EDGE = 0.002
#: An element by which a page marks its main text is taken at its word.
MARKED = -500.0


def never(tag: str, attributes: str, in_main: bool = False, minor: bool = True) -> bool:
    """Whether an element is known not to be content, with all in it; ``minor``: it holds less than half of the text around it."""
    if tag in NEVER or (tag == "header" and not in_main):
        return minor or tag != "form"
    if tag in MAIN or tag in ("html", "body", "#root") or not _NAMED.search(attributes):
        return False
    node = Node(tag, attributes)
    if node.attribute("hidden") is not None or node.attribute("aria-hidden") == "true" or _HIDDEN.search(node.attribute("style") or ""):
        return True
    if not minor:
        return False
    if (node.attribute("role") or "").lower() in BAD_ROLES:
        return True
    names = f"{node.attribute('class') or ''} {node.attribute('id') or ''}"
    return any(w.lower() in BAD_WORDS for w in _WORD.findall(names))


def text_sizes(root: Node) -> dict[int, int]:
    """Characters of text in every element, by identity."""
    order = [root]
    for node in order:
        order += node.children
    sizes = {id(node): len(node.text) for node in order}
    for node in reversed(order[1:]):
        sizes[id(node.parent)] += sizes[id(node)]
    return sizes


def left_out(child: Node, inside: bool, around: int, sizes: dict[int, int]) -> bool:
    """Whether a child stands outside the tree; around: characters of the main element it lies in, or of the page."""
    return child.tag is not None and never(child.tag, child.attributes, inside, 2 * sizes[id(child)] < around)


def features(node: Node) -> list[tuple[str, int]]:
    if node.tag is None:
        length = (len(node.text) > 25) + (len(node.text) > 80) + (len(node.text) > 200)
        links = (node.linked > 0.1) + (node.linked > 0.5)
        sentence = node.text.rstrip("\"')»” ")[-1:] in tuple(".!?…。")
        return [("run", (length * len(_LINKS) + links) * len(_SENTENCE) + sentence)]
    # Plain containers say nothing by themselves.
    kind = 1 if node.tag in TEXTUAL else 2 if node.tag in MAIN else 3 if node.tag in HEADINGS else 0
    return [("element", kind)] if kind else []


def page_tree(html: str) -> Node:
    return read(html, lambda tag, attributes: bool(attributes) and never(tag, attributes))


def count_page(root: Node, counts: Counter) -> None:
    """Add the feature and edge counts of a labelled page; a page without marks adds nothing."""
    seen: list[tuple[str, int, int]] = []
    marked = False
    sizes = text_sizes(root)
    # (node, inside main, known not to be content, characters around)
    stack = [(root, False, False, sizes[id(root)])]
    while stack:
        node, inside, out, around = stack.pop()
        label = int(inside and not out)
        seen += [(name, value, label) for name, value in features(node)]
        for child in node.children:
            child_in = inside or child.tag in MAIN
            child_out = out or left_out(child, inside, around, sizes)
            marked |= child.tag in MAIN
            seen.append(("edge", label, int(child_in and not child_out)))
            stack.append((child, child_in, child_out, sizes[id(child)] if child.tag in MAIN else around))
    if marked:
        counts.update(seen)


class Model:
    """Log potentials from counts {(feature, value, label): n}; of an edge the value is the parent's label."""

    def __init__(self, counts: dict[tuple[str, int, int], int]) -> None:
        self.given: dict[str, list[tuple[float, float]]] = {}
        for name, prior in PRIOR.items():
            table = [[p[k] + counts.get((name, v, k), 0) for k in (0, 1)] for v, p in enumerate(prior)]
            if name == "edge":
                rows = []
                for a, b in table:
                    p = min(max(b / (a + b), LEAST_EDGE), 1 - LEAST_EDGE)
                    rows.append((math.log(1 - p), math.log(p)))
                self.given[name] = rows
            else:
                total = [sum(r[k] for r in table) for k in (0, 1)]
                self.given[name] = [(math.log(r[0] / total[0]), math.log(r[1] / total[1])) for r in table]

    def own(self, node: Node) -> tuple[float, float]:
        a, b = (MARKED, 0.0) if node.tag in MAIN else (0.0, 0.0)
        for name, value in features(node):
            x, y = self.given[name][value]
            a, b = a + x, b + y
        return a, b

    def content(self, root: Node) -> list[str]:
        """Text runs in page order whose content marginal is PROBABLE or more."""
        order: list[tuple[Node, int]] = []
        sizes = text_sizes(root)
        stack = [(root, -1, False, sizes[id(root)])]
        while stack:
            node, parent, inside, around = stack.pop()
            place = len(order)
            order.append((node, parent))
            if node.tag in MAIN:
                inside, around = True, sizes[id(node)]
            stack += [(c, place, inside, around) for c in reversed(node.children) if not left_out(c, inside, around, sizes)]
        (e00, e01), (e10, e11) = self.given["edge"]
        # Upward: what a node and all below it say, for either label of the node.
        up = [self.own(node) for node, _ in order]
        message = [(0.0, 0.0)] * len(order)
        for k in range(len(order) - 1, 0, -1):
            a, b = up[k]
            sent = (_add(a + e00, b + e01), _add(a + e10, b + e11))
            message[k] = sent
            parent = order[k][1]
            x, y = up[parent]
            up[parent] = (x + sent[0], y + sent[1])
        # Downward: what all the rest of the tree says. The root is not content.
        down = [(0.0, -50.0)] * len(order)
        out = []
        for k in range(1, len(order)):
            parent = order[k][1]
            x = down[parent][0] + up[parent][0] - message[k][0]
            y = down[parent][1] + up[parent][1] - message[k][1]
            top = max(x, y)
            down[k] = (_add(x - top + e00, y - top + e10), _add(x - top + e01, y - top + e11))
            node = order[k][0]
            if node.tag is None:
                odds = up[k][1] + down[k][1] - up[k][0] - down[k][0]
                if 1 / (1 + math.exp(-max(-40.0, min(40.0, odds)))) >= PROBABLE:
                    out.append(node.text)
        return out


def _add(a: float, b: float) -> float:
    top = a if a > b else b
    return top + math.log1p(math.exp(-abs(a - b)))


def fit(pages: DataFrame) -> Model:
    """The model of all labelled pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for html in batch["html"]:
                count_page(page_tree(html.as_py() or ""), counts)
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), *(pa.array([k[j] for k in keys], pa.int64()) for j in (1, 2)), pa.array([counts[k] for k in keys], pa.int64())],
            ["name", "value", "label", "n"])

    # A row per feature value and label: a few dozen.
    rows = pages.select(F.col("html").cast("string").alias("html")).mapInArrow(run, "name string, value long, label long, n long").groupBy("name", "value", "label").agg(F.sum("n").alias("n")).collect()
    return Model({(r["name"], r["value"], r["label"]): r["n"] for r in rows})


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """The main text of every page.

    ``pages`` has page_id, url and html; other columns are ignored. Without a ``model`` it is
    fitted on these pages. Returns one row per row: page_id, url, text (blocks joined by an
    empty line, white space inside a block as one space, character references decoded) and
    n_chars.

    A null or empty page, or one without content, has an empty text. Broken pages are read as
    far as they go, very long ones whole. Repeated rows give repeated rows. No rows give no rows.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast((model or fit(pages)).given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model({})
        known.given = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = ["\n\n".join(known.content(page_tree(html.as_py() or ""))) for html in part["html"]]
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
