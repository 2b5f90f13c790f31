"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements, with its runs of text as leaves. Each node is content or
not. Node potentials are log-linear in features of the node (kind of element, names in class and
id, length, share of linked text, punctuation); a parent-child table says how far neighbours agree.
Sum-product messages up and then down the tree give each node's marginal, and the runs that are
content more likely than not make up the text, in page order, one line each.

Training pages are labelled by their own markup: in a sample of at most PAGES pages that have an
<article> or <main>, what is inside, and in nothing that is named or meant as something else, is
content. Each is learned from twice, as it is and with that markup masked, so that pages without
any are decided by their text and links. Weights are drawn towards a fixed start, which holds where
the sample shows no example.

Within a run, character references are decoded and white space becomes single spaces. Scripts,
styles, comments, titles and form controls hold no text; unclosed or crossed tags are closed as
browsers close them, where the next block begins. A null or empty page has the text ''. Rows
without page_id, repeated rows and extra columns are handled like any others; a row gives a row.
"""

import html
import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that the model is fitted to, at most, chosen by a hash of page_id.
PAGES = 400

#: Elements by their part in a page.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
WITHOUT_TEXT = {"script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "audio", "video", "select", "textarea", "button", "title"}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section",
    "summary", "table", "ul",
}
BLOCKS = CLOSES_P | {"html", "body", "head", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "legend", "label", "option"}
#: An element that begins ends open ones of these kinds, but not beyond those.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, {"html"}),
}
ASIDE_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "search", "fieldset"}
ARTICLE_TAGS = {"article", "main"}
#: Words in class and id that name something other than the article, or the article.
ASIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "copyright", "disqus", "footer", "form", "gdpr", "header", "legal", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "pagination", "popup", "promo", "promoted", "recommended", "related", "replies", "reply", "search", "share", "sharing",
    "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
ARTICLE_NAMES = {"article", "body", "content", "entry", "main", "post", "story", "text"}

FEATURES = ("bias", "article_tag", "aside_tag", "aside_name", "article_name", "paragraph", "heading", "list", "table", "container", "run", "log_length", "link_share", "marks", "short")
#: How likely a node is content below a parent that isn't, and below one that is, by kind of node,
#: to start with; and how many nodes that start, and all that is counted, weigh.
KINDS = ("aside", "article", "other")
EDGES = np.array([[0.001, 0.02], [0.5, 0.99], [0.02, 0.98]])
START_NODES, COUNTED_NODES = 50, 200
#: Where the weights start.
START = np.array([0.0, 3.0, -6.0, -6.0, 1.5, 1.0, 0.7, 0.2, 0.2, 0.0, 0.2, 0.15, -2.5, 0.5, -0.2])

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""",
    re.S,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_ENDS_RAW = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in WITHOUT_TEXT}


class Page(NamedTuple):
    """Nodes in page order, parents first. text is None for elements."""

    parent: list[int]
    tag: list[str]
    names: list[frozenset]
    text: list[str | None]
    linked: list[int]  # characters of a run that stand in links


def parse(source: str) -> Page:
    """The tree of block elements and runs of text."""
    page = Page([-1], ["#root"], [frozenset()], [None], [0])
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements, and the block node they are in
    run: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            page.parent.append(stack[-1][1])
            page.tag.append("#run")
            page.names.append(frozenset())
            page.text.append(text)
            page.linked.append(min(linked, len(text)))
        run.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal links
        if any(tag in BLOCKS for tag, _ in stack[to:]):
            flush()
        links -= sum(tag == "a" for tag, _ in stack[to:])
        del stack[to:]

    def add(text: str) -> None:
        nonlocal linked
        if text:
            run.append(text)
            if links:
                linked += len(text)

    at = 0
    while found := _TAG.search(source, at):
        add(source[at : found.start()])
        at = found.end()
        end, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] in BLOCKS and tag not in BLOCKS:
                    break  # an inline element that a block has ended
            continue
        if tag in WITHOUT_TEXT:
            if not attributes.endswith("/"):
                closing = _ENDS_RAW[tag].search(source, at)
                at = closing.end() if closing else (len(source) if tag in ("script", "style") else at)
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        if tag in ENDS:
            ended, scope = ENDS[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in scope:
                    break
                if stack[i][0] in ended:
                    close(i)
                    if tag in ("li", "td", "th", "dd", "dt"):
                        break
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                run.append(" ")
            continue
        if tag not in BLOCKS:
            stack.append((tag, stack[-1][1]))
            links += tag == "a"
            continue
        flush()
        names = frozenset(w for value in _NAMED.findall(attributes) for w in re.split(r"[^a-z]+", value.lower()) if w) if attributes else frozenset()
        page.parent.append(stack[-1][1])
        page.tag.append(tag)
        page.names.append(names)
        page.text.append(None)
        page.linked.append(0)
        stack.append((tag, len(page.parent) - 1))
    add(source[at:])
    flush()
    return page


def node_features(page: Page) -> np.ndarray:
    """A row of FEATURES for each node; lengths and links of elements are those of what they hold."""
    n = len(page.parent)
    length = [len(t) if t else 0 for t in page.text]
    linked = list(page.linked)
    for i in range(n - 1, 0, -1):
        length[page.parent[i]] += length[i]
        linked[page.parent[i]] += linked[i]
    out = np.zeros((n, len(FEATURES)))
    for i, (tag, names, text) in enumerate(zip(page.tag, page.names, page.text, strict=True)):
        share = linked[i] / length[i] if length[i] else 0.0
        marks = text is not None and text[-1] in ".!?…”。"
        out[i] = (
            1, tag in ARTICLE_TAGS, tag in ASIDE_TAGS, not names.isdisjoint(ASIDE_NAMES), not names.isdisjoint(ARTICLE_NAMES),
            tag in ("p", "blockquote", "pre"), tag[0] == "h" and tag[1:].isdigit(), tag in ("li", "ul", "ol", "dl", "dd", "dt"),
            tag in ("table", "tr", "td", "th", "tbody"), tag in ("div", "section", "body", "html", "#root"), text is not None,
            math.log1p(length[i]) - 4 if text else 0, share, marks, text is not None and length[i] < 25,
        )
    return out


def node_kinds(page: Page) -> np.ndarray:
    """Each node's place in KINDS."""
    out = np.full(len(page.tag), 2)
    for i, (tag, names) in enumerate(zip(page.tag, page.names, strict=True)):
        if tag in ASIDE_TAGS or not names.isdisjoint(ASIDE_NAMES):
            out[i] = 0
        elif tag in ARTICLE_TAGS or not names.isdisjoint(ARTICLE_NAMES):
            out[i] = 1
    return out


def markup_labels(page: Page) -> np.ndarray | None:
    """1 for nodes of the article as the markup tells it, else 0; None if it doesn't tell."""
    if not any(tag in ARTICLE_TAGS for tag in page.tag):
        return None
    inside, aside = [False] * len(page.tag), [False] * len(page.tag)
    for i, tag in enumerate(page.tag):
        p = page.parent[i]
        inside[i] = tag in ARTICLE_TAGS or (p >= 0 and inside[p])
        aside[i] = tag in ASIDE_TAGS or not page.names[i].isdisjoint(ASIDE_NAMES) or (p >= 0 and aside[p])
    return np.array([a and not b for a, b in zip(inside, aside, strict=True)], float)


class TreeModel(NamedTuple):
    """Weights of the node features, the log-odds of content among nodes, and for each kind of node
    the chance that it is content below a parent that isn't, and below one that is."""

    weights: np.ndarray
    prior: float
    edges: np.ndarray

    def marginals(self, page: Page) -> list[float]:
        """How likely each node is content, given the whole tree; sums of products, up and down."""
        own = np.clip(node_features(page) @ self.weights - self.prior, -12, 12).tolist()
        pairs = self.edges[node_kinds(page)].tolist()
        n = len(own)
        below, message = own[:], [0.0] * n  # log-odds of a node from its subtree; what it tells its parent
        for i in range(n - 1, 0, -1):
            odds = math.exp(max(-40.0, min(40.0, below[i])))
            out, inside = pairs[i]
            message[i] = math.log((1 - inside + inside * odds) / (1 - out + out * odds))
            below[page.parent[i]] += message[i]
        total = below[:]
        for i in range(1, n):
            odds = math.exp(max(-40.0, min(40.0, total[page.parent[i]] - message[i])))
            out, inside = pairs[i]
            total[i] += math.log((out + inside * odds) / (1 - out + (1 - inside) * odds))
        return [1 / (1 + math.exp(max(-40.0, min(40.0, -t)))) for t in total]

    def text(self, source: str | None) -> str:
        page = parse(source or "")
        chances = self.marginals(page)
        return "\n".join(t for t, c in zip(page.text, chances, strict=True) if t is not None and c > 0.5)


def masked(page: Page) -> Page:
    """The page as if nothing in it told its part: plain containers, no names."""
    tags = ["div" if tag in ARTICLE_TAGS | ASIDE_TAGS else tag for tag in page.tag]
    return page._replace(tag=tags, names=[frozenset()] * len(tags))


def fit_tree_model(sources: list[str], steps: int = 300) -> TreeModel:
    """Node weights by penalised logistic regression, the chances on edges by counting.

    Every page counts twice, as it is and masked, so that lengths, links, punctuation and the kinds of
    blocks get weights by which pages without telling markup are decided.
    """
    rows, labels, counts = [], [], np.zeros((len(KINDS), 2, 2))
    for source in sources:
        page = parse(source)
        y = markup_labels(page)
        if y is None:
            continue
        for version in (page, masked(page)):
            rows.append(node_features(version))
            labels.append(y)
            np.add.at(counts, (node_kinds(version)[1:], y[page.parent[1:]].astype(int), y[1:].astype(int)), 1)
    weights, prior = START.copy(), 0.0
    if rows:
        x, y = np.concatenate(rows), np.concatenate(labels)
        prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            weights -= 0.5 * (x.T @ (p - y) / len(y) + 0.01 * (weights - START))
    seen = counts.sum(axis=2)
    counted = counts[:, :, 1] * np.minimum(1, COUNTED_NODES / np.maximum(seen, 1))
    edges = (counted + START_NODES * EDGES) / (np.minimum(seen, COUNTED_NODES) + START_NODES)
    return TreeModel(weights, prior, edges)


def train(pages: DataFrame) -> TreeModel:
    """Fits the model to a sample: the pages with the smallest hashes of id and address."""
    hashed = pages.select("html", F.xxhash64("page_id", "url").alias("h")).filter("html IS NOT NULL")
    smallest = [r.h for r in hashed.select("h").orderBy("h").limit(PAGES).collect()]
    if not smallest:
        return fit_tree_model([])
    # Only the sample's pages are sent, not those that each task would keep to sort.
    sample = hashed.filter(F.col("h") <= smallest[-1]).select("html").limit(PAGES)
    return fit_tree_model([r.html for r in sample.collect()])


def extract_text(pages: DataFrame, model: TreeModel) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches):
        for batch in batches:
            texts = [model.text(source) for source in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["page_id"].cast(pa.int64()), batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
