"""Main text of web pages by a tree-structured graphical model over the DOM.

Each node (block element or text block) is content or not. A node's own potential weighs its features,
a parent-child potential weighs each pair of states. Messages pass up and down the tree and give each
node's exact marginal; text blocks that are content more likely than not make the text. Weights are
trained by the likelihood of labelled pages.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailshape.llm.dom import Block, read

# Words in classes, ids and roles of furniture and of content.
FURNITURE = frozenset("""ad ads advert advertisement advertising alert banner bar breadcrumb breadcrumbs
byline comment comments consent contentinfo cookie cookies copyright dialog disclaimer discussion
feedback footer form gdpr header login masthead menu meta modal nav navbar navigation newsletter notice
pager pagination popup privacy promo promotion recommended related replies reply respond search share
sharing side sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar
topbar trending widget""".split())
CONTENT = frozenset("article articlebody body content entry main post story text".split())

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NAMED = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""",
                    re.IGNORECASE)
_HIDDEN = re.compile(r"""display\s*:\s*none|\bhidden\b|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_TAG_KINDS = {**dict.fromkeys("nav menu".split(), "menu"), **dict.fromkeys(["aside"], "aside"),
              **dict.fromkeys(["header"], "header"), **dict.fromkeys(["footer"], "footer"),
              **dict.fromkeys("form fieldset legend dialog".split(), "form"),
              **dict.fromkeys("article main".split(), "article"),
              **dict.fromkeys("h1 h2 h3 h4 h5 h6 hgroup".split(), "heading"),
              **dict.fromkeys("ul ol dl dir li dt dd".split(), "list"),
              **dict.fromkeys("table thead tbody tfoot tr td th".split(), "table"),
              **dict.fromkeys("p blockquote pre figcaption".split(), "prose")}

# Bounds of the training sample.
SAMPLE_PAGES = 60
SAMPLE_CHARS = 30_000
LABEL = "data-main"

_element_memo: dict[tuple[str, str], list[str]] = {}


def element_features(tag: str, attributes: str) -> list[str]:
    key = (tag, attributes)
    found = _element_memo.get(key)
    if found is None:
        found = ["element", "tag " + _TAG_KINDS.get(tag, "other")]
        if attributes:
            words = {w.lower() for _, value in _NAMED.findall(attributes)
                     for w in _WORDS.findall(value)}
            if words & FURNITURE:
                found.append("furniture")
            elif words & CONTENT:
                found.append("content")
            if _HIDDEN.search(attributes):
                found.append("hidden")
        if len(_element_memo) > 20_000:
            _element_memo.clear()
        if len(attributes) < 200:
            _element_memo[key] = found
    return found


def text_features(block: Block, parent_tag: str) -> list[str]:
    n = len(block.text)
    share = block.linked / n
    found = ["text", "in " + _TAG_KINDS.get(parent_tag, "other"),
             "size %d" % min(int(math.log2(n + 1)), 9),
             "links %d" % (0 if share < 0.05 else 1 if share < 0.4 else 2 if share < 0.9 else 3)]
    if block.text[-1] in ".!?:;\"”»…。！？":
        found.append("closed")
    if "©" in block.text[:200] or "all rights reserved" in block.text[:200].lower():
        found.append("rights")
    return found


class TreeModel:
    """Weights of features, and per child sort a 2 x 2 table of parent and child states."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.edges = {"text": np.zeros((2, 2)), "element": np.zeros((2, 2))}

    def _inputs(self, nodes: list[Block]):
        features = [text_features(b, nodes[b.parent].tag) if not b.tag
                    else element_features(b.tag, b.attributes) for b in nodes]
        weights = self.weights
        scores = [sum(weights.get(f, 0.0) for f in found) for found in features]
        return features, scores

    def marginals(self, nodes: list[Block], scores: list[float]):
        """P(content) per node, by one pass up and one down; also the messages, for pairs.

        Messages are log-odds-like pairs with the state 0 value taken off where possible, so long
        trees do not overflow. Nodes come after their parents, so no recursion is needed.
        """
        n = len(nodes)
        tables = {k: t.tolist() for k, t in self.edges.items()}
        # up[i]: (log) total below and at i for state 0 and 1, before the parent's edge.
        zero, one = [0.0] * n, list(scores)
        to_parent: list[tuple[float, float]] = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            (a, b), (c, d) = tables["element" if nodes[i].tag else "text"]
            z, o = zero[i], one[i]
            message = (_add(a + z, b + o), _add(c + z, d + o))
            to_parent[i] = message
            p = nodes[i].parent
            zero[p] += message[0]
            one[p] += message[1]
        # Totals with everything above: parent's belief without what this child sent.
        above: list[tuple[float, float]] = [(0.0, 0.0)] * n
        chance = [0.0] * n
        for i in range(n):
            if i:
                (a, b), (c, d) = tables["element" if nodes[i].tag else "text"]
                p = nodes[i].parent
                z = zero[p] + above[p][0] - to_parent[i][0]
                o = one[p] + above[p][1] - to_parent[i][1]
                top = max(z, o)
                above[i] = (_add(a + z - top, c + o - top), _add(b + z - top, d + o - top))
            gap = one[i] + above[i][1] - zero[i] - above[i][0]
            chance[i] = 1 / (1 + math.exp(-max(-500.0, min(500.0, gap))))
        return chance, (zero, one, to_parent, above)

    def pair(self, nodes: list[Block], i: int, messages) -> np.ndarray:
        """Joint marginal of node ``i``'s parent (rows) and node ``i`` (columns)."""
        zero, one, to_parent, above = messages
        p = nodes[i].parent
        parent = np.array([zero[p] + above[p][0] - to_parent[i][0],
                           one[p] + above[p][1] - to_parent[i][1]])
        joint = self.edges["element" if nodes[i].tag else "text"] + parent[:, None] + np.array(
            [zero[i], one[i]])[None, :]
        joint = np.exp(joint - joint.max())
        return joint / joint.sum()

    def gradient(self, nodes: list[Block], labels: list[int]):
        """``(feature gradient, edge gradient)`` of the labels' log-likelihood."""
        features, scores = self._inputs(nodes)
        chance, messages = self.marginals(nodes, scores)
        grad: dict[str, float] = {}
        for found, y, p in zip(features, labels, chance):
            for f in found:
                grad[f] = grad.get(f, 0.0) + y - p
        edges = {k: np.zeros((2, 2)) for k in self.edges}
        for i in range(1, len(nodes)):
            table = edges["element" if nodes[i].tag else "text"]
            table -= self.pair(nodes, i, messages)
            table[labels[nodes[i].parent], labels[i]] += 1
        return grad, edges

    def fit(self, pages: list[tuple[list[Block], list[int]]], epochs: int = 10, rate: float = 0.2,
            penalty: float = 1e-3) -> "TreeModel":
        seen: dict[str, float] = {}
        edge_seen = {k: np.full((2, 2), 1e-6) for k in self.edges}
        for _ in range(epochs):
            for nodes, labels in pages:
                grad, edges = self.gradient(nodes, labels)
                for f, g in grad.items():
                    g -= penalty * self.weights.get(f, 0.0)
                    seen[f] = seen.get(f, 1e-6) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + rate * g / math.sqrt(seen[f])
                for k, g in edges.items():
                    g = g - penalty * self.edges[k]
                    edge_seen[k] += g * g
                    self.edges[k] += rate * g / np.sqrt(edge_seen[k])
        return self

    def main_text(self, source: str | None) -> str:
        """Content blocks in page order, joined by an empty line; empty for null or empty pages."""
        nodes = read(source or "")
        _, scores = self._inputs(nodes)
        chance, _ = self.marginals(nodes, scores)
        return "\n\n".join(b.text for b, p in zip(nodes, chance) if not b.tag and p >= 0.5)


def _add(a: float, b: float) -> float:
    """Logarithm of a sum of exponentials."""
    if a < b:
        a, b = b, a
    gap = b - a
    return a if gap < -40 else a + math.log1p(math.exp(gap))


def labelled(source: str) -> tuple[list[Block], list[int]]:
    """Nodes and labels of a training page: a text block is content inside a marked element (or an
    article, where the page marks none) unless an aside, nav, form or footer lies between; an element
    is content if most of its text is."""
    nodes = read(source)
    marked = any(LABEL in b.attributes for b in nodes)
    inside, kept, total = [0] * len(nodes), [0] * len(nodes), [0] * len(nodes)
    for i, b in enumerate(nodes):
        state = inside[b.parent] if i else 0
        if b.tag and (LABEL in b.attributes if marked else b.tag == "article"):
            state = 1
        elif b.tag in ("aside", "nav", "form", "footer", "header") or LABEL[:5] + "off" in b.attributes:
            state = 0
        inside[i] = state
    for i in range(len(nodes) - 1, -1, -1):
        b = nodes[i]
        if not b.tag:
            kept[i], total[i] = len(b.text) * inside[i], len(b.text)
        if i:
            kept[b.parent] += kept[i]
            total[b.parent] += total[i]
    return nodes, [int(2 * k > t) for k, t in zip(kept, total)]


# Furniture around and within the content of rewritten training pages: opening tag and its use.
_CHROME = [("<nav>", "links"), ('<div class="menu">', "links"), ('<ul id="navbar">', "links"),
           ("<header>", "short"), ('<div class="site-header">', "short"), ("<aside>", "prose"),
           ('<div id="sidebar">', "prose"), ('<div class="ad">', "prose"),
           ('<div class="advert">', "short"), ('<div class="cookie-notice">', "prose"),
           ('<div role="alert" class="notice">', "short"), ('<form action="/s">', "short"),
           ('<section class="related">', "links"), ('<div class="share">', "links"),
           ("<footer>", "short"), ('<div class="footer">', "short"),
           ('<section id="comments">', "prose"), ('<div class="comment-list">', "prose"),
           ('<div class="newsletter">', "short")]
_BODIES = ["<article {}>", "<main {}>", '<div class="content" {}>', '<div id="main" {}>', "<div {}>",
           '<section class="post-body" {}>', '<div class="wrap"><div class="entry" {}>']


def rewritten(source: str, others: list[str], seed: int) -> str:
    """The labelled page's content in other markup, amid furniture filled with other pages' words."""
    rng = random.Random(seed)
    nodes, labels = labelled(source)
    blocks = [(nodes[b.parent].tag, b.text) for b, y in zip(nodes, labels) if y and not b.tag]

    def furniture(opening: str, use: str) -> str:
        tag = opening[1:].split()[0].rstrip(">")
        words = rng.choice(others).split() if others else ["x"]
        opening = opening[:-1] + f" {LABEL[:5]}off>"
        if use == "links":
            body = "<ul>" + "".join(f'<li><a href="/{i}">{rng.choice(words)}</a></li>'
                                    for i in range(rng.randrange(2, 7))) + "</ul>"
        elif use == "short":
            body = rng.choice(["{}", "<p>{}</p>", "<h1>{}</h1>", "<h3>{}</h3>"]).format(" ".join(words[:rng.randrange(1, 12)]))
        else:
            size = rng.choice([2, 4, 8, 20, 60])
            body = "".join(f"<p>{' '.join(words[i * size:(i + 1) * size])}</p>"
                           for i in range(rng.randrange(1, 4)))
        return f"{opening}{body}</{tag}>"

    before, within, after = ([furniture(*rng.choice(_CHROME)) for _ in range(rng.randrange(k))]
                             for k in (4, 2, 4))
    body = []
    for tag, text in blocks:
        tag = tag if tag in ("h1", "h2", "h3", "li", "blockquote") else "p"
        text = text.replace("&", "&amp;").replace("<", "&lt;")
        if rng.random() < 0.2:
            first, _, rest = text.partition(" ")
            text = f'<a href="/x">{first}</a> {rest}'
        body.append(f"<{tag}>{text}</{tag}>")
    for piece in within:
        body.insert(rng.randrange(len(body) + 1), piece)
    opening = rng.choice(_BODIES)
    tags = re.findall(r"<(\w+)", opening)
    return ("<html><body>" + "".join(before) + opening.format(f'{LABEL}="1"') + "".join(body)
            + "".join(f"</{t}>" for t in reversed(tags)) + "".join(after) + "</body></html>")


def fit(pages: DataFrame, html_col: str = "html", most: int = SAMPLE_PAGES,
        chars: int = SAMPLE_CHARS) -> TreeModel:
    """Train on ``most`` pages of up to ``chars`` that have an article, by a hash, as they are and
    twice rewritten. Without such pages the model is untrained and takes no text."""
    # Tasks keep their smallest hashes only, so no more than `most` pages a task meet.
    sample = [r[0] for r in pages.select(html_col).filter(
        F.col(html_col).contains("<article") & (F.length(html_col) <= chars)).orderBy(
            F.xxhash64(html_col), html_col).limit(most).collect()]
    texts = ["\n".join(b.text for b in read(s) if not b.tag) for s in sample]
    sources = []
    for i, source in enumerate(sample):
        others = [t for j, t in enumerate(texts) if j != i]
        sources += [source] + [rewritten(source, others, 2 * i + k) for k in range(2)]
    random.Random(0).shuffle(sources)
    model = TreeModel()
    if not sources:
        model.weights["text"] = -1.0
        return model
    return model.fit([labelled(s) for s in sources])


def extract(pages: DataFrame, model: TreeModel, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` per row of ``pages``; other columns are not read, repeated rows
    stay. A page of any length is read whole, by one task."""
    types = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.main_text(s.as_py()) for s in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], [id_col, url_col, "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, f"`{id_col}` {types[id_col]}, `{url_col}` {types[url_col]}, text string, n_chars bigint")
