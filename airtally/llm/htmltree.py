"""Main text of web pages by a tree-structured graphical model over their blocks.

A page is parsed into the tree of its block elements; a leaf is a run of text
within one block, inline markup taken out. Every node has a label, main text or
not. What is seen of a node (tag, names, length, links, place) is its potential,
and the labels of parent and child have a potential together, so that what is
sure of a node reaches its neighbours. Sum-product messages upward and downward
give each node's marginal; leaves of one half and more are the main text.

The model is a conditional random field: its weights are those under which
labelled pages are likeliest, found by gradient ascent on exact marginals.
Trees of many pages are one forest, and a level of it one step on arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm.common import per_slice

# Groups of tags as the HTML standard has them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
IGNORED = {"html", "head", "body"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output picture "
    "q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var".split()
)
UNSEEN = set("audio button canvas datalist map math meter object option optgroup progress select svg template video".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: An end tag doesn't close what was opened before one of these; those of a table's own parts pass its cells.
BARRIERS = {"table", "td", "th", "caption", "template", "object"}
CELLS = {"td", "th", "caption"}
TABLE_PARTS = {"table", "thead", "tbody", "tfoot", "tr"}
#: A start tag closes an open element of its group, up to the tags that hold the group.
GROUPS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
PARAGRAPHS = HEADINGS | set("p li dt dd td th blockquote pre figcaption caption".split())

# A quoted value follows an equals sign; any other quote is a plain character.
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>|<[!?/][^>]*+>", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-label)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SECTIONS = set("article aside footer form header main nav section".split())
CONTAINER, PARAGRAPH, LEAF = 0, 1, 2


class Tree:
    """Nodes of one page in page order: parents, kinds, features seen at the start tag, and the leaves' texts."""

    def __init__(self, html: str):
        self.parent, self.kind, self.names, self.text, self.linked = [-1], [CONTAINER], [["tag=body"]], [None], [0]
        self.unseen, self.context = [False], [(["at=body"], [])]
        self._parse(html)

    def _add(self, parent: int, kind: int, names: list[str], text: str | None = None, linked: int = 0, unseen: bool = False) -> int:
        """A node below parent; what it stands in is its nearest sectioning tag and the nearest names given above it."""
        section, named = self.context[parent]
        self.parent.append(parent)
        self.kind.append(kind)
        self.names.append(names if kind == CONTAINER else [*names, *section, *named])
        if names[0][4:] in SECTIONS:
            section = ["at=" + names[0][4:]]
        self.context.append((section, ["under=" + name[5:] for name in names[1:] if name != "hidden"] or named))
        self.text.append(text)
        self.linked.append(linked)
        self.unseen.append(unseen or self.unseen[parent])
        return len(self.parent) - 1

    def _parse(self, html: str) -> None:
        stack, tags, open_ = [0], ["body"], {}
        run, linked, link = [], 0, 0

        def flush() -> None:
            nonlocal run, linked
            if run:
                text = " ".join("".join(run).split())
                if text:
                    self._add(stack[-1], LEAF, [f"in={tags[-1]}"], text, min(linked, len(text)))
                run, linked = [], 0

        def close(n: int) -> None:
            """Pop until n elements are open."""
            while len(stack) > n:
                stack.pop()
                open_[tags.pop()] -= 1

        at, end = 0, len(html)
        while at < end:
            match = TOKEN.search(html, at)
            chunk = html[at : match.start() if match else end]
            if chunk:
                chunk = unescape(chunk) if "&" in chunk else chunk
                run.append(chunk)
                if link:
                    linked += len(chunk)
            if not match:
                break
            at = match.end()
            closing, tag, attributes = match.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if tag in RAW and not closing:
                after = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = after.end() if after else end
            elif tag in INLINE:
                if tag == "a":
                    link = 0 if closing else 1
            elif tag == "br":
                run.append(" ")
            elif tag in IGNORED or (tag in VOID and tag != "hr"):
                continue
            elif closing:
                flush()
                link = 0
                if open_.get(tag):
                    n, barriers = len(tags) - 1, BARRIERS - CELLS if tag in TABLE_PARTS else BARRIERS
                    while tags[n] != tag and tags[n] not in barriers:
                        n -= 1
                    if tags[n] == tag:
                        close(n)
            else:
                flush()
                link = 0
                if tags[-1] == "p" or (tag in HEADINGS and tags[-1] in HEADINGS):
                    close(len(tags) - 1)
                group, holders = GROUPS.get(tag, ((), ()))
                if any(open_.get(t) for t in group):
                    n, found = len(tags) - 1, None
                    while n > 0 and tags[n] not in holders:
                        if tags[n] in group:
                            found = n
                        n -= 1
                    if found:
                        close(found)
                if tag == "hr":
                    continue
                node = self._add(stack[-1], PARAGRAPH if tag in PARAGRAPHS else CONTAINER, _names(tag, attributes), unseen=tag in UNSEEN)
                stack.append(node)
                tags.append(tag)
                open_[tag] = open_.get(tag, 0) + 1
        flush()


def _names(tag: str, attributes: str) -> list[str]:
    out = [f"tag={tag}"]
    if attributes and not attributes.isspace():
        for name, double, single, bare in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), double or single or bare
            if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value)):
                out.append("hidden")
            elif name != "style":
                out += {f"name={part.lower()}" for part in NAME_PART.findall(value)}
    return out


def _add_to_parents(values: np.ndarray, parent: np.ndarray, added: np.ndarray) -> None:
    """values[parent] += added in place, with repeated parents; parents of a level stand in order."""
    if len(parent):
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(parent)) + 1])
        values[parent[firsts]] += np.add.reduceat(added, firsts, axis=0)


class Forest:
    """The trees of many pages as arrays: features as (node, feature) pairs, nodes by depth."""

    def __init__(self, trees: list[Tree], features: dict[str, int], learn: bool = False):
        sizes = np.array([len(t.parent) for t in trees], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        n = int(self.first[-1])
        page = np.repeat(np.arange(len(trees)), sizes)
        own = np.array([p for t in trees for p in t.parent], dtype=np.int64)
        self.parent = np.where(own < 0, -1, own + self.first[page]) if n else own
        self.kind = np.array([k for t in trees for k in t.kind], dtype=np.int64)
        self.unseen = np.array([u for t in trees for u in t.unseen], dtype=bool)
        self.depth = np.zeros(n, dtype=np.int64)
        for t, first in zip(trees, self.first, strict=False):
            depth = [0] * len(t.parent)
            for i in range(1, len(depth)):
                depth[i] = depth[t.parent[i]] + 1
            self.depth[first : first + len(depth)] = depth
        order = np.argsort(self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[order])) + 1
        self.levels = np.split(order, cuts) if n else []
        length = np.array([len(x) if x else 0 for t in trees for x in t.text], dtype=np.float64)
        linked = np.array([x for t in trees for x in t.linked], dtype=np.float64)
        sign = np.array([bool(x) and "©" in x for t in trees for x in t.text], dtype=bool)
        upto = np.cumsum(length)
        total = np.zeros(len(trees))
        _add_to_parents(total, page, length)
        place = (upto - length - (np.cumsum(total) - total)[page]) / np.maximum(total[page], 1)
        for level in reversed(self.levels[1:]):
            for values in (length, linked):
                _add_to_parents(values, self.parent[level], values[level])
        some = np.maximum(length, 1)
        # Short or long, a single paragraph is main text by where it stands: its length does not count.
        columns = [
            ("length", np.searchsorted([1, 12, 40, 120, 400, 1500], length, "right")),
            ("links", np.where(length > 0, np.searchsorted([0.01, 0.3, 0.7], linked / some, "right"), 9)),
            ("share", np.searchsorted([0.02, 0.1, 0.3, 0.6, 0.9], length / np.maximum(total[page], 1), "right")),
            ("place", np.searchsorted([0.03, 0.15, 0.6, 0.9], place, "right")),
            ("sign", sign.astype(np.int64)),
        ]
        nodes, ids = [], []

        def number(name: str) -> int:
            if learn:
                return features.setdefault(name, len(features))
            return features.get(name, -1)

        at = 0
        for t in trees:
            for names in t.names:
                for name in names:
                    nodes.append(at)
                    ids.append(number(name))
                at += 1
        nodes, ids = [np.array(nodes, dtype=np.int64)], [np.array(ids, dtype=np.int64)]
        for label, values in columns:
            code = np.where((self.kind == CONTAINER) | (label in ("links", "sign")), self.kind * 16 + values, -1)
            seen, back = np.unique(code, return_inverse=True)
            known = np.array([-1 if c < 0 else number(f"{label}/{c // 16}/{c % 16}") for c in seen.tolist()], dtype=np.int64)
            nodes.append(np.arange(n))
            ids.append(known[back] if n else known)
        node, feature = np.concatenate(nodes), np.concatenate(ids)
        self.node, self.feature = node[feature >= 0], feature[feature >= 0]
        self.leaves = [[first + i for i, x in enumerate(t.text) if x] for t, first in zip(trees, self.first.tolist(), strict=False)]


def beliefs(parent: np.ndarray, levels: list[np.ndarray], own: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of each node's label, and of (parent's, own) label, by messages up and down the trees.

    own holds a log potential for each label of a node; edge, for each node below
    another, one for the parent's label and its own.
    """
    below = own.copy()  # own potential and the messages of all children
    up = np.zeros_like(own)
    for level in reversed(levels[1:]):
        toward = edge[level] + below[level][:, None, :]
        up[level] = np.logaddexp(toward[:, :, 0], toward[:, :, 1])
        _add_to_parents(below, parent[level], up[level])
    whole = below.copy()
    pair = np.zeros_like(edge)
    for level in levels[1:]:
        rest = whole[parent[level]] - up[level]  # what the parent knows without this child
        joint = rest[:, :, None] + edge[level] + below[level][:, None, :]
        both = np.logaddexp(joint[:, 0], joint[:, 1])
        total = np.logaddexp(both[:, :1], both[:, 1:])
        whole[level] = both - total  # scaled, so that very wide or deep trees stay in range
        pair[level] = np.exp(joint - total[:, :, None])
    whole -= np.logaddexp(whole[:, :1], whole[:, 1:])
    return np.exp(whole), pair


class Model:
    """Weights of features, and of label pairs by the kind of the lower node."""

    def __init__(self, features: dict[str, int], weights: np.ndarray, pairs: np.ndarray):
        self.features, self.weights, self.pairs = features, weights, pairs

    def potentials(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        own = np.zeros((len(forest.kind), 2))
        own[:, 1] = np.bincount(forest.node, self.weights[forest.feature], len(own))
        own[forest.unseen, 1] = -1e3
        return own, self.pairs[forest.kind]

    def marginals(self, trees: list[Tree]) -> tuple[Forest, np.ndarray]:
        """Of every node of the trees, the probability that it is main text."""
        forest = Forest(trees, self.features)
        if not len(forest.kind):
            return forest, np.zeros(0)
        return forest, beliefs(forest.parent, forest.levels, *self.potentials(forest))[0][:, 1]

    def main_texts(self, pages: list[str | None]) -> list[str]:
        """The main text of each page: leaves of one half and more, in page order, joined by an empty line."""
        trees = [Tree(page or "") for page in pages]
        forest, chance = self.marginals(trees)
        return [
            "\n\n".join(t.text[leaf - first] for leaf in leaves if chance[leaf] >= 0.5)
            for t, first, leaves in zip(trees, forest.first.tolist(), forest.leaves, strict=False)
        ]


def _labels(tree: Tree, main_text: str) -> list[int]:
    """1 for each leaf that is the next block of the main text, and for elements of whose text three quarters are."""
    blocks, at = [b for b in (" ".join(b.split()) for b in main_text.split("\n\n")) if b], 0
    main, length = [0] * len(tree.parent), [0] * len(tree.parent)
    for i, text in enumerate(tree.text):
        if text:
            length[i] = len(text)
            if at < len(blocks) and text == blocks[at]:
                main[i], at = len(text), at + 1
    if at < len(blocks):
        raise ValueError(f"a labelled page has no block {blocks[at]!r} after its first {at}")
    for i in range(len(main) - 1, 0, -1):
        main[tree.parent[i]] += main[i]
        length[tree.parent[i]] += length[i]
    return [int(n > 0 and m >= 0.75 * n) for m, n in zip(main, length, strict=True)]


def fit(labelled: Iterable[tuple[str, str]], rounds: int = 100, penalty: float = 0.1, rate: float = 0.15) -> Model:
    """The model under which labelled pages, pairs of html and main text, are likeliest.

    The pages are held by the driver: some hundreds or thousands of them, whatever
    the table that the model is for. The same pages give the same model.
    """
    labelled = list(labelled)
    trees = [Tree(html) for html, _ in labelled]
    labels = [_labels(t, text) for t, (_, text) in zip(trees, labelled, strict=True)]
    features: dict[str, int] = {}
    forest = Forest(trees, features, learn=True)
    y = np.array([v for page in labels for v in page], dtype=np.int64)
    lower = forest.parent >= 0
    weights, pairs = np.zeros(len(features)), np.zeros((3, 2, 2))
    seen_single = np.bincount(forest.feature, y[forest.node], len(features))
    seen_pair = np.zeros((3, 2, 2))
    np.add.at(seen_pair, (forest.kind[lower], y[forest.parent[lower]], y[lower]), 1)
    moments = [[np.zeros_like(weights), np.zeros_like(weights)], [np.zeros_like(pairs), np.zeros_like(pairs)]]
    for step in range(1, rounds + 1):
        single, pair = beliefs(forest.parent, forest.levels, *Model(features, weights, pairs).potentials(forest))
        expected = np.bincount(forest.feature, single[forest.node, 1], len(features))
        expected_pair = np.zeros((3, 2, 2))
        for kind in range(3):
            expected_pair[kind] = pair[lower & (forest.kind == kind)].sum(axis=0)
        slopes = (seen_single - expected - penalty * weights, seen_pair - expected_pair - penalty * pairs)
        for value, slope, (mean, square) in zip((weights, pairs), slopes, moments, strict=True):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            value += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model(features, weights, pairs)


def main_text(
    pages: DataFrame, model: Model, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars"
) -> DataFrame:
    """The pages without their html, with its main text and that text's length in code points.

    A null or empty html, and one without main text, give ''. Character references
    are decoded, white space within a block is one space, blocks are joined by two
    line ends in page order. Repeated rows give repeated rows. Other columns pass
    unchanged; where one has the name of a result, the result takes its place.
    """
    rest = [c for c in pages.columns if c.lower() not in {html_col.lower(), text_col.lower(), chars_col.lower()}]
    taken = {c.lower() for c in rest}
    inner = html_col
    while inner.lower() in taken:
        inner = "_" + inner
    shaped = pages.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{html_col}`").cast("string").alias(inner))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in shaped.schema.fields[:-1]], f"`{text_col}` string", f"`{chars_col}` long"])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = model.main_texts(batch.column(batch.num_columns - 1).to_pylist())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=[*rest, text_col, chars_col])

        return step

    return per_slice(shaped, make, schema)
