"""Main text of web pages: a graphical model over the tree of blocks, solved by sum-product.

Every block element and every text of a page is a node with a label: main text or not.
Node potentials come from its element, the words of its class, id and role, and, for texts,
length, links and punctuation. Parent-child potentials say how likely a label is handed
down, by what the child is marked as. Messages go upward from the texts and downward from
the page; their product is each node's marginal. Texts of at least one half are the main
text. Weights are fitted by maximum likelihood (the same messages give its gradient) to the
labelled pages of ``page_labels``, on the driver, in a few seconds and always alike; labels of
other pages can be given instead.

Character references are decoded; white space of any kind inside a block is one space;
blocks are joined by two line feeds. Null and empty pages have an empty text. Repeated rows
and all columns are handed through. Pages are worked on where they lie, without a shuffle;
memory is in proportion to the longest page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.dom import Page, parsed
from tidemark.llm.page_labels import labelled_pages

# Words of class, id and role names by what they say about a block.
CONCEPTS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs toolbar",
    "head": "header masthead topbar banner top branding logo hero",
    "foot": "footer foot bottom copyright legal contentinfo colophon",
    "side": "sidebar aside rail widget widgets complementary secondary",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted dfp adsense",
    "notice": "cookie cookies consent gdpr notice alert warning popup modal overlay dialog newsletter subscribe subscription signup paywall toast notification announcement disclaimer",
    "comment": "comment comments commentlist respond reply replies disqus discussion reader feedback reviews",
    "share": "share sharing social follow like twitter facebook",
    "related": "related recommended recommendations recommend trending popular more read also links tags tag categories latest teaser",
    "form": "form search login signin register input contact",
    "hidden": "hidden invisible sr screen",
    "main": "main content article post entry story text body articlebody page maincontent prose",
}
_CONCEPT = {word: concept for concept, line in CONCEPTS.items() for word in line.split()}
_MARKS_OUT = {name for name in CONCEPTS if name != "main"}
_TAGS_OUT = {"nav", "header", "footer", "aside", "form", "dialog", "noscript", "button", "label", "select", "menu", "search", "fieldset", "legend", "option"}
_TAGS_IN = {"article", "main"}
_TAGS = sorted(
    _TAGS_OUT | _TAGS_IN
    | set("section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure figcaption details summary body html address center".split())
)
_FEATURES = {
    name: i
    for i, name in enumerate(
        ["node", "text", *[f"tag {t}" for t in _TAGS], "tag other", *[f"is {c}" for c in CONCEPTS]]
        + [f"{c} in article" for c in ("header", "footer")]
        + [f"long {i}" for i in range(6)] + [f"linked {i}" for i in range(3)]
        + [f"bare long {i}" for i in range(6)] + ["sentence", "rights"]
    )
}
#: Marks that also hold for whatever lies deeper, an article among comments for instance.
_KEEPS_OUT = {"ad", "comment", "notice", "related", "side"}
#: Kinds of edges, by the child: an element, one marked as no main text, one marked as main
#: text, a text; one marked as main text under ``_KEEPS_OUT``; an element and a text of a
#: page without any mark of main text.
_PLAIN, _OUT, _IN, _TEXT, _IN_UNDER_OUT, _BARE, _BARE_TEXT = _EDGES = range(7)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NODES_AT_ONCE = 200_000


def _names(attributes: dict[str, str]) -> set[str]:
    """What class, id and role say the block is."""
    said = " ".join(attributes.get(key, "") for key in ("class", "id", "role", "itemprop", "aria-label"))
    out = {_CONCEPT[w] for w in map(str.lower, _WORD.findall(said)) if w in _CONCEPT}
    style = attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in attributes or "display:none" in style or attributes.get("aria-hidden") == "true":
        out.add("hidden")
    return out


@dataclass
class Forest:
    """Nodes of several pages: parent (-1: none), depth, kind of the edge above, features as pairs."""

    parent: np.ndarray
    depth: np.ndarray
    edge: np.ndarray
    feature_node: np.ndarray
    feature: np.ndarray

    @classmethod
    def of(cls, pages: Sequence[Page]) -> Forest:
        parent, depth, edge, at, feature = [], [], [], [], []
        for page in pages:
            base = len(parent)
            inside: list[bool] = []
            under_out: list[bool] = []
            names = [_names(a) if a else set() for a in page.attributes]
            bare = not any(t in _TAGS_IN or "main" in said for t, said in zip(page.tag, names))
            for i, (above, tag) in enumerate(zip(page.parent, page.tag)):
                parent.append(base + above if above >= 0 else -1)
                depth.append(depth[base + above] + 1 if above >= 0 else 0)
                inside.append(tag in _TAGS_IN or (above >= 0 and inside[above]))
                said = names[i]
                under_out.append(bool(said & _KEEPS_OUT) or (above >= 0 and under_out[above]))
                if tag:
                    found = ["node", f"tag {tag}" if f"tag {tag}" in _FEATURES else "tag other"]
                    found += [f"is {c}" for c in sorted(said)]
                    if tag in ("header", "footer") and inside[i]:
                        found.append(f"{tag} in article")
                    out = tag in _TAGS_OUT or bool(said & _MARKS_OUT)
                    if out:
                        edge.append(_OUT)
                    elif tag in _TAGS_IN or "main" in said:
                        edge.append(_IN_UNDER_OUT if under_out[i] else _IN)
                    else:
                        edge.append(_BARE if bare and not under_out[i] else _PLAIN)
                else:
                    text = page.text[i]
                    n = len(text)
                    linked = min(2, int(3 * page.linked[i] / (n + 1)))
                    found = ["text", f"long {min(5, n.bit_length() // 2)}", f"linked {linked}"]
                    plain = bare and not under_out[i]
                    if plain:
                        found.append(f"bare {found[1]}")
                    if text[-1] in ".!?…:":
                        found.append("sentence")
                    if "©" in text:
                        found.append("rights")
                    edge.append(_BARE_TEXT if plain else _TEXT)
                for name in found:
                    at.append(base + i)
                    feature.append(_FEATURES[name])
        return cls(*(np.array(x, dtype=np.int64) for x in (parent, depth, edge, at, feature)))


@dataclass
class Model:
    """Weights for the label main text: of features, and of (edge kind, label above, label)."""

    nodes: np.ndarray
    edges: np.ndarray

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """P(main text) of each node, and P(label above, label) of each node with its parent."""
        size = len(forest.parent)
        score = np.zeros((size, 2))
        np.add.at(score[:, 1], forest.feature_node, self.nodes[forest.feature])
        pair = self.edges[forest.edge]  # node, label above, label
        order = np.argsort(forest.depth, kind="stable")
        bounds = np.searchsorted(forest.depth[order], np.arange(forest.depth.max(initial=0) + 2))
        levels = [order[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        below = score.copy()
        message = np.zeros((size, 2))
        for level in reversed(levels[1:]):
            message[level] = np.logaddexp.reduce(pair[level] + below[level, None, :], axis=2)
            np.add.at(below, forest.parent[level], message[level])
        belief = below.copy()
        both = np.zeros((size, 2, 2))
        for level in levels[1:]:
            rest = belief[forest.parent[level]] - message[level]
            joint = rest[:, :, None] + pair[level] + below[level, None, :]
            belief[level] = np.logaddexp.reduce(joint, axis=1)
            both[level] = np.exp(joint - np.logaddexp.reduce(belief[level], axis=1)[:, None, None])
        total = np.logaddexp.reduce(belief, axis=1) if size else np.zeros(0)
        return np.exp(belief[:, 1] - total), both


def page_labels(page: Page) -> np.ndarray:
    """The label of each node: that of the nearest ``m`` attribute above it."""
    out = []
    for above, attributes in zip(page.parent, page.attributes):
        given = attributes.get("m")
        out.append(given == "1" if given is not None else above >= 0 and out[above])
    return np.array(out, dtype=np.int64)


def _model(weights: np.ndarray) -> Model:
    return Model(weights[: len(_FEATURES)], weights[len(_FEATURES) :].reshape(-1, 2, 2))


def trained(pages: Sequence[str], steps: int = 400, prior: float = 0.002) -> Model:
    """Weights of the greatest likelihood of the labels, with a normal prior."""
    read = [parsed(page) for page in pages]
    forest, label = Forest.of(read), np.concatenate([page_labels(page) for page in read])
    edge = np.flatnonzero(forest.parent >= 0)
    above = label[forest.parent[edge]]
    seen_nodes = np.bincount(forest.feature, label[forest.feature_node], minlength=len(_FEATURES))
    seen_edges = np.zeros((len(_EDGES), 2, 2))
    np.add.at(seen_edges, (forest.edge[edge], above, label[edge]), 1)
    weights = np.zeros(len(_FEATURES) + 4 * len(_EDGES))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        model = _model(weights)
        main, both = model.marginals(forest)
        nodes = np.bincount(forest.feature, main[forest.feature_node], minlength=len(_FEATURES))
        edges = np.zeros((len(_EDGES), 2, 2))
        np.add.at(edges, forest.edge[edge], both[edge])
        slope = np.concatenate([seen_nodes - nodes, (seen_edges - edges).ravel()])
        slope = slope / len(pages) - prior * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        weights = weights + 0.1 * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8
        )
    return _model(weights)


@lru_cache(maxsize=1)
def default_model() -> Model:
    return trained(labelled_pages())


def main_texts(pages: Sequence[Page], model: Model) -> list[str]:
    """The texts of the leaves that are main text, in page order."""
    if not pages:
        return []
    main, _ = model.marginals(Forest.of(pages))
    out, base = [], 0
    for page in pages:
        kept = main[base : base + len(page.tag)] >= 0.5
        out.append("\n\n".join(t for t, ok in zip(page.text, kept) if t and ok))
        base += len(page.tag)
    return out


def main_text(pages: DataFrame, column: str = "html", model: Model | None = None) -> DataFrame:
    """``pages`` with the main text of ``column`` in a last column ``__main`` (string)."""
    model = model or default_model()
    rest = [name for name in pages.columns if name != column]
    packed = pages.select(
        (F.struct(*rest) if rest else F.lit(0)).alias("__rest"), F.col(column).alias("__html")
    )

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            waiting: list[Page] = []
            nodes = 0
            for value in batch.column(1):
                waiting.append(parsed(value.as_py() or ""))
                nodes += len(waiting[-1].tag)
                if nodes > _NODES_AT_ONCE:
                    texts += main_texts(waiting, model)
                    waiting, nodes = [], 0
            texts += main_texts(waiting, model)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=["__rest", "__html", "__main"]
            )

    schema = StructType([*packed.schema.fields, StructField("__main", StringType())])
    out = packed.mapInArrow(extracted, schema)
    return out.select(
        *[
            F.col("__html").alias(name) if name == column else F.col("__rest").getField(name).alias(name)
            for name in pages.columns
        ],
        "__main",
    )


def page_digest(pages: DataFrame) -> DataFrame:
    """The main text of every page."""
    return main_text(pages.select("page_id", "url", "html")).select(
        "page_id",
        "url",
        F.col("__main").alias("text"),
        F.length("__main").cast("long").alias("n_chars"),
    )
