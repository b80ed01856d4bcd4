"""Main text of web pages: a tree-structured graphical model over the document tree."""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rdfweave.llm import common
from rdfweave.llm.labelled_pages import LABELLED

#: Pages of the table that the model is fitted on, with the labels their markup implies.
TRAINING_PAGES = 200

TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|!--(?:.*?--!?>|>|.*\Z)|[!?/][^>]*>?)", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
HINT = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Elements that stand inside a line of text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input meta link base param source track area col embed keygen".split())
EMPTY = frozenset("br img input meta link base param source track area col embed hr wbr keygen".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template textarea title iframe object svg math canvas select button audio video map datalist".split())
#: An element that ends when one of the others begins.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}


@dataclass
class Node:
    tag: str
    parent: int
    hints: list[str]
    label: str | None = None
    #: (order, text) of the blocks that belong to this node itself.
    blocks: list[tuple[int, str]] = field(default_factory=list)
    linked: int = 0


def parse(html: str) -> list[Node]:
    """Block elements as a tree, each parent before its children.

    Text of inline elements belongs to the block around them; a block ends where any
    block element begins or ends.
    """
    nodes = [Node("#root", -1, [])]
    stack = [0]
    run: list[str] = []
    order, links, linked, at, size = 0, 0, 0, 0, len(html)

    def text(piece: str) -> None:
        nonlocal linked
        run.append(piece)
        if links:
            linked += len(piece)

    def flush() -> None:
        nonlocal order, linked
        if run:
            joined = "".join(run)
            run.clear()
            line = " ".join((entities.unescape(joined) if "&" in joined else joined).split())
            if line:
                nodes[stack[-1]].blocks.append((order, line))
                nodes[stack[-1]].linked += linked
                order += 1
        linked = 0

    while at < size:
        tag_at = html.find("<", at)
        if tag_at < 0:
            text(html[at:])
            break
        if tag_at > at:
            text(html[at:tag_at])
        m = TAG.match(html, tag_at) or LOOSE.match(html, tag_at)
        if not m:
            text("<")
            at = tag_at + 1
            continue
        at = m.end()
        if m.group(2) is None:
            continue
        closing, tag = bool(m.group(1)), m.group(2).lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            if tag in ("br", "img", "input"):
                text(" ")
            continue
        flush()
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if nodes[stack[i]].tag == tag), 0)
            if depth:
                del stack[depth:]
                links = 0
            continue
        if tag in SILENT:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            if not m.group(3).rstrip().endswith("/"):
                at = end.end() if end else size
            continue
        if tag in ENDS_P:
            p = next((i for i in range(len(stack) - 1, 0, -1) if nodes[stack[i]].tag == "p"), 0)
            if p:
                del stack[p:]
        for i in range(len(stack) - 1, 0, -1):
            above = nodes[stack[i]].tag
            if above in LIMITS.get(tag, ()):
                break
            if above in ENDED_BY.get(tag, ()):
                del stack[i:]
                break
        hints, label = [], None
        if m.group(3).strip():
            for a in ATTRIBUTE.finditer(m.group(3)):
                value = a.group(2) or a.group(3) or a.group(4) or ""
                if a.group(1).lower() in ("hidden", "aria-hidden"):
                    hints += ["hidden"] if value.lower() != "false" else []
                else:
                    hints += [h.lower() for h in HINT.findall(value)]
            known = re.search(r"data-main=\"([01])\"", m.group(3))
            label = known.group(1) if known else None
        nodes.append(Node(tag, stack[-1], hints, label))
        if tag not in EMPTY:
            stack.append(len(nodes) - 1)
    flush()
    return nodes


def features(node: Node) -> list[str]:
    """What is seen at a node: tag, names, and bands of its text."""
    out = [f"tag {node.tag}", *{f"name {h}" for h in node.hints}]
    if node.blocks:
        text = " ".join(b for _, b in node.blocks)
        n = len(text)
        out.append(f"size {min(8, n.bit_length() // 2 * 2)}")
        out.append(f"links {min(4, int(4 * node.linked / max(n, 1)))}")
        out.append(f"stops {min(3, sum(text.count(c) for c in '.!?,;'))}")
    else:
        out.append("no text")
    return out


#: What the markup of a page says about the elements below it, for training only.
MEANS = dict.fromkeys(("article", "main"), 1) | dict.fromkeys(("nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"), 0)


def implied(nodes: list[Node]) -> np.ndarray:
    """Training labels: 1 content, 0 not, from ``data-main`` or from what the tags mean.

    A page without such a tag says nothing (-1).
    """
    out = np.full(len(nodes), -1)
    if not any(n.label or MEANS.get(n.tag) == 1 for n in nodes):
        return out
    out[0] = 0
    for i, n in enumerate(nodes[1:], 1):
        above = out[n.parent]
        if n.label is not None:
            out[i] = int(n.label)
        elif n.tag in MEANS and (MEANS[n.tag] == 1 or not (n.tag == "header" and above == 1)):
            out[i] = MEANS[n.tag]
        else:
            out[i] = above
    return out


@dataclass
class Model:
    """Log potentials: ``weight`` of a feature for content over the rest, ``pair`` by
    (label of parent, label of child), ``start`` of the root."""

    weight: dict[str, float]
    pair: np.ndarray
    start: np.ndarray

    def unary(self, pages: list[list[Node]]) -> np.ndarray:
        get = self.weight.get
        return np.array([sum([get(f, 0.0) for f in features(n)]) for page in pages for n in page])

    def marginals(self, pages: list[list[Node]]) -> list[np.ndarray]:
        """Probability of content of every node, by messages up and then down each tree."""
        if not pages:
            return []
        sizes = np.array([len(p) for p in pages])
        first = np.concatenate([[0], np.cumsum(sizes)])
        parent = np.concatenate([[n.parent + first[i] if n.parent >= 0 else -1 for n in p] for i, p in enumerate(pages)]).astype(np.int64)
        depth = np.zeros(len(parent), np.int64)
        for i, p in enumerate(parent.tolist()):
            if p >= 0:
                depth[i] = depth[p] + 1
        by_depth = np.argsort(depth, kind="stable")
        levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)
        up = np.stack([np.zeros(len(parent)), self.unary(pages)], 1)
        up[parent < 0] += self.start
        sent = np.zeros_like(up)
        for level in reversed(levels[1:]):
            sent[level] = np.logaddexp(self.pair[:, 0] + up[level, :1], self.pair[:, 1] + up[level, 1:])
            np.add.at(up, parent[level], sent[level])
        down = np.zeros_like(up)
        for level in levels[1:]:
            rest = up[parent[level]] + down[parent[level]] - sent[level]
            down[level] = np.logaddexp(rest[:, :1] + self.pair[0], rest[:, 1:] + self.pair[1])
            down[level] -= down[level].max(1, keepdims=True)
        belief = up + down
        p = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))
        return np.split(p, first[1:-1])


def fit(pages: list[list[Node]]) -> Model:
    """Potentials counted on labelled nodes, smoothed by one; each page weighs the same
    whatever its length, so that long pages do not drown the others."""
    seen: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
    total, pair = np.full(2, 2.0), np.full((2, 2), 0.5)
    for nodes in pages:
        labels = implied(nodes)
        each = np.bincount(labels[labels >= 0], minlength=2)
        for i, n in enumerate(nodes):
            if labels[i] < 0 or i == 0:
                continue
            w = 1 / each[labels[i]] ** 0.5
            total[labels[i]] += w
            for f in features(n):
                seen[f][labels[i]] += w
            pair[labels[n.parent], labels[i]] += w
    weight = {f: float(np.log((c[1] + 0.5) / (total[1] + 1)) - np.log((c[0] + 0.5) / (total[0] + 1))) for f, c in seen.items()}
    links = np.log(pair / pair.sum(1, keepdims=True))
    # What is seen at one node is far from independent: the share of its weight that
    # gives the likeliest marginals on the labelled nodes is taken.
    known = np.concatenate([implied(p) for p in pages]) if pages else np.zeros(0)

    def loss(model: Model) -> float:
        p = np.clip(np.concatenate(model.marginals(pages)), 1e-9, 1 - 1e-9)
        return float(-(np.log(p[known == 1]).sum() + np.log(1 - p[known == 0]).sum()))

    tempered = [
        Model({f: w * (tag if f.startswith("tag ") else name if f.startswith("name ") else text) for f, w in weight.items()}, links, np.log([0.9, 0.1]))
        for tag in (0.3, 0.6, 1.0) for name in (0.6, 1.0) for text in (0.15, 0.3, 0.6, 1.0)
    ]
    return min(tempered, key=loss) if pages else tempered[0]


def main_text(nodes: list[Node], content: np.ndarray) -> str:
    blocks = sorted(b for n, p in zip(nodes, content, strict=True) if p > 0.5 for b in n.blocks)
    return "\n".join(t for _, t in blocks)


def learn(pages: DataFrame, limit: int = TRAINING_PAGES) -> Model:
    """A model from the built-in labelled pages and a bounded sample of the table."""
    rows = sorted(common.sample(common.only(pages, "html").filter("html IS NOT NULL"), limit, "html").collect())
    own = [parse(x) for x in LABELLED]
    # The built-in pages show layouts that the sample may lack; together they weigh as much.
    return fit(own * max(1, len(rows) // len(own)) + [parse(r["html"]) for r in rows])


def extract(spark: SparkSession, pages: DataFrame, limit: int = TRAINING_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null or empty html gives an empty text; markup that is not closed ends with the page;
    repeated rows have equal rows; a table without any page that says where its article
    is relies on the built-in pages; an empty table gives an empty result.
    """
    sent = spark.sparkContext.broadcast(learn(pages, limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in common.chunks(batches, "html"):
            trees = [parse(x.decode("utf-8", "replace")) for x in raw]
            texts = [main_text(t, p) for t, p in zip(trees, sent.value.marginals(trees), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    source = common.only(pages, "page_id", "url", "html")
    kind = source.schema["page_id"].dataType.simpleString()
    return source.withColumn("url", F.col("url").cast("string")).mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op4_tree_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, common.table(spark, sf_dir, "pages"))
