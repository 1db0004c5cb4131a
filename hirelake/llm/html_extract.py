"""Main text of web pages by a tree-structured graphical model.

The elements of a page and its runs of text are the nodes of a tree with one label variable
each: content, other, or both below it. A node's potential is the likelihood of what is seen of it (kind of
element, hint in class and id, words, share of linked words, sentence marks); an edge's
potential is the probability of the child's label given the parent's and the child's kind.
Sum-product messages upward and downward give exact marginals, and the runs of text whose
marginal is above one half are the main text. All tables are counted on labelled pages.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from hirelake.llm.common import ship_by_value, table
from hirelake.llm.html_pages import LABEL, labelled_pages

# About this many pages of the table are taken for training (by a hash of the id): what stands
# in an <article> is labelled content there.
TRAIN_PAGES = 300
TRAIN_COMPOSED = 600
SMOOTHING = 0.5

# Fixed sets of element names, by how HTML lays them out.
DROPPED = frozenset("script style noscript template svg math iframe object canvas select option button textarea "
                    "head title audio video map datalist".split())
RAW = frozenset("script style noscript template iframe textarea title svg math canvas object audio video".split())
# Without an end tag, all behind these is theirs; others have no content then.
RAW_TO_END = frozenset("script style iframe textarea title".split())
FOREIGN = frozenset(("svg", "math"))
IN_HEAD = frozenset("html head base link meta title style script noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr input".split())
CLOSES_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                             "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
# An element ends the innermost open ones as long as they are of the listed kinds.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th")}
# Kinds of element the model tells apart; others are "other".
KINDS = frozenset("#text html body article main section div p h1 h2 h3 h4 ul ol li dl dd blockquote pre table tr td th nav "
                  "header footer aside form figure figcaption".split())
# Hints in class, id and role, the first that matches counts.
HINTS = (
    ("comment", re.compile(r"comment|repl(?:y|ies)|response|disqus|discussion")),
    ("ad", re.compile(r"(?:^|[\s_-])ads?(?:$|[\s_-])|advert|sponsor|promo|banner")),
    ("notice", re.compile(r"cookie|consent|notice|alert|dialog|popup|modal|gdpr")),
    ("form", re.compile(r"newsletter|subscri|sign-?up|login|search|form")),
    ("nav", re.compile(r"nav|menu|breadcrumb|pag(?:er|ination)|toc|tags")),
    ("foot", re.compile(r"foot|copyright|legal")),
    ("head", re.compile(r"header|masthead|logo|topbar")),
    ("side", re.compile(r"side|widget|related|recommend|share|social|trending|popular")),
    ("content", re.compile(r"content|article|post|entry|story|body|text|main")),
)
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_MARK = re.compile(rf"{LABEL}=([01])")


class Node:
    """An element, or with kind ``#text`` a run of text between block boundaries."""

    __slots__ = ("children", "hint", "kind", "label", "linked", "parent", "parts", "sentences", "tag", "words")

    def __init__(self, tag: str, parent: int, attributes: str = "", label: int = -1) -> None:
        self.tag, self.parent, self.label = tag, parent, label
        self.kind = tag if tag in KINDS else "other"
        self.hint = "none"
        if attributes and ("class" in attributes or "id" in attributes or "role" in attributes):
            names = " ".join(a or b or c for a, b, c in _ATTRIBUTE.findall(attributes)).lower()
            self.hint = next((name for name, pattern in HINTS if pattern.search(names)), "none")
        self.parts: list[str] = []
        self.words = self.linked = self.sentences = 0


def parse(page: str, marks: bool = True) -> list[Node]:
    """Nodes in page order, parents first. Follows the usual rules for end tags left out;
    comments, declarations and the text of dropped elements are skipped; a ``<`` that opens
    nothing is text. With ``marks`` the spans of composed pages give labels; on all other
    pages a span is plain inline. Time is linear in the page."""
    nodes = [Node("html", -1)]
    stack = [0]          # open block elements
    inline: list[str] = []  # open inline elements that matter: links
    dropped: list[tuple[str, bool]] = []  # and whether the next block ends it, as no end tag will
    endless: set[str] = set()  # names that no end tag has from here on
    labels: list[int] = []
    run = -1
    at, size, last_end = 0, len(page), page.rfind(">")
    opened: Counter[str] = Counter()

    def text(piece: str) -> None:
        nonlocal run
        if dropped and dropped[-1][0] == "head" and not piece.isspace():
            dropped.pop()
        if dropped or not piece or (run < 0 and piece.isspace()):
            return
        if run < 0:
            nodes.append(Node("#text", stack[-1], label=labels[-1] if labels else -1))
            run = len(nodes) - 1
        node = nodes[run]
        node.parts.append(piece)
        if inline:
            node.linked += len(html.unescape(piece).split())

    def has_end(tag: str) -> bool:
        """Is the next tag of this name an end tag?"""
        found = None if tag in endless else re.compile(rf"<(/?){re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
        if not found:
            endless.add(tag)
        return bool(found and found[1])

    while at < size:
        open_at = page.find("<", at)
        if open_at < 0:
            text(page[at:])
            break
        if open_at > at:
            text(page[at:open_at])
        if page.startswith("<!--", open_at):
            end = page.find("-->", open_at + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), open_at):
            end = page.find(">", open_at)
            at = size if end < 0 else end + 1
            continue
        found = (_TAG.match(page, open_at) or _LOOSE_TAG.match(page, open_at)) if open_at < last_end else None
        if not found:
            text("<")
            at = open_at + 1
            continue
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if not closing and dropped and dropped[-1][0] == "head" and tag not in IN_HEAD:
            dropped.pop()
        if not closing and tag in DROPPED and attributes.endswith("/") and (tag in FOREIGN or not has_end(tag)):
            continue
        if not closing and tag in RAW:
            end = None if tag in endless else re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
            if end:
                close = page.find(">", end.start())
                at = size if close < 0 else close + 1
            elif tag in RAW_TO_END:
                at = size
            else:
                endless.add(tag)
            continue
        if tag in DROPPED:
            names = [name for name, _ in dropped]
            if closing and tag in names:
                del dropped[names.index(tag):]
            elif not closing and tag != "option":
                if tag in names:  # ends the open one
                    del dropped[names.index(tag)]
                dropped.append((tag, tag != "head" and not has_end(tag)))
            continue
        if tag == "body" and not closing:
            dropped.clear()
        if marks and tag == "span" and (closing and labels or LABEL in attributes):
            # marks of training pages nest properly: no other span occurs there
            run = -1
            if closing:
                labels.pop()
            else:
                labels.append(int(_MARK.search(attributes)[1]))
            continue
        if tag in INLINE:
            if tag == "a":
                if closing:
                    inline.clear()
                else:
                    inline[:] = ["a"]
            elif tag in ("br", "wbr", "img", "input"):
                text(" ")
            continue
        if tag in VOID:
            run = -1
            continue
        run = -1
        if tag != "optgroup" and (not closing or opened[tag]):
            while dropped and dropped[-1][1]:
                dropped.pop()
        if closing:
            while opened[tag]:
                last = nodes[stack.pop()].tag
                opened[last] -= 1
                if last == tag:
                    inline.clear()
                    break
            continue
        inline.clear()
        if tag == "html" or tag == "body" and opened["body"]:
            continue
        ends = ENDS.get(tag, ())
        while len(stack) > 1:
            top = nodes[stack[-1]].tag
            if not (top == "p" and (ends or tag in CLOSES_PARAGRAPH) or top in ends):
                break
            opened[nodes[stack.pop()].tag] -= 1
        nodes.append(Node(tag, stack[-1], attributes, labels[-1] if labels else -1))
        stack.append(len(nodes) - 1)
        opened[tag] += 1
    for node in nodes:
        if node.parts:
            words = html.unescape("".join(node.parts)).split()
            node.parts = [" ".join(words)]
            node.words = len(words)
            node.sentences = sum(w[-1] in ".!?:;,\"”»" for w in words)
    for k in range(len(nodes) - 1, 0, -1):
        node, parent = nodes[k], nodes[nodes[k].parent]
        parent.words += node.words
        parent.linked += node.linked
        parent.sentences += node.sentences
    return nodes


def _bucket(x: float, cuts: tuple[float, ...]) -> int:
    return sum(x >= c for c in cuts)


def seen(node: Node) -> tuple[tuple[str, object], ...]:
    """What the model sees of a node."""
    words = max(1, node.words)
    return (("kind", node.kind), ("hint", (node.kind in ("#text", "p"), node.hint)),
            ("words", (node.kind == "#text", _bucket(node.words, (1, 3, 6, 12, 30, 80)))),
            ("linked", _bucket(node.linked / words, (0.01, 0.3, 0.6, 0.9))),
            ("sentences", (node.kind == "#text", _bucket(node.sentences / words, (0.001, 0.03, 0.1)))))


# Labels of a node. Mixed elements hold both content and other parts, as the body does.
OTHER, CONTENT, MIXED = LABELS = (0, 1, 2)


class Model:
    """Log tables: per feature value and label, and per (parent label, kind) of the child."""

    def __init__(self) -> None:
        self.seen: dict[tuple[str, object], list[float]] = {}
        self.totals = [0.0] * len(LABELS)
        self.edges: dict[tuple[int, str], list[float]] = {}
        self.unseen: dict[str, list[float]] = {}

    def add(self, nodes: list[Node], labels: list[int]) -> None:
        for k, node in enumerate(nodes):
            label = labels[k]
            self.totals[label] += 1
            for feature in seen(node):
                self.seen.setdefault(feature, [0.0] * len(LABELS))[label] += 1
            parent = labels[node.parent] if k else MIXED
            self.edges.setdefault((parent, node.kind), [0.0] * len(LABELS))[label] += 1

    def fit(self) -> Model:
        sizes: dict[str, int] = {}
        for name, _ in self.seen:
            sizes[name] = sizes.get(name, 0) + 1
        for name, size in sizes.items():
            self.unseen[name] = [log(SMOOTHING / (t + SMOOTHING * size)) for t in self.totals]
        self.seen = {f: [log((c[y] + SMOOTHING) / (self.totals[y] + SMOOTHING * sizes[f[0]])) for y in LABELS]
                     for f, c in self.seen.items()}
        self.edges = {e: [log((c[y] + SMOOTHING) / (sum(c) + len(LABELS) * SMOOTHING)) for y in LABELS]
                      for e, c in self.edges.items()}
        # a kind not met below a label keeps to its parent's label
        for y in LABELS:
            self.edges[y, ""] = [log(0.8 if z == y else 0.1) for z in LABELS]
        return self

    def _potentials(self, node: Node) -> list[float]:
        out = [0.0] * len(LABELS)
        for feature in seen(node):
            if feature[0] != "kind":  # the kind enters through the edges
                for y, value in enumerate(self.seen.get(feature) or self.unseen[feature[0]]):
                    out[y] += value
        return out

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content per node, by messages from the leaves up and back down."""
        n = len(nodes)
        belief = [self._potentials(node) for node in nodes]
        edge = [[self.edges.get((y, node.kind)) or self.edges[y, ""] for y in LABELS] for node in nodes]
        up: list[list[float]] = [[0.0] * len(LABELS)] * n
        for k in range(n - 1, 0, -1):
            own = belief[k]
            up[k] = [_log_sum([own[z] + e[z] for z in LABELS]) for e in edge[k]]
            parent = belief[nodes[k].parent]
            for y in LABELS:
                parent[y] += up[k][y]
        for y in LABELS:
            belief[0][y] += edge[0][MIXED][y]
        for k in range(1, n):
            above = belief[nodes[k].parent]
            rest = [above[y] - up[k][y] for y in LABELS]
            down = [_log_sum([rest[y] + edge[k][y][z] for y in LABELS]) for z in LABELS]
            top = max(down)
            for z in LABELS:
                belief[k][z] += down[z] - top
        return [exp(b[CONTENT] - _log_sum(b)) for b in belief]


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + log(sum(exp(t - top) for t in terms))


def _labels(nodes: list[Node], article: bool) -> list[int]:
    """Marked pages: the innermost mark. Pages of the table: content is what stands in the
    <article>. An element around content that is not content itself is mixed."""
    out = [OTHER] * len(nodes)
    for k, node in enumerate(nodes):
        if article:
            inside = node.tag == "article" or (k > 0 and out[node.parent] == CONTENT)
            out[k] = CONTENT if inside else OTHER
        else:
            out[k] = CONTENT if node.label == 1 else OTHER
    for k in range(len(nodes) - 1, 0, -1):
        if out[k] != OTHER and out[nodes[k].parent] == OTHER:
            out[nodes[k].parent] = MIXED
    return out


def train(pages: DataFrame | None, id_col: str = "page_id", html_col: str = "html",
          train_pages: int = TRAIN_PAGES, composed: int = TRAIN_COMPOSED) -> Model:
    """Count the tables on composed pages and on a bounded sample of the table's pages that
    have exactly one ``<article>``."""
    model = Model()
    for page in labelled_pages(composed):
        nodes = parse(page)
        model.add(nodes, _labels(nodes, article=False))
    if pages is not None:
        usable = pages.where((F.regexp_count(F.lower(html_col), F.lit("<article")) == 1))
        share = min(1.0, train_pages / max(1, usable.count()))
        draw = F.pmod(F.xxhash64(F.lit("html"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))),
                      F.lit(1 << 30)) / float(1 << 30)
        for row in usable.where(draw < share).select(html_col).collect():
            nodes = parse(row[0], marks=False)
            model.add(nodes, _labels(nodes, article=True))
    return model.fit()


def main_text(model: Model, page: str) -> str:
    nodes = parse(page, marks=False)
    chosen = model.marginals(nodes)
    return "\n".join(n.parts[0] for n, p in zip(nodes, chosen, strict=True) if p > 0.5 and n.tag == "#text" and n.parts[0])


def extract(pages: DataFrame, model: Model, html_col: str = "html") -> Column:
    """Main text column for ``pages``. Null, empty and textless pages give the empty string;
    character references are decoded, white space inside a block becomes one space, and the
    blocks are joined in page order by a line end. No page is cut."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda page: main_text(shared.value, page or ""))
    return text(F.col(html_col))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", extract(pages, train(pages)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


ship_by_value(__name__)
