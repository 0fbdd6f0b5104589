"""HTML main text by a tree-structured graphical model.

Every element of a page's tree is content or not.  Each has a potential from
its own features (tag, words of its class and id, amount of text, share of
link text) and each parent-child edge one that depends on the child's tag and on the parent's place.
Sum-product messages, up to the root and down again, give every element's
marginal; the text of elements with a marginal above one half is the main
text.

The weights are learned by maximum likelihood (observed minus expected
features) from labelled pages: pages with exactly one ``article`` or ``main``
element label themselves, as what is in it, less its menus and forms, is content.  So that
the model learns pages of other makes too, training pages are varied, with
the labels known by construction: the main element's tag is hidden or the
element taken out, paragraphs get other tags, and notices, comments and site
headers made of the page's own words are put around and into the article.
Learning reads at most ``TRAINING_PAGES`` pages.
"""

from __future__ import annotations

import html as html_module
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstat.llm.common import ship

TRAINING_PAGES = 240
STEPS = 60
PULL = 2.0  # towards the plain rules; little against a hundred pages, much against two
ship(__name__)

# Element names of the HTML standard, by the role they have here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "head title script style noscript template iframe object svg canvas audio video map "
    "select option optgroup datalist textarea button input nav menu aside footer form dialog".split()
)
RAW = frozenset("script style textarea title noscript iframe template".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
# What begins and ends a block of text; every other element, an unknown one too, stands in the line.
BLOCKS = CLOSES_P | frozenset(
    "html head body title li dt dd tr td th thead tbody tfoot caption legend summary hgroup search dialog center dir option optgroup".split()
)
DEEPEST = 512  # levels of the tree; what is nested deeper is put there, as browsers do
TAGS = (
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th "
    "blockquote pre figure figcaption header footer nav aside form a b strong em i span br img hr code address details".split()
)
_TAG_ID = {t: i + 1 for i, t in enumerate(TAGS)}
# Words of class and id attributes.
GOOD_WORDS = frozenset("article body caption content entry main post story text".split())
BAD_WORDS = frozenset(
    "ad ads alert adv advert advertisement banner bar breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies disqus dropdown foot footer form gdpr head header legal login masthead menu meta modal nav "
    "navbar navigation newsletter notice notices pager pagination popup promo promoted related reply replies search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar tracking widget".split()
)
# Of these, words that long running text may have too: they tell nothing then.
WEAK_WORDS = frozenset("bar byline foot head header legal meta related share sharing skip social tags toolbar tracking widget".split())
RUNNING = 80  # characters of an element's own text from which it is running text
_BAD_LIST = sorted(BAD_WORDS)
_WORD = re.compile(r"[a-z]+")
# Attributes as the standard reads them: a quote opens a value only after "=", one that is not closed ends with the page.
_VALUE = r"""(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>"'][^\s>]*+))?+)?+"""
_ATTR = re.compile(rf"(=?[^\s/>=]++|=){_VALUE}")
_NO_GROUPS = re.sub(r"(?<!\\)\((?!\?)", "(?:", _VALUE)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|(?:=?[^\s/>=]++|=){_NO_GROUPS})*+)(?:>|\Z)", re.S
)
_SLASH = re.compile(r"(?:^|[\s\"'])/\s*$")

# Features of an element, each one of a few values; the potential is the sum of their weights.
WIDTHS = (len(TAGS) + 2, 4, 5, 4, 4, 3)
OFFSETS = tuple(int(x) for x in np.cumsum((0, *WIDTHS)))
# An edge's potential depends on the child's tag and on whether the parent is the page itself (body) or not.
EDGE_KINDS = 2 * (len(TAGS) + 2)


@dataclass
class Page:
    """The element tree, in page order (a parent comes before its children), and the pieces of text."""

    tags: list[str] = field(default_factory=lambda: ["#root"])
    parents: list[int] = field(default_factory=lambda: [-1])
    depths: list[int] = field(default_factory=lambda: [0])
    hints: list[int] = field(default_factory=lambda: [0])  # by :func:`_hint`
    never: list[bool] = field(default_factory=lambda: [False])
    # (element, text); element -1: a block ends, -2: a line break inside a block.
    pieces: list[tuple[int, str]] = field(default_factory=list)


def _hint(attributes: str) -> tuple[int, bool]:
    """0: nothing told, 1: good word, 2: bad word, 3: both; and whether all bad words are weak."""
    words: set[str] = set()
    for name, a, b, c in _ATTR.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            words.update(_WORD.findall((a or b or c).lower()))
    bad = words & BAD_WORDS
    return (1 if words & GOOD_WORDS else 0) + (2 if bad else 0), bad <= WEAK_WORDS


def parse(source: str) -> Page:
    """Elements and text of ``source``; unclosed and stray tags are taken as browsers mostly do."""
    page, stack, at, n = Page(), [0], 0, len(source)
    tags, pieces, opened = page.tags, page.pieces, Counter()
    weak: list[int] = []

    def close(depth: int) -> None:
        for x in stack[depth:]:
            opened[tags[x]] -= 1
        del stack[depth:]

    while at < n:
        m = _TOKEN.search(source, at)
        if m is None:
            pieces.append((stack[-1], source[at:]))
            break
        if m.start() > at:
            pieces.append((stack[-1], source[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag] > 0:
                depth = len(stack) - 1
                while tags[stack[depth]] != tag:
                    depth -= 1
                if any(tags[x] in BLOCKS for x in stack[depth:]):
                    pieces.append((-1, ""))
                close(depth)
            continue
        if tag in BLOCKS:
            pieces.append((-1, ""))
            _close_implied(tags, stack, tag, opened, close)
        elif tag == "br":
            pieces.append((-2, ""))
        parent = stack[-1]
        if page.depths[parent] >= DEEPEST:
            parent = page.parents[parent]
        own = len(tags)
        tags.append(tag)
        page.parents.append(parent)
        page.depths.append(page.depths[parent] + 1)
        hint, soft = _hint(m[3]) if "=" in m[3] else (0, False)
        page.hints.append(hint)
        if hint >= 2 and soft:
            weak.append(own)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = end.end() if end else n
        elif tag not in VOID and not _SLASH.search(m[3]):
            stack.append(own)
            opened[tag] += 1
    pieces.append((-1, ""))
    _settle(page, weak)
    return page


def _settle(page: Page, weak: list[int]) -> None:
    """What the finished tree tells: which elements are never text, and which weak words stand at running text.

    A form that holds the main element or most of the text is the page's frame, and only its labels and controls
    go; the footer of a quotation names its source.
    """
    n, parents, tags = len(page.tags), page.parents, page.tags
    own = [0] * n
    for e, text in page.pieces:
        if e >= 0:
            own[e] += len(text.strip())
    # Text of an element with the elements in its lines, and with everything inside it.
    line, total, holds = own[:], own[:], [t in ("article", "main") for t in tags]
    hidden = [t in NEVER and t != "form" for t in tags]
    for e in range(1, n):
        hidden[e] = hidden[e] or hidden[parents[e]]
    for e in range(n - 1, 0, -1):
        if hidden[e]:
            continue
        if tags[e] not in BLOCKS:
            line[parents[e]] += line[e]
        total[parents[e]] += total[e]
        holds[parents[e]] = holds[parents[e]] or holds[e]
    for e in weak:
        if line[e] >= RUNNING:
            page.hints[e] -= 2
    frame, quoted, never = [False] * n, [False] * n, [False] * n
    for e in range(1, n):
        p, tag = parents[e], tags[e]
        frame[e] = frame[p] or (tag == "form" and (holds[e] or total[e] * 2 > total[0]))
        quoted[e] = quoted[p] or tag == "blockquote"
        own_never = tag in NEVER and not (tag == "form" and frame[e]) and not (tag == "footer" and quoted[e])
        never[e] = never[p] or own_never or (frame[e] and tag == "label")
    page.never[:] = never


def _close_implied(tags: list[str], stack: list[int], tag: str, opened: Counter, close: Callable[[int], None]) -> None:
    """Close what the start of block ``tag`` ends by itself."""
    ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "body": ("head",)}.get(tag, ())
    walls = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}.get(tag, ())
    if tag in CLOSES_P and opened["p"] > 0:
        for depth in range(len(stack) - 1, 0, -1):
            if tags[stack[depth]] == "p":
                close(depth)
                break
            if tags[stack[depth]] in BLOCKS:
                break
    if any(opened[x] > 0 for x in ends):
        for depth in range(len(stack) - 1, 0, -1):
            if tags[stack[depth]] in walls:
                break
            if tags[stack[depth]] in ends:
                close(depth)
                if tag != "tr":
                    break


def element_features(page: Page, hide: int = -1) -> np.ndarray:
    """One column index per feature for every element; ``hide``: an element shown as a plain ``div``."""
    n = len(page.tags)
    own, link = [0] * n, [0] * n
    for e, text in page.pieces:
        if e >= 0 and not page.never[e]:
            own[e] += len(text.strip())
    total = own[:]
    for e in range(n - 1, 0, -1):
        p = page.parents[e]
        if page.tags[e] == "a":
            link[e] = total[e]
        total[p] += total[e]
        link[p] += link[e]
    everything = max(total[0], 1)
    out = np.empty((n, len(WIDTHS)), np.int64)
    for e in range(n):
        tag = "div" if e == hide else page.tags[e]
        t, p = total[e], page.parents[e]
        out[e, 0] = _TAG_ID.get(tag, 0) if not page.never[e] else len(TAGS) + 1
        out[e, 1] = 0 if e == hide else page.hints[e]
        out[e, 2] = 0 if t == 0 else 1 if t < 25 else 2 if t < 80 else 3 if t < 300 else 4
        out[e, 3] = 0 if t == 0 else min(3, 1 + int(link[e] * 3 / t)) if link[e] else 0
        out[e, 4] = min(3, int(4 * t / everything))
        out[e, 5] = 0 if p <= 0 or not total[p] else 1 if own[p] * 2 > total[p] else 2
    return out + np.array(OFFSETS[:-1])


@dataclass
class Weights:
    own: np.ndarray  # (features, 2)
    edge: np.ndarray  # (kinds of child, parent's state, child's state)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def edge_kinds(features: np.ndarray, parents: np.ndarray, depths: np.ndarray) -> np.ndarray:
    tag = features[:, 0] - OFFSETS[0]
    inside = ~np.isin(tag[parents], [_TAG_ID["html"], _TAG_ID["body"]]) & (depths[parents] > 0)
    return tag + (len(TAGS) + 2) * inside


def infer(features: np.ndarray, parents: np.ndarray, depths: np.ndarray, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of elements (n, 2) and edges (n, 2, 2) by sum-product, level by level over many trees at once."""
    n = len(parents)
    unary = weights.own[features].sum(axis=1)
    pair = weights.edge[edge_kinds(features, parents, depths)]
    order = np.argsort(depths, kind="stable")
    cuts = np.searchsorted(depths[order], np.arange(depths.max() + 2))
    levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    belief = unary.copy()  # own potential and the messages from the children
    up = np.zeros((n, 2))
    for rows in reversed(levels[1:]):
        up[rows] = _logsum(pair[rows] + belief[rows][:, None, :], 2)
        np.add.at(belief, parents[rows], up[rows])
    total = belief.copy()  # with the message from the parent too
    edges = np.zeros((n, 2, 2))
    for rows in levels[1:]:
        above = total[parents[rows]] - up[rows]
        joint = above[:, :, None] + pair[rows] + belief[rows][:, None, :]
        edges[rows] = joint
        total[rows] = belief[rows] + _logsum(above[:, :, None] + pair[rows], 1)
    marginal = np.exp(total - _logsum(total, 1)[:, None])
    flat = edges.reshape(n, 4)
    edges = np.exp(flat - _logsum(flat, 1)[:, None]).reshape(n, 2, 2)
    return marginal, edges


def _forest(pages: list[Page], hidden: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, parents and depths of all elements of ``pages``, numbered through."""
    features = [element_features(p, hidden[i] if hidden else -1) for i, p in enumerate(pages)]
    starts = np.cumsum([0, *[len(p.tags) for p in pages]])
    parents = np.concatenate([np.maximum(np.array(p.parents), 0) + s for p, s in zip(pages, starts[:-1], strict=True)])
    return np.concatenate(features), parents, np.concatenate([np.array(p.depths) for p in pages])


def self_labels(page: Page) -> tuple[int, np.ndarray] | None:
    """(main element, labels) if the page has exactly one ``article``, or else exactly one ``main``."""
    for name in ("article", "main"):
        found = [e for e, t in enumerate(page.tags) if t == name]
        if len(found) == 1:
            labels = np.zeros(len(page.tags), np.int64)
            labels[found[0]] = 1
            for e in range(found[0] + 1, len(page.tags)):
                labels[e] = labels[page.parents[e]] and not page.never[e] and page.hints[e] != 2
            return found[0], labels
    return None


_PHRASE = re.compile(r">([^<>]{15,300})<")
_FRAMES = (
    '<div class="{w}"><h3>{a}</h3><p>{b}</p><p>{a}</p></div>', '<section id="{w}"><h2>{a}</h2><div><p>{b}</p></div></section>',
    '<div class="{w}">{b}</div>', '<div id="{w}"><ul><li>{a}</li><li>{b}</li></ul></div>', '<p class="{w}">{a}</p>',
)
_SITE_HEADERS = ('<header><h1>{a}</h1><p>{b}</p></header>', '<header><h1>{a}</h1></header>', '<div class="{w}"><h1>{a}</h1></div>')
_RETAG = ("li", "blockquote", "div", "h2", "dd", "section", "pre", "td")


def vary(source: str, rng: np.random.Generator) -> str:
    """``source`` with other paragraph tags and with boilerplate put around and into its main element."""
    phrases = _PHRASE.findall(source) or ["more from this site"]

    def words() -> dict[str, str]:
        a, b = (phrases[int(i)] for i in rng.integers(0, len(phrases), 2))
        return {"a": a[:60], "b": b, "w": _BAD_LIST[int(rng.integers(0, len(_BAD_LIST)))]}

    def frame() -> str:
        return _FRAMES[int(rng.integers(0, len(_FRAMES)))].format(**words())

    opening, closing = re.search(r"(?i)<(article|main)[\s>]", source), re.search(r"(?i)</(article|main)\s*>", source)
    if opening is None or closing is None:
        return source
    before, inside, after = source[: opening.start()], source[opening.start() : closing.start()], source[closing.start() :]
    tag = _RETAG[int(rng.integers(0, len(_RETAG)))]
    inside = re.sub(r"<(/?)p>", lambda m: f"<{m[1]}{tag}>" if rng.random() < 0.3 else m[0], inside)
    head = _SITE_HEADERS[int(rng.integers(0, 3))].format(**words()) if rng.random() < 0.7 else ""
    end = closing.end() - closing.start()
    return before + head + frame() + inside + frame() + after[:end] + frame() + after[end:]


def without_element(page: Page, labels: np.ndarray, gone: int) -> tuple[Page, np.ndarray]:
    """``page`` with element ``gone`` taken out and its children given to its parent."""
    at = [e - (e > gone) for e in range(len(page.tags))]
    up = page.parents[gone]
    at[gone] = at[up]
    below = {gone}
    out = Page([], [], [], [], [], [(e if e < 0 else at[e], t) for e, t in page.pieces])
    for e, tag in enumerate(page.tags):
        p = page.parents[e]
        if p in below:
            below.add(e)
        if e == gone:
            continue
        out.tags.append(tag)
        out.parents.append(-1 if p < 0 else at[p])
        out.depths.append(page.depths[e] - (e in below))
        out.hints.append(page.hints[e])
        out.never.append(page.never[e])
    return out, np.delete(labels, gone)


def training_trees(sources: list[str]) -> tuple[list[Page], list[int], list[np.ndarray]]:
    """Trees, the element to hide in each (or -1), and labels: each self-labelled page as it is and varied."""
    rng = np.random.default_rng(13)
    trees, hidden, labels = [], [], []
    for i, source in enumerate(sources):
        for varied in (False, True):
            page = parse(vary(source, rng) if varied else source)
            known = self_labels(page)
            if known is None:
                continue
            main, own = known
            if i % 3 == 2:
                page, own = without_element(page, own, main)
                main = -1
            trees.append(page)
            hidden.append(main if i % 3 == 1 else -1)
            labels.append(own)
    return trees, hidden, labels


def train(sources: list[str]) -> Weights:
    """Weights from the self-labelled ones among ``sources``; with none, weights that state the plain rules."""
    weights = Weights(np.zeros((OFFSETS[-1], 2)), np.zeros((EDGE_KINDS, 2, 2)))
    # Where no page tells otherwise: menus, forms and bad words are not content, text is.
    prior = np.zeros(OFFSETS[-1])
    prior[OFFSETS[0] + len(TAGS) + 1] = -6.0
    prior[[OFFSETS[0] + _TAG_ID[t] for t in ("article", "main")]] = 3.0
    prior[[OFFSETS[0] + _TAG_ID[t] for t in ("html", "body", "header")]] = -3.0
    prior[OFFSETS[1] : OFFSETS[1] + 4] = (0.0, 2.0, -4.0, -1.0)
    prior[OFFSETS[2] : OFFSETS[2] + 5] = (-0.5, -0.3, 0.2, 0.6, 1.0)
    prior[OFFSETS[3] : OFFSETS[3] + 4] = (0.3, 0.0, -1.0, -2.0)
    weights.own[:, 1] = prior
    weights.edge[:, 1, 1], weights.edge[:, 1, 0], weights.edge[:, 0, 1] = 1.0, -1.0, -0.5
    trees, hidden, known = training_trees(sources)
    if not trees:
        return weights
    features, parents, depths = _forest(trees, hidden)
    labels = np.concatenate(known)
    kinds = edge_kinds(features, parents, depths)
    inner = np.flatnonzero(depths > 0)
    own0, edge0 = weights.own.copy(), weights.edge.copy()
    seen = np.zeros_like(weights.own)
    np.add.at(seen, (features.ravel(), np.repeat(labels, features.shape[1])), 1.0)
    seen_edges = np.zeros_like(weights.edge)
    np.add.at(seen_edges, (kinds[inner], labels[parents[inner]], labels[inner]), 1.0)
    sums = [np.zeros_like(weights.own), np.zeros_like(weights.edge)]
    for _ in range(STEPS):
        marginal, edges = infer(features, parents, depths, weights)
        expected = np.zeros_like(weights.own)
        np.add.at(expected, features.ravel(), np.repeat(marginal, features.shape[1], axis=0))
        expected_edges = np.zeros_like(weights.edge)
        np.add.at(expected_edges, kinds[inner], edges[inner])
        grads = [(seen - expected) - PULL * (weights.own - own0), (seen_edges - expected_edges) - PULL * (weights.edge - edge0)]
        for i, (w, g) in enumerate(zip((weights.own, weights.edge), grads, strict=True)):  # Adagrad
            sums[i] += g * g
            w += 0.5 * g / np.sqrt(sums[i] + 1e-8)
    return weights


def _blocks(page: Page, keep: np.ndarray) -> str:
    """Kept text in page order, white space inside a block as one space, blocks joined by a line feed."""
    out: list[str] = []
    block: list[str] = []
    for e, text in page.pieces:
        if e == -1:
            if block:
                line = " ".join(html_module.unescape("".join(block)).split())
                if line:
                    out.append(line)
                block = []
        elif e == -2:
            block.append(" ")
        elif keep[e]:
            block.append(text)
    return "\n".join(out)


def extract(sources: list[str], weights: Weights) -> list[str]:
    """The main text of each of ``sources``."""
    pages = [parse(s) for s in sources]
    if not pages:
        return []
    marginal, _ = infer(*_forest(pages), weights)
    texts, at = [], 0
    for page in pages:
        n = len(page.tags)
        keep = (marginal[at : at + n, 1] > 0.5) & ~np.array(page.never)
        if n == 1:  # no element at all: plain text
            keep[0] = True
        texts.append(_blocks(page, keep))
        at += n
    return texts


def _portions(sources: list[str], pages: int = 64, characters: int = 1 << 20) -> Iterator[list[str]]:
    """``sources`` in order, at most ``pages`` and, but for single long ones, ``characters`` at once."""
    some: list[str] = []
    for source in sources:
        if some and (len(some) == pages or sum(map(len, some)) + len(source) > characters):
            yield some
            some = []
        some.append(source)
    if some:
        yield some


def _extractor(weights: Weights):
    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sources in batches:
            whole = [s or "" for s in sources]
            texts: list[str] = []
            for some in _portions(whole):  # few trees at once keep memory small
                texts += extract(some, weights)
            yield pd.Series(texts, dtype="object")

    return main_text


def labelled_sample(pages: DataFrame, html: str = "html", rows: int = TRAINING_PAGES) -> list[str]:
    """At most ``rows`` different pages with an ``article`` or ``main`` element, the first by a hash of the page."""
    source = pages.select(F.col(html).alias("html")).where(F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
    # Very long pages would make the driver's part of learning unbounded; scoring has no such limit.
    source = source.where(F.length("html") <= 200_000).select("html", F.xxhash64("html").alias("h"))
    first = F.broadcast(source.select("h").distinct().orderBy("h").limit(rows))  # ``rows`` rows at most
    picked = source.join(first, "h", "left_semi").groupBy("h").agg(F.min("html").alias("html"))
    return [r["html"] for r in picked.orderBy("h").collect()]


def main_texts(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", weights: Weights | None = None
) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per row of ``pages``; null html gives an empty text.

    Menus, sidebars, footers, forms, scripts and styles (by their own tags) are never
    part of the text, but for a form around most of the page and a quotation's footer; everything else is decided by the model, learned from
    ``pages`` unless ``weights`` are given.
    """
    model = weights or train(labelled_sample(pages, html))
    text = _extractor(model)(F.coalesce(F.col(html), F.lit("")))
    out = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
