"""Operator 12: the main text of HTML pages, by a tree-structured graphical model.

A page becomes a tree of its block elements and of the text blocks between them. Every node is
either content or not. A node's own potential comes from its tag, the words of its class and id
and, for a text block, from its length, links and punctuation; a potential between parent and
child says how well their states go together for a child of that kind. Sum-product messages,
first up and then down the tree, give each node's exact marginal; text blocks that are content
more likely than not are the page's text.

The potentials are fitted to labelled pages by gradient ascent on the exact likelihood, which the
same messages give, with a Gaussian prior around plain expectations (a menu is not content, a
text block goes with its parent), so that what no labelled page shows keeps a sensible value.
Pages that mark their article label themselves. Each is learned from twice, once with the marks
taken off, so that pages without marks are read by what else they show.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import map_texts

# Labelled pages the model is fitted to, and the nodes a page may have to be among them. These
# bound what reaches the driver; extraction itself covers every page and node.
TRAINING_PAGES = 200
TRAINING_NODES = 2000
ITERATIONS = 100
STEP = 0.1
# Inverse variance of the prior, counted in labelled nodes.
PRIOR_WEIGHT = 2.0

# How HTML names its elements.
BLOCKS = set(
    "html head body title article aside section main nav header footer address hgroup h1 h2 h3 h4 h5 h6 "
    "p div pre blockquote center ul ol dl li dt dd menu figure figcaption table caption thead tbody tfoot "
    "tr td th form fieldset legend button select option optgroup textarea label details summary dialog "
    "noscript template script style iframe object svg math canvas video audio hr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp svg math template".split())
CLOSES_P = set(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# An element closes an open one of these kinds, up to a boundary of those.
SAME_KIND = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}

MAIN = ("article", "main")
NOT_SHOWN = {"head", "title", "script", "style", "template", "noscript", "iframe", "object", "svg", "math", "canvas", "video", "audio"}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "button", "select", "option", "optgroup", "textarea", "fieldset", "legend", "label", "dialog"}

# Words of classes and ids, by what they name.
NAMES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toolbar tabs pagination pager skip toc",
    "head": "header masthead topbar banner logo branding",
    "foot": "footer foot copyright colophon legal bottom",
    "side": "sidebar side aside rail widget widgets secondary",
    "advert": "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promoted promotion",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe paywall disclaimer",
    "comments": "comment comments disqus reply replies respond discussion responses feedback commentlist",
    "share": "share sharing social related recommended recommendations trending popular tags more",
    "form": "form login signin signup search register captcha",
    "content": "content article post entry story text maintext main body",
}
GROUP_OF = {word: i for i, words in enumerate(NAMES.values()) for word in words.split()}
CONTENT_NAME = list(NAMES).index("content")

TAGS = ["text", "other", *sorted(BLOCKS)]
TAG_ID = {tag: i for i, tag in enumerate(TAGS)}
LENGTHS, LINKS = 12, 4
# Features of a node: its tag, the groups its names fall in, whether it is hidden, and what a text
# block looks like.
NAME_AT = len(TAGS)
HIDDEN_AT = NAME_AT + len(NAMES)
LENGTH_AT = HIDDEN_AT + 1
LINK_AT = LENGTH_AT + LENGTHS
STOP_AT = LINK_AT + LINKS
RIGHTS_AT = STOP_AT + 1
N_FEATURES = RIGHTS_AT + 1
# Kinds of children for the potential between parent and child.
KINDS = ("text", "item", "box", "main", "furniture")
KIND_OF = np.array(
    [
        0
        if tag == "text"
        else 3
        if tag in MAIN
        else 4
        if tag in FURNITURE | NOT_SHOWN | {"header"}
        else 2
        if tag in {"html", "body", "div", "section", "other", "center", "table", "tbody", "tr", "details"}
        else 1
        for tag in TAGS
    ]
)

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)|<!--|<[!?/]")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']*)))?")
_WORDS = re.compile(r"[a-z]+")
_SPLIT_NAMES = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RIGHTS = re.compile(r"©|all rights reserved", re.I)
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}


@dataclass
class Page:
    """Nodes of a page in page order; node 0 is the root. ``blocks`` has a text for text nodes."""

    parent: list[int]
    depth: list[int]
    tag: list[int]
    features: list[list[int]]
    blocks: list[str | None]


def _tag_end(page: str, at: int, unclosed: set[str]) -> tuple[int, str]:
    """(end, attributes) of the tag whose name ends at ``at``; quoted values may hold '>'."""
    end = page.find(">", at)
    if end < 0:
        return len(page), ""
    place = at
    while True:
        quotes = [q for q in (page.find(m, place, end) for m in "\"'") if q >= 0]
        if not quotes:
            return end + 1, page[at:end]
        opening = min(quotes)
        mark = page[opening]
        before = page[at:opening].rstrip()
        if not before.endswith("="):  # a quote that opens no value
            place = opening + 1
            continue
        closing = -1 if mark in unclosed else page.find(mark, opening + 1)
        if closing < 0:
            unclosed.add(mark)
            return end + 1, page[at:end]
        place = closing + 1
        if closing > end:
            end = page.find(">", closing)
            if end < 0:
                return len(page), page[at:]


def _names(attributes: str) -> tuple[set[int], bool]:
    """Groups of the words in class, id and role, and whether the element is hidden."""
    groups: set[int] = set()
    hidden = False
    for found in _ATTRIBUTE.finditer(attributes):
        name = found.group(1).lower()
        value = next((v for v in found.groups()[1:] if v is not None), "")
        if name in ("class", "id", "role"):
            for word in _WORDS.findall(_SPLIT_NAMES.sub(" ", value).lower()):
                if word in GROUP_OF:
                    groups.add(GROUP_OF[word])
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            hidden = True
    return groups, hidden


def parse(page: str) -> Page:
    """The tree of block elements and text blocks of a page, however badly nested it is."""
    tree = Page([-1], [0], [TAG_ID["html"]], [[TAG_ID["html"]]], [None])
    stack, open_tags = [(0, "html")], {"html": 1}
    pieces: list[str] = []
    linked = 0
    links_open = 0
    unclosed: set[str] = set()

    def flush():
        nonlocal linked
        words = html.unescape("".join(pieces)).split() if pieces else None
        pieces.clear()
        in_links, linked = linked, 0
        if not words:
            return
        block = " ".join(words)
        size = len(block)
        share = in_links / size
        link = 0 if share == 0 else 1 if share < 0.5 else 2 if share < 0.9 else 3
        features = [
            TAG_ID["text"],
            LENGTH_AT + min(size.bit_length(), LENGTHS - 1),
            LINK_AT + link,
        ]
        if block[-1] in ".!?…。":
            features.append(STOP_AT)
        if _RIGHTS.search(block):
            features.append(RIGHTS_AT)
        add(TAG_ID["text"], features, block)

    def add(tag: int, features: list[int], block: str | None) -> int:
        above = stack[-1][0]
        tree.parent.append(above)
        tree.depth.append(tree.depth[above] + 1)
        tree.tag.append(tag)
        tree.features.append(features)
        tree.blocks.append(block)
        return len(tree.parent) - 1

    def close(kinds, boundary=()):
        """Close the innermost open element of the kinds, and all inside it."""
        if not any(open_tags.get(k) for k in kinds):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][1] in kinds:
                for _, tag in stack[i:]:
                    open_tags[tag] -= 1
                del stack[i:]
                return
            if stack[i][1] in boundary:
                return

    at, n = 0, len(page)
    while at < n:
        found = _TAG.search(page, at)
        text_end = found.start() if found else n
        if text_end > at:
            pieces.append(page[at:text_end])
            if links_open:
                linked += text_end - at
        if not found:
            break
        name = found.group(2)
        if name is None:
            if found.group() == "<!--":
                end = page.find("-->", found.end() - 2 if page[found.end() : found.end() + 1] == ">" else found.end())
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", found.end())
                at = n if end < 0 else end + 1
            continue
        name = name.lower()
        at, attributes = _tag_end(page, found.end(), unclosed)
        closing = bool(found.group(1))
        if name == "a":
            links_open = 0 if closing else 1
            continue
        if name == "br" or name == "hr" or name == "img" or name == "input" or name == "wbr":
            if name == "hr":
                flush()
                close({"p"}, {"table", "td", "th", "button"})
            elif name != "wbr":
                pieces.append(" ")
            continue
        if name not in BLOCKS:
            continue
        flush()
        if closing:
            if name in HEADINGS:
                close(HEADINGS, {"table", "td", "th"})
            elif name not in ("html", "body"):
                close({name}, () if name in ("table", "td", "th") else {"table"} if name in ("tr", "tbody", "thead", "tfoot") else {"td", "th"})
            links_open = 0
            continue
        if name in CLOSES_P:
            close({"p"}, {"table", "td", "th", "button"})
        if name in HEADINGS and stack[-1][1] in HEADINGS:
            close(HEADINGS)
        if name in SAME_KIND:
            close(*SAME_KIND[name])
        if name == "body":
            close({"head"})
        if name == "html" or name in VOID:
            continue
        groups, hidden = _names(attributes) if attributes else (set(), False)
        features = [TAG_ID[name], *[NAME_AT + g for g in sorted(groups)]] + [HIDDEN_AT] * hidden
        node = add(TAG_ID[name], features, None)
        if name in RAW:
            end = _RAW_ENDS[name].search(page, at)
            at = end.end() if end else n
            continue
        if not attributes.rstrip().endswith("/") or name not in ("p", "div"):
            stack.append((node, name))
            open_tags[name] = open_tags.get(name, 0) + 1
        links_open = 0
    flush()
    return tree


@dataclass
class Model:
    """Log potentials: ``own`` of content for each feature, ``pair[kind, parent, child]``."""

    own: np.ndarray
    pair: np.ndarray


def prior() -> Model:
    """What a page's furniture and its text are taken for before any page is seen."""
    own = np.zeros(N_FEATURES)
    for tag in NOT_SHOWN:
        own[TAG_ID[tag]] = -9.0
    for tag in FURNITURE:
        own[TAG_ID[tag]] = -5.0
    own[TAG_ID["header"]] = -2.5
    own[TAG_ID["address"]] = -1.0
    for tag in MAIN:
        own[TAG_ID[tag]] = 4.0
    for i, name in enumerate(NAMES):
        own[NAME_AT + i] = 1.5 if name == "content" else -5.0
    own[HIDDEN_AT] = -6.0
    for i in range(LENGTHS):
        own[LENGTH_AT + i] = (i - 6) * 0.3
    own[LINK_AT : LINK_AT + LINKS] = [0.5, 0.0, -1.0, -1.5]
    own[STOP_AT], own[RIGHTS_AT] = 0.5, -2.0
    # Rows: state of the parent, columns: of the child. Inside what is not content hardly
    # anything is, but a box may hold both.
    pair = np.zeros((len(KINDS), 2, 2))
    pair[:] = [[1.5, -1.5], [-1.5, 1.5]]
    pair[KINDS.index("box")] = [[1.0, -1.0], [-1.0, 1.0]]
    pair[KINDS.index("main")] = [[0.0, 0.0], [0.0, 1.0]]
    pair[KINDS.index("furniture")] = [[1.0, -1.5], [0.0, 0.0]]
    return Model(own, pair)


@dataclass
class Forest:
    """Nodes of many pages: parents point into the same arrays, roots at -1."""

    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    node: np.ndarray  # of each (node, feature) entry
    feature: np.ndarray


def forest(pages: list[Page]) -> Forest:
    sizes = [len(p.parent) for p in pages]
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    parent = np.array([x for p in pages for x in p.parent], np.int64)
    offset = np.repeat(starts[:-1], sizes)
    parent = np.where(parent < 0, -1, parent + offset)
    counts = [len(f) for p in pages for f in p.features]
    return Forest(
        parent,
        np.array([x for p in pages for x in p.depth], np.int64),
        KIND_OF[np.array([x for p in pages for x in p.tag], np.int64)],
        np.repeat(np.arange(len(parent)), counts),
        np.array([f for p in pages for fs in p.features for f in fs], np.int64),
    )


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(trees: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of each node, and for each node that has a parent P(parent state, own state).

    One pass of messages from the leaves to the roots and one back, a level of all trees at a time.
    """
    n = len(trees.parent)
    own = np.zeros((n, 2))
    own[:, 1] = np.bincount(trees.node, model.own[trees.feature], n)
    order = np.argsort(trees.depth, kind="stable")
    bounds = np.searchsorted(trees.depth[order], np.arange(int(trees.depth.max(initial=0)) + 2))
    levels = [order[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    below, up, down = np.zeros((n, 2)), np.zeros((n, 2)), np.zeros((n, 2))
    for nodes in reversed(levels[1:]):
        sent = _log_sum(model.pair[trees.kind[nodes]] + (own[nodes] + below[nodes])[:, None, :], 2)
        up[nodes] = sent - sent.max(axis=1, keepdims=True)
        for state in (0, 1):
            np.add.at(below[:, state], trees.parent[nodes], up[nodes, state])
    joint = np.zeros((n, 2, 2))
    for nodes in levels[1:]:
        above = trees.parent[nodes]
        outside = own[above] + below[above] + down[above] - up[nodes]
        outside -= outside.max(axis=1, keepdims=True)
        both = model.pair[trees.kind[nodes]] + outside[:, :, None]
        down[nodes] = _log_sum(both, 1)
        both = both + (own[nodes] + below[nodes])[:, None, :]
        both = np.exp(both - both.max(axis=(1, 2), keepdims=True))
        joint[nodes] = both / both.sum(axis=(1, 2), keepdims=True)
    belief = own + below + down
    difference = np.clip(belief[:, 1] - belief[:, 0], -500, 500)
    return 1 / (1 + np.exp(-difference)), joint


def self_labels(page: Page) -> list[int] | None:
    """States of a page that marks its article, else None.

    Text inside its one article (or main) element is content, but for furniture in it; an
    element is where at least half of its text is.
    """
    marked = [i for i, tag in enumerate(page.tag) if TAGS[tag] in MAIN]
    outer = [i for i in marked if page.parent[i] not in marked]
    if len(outer) != 1:
        return None
    inside = [False] * len(page.parent)
    for i in range(1, len(page.parent)):
        above = page.parent[i]
        own_names = {f - NAME_AT for f in page.features[i] if NAME_AT <= f < HIDDEN_AT}
        furniture = (
            TAGS[page.tag[i]] in FURNITURE | NOT_SHOWN
            or bool(own_names - {CONTENT_NAME})
            or HIDDEN_AT in page.features[i]
        )
        inside[i] = (i == outer[0] or inside[above]) and not furniture
    good, total = [0] * len(page.parent), [0] * len(page.parent)
    for i in range(len(page.parent) - 1, -1, -1):
        if page.blocks[i] is not None:
            total[i] = len(page.blocks[i])
            good[i] = total[i] if inside[i] else 0
        if i:
            good[page.parent[i]] += good[i]
            total[page.parent[i]] += total[i]
    if not good[0]:
        return None
    return [int(t > 0 and 2 * g >= t) for g, t in zip(good, total, strict=True)]


def unmarked(page: Page) -> Page:
    """The page with its marks of an article taken off."""
    box, marks = TAG_ID["div"], {TAG_ID[m] for m in MAIN}
    features = [
        [box if f in marks else f for f in fs if f != NAME_AT + CONTENT_NAME] for fs in page.features
    ]
    return Page(page.parent, page.depth, [box if t in marks else t for t in page.tag], features, page.blocks)


def fit(trees: Forest, states: np.ndarray, iterations: int = ITERATIONS) -> Model:
    """Potentials of the greatest posterior, by gradient steps of adaptive size (Adam)."""
    start = prior()
    values = np.concatenate([start.own, start.pair.ravel()])
    centre, first, second = values.copy(), np.zeros_like(values), np.zeros_like(values)
    child = np.flatnonzero(trees.parent >= 0)

    def shaped(v):
        return Model(v[:N_FEATURES], v[N_FEATURES:].reshape(len(KINDS), 2, 2))

    seen_own = np.bincount(trees.feature, states[trees.node].astype(float), N_FEATURES)
    seen_pair = np.zeros((len(KINDS), 2, 2))
    np.add.at(seen_pair, (trees.kind[child], states[trees.parent[child]], states[child]), 1.0)
    for step in range(1, iterations + 1):
        content, joint = marginals(trees, shaped(values))
        own = seen_own - np.bincount(trees.feature, content[trees.node], N_FEATURES)
        pair = seen_pair.copy()
        np.subtract.at(pair, trees.kind[child], joint[child])
        slope = np.concatenate([own, pair.ravel()]) - PRIOR_WEIGHT * (values - centre)
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        values = values + STEP * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return shaped(values)


def _decoded(text: bytes | None) -> str:
    return (text or b"").decode("utf-8", "replace")


def _make_examples():
    def call(texts):
        out = {"parent": [], "depth": [], "tag": [], "feature_counts": [], "features": [], "states": []}
        for text in texts:
            page = parse(_decoded(text))
            states = self_labels(page) if len(page.parent) <= TRAINING_NODES else None
            for name in out:
                out[name].append(None)
            if states is not None:
                out["parent"][-1], out["depth"][-1], out["tag"][-1] = page.parent, page.depth, page.tag
                out["feature_counts"][-1] = [len(f) for f in page.features]
                out["features"][-1] = [f for fs in page.features for f in fs]
                out["states"][-1] = states
        return out

    return call


def fit_model(pages: DataFrame, *, text: str = "html", limit: int = TRAINING_PAGES) -> Model:
    """A model fitted to at most ``limit`` pages that mark their article, picked by a hash.

    Only the features and states of their nodes reach the driver. With no such page the model is
    the prior.
    """
    marked = (
        pages.select(F.col(text).alias("body"), F.xxhash64(text).alias("hash"))
        .where(F.col("body").rlike("(?i)<(article|main)[\\s>]"))
    )
    least = marked.select("hash").orderBy("hash").limit(limit).agg(F.max("hash").alias("last")).first()["last"]
    if least is None:
        return prior()
    fields = ", ".join(
        f"{name} array<int>" for name in ("parent", "depth", "tag", "feature_counts", "features", "states")
    )
    # Pages stay where they are: the hashes pick them, and only what they show is gathered.
    examples = map_texts(marked.where(F.col("hash") <= least), _make_examples, fields, text="body", keep=("hash",))
    rows = examples.where("states is not null").orderBy("hash").limit(limit).collect()
    shown, states = [], []
    for row in rows:
        ends = np.cumsum(row["feature_counts"])
        features = [f.tolist() for f in np.split(np.array(row["features"]), ends[:-1])]
        page = Page(row["parent"], row["depth"], row["tag"], features, [None] * len(row["parent"]))
        for seen in (page, unmarked(page)):
            shown.append(seen)
            states += row["states"]
    return fit(forest(shown), np.array(states, np.int64)) if shown else prior()


def extract(texts: list[bytes | None], model: Model) -> list[str]:
    """The main text of each page, its blocks in page order with an empty line between."""
    pages = [parse(_decoded(t)) for t in texts]
    if not pages:
        return []
    content, _ = marginals(forest(pages), model)
    out, at = [], 0
    for page in pages:
        likely = content[at : at + len(page.parent)]
        at += len(page.parent)
        out.append("\n\n".join(b for b, p in zip(page.blocks, likely, strict=True) if b is not None and p > 0.5))
    return out


def extract_text(
    pages: DataFrame,
    model: Model,
    *,
    keep: tuple[str, ...] = ("page_id", "url"),
    text: str = "html",
    name: str = "text",
) -> DataFrame:
    """The columns ``keep`` of each row, its main text as ``name``, and ``n_chars`` code points.

    A null or empty page, and one with no content, has an empty text. Every row is read by itself
    and whole, however long, so repeated rows and ids, null ids and further columns change
    nothing; kept columns may have any names but the results'.
    """
    fitted = (model.own, model.pair)

    def make():
        own = Model(*fitted)

        def call(texts):
            return {"extracted": extract(texts, own)}

        return call

    hidden = tuple(f"c{i}" for i in range(len(keep)))
    source = pages.select(*[F.col(c).alias(h) for c, h in zip(keep, hidden, strict=True)], F.col(text).alias("body"))
    found = map_texts(source, make, "extracted string", text="body", keep=hidden)
    return found.select(
        *[F.col(h).alias(c) for c, h in zip(keep, hidden, strict=True)],
        F.col("extracted").alias(name),
        F.char_length("extracted").cast("long").alias("n_chars"),
    )
