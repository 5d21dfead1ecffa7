"""HTML extraction by wrapper induction.

Of every host up to `SAMPLE` different pages are taken (smallest hashes of their html). Their DOM trees are
aligned by simple tree matching: two nodes match if their tag, class and id agree, and the children of matched
nodes are matched in order so that most nodes match. Text that is the same at one place of all
sampled pages is template, if the text of its whole block is; places whose text varies are slots. Pages that agree in most of their text are copies,
which tell nothing about the template, so only one of them is used.

A page is extracted by matching it with its host's wrapper: what matches template text is dropped, the rest is
content, unless it stands in an element that by its tag, role, class or id is a menu, header, footer, sidebar,
notice, advert, form, script or the comments of readers, or is a list or block made of links. If the page
marks its article or main part, only that counts.

Sampling shuffles hosts and hashes only; a wrapper is induced from at most `SAMPLE` pages. The wrappers are
broadcast if they are below `BROADCAST_BYTES`, else joined by host. A hot host's pages are never grouped.

Defined results: a null or empty html gives the empty text; a null or odd url belongs to the host ''; null
ids and repeated rows are extracted like any other; an empty table gives an empty result. Only `page_id`, `url` and
`html` are read. Pages are read whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.common import small, written

SAMPLE = 8
# Parts of a host in which its sample is sought first.
PARTS = 16
# From fewer different pages no text is taken for template.
LEAST = 4
BROADCAST_BYTES = 32 << 20
# Lists of children with more pairs are aligned a NumPy row at a time, with the same result.
CELLS = 256
# Alignments of more pairs are kept while two trees are compared, as every level above asks for them.
KEPT = 4096
# Elements nested deeper than this stand beside each other.
DEPTH = 200

# Fixed values of the HTML standard: elements without content, and elements that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
_ENDS_P = BLOCKS - {"br", "td", "th", "tr", "caption", "tbody", "thead", "tfoot", "option", "legend", "li", "dd", "dt", "body", "html"}
# An element that closes open elements of the same kind, up to the element that holds them.
_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements whose content is no text of the page: up to their end tag whatever it holds, and by the element stack.
_RAW = "script|style|noscript|iframe|textarea|title"
HIDDEN = frozenset("svg math object template canvas audio video".split())
# Among them those in which a `/` ends an element, and which an element of HTML ends, but for the places that hold HTML.
FOREIGN = frozenset("svg math".split())
_HOLDS_HTML = frozenset("foreignobject desc annotation-xml".split())
# Elements that never hold the article.
ASIDE = frozenset("nav footer aside form menu button select label input dialog search head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs byline comment comments commentlist "
    "consent cookie cookies disqus disclaimer feedback footer gdpr header login masthead menu message modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup promo promotion related "
    "replies reply responses respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags teaser toc toolbar topbar trending widget".split()
)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'){{0,4096}})>|<({_RAW})(?=[\s/>])[^>]*>|<[!?][^>]*>",
    re.S | re.I,
)
_ENDS_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in _RAW.split("|")}
_DRAWN = re.compile(r"<(?:svg|math)(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


class Node:
    """An element or, without a tag, a text."""

    __slots__ = ("tag", "label", "children", "text", "aside", "block")

    def __init__(self, tag: str, label: str, text: str = "", aside: bool = False):
        self.tag, self.label, self.text, self.aside = tag, label, text, aside
        self.children: list[Node] = []


def parse(html: str) -> Node:
    """The DOM tree of a page: open elements end where the standard lets them end."""
    root = Node("#root", "#root")
    stack, at = [root], 0

    def add_text(piece: str) -> None:
        if piece:
            stack[-1].children.append(Node("", "#text", unescape(piece) if "&" in piece else piece))

    def close(tags: set, within: set) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                del stack[depth:]
                return
            if stack[depth].tag in within or stack[depth].tag in HIDDEN:
                return

    def inside_foreign() -> int:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in FOREIGN:
                return depth
            if stack[depth].tag in _HOLDS_HTML:
                return 0
        return 0

    drawn = _DRAWN.search(html)
    while token := _TOKEN.search(html, at):
        add_text(html[at : token.start()])
        at = token.end()
        tag = (token[2] or token[4] or "").lower()
        if not tag:
            continue
        if token[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].tag == "template":
                    break
            continue
        attributes = token[3] or ""
        closed = attributes.rstrip().endswith("/")
        foreign = inside_foreign() if drawn else 0
        if tag in _ENDS_RAW:
            if not (foreign and closed):
                end = _ENDS_RAW[tag].search(html, at)
                at = end.end() if end else len(html)
            continue
        if foreign and tag in BLOCKS:
            del stack[foreign:]
        if tag in _ENDS_P:
            close({"p"}, {"div", "td", "th", "li", "article", "section", "blockquote", "main", "body", "table"})
        if tag in _SAME:
            tags, within = _SAME[tag]
            while stack[-1].tag not in within and any(n.tag in tags for n in stack[1:]):
                depth = len(stack)
                close(tags, within)
                if len(stack) == depth:
                    break
        name, aside = tag, tag in ASIDE
        if attributes:
            for key, *values in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), "".join(values).lower()
                if key == "role":
                    aside |= value in ROLES
                elif key in ("class", "id"):
                    name += f" {value}"
                    if tag not in ("html", "body", "article", "main"):
                        aside |= any(w in WORDS for w in re.split(r"[^a-z]+", value))
                else:
                    aside |= key == "hidden" or value == "true"
        node = Node(tag, name, aside=aside)
        hidden = tag in HIDDEN
        if not hidden:
            stack[-1].children.append(node)
        if tag not in VOID and not closed and (len(stack) < DEPTH or hidden and stack[-1].tag not in HIDDEN):
            stack.append(node)
    add_text(html[at:])
    return root


def clean(text: str) -> str:
    return " ".join(text.split())


def compact(node: Node) -> Node:
    """The tree without blank texts, each text with its white space folded, for matching."""
    kept = Node(node.tag, node.label, aside=node.aside)
    kept.children = [
        compact(c) if c.tag else Node("", "#text", t) for c in node.children if c.tag or (t := clean(c.text))
    ]
    return kept


def match(a: Node, b: Node, known: dict | None = None) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two nodes with equal labels: matched nodes, and the matched pairs of children.

    `known` keeps large alignments while the nodes of both trees live and those below a and b do not change.
    """
    x, y = a.children, b.children
    if not x or not y:
        return 1, []
    labels = [c.label for c in x]
    if len(set(labels)) == len(x) and labels == [d.label for d in y]:
        return 1 + sum(_size(c, d, known) for c, d in zip(x, y)), [(i, i) for i in range(len(x))]
    if len(x) * len(y) > CELLS:
        if known is None or len(x) * len(y) <= KEPT:
            return _match_long(x, y, known)
        if (id(a), id(b)) not in known:
            known[id(a), id(b)] = _match_long(x, y, known)
        return known[id(a), id(b)]
    width = len(y) + 1
    weight = [[_size(c, d, known) if c.label == d.label else 0 for d in y] for c in x]
    best = [[0] * width for _ in range(len(x) + 1)]
    for i, row in enumerate(weight):
        above, here = best[i], best[i + 1]
        for j, w in enumerate(row):
            here[j + 1] = max(above[j + 1], here[j], above[j] + w)
    pairs, i, j = [], len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return 1 + best[-1][-1], pairs[::-1]


def _shape(node: Node, texts: list[str]) -> tuple | None:
    """The labels of a tree in which no two siblings share one, with its texts added to `texts`; else None.

    Trees of one such shape match node by node.
    """
    if not node.tag:
        texts.append(node.text)
        return (node.label,)
    inner = [_shape(c, texts) for c in node.children]
    if None in inner or len({c.label for c in node.children}) < len(inner):
        return None
    return (node.label, *inner)


def _nodes(node: Node) -> int:
    return 1 + sum(map(_nodes, node.children))


def _match_long(x: list[Node], y: list[Node], known: dict | None) -> tuple[int, list[tuple[int, int]]]:
    """The same alignment of long lists; some rows of it are kept, the others made again on the way back."""
    numbers: dict[str, int] = {}
    groups: dict[str, dict] = {}

    def described(c: Node) -> tuple:
        texts: list[str] = []
        shape = _shape(c, texts)
        return shape, [numbers.setdefault(t, len(numbers)) for t in texts] if shape else []

    for j, d in enumerate(y):
        shape, texts = described(d)
        places, listed = groups.setdefault(d.label, {}).setdefault(shape, ([], []))
        places.append(j)
        listed.append(texts)
    tables = {
        label: {k: (np.array(p), np.array(t, np.int64).reshape(len(p), -1) if k else p) for k, (p, t) in shapes.items()}
        for label, shapes in groups.items()
    }
    own = [(*described(c), _nodes(c)) for c in x]

    def weights(i: int) -> np.ndarray:
        shape, texts, nodes = own[i]
        out = np.zeros(len(y), np.int64)
        for other, (places, listed) in tables.get(x[i].label, {}).items():
            if shape and other == shape:
                out[places] = nodes + 2 * (listed == np.array(texts, np.int64)).sum(1)
            else:
                out[places] = [_size(x[i], y[j], known) for j in places]
        return out

    def below(above: np.ndarray, i: int) -> np.ndarray:
        here = np.zeros_like(above)
        here[1:] = np.maximum.accumulate(np.maximum(above[1:], above[:-1] + weights(i)))
        return here

    step = isqrt(len(x)) + 1
    row = np.zeros(len(y) + 1, np.int64)
    kept = [row]
    for i in range(len(x)):
        row = below(row, i)
        if (i + 1) % step == 0:
            kept.append(row)
    pairs, i, j = [], len(x), len(y)
    while i and j:
        first = (i - 1) // step * step
        block = [kept[first // step]]
        for k in range(first, i):
            block.append(below(block[-1], k))
        while i > first and j:
            here, above = block[i - first], block[i - first - 1]
            if here[j] == above[j]:
                i -= 1
            elif here[j] == here[j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((i, j))
    return 1 + int(row[-1]), pairs[::-1]


def _size(a: Node, b: Node, known: dict | None = None) -> int:
    """Matched nodes of two nodes with equal labels; equal texts count for more than mere texts."""
    if not a.tag:
        return 3 if a.text == b.text else 1
    return match(a, b, known)[0]


def _agreement(a: Node, b: Node, known: dict | None = None) -> int:
    """Characters of text that are the same at matched places."""
    if not a.tag:
        return len(a.text) if a.text == b.text else 0
    known = {} if known is None else known
    return sum(_agreement(a.children[i], b.children[j], known) for i, j in match(a, b, known)[1])


def _length(a: Node) -> int:
    return len(a.text) if not a.tag else sum(map(_length, a.children))


def _confirm(wrapper: Node, page: Node, known: dict | None = None) -> bool:
    """Drop from the wrapper what the page does not have, and blocks whose text differs (slots).

    True if text differs that is part of the block around the node.
    """
    known = {} if known is None else known
    pairs = match(wrapper, page, known)[1]
    texts = sum(not c.tag for c in wrapper.children) + sum(not c.tag for c in page.children)
    kept, varies = [], texts != 2 * sum(not wrapper.children[i].tag for i, _ in pairs)
    for i, j in pairs:
        one, two = wrapper.children[i], page.children[j]
        if one.tag:
            inner = _confirm(one, two, known)
            varies |= inner and _inline(one)
            kept.append(one)
        elif one.text == two.text:
            kept.append(one)
        else:
            varies = True
    wrapper.children = kept
    if varies:
        _empty(wrapper)
    return varies


def _inline(node: Node) -> bool:
    return node.tag not in BLOCKS


def _empty(node: Node) -> None:
    """Take the texts of a block out of the wrapper, those of its inline elements included."""
    node.children = [c for c in node.children if c.tag]
    for c in node.children:
        if _inline(c):
            _empty(c)


def _prune(node: Node) -> bool:
    """Keep only ways to template texts."""
    node.children = [c for c in node.children if not c.tag or _prune(c)]
    return bool(node.children)


def _pack(node: Node):
    return node.text if not node.tag else [node.label, [_pack(c) for c in node.children]]


def _unpack(packed) -> Node:
    if isinstance(packed, str):
        return Node("", "#text", packed)
    node = Node(packed[0].split(" ")[0], packed[0])
    node.children = [_unpack(c) for c in packed[1]]
    return node


def induce(pages: list[str]) -> str:
    """The wrapper of a host: its template texts with the ways to them, as JSON; empty if there is none."""
    trees: list[Node] = []
    for html in pages:
        tree = compact(parse(html))
        size = _length(tree)
        if all(2 * _agreement(t, tree) <= min(size, _length(t)) for t in trees):
            trees.append(tree)
    if len(trees) < LEAST:
        return ""
    wrapper = trees[0]
    for tree in trees[1:]:
        _confirm(wrapper, tree)
    return json.dumps(_pack(wrapper)) if _prune(wrapper) else ""


def _mark(wrapper: Node, view: Node, page: Node, known: dict) -> None:
    """Empty the page's texts that match template texts; `view` is the page as `compact` makes it."""
    places = [k for k, c in enumerate(page.children) if c.tag or clean(c.text)]
    for i, j in match(wrapper, view, known)[1]:
        one, two, real = wrapper.children[i], view.children[j], page.children[places[j]]
        if one.tag:
            _mark(one, two, real, known)
        elif one.text == two.text:
            real.text = " "


def _measure(node: Node) -> tuple[int, int]:
    """Characters of text that count, and those of them inside links."""
    if not node.tag:
        n = len(clean(node.text))
        return n, 0
    if node.aside:
        return 0, 0
    total = linked = 0
    for c in node.children:
        n, k = _measure(c)
        total, linked = total + n, linked + k
    return total, total if node.tag == "a" else linked


def _main(node: Node) -> Node | None:
    """The largest article, else the largest main part, else nothing."""
    found: dict[str, tuple[int, Node]] = {}

    def walk(n: Node) -> None:
        if n.tag in ("article", "main") and not n.aside:
            size = _measure(n)[0]
            if size > found.get(n.tag, (0, n))[0]:
                found[n.tag] = (size, n)
        for c in n.children:
            if c.tag and not c.aside:
                walk(c)

    walk(node)
    best = found.get("article") or found.get("main")
    return best[1] if best else None


def _gather(node: Node, out: list[str], marked: bool) -> None:
    for c in node.children:
        if not c.tag:
            out.append(c.text)
            continue
        if c.aside or (c.tag == "header" and not marked):
            out.append(" ")
            continue
        if not marked and c.tag in ("ul", "ol", "div", "table", "section", "p"):
            total, linked = _measure(c)
            if total and linked > 0.6 * total:
                out.append(" ")
                continue
        border = c.tag in BLOCKS
        if border:
            out.append(" ")
        _gather(c, out, marked)
        if border:
            out.append(" ")


def extract(html: str, wrapper: Node | None = None) -> str:
    """The main text of a page."""
    page = parse(html)
    if wrapper is not None:
        _mark(wrapper, compact(page), page, {})
    main, out = _main(page), []
    _gather(main or page, out, main is not None)
    return clean("".join(out))


def host_of(url: Column) -> Column:
    """The host of a url in lower case, or ''."""
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), pattern, 1))


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of the hosts of `pages` (host, html) that have a template."""
    hashed = pages.where(F.length("html") > 0).select("host", F.xxhash64("html").alias("page"))
    # The smallest hashes of each part of a host first, so that a hot host's pages meet in many tasks.
    picked = hashed.distinct().withColumn("part", F.pmod("page", F.lit(PARTS)))
    for group in (["host", "part"], ["host"]):
        first = Window.partitionBy(*group).orderBy("page")
        picked = picked.withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE).drop("n")
    picked = picked.drop("part")
    picked = small(written(picked, "sample"), BROADCAST_BYTES)
    rows = pages.withColumn("page", F.xxhash64("html")).join(picked, ["host", "page"])
    sample = rows.groupBy("host", "page").agg(F.first("html").alias("html"))

    def of_host(rows: pd.DataFrame) -> pd.DataFrame:
        made = induce(rows.sort_values("page")["html"].tolist())
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [made]})

    # At most SAMPLE pages per host.
    return sample.groupBy("host").applyInPandas(of_host, "host string, wrapper string").where("wrapper <> ''")


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of `pages` (page_id, url, html) the url and the main text."""
    rows = pages.select(
        F.col("page_id"), F.col("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host")
    )
    wrappers = written(induce_wrappers(rows.select("host", "html")), "wrappers")
    joined = rows.join(small(wrappers, BROADCAST_BYTES), "host", "left").select("page_id", "url", "html", "wrapper")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, Node | None] = {None: None}
        for batch in batches:
            out = []
            for html, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if wrapper not in known:
                    if len(known) > 1000:
                        known = {None: None}
                    known[wrapper] = _unpack(json.loads(wrapper))
                out.append(extract(html, known[wrapper]))
            columns = [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return joined.mapInArrow(texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
