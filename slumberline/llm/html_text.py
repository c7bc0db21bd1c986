"""The main text of web pages by composite text density.

A page becomes a tree of elements. An element's density is its characters per tag, adjusted by how
many of them stand in links:

    (C / T) * log(C T / (LC LT)) / log(log(C LC / (C - LC) + C LCb / Cb + e))

with C characters, T tags, LC and LT those of links, b for the body (a count of 0 is taken as 1). An
element's *density sum* adds up the densities of its children, but for inline formatting (bold type, breaks, links), which is part of a
text and no block beside others. The element with the largest sum is the core of the article (ties: the first one, which is the outermost).
The least density on the way from the body to it is the threshold: the selection widens to the parent where something at
least that dense stands beside it.

Menus, footers, sidebars, notices, adverts, forms, scripts, styles and comments of readers are no article text. They are left out
by their element or role, and by words of class and id; such a word, however, doesn't leave out an element that is or holds an article, or,
on a page without one, that has half of the body's text, since layouts are called ``no-sidebar`` or ``menu-left``, too (words for readers'
comments count unless the element holds all articles of the page). Beyond that an article element only
lowers the threshold for what stands in it beside the core: density decides. Inside the selection, lists of links thinner than the threshold go as well.

Text: character references are decoded, blocks are split at block elements, white space inside a block becomes
one space, blocks are joined by one space in page order.

Defined results: null or empty html gives an empty text, as does a page without article text; broken
markup is read as browsers do in the main (open paragraphs and list items end where the next one
starts, stray end tags are ignored, an open comment, script or tag runs to the end); a page is handled by
itself, so null and repeated ids change nothing; very long or deep pages take time in proportion to their length and a few times
their size in memory; other columns are carried through, and columns ``text`` and ``n_chars`` are replaced; an empty table gives an empty
table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Sequence
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table caption tbody td tfoot th thead tr ul".split()
)
# What an opening tag ends, and up to which element it looks for it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_P = BLOCK - {"body", "head", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup"}
SCOPE = frozenset("td th table caption body html button object".split())
# What stands in a line of text, not beside other blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# Within these a button or label is part of a sentence.
SENTENCE = frozenset("p blockquote h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset(["button", "label"])
# No article text, by element, by role, by a word of class or id.
LEFT_OUT = RAW | frozenset(
    "head nav footer aside form select option input dialog menu object svg canvas math audio video".split()
)
LEFT_OUT_ROLES = frozenset("navigation banner complementary contentinfo search alert alertdialog dialog menu form".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe signup login social share sharing related recommended widget toolbar pagination "
    "pager copyright disclaimer skip".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus".split())
PAGE_HEADER = frozenset(["header", "topbar"])
ARTICLE = frozenset(["article", "main"])
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?|<[!?/][^>]*>?",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<!\S)(hidden)(?!\S)")
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


# How an element is marked by its class and id.
PLAIN, DOUBTED, COMMENT = 0, 1, 2


class Node:
    __slots__ = (
        "tag", "parent", "items", "skip", "doubt", "chars", "tags", "link_chars", "link_tags", "articles", "density", "total"
    )

    def __init__(self, tag: str, parent: Node | None, skip: bool, doubt: int = PLAIN):
        self.tag, self.parent, self.skip, self.doubt = tag, parent, skip, doubt
        self.items: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = self.articles = 0
        self.density = self.total = 0.0


def marks(tag: str, attributes: str, in_article: bool, in_sentence: bool) -> tuple[bool, int]:
    """Whether an element is left out whatever it holds, and what its class and id say of it."""
    if tag in LEFT_OUT or (tag in PAGE_HEADER and not in_article) or (tag in CONTROLS and not in_sentence):
        return True, PLAIN
    doubt = PLAIN
    if not attributes or tag in ("html", "body"):
        return False, doubt
    for name, double, single, bare, hidden in ATTRIBUTE.findall(attributes):
        value = double or single or bare
        name = name.lower()
        if hidden or (name == "style" and re.search(r"display\s*:\s*none", value)):
            return True, doubt
        if name == "role" and value.lower() in LEFT_OUT_ROLES:
            return True, doubt
        if name in ("class", "id"):
            words = set(WORDS.findall(CAMEL.sub(" ", value).lower()))
            if words & COMMENT_WORDS:
                doubt = COMMENT
            elif words & LEFT_OUT_WORDS or (words & PAGE_HEADER and not in_article):
                doubt = max(doubt, DOUBTED)
    return False, doubt


def parse(page: str) -> Node:
    """The tree of a page; texts and children stand in ``items`` in page order."""
    root = Node("html", None, False)
    stack, at = [root], 0
    # The depths at which an element of each kind is open, and those that end the search for one.
    open_at: dict[str, list[int]] = {}
    scopes: list[int] = []

    def deepest(tags: Iterable[str]) -> int:
        return max((open_at[tag][-1] for tag in tags if open_at.get(tag)), default=0)

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag = stack.pop().tag
            open_at[tag].pop()
            if tag in SCOPE:
                scopes.pop()

    size = len(page)
    while at < size:
        found = TOKEN.search(page, at)
        if not found:
            stack[-1].items.append(page[at:])
            break
        if found.start() > at:
            stack[-1].items.append(page[at : found.start()])
        at = found.end()
        tag = (found.group(2) or found.group(5) or "").lower()
        if not tag:
            continue
        scope = scopes[-1] if scopes else 0
        if found.group(1) or found.group(4):
            if tag == "br":
                stack[-1].items.append(" ")
            depth = deepest([tag])
            if depth and (tag in BLOCK or scope <= depth):
                close(depth)
            continue
        if tag in ("html", "body") and (tag == "html" or open_at.get(tag)):
            continue
        if tag in ENDS_P:
            depth = deepest(["p"])
            if depth > scope:
                close(depth)
        if tag in ENDS:
            ended, within = ENDS[tag]
            depth = deepest(ended)
            if depth > deepest(within):
                close(depth)
        if tag == "body":
            close(1)
        attributes = found.group(3) or found.group(6) or ""
        node = Node(tag, stack[-1], *marks(tag, attributes, deepest(ARTICLE) > 0, deepest(SENTENCE) > 0))
        stack[-1].items.append(node)
        if tag in VOID or (attributes.endswith("/") and tag not in BLOCK and tag not in RAW):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            node.items.append(page[at : end.start() if end else size])
            at = end.end() if end else size
            continue
        open_at.setdefault(tag, []).append(len(stack))
        if tag in SCOPE:
            scopes.append(len(stack))
        stack.append(node)
    return root


def settle_doubts(body: Node) -> None:
    """Leave out what class and id mark, unless it is or holds an article, or has half of the text."""
    nodes = nodes_of(body)
    for node in reversed(nodes):
        node.chars, node.articles = 0, int(node.tag in ARTICLE)
        for item in node.items:
            if isinstance(item, str):
                node.chars += n_chars(item)
            elif not item.skip:
                node.chars += item.chars
                node.articles += item.articles
    total, articles = body.chars, body.articles
    for node in nodes:
        if node.doubt == COMMENT:
            node.skip = not articles or node.articles < articles
        elif node.doubt == DOUBTED:
            node.skip = not node.articles and (articles > 0 or 2 * node.chars < total)
        node.chars = 0


def n_chars(text: str) -> int:
    return len(text) - text.count(" ") - text.count("\n") if not text.isspace() else 0


def nodes_of(root: Node) -> list[Node]:
    """All elements that are not left out, parents first."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo.extend(item for item in reversed(node.items) if isinstance(item, Node) and not item.skip)
    return found


def rate(nodes: list[Node], body: Node) -> None:
    """Counts, densities and density sums, children first."""
    for node in reversed(nodes):
        for item in node.items:
            if isinstance(item, str):
                node.chars += n_chars(item)
            elif not item.skip:
                node.chars += item.chars
                node.tags += item.tags + 1
                node.link_chars += item.link_chars
                node.link_tags += item.link_tags + (item.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        if node.chars:
            tags, linked, links = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
            base = log(node.chars * node.link_chars / max(node.chars - node.link_chars, 1) + share * node.chars + e)
            # A ratio or a logarithm of the base below 1 would turn the order round.
            ratio = max(node.chars * tags / (linked * links), 1.0)
            node.density = node.chars / tags * log(ratio) / max(log(base), 1.0)
    for node in nodes:
        parts = (item for item in node.items if isinstance(item, Node) and not item.skip and item.tag not in INLINE)
        node.total = sum(item.density for item in parts)


def select(root: Node) -> tuple[Node, float]:
    """The subtree with the article, and the least density on the way from the body to its core."""
    body = next((item for item in root.items if isinstance(item, Node) and item.tag == "body"), root)
    settle_doubts(body)
    nodes = nodes_of(body)
    rate(nodes, body)
    core = max(nodes, key=lambda node: node.total)
    if core.total == 0:
        core = max(nodes, key=lambda node: node.density)
    path = [core]
    while path[-1] is not body:
        path.append(path[-1].parent)
    threshold = min(node.density for node in path)
    chosen = core
    # Inside an article element whatever has text is dense enough.
    inside = max((i for i, node in enumerate(path) if node.tag == "article"), default=0)
    for i, parent in enumerate(path[1:], 1):
        if i <= inside:
            chosen = parent
            continue
        beside = (item for item in parent.items if isinstance(item, Node) and not item.skip and item is not chosen)
        if chosen.tag in BLOCK and not any(item.density >= threshold and item.chars for item in beside):
            break
        chosen = parent
    return chosen, threshold


def blocks(chosen: Node, threshold: float) -> list[str]:
    """Texts of the blocks below ``chosen`` in page order."""
    found, line = [], []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            found.append(text)
        line.clear()

    todo: list = [chosen]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            line.append(html.unescape(item) if "&" in item else item)
        elif item.skip or is_link_list(item, threshold):
            continue
        elif item.tag == "br":
            line.append(" ")
        else:
            if item.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(item.items))
    flush()
    return found


def is_link_list(node: Node, threshold: float) -> bool:
    return node.link_tags >= 3 and 2 * node.link_chars > node.chars and node.density < threshold


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return " ".join(blocks(*select(parse(page))))


def extract_task(carry: Sequence[str], schema: pa.Schema):
    def extract(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("html")
            for lo in range(0, batch.num_rows, 256):
                here = batch.slice(lo, 256)
                texts = [main_text(page.as_py()) for page in pages[lo : lo + 256]]
                columns = [here.column(name) for name in carry]
                columns += [pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return extract


def extract(pages: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars`` to the ``carry`` columns (all but html) of ``pages``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [name for name in pages.columns if name != "html"] if carry is None else list(carry)
    names = [name for name in names if name not in ("text", "n_chars")]
    schema = T.StructType(
        [pages.schema[name] for name in names]
        + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )
    wanted = pages.select(*dict.fromkeys([*names, "html"]))
    return wanted.mapInArrow(extract_task(names, to_arrow_schema(schema)), schema)
