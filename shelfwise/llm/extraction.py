"""Main text of web pages by tag-path ratios.

Every text leaf has a path of block tags from the root. Text length and punctuation are summed by
path and divided by the path's leaves; the ratios are smoothed along the page, fused by product,
and paths whose fused ratio reaches the ratios' standard deviation are content. The deepest element
that holds most of the content paths' text is the article; all blocks inside it that no menu, form,
advert and the like encloses are returned, headings and short paragraphs too. Of an <article> or
<main> around it, and of the page's body if only that holds the content paths, the content paths
and the headings before them are returned; an <h1> just before it all is its title. Content text
inside <article> or <main> counts double.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.batches import sliced

#: Element names of the HTML standard, by how they are treated here.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd
    label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("""area base br col embed hr img input link meta param source track
    wbr""".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object".split())
DROPPED = RAW | frozenset("""head nav footer aside form button select option datalist dialog menu
    fieldset canvas audio video map""".split())
#: An opening tag that ends an open element of these names, as in the standard.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What may stand in the head; any other tag or text begins the body.
HEAD_ONLY = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: Parts of class and id names of what is not the article.
ASIDE = re.compile(
    r"^(?:ad|ads|adv|advert\w*|adbox|adslot|banner\w*|sponsor\w*|promo\w*|sidebar\w*|aside|"
    r"comments?|commentlist|disqus|repl(?:y|ies)|cookies?|"
    r"consent|gdpr|notices?|notification\w*|nav\w*|menu\w*|breadcrumbs?|pagination|pager|"
    r"footer\w*|masthead|topbar|toolbar|social\w*|share|sharing|sharer|newsletter\w*|"
    r"subscribe|signup|login|popup\w*|modal\w*|overlay|widget\w*|related\w*|"
    r"recommend\w*|trending|teasers?)$")
#: Whole names of the same, which as parts, or inside <article> and <main>, also name content.
ASIDE_WHOLE = re.compile(
    r"^(?:side|foot|skip|hidden|discussion|responses?|respond|reviews?|alert\w*|search\w*|form|"
    r"copyright|legal|disclaimer\w*)(?:[-_](?:area|bar|block|box|field|form|info|input|line|links?|"
    r"list|panel|section|warning|widget|wrap|wrapper))?$")
#: The same for an <article>, by a whole name: readers' comments and links to other articles.
ARTICLE_ASIDE = re.compile(
    r"^(?:(?:\w+-)?comment(?:[-_](?:body|item|entry|content|text|\d+))?|comments|commentlist|disqus|"
    r"repl(?:y|ies)|responses?|ad|advert\w*|promo\w*|sponsor\w*|teasers?|related\w*|recommend\w*)$")
#: Names that say what a page's outer elements hold, not what they are.
LAYOUT = re.compile(r"^(?:has|with|without|no|js)[-_]|[-_](?:with|has|no)[-_]")
ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alert
    alertdialog menu menubar""".split())
PUNCTUATION = re.compile(r"[,.;:!?，。；：！？、]")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|"
    r"<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")


class Node:
    """An open or closed block element."""

    __slots__ = ("dropped", "name", "parent", "path", "place")

    def __init__(self, name: str, parent: Node | None, dropped: bool, path: str, place: int):
        self.name, self.parent, self.dropped, self.path = name, parent, dropped, path
        self.place = place


def is_aside(name: str, rest: str, within: bool) -> tuple[bool, str]:
    """Whether an element is not part of the article, and the names that its path shows."""
    if name in DROPPED or name == "header" and not within:
        return True, ""
    names = []
    for key, value in ATTRIBUTE.findall(rest) if rest else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            names += [one for one in value.split() if not LAYOUT.search(one)]
        elif key == "role" and value in ROLES or key == "hidden" or (
                key == "aria-hidden" and value == "true") or (
                key == "style" and re.search(r"display\s*:\s*none", value)):
            return True, ""
    parts = [part for one in names for part in [one, *re.split(r"[-_]+", one)]]
    if name == "article":
        hit = any(map(ARTICLE_ASIDE.match, names))
    else:
        hit = name not in ("html", "body", "main") and (
            any(map(ASIDE.match, parts)) or not within and any(map(ASIDE_WHOLE.match, names)))
    return hit, "".join(f".{one}" for one in names[:2])


def end_of_inline(page: str, at: int, name: str) -> int:
    """Where an inline element that begins before ``at`` ends: at its own or its block's end."""
    depth = blocks = 0
    while True:
        mark = page.find("<", at)
        if mark < 0:
            return len(page)
        token = TOKEN.match(page, mark)
        at = token.end() if token else mark + 1
        other = (token["name"] or token["name2"] or "").lower() if token else ""
        ends = bool(token) and bool(token["end"] or token["end2"])
        if other == name:
            depth += -1 if ends else 1
            if depth < 0:
                return at
        elif other and other not in INLINE | VOID | RAW:
            blocks += -1 if ends else 1
            if blocks < 0:
                return mark


def text_blocks(page: str) -> list[tuple[Node, str]]:
    """Blocks of text outside of dropped elements in page order, with their elements."""
    root = Node("", None, False, "", 0)
    node, count, within = root, 0, 0
    blocks: list[tuple[Node, str]] = []
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                blocks.append((node, text))
            pieces.clear()

    def close(to: Node) -> None:
        nonlocal node, within
        while node is not to:
            within -= node.name in ("article", "main")
            node = node.parent

    def begin_body(text: str) -> None:
        if node.name == "head" and text.strip():
            close(node.parent)

    at = 0
    while at < len(page):
        mark = page.find("<", at)
        token = TOKEN.match(page, mark) if mark >= 0 else None
        if token is None:  # text up to the end, or a bracket that opens nothing
            end = len(page) if mark < 0 else mark + 1
            begin_body(page[at:end])
            if not node.dropped:
                pieces.append(page[at:end])
            at = end
            continue
        begin_body(page[at:mark])
        if mark > at and not node.dropped:
            pieces.append(page[at:mark])
        at = token.end()
        name = (token["name"] or token["name2"] or "").lower()
        rest = token["rest"] or token["rest2"] or ""
        if not name:
            continue
        if token["end"] or token["end2"]:
            if name in INLINE:
                continue
            open_ = node
            while open_ is not root and open_.name != name:
                open_ = open_.parent
            if open_ is not root:
                flush()
                close(open_.parent)
            continue
        if node.name == "head" and name not in HEAD_ONLY:
            close(node.parent)
        if name in RAW and not rest.endswith("/"):
            found = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.IGNORECASE).search(page, at)
            at = found.end() if found else len(page)
            if name not in ("title", "textarea"):
                continue
            flush()
            continue
        if name == "br":
            pieces.append(" ")
        if name in INLINE and not (rest and is_aside(name, rest, True)[0]):
            continue
        if name in INLINE:  # a hidden or advertising span; what it holds is dropped
            at = end_of_inline(page, at, name)
            continue
        flush()
        if name in VOID:
            continue
        ends = ENDS.get(name)
        if ends:
            open_ = node
            while open_ is not root and open_.name not in ends | {"ul", "ol", "dl", "table"}:
                open_ = open_.parent
            if open_.name in ends:
                close(open_.parent)
        elif node.name == "p" or node.name in HEADINGS and name in HEADINGS:
            close(node.parent)  # a block ends an open paragraph
        aside, shown = is_aside(name, rest, within > 0)
        count += 1
        node = Node(name, node, node.dropped or aside, f"{node.path}/{name}{shown}", count)
        within += name in ("article", "main")
    flush()
    return blocks


def content_paths(blocks: list[tuple[Node, str]]) -> set[str]:
    """Paths whose smoothed, fused ratios reach the standard deviation."""
    length, marks, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, text in blocks:
        length[node.path] += len(text)
        marks[node.path] += len(PUNCTUATION.findall(text))
        leaves[node.path] += 1
    along = np.array([[length[n.path] / leaves[n.path], (marks[n.path] + 1) / leaves[n.path]]
                      for n, _ in blocks])
    padded = np.pad(along, ((1, 1), (0, 0)), mode="edge")
    fused = (padded[:-2] + 2 * padded[1:-1] + padded[2:]).prod(axis=1) / 16
    total: dict[str, float] = defaultdict(float)
    for (node, _), value in zip(blocks, fused, strict=True):
        total[node.path] += value / leaves[node.path]
    least = float(np.std(list(total.values())))
    return {path for path, value in total.items() if value >= least}


def enclosing(node: Node, names: tuple[str, ...]) -> Node | None:
    """The nearest element of such a name, the node itself included."""
    up: Node | None = node
    while up is not None and up.name not in names:
        up = up.parent
    return up


def within_element(node: Node, element: Node) -> bool:
    up: Node | None = node
    while up is not None and up is not element:
        up = up.parent
    return up is element


def main_text(page: str | None, share: float = 0.7) -> str:
    """The article's blocks, one line each; empty if the page has none."""
    blocks = text_blocks(page or "")
    if not blocks:
        return ""
    chosen = content_paths(blocks)
    weight: dict[Node, int] = defaultdict(int)
    for node, text in blocks:
        if node.path in chosen:
            own = len(text) * (2 if enclosing(node, ("article", "main")) else 1)
            up: Node | None = node
            while up is not None:
                weight[up] += own
                up = up.parent
    root = next(n for n in weight if n.parent is None)
    best = max((n for n in weight if weight[n] >= share * weight[root]), key=lambda n: n.place)
    while best.name in HEADINGS or best.name in ("p", "li", "td", "blockquote", "pre"):
        best = best.parent  # a leaf alone: its siblings belong to it
    outer = enclosing(best, ("article",)) or enclosing(best, ("main",)) or best
    whole = best.name not in ("", "html", "body")
    inside, keep, before = [], [], []
    for node, text in blocks:
        if within_element(node, outer):
            inside.append((node, text))
            keep.append(node.path in chosen or whole and within_element(node, best))
        elif not inside:
            before = [*before, text] if node.name == "h1" else []
    for i in range(len(inside) - 2, -1, -1):
        keep[i] |= keep[i + 1] and inside[i][0].name in HEADINGS
    inside = [pair for pair, kept in zip(inside, keep, strict=True) if kept]
    return "\n".join([*before, *(text for _, text in inside)])


def extract_pages(pages: DataFrame, share: float = 0.7) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars`` (code points of ``text``).

    The whole page is read. Null or empty html gives an empty text, not null; repeated rows each
    give a row; an empty table gives none. Only ``page_id``, ``url`` and ``html`` are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [main_text(page, share) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(text) for text in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    schema = T.StructType([pages.schema["page_id"], pages.schema["url"],
                           T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(run, schema)
