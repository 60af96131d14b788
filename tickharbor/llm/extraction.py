"""Main text of web pages by consensus of the pages of a host.

Every page scores its containers by the text they hold outside links and boilerplate, and votes for the
generalised path of tags and classes of its best one. Beside it, it reports the paths and digests of the
containers that hang off the way to the best one. Votes are added up per host; pages are then extracted again
with the winning path of their host, or from their own best container if they do not have it. Text beside the
main container is kept, unless its container's path is one of the host's template paths (the same text on
pages of different main text) or it holds links only.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickharbor.session import stored

# HTML element names by role.
CONTAINERS = frozenset("article main section div body td table center".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements of plain text, which last to the end of the page if they have no end tag; others that are no text end with their parent.
RAW = frozenset("script style textarea title iframe xmp".split())
FOREIGN, INERT = frozenset("svg math".split()), frozenset("noscript template".split())
DROPPED = frozenset("nav footer aside form button select option dialog menu object audio video canvas head".split()) | RAW | FOREIGN | INERT
# Start tags that end an open svg or math, and elements in these that hold HTML.
BREAKOUT = CONTAINERS | frozenset(
    "b big blockquote br code dd dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small "
    "span strong strike sub sup tt u ul var".split())
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
CLOSED_BY_BLOCKS = frozenset("p".split())
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
              "th": {"td", "th"}, "option": {"option"}}
# Words in class, id or role that mark what surrounds an article.
BOILERPLATE = frozenset(
    "nav navbar navigation menu menubar sidebar side footer header masthead banner ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login form search breadcrumb breadcrumbs share sharing social related "
    "recommended comment comments reply replies respond disqus discussion widget toolbar pagination pager copyright "
    "disclaimer contentinfo complementary hidden".split())
ENDED_AT = CONTAINERS | FOREIGN | INERT | frozenset("ul ol dl tbody thead".split())
# Share of a container's text that a child must hold to be the better container. It decides votes, not what is kept.
DESCEND = 0.85

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAME = re.compile(r"[a-z]+")
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE) for tag in RAW | INERT}
_BEGIN = {tag: re.compile(rf"<{tag}(?=[\s/>])", re.IGNORECASE) for tag in INERT}


@dataclass(slots=True)
class Node:
    """``path`` is a digest of the tags and classes from the root, so that deep pages stay small."""

    tag: str
    path: bytes
    parent: int
    dropped: bool
    link: bool
    mass: int = 0


class Open:
    """The open elements, with the depths of each tag and of all that are not inline: no look-up scans them."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, int]] = []
        self.depths: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def push(self, tag: str, node: int) -> None:
        self.depths[tag].append(len(self.elements))
        if tag not in INLINE:
            self.blocks.append(len(self.elements))
        self.elements.append((tag, node))

    def cut(self, depth: int) -> None:
        while len(self.elements) > depth:
            tag, _ = self.elements.pop()
            self.depths[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()

    def node(self) -> int:
        return self.elements[-1][1] if self.elements else 0

    def last(self, tags) -> int:
        """The depth of the innermost of some tags, or -1."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=-1)

    def foreign(self) -> int:
        """The depth of the svg or math whose elements are read, or -1 in HTML."""
        depth = self.last(FOREIGN)
        return depth if depth > self.last(INTEGRATION) else -1

    def inline_from(self, depth: int) -> bool:
        """Whether an inline end tag may end all from here; what an unclosed svg, math, noscript or template holds ends with it."""
        k = bisect_left(self.blocks, depth)
        return k == len(self.blocks) or self.elements[self.blocks[k]][0] in FOREIGN | INERT

    def close_for(self, tag: str) -> None:
        """End what a new block element ends: an open paragraph, or an item at the same level."""
        ends = SAME_LEVEL.get(tag, set()) | CLOSED_BY_BLOCKS
        depth = self.last(ends)
        if depth >= 0 and depth > self.last(ENDED_AT - ends):
            self.cut(depth)


@dataclass
class Page:
    """Container nodes and boilerplate of a page; pieces of text (node, text), where a text of None ends a block."""

    nodes: list[Node]
    pieces: list[tuple[int, str | None]]


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _marks(attributes: str) -> tuple[str, set[str]]:
    """Generalised classes for the path, and all words of class, id and role."""
    classes, words = [], set()
    for match in _ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
        if name == "class":
            classes = sorted({"".join(c for c in x if not c.isdigit()) for x in value.split()})
        if name in ("class", "id", "role"):
            words.update(_NAME.findall(value))
        if name == "style" and "display:none" in value.replace(" ", ""):
            words.add("hidden")
    return "." + ".".join(classes) if classes else "", words


def parse(source: str) -> Page:
    """Read a page leniently: unclosed and crossing tags are closed as far as blocks demand."""
    nodes = [Node("html", b"", -1, False, False)]
    pieces: list[tuple[int, str | None]] = []
    stack = Open()
    at, size = 0, len(source)
    ends: dict[str, re.Match | None] = {}  # the next end tags, each looked for once

    def end_of(tag: str) -> re.Match | None:
        if tag not in ends or (ends[tag] and ends[tag].start() < at):
            ends[tag] = _END[tag].search(source, at)
        return ends[tag]

    def text(raw: str) -> None:
        if raw:
            pieces.append((stack.node(), entities.unescape(raw) if "&" in raw else raw))

    while at < size:
        found = _TAG.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at:found.start()])
        at = found.end()
        closing, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        tag = name.lower()
        if tag not in INLINE:
            pieces.append((stack.node(), None))
        if closing:
            depth = stack.last((tag,))
            if depth >= 0 and (tag not in INLINE or stack.inline_from(depth)):
                stack.cut(depth)
            continue
        foreign = stack.foreign() if nodes[stack.node()].dropped else -1
        if foreign >= 0 and tag in BREAKOUT:
            stack.cut(foreign)
            foreign = -1
        if tag in VOID:
            continue
        if tag in RAW and foreign < 0:
            end = end_of(tag)
            at = end.end() if end else size
            continue
        if tag in INERT:
            end = end_of(tag)
            if end and not _BEGIN[tag].search(source, at, end.start()):
                at = end.end()
                continue
        elif tag not in INLINE and tag not in FOREIGN:
            stack.close_for(tag)
        parent = stack.node()
        classes, words = _marks(attributes) if "=" in attributes else ("", set())
        above = nodes[parent]
        dropped = above.dropped or tag in DROPPED or (tag == "header" and stack.last(("article", "main")) < 0) or (
            tag not in ("html", "body", "main", "article") and bool(words & BOILERPLATE))
        own = parent
        if tag in CONTAINERS or dropped != above.dropped or (tag == "a" and not above.link):
            path = _digest(above.path + f"/{tag}{classes}".encode("utf-8", "replace")) if tag in CONTAINERS else above.path
            nodes.append(Node(tag, path, parent, dropped, above.link or tag == "a"))
            own = len(nodes) - 1
        if not attributes.rstrip().endswith("/") or tag in CONTAINERS:
            stack.push(tag, own)
    return Page(nodes, pieces)


def weigh(page: Page) -> None:
    """Set for each node the length of its text outside links and boilerplate."""
    for node, text in page.pieces:
        if text and not page.nodes[node].dropped and not page.nodes[node].link:
            page.nodes[node].mass += len("".join(text.split()))
    for node in reversed(page.nodes[1:]):
        page.nodes[node.parent].mass += node.mass


def best_container(page: Page) -> int:
    """The innermost container that holds nearly all of the page's text; the first of equal ones."""
    heavy: dict[int, int] = {}
    articles: set[int] = set()  # nodes with an article or main among their children
    for k, node in enumerate(page.nodes[1:], 1):
        if node.parent not in heavy or node.mass > page.nodes[heavy[node.parent]].mass:
            heavy[node.parent] = k
        if node.tag in ("article", "main"):
            articles.add(node.parent)
    at = 0
    while at in heavy:
        child = page.nodes[heavy[at]]
        if not child.mass or child.mass < DESCEND * page.nodes[at].mass or child.tag not in CONTAINERS:
            return at
        at = heavy[at]
        if child.tag in ("article", "main") and at not in articles:
            return at
    return at


def around(page: Page, roots: set[int]) -> tuple[list[bool], list[bool], list[int]]:
    """Whether a node is in a root, whether it is above one, and the containers that hang off the way to them."""
    inside, above = [False] * len(page.nodes), [False] * len(page.nodes)
    for k in range(len(page.nodes) - 1, 0, -1):
        if k in roots or above[k]:
            above[page.nodes[k].parent] = True
    branches = []
    for k, node in enumerate(page.nodes):
        inside[k] = k in roots or (node.parent >= 0 and inside[node.parent])
        if k and not inside[k] and not above[k] and above[node.parent] and node.tag in CONTAINERS and not node.dropped:
            branches.append(k)
    return inside, above, branches


def _words(page: Page, chosen: list[bool]) -> str:
    parts = [" " if text is None else text for node, text in page.pieces if text is None or chosen[node] and not page.nodes[node].dropped]
    return " ".join("".join(parts).split())


def render(page: Page, roots: set[int], templates: frozenset[bytes] = frozenset()) -> str:
    """The text of the roots and of what stands beside them, without boilerplate; white space is one space, as are the ends of blocks.

    Beside the roots, containers on a template path, containers of links only and blocks of links only are left out.
    """
    inside, above, branches = around(page, roots)
    for k in branches:
        inside[k] = page.nodes[k].mass > 0 and page.nodes[k].path not in templates
    beside = [False] * len(page.nodes)  # the nodes above the roots, and links and the like right in them
    within = set(branches)
    for k, node in enumerate(page.nodes):
        if k in roots:
            continue
        beside[k] = above[k] or (node.parent >= 0 and beside[node.parent] and k not in within)
        if not beside[k] and node.parent >= 0 and k not in within:
            inside[k] = inside[node.parent]
    parts: list[str] = []
    block: list[str] = []  # the text of an open block beside the roots
    prose = False
    for node, text in page.pieces:
        if text is None or not beside[node]:
            if prose:
                parts += block
            block, prose = [], False
        if text is None:
            parts.append(" ")
        elif not page.nodes[node].dropped:
            if beside[node]:
                block.append(text)
                prose = prose or (not page.nodes[node].link and not text.isspace())
            elif inside[node]:
                parts.append(text)
    if prose:
        parts += block
    return " ".join("".join(parts).split())


def extract(source: str, path: bytes | None, templates: frozenset[bytes] = frozenset()) -> str:
    """The main text by the host's path if the page has it, else by the page's own best container."""
    page = parse(source)
    weigh(page)
    roots = set()
    if path is not None:
        roots = {k for k, node in enumerate(page.nodes) if node.path == path and node.tag in CONTAINERS and not node.dropped and node.mass}
    return render(page, roots or {best_container(page)}, templates)


_VOTE = pa.schema([("host", pa.string()), ("path", pa.binary()), ("main", pa.bool_()), ("side_text", pa.binary()), ("main_text", pa.binary())])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page one vote for the path of its best container, and one row for each container with text beside it."""
    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = parse(source)
            weigh(page)
            best = best_container(page)
            if not page.nodes[best].mass:
                continue
            inside, _, branches = around(page, {best})
            main = _digest(_words(page, inside).encode("utf-8", "replace"))
            rows = [(host, page.nodes[best].path, True, None, main)]
            branches = [k for k in branches if page.nodes[k].mass]
            if branches:
                owner = {k: k for k in branches}
                for k, node in enumerate(page.nodes):
                    if k not in owner and node.parent in owner:
                        owner[k] = owner[node.parent]
                texts: dict[int, list[str]] = {k: [] for k in branches}
                for node, text in page.pieces:
                    if node in owner and not page.nodes[node].dropped:
                        texts[owner[node]].append(" " if text is None else text)
                rows += [(host, page.nodes[k].path, False, _digest(" ".join("".join(parts).split()).encode("utf-8", "replace")), main)
                         for k, parts in texts.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _VOTE)], schema=_VOTE)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(s, p, frozenset(t or ())) for s, p, t in zip(
            batch.column("html").to_pylist(), batch.column("path").to_pylist(), batch.column("templates").to_pylist())]
        yield batch.select(["page_id", "url"]).append_column("text", pa.array(texts, pa.string())) \
            .append_column("n_chars", pa.array([len(t) for t in texts], pa.int64()))


def host_of(url: F.Column) -> F.Column:
    """The host of an address in lower case, without user and port; null if there is none."""
    place = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.when(place != "", place))


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, path, templates``: the container path that most pages of a host vote for, and its template paths.

    Of paths with equal votes the first in order wins. A path beside the main container is a template's if the
    texts found there are at most half as many as the main texts they stand beside; copies of a page count once.
    """
    votes = stored(pages.where("host IS NOT NULL").select("host", "html").mapInArrow(
        _votes, "host string, path binary, main boolean, side_text binary, main_text binary"), "page-votes")
    counted = votes.where("main").groupBy("host", "path").agg(F.count("*").alias("votes"))
    winners = counted.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), F.col("path"))).alias("path"))
    beside = votes.where("NOT main").groupBy("host", "path").agg(
        F.count_distinct("side_text").alias("texts"), F.count_distinct("main_text").alias("pages"))
    templates = beside.where("2 * texts <= pages").groupBy("host").agg(F.collect_list("path").alias("templates"))
    return winners.join(templates, "host", "left")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    A null page is empty and has the empty text. A page whose address has no host does not vote and uses its
    own best container, without template paths. Of containers that hold equally much the first is the better one.
    Repeated rows give repeated rows; other columns are ignored; an empty table gives no rows. A page is parsed in
    time and memory that grow with its length, however deep or unclosed its elements are. Votes are added up before
    they move, so a host with a third of all pages is a few short rows per task; a host's template paths are as many as
    its page designs have, not its pages; the join with them is split by adaptive execution where a host is large.
    """
    known = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    winners = stored(host_paths(known), "host-paths")
    return known.join(winners, "host", "left").select("page_id", "url", "html", "path", "templates").mapInArrow(
        _extracted, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
