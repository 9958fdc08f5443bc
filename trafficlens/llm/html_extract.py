"""HTML extraction: article text with site templates removed.

Pages are parsed into element trees. Subtrees outside the article are hashed
(tag, class, text and children); Spark counts per host on how many different
pages each occurs. A link list found on many pages of its host (``MIN_PAGES`` and
``MIN_PERCENT`` of them) is template and deleted; any other subtree must be a
whole block container outside the ``article`` or ``main`` element and recur on
``MIN_BLOCK_PERCENT`` of the pages: cells, list items and headings alone are text,
and so is a passage that many articles share. Menus and adverts whose words differ from
page to page are found by a second hash, of the subtree's shape: text of links and of
short blocks is masked and repeated siblings count once. A shape must recur on
``MIN_BLOCK_PERCENT`` of the pages, outside the ``article`` or ``main`` element; on a page
without one, only the shape of a list of ``MIN_LINKS`` links or more counts. Pages of equal text count as one,
so copies of a page never turn its text into template. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments are deleted by
element, role and whole class token or id as well; a form around an article is
none of them. ``html_extract(pages, names=False)`` is the template removal alone: the
whole body less the recurring subtrees, without these lists and without taking the
article element for the text.

The text is that of the page's articles, else of its ``main``, else of its body:
character references decoded, white space inside a block made one space, blocks
joined by two line feeds.

The template table (a few hashes a host) is written and joined on the host;
Spark broadcasts it only under its size threshold and otherwise splits the hot
hosts of the join. Defined cases: a null html is an empty page (empty text); a
null url has no host and keeps all but the deleted elements; broken markup is
closed at the end of the page; an unknown ``<![...>`` is a comment up to the next
``>``; repeated rows give equal rows. Only ``page_id``,
``url`` and ``html`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.tables import Scratch

MIN_PAGES = 5
MIN_PERCENT = 10        # link lists
MIN_BLOCK_PERCENT = 50  # other blocks outside of an article

MIN_LINKS = 3           # of a link list known by its shape alone
SHORT_BLOCK = 200       # characters of a block that its shape masks
LINKS, BLOCK, SHAPE = 0, 1, 2  # kinds of candidates: the last two bits of their hashes

MAX_DEPTH = 256  # elements nested deeper become siblings; their text stays in place

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
                   "section summary table tbody tfoot thead tr ul caption".split())
# A start tag of the first closes an open element of the second.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "body": ("head",)}
SCOPES = frozenset("ul ol dl table select article section div main body html td th".split())
DROPPED = frozenset("script style noscript template head title nav footer aside form button select textarea input "
                    "iframe svg canvas object embed dialog menu audio video map".split())
UNSEEN = frozenset("script style noscript template head title".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu "
                          "menubar".split())
# Elements that are no article text, by class token or id: a token counts if each of its parts is one of these words
# or of ``NAME_PARTS`` ("cookie-notice", "share-buttons", but not "text-widget-body" or "has-sidebar"); those of the
# second list count only outside of an article.
DROPPED_NAMES = frozenset("ad ads adv advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored "
                          "promo cookie cookies consent gdpr notice notices popup modal overlay sidebar menu nav navbar "
                          "navigation breadcrumb breadcrumbs comment comments disqus share sharing social related "
                          "commentlist newsletter subscribe login signup search pagination pager widget".split())
DROPPED_OUTSIDE = frozenset("header footer banner masthead topbar toolbar copyright".split())
NAME_PARTS = frozenset("site page main primary secondary top bottom left right side bar box banner block area list item "
                       "items link links button buttons icons container wrapper wrap slot unit form section reply "
                       "respond thread posts post articles stories footer header toggle wp mega mobile desktop global user reader "
                       "google follow sticky floating dropdown onetrust sdk".split())
COMMENT_CLASSES = frozenset("comment comments comment-body user-comment reader-comment".split())
# Their ids are anchors of the text.
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th tr caption figure figcaption blockquote pre section span a b i em "
                     "strong code sup sub mark small label cite q time img".split())
SECTION_IDS = frozenset("comment comments disqus sidebar cookie cookies consent gdpr".split())
LINK_LISTS = frozenset("ul ol div section table".split())
CONTAINERS = frozenset("address aside blockquote center details dialog dir div dl fieldset figure footer form header "
                       "hgroup menu nav ol p pre section table ul".split())
LONE = frozenset("li dt dd td th caption figcaption summary h1 h2 h3 h4 h5 h6".split())
_NAMES = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
# Python refuses to read integers of thousands of digits; 1114112 is the first number that is no character.
_LONG_REFERENCE = re.compile(r"&#0*([0-9]{9,})")


class Node:
    __slots__ = ("tag", "names", "classes", "marks", "outside_marks", "role", "hidden", "children")

    def __init__(self, tag: str, attrs: list[tuple[str, str | None]]):
        self.tag = tag
        self.children: list = []
        self.names: frozenset = frozenset()  # word parts of class and id
        self.classes: frozenset = frozenset()
        self.marks = self.outside_marks = False  # named as no article text, as none outside of an article
        self.role = ""
        self.hidden = False
        for key, value in attrs:
            if key in ("class", "id") and value:
                self.names |= {part.lower() for part in _NAMES.findall(value)}
                if key == "class":
                    self.classes |= frozenset(value.lower().split())
                for token in value.split():
                    self.mark([part.lower() for part in _NAMES.findall(token)], key == "id")
            elif key == "role" and value:
                self.role = value.strip().lower()
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                self.hidden = True


    def mark(self, parts: list[str], is_id: bool) -> None:
        if is_id and self.tag in ANCHORED and (self.tag != "section" or SECTION_IDS.isdisjoint(parts)):
            return
        if not all(p in DROPPED_NAMES or p in DROPPED_OUTSIDE or p in NAME_PARTS for p in parts):
            return
        self.marks |= any(p in DROPPED_NAMES for p in parts)
        self.outside_marks |= any(p in DROPPED_OUTSIDE for p in parts)


class TreeBuilder(HTMLParser):
    """Element tree of a page; tolerant of missing end tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", [])
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag in BLOCKS or tag in CLOSES:
            self.close_open(tag)
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID and len(self.open) < MAX_DEPTH:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def close_open(self, tag: str) -> None:
        """Close what the start tag ends: an open paragraph, list item, cell."""
        ended = CLOSES.get(tag, ()) + (("p",) if tag in BLOCKS else ())
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in ended:
                del self.open[at:]
                return
            if self.open[at].tag in SCOPES:
                return

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)

    def parse_html_declaration(self, i: int) -> int:
        """``<![...>`` of any kind is a comment up to the next ``>``, as in browsers;
        the parser raises on sections it does not know."""
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(_LONG_REFERENCE.sub(lambda m: "&#" + (m[1] if len(m[1]) < 20 else "1114112"), html))
    builder.close()
    return builder.root


def is_dropped(node: Node, inside: bool) -> bool:
    """Element that never holds article text; ``inside``: within an article."""
    if node.tag in ("article", "main"):
        return not node.classes.isdisjoint(COMMENT_CLASSES)
    if node.tag in ("html", "body") or node.role == "main":
        return False
    if node.tag in DROPPED or node.role in DROPPED_ROLES or node.hidden or node.marks:
        return inside or node.tag != "form" or not holds_article(node)
    return not inside and (node.tag == "header" or node.outside_marks)


def is_article(node: Node, wanted: str) -> bool:
    return (node.tag == wanted or wanted == "main" and node.role == "main") and not is_dropped(node, True)


def holds_article(node: Node) -> bool:
    """An article or main element in a form: the form wraps the page."""
    stack = [node]
    while stack:
        for child in stack.pop().children:
            if isinstance(child, Node):
                if is_article(child, "article") or is_article(child, "main"):
                    return True
                stack.append(child)
    return False


def article_roots(root: Node) -> list[Node]:
    """The articles of a page, else its main element, else its body. Where no
    article stands outside the deleted elements, those in a deleted wrapper are
    taken if they hold more text than the rest."""
    roots = outermost(root, "article", False)
    if roots:
        return roots
    roots = outermost(root, "main", False) or [root]
    size = text_size(roots, roots == [root])
    skipped = frozenset() if size == 0 else DROPPED - {"form"}  # an aside's article is a teaser beside any text
    wrapped = outermost(root, "article", True, skipped) or outermost(root, "main", True, skipped)
    wrapped = [w for w in wrapped if w not in roots]
    return wrapped if wrapped and text_size(wrapped, False) > size else roots


def outermost(root: Node, wanted: str, wrapped: bool, skipped: frozenset = frozenset()) -> list[Node]:
    """The outermost ``wanted`` elements in page order; ``wrapped``: those in the
    fewest deleted elements (but ``skipped`` tags), else those in none."""
    level = [root]
    while level:
        found, below, stack = [], [], level[::-1]
        while stack:
            node = stack.pop()
            if is_article(node, wanted):
                found.append(node)
                continue
            if node is not root and node.tag in ("article", "main") and is_dropped(node, True):
                continue
            inner = []
            for child in node.children:
                if isinstance(child, Node) and not is_dropped(child, False):
                    inner.append(child)
                elif isinstance(child, Node) and child.tag not in skipped:
                    below.append(child)
            stack += inner[::-1]
        if found or not wrapped:
            return found
        level = below
    return []


def text_size(roots: list[Node], whole_page: bool) -> int:
    return sum(map(len, blocks_of(roots, set(), whole_page)))


def hash_subtrees(node: Node, out: dict[int, int]) -> tuple[bytes, int, int]:
    """Hash every subtree (``out``: id of the node to hash); returns the hash,
    the text length and the length of text in links."""
    h = blake2b(digest_size=8)
    h.update(node.tag.encode() + b"\0" + " ".join(sorted(node.names)).encode())
    size = linked = 0
    for child in node.children:
        if isinstance(child, str):
            text = " ".join(child.split())
            h.update(b"\1" + text.encode("utf-8", "surrogatepass"))
            size += len(text)
        else:
            digest, n, m = hash_subtrees(child, out)
            h.update(b"\2" + digest)
            size, linked = size + n, linked + m
    if node.tag == "a":
        linked = size
    digest = h.digest()
    if size:
        out[id(node)] = int.from_bytes(digest, "big", signed=True)
    return digest, size, linked


def shape_of(node: Node, out: dict[int, int], link: bool = False) -> tuple[bytes, int]:
    """Hash the shape of every subtree (``out``: id of the node to hash) and return
    the node's with its text length: elements and the names of block elements, text in
    links and of blocks of up to ``SHORT_BLOCK`` characters masked, equal neighbours once."""
    link = link or node.tag == "a"
    parts: list[tuple[bytes, str]] = []
    size = 0
    for child in node.children:
        if isinstance(child, str):
            text = " ".join(child.split())
            n, part = len(text), (b"", text)
        else:
            digest, n = shape_of(child, out, link)
            part = (digest, "")
        size += n
        if n:
            parts.append(part)
    h = blake2b(digest_size=8)
    names = " ".join(sorted(node.names)) if node.tag in CONTAINERS else ""
    h.update(node.tag.encode() + b"\0" + names.encode())
    last = None
    for digest, text in parts:
        mark = b"\2" + digest if digest else b"\1" if link or size <= SHORT_BLOCK \
            else b"\3" + text.encode("utf-8", "surrogatepass")
        if mark != last:
            h.update(mark)
        last = mark
    out[id(node)] = int.from_bytes(h.digest(), "big", signed=True)
    return h.digest(), size


def template_candidates(root: Node) -> list[tuple[int, int]]:
    """Nodes that may be template (id, hash): link lists and, outside the article,
    block containers, by their text; the same again by their shape, without an article
    link lists only. The kind is in the hash's last two bits."""
    hashes: dict[int, int] = {}
    hash_subtrees(root, hashes)
    roots = article_roots(root)
    marked = {id(r) for r in roots if r is not root}
    shapes: dict[int, int] = {}
    out: list[tuple[int, int]] = []
    holders: set[int] = set()  # elements that hold an article

    def holds(node: Node) -> bool:
        found = id(node) in marked
        for child in node.children:
            if isinstance(child, Node) and holds(child):
                found = True
        if found:
            holders.add(id(node))
        return found

    if marked:
        holds(root)

    def walk(node: Node, inside: bool) -> None:
        for child in node.children:
            if not isinstance(child, Node) or id(child) not in hashes:
                continue
            if id(child) in marked:
                walk(child, True)
                continue
            links = child.tag in LINK_LISTS and mostly_links(child)
            if links:
                out.append((id(child), hashes[id(child)] & ~3 | LINKS))
            elif not inside and child.tag in CONTAINERS and not is_lone(child, hashes):
                out.append((id(child), hashes[id(child)] & ~3 | BLOCK))
            by_shape = child.tag in CONTAINERS if marked else links and count_links(child) >= MIN_LINKS
            if by_shape and not inside and id(child) not in holders:
                if id(child) not in shapes:
                    shape_of(child, shapes)
                out.append((id(child), shapes[id(child)] & ~3 | SHAPE))
            walk(child, inside)

    walk(root, False)
    return out


def is_lone(node: Node, hashes: dict[int, int]) -> bool:
    """All text of the node is in one cell, list item or heading."""
    while node.tag not in LONE:
        if any(isinstance(child, str) and child.strip() for child in node.children):
            return False
        held = [child for child in node.children if isinstance(child, Node) and id(child) in hashes]
        if len(held) != 1:
            return False
        node = held[0]
    return True


def count_links(node: Node) -> int:
    return (node.tag == "a") + sum(count_links(child) for child in node.children if isinstance(child, Node))


def mostly_links(node: Node) -> bool:
    size, linked, stack = 0, 0, [(node, False)]
    while stack:
        at, link = stack.pop()
        for child in at.children:
            if isinstance(child, str):
                n = len(child.strip())
                size, linked = size + n, linked + n * link
            else:
                stack.append((child, link or child.tag == "a"))
    return size > 0 and 2 * linked >= size


def blocks_of(roots: list[Node], deleted: set[int], whole_page: bool, names: bool = True) -> list[str]:
    """Text blocks in page order; without ``names`` only what is never shown is left out."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    def walk(node: Node, inside: bool) -> None:
        for child in node.children:
            if isinstance(child, str):
                run.append(child)
            elif child.tag == "br":
                run.append(" ")
            elif id(child) in deleted or (is_dropped(child, inside) if names else child.tag in UNSEEN):
                run.append(" ")
            elif child.tag in BLOCKS:
                flush()
                walk(child, inside)
                flush()
            else:
                if child.tag in ("td", "th"):
                    run.append(" ")
                walk(child, inside)

    for root in roots:
        walk(root, not whole_page)
        flush()
    return out


def page_text(html: str, templates: set[int], names: bool = True) -> str:
    root = parse(html)
    deleted = {k for k, h in template_candidates(root) if h in templates} if templates else set()
    roots = article_roots(root) if names else [root]
    return "\n\n".join(blocks_of(roots, deleted, roots == [root], names))


def page_hashes(html: str) -> tuple[int, list[int]]:
    """Fingerprint of the page's text and the distinct hashes of its template candidates."""
    root = parse(html)
    text = "\n".join(blocks_of([root], set(), True))
    print_ = int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
    return print_, sorted({h for _, h in template_candidates(root)})


def host_column(url: str = "url"):
    return F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def site_templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``host, templates``: hashes of the subtrees that recur on many different
    pages of the host. Distinct (host, hash, page) rows are made map-side first,
    so a hot host's template is spread over all tasks. The counts are written, so
    every page is hashed once."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, page, found = [], [], []
            for name, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                fingerprint, each = page_hashes(html or "")
                host.append(name)
                page.append(fingerprint)
                found.append(each)
            yield pa.RecordBatch.from_pydict({"host": pa.array(host, pa.string()), "page": pa.array(page, pa.int64()),
                                              "found": pa.array(found, pa.list_(pa.int64()))})

    seen = (pages.select(host_column().alias("host"), "html").where(F.col("host") != "")
            .mapInArrow(hashes, "host string, page long, found array<long>"))
    # A null hash stands for the page itself and counts the host's different pages.
    rows = seen.select("host", "page", F.explode(F.concat(F.array(F.lit(None).cast("long")), "found")).alias("hash"))
    counts = rows.distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages"))
    most = F.max(F.when(F.col("hash").isNull(), F.col("pages")))
    hosts = scratch.keep(counts.where(F.col("pages") >= MIN_PAGES), "counts")
    total = hosts.groupBy("host").agg(most.alias("total"))
    percent = F.when(F.col("hash").bitwiseAND(F.lit(3)) == LINKS, MIN_PERCENT).otherwise(MIN_BLOCK_PERCENT)
    return (hosts.where(F.col("hash").isNotNull()).join(total, "host")
            .where(F.col("pages") * 100 >= F.col("total") * percent)
            .groupBy("host").agg(F.collect_list("hash").alias("templates")))


def html_extract(pages: DataFrame, names: bool = True) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for every page; ``names=False``:
    by recurring subtrees alone."""
    pages = pages.select("page_id", "url", "html")
    scratch = Scratch(pages.sparkSession, "html-extract")
    templates = scratch.keep(site_templates(pages, scratch), "templates")

    @F.arrow_udf("string")
    def extract(htmls: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for html, found in htmls:
            yield pa.array([page_text(h or "", set(t or ()), names) for h, t in
                            zip(html.to_pylist(), found.to_pylist(), strict=True)], pa.string())

    scratch.outlive()
    return (pages.withColumn("host", host_column()).join(templates, "host", "left")
            .select("page_id", "url", extract("html", "templates").alias("text"))
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))
