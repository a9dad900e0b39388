"""Main text of web pages with site template removal.

1. Every page is parsed once into its element tree. Each block-level subtree of the whole page,
   inside the main content and outside, gets a hash of its tag, class and id, its text and its
   children's hashes.
2. Spark counts, per host, with how many different articles each subtree occurs. An article is
   known by the first of its highest headings in the main element, or without one by the longest
   block outside the subtree. So copies of a page, and versions of an article that differ in
   some paragraphs, count once and do not make the article a template. Subtrees on at
   least ``MIN_PAGES`` pages, with ``MIN_PAGES`` different articles (or all of a host that has
   fewer; two at least) and with ``MIN_SHARE`` of the host's are its template.
3. Template subtrees are deleted, as are elements that by tag, role or class are menus,
   headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader comments.
   What is left of the main element (``article`` or ``main``; the whole body without one) is
   the text. Within a main element a class tells only if one of its names is wholly that of such
   a part (``comments``, ``share-buttons``, not ``share-price``) and the element is a container, not
   a paragraph or other prose; what is written otherwise is left to the count. Labels and buttons
   within prose are words of it, and an open dialog is shown.

Blocks of the main content (a notice or a list of links written as a paragraph or list) are
counted like all others. Versions of one article under different headings are different
articles: where they reach the share above, the paragraphs they have in common go. Pages that
share their highest heading are one article, so on a host where all do nothing goes by its
count. Character references are decoded,
white space inside a block becomes one space, and blocks are joined in page order by one line
feed. Null html and pages without text give an empty string. Null urls share one host. Rows
that repeat give repeated results. Only the id, url and html columns are read.

The parse is written to the shared folder as blocks of text with the subtrees they lie in, so
the second step works on narrow rows. Counts are pre-aggregated on the map side, and a page is
joined with its own template hits on a row number, so no host's pages meet in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import small_batches, stage
from tallyspark.operators.joins import broadcast_if_small

MIN_PAGES = 5
MIN_SHARE = 0.3

# Fixed values of HTML: elements without content, elements that stand in a line, and elements
# that are never part of an article's text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select option textarea input label iframe object "
    "svg canvas dialog menu video audio map".split()
)
UNSEEN = frozenset("head script style noscript template iframe object svg canvas video audio map".split())  # no text of the page
MAIN = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_SIGNS = re.compile(
    r"(?:^|[-_ ])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|"
    r"footer|sidebar|cookies?|consent|notice|gdpr|popup|modal|newsletter|subscribe|share|social|comments?|comment-?list|"
    r"disqus|respond|related|widget)(?:$|[-_ ])"
)
_TOP = re.compile(r"(?:^|[-_ ])(?:header|masthead)(?:$|[-_ ])")  # site headers, outside an article only
# within an article, whole class names of parts that are not its text
_PARTS_INSIDE = re.compile(
    r"(?:^| )(?:(?:post|article|entry|page|site|story)[-_])?"
    r"(?:ads?|adverts?|advertisement|adsense|sponsor(?:ed)?|promo|nav|navbar|navigation|menu|breadcrumbs?|footer|sidebar|cookies?|"
    r"consent|notice|gdpr|popup|modal|newsletter|subscribe|share|sharing|social|comments?|disqus|respond|related|widget)"
    r"(?:[-_](?:area|bar|block|box|buttons?|container|form|icons?|inner|items?|links?|list|media|overlay|panel|posts|articles|section|"
    r"signup|slot|thread|tools|unit|widget|wrap|wrapper))*(?: |$)"
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = frozenset(("p", "li", "dt", "dd", "td", "th", "caption", "figcaption", "blockquote", "pre", "summary", *_HEADINGS))
_IN_PROSE = frozenset(("label", "button"))
# an open element is closed by the start of one of these
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table article main section div body html nav aside footer header form blockquote".split())
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "sign", "items", "role", "parent", "open")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.parent, self.items = tag, parent, []
        self.open = "open" in attrs
        self.sign = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".strip().lower()
        self.role = (attrs.get("role") or "").lower()

    def boilerplate(self, inside_main: bool) -> bool:
        if inside_main:
            if self.tag in _IN_PROSE and self._in_prose() or self.tag == "dialog" and self.open:
                return False
            if self.tag in DROPPED or self.role in _ROLES:
                return True
            return self.tag not in _PROSE and self.tag not in INLINE and self.tag not in MAIN and bool(_PARTS_INSIDE.search(self.sign))
        if self.tag in DROPPED or self.role in _ROLES or self.tag == "header":
            return True
        if self.tag in ("html", "body", *MAIN):
            return False
        return bool(_SIGNS.search(self.sign)) or bool(_TOP.search(self.sign))

    def _in_prose(self) -> bool:
        node = self.parent
        while node is not None and node.tag in INLINE:
            node = node.parent
        return node is not None and node.tag in _PROSE


class TreeBuilder(HTMLParser):
    """Element tree of a page as browsers read it, as far as blocks of text need it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", {}, None)

    def _close_to(self, tags, scope=_SCOPE) -> None:
        node = self.at
        while node.parent is not None and node.tag not in tags:
            if node.tag in scope:
                return
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag not in INLINE and tag not in _IN_PROSE:
            if self.at.tag != "head" or tag not in ("title", "style", "script", "noscript", "template"):
                self._close_to({"p"})
            if tag not in VOID and self.at.tag == "head" and tag not in ("title", "style", "script", "noscript", "template"):
                self.at = self.at.parent
        if tag in _CLOSES:
            self._close_to(_CLOSES[tag])
        if tag in VOID:
            self.at.items.append(" " if tag == "br" else None if tag == "hr" else "")
            return
        node = Node(tag, dict(attrs), self.at)
        self.at.items.append(node)
        self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "path"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID or tag in ("html", "body"):
            return
        node = self.at
        while node.parent is not None and node.tag != tag:
            if tag in INLINE and node.tag not in INLINE:
                return
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.items.append(data)


def parse(html: str | None) -> Node:
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _main_nodes(root: Node) -> list[Node]:
    """Outermost article or main elements in page order, or the whole page."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in MAIN:
            found.append(node)
        else:
            todo += [x for x in reversed(node.items) if isinstance(x, Node) and x.tag not in DROPPED]
    return found or [root]


def _word(digest: bytes) -> int:
    return int.from_bytes(digest, "big", signed=True)


def page_parts(html: str | None) -> tuple[list[str], list[list[int]], list[int], list[int], int]:
    """Blocks of main text, for each the subtrees (by number) that could delete it, the hash of
    each such subtree, the article it lies in, and the article of the page.

    An article is the hash of a heading or block (see above), 0 without any text."""
    blocks: list[str] = []
    within: list[list[int]] = []
    hashes: list[int] = []
    named: list[tuple[str, int]] = []  # the blocks that are headings, with their tags
    held: list[str] = []

    def flush(above, tag=""):
        text = _SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            if tag in _HEADINGS:
                named.append((tag, len(blocks)))
            blocks.append(text)
            within.append(list(above))

    root = parse(html)
    mains = _main_nodes(root)
    whole_page = mains == [root]
    started = {id(m) for m in mains}

    # what is entered: item, hash of the parent, subtrees above, in main, text is kept;
    # what is left: those of the element, its number or None
    todo: list = [("in", root, None, (), False, False)]
    while todo:  # a loop, as pages may nest deeper than Python's stack
        step, item, hashed, above, in_main, kept, *ended = todo.pop()
        if step == "out":
            parent, at = ended
            if kept and item.tag not in INLINE and item.tag not in _IN_PROSE:
                flush(above, item.tag)
            if parent is not None:
                parent.update(hashed.digest())
            if at is not None:
                hashes[at] = _word(hashed.digest())
        elif item is None:
            if kept:
                flush(above)
        elif isinstance(item, str):
            if kept:
                held.append(item)
            if hashed is not None and item:
                hashed.update(" ".join(item.split()).encode("utf-8", "surrogatepass"))
        elif item.tag not in UNSEEN:
            main = id(item) in started
            in_main = in_main or main
            kept = main or (kept and not item.boilerplate(not whole_page))
            block = item.tag not in INLINE
            if block and kept and item.tag not in _IN_PROSE:
                flush(above)
            own = hashlib.blake2b(f"<{item.tag} {item.sign}>".encode("utf-8", "surrogatepass"), digest_size=8)
            at = None
            if block and item is not root:
                at = len(hashes)
                above = (*above, at)
                hashes.append(0)
            todo.append(("out", item, own, above, in_main, kept, hashed, at))
            todo += [("in", x, own, above, in_main, kept) for x in reversed(item.items)]
    flush(())
    names = [_word(hashlib.blake2b(b.encode("utf-8", "surrogatepass"), digest_size=8).digest()) for b in blocks]
    by_length = sorted(range(len(blocks)), key=lambda i: (-len(blocks[i]), names[i]))
    heading = min(named)[1] if named and not whole_page else None
    places: dict[int, list[int]] = {}
    for at, h in enumerate(hashes):
        places.setdefault(h, []).append(at)
    lies_in: dict[int, set[int]] = {}

    def article(gone: list[int]) -> int:
        if heading is not None:
            return names[heading]
        for i in by_length:
            if i not in lies_in:
                lies_in[i] = set(within[i])
            if lies_in[i].isdisjoint(gone):
                return names[i]
        return 0

    outside = {h: article(gone) for h, gone in places.items()}
    return blocks, within, hashes, [outside[h] for h in hashes], article([])


_PARTS = T.StructType(
    [
        T.StructField("blocks", T.ArrayType(T.StringType())),
        T.StructField("within", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("subtrees", T.ArrayType(T.LongType())),
        T.StructField("outside", T.ArrayType(T.LongType())),
        T.StructField("content", T.LongType()),
    ]
)


def parse_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id, url, host, blocks, within, subtrees, outside, content`` of every page."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1 << 20):
            parts = [page_parts(h) for h in batch.column(2).to_pylist()]
            made = [
                pa.array([p[0] for p in parts], pa.list_(pa.string())),
                pa.array([p[1] for p in parts], pa.list_(pa.list_(pa.int32()))),
                pa.array([p[2] for p in parts], pa.list_(pa.int64())),
                pa.array([p[3] for p in parts], pa.list_(pa.int64())),
                pa.array([p[4] for p in parts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["page_id", "url", *_PARTS.names])

    fields = [T.StructField("page_id", pages.schema[id_col].dataType), T.StructField("url", T.StringType())]
    chosen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    parsed = chosen.mapInArrow(extract, T.StructType([*fields, *_PARTS.fields]))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return parsed.withColumn("host", host)


def templates(parsed: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``host, subtree`` of the subtrees that recur, with their counts. Copies and versions of a page
    are one article, so an article copied on many pages does not recur."""
    at = F.explode(F.array_distinct(F.arrays_zip("subtrees", "outside"))).alias("at")
    seen = parsed.select("host", at).select("host", F.col("at.subtrees").alias("subtree"), F.col("at.outside").alias("outside"))
    seen = seen.groupBy("host", "subtree", "outside").agg(F.count(F.lit(1)).alias("pages"))
    counts = seen.groupBy("host", "subtree").agg(F.sum("pages").alias("on_pages"), F.count(F.lit(1)).alias("on_contents"))
    contents = parsed.where("content <> 0").select("host", "content").distinct()
    hosts = contents.groupBy("host").agg(F.count(F.lit(1)).alias("host_contents"))
    recurs = (F.col("on_contents") >= F.least(F.lit(min_pages), "host_contents")) & (F.col("on_contents") >= min_share * F.col("host_contents"))
    often = counts.where((F.col("on_pages") >= min_pages) & (F.col("on_contents") > 1))
    return often.join(broadcast_if_small(hosts), "host").where(recurs)


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    parsed, _ = stage(parse_pages(pages, id_col, url_col, html_col), "parsed-pages")
    template = templates(parsed, min_pages, min_share)
    # at most 1 / min_share times the subtrees of a mean page of the host
    template, _ = stage(template.groupBy("host").agg(F.collect_list("subtree").alias("gone")), "templates")
    none = F.array().cast("array<bigint>")
    pages_ = parsed.join(broadcast_if_small(template), "host", "left").withColumn("gone", F.coalesce("gone", none))
    # numbers of the deleted subtrees of this page, then the blocks that lie in none of them
    gone = F.filter(F.sequence(F.lit(0), F.size("subtrees") - 1), lambda i: F.array_contains("gone", F.get("subtrees", i)))
    gone = F.when((F.size("gone") > 0) & (F.size("subtrees") > 0), gone).otherwise(F.array().cast("array<int>"))
    left = F.filter("blocks", lambda b, i: ~F.arrays_overlap(F.get("within", i), F.col("gone_at")))
    text = F.array_join(F.when(F.size("gone_at") > 0, left).otherwise(F.col("blocks")), "\n")
    out = pages_.withColumn("gone_at", gone).withColumn("text", text)
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
