"""HTML main-text extraction (operator 12): removal of site templates by hashes of element subtrees.

Two passes over the pages, each a narrow map over whole texts:

1. Every element subtree with text gets a hash of its tags, labels and text.  Spark counts
   on how many pages of a host each hash stands.  Pages of a host with the same main text
   count once, so copies of a page never make its article a template.
2. Subtrees whose hash is on at least ``MIN_PAGES`` pages and ``MIN_SHARE`` of the host's
   pages are deleted, and so are those that say what they are: by tag (nav, footer, aside,
   form, script ...), role, or class and id (menu, sidebar, cookie, ad, comments ...).  What is
   left inside the main element is cut into blocks.

A host's list of template hashes is at most the subtrees of a page divided by ``MIN_SHARE``.
All lists are broadcast if they have at most ``BROADCAST_HASHES`` entries by count, so that
pages are not moved; beyond that pages meet their host's list in a shuffle join, in which
Spark splits the pages of a large host.  The counts are keyed by host and hash and summed
before they are moved, so a host with a third of all pages is no hot key.

What a template may not take: the main element, what holds it, what holds more than half of
the main text, and the paragraphs, headings, lists and tables inside a main element (an
article's own sentence stays even if many pages quote it).

Defined results: null and empty html gives an empty text; a page without host has no
templates; broken, unclosed and cut-off markup ends where a browser would end it; every row
gives a row, repeated ones too; ids of any type pass; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import giving_back, ship_package, written

MIN_PAGES = 4
MIN_SHARE = 0.1
BROADCAST_HASHES = 1_000_000
BATCH_CHARS = 4 << 20

# HTML's element kinds, and the labels by which sites name what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split())
CELL = frozenset("td th".split())
FLOW = frozenset("blockquote caption dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup li ol p pre table tbody td tfoot th thead tr ul".split())
DROP = frozenset("applet aside audio button canvas datalist dialog fieldset footer form frameset head input map menu meter nav object optgroup option progress search select svg video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog directory form menu menubar navigation search status tablist toolbar tooltip".split())
LABELS = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising adslot adsbygoogle sponsor sponsored sponsors promo promos promotion promoted banner "
    "nav navbar navigation navi menu menus menubar submenu breadcrumb breadcrumbs pagination pager paging toc skip skiplink "
    "footer foot footnav colophon copyright sidebar sidebars sidenav aside rail widget widgets masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification notifications alert popup popover modal overlay lightbox newsletter subscribe subscription signup signin login paywall "
    "comment comments commentlist commentary disqus respond replies reply discussion "
    "share sharing sharebar social socials follow related recommended recommendations trending teaser teasers search searchbox form".split()
)
HEADER_LABELS = frozenset("header heading head".split())
CONTENT_LABELS = frozenset("article articlebody articlecontent articletext post postbody postcontent entry entrycontent story storybody content maincontent main".split())
CLOSED_BY = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",), "option": ("select",)}
SCOPE = frozenset("html table td th button object caption".split())

_ATTRS = r"""[^>"']*(?:(?:"[^"]{0,8192}"|'[^']{0,8192}')[^>"']*)*"""
_TOKEN = re.compile(
    rf"<(?:!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|(?P<raw>script|style|title|textarea|noscript|template|iframe|xmp|noembed|noframes)(?=[\s/>])(?:{_ATTRS}|[^>]*)>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    rf"|(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>{_ATTRS}|[^>]*)>"
    r"|[!?][^>]*>|/[^>a-z][^>]*>|/?[a-z!?][^>]*\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|hidden|aria-hidden|style)(?=[\s=/>]|$)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")
_DIGITS = re.compile(r"\d+")


class Page:
    """The elements of a page in document order, and its texts by element."""

    def __init__(self, source: str, hashed: bool = True):
        self.tags, self.parents, self.labels, self.roles, self.hidden, self.named = ["#page"], [-1], [frozenset()], [""], [False], [""]
        self.pieces: list[tuple[int, str | None]] = []  # (element, text), or None where a block begins or ends
        self.hashes: dict[int, int] = {}
        self._parts: list[list[str]] | None = [[]] if hashed else None
        self._stack, self._open = [0], {}
        pos = 0
        for m in _TOKEN.finditer(source):
            if m.start() > pos:
                self._text(source[pos : m.start()])
            pos = m.end()
            name = m["name"]
            if name is None:
                continue
            if m["end"]:
                self._close(name.lower())
            else:
                self._start(name.lower(), m["attrs"])
        if pos < len(source):
            self._text(source[pos:])
        while len(self._stack) > 1:
            self._pop()

    def _text(self, text: str) -> None:
        if "&" in text:
            text = entities.unescape(text)
        self.pieces.append((self._stack[-1], text))
        if self._parts is not None and (words := text.split()):
            self._parts[-1].append(" ".join(words))

    def _start(self, tag: str, attrs: str) -> None:
        if tag in VOID:
            self.pieces.append((self._stack[-1], None if tag == "hr" else " " if tag == "br" else ""))
            return
        if (tag in BLOCK or tag in CELL) and self._open.get("p"):
            self._imply("p", SCOPE)
        if tag in CLOSED_BY:
            for same in {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,)):
                if self._open.get(same):
                    self._imply(same, CLOSED_BY[tag])
        n = len(self.tags)
        labels, role, hidden, named = frozenset(), "", False, ""
        if attrs and not attrs.isspace():
            words = []
            for key, a, b, c in _ATTR.findall(attrs):
                key, value = key.lower(), a or b or c
                if key in ("class", "id", "itemprop"):
                    words.append(value)
                elif key == "role":
                    role = value.strip().lower()
                else:
                    hidden |= key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and "display:none" in value.replace(" ", "").lower()
            named = " ".join(words)
            if named:
                labels = frozenset(x.lower() for w in named.split() for x in (*_CAMEL.split(w), re.sub("[^A-Za-z]", "", w)))
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.labels.append(labels)
        self.roles.append(role)
        self.hidden.append(hidden)
        self.named.append(named)
        self._stack.append(n)
        self._open[tag] = self._open.get(tag, 0) + 1
        if self._parts is not None:
            self._parts.append([])
        if tag in BLOCK:
            self.pieces.append((n, None))
        elif tag in CELL:
            self.pieces.append((n, " "))

    def _pop(self) -> None:
        n = self._stack.pop()
        tag = self.tags[n]
        self._open[tag] -= 1
        if tag in BLOCK:
            self.pieces.append((n, None))
        if self._parts is not None:
            parts = self._parts.pop()
            if parts:
                h = xxhash.xxh64_intdigest("\x00".join((tag, _DIGITS.sub("0", self.named[n]), *parts)), 42)
                self.hashes[n] = h - (1 << 64) if h >> 63 else h
                self._parts[-1].append(f"\x01{h:x}")

    def _imply(self, tag: str, scope: tuple[str, ...] | frozenset) -> None:
        """End an open element that the next one cannot be inside of."""
        for k in range(len(self._stack) - 1, 0, -1):
            t = self.tags[self._stack[k]]
            if t == tag:
                while len(self._stack) > k:
                    self._pop()
                return
            if t in scope:
                return

    def _close(self, tag: str) -> None:
        if not self._open.get(tag):
            if tag in BLOCK:
                self.pieces.append((self._stack[-1], None))
            elif tag == "br":
                self.pieces.append((self._stack[-1], " "))
            return
        inline = tag not in BLOCK and tag not in CELL
        for k in range(len(self._stack) - 1, 0, -1):
            t = self.tags[self._stack[k]]
            if t == tag:
                while len(self._stack) > k:
                    self._pop()
                return
            if inline and (t in BLOCK or t in CELL):
                return

    def _gone(self, inside: bool, n: int) -> bool:
        """Whether an element says itself that it is no main text."""
        tag, labels = self.tags[n], self.labels[n]
        if tag in DROP or self.hidden[n] or self.roles[n] in ROLES or not LABELS.isdisjoint(labels):
            return True
        return not inside and (tag == "header" or not HEADER_LABELS.isdisjoint(labels))

    def main(self) -> tuple[list[bool], set[int], bool]:
        """By element: is it dropped by what it says; the main elements; and whether these were found at all."""
        n = len(self.tags)
        mains = [k for k in range(1, n) if self.tags[k] == "main" or self.roles[k] == "main"]
        articles = [k for k in range(1, n) if (self.tags[k] == "article" or self.roles[k] == "article") and LABELS.isdisjoint(self.labels[k])]
        chosen = self._outer(mains) or self._outer(articles)
        if not chosen:
            named = [k for k in range(1, n) if self.tags[k] in ("div", "section", "td") and LABELS.isdisjoint(self.labels[k]) and not CONTENT_LABELS.isdisjoint(self.labels[k])]
            if outer := self._outer(named):
                size = self.sizes()
                chosen = {max(outer, key=lambda k: (size[k], -k))}
        holds = set()
        for k in chosen:
            while k > 0:
                holds.add(k)
                k = self.parents[k]
        gone, inside = [False] * n, [False] * n
        for k in range(1, n):
            p = self.parents[k]
            inside[k] = inside[p] or k in chosen
            gone[k] = gone[p] or k not in holds and self.tags[k] not in ("html", "body") and self._gone(inside[k], k)
        found = bool(chosen) and not all(gone[k] for k in chosen)
        self.inside = inside if found else [True] * n
        self.holds = holds
        return gone, chosen if found else set(), found

    def _outer(self, picked: list[int]) -> set[int]:
        """Those that are not inside another one, nor inside what names itself a menu, an aside or the like."""
        picked_set, out = set(picked), set()
        for k in picked:
            p = self.parents[k]
            while p > 0 and p not in picked_set and not (self.tags[p] in DROP or not LABELS.isdisjoint(self.labels[p]) and self.tags[p] not in ("html", "body")):
                p = self.parents[p]
            if p <= 0:
                out.add(k)
        return out or {k for k in picked if self.parents[k] not in picked_set}

    def sizes(self, gone: list[bool] | None = None, within: str | None = None) -> list[int]:
        """Characters of text below each element, of pieces not gone."""
        size = [0] * len(self.tags)
        link = [False] * len(self.tags)
        for k in range(1, len(self.tags)):
            link[k] = self.tags[k] == within or link[self.parents[k]]
        for k, text in self.pieces:
            if text and not (gone and (gone[k] or not self.inside[k])) and (within is None or link[k]):
                size[k] += len(text)
        for k in range(len(self.tags) - 1, 0, -1):
            size[self.parents[k]] += size[k]
        return size

    def blocks(self, gone: list[bool]) -> Iterator[str]:
        held: list[str] = []
        for k, text in self.pieces:
            if text is None:
                if held:
                    if words := "".join(held).split():
                        yield " ".join(words)
                    held = []
            elif not gone[k] and self.inside[k]:
                held.append(text)
        if held and (words := "".join(held).split()):
            yield " ".join(words)

    def without(self, templates: set[int]) -> list[bool]:
        """By element: is it gone, by what it says or as part of the site's template."""
        gone, chosen, found = self.main()
        if not templates and found:
            return gone
        size = self.sizes(gone)
        links = None if found else self.sizes(gone, "a")
        for k in range(1, len(self.tags)):
            gone[k] = gone[k] or gone[self.parents[k]]
            if gone[k] or k in self.holds or k in chosen or self.tags[k] in ("html", "body"):
                continue
            if self.hashes.get(k) in templates and 2 * size[k] <= size[0]:
                gone[k] = not (found and self.inside[k] and self.tags[k] in FLOW) and (self.tags[k] in BLOCK or self.tags[k] in CELL)
            elif links and self.tags[k] in ("ul", "ol", "div", "table") and size[k] and 10 * links[k] >= 8 * size[k]:
                gone[k] = 2 * size[k] <= size[0]  # a list of links in a page that names no main element
        return gone


def subtree_hashes(source: str) -> tuple[int, list[int]]:
    """A hash of the page's main text, and those of its subtrees that could be template."""
    page = Page(source)
    gone, chosen, _ = page.main()
    digest = xxhash.xxh64_intdigest("\n\n".join(page.blocks(gone)), 42)
    picked = {h for k, h in page.hashes.items() if not gone[k] and k not in page.holds and (page.tags[k] in BLOCK or page.tags[k] in CELL) and page.tags[k] not in ("html", "body")}
    return digest - (1 << 64) if digest >> 63 else digest, sorted(picked)


def main_text(source: str, templates: set[int] = frozenset()) -> str:
    """The main text of a page without its host's template subtrees; blocks are two line feeds apart."""
    page = Page(source, hashed=bool(templates))
    return "\n\n".join(page.blocks(page.without(templates)))


def host(url: Column) -> Column:
    """The lower-case host of a URL, null where there is none."""
    found = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1))
    return F.when(found != "", found)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows = [subtree_hashes(x or "") for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("host"), pa.array([d for d, _ in rows], pa.int64()), pa.array([h for _, h in rows], pa.list_(pa.int64()))], ["host", "page", "hashes"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages, lists = (batch.column(c) for c in ("page_id", "url", "html", "hashes"))
        out, first, chars = [], 0, 0
        last_list, templates = None, frozenset()
        for i in range(batch.num_rows):
            hashes = lists[i].as_py()
            if hashes != last_list:
                last_list, templates = hashes, frozenset(hashes or ())
            out.append(main_text(pages[i].as_py() or "", templates))
            chars += len(out[-1])
            if chars >= BATCH_CHARS or i + 1 == batch.num_rows:
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(out)), urls.slice(first, len(out)), pa.array(out, pa.string())], ["page_id", "url", "text"])
                first, out, chars = i + 1, [], 0


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, hashes): the subtree hashes that stand on many pages of a host; ``pages`` has (host, html)."""
    ship_package(pages.sparkSession)
    each = pages.where("host IS NOT NULL").select("host", "html").mapInArrow(giving_back(_hashed), "host string, page long, hashes array<long>")
    distinct = written(each.dropDuplicates(["host", "page"]), "subtrees", compression="zstd")
    total = distinct.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    counts = distinct.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("c")).where(F.col("c") >= min_pages)
    common = counts.join(total, "host").where(F.col("c") >= min_share * F.col("n"))
    return common.groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", broadcast_hashes: int = BROADCAST_HASHES, **how) -> DataFrame:
    """(id, url, text) for each row of pages; ``how`` are the thresholds of ``site_templates``."""
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html")).withColumn("host", host(F.col("url")))
    templates = written(site_templates(rows, **how), "templates")
    size = templates.agg(F.count("*") + F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    held = F.broadcast(templates) if size <= broadcast_hashes else templates
    kinds = dict(rows.dtypes)
    out = rows.join(held, "host", "left").select("page_id", "url", "html", "hashes").mapInArrow(giving_back(_extracted), f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.withColumnsRenamed({"page_id": id_col, "url": url})


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_main_text(pages).withColumn("n_chars", F.length("text").cast("long"))
