"""Main text of web pages by removing site templates.

Every block element's subtree (tags and text) is hashed.  Spark counts, per host,
the different pages that hold each subtree, and subtrees that recur on many pages
of their host are deleted as template.  Elements that say themselves that they
are page furniture (by tag, role, class or id) are deleted whether they recur or not, so they aren't counted.
A class or id is a furniture name only as a whole, or with general words (``ad-box``, ``site-footer``), so
``social-science`` is none; ids of an article's headings, paragraphs and lists name their content and
don't count.
What is left of the article (of the body, if no element is marked as article or
main) is the text.

Paragraphs, headings, lists, quotes and tables inside a marked article are its
flow and stay even if they recur, as sites repeat passages between articles.
Pages with equal main content count once, so copies of a page or of an article under
other menus don't make it a template.  A page's main content is the smallest subtree, or
run of paragraphs, lists, quotes and tables of one parent, with more than half of its
text; a page without one is its own.

Text: character references are decoded, white space inside a block becomes one
space, blocks are joined by one newline in page order.  Broken markup (unclosed
elements, stray end tags, ``<`` in text) is read as browsers do, roughly.

Nulls: a null or empty html gives an empty text; a null url is a host of its own.
Repeated rows give repeated results.  An empty table gives no rows.  Other
columns are not read."""

from __future__ import annotations

import html as htmllib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.llm.store import written

MIN_PAGES = 5  # different pages of a host of any size

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|noscript|template|iframe|svg|select|object|head)\b[^>]*+>.*?(?:</\1\s*>|(?=<body\b)|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[a-z]+")

#: HTML element names, and the names that sites give to page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html"
    " legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption".split())
PASSAGE = frozenset("p ul ol dl blockquote pre table figure".split())
WRAPPER = frozenset("html body main article".split())
FURNITURE_TAGS = frozenset("nav aside footer form menu dialog button label input fieldset legend option optgroup".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer login masthead menu modal"
    " nav navbar navigation newsletter notice notices pagination pager popup promo promoted related replies respond share sharing sidebar signup social sponsor"
    " sponsored subscribe teaser toolbar topbar widget widgets".split()
)
#: Words that don't change what a furniture name says.
GENERAL_NAMES = frozenset("area bar block bottom box btn button buttons container content top global inner item items left link links list main module outer page panel right row section site slot sticky unit wrap wrapper".split())
CLOSES_P = BLOCK - {"body", "html", "option", "optgroup"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div main body html nav aside footer header form".split())


def names_furniture(name: str) -> bool:
    """Whether a class or id is made of furniture names and general words."""
    parts = NAME.findall(name)
    return not FURNITURE_NAMES.isdisjoint(parts) and all(x in FURNITURE_NAMES or x in GENERAL_NAMES for x in parts)


def is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element says that it isn't part of the text."""
    if tag in FURNITURE_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in WRAPPER and tag != "article":
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "class" or name == "id" and not (in_article and tag in FLOW):
            if any(names_furniture(x) for x in value.split()):
                return True
        elif name == "role":
            if value in FURNITURE_ROLES:
                return True
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


class Page:
    """Text blocks of a page, and its block elements with their hash and the blocks they span."""

    def __init__(self, html: str):
        self.blocks: list[str] = []
        self.named: list[bool] = []  # which blocks lie in an element that says it is furniture
        self.elements: list[tuple[int, int, int]] = []  # hash, first block, end block of what may be template
        self.articles: list[tuple[str, int, int]] = []
        self.text: list[str] = []
        # open elements: tag, is furniture, hash parts, first block
        self.open: list[tuple[str, bool, list[str], int]] = []
        self.skip = self.inline = self.in_article = 0  # open furniture, that within a line, and articles
        self.loose: list[str] = []
        self.spans: list[tuple[list[int], list[tuple[int, int]]]] = []  # digests and block spans of what may be the main content
        self.runs: dict[int, tuple[list[str], list[int], list[tuple[int, int]]]] = {}  # the passages of each parent, by its hash parts
        self._read(html)

    def _flush(self) -> None:
        if self.text:
            block = " ".join("".join(self.text).split())
            if block:
                self.blocks.append(block)
                self.named.append(self.skip > 0)
            self.text = []

    def _words(self, raw: str) -> None:
        if not raw:
            return
        text = htmllib.unescape(raw) if "&" in raw else raw
        (self.open[-1][2] if self.open else self.loose).append(text)
        if not self.inline:
            self.text.append(text)

    def _close(self) -> None:
        tag, furniture, parts, first = self.open.pop()
        block = tag in BLOCK
        if block:
            self._flush()
        digest = xxhash.xxh64_intdigest("\x00".join([tag, *parts]).encode("utf-8", "replace")) - (1 << 63)
        around = self.open[-1][2] if self.open else self.loose
        around.append(f"\x01{digest:x}")
        if block and not self.skip and tag not in ("html", "body"):
            self.spans.append(([digest], [(first, len(self.blocks))]))
            if tag in PASSAGE:
                _, digests, spans = self.runs.setdefault(id(around), (around, [], []))
                digests.append(digest)
                spans.append((first, len(self.blocks)))
        if tag in ("article", "main") and not furniture:
            self.in_article -= 1
            if not self.skip:
                self.articles.append((tag, first, len(self.blocks)))
        if furniture:
            self.skip -= 1
            self.inline -= not block
        if block and not furniture and not self.skip and tag not in WRAPPER and not (tag in FLOW and self.in_article):
            self.elements.append((digest, first, len(self.blocks)))

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("article", "main"):
            while self.skip:  # an unclosed menu doesn't swallow the article
                if is_furniture(tag, attributes, False):
                    break
                self._close()
        if tag in CLOSES_P and any(x[0] == "p" for x in self.open[-8:]):
            self._close_to("p")
        for other in CLOSES.get(tag, ()):
            self._close_to(other)
        if tag in VOID:
            if tag in ("br", "hr"):
                self._words(" ")
                if tag == "hr":
                    self._flush()
            return
        furniture = is_furniture(tag, attributes, bool(self.in_article))
        if tag in BLOCK:
            self._flush()
        if furniture:
            self.skip += 1
            self.inline += tag not in BLOCK
        elif tag in ("article", "main"):
            self.in_article += 1
        self.open.append((tag, furniture, [], len(self.blocks)))

    def _close_to(self, tag: str) -> None:
        """Close the nearest open ``tag`` that no other container separates from here."""
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                while len(self.open) > depth:
                    self._close()
                return
            if self.open[depth][0] in SCOPE:
                return

    def _end(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                while len(self.open) > depth:
                    self._close()
                return

    def _read(self, html: str) -> None:
        at = 0
        for m in TOKEN.finditer(html):
            if m.start() > at:
                self._words(html[at : m.start()])
            at = m.end()
            tag = m[3]
            if tag is None:
                continue
            if m[2]:
                self._end(tag.lower())
            else:
                self._start(tag.lower(), m[4])
        self._words(html[at:])
        while self.open:
            self._close()
        self._flush()

    def core(self) -> int | None:
        """Hash of the main content, None if nothing holds more than half of the text."""
        upto = [0]
        for x, named in zip(self.blocks, self.named, strict=True):
            upto.append(upto[-1] + (0 if named else len(x)))
        found = ((sum(upto[b] - upto[a] for a, b in spans), digests) for digests, spans in [*self.spans, *(x[1:] for x in self.runs.values())])
        size, digests = min((x for x in found if 2 * x[0] > upto[-1]), key=lambda x: x[0], default=(0, None))
        return None if digests is None else digests[0] if len(digests) == 1 else xxhash.xxh64_intdigest(repr(digests).encode()) - (1 << 63)

    def main_text(self, template: set[int]) -> str:
        """The blocks of the article (else main, else all) that lie in no template subtree."""
        keep = [False] * len(self.blocks)
        for kind in ("article", "main"):
            spans = [(a, b) for tag, a, b in self.articles if tag == kind]
            if spans:
                break
        else:
            spans = [(0, len(keep))]
        for a, b in spans:
            keep[a:b] = [not x for x in self.named[a:b]]
        for digest, a, b in self.elements:
            if digest in template:
                keep[a:b] = [False] * (b - a)
        return "\n".join(x for x, k in zip(self.blocks, keep, strict=True) if k)


def _host(url: Column) -> Column:
    """The lower-cased host of an address, without user and port; empty if there is none."""
    place = F.coalesce(F.regexp_extract(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit(""))
    return F.lower(F.substring_index(F.substring_index(place, "@", -1), ":", 1))


def subtrees(pages: DataFrame) -> DataFrame:
    """(host, page_hash, core, subtree) of every page's block elements, each once per page."""

    def run(batches):
        for b in batches:
            out = []
            for host, page, html in zip(*(b.column(x).to_pylist() for x in ("host", "page_hash", "html")), strict=True):
                read = Page(html or "")
                core = read.core()
                out += [(host, page, page if core is None else core, digest) for digest in {x[0] for x in read.elements}]
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 4, types, strict=True)], ["host", "page_hash", "core", "subtree"])

    return pages.select("host", "page_hash", "html").mapInArrow(run, "host string, page_hash long, core long, subtree long")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), _host(F.col(url)).alias("host"), F.xxhash64(html).alias("page_hash"))
    found = written(subtrees(rows).distinct(), "subtrees")
    contents = found.select("host", "subtree", "core").distinct()
    template = contents.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_PAGES).select("host", "subtree")
    cuts = found.join(template, ["host", "subtree"]).groupBy("host", "page_hash").agg(F.collect_set("subtree").alias("cut"))
    cuts = written(cuts, "template_cuts")  # of each page under each host only that host's

    def run(batches):
        for b in batches:
            texts = []
            for raw, cut in zip(*(b.column(x).to_pylist() for x in ("html", "cut")), strict=True):
                texts.append(Page(raw or "").main_text(set(cut or ())))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    joined = rows.join(cuts, ["host", "page_hash"], "left").select("page_id", "url", "html", "cut")
    kind = dict(joined.dtypes)["page_id"]
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
