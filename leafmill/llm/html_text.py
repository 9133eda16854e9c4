"""Main text of HTML pages, with a style tree for each site.

The element paths of all pages of a host are merged into one style tree.  For each node of
it (a host and a path of tags and classes) two entropies are taken over the host's pages:
of its presentation (the sequence of its children) and of its contents (the text blocks
right under it).  A node whose contents recur on most pages has high content entropy over
pages and so low importance; branches of low importance are removed from each page.

Every block of every page is judged so: it stays if the importance of its node times the
node's weight reaches ``LEAST_IMPORTANCE``.  What tags and class names say of a node's role
only weighs it: ``NEVER`` for what HTML itself sets apart (``nav``, ``footer``, ``form``) and for
names of matter that is no article (``ad``, ``comments``), ``DOUBTFUL`` for names that an article
may bear too (``notice``, ``section-header``), whose nodes go only if they also recur.  A name
does not decide alone.  A marked article (``article``, ``main``) has the weight of its own names
only, whatever a wrapper around it is called, but for comments and what HTML sets apart.  Within
it only names of adverts and comments weigh ``NEVER``, all others are doubtful, and those of
headings and inline elements say nothing.  And where names would leave nothing of an unmarked
page, its text stays.  An element that is not shown, or is a control, has no text.

Pages of a host with the same set of blocks are copies and count once, or else a much copied
article would look like a notice.  The entropies are smoothed by ``PRIOR`` pages with contents
of their own, so there is no least number of pages: what recurs on all of two pages of a host
has importance 0.40, on three 0.25, and what was seen on one page has 1.  The tree of all hosts
together counts as ``ELSEWHERE`` further pages of a host where that speaks for a node: a host of a
few near copies of one article has so its branches judged by what they hold on other hosts.  Blocks that are new
on each page are never of low importance, however alike their presentation.

Shuffled are only hashes: one row for each distinct page, with a hash for each path and distinct
block, then counted in two steps, so that a host with a third of all pages is pre-aggregated on
the map side.  The paths to remove are then joined back by host and salt.

Of a page with marked articles what stays of them is taken, and nothing else, however long
either is; all of them, if the tree would leave nothing.  Marks around links alone are teaser
cards, and no marks.

Defined results: null or empty HTML gives the empty text; character references are decoded
as HTML does (also without a closing semicolon); ``br`` is white space; a block is a
block-level element's run of text, of which inline elements that go leave the rest; comments end as HTML says
(also at ``--!>``); a tag
without its ``>`` ends the markup, what follows is text; unclosed elements end with what
encloses them; rows are independent, so repeated pages give repeated results; null URLs form
one host; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import keep, table
from .url_rules import host_of

PRIOR, LEAST_IMPORTANCE, DECAY = 0.5, 0.3, 0.9
ELSEWHERE = 8  # pages
SALTS = 16

# Element names of HTML by their role.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp noscript".split())
HIDDEN = set(
    "audio button canvas datalist embed head iframe input label map noembed noframes noscript object optgroup option select script "
    "style svg template textarea title video".split()
)
APART = set("aside dialog footer form menu nav".split())
ENDS_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Words in class or id that state a role other than the article's.
ROLES = set(
    "ad ads adbox adslot advert adverts advertisement advertising breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus gdpr infobar masthead modal nav navbar navigation newsletter pager pagination paywall popup promo promoted promotion "
    "recommended replies share sharing sidebar signup site-footer site-header social sponsor sponsored sponsors subscribe subscription "
    "toolbar topbar widget widgets".split()
)
DOUBTFUL_ROLES = ROLES | set(
    "alert banner disclaimer footer header login menu notice notices notification related reply respond search skip teaser".split()
)
COMMENTS = {"comment", "comments", "commentlist", "disqus", "replies"}
ADVERTS = set("ad ads adbox adslot advert adverts advertisement advertising promo promoted promotion sponsor sponsored sponsors".split())
HEADINGS = {f"h{i}" for i in range(1, 7)}
APART_ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
MAIN_ROLES = {"main", "article"}
NEVER, DOUBTFUL = 0.2, 0.6
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"<>]*"|'[^'<>]*')*+)>""")
STOP = re.compile("[>\"']")
COMMENT_END = re.compile("--!?>")
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|itemprop)(?=[\s=/]|$)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


def path_hash(parent: int, name: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{parent}>{name}".encode(), digest_size=8).digest(), "little", signed=True)


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Element:
    __slots__ = ("tag", "path", "hidden", "main", "weight", "firm", "block", "children")

    def __init__(self, tag: str, path: int, hidden: bool, main: bool, weight: float, firm: bool, block: "Element | None"):
        self.tag, self.path, self.hidden, self.main, self.weight, self.firm, self.children = tag, path, hidden, main, weight, firm, []
        self.block = block or self  # the nearest block-level element


class Block(NamedTuple):
    """A run of text: the path of its node, whether it is in a marked article, its weight, whether HTML or comments set it apart, whether all is a link."""

    path: int
    main: bool
    weight: float
    firm: bool
    linked: bool
    text: str


class Page:
    """Blocks of one page, and the children of each path."""

    def __init__(self, html: str | None):
        self.blocks: list[Block] = []
        self.styles: list[tuple[int, str]] = []
        self.stack = [Element("", 0, False, False, 1.0, False, None)]
        self.open: Counter = Counter()
        self.buffer: list[str] = []
        self.linked = True
        if html:
            self.read(html)
        while len(self.stack) > 1:
            self.close()
        self.flush()

    def read(self, html: str) -> None:
        at, ended = 0, set()  # quotes of which there is no more
        while (lt := html.find("<", at)) >= 0:
            if lt > at:
                self.text(html[at:lt])
            if m := TAG.match(html, lt):
                at, closing, tag, attributes = m.end(), m[1], m[2].lower(), m[3]
            elif html.startswith("<!--", lt):
                last = lt + 5 if html.startswith(">", lt + 4) else lt + 6 if html.startswith("->", lt + 4) else 0
                if not last:
                    last = m.end() if (m := COMMENT_END.search(html, lt + 4)) else 0
                if not last:
                    return
                at = last
                continue
            elif html.startswith(("<!", "<?"), lt):
                at = html.find(">", lt) + 1
                if not at:
                    return
                continue
            elif m := NAME.match(html, lt):
                at = self.tag_end(html, m.end(), ended)
                if at < 0:
                    self.text(html[lt:])
                    return
                closing, tag, attributes = html[lt + 1] == "/", m[1].lower(), html[m.end() : at - 1]
            else:
                self.text("<")
                at = lt + 1
                continue
            if closing:
                self.end(tag)
                continue
            self.begin(tag, attributes)
            if tag in RAW:
                last = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = last.end() if last else len(html)
                self.end(tag)
        self.text(html[at:])

    @staticmethod
    def tag_end(html: str, at: int, ended: set[str]) -> int:
        """Where the tag ends whose attributes start at ``at``; -1 if it does not."""
        while (m := STOP.search(html, at)) is not None:
            if m[0] == ">":
                return m.end()
            at = html.find(m[0], m.end()) if m[0] not in ended else -1
            if at < 0:  # an open quote: up to the first >
                ended.add(m[0])
                return html.find(">", m.end()) + 1 or -1
            at += 1
        return -1

    def text(self, raw: str) -> None:
        if not self.stack[-1].hidden:
            self.buffer.append(raw)
            self.linked = self.linked and (self.open["a"] > 0 or not raw.strip())

    def flush(self) -> None:
        if not self.buffer:
            return
        text = " ".join("".join(map(unescape, self.buffer)).split())
        linked, self.linked, self.buffer = self.linked, True, []
        if text:
            top = self.stack[-1].block
            self.blocks.append(Block(top.path, top.main, top.weight, top.firm, linked, text))

    def begin(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag in ENDS_P and self.open["p"]:
            self.end("p")
        if tag in SIBLINGS and any(self.open[x] for x in SIBLINGS[tag]):
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in SIBLINGS[tag]:
                    while len(self.stack) > i:
                        self.close()
                    break
                if self.stack[i].tag in {"ul", "ol", "dl", "table", "select", "menu"}:
                    break
        block = tag in BLOCKS
        if block:
            self.flush()
        top = self.stack[-1]
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        names = sorted({x for k in ("class", "id") for x in found.get(k, "").lower().split()})
        role = found.get("role", "").lower()
        main = top.main or tag in MAIN_ROLES or role in MAIN_ROLES or found.get("itemprop", "").lower() == "articlebody"
        own, firm = self.weight_of(tag, names, role, top.main)
        hidden = top.hidden or tag in HIDDEN or "hidden" in found or (not block and own == NEVER)
        top.children.append(tag)
        name = ".".join([tag, *(x for x in names if not re.search(r"\d", x))])
        if not block:
            own = top.weight
        elif top.firm or top.main or not main:  # an article that begins here hears nothing from above
            own = min(top.weight, own)
        path = path_hash(top.path, name) if block else top.path
        self.stack.append(Element(tag, path, hidden, main, own, top.firm or firm, None if block else top.block))
        self.open[tag] += 1

    @staticmethod
    def weight_of(tag: str, names: list[str], role: str, in_main: bool) -> tuple[float, bool]:
        """What tag, class names and role say against a node, and whether nothing in it may speak for it."""
        if tag in APART or role in APART_ROLES or (tag == "header" and not in_main):
            return NEVER, True
        if in_main and (tag in HEADINGS or tag not in BLOCKS):
            return 1.0, False
        words = set(names)
        if tag in {"body", "html", "article", "main"}:
            words &= {"comment", "comments"}
        parts = {y for x in words for y in re.split(r"[-_]+", x)} if words else words
        firm = bool(words & COMMENTS)
        if firm or words & (ADVERTS if in_main else ROLES) or not in_main and (words | parts) & DOUBTFUL_ROLES:
            return NEVER, firm
        return DOUBTFUL if (words | parts) & DOUBTFUL_ROLES else 1.0, False

    def end(self, tag: str) -> None:
        if self.open[tag]:
            while self.close() != tag:
                pass

    def close(self) -> str:
        top = self.stack[-1]
        if top.block is top:
            self.flush()
            self.styles.append((top.path, ",".join(top.children)))
        self.open[top.tag] -= 1
        return self.stack.pop().tag

    def main_text(self, importance: dict[int, float]) -> str:
        """The text by the importance of each path (1 where there is none)."""
        fine = [b for b in self.blocks if importance.get(b.path, 1.0) * b.weight >= LEAST_IMPORTANCE]
        marked = [b for b in self.blocks if b.main and not b.firm]
        if all(b.linked for b in marked):  # none, or cards
            kept = fine or [b for b in self.blocks if not b.firm]
        else:
            kept = [b for b in fine if b.main] or [b for b in marked if b.weight >= LEAST_IMPORTANCE]
        return "\n".join(b.text for b in kept)


def node_rows(html: str | None) -> tuple[int, list[tuple[int, int, int]]]:
    """A hash of a page's blocks, and its (path, kind, feature), each once: kind 0 the page itself, 1 a style, 2 a block."""
    page = Page(html)
    rows = {(b.path, 2, text_hash(b.text)) for b in page.blocks}
    rows |= {(p, 1, text_hash(s)) for p, s in page.styles}
    contents = text_hash(repr(sorted({b.text for b in page.blocks})))
    return contents, sorted(rows | {(p, 0, 0) for p, _, _ in rows})


def low_paths(pages: DataFrame) -> DataFrame:
    """(host, low): the paths of each host that go, alone or if their weight is doubtful, with their importance; from (host, html)."""
    node = pa.struct([("path", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [node_rows(html.as_py()) for html in batch["html"]]
            nodes = [[dict(zip(("path", "kind", "feature"), r, strict=True)) for r in rows] for _, rows in found]
            yield pa.RecordBatch.from_pydict(
                {
                    "host": batch["host"],
                    "contents": pa.array([x for x, _ in found], pa.int64()),
                    "nodes": pa.array(nodes, pa.list_(node)),
                }
            )

    each = pages.select("host", "html").mapInArrow(
        run, "host string, contents long, nodes array<struct<path:long,kind:int,feature:long>>"
    )
    distinct = each.groupBy("host", "contents").agg(F.min("nodes").alias("nodes"))
    rows = distinct.select("host", F.explode("nodes").alias("node")).select("host", "node.*")
    counts = keep(rows.groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("k")), "site-style-counts")
    own = importances(counts, "host", "path")
    everywhere = importances(counts.groupBy("path", "kind", "feature").agg(F.sum("k").alias("k")), "path")
    known = own.join(everywhere.select("path", F.col("importance").alias("elsewhere")), "path")
    both = F.greatest("importance", (F.col("m") * F.col("importance") + ELSEWHERE * F.col("elsewhere")) / (F.col("m") + ELSEWHERE))
    lows = known.withColumn("importance", both.cast("float")).where(F.col("importance") < LEAST_IMPORTANCE / DOUBTFUL)
    return lows.groupBy("host").agg(F.collect_list(F.struct("path", "importance")).alias("low"))


def importances(counts: DataFrame, *node: str) -> DataFrame:
    """(node, m, importance): the nodes of a style tree that have blocks, with their pages, from (node, kind, feature, k)."""
    k = F.col("k")
    nodes = (
        counts.groupBy(*node)
        .agg(
            F.max(F.when(F.col("kind") == 0, k)).alias("m"),
            F.count_if(F.col("kind") == 1).alias("styles"),
            F.sum(F.when(F.col("kind") == 1, k * F.log(k))).alias("style_log"),
            F.sum(F.when(F.col("kind") == 1, k)).alias("style_n"),
            F.sum(F.when(F.col("kind") == 2, k * F.log(k))).alias("block_log"),
            F.sum(F.when(F.col("kind") == 2, k)).alias("block_n"),
        )
        .where(F.col("block_n") > 0)
    )
    log_m = F.log(F.col("m") + PRIOR)
    presentation = 1 - F.coalesce(F.col("style_log") / (F.col("style_n") + PRIOR), log_m) / log_m
    content = 1 - F.col("block_log") / (F.col("block_n") + PRIOR) / log_m
    weight = F.pow(F.lit(DECAY), F.col("styles"))
    return nodes.select(*node, "m", F.greatest(content, (1 - weight) * presentation + weight * content).alias("importance"))


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of ``pages`` (page_id, url, html)."""
    known = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    low = keep(low_paths(known), "site-style-tree").withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    salted = known.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(low, ["host", "salt"], "left").select("page_id", "url", "html", "low")
    schema = known.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Page(html.as_py()).main_text({x["path"]: x["importance"] for x in low.as_py() or ()})
                for html, low in zip(batch["html"], batch["low"], strict=True)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    return joined.mapInArrow(run, schema)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text and its length in code points of every page."""
    return main_texts(table(spark, sf_dir, "pages"))
