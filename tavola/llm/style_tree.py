"""Main text of web pages with one style tree per host.

Every page is read into a tree of block elements. An element's *style* is its
tag with its class and id names (digits folded); equal style paths of a host's
pages are one node of the host's style tree. Per node two distributions over
the host's pages are counted: what its branch contains (content) and which
styles its children have (presentation). A node's importance is the larger of
their entropies, each divided by the entropy of all pages differing. Markup that
names its purpose (nav, footer, class "ad", ...) has no importance.

Branches of low importance leave each page: named ones always, others where at
least ``MIN_PAGES`` pages of the host hold the node and its importance is below
``IMPORTANCE``. A flow element (a paragraph, heading, list, ...) without a class
is never a template branch, an article is none, and entropy only counts where
the host's pages and articles themselves differ: pages that repeat an article,
or a line that many articles share, lose nothing, and no page loses its whole
text to entropy. Of what is left a
page's article is kept (the article element, else the main one, else one whose
class says so), or all of it if nothing is marked so, without lists made of
links.

Counts are grouped by host, path and hash and are pre-aggregated, so a host
with a third of all pages is a few rows per task; pages are joined with their
host's few noise paths. Null html gives an empty text; a page without a host in
its url is judged by its markup alone; every page row has a result row.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm.common import map_arrow, park, table

MIN_PAGES = 5
IMPORTANCE = 0.3
VARIED = 0.5
LINK_SHARE = 0.8

# Element kinds of HTML and names that pages give to their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var".split())
DROPPED = frozenset("script style noscript template iframe object svg math head title textarea select option button "
                    "datalist audio video canvas map dialog".split())
NAMED = frozenset("nav footer aside form menu".split())
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption "
                 "caption hr address details summary".split())
NOISE = frozenset("nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising "
                  "banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
                  "newsletter subscribe signup login search social share sharing related recommended breadcrumb breadcrumbs "
                  "pagination pager comment comments disqus reply replies respond widget toolbar skip copyright form".split())
CONTENT = frozenset("article post entry story content articlebody main".split())
INSIDE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
          "option": ("select",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}
TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(script|style|textarea|title|iframe|noscript|template|svg|math)\b[^>]*+(?:>.*?(?:</\1\b[^>]*+>|\Z)|\Z)"""
                   r"""|<(/?)([a-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?][^>]*+(?:>|\Z)|([^<]++|<)""", re.I | re.S)
ATTRIBUTE = re.compile(r"""([a-z:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@lru_cache(maxsize=50_000)
def style(tag: str, attrs: str) -> tuple[str, int, bool]:
    """Label, content level (0 to 3) and whether the markup names the element as something else."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attrs)}
    names = f"{found.get('class', '')} {found.get('id', '')}"
    label = tag + "".join("." + x for x in sorted(set(re.sub(r"\d+", "#", names).lower().split())))
    said = set(re.split(r"[^a-z]+", f"{names} {found.get('role', '')} {found.get('itemprop', '')}".lower()))
    level = 3 if tag == "article" or "articlebody" in said else 2 if tag == "main" or found.get("role", "").lower() == "main" else \
        1 if said & CONTENT else 0
    named = tag in NAMED or tag in DROPPED or (tag not in ("html", "body") and bool(said & NOISE) and not said & CONTENT)
    if said & {"comment", "comments", "reply", "replies"}:
        named, level = tag not in ("html", "body"), 0
    hidden = re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attrs) or "display:none" in attrs.replace(" ", "").lower()
    return label, level, named or bool(hidden)


class Block:
    """A block's text, the style path and content level of its element, and what is known of it."""

    __slots__ = ("text", "path", "level", "outside", "named", "links")

    def __init__(self, text, path, level, outside, named, links):
        self.text, self.path, self.level, self.outside, self.named, self.links = text, path, level, outside, named, links


def read(html: str) -> list[Block]:
    """The text blocks of a page in order, with the style path that holds them."""
    blocks: list[Block] = []
    # tag, path, level, named, elements of the path that lie outside of or are a marked article
    stack: list[tuple[str, str, int, bool, int]] = [("", "", 0, False, 0)]
    parts: list[str] = []
    linked, in_link = 0, False

    def flush():
        nonlocal linked, in_link
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                _, path, level, named, outside = stack[-1]
                blocks.append(Block(text, path, level, outside, named, linked >= LINK_SHARE * len(text)))
            parts.clear()
        linked, in_link = 0, False

    for m in TOKEN.finditer(html):
        text = m[5]
        if text is not None:
            text = unescape(text) if "&" in text else text
            parts.append(text)
            if in_link:
                linked += len(text.strip())
            continue
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            if tag == "a":
                in_link = False
            if tag in INLINE:
                continue
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if tag in FLOW and stack[i][0] not in FLOW:
                    break
        elif tag in INLINE:
            if tag == "a":
                in_link = True
        elif tag == "br":
            parts.append(" ")
        elif tag in VOID:
            if tag == "hr":
                flush()
        else:
            flush()
            if stack[-1][0] == "p":
                stack.pop()
            if tag in INSIDE:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag or tag in ("dt", "dd") and stack[i][0] in ("dt", "dd"):
                        del stack[i:]
                        break
                    if stack[i][0] in INSIDE[tag]:
                        break
            label, level, named = style(tag, m[4])
            _, path, outer, lost, outside = stack[-1]
            if tag == "header" and not outer:
                named = True
            if m[4].endswith("/") and tag not in FLOW and tag != "div":
                continue
            deeper = tag not in ("html", "body")
            stack.append((tag, f"{path}/{label}" if deeper else path, max(level, outer), named or lost,
                          outside if outer else outside + deeper))
    flush()
    return blocks


def tree_nodes(blocks: list[Block]) -> dict[str, tuple[int, int, int]]:
    """Per style path of a page: hash of the branch's text, hash of its children's styles, and its place.

    The place is 0 outside of articles, 1 inside of one, 2 for an article or what holds one; the page itself is "/".
    """
    content: dict[str, xxhash.xxh64] = {"/": xxhash.xxh64()}
    children: dict[str, dict[str, None]] = {}
    place: dict[str, int] = {"/": 2}
    for b in blocks:
        if b.named:
            continue
        path, data = b.path, b.text.encode("utf-8", "surrogatepass") + b"\n"
        content["/"].update(data)
        depth = path.count("/")
        while path:
            content.setdefault(path, xxhash.xxh64()).update(data)
            up = path.rpartition("/")[0]
            children.setdefault(up or "/", {})[path] = None
            at = 0 if not b.level else 1 if depth > b.outside else 2
            place[path] = max(place.get(path, 0), at)
            path, depth = up, depth - 1
    return {p: (h.intdigest() - (1 << 63), xxhash.xxh64("|".join(children.get(p, ()))).intdigest() - (1 << 63), place[p])
            for p, h in content.items()}


def style_trees(pages: DataFrame) -> DataFrame:
    """host, path, pages, importance, place of every node of every host's tree."""
    def fn(batch: pa.RecordBatch):
        out = {"host": [], "path": [], "content": [], "look": [], "place": []}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if html:
                for path, (content, look, place) in tree_nodes(read(html)).items():
                    for k, v in zip(out, (host, path, content, look, place)):
                        out[k].append(v)
        yield out

    nodes = park(map_arrow(pages.filter("host <> ''").select("host", "html"), fn,
                           "host string, path string, content long, look long, place int"))

    def entropy(kind: str) -> DataFrame:
        n = nodes.groupBy("host", "path", kind).agg(F.count("*").alias("n"), F.max("place").alias("place"))
        return n.groupBy("host", "path").agg(F.sum("n").alias("pages"), F.max("place").alias("place"),
                                             F.expr("log(sum(n)) - sum(n * log(n)) / sum(n)").alias(f"h_{kind}"))
    both = entropy("content").join(entropy("look").select("host", "path", "h_look"), ["host", "path"])
    most = F.when(F.col("pages") > 1, F.greatest("h_content", "h_look") / F.log("pages")).otherwise(1.0)
    return both.select("host", "path", "pages", "place", most.alias("importance"))


def noise_paths(trees: DataFrame, min_pages: int = MIN_PAGES, importance: float = IMPORTANCE) -> DataFrame:
    """host, noise: the style paths of a host whose branches leave its pages.

    Bare flow elements, articles and what holds an article are never among them, nor is anything of a host whose
    pages (or, inside articles, whose articles) mostly repeat one another.
    """
    trees = trees.filter(F.col("pages") >= min_pages)
    bare = F.element_at(F.split("path", "/"), -1).isin(*sorted(FLOW))
    hosts = trees.filter("place = 2").groupBy("host").agg(F.min("importance").alias("varied"))
    low = trees.filter((F.col("place") < 2) & (F.col("importance") < importance) & ~bare)
    return (low.join(hosts, "host").filter(F.col("varied") >= VARIED)
            .groupBy("host").agg(F.collect_set("path").alias("noise")))


def article(html: str | None, noise: frozenset[str]) -> str:
    """The kept blocks of a page, joined by empty lines."""
    blocks = [b for b in read(html or "") if not b.named]
    top = max((b.level for b in blocks), default=0)
    left = [b for b in blocks if b.level == top and (top or not b.links)]
    kept = []
    for b in left:
        path, cut = b.path, False
        while path and noise and not cut:
            cut, path = path in noise, path.rpartition("/")[0]
        if not cut:
            kept.append(b)
    return "\n\n".join(b.text for b in kept or left)


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, importance: float = IMPORTANCE) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), host.alias("host"))
    noise = park(noise_paths(style_trees(pages), min_pages, importance))

    def fn(batch: pa.RecordBatch):
        text = [article(html, frozenset(bad or ())) for html, bad in
                zip(batch.column("html").to_pylist(), batch.column("noise").to_pylist())]
        text = [t.encode("utf-8", "replace").decode() for t in text]
        yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": text, "n_chars": [len(t) for t in text]}

    return map_arrow(pages.join(noise, "host", "left").select("page_id", "url", "html", "noise"), fn,
                     "page_id long, url string, text string, n_chars long")


def op5_style_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
