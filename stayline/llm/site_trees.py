"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of styles: a style node is a block element with its class names below its parent's
style node. For every node the host's pages give two entropies, of the child sequences it is presented with and of the texts it
holds, both scaled so that 0 means "the same on every page" and 1 "different on every page". Their weighted mean is the
node's importance. A branch whose importance is under ``least`` of the host's own (its body's) is a template and is removed
from each page. Elements that declare themselves as furniture (menus, headers, footers, sidebars, forms, adverts, notices,
comments, scripts, hidden parts) have importance 0 from the start, and where a page declares its article, only that is read.

Hosts with fewer than ``MIN_PAGES`` pages of a node have no statistics to go by: there only the declarations count. What share
of its host's pages has a node does not matter. Up to ``LISTED`` templates of a host travel as one list with its pages; of a host
with more, each page is given only those among its own nodes, with the same result.

Defined cases: null or empty html and pages without text give the empty text; a null url is a host of its own; unclosed,
misnested or cut-off markup is read as far as it goes; white space of any kind inside a block, line breaks included, is one
space; repeated rows stay repeated; very long pages are read whole.
"""

from __future__ import annotations

import html as html_module
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.session import cut_lineage

MIN_PAGES = 10
LISTED = 1000
LEAST = 0.1
CONTENT_WEIGHT = 0.9
ROOT = 0

# Elements of HTML by how they are laid out, and names that say what a part of a page is for.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img picture source br "
    # Parts of a line that hold no text of it.
    "script style noscript template button select textarea label object canvas svg math audio video map iframe".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
FURNITURE = frozenset(
    "head script style title textarea noscript template iframe nav aside footer form menu dialog button select option "
    "optgroup datalist object embed canvas svg math audio video map fieldset legend".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored sidebar nav navbar "
    "navigation menu submenu breadcrumb breadcrumbs cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "subscription share sharing social related recommended recommendations comment comments commentlist disqus respond footer "
    "masthead topbar toolbar pagination pager widget widgets login signup search skip".split()
)
# A start tag of these ends an open one of the same row.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "p": ("p",),
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)
BARRIER = frozenset("article section main div ul ol dl table body html aside nav form blockquote".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.S
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=\"'/>]+)")


class Frame:
    """An open element."""

    __slots__ = ("article", "dropped", "key", "tag")

    def __init__(self, tag: str, key: int, dropped: bool, article: bool) -> None:
        self.tag, self.key, self.dropped, self.article = tag, key, dropped, article


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, double, single, bare, alone in ATTRIBUTE.findall(raw):
        out.setdefault((name or alone).lower(), html_module.unescape(double or single or bare))
    return out


def _names(attributes: dict[str, str]) -> list[str]:
    return re.split(r"[\s_-]+", f"{attributes.get('class', '')} {attributes.get('id', '')}".lower())


def _is_furniture(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in FURNITURE or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    names = _names(attributes)
    return (
        attributes.get("role", "").lower() in ROLES
        or "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        or not NAMES.isdisjoint(names)
        or not in_article
        and "header" in names
    )


class Page:
    """The blocks of a page in order, each with the style nodes above it, and the child sequences of those nodes."""

    def __init__(self, html: str | None) -> None:
        self.blocks: list[tuple[tuple[int, ...], bool, str]] = []
        self.children: dict[int, list[str]] = {}
        self._stack = [Frame("", ROOT, False, False)]
        self._held: list[str] = []
        self._read(html or "")
        self._flush()

    def _flush(self) -> None:
        text = " ".join("".join(self._held).split())
        self._held = []
        if text:
            keys = tuple(dict.fromkeys(f.key for f in self._stack))
            self.blocks.append((keys, self._stack[-1].article, text))

    def _text(self, raw: str) -> None:
        if raw and not self._stack[-1].dropped:
            self._held.append(html_module.unescape(raw) if "&" in raw else raw)

    def _read(self, html: str) -> None:
        at = 0
        while (tag := TAG.search(html, at)) is not None:
            self._text(html[at : tag.start()])
            at = tag.end()
            name = (tag[2] or "").lower()
            if not name:
                continue
            if tag[1]:
                self._close(name)
                continue
            self._open(name, tag[3])
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                at = end.start() if end else len(html)
        rest = html[at:]
        # A tag that the end of the page cuts off is no text.
        cut = re.search(r"<[A-Za-z/!?]", rest)
        self._text(rest[: cut.start()] if cut else rest)

    def _open(self, tag: str, raw: str) -> None:
        if tag in INLINE:
            if tag == "br":
                self._text(" ")
            if tag not in VOID:
                self._inline(tag, raw)
            return
        self._flush()
        if tag in ENDS_PARAGRAPH:
            self._end(("p",))
        if tag in ENDS and tag != "p":
            self._end(ENDS[tag])
        self._drop_inline()
        attributes, above = _attributes(raw), self._stack[-1]
        style = ".".join([tag, *sorted(re.sub(r"\d+", "", attributes.get("class", "")).lower().split())])
        self.children.setdefault(above.key, []).append(style)
        if tag in VOID:
            return
        article = above.article or tag in ("article", "main")
        dropped = above.dropped or _is_furniture(tag, attributes, above.article)
        key = xxhash.xxh64_intdigest(style.encode(), above.key) >> 1
        self._stack.append(Frame(tag, key, dropped, article))

    def _inline(self, tag: str, raw: str) -> None:
        above = self._stack[-1]
        furniture = (raw.strip() or tag in FURNITURE) and _is_furniture(tag, _attributes(raw), above.article)
        dropped = above.dropped or bool(furniture)
        if dropped != above.dropped:
            self._stack.append(Frame(tag, above.key, dropped, above.article))

    def _drop_inline(self) -> None:
        while len(self._stack) > 1 and self._stack[-1].tag in INLINE:
            self._stack.pop()

    def _end(self, tags: tuple[str, ...]) -> None:
        """Ends the innermost open element of these, unless a container stands between."""
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag in tags:
                del self._stack[i:]
                return
            if self._stack[i].tag in BARRIER:
                return

    def _close(self, tag: str) -> None:
        if tag in INLINE:
            if self._stack[-1].tag == tag:
                self._stack.pop()
            return
        self._flush()
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag == tag:
                del self._stack[i:]
                return

    def own(self) -> list[tuple[tuple[int, ...], str]]:
        """Blocks of the declared article if there is one, else all that nothing declares as furniture."""
        declared = any(article for _, article, _ in self.blocks)
        return [(keys, text) for keys, article, text in self.blocks if article or not declared]

    def text(self, templates: frozenset[int] = frozenset()) -> str:
        return "\n".join(text for keys, text in self.own() if templates.isdisjoint(keys))

    def nodes(self) -> list[tuple[int, int, int]]:
        """Of every style node with text: key, hash of its child sequence, hash of its text."""
        texts: dict[int, xxhash.xxh64] = {}
        for keys, text in self.own():
            for key in keys:
                texts.setdefault(key, xxhash.xxh64()).update(text.encode("utf-8", "surrogatepass") + b"\n")
        return [
            (key, xxhash.xxh64_intdigest(" ".join(self.children.get(key, ())).encode()) >> 1, h.intdigest() >> 1)
            for key, h in texts.items()
        ]


def _with_host(pages: DataFrame, url: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    return pages.withColumn("_host", host)


def importance(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, node, n_pages, importance) of the style tree of every host; the root is node 0."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, kinds, values = [], [], [], []
            for host, page in zip(batch.column("_host"), batch.column("_html"), strict=True):
                for key, shape, content in Page(page.as_py()).nodes():
                    hosts += [host.as_py()] * 2
                    keys += [key, key]
                    kinds += ["shape", "content"]
                    values += [shape, content]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.int64())],
                names=["host", "node", "kind", "value"],
            )

    seen = _with_host(pages, url).select("_host", F.col(html).alias("_html"))
    counted = seen.mapInArrow(nodes, "host string, node long, kind string, value long").groupBy(
        "host", "node", "kind", "value"
    ).count()
    n, same = F.sum("count"), F.sum(F.col("count") * F.log(F.col("count").cast("double")))
    entropy = F.when(n > 1, 1 - same / (n * F.log(n.cast("double")))).otherwise(F.lit(1.0))
    by_kind = counted.groupBy("host", "node", "kind").agg(n.alias("n_pages"), entropy.alias("entropy"))
    weight = F.when(F.col("kind") == "content", CONTENT_WEIGHT).otherwise(1 - CONTENT_WEIGHT)
    return by_kind.groupBy("host", "node").agg(
        F.max("n_pages").alias("n_pages"), F.sum(weight * F.col("entropy")).alias("importance")
    )


def templates(nodes: DataFrame, least: float = LEAST, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, node): the branches of low importance of every host."""
    root = nodes.where(F.col("node") == ROOT).select("host", F.col("importance").alias("host_importance"))
    low = (F.col("n_pages") >= min_pages) & (F.col("importance") < least * F.col("host_importance"))
    return nodes.join(root, "host").where(low).select("host", "node")


def _of_pages(pages: DataFrame, low: DataFrame) -> DataFrame:
    """(_host, _key, _templates): the templates among each page's own nodes, of pages (_host, _key, _html)."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[key for key, _, _ in Page(page.as_py()).nodes()] for page in batch.column("_html")]
            yield pa.RecordBatch.from_pydict(
                {"_host": batch.column("_host"), "_key": batch.column("_key"), "nodes": pa.array(own, pa.list_(pa.int64()))}
            )

    seen = pages.select("_host", "_key", "_html").mapInArrow(nodes, "_host string, _key string, nodes array<long>")
    return (
        seen.select("_host", "_key", F.explode("nodes").alias("node"))
        .join(low.withColumnRenamed("host", "_host"), ["_host", "node"])
        .groupBy("_host", "_key")
        .agg(F.collect_set("node").alias("_templates"))
    )


def main_text(pages: DataFrame, url: str = "url", html: str = "html", listed: int = LISTED) -> DataFrame:
    """The columns of pages but the html, with ``text`` and ``n_chars``; own columns of these names are replaced."""
    # Written, so that its size is known: a small list is broadcast, and otherwise the join can split the pages of a host.
    low = cut_lineage(templates(importance(pages, url, html)))
    long = cut_lineage(low.groupBy("host").count().where(F.col("count") > listed).select(F.col("host").alias("_host")))
    short = low.withColumnRenamed("host", "_host").join(long, "_host", "left_anti")
    found = cut_lineage(short.groupBy("_host").agg(F.collect_list("node").alias("_templates")))
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    own = F.struct(*kept).alias("_page") if kept else F.struct(F.lit(None).alias("_none")).alias("_page")
    rows = _with_host(pages, url).select("_host", own, F.col(html).alias("_html"))
    carried = ["_page", "_html", "_templates"]
    joined = rows.join(found, "_host", "left").select(*carried)
    if not long.isEmpty():
        far = rows.join(long, "_host", "left_semi").withColumn("_key", F.sha2("_html", 256))
        parts = cut_lineage(_of_pages(far, low))
        joined = (
            rows.join(long, "_host", "left_anti")
            .join(found, "_host", "left")
            .select(*carried)
            .unionByName(far.join(parts, ["_host", "_key"], "left").select(*carried))
        )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("_html"), batch.column("_templates"), strict=True)
            texts = [Page(page.as_py()).text(frozenset(low.as_py() or ())) for page, low in rows]
            yield pa.RecordBatch.from_pydict({"_page": batch.column("_page"), "text": pa.array(texts, pa.string())})

    shape = joined.select("_page", F.lit("").alias("text")).schema
    out = joined.mapInArrow(extract, shape)
    return out.select(*(f"_page.`{c}`" for c in kept), "text", F.length("text").cast("long").alias("n_chars"))
