"""Main text of web pages by consensus host paths.

Each page's containers are scored by the text they hold outside of links and boilerplate. The scores are
summed per host and generalised path (tags with their classes, digits taken out) in Spark, the best path
of each host is chosen, and every page is extracted again at its host's path. Hosts may have several templates:
pages that lack the path, or hold no text there, use their own best one, and so do pages with little of their text
there if their own path is the choice of several pages of the host or holds as much as a main text of the host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import stored

_names = lambda text: frozenset(text.split())
# Element kinds of the HTML standard, and words that sites use for boilerplate.
VOID = _names("area base br col embed hr img input link meta param source track wbr")
INLINE = _names("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math nobr q rp rt ruby s samp small span "
                "strike strong sub sup time tt u var wbr img")
RAW = _names("script style textarea title noscript iframe noembed noframes xmp template")
SKIPPED = _names("nav header footer aside form button select option menu dialog svg canvas audio video object head") | RAW
CONTAINERS = _names("body main article section div td center blockquote table")
BLOCK_STARTS = _names("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                      "header hr main menu nav ol p pre section summary table ul")
BOILERPLATE = _names("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                     "notices alert popup modal overlay nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer header masthead "
                     "toolbar topbar comment comments commentlist disqus reply replies respond share sharing social related recommended "
                     "newsletter subscribe subscription signup login search pagination pager widget widgets skip copyright")
ROLES = _names("navigation banner contentinfo complementary search form menu menubar dialog alert toolbar")
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<""", re.S)
#: Behind the last closing bracket no tag can end; the groups are there to be empty.
_REST = re.compile(r"<!--.*|[^<]+|<|(?!)()()()()()()", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
#: What follows these in a class name tells of a layout, not of the element itself.
LAYOUT = _names("no has with without")
#: Least share of a host's text a path must hold: an article or main element, and any other container.
SEMANTIC, OTHER = 0.3, 0.8
#: Least share and number of a host's pages that choose a path for another template.
TEMPLATE, TEMPLATE_PAGES = 0.1, 2


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)} if "=" in source else {}


def _is_boilerplate(tag: str, attributes: dict[str, str], source: str) -> int:
    """2: surely, 1: by its name or as a form, unless it turns out to hold the page's main part, 0: no."""
    if tag in SKIPPED and tag != "form":
        return 2
    if tag in ("html", "body", "main", "article") or not source:
        return int(tag == "form")
    if attributes.get("role", "").lower() in ROLES or attributes.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", source):
        return 2
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return 2
    return int(tag == "form" or any(map(_is_named, f"{attributes.get('class', '')} {attributes.get('id', '')}".split())))


def _is_named(name: str) -> bool:
    """Whether a class or id starts or ends with a word for boilerplate."""
    parts = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())
    parts = parts[:next((i for i, w in enumerate(parts) if w in LAYOUT), len(parts))]
    return bool(parts) and (parts[0] in BOILERPLATE or parts[-1] in BOILERPLATE)


class Page:
    """One pass over a page: blocks of kept text, each with the containers it lies in."""

    def __init__(self, source: str):
        #: containers: generalised path, whether article or main, depth
        self.paths: list[tuple[str, int, int]] = [("", 0, 0)]
        #: blocks: text, characters in links, containers from the outermost on
        self.blocks: list[tuple[str, int, tuple[int, ...]]] = []
        # tag, surely skipped, containers, path, elements around it that look like boilerplate
        self._stack: list[tuple[str, bool, tuple[int, ...], str, tuple[int, ...]]] = []
        #: pieces of a block (text, in a link, doubtful elements), pieces and containers of all, doubtful elements of articles and mains
        self._text: list[tuple[str, bool, tuple[int, ...]]] = []
        self._parts: list[tuple[list, tuple[int, ...]]] = []
        self._articles: list[tuple[int, ...]] = []
        self._doubtful = self._links = 0
        self._read(source)
        kept = self._main_parts()
        for pieces, containers in self._parts:
            pieces = [p for p in pieces if kept.issuperset(p[2])]
            if text := " ".join("".join(p[0] for p in pieces).split()):
                self.blocks.append((text, sum(len(p[0]) for p in pieces if p[1]), containers))

    def _top(self) -> tuple[str, bool, tuple[int, ...], str, tuple[int, ...]]:
        return self._stack[-1] if self._stack else ("", False, (0,), "", ())

    def _break(self) -> None:
        if self._text:
            self._parts.append((self._text, self._top()[2]))
            self._text = []

    def _main_parts(self) -> set[int]:
        """Elements named like boilerplate that hold the page's article, or nearly all its text outside links where no article is kept."""
        kept: set[int] = set()
        if not self._doubtful:
            return kept
        sizes, total = [0] * self._doubtful, 0
        for pieces, _ in self._parts:
            for text, linked, doubtful in pieces:
                n = 0 if linked else len(text.strip())
                total += n
                for e in doubtful:
                    sizes[e] += n
        for e in range(self._doubtful):
            if any(e not in a and kept.issuperset(a) for a in self._articles):
                continue
            if any(e in a for a in self._articles) or total and sizes[e] >= OTHER * total:
                kept.add(e)
        return kept

    def _pop(self, to: int) -> None:
        for tag, *_ in self._stack[to:]:
            self._links -= tag == "a"
        if any(tag not in INLINE for tag, *_ in self._stack[to:]):
            self._break()
        del self._stack[to:]

    def _close(self, tag: str, limits: frozenset[str]) -> None:
        """Pop up to an open ``tag`` unless one of ``limits`` lies between."""
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] == tag:
                self._pop(i)
                return
            if self._stack[i][0] in limits:
                return

    def _open(self, tag: str, source: str) -> None:
        if tag in BLOCK_STARTS:
            self._close("p", frozenset(("td", "th", "table", "button", "caption", "object")))
        elif tag in ("li", "td", "th", "tr", "option", "dt", "dd"):
            for same in {"td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(tag, (tag,)):
                self._close(same, frozenset(("ul", "ol", "table", "dl", "select")))
        if tag not in INLINE:
            self._break()
        if tag in VOID:
            return
        _, skipped, containers, path, doubtful = self._top()
        attributes = _attributes(source)
        kind = 0 if skipped else _is_boilerplate(tag, attributes, source)
        skipped = skipped or kind == 2
        if kind == 1:
            doubtful = (*doubtful, self._doubtful)
            self._doubtful += 1
        if tag in ("article", "main") and not skipped:
            self._articles.append(doubtful)
        if tag in CONTAINERS and not skipped:
            kinds = sorted({re.sub(r"\d+", "#", c) for c in attributes.get("class", "").lower().split()})
            path = f"{path}/{'.'.join([tag, *kinds])}"
            self.paths.append((path, int(tag in ("article", "main")), len(containers)))
            containers = (*containers, len(self.paths) - 1)
        self._links += tag == "a"
        self._stack.append((tag, skipped, containers, path, doubtful))

    def _read(self, source: str) -> None:
        at, size, last = 0, len(source), source.rfind(">")
        while at < size:
            m = (_TOKEN if at <= last else _REST).match(source, at)
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                if m[0][0] != "<" or len(m[0]) == 1:
                    _, skipped, _, _, doubtful = self._top()
                    if not skipped:
                        self._text.append((html.unescape(m[0]) if "&" in m[0] else m[0], self._links > 0, doubtful))
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                if tag == "br":
                    self._break()
                elif tag == "p" and not any(t == "p" for t, *_ in self._stack):
                    self._break()
                else:
                    self._close(tag, frozenset())
                continue
            self._open(tag, m[3] or m[6] or "")
            if tag in RAW and (end := _RAW_END[tag].search(source, at)):
                at = end.start()
            elif tag in RAW:
                at = size
        self._pop(0)
        self._break()

    def scores(self) -> dict[tuple[str, int, int], int]:
        """Characters outside links, for each path."""
        found: dict[tuple[str, int, int], int] = {}
        for text, linked, containers in self.blocks:
            for path in {self.paths[c] for c in containers}:
                found[path] = found.get(path, 0) + max(0, len(text) - linked)
        return found

    def at(self, path: str) -> str | None:
        """Text of all containers at a path in page order, or nothing if there is none."""
        own = {i for i, p in enumerate(self.paths) if p[0] == path}
        return " ".join(t for t, _, containers in self.blocks if not own.isdisjoint(containers)) if own else None

    def best(self) -> str:
        """The page's own choice, by the rule of the hosts."""
        scores = self.scores()
        total = max(scores.values(), default=0)
        return max(((rank(s, total, kind), kind and -depth, depth if not kind else 0, s, p) for (p, kind, depth), s in scores.items()), default=(0, 0, 0, 0, ""))[-1]


def rank(score: float, total: float, semantic: int) -> int:
    """2: an article or main element with enough of the text, 1: another container with nearly all, 0: no choice."""
    share = score / total if total else 0.0
    return 2 if semantic and share >= SEMANTIC else int(not semantic and share >= OTHER)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            page = Page(source.as_py())
            own = page.best()
            rows += [(host, path, kind, depth, n, int(path == own)) for (path, kind, depth), n in page.scores().items()]
        types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)],
                                         ["host", "path", "semantic", "depth", "score", "own"])


def _pages(pages: DataFrame, page: str, url: str, source: str) -> DataFrame:
    host = F.regexp_extract(F.lower(F.col(f"`{url}`")), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return pages.select(F.col(f"`{page}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("html"),
                        F.coalesce(host, F.lit("")).alias("host"))


def host_paths(pages: DataFrame) -> DataFrame:
    """The winning path of each host: one vote per page and path, weighted by the text it holds there.

    With it the mean text of a page there, and the own choices of enough pages (at most ten paths).
    """
    voted = pages.select("host", "html").mapInArrow(_votes, "host string, path string, semantic int, depth int, score long, own int")
    summed = voted.groupBy("host", "path", "semantic", "depth").agg(F.sum("score").alias("score"), F.count("*").alias("n"), F.sum("own").alias("own"))
    share = F.col("score") / F.max("score").over(Window.partitionBy("host"))
    place = F.when((F.col("semantic") == 1) & (share >= SEMANTIC), 2).when((F.col("semantic") == 0) & (share >= OTHER), 1).otherwise(0)
    order = F.struct(place, F.when(F.col("semantic") == 1, -F.col("depth")).otherwise(0), F.when(F.col("semantic") == 0, F.col("depth")).otherwise(0),
                     "score", "path")
    template = (F.col("own") >= TEMPLATE_PAGES) & (F.col("own") >= TEMPLATE * F.sum("own").over(Window.partitionBy("host")))
    return (summed.withColumn("order", order).withColumn("template", F.when(template, F.col("path"))).groupBy("host")
            .agg(F.max_by("path", "order").alias("path"), F.max_by(F.col("score") / F.col("n"), "order").alias("mean"),
                 F.collect_set("template").alias("templates")))


def _main_text(page: Page, path: str | None, mean: float | None, templates: list[str] | None) -> str:
    text = page.at(path) if path is not None else None
    if not text:
        return page.at(page.best()) or ""
    held: dict[str, int] = {}
    for (p, _, _), n in page.scores().items():
        held[p] = held.get(p, 0) + n
    if held.get(path, 0) < SEMANTIC * held.get("", 0):
        own = page.best()
        if own in templates or held.get(own, 0) >= SEMANTIC * mean:
            return page.at(own) or text
    return text


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_main_text(Page(source.as_py()), *host) for source, *host in zip(batch.column(2), *(batch.column(i).to_pylist() for i in (3, 4, 5)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["page_id", "url", "text"])


def extract_text(pages: DataFrame, page: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url and main text of every row.

    Null and empty pages give an empty text; pages without a host vote together as one. Repeated rows are
    extracted each. The winners (a row per host) are stored first, so the planner knows their size: small
    ones are sent to all tasks, others are joined with skewed hosts split.
    """
    rows = _pages(pages, page, url, source)
    winners = stored(host_paths(rows), "host-paths")
    kind = rows.schema["page_id"].dataType.simpleString()
    return (rows.join(winners, "host", "left").select("page_id", "url", "html", "path", "mean", "templates")
            .mapInArrow(_extract, f"page_id {kind}, url string, text string"))


def text_report(extracted: DataFrame) -> DataFrame:
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
