"""Main text of web pages by consensus of their host.

Pages of a host share a template, so the place of the article is decided together. Each page's
containers are scored (text outside links, most for paragraphs that are long and have commas, a
share of it for the container around), and the best one votes for its generalised path: tag and
classes from the body down, digits replaced. Spark counts the votes per host and path, and every
page is read again from all its elements on the winning path; a page that has none, or no text
in them, falls back on its own best container.

Never read: scripts, styles, comments of the markup, menus, asides, footers, hidden elements, and
headers outside the article. Blocks follow block-level tags; a line break inside a block is white
space. Forms and elements whose class, id or role names adverts, notices, sharing, reader comments
and the like are read, and left out only once the page is known: not ``article``, ``main`` or
``body``, not an element around one of those or around a first heading, and not if nothing else
has any text. A name counts by its first and last word (``comment-list``, ``left-sidebar``) unless
another word says that it is about something (``no-sidebar``, ``has-sidebar``, ``comments-open``).

The best container grows: to the element around it while its neighbours there are text like its
own, so that headline, lead and all parts of a body stay together, and to the ``article`` that it
stands in, or the ``main``.

Defined results: a null page is an empty one and has no text; a page without url shares the
empty host with all others of that kind; a page cut short keeps what is there, without a tag
that is not closed; ties go to the path that is smaller; repeated rows are answered one by one;
an empty table gives an empty one. A page of any length is parsed whole, one at a time; other columns
of the input, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm.tables import beside, read, stage

# Names of elements of the markup language, by how they are treated.
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
SKIPPED = frozenset(
    "head nav aside footer button select option svg math canvas object embed audio video "
    "dialog menu datalist label input fieldset map".split()
) | RAW
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article main section div td body blockquote center".split())
PARAGRAPHS = frozenset("p pre blockquote li dd td h1 h2 h3 h4 h5 h6 figcaption".split())
CLOSED_BY_SELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
                  "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
# Words in class, id or role of blocks that are not part of an article.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promoted "
    "promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer masthead toolbar pagination pager "
    "comment comments commentlist disqus reply replies respond share sharing social related "
    "recommended newsletter subscribe subscription signup login widget skip hidden complementary "
    "contentinfo search".split()
)

# Words that make a name say something about the element rather than name it.
ABOUT = frozenset("no not has with without is open opened closed enabled disabled off on allowed target".split())
ARTICLES = ("article", "main")

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)"
    # Quotes only count after an equals sign; one that is not closed goes on to the end.
    r"|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>=]++|=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|=)*+)(>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    """One element: ``noise`` if its names say that it is no part of an article, ``holds`` if there
    is an article or a first heading in it."""

    tag: str
    path: str
    skipped: bool
    number: int
    parent: int
    noise: bool = False
    holds: bool = False
    score: float = 0.0


@dataclass
class Block:
    """A piece of text, the elements it stands in from the outermost, and how much of it counts."""

    text: str
    inside: tuple[int, ...]
    own: int
    score: float


def _names_noise(name: str) -> bool:
    words = _WORD.findall(name)
    return bool(words) and not ABOUT.intersection(words) and (words[0] in NOISE or words[-1] in NOISE)


def _attributes(raw: str) -> tuple[list[str], bool, bool]:
    """Classes, whether class, id or role names something that is not article text, and whether the
    element is hidden."""
    classes, noise, hidden = [], False, False
    for name, value in _ATTRIBUTE.findall(raw):
        name = name.lower()
        if name in ("class", "id", "role"):
            items = value.strip("\"'").lower().split()
            if name == "class":
                classes = items
            noise = noise or any(_names_noise(item) for item in items)
            hidden = hidden or (name == "class" and "hidden" in items)
        elif name == "aria-hidden" and value.strip("\"'").lower() == "true":
            hidden = True
    # The attribute by itself, not a word in the value of another.
    bare = _ATTRIBUTE.sub(" ", raw).lower().split()
    return classes, noise, hidden or "hidden" in (word.rstrip("/") for word in bare)


class Page:
    """The blocks of a page, each with the elements it stands in, and scored containers."""

    def __init__(self, html: str | None):
        self.blocks: list[Block] = []
        self.nodes: list[Node] = []
        self.stack: list[Node] = [Node("", "", False, -1, -1)]
        self.pending: list[str] = []
        self.pending_linked = 0
        self.links = 0
        self._read(html or "")
        self._flush()
        self._judge()

    def _read(self, html: str) -> None:
        at = 0
        while True:
            found = _TOKEN.search(html, at)
            if found is None:
                self._text(html[at:])
                return
            self._text(html[at : found.start()])
            at = found.end()
            tag = found.group(2)
            if tag is None or not found.group(4):
                # A comment, a declaration, or a tag that the page's end cuts off.
                continue
            tag = tag.lower()
            if found.group(1):
                self._close(tag)
            elif self._open(tag, found.group(3)) and tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
                self._close(tag)

    def _text(self, text: str) -> None:
        if text and not self.stack[-1].skipped:
            self.pending.append(text)
            if self.links:
                self.pending_linked += len(text)

    def _open(self, tag: str, raw: str) -> bool:
        if tag in BLOCKS:
            self._flush()
            self._close_implied(tag)
        elif tag == "br":
            self.pending.append(" ")
        if tag in VOID:
            return False
        parent = self.stack[-1]
        classes, noise, hidden = _attributes(raw) if raw else ([], False, False)
        name = tag + "".join("." + _DIGITS.sub("#", c) for c in sorted(set(classes)))
        # Wrappers that the parser may or may not see do not take part in paths.
        path = parent.path if tag in ("html", "p", "b", "i") else f"{parent.path}/{name}"
        skipped = parent.skipped or tag in SKIPPED or (hidden and tag not in ("html", "body"))
        skipped = skipped or (tag == "header" and not any(n.tag in ARTICLES for n in self.stack))
        node = Node(tag, path, skipped, len(self.nodes), parent.number)
        node.noise = (noise or tag == "form") and tag not in ("html", "body", *ARTICLES)
        if tag in ("article", "main", "h1") and not skipped:
            for around in self.stack:
                around.holds = True
        self.nodes.append(node)
        self.stack.append(node)
        self.links += tag == "a"
        return True

    def _close_implied(self, tag: str) -> None:
        """What a block that begins ends: an open paragraph, an item of the same list."""
        bounds = CLOSED_BY_SELF.get(tag, ())
        for k in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[k].tag
            if open_tag == "p" or (bounds and open_tag == tag):
                self._pop_to(k)
                return
            if open_tag in bounds or (open_tag in BLOCKS and not bounds):
                return

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                self._pop_to(k)
                return
            # An end tag of inline markup does not reach out of its block.
            if tag not in BLOCKS and self.stack[k].tag in BLOCKS:
                return

    def _pop_to(self, k: int) -> None:
        if any(node.tag in BLOCKS for node in self.stack[k:]):
            self._flush()
        for node in self.stack[k:]:
            self.links -= node.tag == "a"
        del self.stack[k:]

    def _flush(self) -> None:
        """End the current block and credit it to the containers around."""
        if not self.pending:
            return
        text = _SPACE.sub(" ", unescape("".join(self.pending))).strip()
        linked = self.pending_linked
        self.pending, self.pending_linked = [], 0
        if not text:
            return
        own = max(0, len(text) - linked)
        block = next((n.tag for n in reversed(self.stack) if n.tag in BLOCKS), "")
        score = own * (1.0 if block in PARAGRAPHS or own > 80 else 0.3) + 10 * text.count(",")
        self.blocks.append(Block(text, tuple(n.number for n in self.stack[1:]), own, score))

    def _judge(self) -> None:
        """Leave out what is noise, now that the whole page is known, and score the containers."""
        noise = {n.number for n in self.nodes if n.noise and not n.holds}
        kept = [b for b in self.blocks if not noise.intersection(b.inside)]
        self.blocks = kept or self.blocks
        for block in self.blocks:
            share = 1.0
            for number in reversed(block.inside):
                node = self.nodes[number]
                if node.tag in CONTAINERS:
                    node.score += block.score * share
                    share /= 2
                    if share < 0.2:
                        break

    def best(self) -> Node | None:
        """The container with the highest score, grown; an article or main counts half as much again."""
        held = [n for n in self.nodes if n.score > 0]
        favour = {"article": 1.5, "main": 1.25}
        found = max(held, key=lambda n: (n.score * favour.get(n.tag, 1.0), -n.number), default=None)
        return self._grown(found) if found else None

    def _around(self, node: Node) -> Iterator[Node]:
        while node.parent >= 0:
            node = self.nodes[node.parent]
            yield node

    def _grown(self, node: Node) -> Node:
        around = list(self._around(node))
        articles = [n for n in around if n.tag in ARTICLES]
        if node.tag == "article" or (node.tag == "main" and not articles):
            return node
        if articles:
            return articles[0]
        for outer in around:
            if outer.tag in ("body", "html", "td", "table", "tr", "tbody"):
                break
            beside = [b for b in self.blocks if outer.number in b.inside and node.number not in b.inside]
            length = sum(len(b.text) for b in beside)
            # Neighbours that are mostly links, or next to nothing, are no reason to grow.
            if outer.tag in CONTAINERS and length and 2 * sum(b.own for b in beside) >= length:
                node = outer
            elif length:
                break
        return node

    def text_in(self, nodes: set[int]) -> str:
        return "\n".join(b.text for b in self.blocks if nodes.intersection(b.inside))

    def on_path(self, path: str) -> set[int]:
        return {n.number for n in self.nodes if n.path == path and not n.skipped and n.tag in CONTAINERS}


def main_text(html: str | None, path: str | None = None) -> str:
    """Main text of one page, read from the elements on a path if it has text there."""
    page = Page(html)
    text = page.text_in(page.on_path(path)) if path else ""
    if text:
        return text
    best = page.best()
    return page.text_in({best.number}) if best else ""


def host_of(url):
    """Host of a url column, lower-cased, without port; '' where there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return host


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = []
        for html in batch.column("html").to_pylist():
            best = Page(html).best()
            paths.append(best.path if best else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array(paths, pa.string())], names=["host", "path"]
        )


def winning_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)``: the path with most votes of each host, counted with map-side combine."""
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    votes = rows.mapInArrow(_votes, "host string, path string").where("path is not null")
    counted = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))
    first = F.min(F.struct((-F.col("votes")).alias("votes"), F.col("path").alias("path")))
    return counted.groupBy("host").agg(first["path"].alias("path"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        html, paths = batch.column("html").to_pylist(), batch.column("path").to_pylist()
        texts = [main_text(h, p) for h, p in zip(html, paths, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """Per row ``page_id, url, text``."""
    paths = beside(stage(winning_paths(pages))).withColumnRenamed("host", "_host")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    joined = rows.join(paths, host_of(F.col("url")) == F.col("_host"), "left")
    return joined.select("page_id", "url", "html", "path").mapInArrow(
        _extract, "page_id bigint, url string, text string"
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``; odd rows as the module says."""
    pages = extracted(read(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("bigint"))
