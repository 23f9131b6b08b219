"""Main text of web pages by tag-path ratios.

The text nodes of a page are grouped by their root-to-leaf tag path. Each path has two ratios, characters and
punctuation marks per text node; both are smoothed over neighbouring paths, fused into one weight, and the paths above
a threshold mark content. The content node is the deepest container that holds all of the marked text, but never one
inside the innermost article or main around that text, nor one whose parent still has a heading. Directly below the body
a block with nine tenths of it is enough if the rest is in plain blocks of other paths (imprints). The article is every block inside it, short ones too, apart from the subtrees that are never part of an article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyridge.llm.tables import slices

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|title|xmp|noembed)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.I | re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，！？；：、]")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike "
                   "strong sub sup time tt u var wbr label".split())
#: Tags whose start ends an open element of the second column (within the nearest container).
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
BLOCK_ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                         "h5 h6 header hr main menu nav ol p pre section table ul".split())
CONTAINERS = frozenset("html body main article section div center table tbody tr td".split())
NEVER = frozenset("head nav footer header aside form button select menu dialog fieldset object canvas audio video".split())
#: Words of class, id or role that name what is not the article.
NOISE = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent "
                  "cookie cookies copyright disclaimer discussion disqus footer gdpr header masthead menu modal nav navbar navigation "
                  "newsletter notice notices pager pagination popup promo promoted promotion recommended related replies reply "
                  "respond share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar widget widgets "
                  "alert contentinfo complementary search".split())
WORDS = re.compile(r"[a-z]+")
SMOOTHING = (0.25, 0.5, 0.25)
THRESHOLD, HELD = 0.7, 0.9
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _noise(tag: str, names: str) -> bool:
    if tag in NEVER:
        return True
    if tag in ("html", "body", "main", "article") or not names:
        return False
    spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()
    return not NOISE.isdisjoint(WORDS.findall(spaced))


class Page:
    """Elements (parent, tag, whether it is noise) and text nodes (element, path, text) of a page, in order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.noise, self.path = [-1], [""], [False], [0]
        self.paths: dict[tuple[int, str], int] = {}
        self.nodes: list[tuple[int, str]] = []  # element, text; a block border is the text " "
        stack, at = [0], 0
        for m in MARKUP.finditer(source):
            if m.start() > at:
                self.nodes.append((stack[-1], source[at:m.start()]))
            at = m.end()
            if m["tag"]:
                self._step(stack, m["tag"].lower(), bool(m["end"]), m["attrs"])
        if at < len(source):
            self.nodes.append((stack[-1], source[at:]))

    def _step(self, stack: list[int], tag: str, ends: bool, attrs: str) -> None:
        if tag not in INLINE:
            self.nodes.append((stack[-1], " "))
        if tag in VOID:
            return
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if self.tag[stack[k]] == tag:
                    del stack[k:]
                    break
            return
        closes = CLOSES.get(tag, {"p"} if tag in BLOCK_ENDS_P else None)
        if closes:
            for k in range(len(stack) - 1, 0, -1):
                own = self.tag[stack[k]]
                if own in closes:
                    del stack[k:]
                    break
                if own in CONTAINERS and not (tag in ("tr",) and own in ("tr", "td")) or own in ("ul", "ol", "dl", "table", "blockquote"):
                    break
        up = stack[-1]
        names = " ".join(a or b or c for a, b, c in NAMED.findall(attrs)) if "=" in attrs else ""
        self.parent.append(up)
        self.tag.append(tag)
        self.noise.append(self.noise[up] or _noise(tag, names))
        step = (self.path[up], "" if tag in INLINE else f"{tag}.{names}" if names else tag)
        self.path.append(self.path[up] if tag in INLINE else self.paths.setdefault(step, len(self.paths) + 1))
        stack.append(len(self.tag) - 1)


def _smoothed(x: np.ndarray) -> np.ndarray:
    if len(x) == 1:
        return x
    padded = np.concatenate((x[:1], x, x[-1:]))
    return SMOOTHING[0] * padded[:-2] + SMOOTHING[1] * padded[1:-1] + SMOOTHING[2] * padded[2:]


def content_paths(sizes: np.ndarray, marks: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Which paths are content: smoothed characters per node times smoothed punctuation per node, above a share of
    their standard deviation. Without any punctuation the characters decide alone."""
    lengths, points = _smoothed(sizes / nodes), _smoothed(marks / nodes)
    fused = lengths * points if points.any() else lengths
    return (fused >= THRESHOLD * fused.std()) | (fused == fused.max())


def main_text(source: str) -> str:
    """The article's text; empty for an empty page."""
    page = Page(source)
    texts = [(e, html.unescape(t) if "&" in t else t) for e, t in page.nodes]
    order: dict[int, int] = {}
    rows = []
    for e, t in texts:
        if not page.noise[e] and (size := len("".join(t.split()))):
            rows.append((order.setdefault(page.path[e], len(order)), size, len(PUNCTUATION.findall(t)), e))
    if not rows:
        return ""
    table = np.array(rows)
    sums = [np.bincount(table[:, 0], w) for w in (table[:, 1], table[:, 2], None)]
    chosen = content_paths(*sums)
    weight = np.zeros(len(page.tag))
    np.add.at(weight, table[:, 3], np.where(chosen[table[:, 0]], table[:, 1], 0))
    children: dict[int, list[int]] = {}
    for e in range(len(weight) - 1, 0, -1):
        weight[page.parent[e]] += weight[e]
        if weight[e] and page.tag[e] in CONTAINERS:
            children.setdefault(page.parent[e], []).append(e)
    way = [0]
    while (own := children.get(way[-1])) is not None:
        inner = max(own, key=lambda e: weight[e])
        rest = [e for e in own if e != inner]
        plain = (page.tag[way[-1]] in ("", "html", "body") and sum(weight[e] for e in own) == weight[way[-1]]
                 and all(page.tag[e] not in ("article", "main", "section") and page.path[e] != page.path[inner] for e in rest))
        if weight[inner] < (HELD if plain else 1) * weight[way[-1]]:
            break
        way.append(inner)
    named = [k for k, e in enumerate(way) if page.tag[e] in ("article", "main")]
    if named:
        root = way[named[-1]]
    else:
        headed = {page.parent[e] for e in {int(e) for e in table[:, 3]} if page.tag[e] in HEADINGS}
        root = next((e for e in way[:-1] if page.tag[e] in ("div", "section") and e in headed), way[-1])
    inside = [False] * len(page.tag)
    for e in range(len(inside)):
        inside[e] = e == root or e > 0 and inside[page.parent[e]]
    return " ".join("".join(t if inside[e] and not page.noise[e] else " " for e, t in texts).split())


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` but the markup, and ``text``, ``n_chars`` (code points).

    A null or empty page, or one without any text outside the left-out parts, has an empty text. Repeated rows stay.
    Columns named ``text`` or ``n_chars`` are replaced.
    """
    kept = pages.drop("text", "n_chars", html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            texts = [main_text(t) if t else "" for t in batch.column("__html").to_pylist()]
            out = batch.drop_columns(["__html"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             [*out.schema.names, "text", "n_chars"])

    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    source = pages.drop("text", "n_chars") if html_col not in ("text", "n_chars") else pages
    return source.withColumn("__html", F.col(html_col).cast("string")).select(*kept.columns, "__html").mapInArrow(run, schema)
