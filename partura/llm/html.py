"""Main text of web pages: what tags and class names say of a branch, and how much it varies over its site.

A site style tree merges the pages of a host: nodes with the same path of tags and classes are one node of the tree. A node's
presentation importance is the entropy of its child layouts over the pages, its content importance that of its
texts, each as a share of the greatest possible. Branches that look and read alike on all pages matter little and go.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partura.llm.shipping import map_arrow
from partura.llm.storage import Workspace

GAMMA = 0.9  # share of content in a node's importance
LEAST = 0.3  # a node of less importance is no main text
PAGES = 5  # different pages from which a node can be judged
BROADCAST_NODES = 200_000

BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = set("script style noscript template svg iframe object textarea select title math canvas noframes".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NOISE_TAGS = set("nav aside footer form dialog menu button head fieldset".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
# Words in a class or id that mark a branch as no main text.
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies copyright discussion disqus dropdown feedback footer form gdpr login menu modal nav navbar navigation newsletter"
    " notice notices pager pagination popup promo promoted recommended recommendations related replies reply respond"
    " search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toc toolbar widget".split()
)
NOISE_OUTSIDE = set("header masthead top topbar".split())  # outside the article only
MAIN_TAGS = {"article": 2, "main": 1}
ROOTS = {"html", "body", "main", "article"}  # no noise by a class word
WRAPPER = 0.9  # a branch marked by a class word that holds so much of a page's text wraps it

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|<[!?/a-zA-Z][^>]*(?:>|\Z)", re.S
)
_RAW_ENDS = {t: re.compile(rf"<(/?){t}(?![a-z0-9-])([^>]*)>?", re.I | re.A) for t in RAW}
_NEXT_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS - {'option'}))})(?![a-z0-9-])", re.I | re.A)
_QUALIFIED = re.compile(r"(?<!\S)(?:no|has|with|without)[-_]\S*", re.I)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}


class Node:
    """An open element that can hold blocks."""

    __slots__ = ("tag", "path", "noise", "marks", "main", "children", "parent")

    def __init__(self, tag: str, path: str, noise: bool, marks: tuple["Node", ...], main: int, parent: "Node | None"):
        self.tag, self.path, self.noise, self.main, self.parent = tag, path, noise, main, parent
        self.marks = marks  # elements around it that a class word marks, itself included
        self.children: list[str] = []


def _marks(tag: str, attributes: str, main: int) -> tuple[bool, bool, str]:
    """Whether an element is noise by its tag, role or hiding, whether by a class word, and its class for the path."""
    inside = main > 0
    noise, worded, label = tag in NOISE_TAGS or (tag == "header" and not inside), False, ""
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name in ("class", "id"):
            words = {w.lower() for w in _PART.findall(_QUALIFIED.sub(" ", value))}
            if tag not in ROOTS or (tag == "article" and main == MAIN_TAGS["article"]):
                worded = worded or bool(words & NOISE_WORDS) or (not inside and bool(words & NOISE_OUTSIDE))
            label += "." + re.sub(r"\d+", "0", value)
        elif name == "role":
            noise = noise or value.lower() in NOISE_ROLES
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            noise = True
        elif name == "style":
            noise = noise or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
    return noise, worded, label


def _raw_ends(page: str, tag: str) -> dict[int, int]:
    """Where each element `tag` ends, by where it starts; an element that is not closed has no end."""
    found, opened = {}, []
    for m in _RAW_ENDS[tag].finditer(page):
        if not m[1]:
            if tag in ("svg", "math") and m[2].endswith("/"):
                continue
            opened.append(m.start())
        elif opened:
            starts = opened if tag in ("script", "style") else opened[-1:]  # text of a script is no markup
            found.update(dict.fromkeys(starts, m.end()))
            del opened[-len(starts) :]
    return found


def blocks(page: str) -> list[tuple[Node, str]]:
    """Runs of text between block tags, in page order, each with the element that holds it; markup may be broken."""
    root = Node("", "", False, (), 0, None)
    now, out, text = root, [], []
    ends: dict[str, dict[int, int]] = {}
    at = 0

    def flush() -> None:
        if text:
            joined = "".join(text)
            line = " ".join((unescape(joined) if "&" in joined else joined).split())
            if line:
                out.append((now, line))
            text.clear()

    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None or "<" in m[3]:  # no element, or a quote left open: that tag ends at the first >
            m = _LOOSE.match(page, m.start())
            if m is None:
                continue
            at, tag = m.end(), m[2]
        tag = tag.lower()
        if m[1]:
            block = tag in BLOCKS
            if block:
                flush()
            holder = now
            while holder is not root and holder.tag != tag:
                if not block and holder.tag in BLOCKS:
                    holder = root
                    break
                holder = holder.parent
            if holder is not root:
                if not block:
                    flush()
                now = holder.parent
            continue
        if tag in RAW:
            if m[3].endswith("/") and tag in ("svg", "math"):
                continue
            if tag not in ends:
                ends[tag] = _raw_ends(page, tag)
            close = ends[tag].get(m.start())
            if close is None and tag not in ("script", "style"):
                block = _NEXT_BLOCK.search(page, at)
                close = block.start() if block else None
            at = len(page) if close is None else max(at, close)
            text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
            continue
        noise, worded, label = _marks(tag, m[3], now.main)
        if tag in BLOCKS:
            flush()
            while now.tag == "p" or now.tag in _CLOSED_BY.get(tag, ()) or (now is not root and now.tag not in BLOCKS):
                now = now.parent
            if tag in _CLOSED_BY:
                holder = now
                while holder is not root and holder.tag not in ("ul", "ol", "dl", "table", "select", *_CLOSED_BY[tag]):
                    holder = holder.parent
                if holder.tag in _CLOSED_BY[tag]:
                    now = holder.parent
            if tag == "body" and now.tag == "head":
                now = now.parent
        elif not (noise or worded) or tag in VOID:
            continue
        else:
            flush()
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        path = f"{now.path}/{tag}{label}"
        now.children.append(path)
        noise = noise or now.noise
        main = 0 if noise else max(now.main, MAIN_TAGS.get(tag, 0), 'role="main"' in m[3])
        now = Node(tag, path, noise, now.marks, main, now)
        if worded:
            now.marks += (now,)
    flush()
    return out


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(errors="replace"), digest_size=8).digest(), "big", signed=True)


def style_nodes(page: str) -> Iterator[tuple[int, int, int]]:
    """(node, layout, content) of each path of a page: hashes of the path, of its children and of its texts."""
    texts: dict[str, list[str]] = {}
    layouts: dict[str, list[str]] = {}
    seen: set[int] = set()
    for node, line in blocks(page):
        while node is not None and node.path:
            texts.setdefault(node.path, []).append(line)
            if id(node) not in seen:
                seen.add(id(node))
                layouts.setdefault(node.path, []).extend(dict.fromkeys(node.children))
            node = node.parent
    for path, lines in texts.items():
        yield _hash(path), _hash("\n".join(layouts[path])), _hash("\n".join(lines))


def _unmarked(found: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """Lines in no branch that a class word marks. Where that leaves no article, a mark around most of the page does not count."""
    ignored: set[int] = set()
    size = sum(len(line) for _, line in found)
    while True:
        marks = [next((k for k in n.marks if id(k) not in ignored), None) for n, _ in found]
        clean = [x for x, k in zip(found, marks) if k is None]
        if any(n.main for n, _ in clean):
            return clean
        held: dict[int, int] = {}
        around = set()
        for (n, line), k in zip(found, marks):
            if k is not None:
                held[id(k)] = held.get(id(k), 0) + len(line)
                if n.main and not k.main:
                    around.add(id(k))
        wraps = {k for k, n in held.items() if n >= WRAPPER * size or k in around and 2 * n > size}
        if not wraps:
            return clean
        ignored |= wraps


def main_text(page: str, low: set[int]) -> str:
    """Lines of the article: of the article and main elements if the page has any, of the whole body otherwise.

    Branches that tags, roles or class names mark as something else go, and everywhere those in `low`; an article that is
    in `low` as a whole stays.
    """
    found = _unmarked([(n, line) for n, line in blocks(page) if not n.noise])
    content = [x for x in found if x[0].main]

    def matters(node: Node | None) -> bool:
        while node is not None:
            if node.path and node.path.count("/") > 2 and node.tag not in ROOTS and _hash(node.path) in low:
                return False
            node = node.parent
        return True

    kept = [x for x in content or found if not low or matters(x[0])]
    return "\n".join(line for _, line in kept or content)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, digest, page in zip(*(c.to_pylist() for c in batch.columns)):
            for node, layout, content in style_nodes(page):
                rows.append((host, node, 0, layout, digest))
                rows.append((host, node, 1, content, digest))
        columns = zip(*rows) if rows else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = ["host", "node", "kind", "value", "digest"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def importance(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance) of the style tree of each host in `pages` (host, html).

    Equal pages of a host count once. A node of one page has importance 1.
    """
    rows = pages.where("host <> ''").select("host", F.xxhash64("html").alias("digest"), "html")
    nodes = map_arrow(rows, _nodes, "host string, node long, kind int, value long, digest long").distinct()
    counts = nodes.groupBy("host", "node", "kind", "value").agg(F.count("*").alias("c"))
    sums = counts.groupBy("host", "node", "kind").agg(
        F.sum("c").alias("m"), F.sum(F.col("c") * F.log(F.col("c").cast("double"))).alias("s")
    )
    m = F.col("m").cast("double")
    entropy = F.when(F.col("m") == 1, 1.0).otherwise((F.log(m) - F.col("s") / m) / F.log(m))
    share = F.when(F.col("kind") == 1, F.lit(GAMMA)).otherwise(F.lit(1 - GAMMA))
    return sums.groupBy("host", "node").agg(F.max("m").alias("pages"), F.sum(entropy * share).alias("importance"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low = [set(x or ()) for x in batch.column(3).to_pylist()]
        texts = [main_text(page, nodes) for page, nodes in zip(batch.column(2).to_pylist(), low)]
        sizes = np.array([len(t) for t in texts], np.int64)
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes)]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each row of `pages` (page_id, url, html).

    Blocks of text are joined by line ends, white space inside a block is one space, character references are decoded. Null or
    empty html gives an empty text. Pages whose url has no host are judged by their own marks alone. Repeated rows
    repeat their result. Pages are parsed twice rather than moved: only hashes of tree nodes are shuffled, and the nodes
    found unimportant come back as a broadcast if they are few, else by a join on the host.
    """
    url = F.col("url").cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", url.alias("url"), html.alias("html"), host.alias("host"))
    ws = Workspace(pages.sparkSession, "html")
    little = (F.col("pages") >= PAGES) & (F.col("importance") < LEAST)
    low = ws.save(importance(rows).where(little).select("host", "node"), "low")
    by_host = low.groupBy("host").agg(F.collect_list("node").alias("low"))
    by_host = F.broadcast(by_host) if low.count() <= BROADCAST_NODES else by_host
    joined = rows.join(by_host, "host", "left").select("page_id", "url", "html", "low")
    kind = pages.schema["page_id"].dataType.simpleString()
    return map_arrow(joined, _extract, f"page_id {kind}, url string, text string, n_chars long")
