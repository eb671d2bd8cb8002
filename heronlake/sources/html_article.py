"""Articles from HTML: JSON-LD, meta tags, body selectors; as a parser of one page and as an operator over pages."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.functions import vocab as V
from heronlake.functions.text import clean_content, trimmed
from heronlake.functions.times import iso, to_utc
from heronlake.functions.urls import category_of_url, domain
from heronlake.sources.readability import main_text

#: Elements that hold a page's fields.
HEADS = frozenset("script meta title time".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening tag of their kind closes, and what keeps it from doing so.
SELF_CLOSING = frozenset(("p", "li"))
ENCLOSING = frozenset("article aside blockquote body div figure footer form header li main nav ol section table td th ul".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, sep: str = " ", skip=lambda n: False) -> str:
        if len(self.children) == 1 and isinstance(self.children[0], str):
            return "" if skip(self) else self.children[0].strip()
        parts, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if s := node.strip():
                    parts.append(s)
            elif not skip(node):
                stack += reversed(node.children)
        return sep.join(parts)

    def matches(self, simple: str) -> bool:
        tag, _, rest = simple.partition(".")
        return (not tag or self.tag == tag) and (not rest or rest in self.attrs.get("class", "").split())


class Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("", {}, None)
        #: The HEADS in the page's order: a node is always put at the end of what is there.
        self.heads: list[Node] = []

    def updatepos(self, i, j):
        """Nobody asks for lines and columns."""
        return j

    def _put(self, tag, attrs) -> Node:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.now)
        self.now.children.append(node)
        if tag in HEADS:
            self.heads.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        at = self.now if tag in SELF_CLOSING else None
        while at is not None and at.tag != tag:
            at = None if at.tag in ENCLOSING else at.parent
        if at is not None:
            self.now = at.parent
        node = self._put(tag, attrs)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag, attrs):
        self._put(tag, attrs)

    def handle_endtag(self, tag):
        at = self.now
        while at.parent is not None and at.tag != tag:
            at = at.parent
        if at.parent is not None:
            self.now = at.parent

    def handle_data(self, data):
        self.now.children.append(data)


def tree_of(html: str) -> Tree:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree


def parse(html: str) -> Node:
    return tree_of(html).root


def select_one(root: Node, selector: str) -> Node | None:
    """The first node of a selector of tags, classes and descendants."""
    *outer, last = selector.split()
    for node in root.walk():
        if not node.tag or not node.matches(last):
            continue
        up, left = node.parent, list(outer)
        while up is not None and left:
            if up.tag and up.matches(left[-1]):
                left.pop()
            up = up.parent
        if not left:
            return node
    return None


def _loads(text: str):
    for attempt in (text, re.sub(r",\s*([}\]])", r"\1", text)):
        try:
            return json.loads(attempt)
        except ValueError:
            continue
    return None


def _name(value) -> str:
    if isinstance(value, list):
        value = value[0] if value else ""
    return str(value.get("name", "")) if isinstance(value, dict) else str(value)


def _words(value) -> list[str]:
    items = value if isinstance(value, list) else str(value).split(",") if isinstance(value, str) else []
    return [s for s in (str(x).strip() for x in items if x) if s]


def from_jsonld(heads: list[Node]) -> dict:
    """Fields of the page's articles in JSON-LD; the first object that has a field gives it."""
    out: dict = {}
    readers = {
        "headline": ("title", lambda v: str(v).strip()), "datePublished": ("published_at", str), "author": ("author", _name),
        "articleSection": ("category_raw", lambda v: str(v[0] if v else "") if isinstance(v, list) else str(v)), "keywords": ("keywords", _words), "articleBody": ("content", str),
    }
    for node in heads:
        if node.tag != "script" or node.attrs.get("type") != "application/ld+json":
            continue
        data = _loads("".join(c for c in node.children if isinstance(c, str)))
        for item in data if isinstance(data, list) else [data]:
            kind = item.get("@type", "") if isinstance(item, dict) else ""
            if "Article" not in (" ".join(map(str, kind)) if isinstance(kind, list) else str(kind)):
                continue
            for key, (field, read) in readers.items():
                if key in item and field not in out:
                    out[field] = read(item[key])
    return out


def from_meta(heads: list[Node]) -> dict:
    """Fields of meta tags, the title and a time element."""
    metas: dict[tuple[str, str], str] = {}
    title = moment = None
    for node in heads:
        if node.tag == "meta" and node.attrs.get("content"):
            for kind in ("property", "name", "itemprop"):
                if kind in node.attrs:
                    metas.setdefault((kind, node.attrs[kind]), node.attrs["content"].strip())
        elif node.tag == "title" and title is None:
            title = node.text("")
        elif node.tag == "time" and node.attrs.get("datetime") and moment is None:
            moment = node.attrs["datetime"]
    times = [metas.get(k) for k in (("property", "article:published_time"), ("itemprop", "datePublished"), ("name", "pubdate"), ("name", "publish-date"))]
    out = {
        "title": metas.get(("property", "og:title")) or title, "times": [t for t in (*times, moment) if t],
        "category_raw": metas.get(("property", "article:section")), "keywords": _words(metas.get(("name", "keywords"), "")),
        "author": metas.get(("name", "author")) or metas.get(("property", "article:author")),
    }
    return {k: v for k, v in out.items() if v}


def _is_noise(node: Node) -> bool:
    return node.tag in V.NOISE_TAGS or node.attrs.get("id") in V.NOISE_IDS or any(c in V.NOISE_CLASSES for c in node.attrs.get("class", "").split())


def body_text(root: Node, selectors: list[str]) -> str:
    """Paragraphs of over 10 characters of the first selector that fits, or else all its text; without noise."""
    for selector in selectors:
        body = select_one(root, selector)
        if body is None:
            continue
        hidden, paragraphs = set(), []
        for node in body.walk():
            if id(node.parent) in hidden or _is_noise(node):
                hidden.add(id(node))
            elif node.tag == "p":
                paragraphs.append(node.text(" ", _is_noise))
        return " ".join(p for p in paragraphs if len(p) > 10) or body.text(" ", _is_noise)
    return ""


def extract(html: str | None, url: str | None, selectors: dict[str, list[str]] = V.BODY_SELECTORS) -> dict:
    """JSON-LD, then meta tags for what is missing, then the site's selectors, then for short bodies the page's main text
    if that is longer. content_from tells which gave the content: json-ld, site or page."""
    if not html:
        return {}
    tree = tree_of(html)
    root = tree.root
    out = from_jsonld(tree.heads)
    meta = from_meta(tree.heads)
    # Where a page's time may stand, in the order of trust; the first that can be read counts.
    out["times"] = [t for t in (out.pop("published_at", ""), *meta.pop("times", ())) if t]
    out |= {k: v for k, v in meta.items() if not out.get(k)}
    out["content_from"] = "json-ld" if out.get("content") else None
    if not out.get("content"):
        site = next((s for known, s in selectors.items() if known in (url or "").lower()), [])
        out["content"] = body_text(root, site)
        out["content_from"] = "site" if out["content"] else None
    if len(out["content"]) < 200:
        longer = main_text(root, _is_noise)
        if len(longer) > len(out["content"]):
            out |= {"content": longer, "content_from": "page"}
    return out


FIELDS = "title string, times array<string>, author string, category_raw string, keywords array<string>, content string, content_from string"


#: Pages that a task holds as Python strings and fields at once.
AT_ONCE = 100


def extracted(batches, id_column: str, url: str):
    """Batches (id, url, and the FIELDS) of batches (id, url, html), AT_ONCE pages each."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    lists = ("keywords", "times")
    kinds = [pa.list_(pa.string()) if n in lists else pa.string() for n in names]
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            found = [extract(h, u) for u, h in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
            columns = [pa.array([f.get(n) if n not in lists else f.get(n) or [] for f in found], k) for n, k in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=[id_column, url, *names])


def extract_articles(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, title, published_at, author, category_raw, keywords, content, content_from, domain), a row for each page;
    content_from tells whether json-ld, the site's selectors or the page's main text gave the content; published_at is in UTC, from the first of the page's times that can be read, and null without one.

    Parsing runs in Arrow batches; cleaning and the category from the URL stay in the JVM.
    """
    rows = pages.select(id_column, url, html)
    parsed = rows.mapInArrow(lambda batches: extracted(batches, id_column, url), f"{id_column} {rows.schema[id_column].dataType.simpleString()}, {url} string, {FIELDS}")
    section = F.coalesce(F.col("category_raw"), F.lit(""))
    keywords = F.filter(F.transform(F.col("keywords"), trimmed), lambda k: k != "")
    known = F.filter(F.transform("times", lambda t: to_utc(t)), lambda t: t.isNotNull())
    parsed = parsed.select(id_column, url, "title", iso(F.try_element_at(known, F.lit(1))).alias("published_at"), "author", "category_raw", "keywords", "content", "content_from")
    return parsed.withColumns({"content": clean_content(F.col("content")), "category_raw": F.when(section == "", category_of_url(F.col(url))).otherwise(section), "keywords": keywords}).withColumn("domain", domain(F.col(url)))
