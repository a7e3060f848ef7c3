"""One pass over a page's markup, for everything that is later taken from it.

Tag soup is read as a lenient parser reads it: an end tag closes the nearest open element of its
name and all inside it, nothing else closes an element (an unclosed <p> goes on until its parent
ends), void elements have no content, and the text of script, style and template elements and of
comments is no text of the page.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOID = frozenset("area base br col command embed frame hr image img input isindex keygen link menuitem meta nextid param source spacer track wbr basefont bgsound".split())
SILENT = frozenset(("script", "style", "template"))
#: Elements whose text can be a correction, and the pass in which it is looked for.
PASSES = {"p": 1, "aside": 2, "blockquote": 2, "div": 3}


@dataclass
class Element:
    """An open or finished element; its text is the range of the page's text nodes from `first`."""

    name: str
    attributes: dict[str, str]
    first: int
    order: int
    last: int = -1
    has_block: bool = False
    inside: tuple[int, ...] = field(default=())


class PageReader(HTMLParser):
    """Collects text nodes and elements in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.elements: list[Element] = []
        self.open: list[Element] = []
        self.scripts: list[tuple[Element, list[str]]] = []
        self.quiet = 0
        self.run = False  # whether what comes next continues the last text node

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.run = False
        given: dict[str, str] = {}
        for name, value in attrs:
            given[name] = value or ""
        element = Element(tag, given, len(self.texts), len(self.elements), inside=tuple(e.order for e in self.open))
        self.elements.append(element)
        if tag in ("p", "div"):
            for outer in self.open:
                outer.has_block = True
        if tag in VOID:
            element.last = element.first
            return
        self.open.append(element)
        self.quiet += tag in SILENT
        if tag == "script":
            self.scripts.append((element, []))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.run = False
        if not any(e.name == tag for e in self.open):
            return
        while self.open:
            element = self.open.pop()
            element.last = len(self.texts)
            self.quiet -= element.name in SILENT
            if element.name == tag:
                break

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1].name == "script" and self.scripts:
            self.scripts[-1][1].append(data)
        if self.quiet:
            return
        if self.run:
            self.texts[-1] += data
        else:
            self.texts.append(data)
        self.run = True

    def handle_comment(self, data: str) -> None:
        self.run = False

    def handle_decl(self, decl: str) -> None:
        self.run = False

    def handle_pi(self, data: str) -> None:
        self.run = False

    def unknown_decl(self, data: str) -> None:
        self.run = False

    def finish(self) -> None:
        self.close()
        for element in self.open:
            element.last = len(self.texts)
        self.open = []

    def joined(self, element: Element) -> str:
        """Every text node stripped, with nothing between them."""
        return "".join(t.strip() for t in self.texts[element.first : element.last])

    def spaced(self, first: int, last: int) -> str:
        return " ".join(s for t in self.texts[first:last] if (s := t.strip()))

    def named(self, *names: str) -> Iterator[Element]:
        return (e for e in self.elements if e.name in names)


def _name_of(author) -> str | None:
    first = author[0] if isinstance(author, list) and author else author
    name = first.get("name", "") if isinstance(first, dict) else None
    return name.strip() if isinstance(name, str) else None


def author_of(scripts: list[str]) -> str:
    """The first author's name in the first script of linked data that has one."""
    for text in scripts:
        try:
            data = json.loads(text)
        except ValueError:
            continue
        for item in data if isinstance(data, list) else [data]:
            if isinstance(item, dict) and item.get("author") and (name := _name_of(item["author"])):
                return name
    return ""


def read_page(html: str | None) -> dict:
    """The fields of PAGE. A null or empty page has none of them."""
    reader = PageReader()
    reader.feed(html or "")
    reader.finish()
    blocks = [{"pass": PASSES[e.name], "text": reader.joined(e)} for e in reader.named(*PASSES) if not (e.name == "div" and e.has_block)]
    first = {name: next(reader.named(name), None) for name in ("h1", "title", "article", "main")}
    metas: dict[str, str] = {}
    for e in reader.named("meta"):
        if "property" in e.attributes:
            metas.setdefault(e.attributes["property"], e.attributes.get("content", ""))
    container = first["article"] or first["main"]
    paragraphs = [reader.joined(e) for e in reader.named("p") if container and container.order in e.inside]
    byline = next((e for e in reader.elements if "byline" in e.attributes.get("class", "").lower()), None)
    body = first["article"]
    return {
        "page_text": "".join(reader.texts),
        "spaced_text": " ".join(reader.texts),
        "blocks": blocks,
        "h1": reader.joined(first["h1"]) if first["h1"] else None,
        "title": reader.joined(first["title"]) if first["title"] else None,
        "time": next((e.attributes["datetime"] for e in reader.named("time") if "datetime" in e.attributes), None),
        "metas": list(metas.items()),
        "author": author_of(["".join(data) for e, data in reader.scripts if e.attributes.get("type") == "application/ld+json"]),
        "byline": reader.joined(byline) if byline else None,
        "links": [{"href": e.attributes.get("href"), "text": reader.joined(e)} for e in reader.named("a")],
        "paragraphs": paragraphs if container else None,
        "article_body": reader.spaced(body.first, body.last) if body else reader.spaced(0, len(reader.texts)),
    }


PAGE = T.StructType(
    [
        T.StructField("page_text", T.StringType()),
        T.StructField("spaced_text", T.StringType()),
        T.StructField("blocks", T.ArrayType(T.StructType([T.StructField("pass", T.IntegerType()), T.StructField("text", T.StringType())]))),
        T.StructField("h1", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("metas", T.MapType(T.StringType(), T.StringType())),
        T.StructField("author", T.StringType()),
        T.StructField("byline", T.StringType()),
        T.StructField("links", T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("text", T.StringType())]))),
        T.StructField("paragraphs", T.ArrayType(T.StringType())),
        T.StructField("article_body", T.StringType()),
    ]
)
PAGE_ARROW = pa.struct(
    [
        ("page_text", pa.string()),
        ("spaced_text", pa.string()),
        ("blocks", pa.list_(pa.struct([("pass", pa.int32()), ("text", pa.string())]))),
        ("h1", pa.string()),
        ("title", pa.string()),
        ("time", pa.string()),
        ("metas", pa.map_(pa.string(), pa.string())),
        ("author", pa.string()),
        ("byline", pa.string()),
        ("links", pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))),
        ("paragraphs", pa.list_(pa.string())),
        ("article_body", pa.string()),
    ]
)


#: A worker hands on what it has read once it holds so many characters of text.
PIECE = 1 << 20


def _texts(page: dict) -> int:
    """About how many characters of text a page's fields hold. An unclosed element's text has that of
    those behind it, so it can be many times the markup."""
    whole = 3 * len(page["page_text"])
    return whole + sum(len(b["text"]) for b in page["blocks"]) + sum(map(len, page["paragraphs"] or ())) + sum(len(link["href"] or "") + len(link["text"]) for link in page["links"])


def in_pieces(batches: Iterator[pa.RecordBatch], names: list[str], html: str) -> Iterator[pa.RecordBatch]:
    """The named columns and `page` of every row, in order, in batches of about PIECE characters of text."""
    for batch in batches:
        markup, first, held, size = batch.column(html), 0, [], 0
        for i in range(batch.num_rows):
            held.append(read_page(markup[i].as_py()))
            size += _texts(held[-1])
            if size >= PIECE or i == batch.num_rows - 1:
                found = pa.array(held, PAGE_ARROW)
                held, size = [], 0
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, len(found)) for c in names), found], [*names, "page"])
                first = i + 1


def parsed(pages: DataFrame, html: str = "html") -> DataFrame:
    """The columns of pages but for the markup, and `page` (PAGE). Only here does Python run, and it
    holds the fields of a few pages at a time, however many a batch has."""
    names = [c for c in pages.columns if c != html]
    schema = T.StructType([*(pages.schema[c] for c in names), T.StructField("page", PAGE)])
    return pages.select(*names, html).mapInArrow(lambda batches: in_pieces(batches, names, html), schema)
