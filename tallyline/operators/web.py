"""Links and fields of stored web pages (``url``, ``html``).

Pages are read by the parser of the standard library in Arrow batches: expressions
cannot follow the nesting of tags. One page is held at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ["title", "publish_dept", "publish_date", "doc_number", "source", "content"]
# Elements without an end tag, and those that end an open paragraph.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
ENDS_PARAGRAPH = set(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split()
)
_SCOPES = {"article", "aside", "body", "button", "div", "li", "section", "table", "td", "th"}


@dataclass(frozen=True)
class Block:
    """An element by its tag and, if given, the exact value of one attribute."""

    tag: str
    attribute: str = ""
    value: str = ""

    def matches(self, tag: str, attributes: dict) -> bool:
        return tag == self.tag and (not self.attribute or attributes.get(self.attribute) == self.value)


@dataclass(frozen=True)
class PageLayout:
    """Where the parts of a page are; without ``links`` list entries count anywhere."""

    links: Block | None = Block("div", "class", "fylb")
    title: Block = Block("h1", "align", "center")
    info: Block = Block("p", "class", "xx")
    content: Block = Block("div", "class", "v_news_content")


@dataclass
class _Open:
    """An element that has not ended yet, the parts of the layout that it starts, its link."""

    tag: str
    parts: set = field(default_factory=set)
    link: tuple | None = None


class _Page(HTMLParser):
    """The texts of the layout's parts and the links of one page."""

    def __init__(self, layout: PageLayout):
        super().__init__(convert_charrefs=True)
        self.layout, self.open = layout, []
        self.links: list[tuple[str, str, list[str]]] = []
        self.texts = {"title": [], "info": [], "content": []}
        self.doc_number, self.contents = "", 0

    def _end(self, tags: set, within: set = frozenset()) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in within:
                return

    def handle_starttag(self, tag, attrs):
        attributes = {name: value or "" for name, value in attrs}
        if tag in ENDS_PARAGRAPH:
            self._end({"p"}, _SCOPES)
        elif tag == "li":
            self._end({"li"}, {"ul", "ol"})
        elif tag == "a":
            self._end({"a"}, _SCOPES)
        element = _Open(tag)
        for part in ("links", "title", "info", "content"):
            block = getattr(self.layout, part)
            if block is not None and block.matches(tag, attributes):
                element.parts.add(part)
        if "content" in element.parts:
            self.contents += 1
            if self.contents > 1:  # the first block is the text
                element.parts.discard("content")
        entry = tag == "a" and self.open and self.open[-1].tag == "li"
        if entry and (self.layout.links is None or any("links" in e.parts for e in self.open)):
            element.link = (attributes.get("href", "").strip(), attributes.get("title", "").strip(), [])
            self.links.append(element.link)
        if tag not in VOID:
            self.open.append(element)

    def handle_endtag(self, tag):
        self._end({tag})

    def handle_data(self, data):
        if self.open and self.open[-1].tag in ("script", "style"):
            return
        text = data.replace("\u00a0", " ")
        if self.open and "title" in self.open[-1].parts:
            self.texts["title"].append(text)
        for element in self.open:
            for part in element.parts & {"info", "content"}:
                self.texts[part].append(text)
            if element.link:
                element.link[2].append(text)
        if not self.doc_number and re.search(r"〔.*〕.*号", text, re.S):
            self.doc_number = text.strip()


def _read(html: str | None, layout: PageLayout) -> _Page:
    page = _Page(layout)
    if html:
        # comments do not part texts; marked sections are not HTML
        page.feed(re.sub(r"<!--.*?-->|<!\[.*?>", "", html, flags=re.S))
        page.close()
    return page


def _after(text: str, label: str) -> str:
    """The word behind the last occurrence of a label."""
    words = text.rpartition(label)[2].split() if label in text else []
    return words[0] if words else ""


def page_links(pages: DataFrame, base: str, layout: PageLayout | None = None) -> DataFrame:
    """Links of list entries with their names; relative ones are completed with ``base``.

    Every anchor that is a child of an entry counts. Without a layout the whole page is
    searched. Links without target or name are dropped; a page without text has none.
    """
    layout = layout or PageLayout(links=None)

    @F.pandas_udf("array<struct<href:string,title:string,text:string>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([
                [{"href": h, "title": t, "text": "".join(text)} for h, t, text in _read(page, layout).links]
                for page in batch
            ], dtype=object)

    href = F.col("_l.href")
    full = F.when(href.startswith("http"), href).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(href, "^/+", ""))
    )
    links = pages.select(F.col("url").alias("page_url"), F.explode(found("html")).alias("_l"))
    named = links.select("page_url", full.alias("link"), link_name(F.col("_l.title"), F.col("_l.text")).alias("name"), "_l")
    return named.where((href != "") & (F.col("name") != "")).drop("_l")


#: All white space, as Python's ``strip`` takes it.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def link_name(title: Column, text: Column) -> Column:
    """The title, or the text without its ten-character date prefix."""
    clean = F.trim(text, F.lit(WHITE))
    dated = (F.length(clean) > 10) & F.substring(clean, 1, 10).contains("-")
    return F.when(title != "", title).when(dated, F.trim(F.substr(clean, F.lit(11)), F.lit(WHITE))).otherwise(clean)


def page_fields(pages: DataFrame, layout: PageLayout | None = None) -> DataFrame:
    """Title, department, date, document number, source and text of detail pages.

    A field that a page does not have is empty. The text keeps its order, with a
    blank line between text nodes.
    """
    layout = layout or PageLayout()

    @F.pandas_udf(", ".join(f"{name} string" for name in FIELDS))
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for html in batch:
                page = _read(html, layout)
                info = "".join(page.texts["info"])
                source = _after(info, "来源：")
                nodes = [t.strip() for t in page.texts["content"]]
                rows.append((
                    "".join(page.texts["title"][:1]).strip(), source, _after(info, "发布日期："), page.doc_number,
                    source, "\n\n".join(t for t in nodes if t),
                ))
            yield pd.DataFrame(rows, columns=FIELDS, dtype=object)

    return pages.select("url", read("html").alias("_f")).select("url", "_f.*")


def merged_pages(links: DataFrame, fields: DataFrame) -> DataFrame:
    """Each listed link with the fields of its page, empty where the page is missing."""
    names = [c for c in fields.columns if c != "url"]
    joined = links.join(fields.withColumnRenamed("url", "link"), "link", "left")
    return joined.select("link", "name", *[F.coalesce(c, F.lit("")).alias(c) for c in names])
