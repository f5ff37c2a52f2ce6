"""Issue tables of HTML exports: a parser in Arrow batches for the markup, column functions for the fields."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import fixed
from storyloom.functions import text as T
from storyloom.sources.parsed import exploded
from storyloom.sources.stories import decoded_path, sprint_number


class IssueTable(HTMLParser):
    """Rows of the issue table: (class, content) of each cell.

    ``rich`` keeps line breaks, paragraphs and list items as lines, takes ``td``
    only and rows of the class ``issuerow`` only; otherwise ``th`` counts too,
    classes are lower-cased with the cell's data-id, and any row of the body counts.
    A table inside a cell belongs to the cell.
    """

    def __init__(self, rich: bool):
        super().__init__(convert_charrefs=True)
        self.rich, self.rows, self.depth = rich, [], 0
        self.row: list[dict] | None = None
        self.cell: dict | None = None

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        kind = a.get("class", "")
        if tag == "table":
            if self.depth:
                self.depth += 1
            elif a.get("id") == "issuetable" or not self.rich and "issue" in kind:
                self.depth = 1
        elif self.depth == 1 and tag == "tr" and (not self.rich or "issuerow" in kind.split()):
            self.row, self.cell = [], None
        elif self.depth == 1 and self.row is not None and tag in (("td",) if self.rich else ("td", "th")):
            self.close_cell()
            name = kind if self.rich else f"{kind} {a.get('data-id', '')}".strip().lower()
            self.cell = {"class": name, "content": []}
        elif self.cell is not None and self.rich:
            self.cell["content"].append({"br": "\n", "p": "\n", "li": "\n- "}.get(tag, ""))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th"):
            self.close_cell()
        elif self.depth == 1 and tag == "tr":
            self.close_cell()
            if self.row:
                self.rows.append(self.row)
            self.row = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell["content"].append(data)

    def close_cell(self):
        if self.cell is not None and self.row is not None:
            content = "".join(self.cell["content"]).replace("\xa0", " ").strip()
            self.row.append({"class": self.cell["class"], "content": content})
        self.cell = None


#: A plain tag with the text after it: lower-case names, attributes in quotes without references.
TAG = re.compile(r"""(<(/?)([a-z][a-z0-9]*)((?:\s+[a-z][a-z0-9-]*=(?:"[^"<>&]*"|'[^'<>&]*'))*)\s*(/?)>([^<]*))""", re.ASCII)
ATTRIBUTE = re.compile(r"""([a-z][a-z0-9-]*)=(?:"([^"]*)"|'([^']*)')""")
#: Elements whose content isn't markup.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


@lru_cache(4096)
def attributes(text: str) -> list[tuple[str, str]]:
    return [(name, a or b) for name, a, b in ATTRIBUTE.findall(text)]


def plain_tags(html: str) -> list[tuple] | None:
    """The page's tags if all of it is plain markup and text; none if it needs the parser."""
    tags = TAG.findall(html)
    first = html.find("<")
    whole = (len(html) if first < 0 else first) + sum(len(t[0]) for t in tags) == len(html)
    return tags if whole and not any(t[2] in RAW or t[1] and (t[3] or t[4]) for t in tags) else None


def cells_of(html: str, rich: bool) -> list[tuple[int, list[dict]]]:
    """Rows of a page's issue tables, from 1, with the class and content of each cell."""
    parser = IssueTable(rich)
    tags = plain_tags(html)
    if tags is None:
        parser.feed(html)
        parser.close()
    else:  # the same calls, without looking for anything but plain tags
        for _, end, tag, given, _, data in tags:
            if end:
                parser.handle_endtag(tag)
            else:
                parser.handle_starttag(tag, attributes(given) if given else [])
            if data and parser.cell is not None:
                parser.handle_data(unescape(data) if "&" in data else data)
    return list(enumerate(parser.rows, 1))


class LinkParser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, list[str]]] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        if tag == "a" and (href := dict(attrs).get("href")):
            self.found.append((href, []))
            self.inside = True

    def handle_endtag(self, tag):
        if tag == "a":
            self.inside = False

    def handle_data(self, data):
        if self.inside and self.found:
            self.found[-1][1].append(data)


def links_of(html: str) -> list[tuple[int, str, str]]:
    """Links of a page in their order, with their text on one line."""
    parser = LinkParser()
    parser.feed(html)
    return [(i, href, re.sub(r"\s+", " ", "".join(words)).strip()) for i, (href, words) in enumerate(parser.found, 1)]


def scan(spark: SparkSession, root: str, pattern: str = "*.html", first_only: bool = False) -> DataFrame:
    """file_path, sprint, html; ``first_only`` takes the first file of each sprint by name."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root, wholetext=True)
    rows = files.select(decoded_path(F.col("_metadata.file_path")).alias("file_path"), F.col("value").alias("html"))
    rows = rows.withColumn("sprint", F.regexp_extract("file_path", r"([^/]*[Ss]print[^/]*)/[^/]*$", 1)).where("sprint <> ''")
    if first_only:
        least = rows.groupBy("sprint").agg(F.min("file_path").alias("file_path"))
        rows = rows.join(least, ["sprint", "file_path"], "left_semi")
    return rows


def issue_rows(pages: DataFrame, rich: bool = True, html: str = "html") -> DataFrame:
    """Each page's rows of its issue tables, with the page's other columns."""
    return exploded(pages, html, lambda page: cells_of(page, rich), "row_no int, cells array<struct<class:string,content:string>>")


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    return exploded(pages, html, links_of, "link_no int, href string, words string")


def first_content(cls: str) -> Column:
    """Content of the first cell of exactly this class; null if there is none."""
    return F.get(F.filter("cells", lambda c: c["class"] == cls), F.lit(0))["content"]


def fields_exact(rows: DataFrame, id_pattern: str = T.STORY_ID) -> DataFrame:
    """Fields by the exact class of the first such cell; the key is an id, or else the stripped text."""
    columns = []
    for cls, name in fixed.CELL_FIELDS.items():
        content = first_content(cls)
        if name == "issue_key":
            found = F.regexp_extract(content, f"({id_pattern})", 1)
            content = F.when(found != "", found).otherwise(F.trim(content))
        columns.append(content.alias(name))
    place = [c for c in ("file_path", "row_no") if c in rows.columns]
    return rows.select("sprint", sprint_number(F.col("sprint")).alias("sprint_no"), *columns, *place)


def fields_hinted(rows: DataFrame, id_pattern: str = T.STORY_ID, hints: dict[str, list[str]] | None = None) -> DataFrame:
    """Fields by hints in the class; a cell goes to the first field in order that it hints at.

    Once a field is filled, later cells that hint at it go to the next field they hint at.
    Rows without a key are dropped, and the sprint is that of the folder.
    """
    hints = hints or fixed.CELL_HINTS
    names = list(hints)
    state = F.array(*[F.lit(None).cast("string")] * len(names))

    def hit(cls, name):
        any_of = F.lit(False)
        for h in hints[name]:
            any_of = any_of | F.contains(cls, F.lit(h))
        return any_of & ~F.contains(cls, F.lit("statuscategory")) if "status" in hints[name] else any_of

    def step(acc, c):
        # the field is found once for a cell, and only then its value
        hits = T.let(c["class"], lambda cls: F.coalesce(*(F.when(hit(cls, name) & F.get(acc, F.lit(i)).isNull(), F.lit(i)) for i, name in enumerate(names))))
        found = F.nullif(F.regexp_extract(c["content"], f"({id_pattern})", 1), F.lit(""))
        value = lambda i: F.when(i == names.index("issue_key"), found).otherwise(c["content"]) if "issue_key" in names else c["content"]
        put = lambda i: F.when(i.isNull(), acc).otherwise(F.transform(acc, lambda v, k: F.when(k == i, value(i)).otherwise(v)))
        return T.let(hits, put)

    filled = rows.withColumn("__f", F.aggregate("cells", state, step))
    out = filled.select(*(F.get("__f", F.lit(i)).alias(n) for i, n in enumerate(names) if n != "sprint"), "sprint")
    return out.where("issue_key is not null").withColumn("sprint_no", sprint_number(F.col("sprint")))
