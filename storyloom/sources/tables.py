"""Markdown tables of any header."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import text as T
from storyloom.sources.parsed import exploded
from storyloom.sources.stories import decoded_path

SEPARATOR = re.compile(r"^[-: ]*$")


def cells_of(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def rows_of(text: str) -> Iterator[tuple[int, list[str], list[tuple[str, str]]]]:
    """Rows of all tables of a text: the header is the last row before a separator.

    Short rows are filled with empty text, long ones cut to the header; a line
    that is no table row ends the table.
    """
    headers, last, n = None, None, 0
    for line in text.splitlines():
        if not line.strip().startswith("|"):
            headers = last = None
            continue
        cells = cells_of(line)
        if all(SEPARATOR.match(c) for c in cells):
            if headers is None and last is not None:
                headers = last
            continue
        if headers is None:
            last = cells
            continue
        n += 1
        padded = cells[: len(headers)] + [""] * (len(headers) - len(cells))
        yield n, headers, list(dict(zip(headers, padded)).items())


def scan(spark: SparkSession, root: str) -> DataFrame:
    """source (file name) and text of the markdown files, README.md left out."""
    files = spark.read.option("pathGlobFilter", "*.md").text(root, wholetext=True)
    rows = files.select(F.regexp_extract(decoded_path(F.col("_metadata.file_path")), r"([^/]+)$", 1).alias("source"), F.col("value").alias("text"))
    return rows.where("source <> 'README.md'")


def table_rows(texts: DataFrame, text: str = "text") -> DataFrame:
    return exploded(texts, text, rows_of, "row_no int, headers array<string>, cells map<string,string>")


def header_union(rows: DataFrame, numbered: bool = False) -> DataFrame:
    """Source, then a column for each header in the order in which headers first occur; blanks filled.

    ``numbered`` adds row_no, the row's place in its source.
    """
    seen = rows.select("source", "row_no", F.posexplode("headers").alias("place", "header")).groupBy("header").agg(F.min(F.struct("source", "row_no", "place")).alias("first"))
    names = [r["header"] for r in seen.orderBy("first").collect()]  # headers, not rows
    return rows.select(F.col("source").alias("Source"), *(["row_no"] if numbered else []), *(F.coalesce(F.col("cells")[n], F.lit("")).alias(n) for n in names))


def appendix_rows(text: Column, columns: int) -> Column:
    """Cells of the table rows in a report's appendix: arrays of ``columns`` cells, header and separator left out."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.startswith(F.trim(x), F.lit("|")) & ~F.rlike(x, F.lit(r"^[|\-: ]+$")))
    cells = F.transform(lines, lambda x: F.transform(F.split(F.regexp_replace(F.trim(x), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c)))
    return T.let(F.filter(cells, lambda c: F.size(c) == columns), lambda rows: F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))))
