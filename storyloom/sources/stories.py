"""Markdown stories, one file each, in folders of sprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import text as T
from storyloom.tables import running

SPRINT = r"([^/]*[Ss]print[^/]*)/stories/[^/]*$"


def decoded_path(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def scan(spark: SparkSession, root: str, sprint: str | None = None) -> DataFrame:
    """file_path, file_size, sprint, text of every ``*/stories/*.md``; one sprint's folder only, if asked."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(root, wholetext=True)
    rows = files.select(decoded_path(F.col("_metadata.file_path")).alias("file_path"), F.col("_metadata.file_size").alias("file_size"), F.col("value").alias("text"))
    rows = rows.withColumn("sprint", F.regexp_extract("file_path", SPRINT, 1)).where("sprint <> ''")
    return rows.where(F.col("sprint") == sprint) if sprint else rows


def sprint_number(sprint: Column) -> Column:
    return F.regexp_extract(sprint, r"(\d+)", 1).try_cast("int")


def in_order(stories: DataFrame, order: tuple[str, ...] = ("sprint", "file_path")) -> DataFrame:
    """Adds ordinal: the place in the corpus, from 1, counted in ranges."""
    return running(stories, list(order), F.lit(1), "ordinal")


def last_wins(pairs: Column) -> Column:
    """A map of (key, value) pairs, the last of equal keys standing."""

    def of(p: Column) -> Column:
        keep = F.filter(p, lambda x, i: ~F.exists(F.slice(p, i + 2, F.greatest(F.size(p) - i - 1, F.lit(0))), lambda y: y["key"] == x["key"]))
        return F.map_from_entries(F.transform(keep, lambda x: F.struct(x["key"], x["value"])))

    return T.let(pairs, of)


def section_struct(body: Column) -> Column:
    content = F.trim(F.regexp_replace(body, r"^\s+|\s+$", ""))
    lines = lambda c: F.size(F.filter(F.split(c, "\n"), lambda x: F.trim(x) != ""))
    return T.let(content, lambda c: F.struct(c.alias("content"), T.word_count(c).cast("int").alias("word_count"), F.length(c).alias("char_count"), lines(c).cast("int").alias("line_count")))


def parse(files: DataFrame, id_pattern: str = T.STORY_ID, compat: bool = False) -> DataFrame:
    """Stories of markdown texts: title, metadata list before the first section, sections.

    Later metadata keys and sections overwrite earlier ones of the same name.
    ``compat`` takes metadata lines anywhere in the text, not just before the first section.
    """
    body = F.regexp_replace(F.col("text"), "\r\n?", "\n")
    preamble = body if compat else F.element_at(F.split(body, r"(?d)(?m)^## ", 2), 1)
    line = F.lit(r"(?d)(?m)^- \*\*(.+?)\*\*:[ \t]*(.*)$")
    pairs = F.transform(F.regexp_extract_all(preamble, line, F.lit(0)), lambda m: F.struct(F.regexp_extract(m, r"(?d)^- \*\*(.+?)\*\*:[ \t]*(.*)$", 1).alias("key"), F.trim(F.regexp_extract(m, r"(?d)^- \*\*(.+?)\*\*:[ \t]*(.*)$", 2)).alias("value")))
    parts = F.split(body, r"(?d)(?m)^## ")
    cut = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    sections = F.transform(cut, lambda s: F.struct(F.trim(F.element_at(F.split(s, "\n", 2), 1)).alias("key"), section_struct(F.coalesce(F.get(F.split(s, "\n", 2), F.lit(1)), F.lit(""))).alias("value")))
    title = F.trim(F.regexp_extract(body, r"(?d)(?m)^# (.+)$", 1))
    named = F.regexp_extract(title, f"({id_pattern})", 1)
    stem = F.regexp_extract("file_path", r"([^/]+)\.md$", 1)
    has_colon = F.contains(title, F.lit(":"))
    n = T.word_count(body)
    return files.select(
        F.when(named != "", named).otherwise(stem).alias("story_id"),
        "sprint",
        sprint_number(F.col("sprint")).alias("sprint_no"),
        F.when(has_colon, F.trim(F.regexp_extract(title, r"(?d)^[^:]*:(.*)$", 1))).otherwise(title).alias("summary"),
        last_wins(pairs).alias("metadata"),
        last_wins(sections).alias("sections"),
        "file_path",
        "file_size",
        n.cast("int").alias("total_word_count"),
        T.estimated_tokens(n).alias("estimated_tokens"),
    )


def retrieval_view(files: DataFrame, id_pattern: str = T.STORY_ID) -> DataFrame:
    """story_id, summary, sprint, components, epic, labels, text of every story, as retrieval reads them.

    A title without an id gives no summary, and an id is then looked for in the file's name.
    """
    rows = parse(files, id_pattern)
    known = F.regexp_extract(F.regexp_extract(F.regexp_replace("text", "\r\n?", "\n"), r"(?d)^# (.+)", 1), f"({id_pattern})", 1) != ""
    stem = F.regexp_extract("file_path", r"([^/]+)\.md$", 1)
    named = F.nullif(F.regexp_extract(stem, f"({id_pattern})", 1), F.lit(""))
    titles = files.select("file_path", known.alias("__known"))
    rows = rows.join(titles, "file_path")
    story_id = F.when(F.col("__known"), F.col("story_id")).otherwise(F.coalesce(named, stem))
    summary = F.when(F.col("__known"), F.col("summary")).otherwise("")
    meta = lambda k: F.coalesce(F.col("metadata")[k], F.lit("")).alias(k.lower())
    text = T.searchable_text(story_id, summary, *(F.col("sections")[k]["content"] for k in ("Description", "Acceptance Criteria", "Solution", "Build Components")))
    return rows.select(story_id.alias("story_id"), F.left(summary, F.lit(200)).alias("summary"), "sprint", meta("Components"), meta("Epic"), meta("Labels"), text.alias("text"))


def flat(stories: DataFrame) -> DataFrame:
    """One plain column for each common field and section, empty text where there is none."""
    meta = lambda k: F.coalesce(F.col("metadata")[k], F.lit("")).alias(k.lower().replace(" ", "_"))
    part = lambda k, name: F.coalesce(F.col("sections")[k]["content"], F.lit("")).alias(name)
    return stories.select(
        "story_id", "sprint", "sprint_no", "summary",
        *(meta(k) for k in ("Status", "Priority", "Assignee", "Reporter", "Components", "Epic", "Labels", "Resolution")),
        F.coalesce(F.nullif(F.col("metadata")["Type"], F.lit("")), F.lit("Story")).alias("type"), F.coalesce(F.col("metadata")["Story Points"], F.lit("")).alias("story_points"),
        part("Description", "description"), part("Acceptance Criteria", "acceptance_criteria"), part("Solution", "solution"),
    )


def to_markdown(stories: DataFrame, fields: dict[str, str], sections: dict[str, str]) -> Column:
    """A story's markdown: title, metadata that isn't blank, cleaned sections that aren't."""
    meta = [F.when(~F.trim(F.coalesce(c, F.lit(""))).isin("", "&nbsp;"), F.concat(F.lit(f"- **{name}**: "), F.trim(c))) for name, c in ((n, F.col(k)) for n, k in fields.items())]
    body = [F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.concat(F.lit(f"\n## {name}\n\n"), T.wiki_to_markdown(T.clean_markup(F.regexp_replace(c, "\r\n?", "\n"))))) for name, c in ((n, F.col(k)) for n, k in sections.items())]
    return F.concat(F.concat_ws("\n", F.concat(F.lit("# "), F.col("story_id"), F.lit(": "), F.col("summary")), F.lit(""), *meta, *body), F.lit("\n"))
