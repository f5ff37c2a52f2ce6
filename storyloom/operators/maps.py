"""Inverted maps and edges: components, labels, epics, criteria, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions import stats
from storyloom.functions import text as T
from storyloom.tables import cut

#: Parts that the edges of one prefix are dealt to.
SALTS = 64


def exploded(rows: DataFrame, column: str, separators: str = "[,;]+", name: str = "value") -> DataFrame:
    """A row for each value of a field with many; a value named twice gives two rows."""
    return rows.withColumn(name, F.explode(T.split_values(F.coalesce(column, F.lit("")), separators)))


def frequency(rows: DataFrame, value: str, k: int | None = None, ordinal: str | None = None) -> DataFrame:
    """Values by number of rows, most frequent first, ties by value; with an ``ordinal`` by where they first occur in the corpus."""
    first = [F.min(ordinal).alias("__first")] if ordinal else []
    out = rows.groupBy(value).agg(F.count("*").alias("n"), *first).orderBy(F.desc("n"), *(["__first"] if ordinal else []), value)
    return (out.limit(k) if k else out).select(value, "n")


def orphans(rows: DataFrame, value: str) -> DataFrame:
    """Values of one row only."""
    return rows.groupBy(value).agg(F.count("*").alias("n")).where("n = 1").select(value)


def distinct_per(rows: DataFrame, group: str, value: str) -> DataFrame:
    return rows.groupBy(group).agg(F.count_distinct(value).alias("n"))


def top_per(rows: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """The ``k`` most frequent values of each group."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"))
    return stats.top_per_group(counts, [group], [F.desc("n"), F.col(value)], k)


def inverted(rows: DataFrame, value: str, key: str = "story_id", span: str = "sprint") -> DataFrame:
    """Number of keys and of spans of each value; ``members`` has the keys themselves."""
    return rows.groupBy(value).agg(F.count_distinct(key).alias("stories"), F.count_distinct(span).alias("spans"))


def members(rows: DataFrame, value: str, key: str = "story_id", span: str = "sprint", more: dict[str, int | None] | None = None) -> DataFrame:
    """The inverted map: a row for each (value, key, span), however many one value has.

    ``more`` are further columns, cut to so many characters where a number is given; of several rows the last in order stands.
    """
    short = [(F.col(c) if n is None else F.left(F.coalesce(c, F.lit("")), F.lit(n))).alias(c) for c, n in (more or {}).items()]
    if not short:
        return rows.select(value, key, span).distinct()
    return rows.groupBy(value, key, span).agg(F.max(F.struct(*short)).alias("__m")).select(value, key, span, "__m.*")


def hot(rows: DataFrame, value: str, least: int = 2, key: str = "story_id", span: str = "sprint") -> DataFrame:
    """Values of ``least`` keys or more, with their sorted distinct spans."""
    spans = F.array_sort(F.collect_set(span))  # as many as there are spans, not rows
    return rows.groupBy(value).agg(F.count_distinct(key).alias("stories"), spans.alias("spans")).where(F.col("stories") >= least)


def epics(stories: DataFrame) -> DataFrame:
    """epic of each story, from its fields."""
    return stories.withColumn("epic_name", T.epic_of(*(F.col(c) if c in stories.columns else F.lit("") for c in ("epic", "parent", "summary", "components"))))


def epic_span(rows: DataFrame, epic: str, span: str = "sprint") -> DataFrame:
    """Epics over more than one span, with the sorted spans."""
    return rows.groupBy(epic).agg(F.count("*").alias("stories"), F.array_sort(F.collect_set(span)).alias("spans")).where(F.size("spans") > 1)


def epic_quality(scored: DataFrame, epic: str = "epic", score: str = "quality_score", k: int = 20) -> DataFrame:
    return scored.where(F.trim(epic) != "").groupBy(epic).agg(F.count("*").alias("stories"), F.round(F.avg(score), 1).alias("mean_quality")).orderBy(F.desc("stories"), epic).limit(k)


def with_text(stories: DataFrame, column: str) -> DataFrame:
    """Index of a section: stories that have it, with the whole of it, by sprint and key."""
    section = F.regexp_replace(F.coalesce(column, F.lit("")), r"^\s+|\s+$", "").alias(column)
    more = [c for c in ("status", "components") if c in stories.columns]
    return stories.select("sprint", "story_id", "summary", *more, section).where(F.col(column) != "").orderBy("sprint", "story_id")


def reference_edges(stories: DataFrame, pattern: str = T.STORY_ID, known_only: bool = False) -> DataFrame:
    """from, to, sprint: ids that a story names in solution, criteria and summary, itself left out.

    ``known_only`` keeps ids whose prefix some story of the corpus has.
    """
    text = F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in ("solution", "acceptance_criteria", "summary")))
    edges = stories.select(F.col("story_id").alias("from"), F.explode(T.story_ids(text, pattern)).alias("to"), "sprint").where(F.col("from") != F.col("to"))
    if known_only:
        prefix = lambda c: F.regexp_extract(c, r"^([A-Z][A-Z0-9]*)-", 1)
        # prefixes are few and have very many edges each: these are dealt by what they name, too
        known = stories.select(prefix("story_id").alias("p")).distinct().select("p", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        edges = edges.join(known, (prefix("to") == F.col("p")) & (F.pmod(F.xxhash64("to"), F.lit(SALTS)).cast("int") == F.col("salt")), "left_semi")
    return edges


def dangling(edges: DataFrame, stories: DataFrame) -> DataFrame:
    """Targets that no story has."""
    return edges.select("to").distinct().join(stories.select(F.col("story_id").alias("to")), "to", "left_anti")


def mermaid(edges: DataFrame, most: int = 100) -> str:
    """The first edges, sorted, as a diagram whose nodes are labelled with the ids."""
    node = lambda c: F.concat(F.replace(c, F.lit("-"), F.lit("_")), F.lit('["'), F.col(c), F.lit('"]'))
    rows = edges.orderBy("from", "to").limit(most).select(F.concat(F.lit("    "), node("from"), F.lit(" --> "), node("to")).alias("line")).collect()
    return "\n".join(["graph LR", *(r["line"] for r in rows)])


def missing(values: DataFrame, documented: DataFrame, on: str) -> DataFrame:
    """Values that aren't documented."""
    return values.select(on).distinct().join(documented.select(on), on, "left_anti")


def call_chain(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Elements reached from ``start`` (name) along ``edges`` (from, to), with the least number of steps.

    Of versions of one name (``Name_2``) the highest stands.  Each round goes on from what it has found for the first
    time, until there is nothing new, so chains of any length and rings end.
    """
    versioned = edges.select("from", F.regexp_replace("to", r"_\d+$", "").alias("name"), F.coalesce(F.regexp_extract("to", r"_(\d+)$", 1).try_cast("int"), F.lit(0)).alias("version"), "to")
    newest = cut(versioned.groupBy("from", "name").agg(F.max_by("to", "version").alias("to")).select("from", "to").distinct())
    front = seen = cut(start.select(F.col("name").alias("node"), F.lit(0).alias("steps")).distinct())
    step = 0
    while not front.isEmpty():
        step += 1
        met = front.join(newest, front["node"] == newest["from"]).select(F.col("to").alias("node")).distinct()
        front = cut(met.join(seen.select("node"), "node", "left_anti").withColumn("steps", F.lit(step)))
        seen = seen.unionByName(front)
    return seen


def prior_touchpoints(rows: DataFrame, value: str, span: str, key: str) -> DataFrame:
    """For each (span, value): in how many earlier spans the value occurs, the latest, and how many keys there.

    One row for each span of a value is made first, so a value in very many rows is no self-join of them.
    """
    each = rows.groupBy(value, span).agg(F.count_distinct(key).alias("keys"))
    earlier = Window.partitionBy(value).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    out = each.select(value, span, F.col("keys").alias("own_keys"), F.count("*").over(earlier).alias("prior_spans"), F.max(span).over(earlier).alias("latest_prior"), F.sum("keys").over(earlier).alias("prior_keys"))
    return out.where("prior_spans > 0")
