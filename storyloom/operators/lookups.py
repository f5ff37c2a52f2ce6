"""Lookups by id, component, phrase and relation; all are filters and joins of the flat stories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.functions import text as T
from storyloom.operators import maps


def story(stories: DataFrame, story_id: str) -> DataFrame:
    return stories.where(F.col("story_id") == story_id)


def touching(stories: DataFrame, component: str) -> DataFrame:
    """Stories with the component among theirs (how = component), or in description or solution (how = text)."""
    named = F.array_contains(F.transform(T.split_values(F.coalesce("components", F.lit(""))), lambda c: F.lower(c)), component.lower())
    text = F.lower(F.concat_ws(" ", "description", "solution"))
    how = F.when(named, "component").when(F.contains(text, F.lit(component.lower())), "text")
    return stories.withColumn("how", how).where("how is not null")


def mentioning(stories: DataFrame, phrase: str, column: str = "acceptance_criteria") -> DataFrame:
    return stories.where(F.contains(F.lower(F.coalesce(column, F.lit(""))), F.lit(phrase.lower())))


def related(edges: DataFrame, story_id: str) -> DataFrame:
    """What a story depends on (out) and what depends on it (in)."""
    out = edges.where(F.col("from") == story_id).select(F.lit("out").alias("way"), F.col("to").alias("story_id"))
    return out.unionByName(edges.where(F.col("to") == story_id).select(F.lit("in").alias("way"), F.col("from").alias("story_id"))).distinct()


def without(stories: DataFrame, column: str) -> DataFrame:
    """Stories whose section has three words or fewer."""
    return stories.where(T.word_count(F.coalesce(column, F.lit(""))) <= 3)


def shared_components(stories: DataFrame, sprint_no: int) -> DataFrame:
    """Components of a sprint that the one before had, too, with how many stories of each."""
    rows = maps.exploded(stories.where(F.col("sprint_no").isin(sprint_no, sprint_no - 1)), "components", T.COMPONENT_SEPARATORS, "component")
    n = lambda s: F.count_distinct(F.when(F.col("sprint_no") == s, F.col("story_id")))
    return rows.groupBy("component").agg(n(sprint_no).alias("now"), n(sprint_no - 1).alias("before")).where("now > 0 and before > 0")


def regression_scope(stories: DataFrame, sprint_no: int) -> DataFrame:
    """Earlier stories with a component of the sprint's, and by how many of them."""
    rows = maps.exploded(stories.where(F.col("sprint_no") <= sprint_no), "components", T.COMPONENT_SEPARATORS, "component")
    now = rows.where(F.col("sprint_no") == sprint_no).select("component").distinct()
    return rows.where(F.col("sprint_no") < sprint_no).join(now, "component", "left_semi").groupBy("story_id", "sprint_no").agg(F.count_distinct("component").alias("shared"))


def criteria(stories: DataFrame) -> DataFrame:
    """story_id, criterion_no, criterion: the list items (else lines) of the acceptance criteria."""
    lines = F.filter(F.transform(F.split(F.coalesce("acceptance_criteria", F.lit("")), "\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s*(?:[-*•]|\d+[.)])\s+", ""))), lambda x: x != "")
    return stories.select("story_id", F.posexplode(lines).alias("criterion_no", "criterion")).withColumn("criterion_no", F.col("criterion_no") + 1)


def criteria_coverage(items: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Criteria with how many scenarios (story_id, criterion_no) cover them; none is a gap."""
    n = scenarios.groupBy("story_id", "criterion_no").agg(F.count("*").alias("scenarios"))
    return items.join(n, ["story_id", "criterion_no"], "left").withColumn("scenarios", F.coalesce("scenarios", F.lit(0))).withColumn("gap", F.col("scenarios") == 0)


def progression(stories: DataFrame) -> DataFrame:
    """Stories of several sprints: each sprint's status and the one before."""
    by = Window.partitionBy("story_id")
    rows = stories.select("story_id", "sprint_no", "status").distinct()
    rows = rows.withColumn("sprints", F.size(F.collect_set("sprint_no").over(by))).where("sprints > 1")
    return rows.withColumn("was", F.lag("status").over(by.orderBy("sprint_no"))).select("story_id", "sprint_no", "was", "status")


def preferring(stories: DataFrame, metadata: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Columns as the metadata say, else as the stories do."""
    m = metadata.select(on, *(F.col(c).alias(f"__{c}") for c in columns))
    out = stories.join(m, on, "left")
    return out.withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).drop(*(f"__{c}" for c in columns))


#: Folders that a lookup table is dealt to, by its key.
BUCKETS = 64


def bucket(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def write_lookup(rows: DataFrame, path: str, key: str = "story_id", buckets: int = BUCKETS) -> None:
    """A Parquet table for lookups by ``key``: a folder for each bucket, in order of the key, with Bloom filters and
    statistics, so that one key reads one folder and of it the row groups that may have the key.

    Rows are dealt by (bucket, key) in ranges, so a bucket of very many rows is several files.
    """
    placed = rows.withColumn("bucket", bucket(F.col(key), buckets)).repartitionByRange("bucket", key).sortWithinPartitions("bucket", key)
    writer = placed.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", str(16 << 20)).option("parquet.page.row.count.limit", "2000")
    writer.partitionBy("bucket").parquet(path)


def looked_up(spark: SparkSession, path: str, key: str, value, buckets: int = BUCKETS) -> DataFrame:
    """The rows of one key; the bucket is worked out in the plan, so other folders aren't listed or read."""
    table = spark.read.parquet(path)
    return table.where((F.col("bucket") == bucket(F.lit(value), buckets)) & (F.col(key) == F.lit(value))).drop("bucket")


def looked_up_all(asked: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows of all keys in ``asked``; where these are few, Spark prunes the buckets as it runs."""
    table = asked.sparkSession.read.parquet(path)
    keys = asked.select(F.col(key)).distinct().withColumn("bucket", bucket(F.col(key), buckets))
    return table.join(keys, ["bucket", key], "left_semi").drop("bucket")


def tier_index(tiers: list[tuple[str, DataFrame]], key: str = "story_id") -> DataFrame:
    """key, tier: the first of the tables, cheapest first, that has it."""
    each = None
    for rank, (name, table) in enumerate(tiers):
        rows = table.select(key, F.lit(rank).alias("rank"), F.lit(name).alias("tier"))
        each = rows if each is None else each.unionByName(rows)
    return each.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by("tier", "rank").alias("tier"))


def cheapest(story_id: str, tiers: list[tuple[str, DataFrame]], index: DataFrame | None = None) -> tuple[str, DataFrame] | None:
    """The first of the tables, cheapest first, that has the story, and its rows there.

    With a ``tier_index``, which may be a lookup table, that is one lookup; else each table is asked in turn.
    """
    if index is not None:
        found = story(index, story_id).select("tier").head()
        return (found["tier"], story(dict(tiers)[found["tier"]], story_id)) if found else None
    for name, table in tiers:
        found = story(table, story_id)
        if not found.isEmpty():
            return name, found
    return None
