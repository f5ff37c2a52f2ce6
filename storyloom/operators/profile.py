"""Profiles of a corpus of stories: coverage, density, quality, retrieval surface, status.

``stories`` has the schema of ``schemas.STORY``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions import fixed, stats
from storyloom.functions import text as T


def section_words(name: str) -> Column:
    return F.coalesce(F.col("sections")[name]["word_count"], F.lit(0))


def meta(name: str) -> Column:
    return F.trim(F.coalesce(F.col("metadata")[name], F.lit("")))


def present(name: str) -> Column:
    """A section counts from four words on."""
    return section_words(name) > 3


def coverage(stories: DataFrame) -> DataFrame:
    """For each section and metadata key how many stories have it, and the section's mean words."""
    sums = [F.count("*").alias("n")]
    for i, name in enumerate(fixed.SECTIONS):
        sums += [F.count_if(present(name)).alias(f"s{i}"), F.avg(F.when(present(name), section_words(name))).alias(f"w{i}")]
    sums += [F.count_if(meta(name) != "").alias(f"m{i}") for i, name in enumerate(fixed.METADATA_KEYS)]
    rows = [F.struct(F.lit("section").alias("kind"), F.lit(n).alias("name"), F.col(f"s{i}").alias("stories"), F.round(F.coalesce(f"w{i}", F.lit(0.0)), 0).alias("avg_words")) for i, n in enumerate(fixed.SECTIONS)]
    rows += [F.struct(F.lit("metadata").alias("kind"), F.lit(n).alias("name"), F.col(f"m{i}").alias("stories"), F.lit(None).cast("double").alias("avg_words")) for i, n in enumerate(fixed.METADATA_KEYS)]
    one = stories.agg(*sums)
    return one.select("n", F.inline(F.array(*rows))).select("kind", "name", "stories", stats.percent(F.col("stories"), F.col("n")).alias("pct"), "avg_words")


def coverage_by_sprint(stories: DataFrame) -> DataFrame:
    n = F.count("*")
    of = lambda name: F.count_if(present(name))
    return stories.groupBy("sprint").agg(n.alias("stories"), stats.percent(of("Acceptance Criteria"), n).alias("ac_pct"), stats.percent(of("Solution"), n).alias("solution_pct"))


def richness() -> Column:
    both = section_words("Acceptance Criteria") + section_words("Solution") + section_words("Description")
    return F.round(both / F.greatest(F.col("total_word_count"), F.lit(1)), 2)


def density(stories: DataFrame) -> DataFrame:
    """Totals of the corpus in one row, with the mean of the rounded richness."""
    return stories.agg(
        F.count("*").alias("stories"), F.sum("file_size").alias("bytes"), F.round(F.sum("file_size") / 1048576, 2).alias("mb"),
        F.sum("total_word_count").alias("words"), F.sum("estimated_tokens").alias("tokens"), F.round(F.avg(richness()), 2).alias("richness"),
    )


def density_by_sprint(stories: DataFrame) -> DataFrame:
    return stories.groupBy("sprint").agg(F.count("*").alias("stories"), F.sum("file_size").alias("bytes"), F.round(F.avg("total_word_count"), 0).alias("avg_words"), F.round(F.avg("estimated_tokens"), 0).alias("avg_tokens"))


def size_buckets(stories: DataFrame, size: str = "file_size") -> DataFrame:
    return stories.groupBy(T.size_bucket(F.col(size)).alias("bucket")).agg(F.count("*").alias("stories"))


def percentiles(stories: DataFrame, column: str = "total_word_count", compat: bool = False) -> DataFrame:
    """p10, p25, p50, p75 and p90 by the exclusive method; ``compat`` takes the 2nd and 7th deciles for p25 and p75.

    Of fewer than four values the least, the median and the greatest only.
    """
    deciles = stats.exclusive_quantiles(stories, column, 10)
    quarters = stats.exclusive_quantiles(stories, column, 4)
    pick = lambda df, names: df.select(F.element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col("q")).alias("name"), "value").where("name is not null")
    if compat:
        out = pick(deciles, {1: "p10", 2: "p25", 5: "p50", 7: "p75", 9: "p90"})
    else:
        out = pick(deciles, {1: "p10", 5: "p50", 9: "p90"}).unionByName(pick(quarters, {1: "p25", 3: "p75"}))
    few = stories.agg(F.count(column).alias("n"), F.min(column).cast("double").alias("least"), F.median(column).alias("mid"), F.max(column).cast("double").alias("most"))
    small = few.where("n < 4 and n > 0").select(F.inline(F.array(*(F.struct(F.lit(k).alias("name"), F.col(c).alias("value")) for k, c in (("min", "least"), ("p50", "mid"), ("max", "most"))))))
    return out.join(F.broadcast(few.where("n >= 4").select("n"))).select("name", "value").unionByName(small)


def with_quality(stories: DataFrame) -> DataFrame:
    """Adds quality_score, 0 to 100."""
    parts = {"description": "Description", "criteria": "Acceptance Criteria", "solution": "Solution", "linked": "Linked Issues"}
    return stories.withColumn("quality_score", T.quality_score(**{k: section_words(n) for k, n in parts.items()}, components=meta("Components"), assignee=meta("Assignee")))


def quality_stats(scored: DataFrame, score: str = "quality_score") -> DataFrame:
    return scored.agg(F.round(F.avg(score), 1).alias("mean"), F.floor(F.median(score)).alias("median"), F.round(F.coalesce(F.stddev_samp(score), F.lit(0.0)), 1).alias("stdev"))


def quality_bands(scored: DataFrame, score: str = "quality_score") -> DataFrame:
    return scored.groupBy(T.quality_band(F.col(score)).alias("band")).agg(F.count("*").alias("stories"))


def quality_by(scored: DataFrame, group: str = "sprint", score: str = "quality_score") -> DataFrame:
    return scored.groupBy(group).agg(F.count("*").alias("stories"), F.round(F.avg(score), 1).alias("mean_quality"))


def extremes(scored: DataFrame, k: int = 10, score: str = "quality_score", key: str = "story_id") -> DataFrame:
    """The ``k`` best and worst, ties by key."""
    best = scored.orderBy(F.desc(score), key).limit(k).select(F.lit("best").alias("end"), key, score)
    return best.unionByName(scored.orderBy(score, key).limit(k).select(F.lit("worst").alias("end"), key, score))


def retrieval_surface(stories: DataFrame, html_bytes: int = 0) -> DataFrame:
    """Median and 75th percentile of tokens, and what markdown saves over a table export."""
    p75 = stats.exclusive_quantiles(stories, "estimated_tokens", 4).where("q = 3").select(F.col("value").alias("p75_tokens"))
    one = stories.agg(F.median("estimated_tokens").alias("median_tokens"), F.median("file_size").alias("median_bytes"), F.sum("file_size").alias("md_bytes"))
    saved = F.when(F.lit(html_bytes) > 0, F.round((1 - F.col("md_bytes") / F.lit(html_bytes)) * 100, 1)).otherwise(0.0)
    return one.join(p75, how="left").withColumn("saved_pct", saved)


def tokens_by_component(stories: DataFrame, k: int = 15) -> DataFrame:
    rows = stories.select(F.explode(T.split_values(meta("Components"))).alias("component"), "estimated_tokens")
    return rows.groupBy("component").agg(F.count("*").alias("stories"), F.sum("estimated_tokens").alias("tokens")).orderBy(F.desc("tokens"), "component").limit(k)


def status_summary(rows: DataFrame, group: str = "sprint", status: str = "status") -> DataFrame:
    """Total, done, in progress and other of each group."""
    low = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    done, going = low == "done", F.contains(low, F.lit("progress"))
    return rows.groupBy(group).agg(F.count("*").alias("total"), F.count_if(done).alias("done"), F.count_if(going & ~done).alias("in_progress"), F.count_if(~done & ~going).alias("other"))


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def files_by_sprint(files: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Story files of each sprint, and the first page's name."""
    out = files.groupBy("sprint").agg(F.count("*").alias("stories"))
    if pages is None:
        return out.withColumn("page", F.lit(None).cast("string"))
    return out.join(pages.groupBy("sprint").agg(F.min("file_path").alias("page")), "sprint", "full").withColumn("stories", F.coalesce("stories", F.lit(0)))
