"""Analytics over questions to an assistant.

``queries``: conversation_id, is_subagent, line_no, query, intents, word_count and
what ``sources.transcripts.queries`` makes besides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions import stats
from storyloom.functions import text as T


def volume(queries: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    one = queries.agg(
        F.count("*").alias("queries"), F.count_distinct("conversation_id").alias("conversations"), F.round(F.avg("word_count"), 1).alias("mean_words"), F.median("word_count").alias("median_words"),
        F.max("word_count").alias("max_words"), F.min("word_count").alias("min_words"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
    )
    if answers is None:
        return one
    return one.crossJoin(F.broadcast(answers.where("chars > 0").agg(F.round(F.avg("chars"), 0).alias("mean_chars"), F.median("chars").alias("median_chars"))))


def parents(queries: DataFrame) -> DataFrame:
    return queries.where("not is_subagent") if "is_subagent" in queries.columns else queries


def intent_distribution(queries: DataFrame) -> DataFrame:
    """Intents of parents' questions; a question with two counts under both, so the shares may exceed 100."""
    rows = parents(queries)
    total = rows.agg(F.count("*").alias("n"))
    each = rows.select(F.explode("intents").alias("intent")).groupBy("intent").agg(F.count("*").alias("queries"))
    return each.crossJoin(F.broadcast(total)).select("intent", "queries", stats.percent(F.col("queries"), F.col("n")).alias("pct"))


def intent_examples(queries: DataFrame, order: list[str], k: int = 3, chars: int = 100) -> DataFrame:
    """The first questions of each intent."""
    rows = parents(queries).select(F.explode("intents").alias("intent"), *order, F.left("query", F.lit(chars)).alias("query"))
    return stats.top_per_group(rows, ["intent"], [F.col(c) for c in order], k)


def mentions(queries: DataFrame, column: str, order: list[str], k: int = 3) -> DataFrame:
    """What questions mention (stories, components, paths): counts and the first questions."""
    rows = queries.select(F.explode(column).alias("value"), *order, F.left("query", F.lit(80)).alias("query"))
    counts = rows.groupBy("value").agg(F.count("*").alias("n"))
    first = stats.top_per_group(rows, ["value"], [F.col(c) for c in order], k)
    return counts.join(first.groupBy("value").agg(F.array_sort(F.collect_list(F.struct("rank", "query"))).alias("samples")), "value")


def tools(calls: DataFrame) -> DataFrame:
    return calls.groupBy("tool").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tool")


def targets(calls: DataFrame, tool: str, k: int) -> DataFrame:
    """What a tool was most used on; paths from their known top folder on."""
    rows = calls.where((F.col("tool") == tool) & (F.col("target") != ""))
    return rows.groupBy(T.normal_path(F.col("target")).alias("target")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "target").limit(k)


def by_length(queries: DataFrame, answers: DataFrame) -> DataFrame:
    """Parents' conversations: abandoned (one or two questions, at most three answers), long (three or more)."""
    q = parents(queries).groupBy("conversation_id").agg(F.count("*").alias("questions"))
    a = answers.groupBy("conversation_id").agg(F.count("*").alias("answers"))
    rows = q.join(a, "conversation_id", "left").withColumn("answers", F.coalesce("answers", F.lit(0)))
    return rows.withColumns({"abandoned": F.col("questions").between(1, 2) & (F.col("answers") <= 3), "long": F.col("questions") >= 3})
