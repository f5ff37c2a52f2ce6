"""Chat transcripts, a JSON object a line."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.functions import text as T
from storyloom.sources.stories import decoded_path

ITEM = "struct<role:string,message:struct<content:array<struct<type:string,text:string,name:string,input:map<string,string>>>>>"


def discover(workspace: str, root: str) -> str | None:
    """The folder below ``root`` whose name, letters and digits only, begins most like the workspace's path; None without any likeness."""
    plain = lambda x: re.sub(r"[^a-z0-9]", "", x.lower())
    want = plain(os.path.abspath(workspace))
    likeness = {n: len(os.path.commonprefix([plain(n), want])) for n in sorted(os.listdir(root)) if os.path.isdir(os.path.join(root, n))} if os.path.isdir(root) else {}
    best = max(likeness, key=likeness.get, default=None)
    return os.path.join(root, best) if best and likeness[best] else None


def lines_of(spark: SparkSession, root: str) -> DataFrame:
    """file_path, line_no, line of all transcripts; a large file is read by many tasks, in Spark's own ranges of bytes.

    A line's number is its place in its range and the lines of the file's ranges before, of which there is one row each.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").option("lineSep", "\n").text(root)
    at = F.monotonically_increasing_id()  # in the order of a range's lines
    rows = files.select(decoded_path(F.col("_metadata.file_path")).alias("file_path"), F.col("_metadata.file_block_start").alias("start"), at.alias("at"), F.regexp_replace("value", "\r$", "").alias("line"))
    ranges = rows.groupBy("file_path", "start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file_path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("before", F.coalesce(before, F.lit(0))).select("file_path", "start", "first", "before")
    return rows.join(ranges, ["file_path", "start"]).select("file_path", (F.col("before") + F.col("at") - F.col("first")).cast("int").alias("line_no"), "line")


def scan(spark: SparkSession, root: str) -> DataFrame:
    """conversation_id, is_subagent, line_no, role, content; blank and broken lines and plain-text contents are left out."""
    rows = lines_of(spark, root).where("trim(line) <> ''").withColumn("m", F.from_json("line", ITEM))
    sub = F.contains("file_path", F.lit("/subagents/"))
    name = F.regexp_extract("file_path", r"([^/]+)\.jsonl$", 1)
    return rows.where("m.message.content is not null").select(name.alias("conversation_id"), sub.alias("is_subagent"), "line_no", F.col("m.role").alias("role"), F.col("m.message.content").alias("content"))


def queries(messages: DataFrame) -> DataFrame:
    """Questions of users: the tagged query, else the text without tags; three characters or more."""
    text = F.array_join(F.transform(F.filter("content", lambda i: i["type"] == "text"), lambda i: i["text"]), "\n")
    tagged = F.regexp_extract(text, r"(?s)<user_query>\s*(.*?)\s*</user_query>", 1)
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", " "), r"\s+", " "))
    rows = messages.where("role = 'user'").select("conversation_id", "is_subagent", "line_no", F.nullif(F.trim(F.regexp_extract(text, r"(?s)<timestamp>(.*?)</timestamp>", 1)), F.lit("")).alias("timestamp"), F.when(tagged != "", tagged).otherwise(bare).alias("query"))
    rows = rows.where(F.length("query") >= 3)
    return rows.withColumns({"intents": T.intents(F.col("query")), "stories": T.story_ids(F.col("query")), "components": T.components_mentioned(F.col("query")), "paths": T.paths_mentioned(F.col("query")), "word_count": F.size(F.split(F.trim("query"), r"\s+"))})


def tool_calls(messages: DataFrame) -> DataFrame:
    """Each use of a tool: its name and what it was for."""
    calls = messages.select("conversation_id", "is_subagent", "line_no", F.explode(F.filter("content", lambda i: i["type"] == "tool_use")).alias("c"))
    arg = lambda k: F.col("c.input")[k]
    return calls.select("conversation_id", "is_subagent", "line_no", F.col("c.name").alias("tool"), F.coalesce(arg("path"), arg("glob_pattern"), arg("pattern"), F.left(arg("command"), F.lit(120)), F.lit("")).alias("target"))


def answers(messages: DataFrame) -> DataFrame:
    """Characters of each assistant message's text."""
    text = F.array_join(F.transform(F.filter("content", lambda i: i["type"] == "text"), lambda i: i["text"]), "\n")
    return messages.where("role = 'assistant'").select("conversation_id", "is_subagent", "line_no", F.length(text).alias("chars"))


def flat_queries(found: DataFrame) -> DataFrame:
    """Parents' questions as plain rows."""
    return found.where("not is_subagent").select("timestamp", F.left("conversation_id", F.lit(8)).alias("conversation_id"), F.left("query", F.lit(200)).alias("query"), F.array_join("intents", ", ").alias("intents"), F.array_join("stories", ", ").alias("stories"), "word_count")
