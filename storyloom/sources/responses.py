"""Extractors' responses and other JSON beside them."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.schemas import index_schema
from storyloom.sources.stories import decoded_path

ENVELOPE = "struct<custom_id:string,status:string,output:string,raw_text:string,error:string,usage:struct<input_tokens:int,output_tokens:int>>"


def unfenced(raw: Column) -> Column:
    """Without a code fence around it."""
    return F.trim(F.regexp_replace(raw, r"(?s)^\s*```(?:json)?\s*\n?|\n?```\s*$", ""))


def salvaged(raw: Column, index: str) -> Column:
    """An index's rows out of a response, cut off ones up to their last whole item; null if hopeless."""
    kind = index_schema(index)
    text = unfenced(raw)
    cut = lambda mark: F.concat(F.regexp_extract(text, rf"(?s)^(.*\}}){mark}", 1), F.lit("]}"))
    whole = F.when(F.rlike(text, F.lit(r"(?s)\}\s*$")), F.from_json(text, kind))
    array = index_array(index)
    usable = lambda c: F.when(c[array].isNotNull() & (F.size(c[array]) > 0), c)
    return F.coalesce(whole, usable(F.from_json(cut(r"\s*,"), kind)), usable(F.from_json(cut(""), kind)))


def index_array(index: str) -> str:
    from storyloom.schemas import INDEXES

    return INDEXES[index][0]


def read(spark: SparkSession, folder: str, index: str, compat: bool = False) -> DataFrame:
    """custom_id, status, parsed, raw_text, error in the order of file names.

    What can't be parsed is an error with its text kept; ``compat`` calls it a success.
    """
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).select(F.regexp_extract(decoded_path(F.col("_metadata.file_path")), r"([^/]+)\.json$", 1).alias("file"), F.col("value"))
    rows = files.select("file", "value", F.from_json("value", ENVELOPE).alias("e"))
    raw = F.coalesce(F.col("e.output"), F.col("e.raw_text"), F.col("value"))
    out = rows.select(F.coalesce("e.custom_id", "file").alias("custom_id"), F.col("e.status").alias("said"), salvaged(raw, index).alias("parsed"), raw.alias("raw_text"), F.col("e.error").alias("error"))
    good = F.when(F.coalesce(F.col("said"), F.lit("success")) != "success", F.col("said")).when(F.col("parsed").isNotNull() | F.lit(compat), "success").otherwise("error")
    return out.select("custom_id", good.alias("status"), "parsed", "raw_text", F.when(good == "error", F.coalesce("error", F.lit("not an index"))).otherwise(F.col("error")).alias("error"))


def sidecar(spark: SparkSession, path: str) -> DataFrame | None:
    """A JSON file as one row, None if there is none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.json(path, multiLine=True)


def write_prompts(requests: DataFrame, folder: str) -> int:
    """Prompts for a manual run, one text file each, written by the executors, and a manifest of their ids; how many there are.

    ``folder`` must be one that they all share, such as a mounted file system.
    """
    os.makedirs(folder, exist_ok=True)

    def save(part):
        for r in part:
            whole = os.path.join(folder, r["custom_id"] + ".prompt.md")
            with open(f"{whole}.new", "w", encoding="utf-8") as f:
                f.write(r["prompt"])
            os.replace(f"{whole}.new", whole)  # a task that runs twice leaves one whole file

    requests.select("custom_id", "prompt").foreachPartition(save)
    n = 0
    with open(os.path.join(folder, "manifest.txt"), "w", encoding="utf-8") as f:
        for row in requests.select("custom_id").orderBy("custom_id").toLocalIterator():  # ids only, a partition at a time
            f.write(row["custom_id"] + "\n")
            n += 1
    return n
