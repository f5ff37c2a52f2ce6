"""Usage logs in CSV."""

from __future__ import annotations

import glob
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import text as T

# Columns of the log.
COLUMNS = {
    "user": "User", "kind": "Kind", "model": "Model", "max_mode": "Max Mode",
    "input_with_cache": "Input (w/ Cache Write)", "input_without_cache": "Input (w/o Cache Write)", "cache_read": "Cache Read",
    "output_tokens": "Output Tokens", "total_tokens": "Total Tokens",
}


def discover(args: list[str], root: str = ".") -> list[str]:
    """Files given, else those of the data folder, else those among the downloads."""
    if args:
        return [p for a in args for p in sorted(glob.glob(a)) or [a]]
    return sorted(glob.glob(os.path.join(root, "data/usage/*.csv"))) or sorted(glob.glob(os.path.expanduser("~/Downloads/team-usage-events-*.csv")))


def field(df: DataFrame, name: str) -> Column:
    found = next((c for c in df.columns if c.lstrip("﻿") == name), None)
    return F.coalesce(F.col(f"`{found}`"), F.lit("")) if found else F.lit("")


def read(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Usage events; rows without a readable date are dropped, missing columns are empty or 0."""
    raw = spark.read.csv(paths, header=True, multiLine=True, escape='"').select("*", F.col("_metadata.file_path").alias("__file"))
    raw = raw.withColumn("__line", F.monotonically_increasing_id())
    number = {k: T.lenient_int(field(raw, v)).alias(k) for k, v in list(COLUMNS.items())[4:]}
    ts = T.lenient_timestamp(F.regexp_replace(F.trim(field(raw, "Date")), '^"+|"+$', ""))
    rows = raw.select(ts.alias("ts"), F.to_date(ts).alias("day"), *(field(raw, v).alias(k) for k, v in list(COLUMNS.items())[:4]), *number.values(), T.lenient_float(field(raw, "Cost")).alias("cost"), F.regexp_extract("__file", r"([^/]+)$", 1).alias("source_file"), F.col("__line").alias("line"))
    return rows.where("ts is not null")
