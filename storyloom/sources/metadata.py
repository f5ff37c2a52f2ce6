"""Metadata trees: files by folder, object dictionaries."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from storyloom.functions import fixed
from storyloom.functions import text as T
from storyloom.sources.stories import decoded_path


def scan(spark: SparkSession, root: str) -> DataFrame:
    """file_path of every file below ``root``; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(decoded_path(F.col("path")).alias("file_path"))


def by_folder(files: DataFrame) -> DataFrame:
    """folder and file_path of the files below a known folder; the first in the path counts."""
    known = F.array(*map(F.lit, fixed.FOLDER_LABELS))
    folder = F.get(F.filter(F.split("file_path", "/"), lambda p: F.array_contains(known, p)), F.lit(0))
    return files.select(folder.alias("folder"), "file_path").where("folder is not null")


def folder_counts(files: DataFrame) -> DataFrame:
    """Files by the first known folder in their path, with the folder's label."""
    labels = F.create_map(*(F.lit(x) for kv in fixed.FOLDER_LABELS.items() for x in kv))
    return by_folder(files).groupBy("folder").agg(F.count("*").alias("files")).withColumn("label", F.coalesce(labels[F.col("folder")], F.col("folder")))


def xml_label(xml: Column) -> Column:
    """Text of the first ``label`` below the root; null if there is none or the XML is broken."""

    @pandas_udf("string")
    def labels(texts: pd.Series) -> pd.Series:
        def one(x):
            try:
                for e in ET.fromstring(x):
                    if e.tag.rpartition("}")[2] == "label":
                        return (e.text or "").strip() or None
            except (ET.ParseError, TypeError):
                pass
            return None

        return texts.map(one)

    return labels(xml)


def object_dictionary(spark: SparkSession, root: str) -> DataFrame:
    """api_name, label, category, namespace, words, initials, field_count, search_variants.

    Folders ``.../objects/<Api>/`` below a folder force-app; of several of one name the first by path.
    """
    read = spark.read.option("recursiveFileLookup", "true")
    own = read.option("pathGlobFilter", "*.object-meta.xml").text(root, wholetext=True).select(decoded_path(F.col("_metadata.file_path")).alias("file_path"), F.col("value").alias("xml"))
    here = r"force-app.*/objects/([^/]+)/"
    paths = scan(spark, root).withColumn("api_name", F.regexp_extract("file_path", here, 1)).where("api_name <> ''").withColumn("folder", F.regexp_extract("file_path", r"^(.*/objects/[^/]+)/", 1))
    first = paths.groupBy("api_name").agg(F.min("folder").alias("folder"))
    fields = paths.join(first, ["api_name", "folder"]).groupBy("api_name", "folder").agg(F.count_if(F.endswith("file_path", F.lit(".field-meta.xml"))).alias("field_count"))
    labels = own.withColumn("folder", F.regexp_extract("file_path", r"^(.*/objects/[^/]+)/", 1)).groupBy("folder").agg(F.min_by("xml", "file_path").alias("xml")).select("folder", xml_label(F.col("xml")).alias("label"))
    api = F.col("api_name")
    words = T.split_camel(T.base_name(api))
    rows = fields.join(labels, "folder", "left").withColumn("label", F.coalesce("label", F.array_join(words, " ")))
    return rows.select("api_name", "label", T.object_category(api).alias("category"), T.namespace(api).alias("namespace"), words.alias("words"), T.initials(words).alias("initials"), "field_count", T.search_variants(api, F.col("label")).alias("search_variants"))
