"""Duplicates by key: first, last, and union of arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row for each key, the first in ``order``.

    The least row is kept while partial sums are made, so a key with very many
    rows is shuffled as one row from each task.
    """
    return _keep(rows, keys, order, F.min_by)


def keep_last(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    return _keep(rows, keys, order, F.max_by)


def _keep(rows: DataFrame, keys: list[str], order: list[str | Column], pick) -> DataFrame:
    # min_by can't hash-aggregate structs of strings, but it does combine on the map side
    whole = F.struct(*(F.col(f"`{c}`").alias(c) for c in rows.columns))
    return rows.groupBy(*keys).agg(pick(whole, F.struct(*order)).alias("__r")).select("__r.*")


def array_union(rows: DataFrame, keys: list[str], array: str) -> DataFrame:
    """Sorted distinct values of an array column over the rows of each key.

    Values are made distinct as rows before they are gathered.
    """
    values = rows.select(*keys, F.explode(array).alias("__v")).distinct()
    return values.groupBy(*keys).agg(F.array_sort(F.collect_list("__v")).alias(array))


def numbered(rows: DataFrame, keys: list[str], order: list[str | Column], name: str = "n") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
