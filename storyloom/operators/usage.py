"""Usage analytics over events with the columns of ``schemas.USAGE``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions import text as T
from storyloom.operators.dedup import keep_first

KEY = ["ts", "user", "model", "total_tokens"]


def deduplicated(events: DataFrame) -> DataFrame:
    """The first of events with the same time, user, model and total tokens."""
    return keep_first(events, KEY, ["source_file", "line"])


def ratio(a: Column, b: Column, digits: int) -> Column:
    return F.when(b > 0, F.round(a / b, digits)).otherwise(0.0)


def sums() -> list[Column]:
    total = lambda c: F.sum(c).alias(c)
    return [F.count("*").alias("requests"), total("total_tokens"), total("cache_read"), total("input_with_cache"), total("input_without_cache"), total("output_tokens"), F.round(F.sum("cost"), 4).alias("cost")]


def ratios(df: DataFrame) -> DataFrame:
    n, fresh = F.col("requests"), F.col("input_with_cache") + F.col("input_without_cache")
    return df.withColumns({"cost_per_request": ratio(F.col("cost"), n, 4), "tokens_per_request": ratio(F.col("total_tokens"), n, 0), "cache_rate": T.cache_rate(F.col("cache_read"), fresh)})


def overview(events: DataFrame) -> DataFrame:
    one = events.agg(*sums(), F.count_distinct("user").alias("users"), F.count_distinct("model").alias("models"), F.count_distinct("day").alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return ratios(one).withColumns({"cost_per_day": ratio(F.col("cost"), F.col("days"), 4), "requests_per_day": ratio(F.col("requests"), F.col("days"), 1)})


def per(events: DataFrame, group: str) -> DataFrame:
    """Sums and ratios of each user, model or day, and how many of the others it meets."""
    others = [c for c in ("user", "model", "day") if c != group]
    return ratios(events.groupBy(group).agg(*sums(), *(F.count_distinct(c).alias(f"{c}s") for c in others)))


def rollup(events: DataFrame) -> DataFrame:
    """All three groupings in one pass: ``kind`` says which of user, model and day a row is of."""
    kind = F.when(F.grouping("user") == 0, "user").when(F.grouping("model") == 0, "model").otherwise("day")
    return events.groupingSets([["user"], ["model"], ["day"]], "user", "model", "day").agg(kind.alias("kind"), *sums())


def cache_efficiency(events: DataFrame, price: float = 1e-6) -> DataFrame:
    """Overall rate, mean and median of the rows' rounded rates, shares of rows at 70 or more and at 0, estimated saving."""
    fresh = F.col("input_with_cache") + F.col("input_without_cache")
    rows = events.select("cache_read", fresh.alias("fresh"), T.cache_rate(F.col("cache_read"), fresh).alias("rate"))
    one = rows.agg(F.sum("cache_read").alias("c"), F.sum("fresh").alias("f"), F.round(F.avg("rate"), 1).alias("mean_rate"), F.round(F.median("rate"), 1).alias("median_rate"), F.count_if(F.col("rate") >= 70).alias("high"), F.count_if(F.col("rate") == 0).alias("zero"), F.count("*").alias("n"))
    return one.select(T.cache_rate(F.col("c"), F.col("f")).alias("overall_rate"), "mean_rate", "median_rate", "high", "zero", ratio(F.col("high") * 100.0, F.col("n"), 1).alias("high_pct"), F.round(F.col("c") * price, 2).alias("saving"))


def outliers(events: DataFrame, times: float = 3.0) -> DataFrame:
    """Events that cost more than ``times`` the mean."""
    mean = events.agg(F.avg("cost").alias("mean_cost"))
    return events.crossJoin(F.broadcast(mean)).where(F.col("cost") > times * F.col("mean_cost"))


def most_expensive(events: DataFrame, k: int = 10, key: str = "line") -> DataFrame:
    return events.orderBy(F.desc("cost"), key).limit(k)
