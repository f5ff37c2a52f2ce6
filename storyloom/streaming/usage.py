"""Usage events as a stream: duplicates out, sums by window and model, late rows within the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a stream of usage needs; ``sources.usage`` makes the same columns of files.
STREAM = "ts timestamp, user string, model string, input_with_cache bigint, input_without_cache bigint, cache_read bigint, output_tokens bigint, total_tokens bigint, cost double"


def read(spark: SparkSession, path: str, kind: str = "json", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(STREAM).format(kind).option("maxFilesPerTrigger", files_per_trigger).load(path)


def deduplicated(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """The first of events with the same time, user, model and total; state is dropped behind the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["ts", "user", "model", "total_tokens"])


def windowed(events: DataFrame, window: str = "1 day", slide: str | None = None) -> DataFrame:
    """Requests, tokens and cost of each window and model; ``events`` has its watermark already."""
    over = F.window("ts", window, slide) if slide else F.window("ts", window)
    sums = events.groupBy(over.alias("w"), "model").agg(F.count("*").alias("requests"), F.sum("total_tokens").alias("tokens"), F.sum("cost").alias("cost"))
    return sums.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "model", "requests", "tokens", "cost")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Runs of a user's requests without a longer gap."""
    out = events.groupBy(F.session_window("ts", gap).alias("w"), "user").agg(F.count("*").alias("requests"), F.sum("cost").alias("cost"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user", "requests", "cost")


def write(df: DataFrame, path: str, checkpoint: str, once: bool = False):
    """Appends finished rows as Parquet; started again with the same checkpoint it goes on where it was."""
    out = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start(path)


#: Columns that are summed up.
SUMS = ["total_tokens", "cache_read", "input_with_cache", "input_without_cache", "output_tokens", "cost"]


def first_only(events: DataFrame) -> DataFrame:
    """The first to come of events with the same time, user, model and total, however late another one is.

    The state is a key for each event ever seen; ``deduplicated`` bounds it by a watermark.
    """
    return events.dropDuplicates(["ts", "user", "model", "total_tokens"])


def cells(events: DataFrame) -> DataFrame:
    """Sums of each user, model and day so far; as many rows of state as there are of these, whatever the number of events."""
    return events.groupBy("user", "model", F.to_date("ts").alias("day")).agg(F.count("*").alias("requests"), *(F.sum(c).alias(c) for c in SUMS))


def keep_cells(events: DataFrame, path: str, checkpoint: str, once: bool = False):
    """Writes the cells that each batch of the stream changes, in a folder of the batch.

    A batch that is done again after a restart writes the same folder again, so nothing counts twice.
    """

    def save(changed: DataFrame, batch: int) -> None:
        changed.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{path}/part={batch}")

    out = cells(events).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
    return (out.trigger(availableNow=True) if once else out).start()


def running(spark: SparkSession, path: str, group: str) -> DataFrame:
    """What ``operators.usage.per`` says of all events so far: sums and ratios of each user, model or day, from the latest cells."""
    from storyloom.operators.usage import ratios

    latest = spark.read.parquet(path).groupBy("user", "model", "day").agg(F.max_by(F.struct("requests", *SUMS), "batch").alias("c")).select("user", "model", "day", "c.*")
    total = [F.sum(c).alias(c) for c in ("requests", *SUMS[:-1])]
    others = [F.count_distinct(c).alias(f"{c}s") for c in ("user", "model", "day") if c != group]
    return ratios(latest.groupBy(group).agg(*total, F.round(F.sum("cost"), 4).alias("cost"), *others))
