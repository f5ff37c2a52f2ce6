"""Tables in the shared folder, to cut lineage; sums in an order over all rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shared(df: DataFrame):
    """The Spark context, whose checkpoint folder is set; a temporary one only on one machine that names none."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="storyloom-"))
    return context


def cut(df: DataFrame) -> DataFrame:
    """``df`` from a checkpoint in the session's shared folder."""
    shared(df)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, of which later steps read only the columns they need; it goes with the session."""
    context = shared(df)
    path = f"{context.getCheckpointDir().rstrip('/')}/{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(there)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(table: DataFrame) -> DataFrame:
    """A table as it is scanned, or, if its files are too few to keep all cores at work, dealt to as many partitions.

    A file of one row group is one task, whatever its size.  Tables of more parts than cores aren't shuffled.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if len(table.inputFiles()) < cores else table


def running(rows: DataFrame, order: list[str | Column], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows up to each one in ``order``, which should leave no ties.

    Rows are dealt out in ranges, and what lies before a range is one row each, so that no task sees all rows.
    """
    # the ranges are sampled, so they are fixed before they are used twice
    ranged = cut(rows.repartitionByRange(*order).withColumn("__r", F.spark_partition_id()).withColumn("__v", value))
    sums = ranged.groupBy("__r").agg(F.sum("__v").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = Window.partitionBy("__r").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.withColumn("__s", F.sum("__v").over(near)).join(F.broadcast(sums.select("__r", before.alias("__b"))), "__r")
    return out.withColumn(name, F.col("__b") + F.col("__s")).drop("__r", "__v", "__s", "__b")
