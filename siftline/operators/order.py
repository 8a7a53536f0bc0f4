"""Global numbering without a single task."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set: a temporary one on one machine, an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='siftline-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of df."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, each: int = 20_000) -> DataFrame:
    """df dealt to tasks of about ``each`` rows: for work that is heavy for each row of a table that is few bytes, which Spark would read in few tasks."""
    return df.repartition(max(1, -(-df.count() // each)))


def numbered(df: DataFrame, order: list[str] | list[Column], name: str = "n") -> DataFrame:
    """df with each row's number, from 1, in the order of columns; rows that tie have numbers of their own, in any order.

    Rows are range-partitioned and sorted; a partition's first number follows from the counts of those before it.
    The partitioned rows are checkpointed, so numbers and counts come from the same partitions.
    """
    dealt = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select("_part", F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = dealt.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_place") + F.col("_before")).drop("_part", "_place", "_before")
