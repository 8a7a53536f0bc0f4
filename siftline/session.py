"""Sessions and table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "siftline", **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; conf keys are given with ``__`` for a dot."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
