"""Caches with an expiry, as of a given time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.ids import stable_hash

NULL_DAYS, CHECK_DAYS = 30, 7


def fresh(cache: DataFrame, now: Column) -> DataFrame:
    """Entries that haven't expired."""
    return cache.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))


def lookup(requests: DataFrame, cache: DataFrame, now: Column, key: str = "cache_key") -> tuple[DataFrame, DataFrame]:
    """Requests with a fresh entry beside them, and the requests without one."""
    kept = fresh(cache, now)
    return requests.join(kept, key), requests.join(kept.select(key), key, "left_anti")


def checked(values: DataFrame, cache: DataFrame, now: Column, kind: str) -> DataFrame:
    """Values with ``result``: true, false or null (unknown or not cached) of a cached check. values: value."""
    keyed = values.withColumn("cache_key", stable_hash(F.lit(kind), "value"))
    found = fresh(cache, now).select("cache_key", F.when(F.col("status") == "true", True).when(F.col("status") == "false", False).alias("result"), F.lit(True).alias("cached"))
    return keyed.join(found, "cache_key", "left").withColumn("cached", F.coalesce("cached", F.lit(False)))


def lookup_outcomes(results: DataFrame, now: Column) -> DataFrame:
    """What of a batch of lookups is cached, and until when: found and fatal for good, null for 30 days, transient not at all."""
    kept = results.where(F.col("status").isin("found", "fatal", "null"))
    return kept.withColumn("expires_at", F.when(F.col("status") == "null", now + F.make_dt_interval(F.lit(NULL_DAYS))))


def within_cap(requests: DataFrame, keys: list[str], order: list[Column], cap: int) -> DataFrame:
    """Requests with ``allowed``: the first ``cap`` new ones of each key in order; those that aren't new are free."""
    spent = F.sum(F.col("is_new").cast("int")).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return requests.withColumn("allowed", ~F.col("is_new") | (spent <= cap))


def policy_verified(log: DataFrame, policy: str) -> DataFrame:
    """The last status of each mailbox under one policy version."""
    return log.where(F.col("policy_version") == policy).groupBy("email").agg(F.max_by("status", "seq").alias("status"), F.max_by("reason", "seq").alias("reason"))
