"""Feeds: active, pending, degraded or disabled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEVER = 999


def status_after_failure(failures: Column, idle_days: Column) -> Column:
    """T07"""
    return F.when((failures >= 7) | (idle_days >= 30), "disabled").when((failures >= 3) | (idle_days >= 14), "degraded").otherwise("pending")


def feed_states(checks: DataFrame, today: Column) -> DataFrame:
    """feed_id, failures (since the last success) and status. checks: feed_id, seq, day, failed.

    A feed that never had a success counts as idle for good, so its first failure disables it; idle days count only where
    the last check failed. Two aggregates and a join instead of a window, so a feed with many checks isn't one task.
    """
    last = checks.groupBy("feed_id").agg(F.max(F.when(~F.col("failed"), F.col("seq"))).alias("ok_seq"), F.max(F.when(~F.col("failed"), F.col("day"))).alias("ok_day"))
    since = checks.join(last, "feed_id").where("failed and (ok_seq is null or seq > ok_seq)").groupBy("feed_id").agg(F.count(F.lit(1)).alias("failures"))
    out = last.join(since, "feed_id", "left").withColumn("failures", F.coalesce("failures", F.lit(0)))
    idle = F.coalesce(F.date_diff(today, F.col("ok_day")), F.lit(NEVER))
    return out.select("feed_id", "failures", F.when(F.col("failures") == 0, "active").otherwise(status_after_failure(F.col("failures"), idle)).alias("status"))
