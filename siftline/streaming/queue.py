"""The work queue: claims, retries and leases as expressions on a snapshot, and the fold of a log of actions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.deals import backoff_seconds
from siftline.operators.aggregates import watermark
from siftline.operators.order import cut

MOST_CLAIMED, LEAST_LEASE, LEAST_DELAY = 100, 30, 30


def due(items: DataFrame, now: Column) -> DataFrame:
    """Pending items whose time has come, and running ones whose lease ran out."""
    return items.where(((F.col("status") == "pending") & (F.col("run_after") <= now)) | ((F.col("status") == "running") & (F.col("lease_until") < now)))


def claim(items: DataFrame, now: Column, owner: str, limit: int, lease_seconds: int) -> DataFrame:
    """The next items, as they are once claimed. A claim is a bounded batch: at most a hundred items."""
    taken = due(items, now).orderBy("run_after", "id").limit(max(0, min(limit, MOST_CLAIMED)))
    lease = now + F.make_dt_interval(secs=F.lit(max(LEAST_LEASE, lease_seconds)))
    return taken.withColumns({"status": F.lit("running"), "attempt_count": F.col("attempt_count") + 1, "lease_owner": F.lit(owner), "lease_until": lease})


def after_retry(items: DataFrame, now: Column, most_attempts: int) -> DataFrame:
    """Claimed items that failed: due again after a growing delay, or dead letters."""
    wait = now + F.make_dt_interval(secs=backoff_seconds(F.col("attempt_count")))
    return items.withColumns({"status": F.when(F.col("attempt_count") >= most_attempts, "dead_letter").otherwise("pending"), "run_after": wait, "lease_owner": F.lit(None).cast("string"), "lease_until": F.lit(None).cast("timestamp")})


def after_defer(items: DataFrame, now: Column, delay_seconds: int = 300) -> DataFrame:
    """Blocked items, due later, the attempt given back."""
    wait = now + F.make_dt_interval(secs=F.lit(max(LEAST_DELAY, delay_seconds)))
    return items.withColumns({"status": F.lit("pending"), "attempt_count": F.greatest(F.lit(0), F.col("attempt_count") - 1), "run_after": wait, "lease_owner": F.lit(None).cast("string"), "lease_until": F.lit(None).cast("timestamp")})


def replay_dead_letters(items: DataFrame, now: Column) -> DataFrame:
    """Dead letters as new."""
    dead = F.col("status") == "dead_letter"
    return items.withColumns({"status": F.when(dead, "pending").otherwise(F.col("status")), "attempt_count": F.when(dead, 0).otherwise(F.col("attempt_count")), "run_after": F.when(dead, now).otherwise(F.col("run_after"))})


def fold_actions(log: DataFrame, most_attempts: int) -> DataFrame:
    """Key, status and attempts after a log of enqueue, claim, complete, retry, defer and replay.

    log: key, seq (unique for a key), action. A claim adds an attempt and a defer takes one back, but never below zero: the
    running sum less its smallest value so far, if that is negative. A retry with ``most_attempts`` or more is a dead
    letter; a replay makes a dead letter pending with no attempts, and does nothing to another item. Windows go through a
    key's rows in order and hold none of them. Which replays find a dead letter is decided from one to the next, for all keys
    at once, so there are as many rounds as one item had such replays, and none where nothing is replayed.
    """
    rows = log.select("key", "seq", "action")
    in_order = Window.partitionBy("key").orderBy("seq")
    change = F.when(F.col("action") == "claim", 1).when(F.col("action") == "defer", -1).otherwise(0)

    def counted(some: DataFrame) -> DataFrame:
        sums = some.withColumn("_sum", F.sum(change).over(in_order)).withColumn("_before", F.lag("action").over(in_order))
        return sums.withColumn("attempts", (F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(in_order))).cast("long"))

    while not rows.where("action = 'replay'").isEmpty():
        # What follows a retry that was the last is a dead letter; a replay of anything else, or of what is replayed, is nothing.
        dead = counted(rows).where((F.col("action") == "replay") & (F.col("_before") == "retry") & (F.col("attempts") >= most_attempts))
        first = cut(dead.groupBy("key").agg(F.min("seq").alias("_from")))
        if first.isEmpty():
            break
        action = F.when(F.col("seq") == F.col("_from"), "replayed").otherwise(F.col("action"))
        rows = cut(rows.join(first, "key", "left").where("_from is null or seq >= _from").select("key", "seq", action.alias("action")))
    told = F.when(F.col("action") != "replay", F.col("seq"))
    last = F.max_by("action", told)
    attempts = F.max_by("attempts", "seq")
    status = F.when(last == "claim", "running").when(last == "complete", "completed").when((last == "retry") & (attempts >= most_attempts), "dead_letter").otherwise("pending")
    return counted(rows).groupBy("key").agg(status.alias("status"), attempts.alias("attempts"))


def operations(log: DataFrame, now: Column) -> DataFrame:
    """Provider operations (operation_key, seq, status, lease_until): started ones whose lease ran out are uncertain."""
    last = log.groupBy("operation_key").agg(F.max_by(F.struct("status", "lease_until"), "seq").alias("s"))
    lost = (F.col("s.status") == "started") & (F.col("s.lease_until") < now)
    return last.select("operation_key", F.when(lost, "uncertain").otherwise(F.col("s.status")).alias("status"))


def digest_window(rows: DataFrame, at: str, last_success: Column, now: Column) -> DataFrame:
    """Rows after the last successful run and up to the time this run took before it read anything."""
    return rows.where((F.col(at) > last_success.cast("timestamp")) & (F.col(at) <= now.cast("timestamp")))


def digest_run(rows: DataFrame, at: str, runs: DataFrame, run_at: datetime, send: Callable[[DataFrame], bool]) -> tuple[datetime, bool]:
    """One run over its window; the time that the next window starts from, and whether the run succeeded.

    runs: ran_at of the runs that succeeded; none: all rows up to ``run_at``, which the caller takes before anything is read,
    so a row that arrives while the run lasts falls into the next window. A window without rows is a success and nothing is
    sent; where ``send`` returns False the window stays open, and the next run has it again.
    """
    before = watermark(runs).first()[0] or datetime(1, 1, 1)
    found = digest_window(rows, at, F.lit(before), F.lit(run_at))
    sent = found.isEmpty() or bool(send(found))
    return (run_at if sent else before), sent


def in_replay_window(sent_ms: Column, now_ms: Column, tolerance_ms: int = 300_000) -> Column:
    """T12"""
    return F.abs(now_ms - sent_ms) <= tolerance_ms


def changed(rows: DataFrame, keys: list[str], value: str, order: list[Column]) -> DataFrame:
    """Rows whose value differs from the one before of the same key, with the one before."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("before", before).where(F.col("before").isNotNull() & (F.col("before") != F.col(value)))


def advance_cursor(state: DataFrame, pages: DataFrame) -> DataFrame:
    """Per mailbox the cursor after a sync and whether it has to start over.

    state: mailbox, cursor; pages: mailbox, next_cursor (null if the old one is gone). A cursor never goes back.
    """
    got = pages.groupBy("mailbox").agg(F.max("next_cursor").alias("_next"), F.bool_or(F.col("next_cursor").isNull()).alias("_gone"))
    out = state.join(got, "mailbox", "left")
    gone = F.coalesce("_gone", F.lit(False))
    return out.select("mailbox", F.when(gone, None).otherwise(F.greatest("cursor", F.coalesce("_next", "cursor"))).alias("cursor"), gone.alias("resync"))
