"""Streaming twins of the state machines: the same decisions with the state of a key kept by Spark.

Where the order of a key's rows decides step by step, the state is a row that Python folds. Where aggregates say it all
(suppressions, sequences, provider operations), the batch fold itself runs over the stream: copies merge before the
shuffle, and repeated rows change nothing. ``write_states`` keeps what a stream of states says last, ``latest`` reads it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from siftline.operators.fold import LAST, fold
from siftline.operators.snapshot import Snapshot
from siftline.streaming.feed_health import NEVER
from siftline.streaming.queue import LEAST_LEASE
from siftline.streaming.sequences import fold_states
from siftline.streaming.suppression import fold_suppressions

#: Seconds that a failed item waits for, by its attempts: as the batch expression without its random part.
MOST_BACKOFF = 3600


def backoff(attempts: int) -> int:
    return min(MOST_BACKOFF, 2 ** min(attempts, 10))


_ITEM = "key string, status string, attempts int, seq long"
_FEED = "feed_id string, failures int, ok_day int, seq long, status string"


def queue_states(actions: DataFrame, most_attempts: int) -> DataFrame:
    """Key, status, attempts and seq after each batch's actions. actions: key, seq, action.

    An action that a key has had (its seq isn't above the last) does nothing, so a batch that is repeated changes nothing. An
    action that comes after a later one of its key does nothing either; ``lease_queue`` hands such rows back.
    The state of a key is one row; a completed item keeps it, so that a late copy of an action can't revive it.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, attempts, last = state.get if state.exists else ("pending", 0, -1)
        rows = pd.concat(list(frames)).sort_values("seq")
        for row in rows.itertuples(index=False):
            if row.seq <= last:
                continue
            last = int(row.seq)
            if row.action == "claim":
                status, attempts = "running", attempts + 1
            elif row.action == "complete":
                status = "completed"
            elif row.action == "defer":
                status, attempts = "pending", max(0, attempts - 1)
            elif row.action == "retry":
                status = "dead_letter" if attempts >= most_attempts else "pending"
            elif row.action == "replay":
                status, attempts = ("pending", 0) if status == "dead_letter" else (status, attempts)
            else:
                status = "pending"
        state.update((status, attempts, last))
        yield pd.DataFrame({"key": [key[0]], "status": [status], "attempts": [attempts], "seq": [last]})

    return actions.groupBy("key").applyInPandasWithState(step, _ITEM, "status string, attempts int, last long", "update", GroupStateTimeout.NoTimeout)


class _Leases(StatefulProcessor):
    """One item's state, with a timer for what happens to it without a further row."""

    def __init__(self, most_attempts: int, least_lease: int, keep_seconds: int):
        self.most_attempts, self.least_lease, self.keep_ms = most_attempts, least_lease, keep_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.item = handle.getValueState("item", "status string, attempts int, last long, until long")

    def _timer(self, until: int | None) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if until is not None:
            self.handle.registerTimer(until)

    @staticmethod
    def _out(key: tuple, status: str, attempts: int, seq: int, until: int | None, why: str) -> dict:
        return {"key": key[0], "status": status, "attempts": attempts, "seq": seq, "until": None if until is None else pd.Timestamp(until, unit="ms"), "why": why}

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        status, attempts, last, until = self.item.get() if self.item.exists() else ("pending", 0, -1, None)
        out, changed = [], False
        for row in pd.concat(list(rows)).sort_values("seq").itertuples(index=False):
            if row.seq <= last:  # the same row again says nothing; one that was never seen can't be told from it, so both are handed back
                out.append(self._out(key, row.action, attempts, int(row.seq), None, "late"))
                continue
            last, changed, now = int(row.seq), True, int(pd.Timestamp(row.at).timestamp() * 1000)
            seconds = 0 if pd.isna(row.seconds) else int(row.seconds)
            if row.action == "claim":
                status, attempts, until = "running", attempts + 1, now + 1000 * max(self.least_lease, seconds)
            elif row.action == "complete":
                status, until = "completed", now + self.keep_ms
            elif row.action == "defer":
                status, attempts, until = "waiting", max(0, attempts - 1), now + 1000 * max(self.least_lease, seconds)
            elif row.action == "retry":
                dead = attempts >= self.most_attempts
                status, until = ("dead_letter", None) if dead else ("waiting", now + 1000 * backoff(attempts))
            elif row.action == "replay":
                status, attempts, until = ("pending", 0, None) if status == "dead_letter" else (status, attempts, until)
            else:
                status, until = "pending", None
        if changed:
            self._timer(until)
            self.item.update((status, attempts, last, until))
            out.append(self._out(key, status, attempts, last, until, "action"))
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        status, attempts, last, until = self.item.get()
        if status == "completed":  # kept for as long as a copy of an action may come
            self.item.clear()
            yield pd.DataFrame([self._out(key, "forgotten", attempts, last, until, "kept_long_enough")])
        elif status in ("running", "waiting"):
            self.item.update(("pending", attempts, last, None))
            yield pd.DataFrame([self._out(key, "pending", attempts, last, until, "lease_lost" if status == "running" else "due")])

    def close(self) -> None:
        pass


def lease_queue(actions: DataFrame, most_attempts: int, least_lease: int = LEAST_LEASE, keep_seconds: int = 30 * 86400, delay: str = "0 seconds") -> DataFrame:
    """T02 to T04 over a stream, with timers: each change of an item as key, status, attempts, seq, until and why.

    actions: key, seq, action, at (timestamp), seconds (of a lease or a delay; may be null). An item that is claimed runs until its lease
    ends; then it is pending again, without a further row of its own (why: lease_lost). One that is retried or
    deferred waits, and becomes pending when its time has come (due). A completed one is kept for ``keep_seconds``, so that
    copies of its actions do nothing, and then forgotten. Time is the watermark of ``at``: in
    a queue that stands still nothing becomes due, and Spark drops rows that are later than ``delay``. Another row whose seq isn't above its key's last does nothing, so a batch that is
    repeated changes nothing; it comes back as late, for what keeps the log to look at. Needs the RocksDB state store.
    """
    columns = actions.select("key", "seq", "action", "at", "seconds").withWatermark("at", delay)
    processor = _Leases(most_attempts, least_lease, keep_seconds)
    return columns.groupBy("key").transformWithStateInPandas(processor, "key string, status string, attempts int, seq long, until timestamp, why string", "Update", "EventTime")


def feed_states(checks: DataFrame, today: int) -> DataFrame:
    """feed_id, failures in a row and status after each batch's checks. checks: feed_id, seq, day (a number), failed."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failures, ok_day, last = state.get if state.exists else (0, -1, -1)
        for row in pd.concat(list(frames)).sort_values("seq").itertuples(index=False):
            if row.seq <= last:
                continue
            last = int(row.seq)
            failures, ok_day = (failures + 1, ok_day) if row.failed else (0, max(ok_day, int(row.day)))
        state.update((failures, ok_day, last))
        idle = NEVER if ok_day < 0 else today - ok_day
        status = "active" if not failures else "disabled" if failures >= 7 or idle >= 30 else "degraded" if failures >= 3 or idle >= 14 else "pending"
        yield pd.DataFrame({"feed_id": [key[0]], "failures": [failures], "ok_day": [ok_day], "seq": [last], "status": [status]})

    return checks.groupBy("feed_id").applyInPandasWithState(step, _FEED, "failures int, ok_day int, last long", "update", GroupStateTimeout.NoTimeout)


def suppressions(log: DataFrame) -> DataFrame:
    """T08 over a stream: email, suppressed_at, reason, external_event_id of mailboxes with new rows. log as in the batch fold.

    A mailbox stays suppressed for good, so its state is kept without a watermark: one row for each suppressed mailbox.
    """
    return fold_suppressions(log)


def sequence_states(log: DataFrame, sequences: DataFrame) -> DataFrame:
    """T09, T10 over a stream: sequence_id and state of sequences with new events.

    log: email, event_type (a stream); sequences: sequence_id, email (a table). An event goes to all sequences of its
    mailbox; one of an unknown or null mailbox to none.
    """
    return fold_states(log.join(sequences.select("sequence_id", "email"), "email"))


def operations(log: DataFrame) -> DataFrame:
    """T05 over a stream: operation_key, status, lease_until and seq of operations with new rows; the highest seq decides.

    Whether a started one is uncertain by now depends on the time of reading: ``queue.operations`` over what ``latest``
    gives says it, also for those that no further row comes for.
    """
    return fold(log.withColumn("last", F.col("seq")), ["operation_key"], "seq", {"status": LAST, "lease_until": LAST, "last": LAST}).withColumnRenamed("last", "seq")


def _store(spark: SparkSession, folder: str, keys: list[str], columns: list[str]) -> Snapshot:
    return Snapshot(spark, folder, keys, "_batch", {c: LAST for c in columns}, buckets=16)


def write_states(states: DataFrame, folder: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """What is there now, batch by batch, into a snapshot in ``folder``: one state for each key, the last batch's.

    A batch that is repeated after a failure changes nothing. Buckets with many files are rewritten as the
    stream goes on, so what is kept grows with the keys and not with the batches.
    """
    columns = [c for c in states.columns if c not in keys]

    def write(rows: DataFrame, batch: int) -> None:
        _store(rows.sparkSession, folder, keys, columns).add(rows.withColumn("_batch", F.lit(batch).cast("long")), batch)

    return states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The last state of each key that ``write_states`` has written."""
    stored = spark.read.option("basePath", f"{folder}/data").parquet(f"{folder}/data").columns
    return _store(spark, folder, keys, [c for c in stored if c not in (*keys, "add", "bucket")]).read()
