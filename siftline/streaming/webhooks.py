"""Webhooks: exactly-once acceptance, batch and streaming."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftline.operators.fold import MIN
from siftline.operators.order import cut
from siftline.operators.pick import first_per_key
from siftline.operators.snapshot import Snapshot
from siftline.streaming.queue import in_replay_window

KEYS = ["provider", "provider_event_id"]


def accept(hooks: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The first of each provider and event id with a valid signature that isn't known yet."""
    fresh = hooks.where("signature_valid")
    if known is not None:
        fresh = fresh.join(known.select(*KEYS), KEYS, "left_anti")
    return first_per_key(fresh, KEYS, [F.col("received_at").alias("a"), F.col("payload").alias("b")])


def work_items(hooks: DataFrame) -> DataFrame:
    """The work item of each accepted webhook."""
    return hooks.select("provider", F.concat(F.lit("webhook:"), F.col("event_type")).alias("kind"), F.concat_ws(":", *KEYS).alias("dedupe_key"), "payload", F.lit("pending").alias("status"), F.lit(0).alias("attempt_count"), F.col("received_at").alias("run_after"))


def accept_stream(hooks: DataFrame, delay: str = "1 day") -> DataFrame:
    """T01 over a stream: later copies within the watermark's delay are dropped; state is bounded by the delay.

    A copy that is later than that is taken as new: ``accept_for_good`` drops those, too.
    """
    return hooks.where("signature_valid").withWatermark("received_at", delay).dropDuplicatesWithinWatermark(KEYS)


def accepted_store(spark: SparkSession, folder: str, buckets: int = 64) -> Snapshot:
    """The keys that were accepted, for good."""
    return Snapshot(spark, f"{folder}/keys", KEYS, "received_at", {"received_at": MIN}, buckets)


def accept_batch(hooks: DataFrame, batch: int, folder: str, buckets: int = 64) -> None:
    """The hooks of a micro-batch that were never accepted before, to ``folder/accepted/batch=<n>``.

    A copy is dropped however late it comes. Known keys are looked up in the buckets that the batch touches, and in no other.
    The rows are written before their keys, and keys are written once for a batch: a batch that is repeated
    after any failure writes the same rows again in place, or nothing.
    """
    spark = hooks.sparkSession
    store = accepted_store(spark, folder, buckets)
    fresh = cut(accept(hooks))
    if store.last_batch() >= batch:
        return
    touched = {r.b for r in fresh.select(F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).alias("b")).distinct().collect()}
    known = store.read(buckets=touched)
    if known is not None:
        fresh = cut(fresh.join(known.select(*KEYS), KEYS, "left_anti"))
    fresh.write.mode("overwrite").parquet(f"{folder}/accepted/batch={batch}")
    store.add(fresh.select(*KEYS, "received_at"), batch)


def accept_for_good(hooks: DataFrame, folder: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """T01 over a stream, without a watermark: each provider and event id once, ever, in ``folder/accepted``."""
    return run_available(hooks, lambda rows, batch: accept_batch(rows, batch, folder, buckets), checkpoint)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """What is there now, in batches that a restart repeats whole. handle: (rows, batch id)."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hmac_sha256(secret: str, message: Column) -> Column:
    """The HMAC of a text as hex: two hashes over the key, mixed with one fixed byte each, and what follows it."""
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    mixed = lambda byte: F.unhex(F.lit(bytes(b ^ byte for b in key).hex()))
    inner = F.sha2(F.concat(mixed(0x36), F.encode(message, "utf-8")), 256)
    return F.sha2(F.concat(mixed(0x5C), F.unhex(inner)), 256)


def signed(hooks: DataFrame, secret: str, now_ms: int, tolerance_ms: int = 300_000) -> DataFrame:
    """Hooks with ``signature_valid``: the HMAC of timestamp, dot and payload, within the replay window.

    hooks: payload, signature (hex), sent_ms. A null in any of them is no valid signature.
    """
    made = hmac_sha256(secret, F.concat_ws(".", F.col("sent_ms").cast("string"), F.col("payload")))
    whole = F.col("payload").isNotNull() & in_replay_window(F.col("sent_ms"), F.lit(now_ms), tolerance_ms)
    return hooks.withColumn("signature_valid", F.coalesce(whole & (made == F.col("signature")), F.lit(False)))
