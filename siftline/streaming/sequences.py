"""Outreach sequences: approval, enrollment, replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STOPS = ("bounce", "unsubscribe", "complaint")


def fold_states(log: DataFrame) -> DataFrame:
    """sequence_id and state after a log (sequence_id, seq, event_type)."""
    any_of = lambda *kinds: F.bool_or(F.col("event_type").isin(*kinds))
    state = F.when(any_of("reply"), "replied").when(any_of(*STOPS), "stopped").when(any_of("enrolled"), "enrolled").when(any_of("approved"), "approved").otherwise("draft")
    return log.groupBy("sequence_id").agg(state.alias("state"))


def approved(sequences: DataFrame, batches: DataFrame, now: Column) -> DataFrame:
    """Sequences that an unexpired, unrevoked batch of their campaign names with exactly their merge hash.

    sequences: sequence_id, campaign_id, manifest_hash, merge_hash; batches: campaign_id, manifest_hash, expires_at,
    revoked_at, merge_hashes (map of sequence to hash).
    """
    good = batches.where(F.col("revoked_at").isNull() & (F.col("expires_at") > now)).select("campaign_id", "manifest_hash", F.explode("merge_hashes").alias("sequence_id", "merge_hash"))
    return sequences.join(good, ["campaign_id", "manifest_hash", "sequence_id", "merge_hash"], "left_semi")


def conversions(bridge: DataFrame, converted: DataFrame, deals: DataFrame) -> DataFrame:
    """Per event of a converted sequence its new state; sequences that have a deal stay as they are.

    bridge: sequence_id, lead_event_id, event_role; converted, deals: sequence_id.
    """
    new = bridge.join(converted.select("sequence_id").distinct(), "sequence_id", "left_semi").join(deals.select("sequence_id").distinct(), "sequence_id", "left_anti")
    return new.withColumn("state", F.when(F.col("event_role") == "anchor", "converted").otherwise("archived_supporting"))
