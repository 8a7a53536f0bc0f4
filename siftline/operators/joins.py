"""Joins of the sales state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_sequences(sequences: DataFrame, recipients: DataFrame) -> DataFrame:
    """Per prospect and campaign its newest sequence, ties by the largest id.

    sequences: sequence_id, primary_recipient_id, campaign_id, updated_at; recipients: recipient_id, prospect_id.
    """
    both = sequences.join(recipients.select(F.col("recipient_id").alias("primary_recipient_id"), "prospect_id"), "primary_recipient_id")
    return both.groupBy("prospect_id", "campaign_id").agg(F.max_by("sequence_id", F.struct("updated_at", "sequence_id")).alias("sequence_id"))


def sequence_events(bridge: DataFrame, events: DataFrame) -> DataFrame:
    """The events of each sequence with their place: the anchor first, then by id. bridge: sequence_id, lead_event_id, event_role."""
    from siftline.operators.pick import ranked

    order = [F.when(F.col("event_role") == "anchor", 0).otherwise(1).asc(), F.col("lead_event_id").asc()]
    return ranked(bridge.join(events, "lead_event_id"), ["sequence_id"], order, "place")


def company_history(events: DataFrame, companies: DataFrame) -> DataFrame:
    """Events with the normalized name of their company, which duplicates are looked for within."""
    from siftline.functions.text import normalize_text

    return events.join(companies.select("company_id", normalize_text("canonical_name").alias("company_key")), "company_id")


def in_scope(rows: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in scope."""
    return rows.join(scope.select(key).distinct(), key, "left_semi")
