"""Mailboxes that nothing may be sent to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.contacts import normalize_email
from siftline.operators.fold import LAST, MIN, NON_EMPTY, fold


def fold_suppressions(log: DataFrame) -> DataFrame:
    """Email, suppressed_at (first), reason (last), external_event_id (last that isn't empty)."""
    return fold(log.withColumn("suppressed_at", F.col("at")), ["email"], "seq", {"suppressed_at": MIN, "reason": LAST, "external_event_id": NON_EMPTY})


def may_send(messages: DataFrame, suppressed: DataFrame) -> DataFrame:
    """Messages to mailboxes that aren't suppressed."""
    gone = suppressed.select(normalize_email("email").alias("_mail")).distinct()
    return messages.join(gone, normalize_email("email") == F.col("_mail"), "left_anti")
