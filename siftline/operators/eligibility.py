"""Why an event, a recipient or a campaign may not go ahead: arrays of reasons, empty where it may."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.text import text_or_empty
from siftline.operators.coverage import reasons
from siftline.operators.order import cut
from siftline.operators.pick import ROLE_THRESHOLD

#: An id is hot if it is in more than one of so many recipients, and in more than so many rows: there are 8,000 of them at most.
HOT_SHARE, HOT_ROWS = 2000, 1000


def event_eligibility(events: DataFrame, open_reviews: DataFrame | None = None) -> DataFrame:
    """F16: events with exclusion_reasons and crm_eligible. events: lead_event_id, record_status, confidence, score, route."""
    out = events
    held = F.lit(False)
    if open_reviews is not None:
        out = out.join(open_reviews.select(F.col("record_id").alias("lead_event_id"), F.lit(True).alias("_held")).distinct(), "lead_event_id", "left")
        held = F.col("_held")
    why = reasons(
        event_record_not_valid=F.col("record_status") != "valid",
        event_confidence_not_high=F.col("confidence") != "high",
        event_score_zero=F.coalesce("score", F.lit(0)) <= 0,
    )
    route = F.when(F.col("route") != "valid", F.array(F.concat(F.lit("company_route_"), F.col("route")))).otherwise(F.array().cast("array<string>"))
    why = F.concat(why, route, reasons(blocking_open_review=held))
    return out.withColumn("exclusion_reasons", why).withColumn("crm_eligible", F.size("exclusion_reasons") == 0).drop("_held")


def recipient_eligibility(recipients: DataFrame, open_reviews: DataFrame) -> DataFrame:
    """ranked recipients with eligibility_reasons and eligibility_status.

    recipients: rank, role_score, first_name, company_id, person_id, contact_candidate_id, and of the company
    profile_status, why_line_status, why_confidence, anchor_id, anchor_status, anchor_confidence, anchor_score.
    """
    held = open_reviews.select(F.col("record_id").cast("string").alias("_id")).distinct()
    ids = recipients.select("company_id", "person_id", F.explode(F.array(*[F.col(c).cast("string") for c in ("company_id", "anchor_id", "person_id", "contact_candidate_id")])).alias("_id"))
    # An id that very many rows have would be one task's work in a join by id; there can't be many such ids, so they are sent to the rows.
    most = recipients.count() // HOT_SHARE + HOT_ROWS
    hot = cut(ids.where("_id is not null").groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("_id"))
    by_hot = ids.join(F.broadcast(hot.join(held, "_id", "left_semi")), "_id", "left_semi")
    by_rest = ids.join(F.broadcast(hot), "_id", "left_anti").join(held, "_id", "left_semi")
    blocked = by_hot.unionByName(by_rest).select("company_id", "person_id", F.lit(True).alias("_held")).distinct()
    out = recipients.join(blocked, ["company_id", "person_id"], "left")
    first = reasons(
        recipient_not_primary=F.col("rank") != 1,
        recipient_role_score_below_70=F.col("role_score") < ROLE_THRESHOLD,
        company_profile_not_valid=F.col("profile_status") != "valid",
    )
    line = F.when(F.col("why_line_status") != "valid", F.array(F.concat(F.lit("why_line_status_"), F.col("why_line_status")))).otherwise(F.array().cast("array<string>"))
    rest = reasons(
        why_line_confidence_low=~F.col("why_confidence").isin("high", "medium"),
        anchor_record_not_valid=F.col("anchor_status") != "valid",
        anchor_confidence_not_high=F.col("anchor_confidence") != "high",
        anchor_score_zero=F.coalesce("anchor_score", F.lit(0)) <= 0,
        blocking_open_review=F.col("_held"),
        recipient_first_name_missing=text_or_empty("first_name") == "",
    )
    out = out.withColumn("eligibility_reasons", F.concat(first, line, rest)).drop("_held")
    return out.withColumn("eligibility_status", F.when(F.size("eligibility_reasons") == 0, "ready").otherwise("blocked"))


def missing_settings(config: DataFrame, required: list[str]) -> DataFrame:
    """config rows with the names of required columns that are null, '' or false."""
    empty = {c: F.coalesce(F.col(c).cast("string"), F.lit("")).isin("", "false") for c in required}
    return config.withColumn("missing", reasons(**empty))


def changed_fields(df: DataFrame, old: str, new: str) -> DataFrame:
    """df with ``changes``: the entries of the new map that differ from the old map's."""
    return df.withColumn("changes", F.map_filter(F.col(new), lambda k, v: ~v.eqNullSafe(F.try_element_at(F.col(old), k))))


def campaign_violations(live: DataFrame, expected: DataFrame) -> DataFrame:
    """live campaigns and what in them isn't as it was approved. Both: campaign_id, status, manifest_hash, timezone, mailboxes (array)."""
    e = expected.select("campaign_id", *[F.col(c).alias(f"_{c}") for c in ("manifest_hash", "timezone", "mailboxes")], F.lit(True).alias("_known"))
    out = live.join(e, "campaign_id", "left")
    box = lambda c: F.array_sort(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda m: F.lower(F.btrim(m))))
    why = reasons(
        campaign_foreign=F.col("_known").isNull(),
        campaign_not_active=F.coalesce("status", F.lit("")) != "active",
        manifest_hash_mismatch=F.col("_known") & ~F.col("manifest_hash").eqNullSafe(F.col("_manifest_hash")),
        timezone_mismatch=F.col("_known") & ~F.col("timezone").eqNullSafe(F.col("_timezone")),
        mailboxes_mismatch=F.col("_known") & (box("mailboxes") != box("_mailboxes")),
        mailboxes_repeated=F.size(F.array_distinct(box("mailboxes"))) != F.size(box("mailboxes")),
    )
    return out.select("campaign_id", why.alias("errors"))
