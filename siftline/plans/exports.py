"""Exports: flat files with fixed columns, handoff documents, per-company summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.operators.coverage import missing_references
from siftline.plans.ledger import content_hash

# The order of the columns of the leads file.
LEAD_FIELDS = (
    "link", "business_name", "person", "event", "date_posted", "location", "summary", "why_line", "why_template_key",
    "why_confidence", "why_line_status", "why_sources", "state", "source_site", "aka", "priority", "property_type",
    "service_angle", "filter_reason", "Decision_Makers", "Employee_Count", "Decision_Maker_Sources", "score",
    "lead_event_id", "organization_id", "primary_candidate_id", "supporting_candidate_ids", "run_id", "record_status",
    "provenance_json",
)
PRIORITY_SCORE = 50


def lead_rows(df: DataFrame) -> DataFrame:
    """Df with exactly the file's columns, those it lacks and nulls as '', by score (missing as 0) and id."""
    has = {c.lower(): c for c in df.columns}
    text = lambda c: F.coalesce(F.col(has[c.lower()]).cast("string"), F.lit("")) if c.lower() in has else F.lit("")
    score = F.coalesce(F.col(has["score"]).try_cast("double"), F.lit(0.0)) if "score" in has else F.lit(0.0)
    return df.withColumn("_score", score).orderBy(F.desc("_score"), has.get("lead_event_id", "_score")).select(*[text(c).alias(c) for c in LEAD_FIELDS])


def write_csv(df: DataFrame, path: str) -> None:
    """Text with a header; a failed job leaves no file under the path that readers take for a whole one."""
    df.na.fill("").write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def lead_export(events: DataFrame, organizations: DataFrame, candidates: DataFrame, scores: DataFrame, contacts: DataFrame) -> DataFrame:
    """An event with its organization (required), its primary candidate, score and selected contact (each if known)."""
    out = events.join(organizations.select("organization_id", F.col("canonical_name").alias("business_name")), "organization_id")
    out = out.join(candidates.select(F.col("candidate_id").alias("primary_candidate_id"), F.col("canonical_url").alias("link")), "primary_candidate_id", "left")
    out = out.join(scores.select("lead_event_id", "score"), "lead_event_id", "left")
    return out.join(contacts.where("selected").select("lead_event_id", F.col("person_name").alias("person")), "lead_event_id", "left")


def bucket(score: Column) -> Column:
    """What is worth a call now, and what is kept warm."""
    return F.when(F.coalesce(score, F.lit(0)) >= PRIORITY_SCORE, "priority").otherwise("nurture")


def company_export(recipients: DataFrame) -> DataFrame:
    """Per company its people by status, and the best status that any of them has. recipients: company_id, status."""
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("email", "phone", "none")]
    out = recipients.groupBy("company_id").agg(F.count(F.lit(1)).alias("people"), *counts)
    return out.withColumn("best", F.when(F.col("n_email") > 0, "email").when(F.col("n_phone") > 0, "phone").otherwise("none"))


def handoff(companies: DataFrame, events: DataFrame, recipients: DataFrame, sequences: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """The four frames of a handoff, and a row per frame with its count and content hash."""
    frames = {"companies": companies, "lead_events": events, "recipients": recipients, "sequences": sequences}
    hashes = [content_hash(f).select(F.lit(n).alias("frame"), "n_rows", "content_hash") for n, f in frames.items()]
    out = hashes[0]
    for h in hashes[1:]:
        out = out.unionByName(h)
    return frames, out


def handoff_violations(frames: dict[str, DataFrame]) -> DataFrame:
    """References of a handoff that don't hold: frame, id, violation."""
    checks = (
        ("lead_events", "lead_event_id", "companies", "company_id", "company_id", "event_company_unknown"),
        ("recipients", "recipient_id", "companies", "company_id", "company_id", "recipient_company_unknown"),
        ("sequences", "sequence_id", "companies", "company_id", "company_id", "sequence_company_unknown"),
        ("sequences", "sequence_id", "lead_events", "anchor_lead_event_id", "lead_event_id", "sequence_anchor_unknown"),
        ("sequences", "sequence_id", "recipients", "primary_recipient_id", "recipient_id", "sequence_recipient_unknown"),
    )
    out = None
    for child, id, parent, column, key, code in checks:
        bad = missing_references(frames[child], frames[parent], column, key, code).select(F.lit(child).alias("frame"), F.col(id).cast("string").alias("id"), "violation")
        out = bad if out is None else out.unionByName(bad)
    return out


def push_payload(name: Column, title: Column, email: Column, phone: Column) -> Column:
    """A contact as one text, parts that are missing left out."""
    return F.concat_ws(" | ", *[F.nullif(F.btrim(F.coalesce(c, F.lit(""))), F.lit("")) for c in (name, title, email, phone)])


def deliveries(sent: DataFrame) -> DataFrame:
    """Keys that weren't delivered exactly once. sent: delivery_key, message_id (null if none was found)."""
    return sent.groupBy("delivery_key").agg(F.count("message_id").alias("n")).where("n <> 1")


def run_rows(df: DataFrame, run_id: str, ids: DataFrame | None = None, id: str = "") -> DataFrame:
    """A run's rows, which prunes partitions of a table that is partitioned by run_id, and of those the given ids."""
    rows = df.where(F.col("run_id") == run_id)
    return rows.join(ids.select(id).distinct(), id, "left_semi") if ids is not None else rows


def digest_leads(leads: DataFrame, organizations: DataFrame, notes: DataFrame, phones: DataFrame) -> DataFrame:
    """Leads with their organization's name, their newest note and their person's phones, once each by the last ten digits."""
    from siftline.functions.contacts import phone_key
    from siftline.functions.crm import parse_note

    note = notes.groupBy("lead_id").agg(F.max_by("content", F.struct("added", "note_id")).alias("content")).select("lead_id", parse_note("content").alias("note"))
    numbers = phones.withColumn("_k", phone_key("phone")).where("_k <> ''").groupBy("person_id", "_k").agg(F.min("phone").alias("phone")).groupBy("person_id").agg(F.array_sort(F.collect_list("phone")).alias("phones"))
    out = leads.join(organizations.select("organization_id", F.col("name").alias("organization")), "organization_id", "left")
    return out.join(note, "lead_id", "left").join(numbers, "person_id", "left")


def coverage_export(sources: DataFrame, candidates: DataFrame, events: DataFrame) -> DataFrame:
    """Per source its candidates, those of them that are valid, and the events they led to."""
    found = candidates.groupBy("source_id").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("record_status") == "valid").alias("valid"))
    led = events.join(candidates.select(F.col("candidate_id").alias("primary_candidate_id"), "source_id"), "primary_candidate_id").groupBy("source_id").agg(F.count_distinct("lead_event_id").alias("events"))
    out = sources.select("source_id").join(found, "source_id", "left").join(led, "source_id", "left")
    return out.select("source_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("candidates", "valid", "events")])
