"""Counts and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The points of each deterministic criterion.
CRITERIA = {"v1_accounting": 20, "contact_contract_quality": 15, "identity_invariants": 5, "provenance_contracts": 15, "pipeline_integrity": 10, "delivery_usage_apollo": 10}
GREEN_POINTS = 85


def usage_summary(attempts: DataFrame, keys: list[str], usage: str = "usage_json") -> DataFrame:
    """Per key and usage name the sum of its top-level numbers, cut to whole numbers row by row; true counts 1.

    Nested values and text are left out: a value's own type decides. A text that isn't a JSON object, or names a key twice,
    counts as a row only. The names ``attempts`` and ``billable`` count rows.
    """
    parsed = attempts.select(*keys, F.try_parse_json(F.col(usage)).alias("_usage"))
    each = parsed.lateralJoin(attempts.sparkSession.tvf.variant_explode(F.col("_usage").outer()))
    kind = F.schema_of_variant("value")
    number = F.try_variant_get("value", "$", "double").cast("bigint")
    value = F.when(kind == "BOOLEAN", F.try_variant_get("value", "$", "boolean").cast("bigint")).when(F.regexp_like(kind, F.lit("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")), number)
    parts = each.where("key is not null").select(*keys, F.col("key").alias("name"), value.alias("amount"))
    sums = parts.where("amount is not null").groupBy(*keys, "name").agg(F.sum("amount").cast("bigint").alias("total"))
    counts = attempts.groupBy(*keys).agg(F.count(F.lit(1)).alias("attempts"), F.sum(F.coalesce(F.col("billable").cast("int"), F.lit(0))).cast("bigint").alias("billable"))
    return sums.unionByName(counts.unpivot(keys, ["attempts", "billable"], "name", "total"))


def status_counts(df: DataFrame, keys: list[str], status: str, values: list[str]) -> DataFrame:
    """Per key a count of each status, all in one pass."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(status) == v).alias(v) for v in values])


def source_coverage(sources: DataFrame, *found: DataFrame) -> DataFrame:
    """Per source its distinct urls over all ways of finding them, whether any was incomplete, and whether none came.

    found: source_id, url, incomplete.
    """
    whole = found[0]
    for other in found[1:]:
        whole = whole.unionByName(other)
    urls = whole.groupBy("source_id", "url").agg(F.bool_or("incomplete").alias("incomplete"))  # distinct before counted
    counted = urls.groupBy("source_id").agg(F.count("url").alias("urls"), F.bool_or("incomplete").alias("incomplete"))
    out = sources.select("source_id").join(counted, "source_id", "left")
    return out.select("source_id", F.coalesce("urls", F.lit(0)).alias("urls"), F.coalesce("incomplete", F.lit(False)).alias("incomplete"), F.col("urls").isNull().alias("uncovered"))


def problem_histogram(entries: DataFrame, key: str = "feed_id") -> DataFrame:
    """Per feed its entries, those that are valid, and whether most are invalid. entries: key, problem (null if valid)."""
    out = entries.groupBy(key).agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("problem").isNull()).alias("valid"))
    return out.withColumn("mostly_invalid", F.col("entries") - F.col("valid") > F.col("valid"))


def duplicate_titles(df: DataFrame, title: str, id: str) -> DataFrame:
    """Titles that several rows have, with the number of rows and the smallest id."""
    key = F.lower(F.btrim(F.col(title)))
    return df.where(F.btrim(F.col(title)) != "").groupBy(key.alias("title_key")).agg(F.count(F.lit(1)).alias("n"), F.min(id).alias("first_id")).where("n > 1")


def duplicate_mailboxes(ready: DataFrame) -> DataFrame:
    """Mailboxes of several ready sequences, with the number and the smallest id."""
    return ready.groupBy(F.lower(F.btrim("email")).alias("mailbox")).agg(F.count(F.lit(1)).alias("n"), F.min("sequence_id").alias("first_id")).where("n > 1")


def keyed_union(df: DataFrame, keys: list[str], items: str, item_key: str, order: str) -> DataFrame:
    """Per key the items of all its rows' arrays, one for each item key: at its first position, with its last value.

    order: the rows' order within a key; items: arrays of structs that hold item_key.
    """
    place = F.struct(F.col(order).alias("o"), F.col("pos").alias("p"))
    rows = df.select(*keys, order, F.posexplode(items).alias("pos", "item"))
    once = rows.groupBy(*keys, F.col(f"item.{item_key}").alias("_k")).agg(F.min(place).alias("_first"), F.max_by("item", place).alias("_item"))
    made = F.transform(F.array_sort(F.collect_list(F.struct("_first", "_item"))), lambda x: x["_item"])
    return once.groupBy(*keys).agg(made.alias(items))


def company_profiles(events: DataFrame) -> DataFrame:
    """Per company identity (its domain, else its normalized name) its events, names and places.

    events: lead_event_id, organization_id, name, domain, location. Lists are sorted, so they don't depend on order.
    """
    from siftline.functions.text import normalize_text, text_or_empty

    identity = F.coalesce(F.nullif(text_or_empty("domain"), F.lit("")), normalize_text("name"))
    unique = lambda c: F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit(""))))
    return events.withColumn("identity", identity).groupBy("identity").agg(unique("name").alias("names"), unique("location").alias("locations"), F.array_sort(F.collect_set("organization_id")).alias("organization_ids"), F.count_distinct("lead_event_id").alias("n_events"))


def criteria_points(df: DataFrame) -> DataFrame:
    """The points of each criterion, rounded half to even and held within its maximum. df: one row of ratios and flags for each day.

    day, retention, reachable, sourced, identity_ok, collisions, provenance, stages, resumed, intact, sent, usage_recorded, duplicate_attempts.
    """
    yes = lambda c, n: F.when(c, F.lit(n)).otherwise(F.lit(0))
    points = {
        "v1_accounting": F.bround(20 * F.col("retention")),
        "contact_contract_quality": F.bround(15 * (F.col("reachable") + F.col("sourced")) / 2),
        "identity_invariants": yes(F.col("identity_ok") & (F.col("collisions") == 0), 5),
        "provenance_contracts": F.bround(15 * F.col("provenance")),
        "pipeline_integrity": F.bround(4 * F.col("stages")) + yes(F.col("resumed"), 3) + yes(F.col("intact"), 3),
        "delivery_usage_apollo": yes(F.col("sent") == 1, 4) + yes(F.col("usage_recorded"), 3) + yes(F.col("duplicate_attempts") == 0, 3),
    }
    held = [F.greatest(F.lit(0), F.least(p.cast("int"), F.lit(CRITERIA[c]))).alias(c) for c, p in points.items()]
    return df.select("day", *held)


def promotion_gate(cards: DataFrame) -> DataFrame:
    """Over exactly three days' cards: two green ones and none invalid or blocked promote. cards: day, green, invalid."""
    out = cards.agg(F.count(F.lit(1)).alias("days"), F.count_if("green").alias("green_days"), F.array_sort(F.collect_list(F.when(F.col("invalid"), F.col("day")))).alias("invalid_days"))
    ok = (F.col("green_days") >= 2) & (F.size("invalid_days") == 0)
    return out.withColumn("decision", F.when(F.col("days") != 3, F.lit("error_needs_three_days")).when(ok, F.lit("promote_v2")).otherwise(F.lit("retain_v1")))


def watermark(runs: DataFrame, at: str = "ran_at") -> DataFrame:
    """The last run."""
    return runs.agg(F.max(at).alias("watermark"))


def ratio(part: Column, whole: Column) -> Column:
    """A share held within 1; of nothing it is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.least(part / whole, F.lit(1.0)))


def merged_profiles(profiles: DataFrame) -> DataFrame:
    """One profile for each company: the best row's fields, the arrays of all.

    Best: valid before review, more events, the smallest profile id. profiles: company_id, profile_id, record_status,
    why_line, aliases, lead_event_ids.
    """
    order = F.struct((F.col("record_status") != "valid").alias("a"), (-F.size("lead_event_ids")).alias("b"), F.col("profile_id").alias("c"))
    best = F.min_by(F.struct("profile_id", "record_status", "why_line"), order).alias("best")
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return profiles.groupBy("company_id").agg(best, union("aliases"), union("lead_event_ids")).select("company_id", "best.*", "aliases", "lead_event_ids")


def promotion_inputs(expected: DataFrame, retained: DataFrame, quarantined: DataFrame, contacts: DataFrame) -> DataFrame:
    """Per day the shares that the criteria take: retention, reachable, sourced.

    expected, retained, quarantined: day, id; contacts: day, selected, email, phone, linkedin, evidence_count.
    """
    accounted = retained.select("day", "id").union(quarantined.select("day", "id")).distinct()
    kept = expected.distinct().join(accounted.withColumn("_ok", F.lit(1)), ["day", "id"], "left").groupBy("day").agg((F.count("_ok") / F.count(F.lit(1))).alias("retention"))
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    chosen = contacts.where("selected").groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.count_if(filled("email") | filled("phone") | filled("linkedin")).alias("r"), F.count_if(F.col("evidence_count") > 0).alias("s"))
    return kept.join(chosen, "day", "left").select("day", "retention", ratio(F.coalesce("r", F.lit(0)), F.coalesce("n", F.lit(0))).alias("reachable"), ratio(F.coalesce("s", F.lit(0)), F.coalesce("n", F.lit(0))).alias("sourced"))
