"""Outreach lines: a template chosen by an answer, its slots checked, the line rendered or the reasons against it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.text import bind, clean_slot, locality, normalize_text, sentence_count, text_or_empty, word_count
from siftline.functions.urls import canonicalize_url

# The opener, the closing questions, and what each template says between them.
OPENER = "Hi [first name], I wanted to reach out after seeing on the news that "
FUTURE = " Is there any chance we could stay in touch regarding your future janitorial needs?"
REVIEW = " Is there any chance you'll be reviewing your janitorial needs?"
SPACE = " Is there any chance you'll be reviewing your janitorial needs, with the additional space?"
BODIES = {
    "acquisition": ("{company} took ownership of {property} in {location}.", FUTURE),
    "opening": ("{property} is opening in {location}.", FUTURE),
    "planned_development": ("plans are moving forward for {project} in {location}.", FUTURE),
    "approval": ("{project} received {approval}.", FUTURE),
    "construction_start": ("construction started on {project} in {location}.", FUTURE),
    "lease_relocation": ("{company} is preparing to occupy {property} in {location}.", FUTURE),
    "site_acquisition": ("{company} acquired {site} in {location}.", FUTURE),
    "expansion": ("{company} is expanding in {location}.", SPACE),
    "funded_facility": ("{funding} is supporting {project_or_expansion}.", FUTURE),
    "renovation_conversion": ("{property} is being renovated into {new_use}.", REVIEW),
    "construction_progress": ("{project} reached {milestone}.", FUTURE),
    "completion": ("{project} was completed in {location}.", FUTURE),
}
UNSENDABLE = ("route_new_owner", "skip_negative", "skip_general")
SHORT_SLOTS = ("company", "project", "project_or_expansion")
SLOTS = sorted({s for body, _ in BODIES.values() for s in re.findall(r"\{(\w+)\}", body)})


def company_reference(value: Column | str, names: Column) -> Column:
    """The way a known name writes the words asked for (at most three), the one with most capitals; '' if none does."""
    asked = clean_slot(value, lowercase=False)
    key = normalize_text(asked)
    inner = F.concat_ws("[^A-Za-z0-9]+", F.split(key, " "))
    pattern = F.concat(F.lit(r"(?i)(?<![A-Za-z0-9])(?<![A-Za-z0-9][&'’.-])("), inner, F.lit(r")(?![A-Za-z0-9])(?![&'’.-][A-Za-z0-9])"))
    found = F.flatten(F.transform(names, lambda n: F.regexp_extract_all(clean_slot(n, lowercase=False), pattern, 1)))
    capitals = lambda c: F.length(F.regexp_replace(c, "[^A-Z]", ""))
    rated = F.transform(found, lambda c, i: F.struct(capitals(c).alias("a"), capitals(F.substring(c, F.lit(2), F.length(c))).alias("b"), (-i).alias("c"), c.alias("text")))
    best = F.array_max(rated)["text"]
    return F.when((key == "") | (word_count(asked) > 3), F.lit("")).otherwise(F.coalesce(best, F.lit("")))


def why_line(template: Column | str, slots: Column, event_allowed: Column, sources: Column, names: Column) -> Column:
    """A struct of text, status (valid, skip or review) and errors.

    slots: a map of text; event_allowed: whether the answer names an event of the company; sources: an array of urls;
    names: the company's known names. A line is rendered only where nothing is wrong with it.
    """
    key = F.btrim(text_or_empty(template))
    given = F.coalesce(slots, F.create_map().cast("map<string,string>"))
    value = lambda s: F.try_element_at(given, F.lit(s))
    has = lambda s: F.map_contains_key(given, s)
    resolved = {s: clean_slot(value(s)) for s in SLOTS}
    resolved["company"], resolved["location"] = company_reference(value("company"), names), locality(value("location"))
    wanted = {k: sorted(re.findall(r"\{(\w+)\}", body)) for k, (body, _) in BODIES.items()} | {k: [] for k in UNSENDABLE}
    required = F.create_map(*[x for k, s in wanted.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in s]).cast("array<string>"))])[key]
    is_known, sendable = key.isin(*wanted), key.isin(*BODIES)
    some = lambda tests: F.exists(F.array(*tests), lambda x: F.coalesce(x, F.lit(False)))
    named = lambda tests: F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests.items()]))
    urls = F.filter(F.transform(F.coalesce(sources, F.array().cast("array<string>")), lambda u: canonicalize_url(u)), lambda u: u.isNotNull())
    none = F.array().cast("array<string>")

    def wrong(r: Column) -> Column:
        """What is wrong with the answer itself. r: the resolved slots, null where they weren't given."""
        long = lambda which, most: some([word_count(r[s]) > most for s in SLOTS if (s in SHORT_SLOTS) == which])
        return named({
            "why_line_company_reference": has("company") & (r["company"] == ""),
            "why_line_location": has("location") & (r["location"] == ""),
            "why_template_unknown": ~is_known,
            "why_line_event_id": ~F.coalesce(event_allowed, F.lit(False)),
            "why_line_unsourced": F.size(urls) == 0,
            "why_line_slots": is_known & (F.array_sort(F.map_keys(given)) != required),
            "why_line_slot_missing": is_known & some([F.array_contains(required, s) & (F.coalesce(r[s], F.lit("")) == "") for s in SLOTS]),
            "why_line_reference_length": (has("company") & (word_count(clean_slot(value("company"), lowercase=False)) > 3)) | (is_known & long(True, 3)),
            "why_line_slot_length": is_known & long(False, 16),
            "why_line_slot_url": is_known & some([F.regexp_like(r[s], F.lit(r"(?i)https?://|www\.")) for s in SLOTS]),
        })

    def line_of(r: Column) -> Column:
        line = None
        for k, (body, question) in BODIES.items():
            text = F.concat(*[r[p[1:-1]] if p.startswith("{") else F.lit(p) for p in re.split(r"(\{\w+\})", OPENER + body + question) if p])
            line = F.when(key == k, text) if line is None else line.when(key == k, text)
        return line

    def misread(r: Column, line: Column) -> Column:
        """What is wrong with the line as it reads."""
        allowed = F.regexp_replace(F.replace(F.replace(line, F.coalesce(F.nullif(r["company"], F.lit("")), F.lit("\x00")), F.lit("")), F.lit("Hi [first"), F.lit("hi [first")), r"(^|[.!?]\s+)[A-Z]|\bI\b", "")
        return named({
            "why_line_word_count": ~word_count(line).between(20, 55),
            "why_line_dash": F.regexp_like(line, F.lit("[—–]")),
            "why_line_sentence_count": (sentence_count(line) != 2) | ~F.endswith(line, F.lit("?")),
            "why_line_case": F.regexp_like(allowed, F.lit("[A-Z]")),
        })

    def judged(line: Column, errors: Column) -> Column:
        fine = F.size(errors) == 0
        status = F.when(~fine, "review").when(sendable, "valid").otherwise("skip")
        return F.struct(F.when(fine & sendable, line).otherwise("").alias("text"), status.alias("status"), errors.alias("errors"))

    def rendered(r: Column, found: Column) -> Column:
        late = lambda line: F.when((F.size(found) == 0) & sendable, misread(r, line)).otherwise(none)
        return bind(line_of(r), lambda line: bind(F.concat(found, late(line)), lambda errors: judged(line, errors)))

    slots_given = F.struct(*[F.when(has(s), resolved[s]).alias(s) for s in SLOTS])
    return bind(slots_given, lambda r: bind(wrong(r), lambda found: rendered(r, found)))
