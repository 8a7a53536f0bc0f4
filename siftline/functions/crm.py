"""Fields of the sales system and of older files."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.dates import parse_datetime
from siftline.functions.text import squeeze, text_or_empty
from siftline.functions.urls import canonicalize_url


def unwrap(c: Column | str) -> Column:
    """A JSON field that is a bare value or an object with one; null for JSON null or none."""
    raw = F.col(c) if isinstance(c, str) else c
    text = F.btrim(raw)
    inner = F.when(F.startswith(text, F.lit("{")), F.get_json_object(text, "$.value")).when(F.regexp_like(text, F.lit('^".*"$')), F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v")).otherwise(text)
    return F.nullif(inner, F.lit("null"))


def add_time(c: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` or a date."""
    raw = text_or_empty(c)
    whole = F.substring(raw, 1, 19)
    return F.coalesce(F.when(F.regexp_like(whole, F.lit(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")), whole.try_cast("timestamp")), F.when(F.length(raw) >= 10, parse_datetime(F.substring(raw, 1, 10))))


def parse_note(c: Column | str) -> Column:
    """Summary, signal, city and priority of a note in text or HTML."""
    text = F.replace(F.regexp_replace(text_or_empty(c), r"(?i)<br\s*/?>", "\n"), F.lit("</p>"), F.lit("\n"))
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.btrim(x)), lambda x: x != "")
    bare = lambda x: F.btrim(F.regexp_replace(x, "<[^>]+>", ""))
    first = F.get(lines, F.lit(0))
    fields = F.get(F.filter(lines, lambda x: F.startswith(x, F.lit("Signal:")) & F.contains(x, F.lit("|"))), F.lit(0))
    parts = F.filter(F.split(fields, r"\|"), lambda p: F.contains(p, F.lit(":")))
    named = lambda n: F.get(F.transform(F.filter(parts, lambda p: F.lower(F.btrim(F.substring_index(p, ":", 1))) == n), lambda p: bare(F.substring(p, F.instr(p, ":") + 1, F.length(p)))), F.lit(0))
    summary = F.when(~F.startswith(F.lower(first), F.lit("source:")), bare(first))
    return F.struct(summary.alias("summary"), *[named(n).alias(n) for n in ("signal", "city", "priority")])


def situs(street: Column | str, city: Column | str, code: Column | str) -> Column:
    """The parts that are there; null if none is."""
    parts = F.array_compact(F.array(*[F.nullif(F.btrim(text_or_empty(c)), F.lit("")) for c in (street, city, code)]))
    return F.nullif(F.array_join(parts, ", "), F.lit(""))


def in_county(address: Column | str, cities: tuple[str, ...]) -> Column:
    """A city of the county as a whole word, in the state."""
    text = F.lower(text_or_empty(address))
    return F.regexp_like(text, F.lit("[ ,]az|az$")) & F.regexp_like(text, F.lit(r"\b(?:" + "|".join(c.lower() for c in cities) + r")\b"))


def merge_variables(c: Column | str) -> Column:
    """The names in double braces, and whether any brace or name is malformed."""
    text = text_or_empty(c)
    name = r"\{\{\s*([A-Za-z][A-Za-z0-9]*)\s*\}\}"
    rest = F.regexp_replace(text, name, "")
    return F.struct(F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(name), 1))).alias("names"), (F.contains(rest, F.lit("{{")) | F.contains(rest, F.lit("}}"))).alias("malformed"))


def lookup_person(c: Column | str) -> Column:
    """A provider's JSON as email (locked ones are ''), phone, linkedin and organization."""
    raw = F.col(c) if isinstance(c, str) else c
    get = lambda p: F.coalesce(F.get_json_object(raw, p), F.lit(""))
    numbers = F.from_json(F.get_json_object(raw, "$.phone_numbers"), "array<struct<sanitized_number: string, raw_number: string>>")
    spoken = F.transform(F.coalesce(numbers, F.array().cast("array<struct<sanitized_number: string, raw_number: string>>")), lambda n: F.coalesce(F.nullif(n["sanitized_number"], F.lit("")), F.nullif(n["raw_number"], F.lit(""))))
    mail = get("$.email")
    return F.struct(F.when(F.contains(mail, F.lit("email_not_unlocked")), "").otherwise(mail).alias("email"), F.coalesce(F.get(F.array_compact(spoken), F.lit(0)), F.lit("")).alias("phone"), get("$.linkedin_url").alias("linkedin"), get("$.organization.name").alias("organization"))


def decision_makers(c: Column | str, fallback: Column | str) -> Column:
    """Name and title of each ``name — title`` between semicolons, else the fallback's name."""
    parts = F.transform(F.split(text_or_empty(c), ";"), lambda p: F.btrim(p))
    people = F.transform(F.filter(parts, lambda p: F.btrim(F.substring_index(p, " — ", 1)) != ""), lambda p: F.struct(F.btrim(F.substring_index(p, " — ", 1)).alias("name"), F.when(F.contains(p, F.lit(" — ")), F.btrim(F.substring(p, F.instr(p, " — ") + 3, F.length(p)))).otherwise(F.lit("")).alias("title")))
    other = F.btrim(text_or_empty(fallback))
    one = F.when(other != "", F.array(F.struct(other.alias("name"), F.lit("").alias("title")))).otherwise(F.array().cast("array<struct<name:string,title:string>>"))
    return F.when(F.size(people) > 0, people).otherwise(one)


def evidence_urls(c: Column | str, fallback: Column | str) -> Column:
    """Distinct urls in a text, closing punctuation off, else the fallback."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(text_or_empty(c), F.lit(r"(https?://[^\s,;]+)"), 1), lambda u: F.regexp_replace(u, r"[.)\]]+$", "")))
    return F.when(F.size(found) > 0, found).otherwise(F.array(text_or_empty(fallback)))


def integer_score(c: Column | str) -> Column:
    """A whole number from 0 to 100, else null; 0 is one."""
    value = F.btrim(text_or_empty(c)).try_cast("int")
    return F.when(value.between(0, 100) & ~F.contains(text_or_empty(c), F.lit(".")), value)


def employee_label(count: Column | str, scope: Column | str, as_of: Column | str) -> Column:
    """P30"""
    number, detail = F.btrim(text_or_empty(count)), F.concat_ws(", ", *[F.nullif(F.btrim(text_or_empty(c)), F.lit("")) for c in (scope, as_of)])
    return F.when((number != "") & (detail != ""), F.concat(number, F.lit(" ("), detail, F.lit(")"))).otherwise(number)


def person_label(name: Column | str, title: Column | str, scope: Column | str) -> Column:
    """P30"""
    extra = lambda c, a, b: F.when(text_or_empty(c) != "", F.concat(F.lit(a), text_or_empty(c), F.lit(b))).otherwise(F.lit(""))
    return F.concat(text_or_empty(name), extra(title, " — ", ""), extra(scope, " (", ")"))


def lead_title(organization: Column | str, person: Column | str, event: Column | str) -> Column:
    """At most 255 characters."""
    subject = F.coalesce(F.nullif(text_or_empty(event), F.lit("")), text_or_empty(organization))
    return F.substring(F.concat_ws(" — ", text_or_empty(organization), text_or_empty(person), subject), 1, 255)


def person_key(c: Column | str) -> Column:
    """P50"""
    return F.lower(squeeze(text_or_empty(c)))


def json_if_present(c: Column | str) -> Column:
    """P50: blank, or JSON."""
    raw = F.btrim(text_or_empty(c))
    return (raw == "") | F.try_parse_json(raw).isNotNull()


def url_violation(c: Column | str) -> Column:
    """Why a url can't be evidence, or null."""
    return F.when(canonicalize_url(c).isNull(), "url_not_http")


def json_strings(c: Column | str, key: str) -> Column:
    """Every text under a key anywhere in a JSON value, in its order. Objects nest without bound, so batches go through json."""

    def find(text: str | None) -> list[str]:
        try:
            todo, out = [json.loads(text or "null")], []
        except ValueError:
            return []
        while todo:
            now = todo.pop()
            if isinstance(now, dict):
                out += [v for k, v in now.items() if k == key and isinstance(v, str)]
                todo += reversed([v for v in now.values() if isinstance(v, (dict, list))])
            elif isinstance(now, list):
                todo += reversed(now)
        return out

    @F.pandas_udf("array<string>")
    def strings(values: pd.Series) -> pd.Series:
        return values.map(find)

    return strings(c)


def assessor_result(c: Column | str) -> Column:
    """Owner, parcel number and use of the first result of a lookup's JSON; null if there is none or it isn't JSON."""
    raw = F.col(c) if isinstance(c, str) else c
    first = F.get_json_object(raw, "$.results[0]")
    get = lambda *names: F.coalesce(*[F.nullif(F.btrim(F.get_json_object(first, f"$.{n}")), F.lit("")) for n in names])
    return F.when(first.isNotNull(), F.struct(get("Ownership", "OwnerName").alias("owner"), get("APN", "ParcelNumber").alias("apn"), get("PropertyType", "UseType").alias("property_type"), situs(get("SitusAddress"), get("SitusCity"), get("SitusZip")).alias("address")))
