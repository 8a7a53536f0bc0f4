"""Deterministic identifiers, computed by built-in functions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.text import normalize_text, text_or_empty

#: Fixed value: the namespace of all identifiers.
NAMESPACE = uuid.UUID("83dfbcb1-c966-4b29-94bd-4d7747288992")
UNIT = "\x1f"


def uuid5(material: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """A version 5 UUID: 128 bits of SHA-1 with the version and variant set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(material, "utf-8")))
    part = lambda start, n: F.substring(digest, start, n)
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(part(17, 1), 16, 10).cast("int") + 1, F.lit(1))
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def stable_uuid(kind: str, *parts: Column | str) -> Column:
    """A UUID of the normalized kind and parts."""
    return uuid5(F.concat_ws(UNIT, normalize_text(F.lit(kind)), *[normalize_text(p) for p in parts]))


def stable_hash(*parts: Column | str) -> Column:
    """SHA-256 of the trimmed parts; null, and the number 0 and false (not the text 0), count as empty."""

    def one(c: Column | str) -> Column:
        value = F.col(c) if isinstance(c, str) else c
        text = value.cast("string")
        nothing = (F.typeof(value) != "string") & text.isin("0", "0.0", "false")
        return F.when(nothing, F.lit("")).otherwise(F.trim(F.coalesce(text, F.lit(""))))

    return F.sha2(F.concat_ws(UNIT, *[one(p) for p in parts]), 256)


def candidate_id(provider: Column | str, provider_id: Column | str, canonical_url: Column | str) -> Column:
    """By the provider's own id, else by the canonical url."""
    own = F.trim(text_or_empty(provider_id))
    return stable_uuid("candidate", provider, F.when(text_or_empty(provider_id) != "", own).otherwise(text_or_empty(canonical_url)))


def organization_id(name: Column | str, domain: Column | str, location: Column | str) -> Column:
    return stable_uuid("organization", name, domain, location)


def person_id(name: Column | str, organization: Column | str) -> Column:
    return stable_uuid("person", name, organization)


def event_id(organization: Column | str, event: Column | str, location: Column | str, date: Column | str) -> Column:
    return stable_uuid("lead-event", organization, event, location, date)


def event_fingerprint(organization: Column | str, event: Column | str, location: Column | str, date: Column | str) -> Column:
    """A hash of the normalized event, its date cut to the day."""
    return stable_hash(normalize_text(organization), normalize_text(event), normalize_text(location), F.substring(text_or_empty(date), 1, 10))
