"""Dates and times in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.text import text_or_empty

_MAIL = r"^(?:[A-Za-z]{3},\s*)?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}(?::\d{2})?)\s*(GMT|UTC|UT|Z|[+-]\d{4})?.*$"


def parse_datetime(c: Column | str) -> Column:
    """ISO 8601 (with Z or an offset), a mail header's date, or a text that starts with a date; in UTC, else null."""
    raw = F.btrim(text_or_empty(c))
    iso = F.when(F.regexp_like(raw, F.lit(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:?\d{2})?)?$")), F.regexp_replace(raw, r"([+-]\d{2})(\d{2})$", "$1:$2").try_cast("timestamp"))
    day = F.regexp_extract(raw, _MAIL, 1)
    day = F.when(F.regexp_like(day, F.lit(r":\d{2}:\d{2}$")), day).otherwise(F.concat(day, F.lit(":00")))
    zone = F.regexp_extract(raw, _MAIL, 2)
    zone = F.when(zone.isin("", "GMT", "UTC", "UT", "Z"), F.lit("+0000")).otherwise(zone)
    mail = F.try_to_timestamp(F.concat_ws(" ", day, zone), F.lit("d MMM yyyy HH:mm:ss Z"))
    cut = F.substring(raw, 1, 10)
    start = F.when(F.regexp_like(cut, F.lit(r"^\d{4}-\d{2}-\d{2}$")), cut.try_cast("timestamp"))
    return F.coalesce(iso, mail, start)
