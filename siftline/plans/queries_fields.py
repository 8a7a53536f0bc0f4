"""Fields parsed, normalized and judged: what is given is made of the tables' own texts, and SQL works out what must come of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions import contacts, crm, people, scope, templates, text, urls
from siftline.operators.order import spread
from siftline.plans.catalog import query
from siftline.plans.queries_scalar import _n as norm
from siftline.session import table

_KEYS = {"customer": "c_custkey", "documents": "doc_id", "events": "event_id", "orders": "o_orderkey", "pages": "page_id"}


def _sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def over(name: str, doc: str, source: str, given: str, make: Callable[[Column], Column], wanted: str) -> None:
    """Registers a query over all rows of a table: ``make`` of what is given, a text that Spark and the SQL work out of its columns.

    wanted: SQL for the outcome, where g is what is given.
    """
    key = _KEYS[source]

    def run(spark, sf):
        return table(spark, sf, source).withColumn("g", F.expr(given).cast("string")).select(key, make(F.col("g")).cast("string").alias("out"))

    run.__name__, run.__doc__ = name, doc
    query(f"SELECT {key}, ({wanted})::VARCHAR AS out FROM (SELECT *, ({given})::VARCHAR AS g FROM {source})")(run)


def cases(name: str, doc: str, pairs: list[tuple[str | None, str | None]], make: Callable[[Column], Column]) -> None:
    """Registers a query over customer: the case of a row is its key modulo the cases, ``{n}`` in a text is its key."""
    wanted = ", ".join(_sql(w) for _, w in pairs)

    def run(spark, sf):
        key = F.col("c_custkey").cast("string")
        given = F.element_at(F.array(*[F.lit(g).cast("string") for g, _ in pairs]), (F.col("c_custkey") % len(pairs) + 1).cast("int"))
        return table(spark, sf, "customer").select("c_custkey", F.replace(given, F.lit("{n}"), key).alias("given")).select("c_custkey", make(F.col("given")).cast("string").alias("out"))

    run.__name__, run.__doc__ = name, doc
    query(f"SELECT c_custkey, replace(([{wanted}])[(c_custkey % {len(pairs)}) + 1], '{{n}}', c_custkey::VARCHAR) AS out FROM customer")(run)


def _parts(struct: Column, *names: str) -> Column:
    """Fields as one text, nulls as ~."""
    return F.concat_ws("|", *[F.coalesce(struct[n].cast("string"), F.lit("~")) for n in names])


def _plain(c: str) -> str:
    out = f"regexp_replace({c}, '(?s)<[^>]+>', ' ', 'g')"
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{sign}')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


_HIDDEN = "|".join(rf"<{t}\b.*?</{t}\s*>" for t in ("script", "style", "noscript"))
_SQUEEZED = r"trim(regexp_replace(coalesce(g, ''), '\s+', ' ', 'g'))"
_START = "left(text, 60)"

over("company_domains", "P10", "pages", "CASE page_id % 5 WHEN 0 THEN upper(url) WHEN 1 THEN ' ' || replace(replace(url, 'https://', ''), 'http://', '') || ' ' WHEN 2 THEN '' WHEN 3 THEN 'ftp://' || url ELSE url END", urls.normalized_domain,
     "CASE WHEN trim(g) = '' OR starts_with(g, 'ftp') THEN '' ELSE regexp_extract(lower(trim(g)), '^(?:https?://)?([^/?#]*)', 1) END")
over("linkedin_urls", "P12", "pages", "CASE page_id % 5 WHEN 0 THEN 'https://uk.linkedin.com/in/' || split_part(url, '/', 4) || '-' || CAST(page_id AS STRING) WHEN 1 THEN 'https://linkedin.com/company/c' || split_part(url, '/', 4) WHEN 2 THEN 'https://linkedin.com.evil.net/in/p' WHEN 3 THEN url ELSE 'http://www.linkedin.com/in/P-' || split_part(url, '/', 4) || '/?a=b' END", urls.normalize_linkedin,
     "CASE WHEN regexp_matches(g, '^https?://([a-z]+[.])*linkedin[.]com/in/') THEN 'https://www.linkedin.com' || regexp_replace(regexp_extract(g, '^https?://[^/]+([^?#]*)', 1), '/+$', '') ELSE '' END")
over("page_texts", "P19", "pages", "html", text.html_text, _plain(f"regexp_replace(coalesce(g, ''), '(?is){_HIDDEN}', ' ', 'g')"))
over(
    "people_in_lists", "P25: name, title, mailbox and whether it is verified of the people in numbered lists", "customer",
    "CASE c_custkey % 4 WHEN 3 THEN c_name ELSE '1. Ann ' || replace(c_name, '#', '') || chr(10) || 'Title: ' || c_mktsegment || chr(10) || 'Email: ' || CASE WHEN c_custkey % 4 = 0 THEN 'Likely ' ELSE '' END || 'a' || CAST(c_custkey AS STRING) || '@x.com' || chr(10) || '2. Bo Ray - ' || lower(c_mktsegment) END",
    lambda c: F.array_join(F.transform(people.numbered_people(c), lambda p: F.concat_ws("/", p["name"], p["title"], F.coalesce(p["email"], F.lit("~")), p["email_verified"].cast("string"))), ";"),
    "CASE WHEN c_custkey % 4 = 3 THEN '' ELSE 'Ann ' || replace(c_name, '#', '') || '/' || c_mktsegment || '/a' || c_custkey || '@x.com/' || (c_custkey % 4 <> 0) || ';Bo Ray/' || lower(c_mktsegment) || '/~/false' END",
)
over("parsed_notes", "P31", "customer", "CASE c_custkey % 3 WHEN 0 THEN 'Bought by ' || c_name || chr(10) || 'Signal: ' || lower(c_mktsegment) || ' | City: Mesa | Priority: high' WHEN 1 THEN 'Source: x<br>Signal: ' || c_mktsegment || ' | City: Yuma' ELSE '<b>' || c_name || '</b></p>' END", lambda c: _parts(crm.parse_note(c), "summary", "signal", "city", "priority"),
     "CASE c_custkey % 3 WHEN 0 THEN 'Bought by ' || c_name || '|' || lower(c_mktsegment) || '|Mesa|high' WHEN 1 THEN '~|' || c_mktsegment || '|Yuma|~' ELSE c_name || '|~|~|~' END")
over("slugs", "P32", "documents", _START, text.slug, "regexp_replace(regexp_replace(lower(coalesce(g, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')")


@query("SELECT c_custkey, left(sha1(c_name), 8) AS key FROM customer")
def feedback_keys(spark, sf):
    """P32"""
    return table(spark, sf, "customer").select("c_custkey", text.feedback_key("c_name").alias("key"))


cases("company_references", "P34: the way that a known name writes what was asked for", [("acme homes", "ACME Homes"), ("homes", "Homes"), ("four words are too many", ""), ("other{n}", ""), (None, "")], lambda c: templates.company_reference(c, F.array(F.lit("ACME Homes LLC"), F.lit("acme homes of Mesa"))))


_RENDERED = "Hi [first name], I wanted to reach out after seeing on the news that Acme Homes took ownership of the plaza in mesa. Is there any chance we could stay in touch regarding your future janitorial needs?"


@query(f"""SELECT c_custkey, (['valid', 'review', 'skip', 'review'])[(c_custkey % 4) + 1] AS status, CASE WHEN c_custkey % 4 = 0 THEN {_sql(_RENDERED)} ELSE '' END AS line,
(['', 'why_line_company_reference,why_line_location,why_line_slot_missing', '', 'why_template_unknown'])[(c_custkey % 4) + 1] AS errors FROM customer""")
def why_lines(spark, sf):
    """A line is rendered only where nothing is wrong with it."""
    at = (F.col("c_custkey") % 4 + 1).cast("int")
    pick = lambda *values: F.element_at(F.array(*values), at)
    fine = F.create_map(F.lit("company"), F.lit("acme homes"), F.lit("property"), F.lit("The Plaza"), F.lit("location"), F.lit("Mesa, AZ"))
    poor, none = F.create_map(F.lit("company"), F.lit("nobody"), F.lit("location"), F.lit("arizona")), F.create_map().cast("map<string,string>")
    given = spread(table(spark, sf, "customer").select("c_custkey")).select("c_custkey", pick(*map(F.lit, ("acquisition", "expansion", "skip_general", "no such key"))).alias("key"), pick(fine, poor, none, none).alias("slots"))
    made = given.select("c_custkey", templates.why_line("key", F.col("slots"), F.lit(True), F.array(F.lit("https://x.com/a")), F.array(F.lit("Acme Homes LLC"))).alias("made"))
    return made.select("c_custkey", "made.status", F.col("made.text").alias("line"), F.array_join("made.errors", ",").alias("errors"))


over("json_in_prose", "P36", "events", "CASE event_id % 3 WHEN 0 THEN 'none ' || event_type WHEN 1 THEN 'Sure <<ccr:a,b>>: ' || props || ' done' ELSE props END", text.json_object, "CASE WHEN event_id % 3 <> 0 THEN props END")
over("unwrapped_fields", "P37", "events", "CASE event_id % 4 WHEN 0 THEN '{\"value\": \"' || event_type || '\"}' WHEN 1 THEN '\"' || event_type || '\"' WHEN 2 THEN CAST(event_id AS STRING) ELSE 'null' END", crm.unwrap, "coalesce(json_extract_string(g, '$.value'), json_extract_string(g, '$'))")
over("add_times", "P37", "orders", "CASE o_orderkey % 4 WHEN 0 THEN left(CAST(o_orderdate AS STRING), 10) || ' 06:07:08.9' WHEN 1 THEN left(CAST(o_orderdate AS STRING), 10) || 'T10:00' WHEN 2 THEN o_orderpriority ELSE left(CAST(o_orderdate AS STRING), 10) END", lambda c: F.date_format(crm.add_time(c), "yyyy-MM-dd HH:mm:ss"),
     r"CASE WHEN regexp_full_match(left(g, 19), '\d{4}-\d\d-\d\d \d\d:\d\d:\d\d') THEN left(g, 19) WHEN try_cast(left(g, 10) AS DATE) IS NOT NULL THEN left(g, 10) || ' 00:00:00' END")
over("situs_addresses", "P38", "customer", "CASE c_custkey % 3 WHEN 0 THEN ' ' || CAST(c_custkey AS STRING) || ' Main St ' WHEN 1 THEN '' END", lambda c: crm.situs(c, F.lit("Mesa "), F.col("c_mktsegment")), "concat_ws(', ', nullif(trim(coalesce(g, '')), ''), 'Mesa', c_mktsegment)")
over("county_gate", "P38", "documents", f"{_START} || CASE doc_id % 4 WHEN 0 THEN ' , Mesa, AZ' WHEN 1 THEN ' tempe,az' WHEN 2 THEN ' Mesagate, AZ' ELSE ' Mesa TX' END", lambda c: crm.in_county(c, ("Mesa", "Tempe")), r"regexp_matches(lower(coalesce(g, '')), '[ ,]az|az$') AND regexp_matches(lower(coalesce(g, '')), '\b(?:mesa|tempe)\b')")
over("merge_variable_names", "P41", "documents", "'Hi {{firstName}} ' || left(text, 30) || CASE doc_id % 3 WHEN 0 THEN ' {{ city }} {{firstName}}' WHEN 1 THEN ' {{first name}}' ELSE ' }}' END", lambda c: F.concat_ws("|", F.array_join(crm.merge_variables(c)["names"], ","), crm.merge_variables(c)["malformed"].cast("string")),
     r"array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(g, ''), '\{\{\s*([A-Za-z][A-Za-z0-9]*)\s*\}\}', 1))), ',') || '|' || regexp_matches(regexp_replace(coalesce(g, ''), '\{\{\s*([A-Za-z][A-Za-z0-9]*)\s*\}\}', '', 'g'), '\{\{|\}\}')")
over("provider_verdicts", "P42", "events", "CASE event_type WHEN 'click' THEN 'Deliverable' WHEN 'error' THEN 'UNDELIVERABLE ' WHEN 'view' THEN 'accept-all' WHEN 'signup' THEN 'catch all ' || props ELSE event_type END", contacts.verdict,
     "CASE WHEN regexp_matches(lower(trim(g)), 'catch.?all|accept.?all') THEN 'catch_all' WHEN lower(trim(g)) IN ('deliverable', 'valid', 'ok') THEN 'valid' WHEN lower(trim(g)) IN ('undeliverable', 'invalid', 'rejected') THEN 'invalid' ELSE 'unknown' END")
over("lookup_people", "P43", "customer", "CASE c_custkey % 3 WHEN 0 THEN '{\"email\":\"p' || CAST(c_custkey AS STRING) || '@x.com\",\"phone_numbers\":[{\"raw_number\":\"\"},{\"sanitized_number\":\"+1' || CAST(c_custkey AS STRING) || '\"}],\"organization\":{\"name\":\"' || c_name || '\"}}' WHEN 1 THEN '{\"email\":\"email_not_unlocked@domain.com\",\"linkedin_url\":\"https://l/in/' || c_mktsegment || '\"}' END", lambda c: _parts(crm.lookup_person(c), "email", "phone", "linkedin", "organization"),
     "CASE WHEN contains(coalesce(g, ''), 'not_unlocked') THEN '' ELSE coalesce(json_extract_string(g, '$.email'), '') END || '|' || coalesce(json_extract_string(g, '$.phone_numbers[1].sanitized_number'), '') || '|' || coalesce(json_extract_string(g, '$.linkedin_url'), '') || '|' || coalesce(json_extract_string(g, '$.organization.name'), '')")
over("old_decision_makers", "P44, P45", "customer", "CASE c_custkey % 3 WHEN 0 THEN c_name || ' — ' || c_mktsegment || '; Bo ' || CAST(c_custkey AS STRING) WHEN 1 THEN ' ; ' END", lambda c: F.array_join(F.transform(crm.decision_makers(c, F.col("c_name")), lambda p: F.concat_ws("/", p["name"], p["title"])), ";"),
     "coalesce(nullif(array_to_string(list_transform(list_filter(list_transform(string_split(coalesce(g, ''), ';'), lambda p: trim(p)), lambda p: split_part(p, ' — ', 1) <> ''), lambda p: split_part(p, ' — ', 1) || '/' || split_part(p, ' — ', 2)), ';'), ''), c_name || '/')")
over("old_evidence_urls", "P44", "pages", "CASE WHEN page_id % 4 = 3 THEN 'none' ELSE 'see ' || url || '). and ' || url || '; ' || CASE WHEN page_id % 4 = 0 THEN 'http://b.org.' ELSE '' END END", lambda c: F.array_join(crm.evidence_urls(c, F.lit("f")), ","), "CASE page_id % 4 WHEN 3 THEN 'f' WHEN 0 THEN url || ',http://b.org' ELSE url END")
over("old_scores", "P44", "orders", "CASE o_orderkey % 5 WHEN 0 THEN '-1' WHEN 1 THEN CAST(o_custkey % 101 AS STRING) || '.0' WHEN 2 THEN o_orderpriority ELSE ' ' || CAST(o_custkey % 150 AS STRING) || ' ' END", crm.integer_score, "CASE WHEN NOT contains(g, '.') AND try_cast(trim(g) AS INT) BETWEEN 0 AND 100 THEN try_cast(trim(g) AS INT) END")
over("mailboxes", "P46", "documents", "CASE WHEN doc_id % 9 = 0 THEN NULL ELSE ' ' || upper(left(md5(text), 8)) || '@X.com ' END", contacts.normalize_email, "lower(trim(coalesce(g, '')))")
over("split_names", "P47", "documents", _START, lambda c: _parts(contacts.split_name(c), "first", "rest"), f"split_part({_SQUEEZED}, ' ', 1) || '|' || CASE WHEN contains({_SQUEEZED}, ' ') THEN substr({_SQUEEZED}, instr({_SQUEEZED}, ' ') + 1) ELSE '' END")
over("lead_titles", "P47", "documents", "left(text, 300)", lambda c: crm.lead_title(c, F.lit("Ann"), F.col("source")), "left(concat_ws(' — ', coalesce(g, ''), 'Ann', coalesce(nullif(source, ''), g, '')), 255)")
over("push_payloads", "K12: what is missing is left out", "documents", "CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE left(text, 30) END", lambda c: _payload(c), "concat_ws(' | ', nullif(trim(coalesce(g, '')), ''), 'Owner', 'a@x.com')")
over("evidence_url_problems", "P49", "pages", "CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN replace(url, 'http', 'ftp') ELSE '' END", crm.url_violation, "CASE WHEN NOT regexp_matches(g, '^https?://') THEN 'url_not_http' END")
over("json_or_blank", "P50", "events", "CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN ' ' WHEN 2 THEN left(props, 3) END", crm.json_if_present, "trim(coalesce(g, '')) = '' OR json_valid(g)")
over("person_keys", "P50", "documents", _START, crm.person_key, f"lower({_SQUEEZED})")
over("json_texts", "P51: the texts under a key, outer ones first", "events", "CASE event_id % 3 WHEN 0 THEN props ELSE '{\"url\":\"' || event_type || '\",\"x\":[{\"url\":\"b' || CAST(event_id AS STRING) || '\"},{\"y\":{\"url\":\"c\",\"z\":1}},{\"url\":5}]}' END", lambda c: F.array_join(crm.json_strings(c, "url"), ","), "CASE WHEN event_id % 3 = 0 THEN '' ELSE concat_ws(',', json_extract_string(g, '$.url'), json_extract_string(g, '$.x[0].url'), json_extract_string(g, '$.x[1].y.url')) END")
over("assessor_answers", "S27", "customer", "CASE c_custkey % 3 WHEN 0 THEN '{\"results\":[{\"OwnerName\":\"' || c_name || '\",\"APN\":\"1-' || CAST(c_custkey AS STRING) || '\",\"UseType\":\"' || c_mktsegment || '\",\"SitusCity\":\"Mesa\"},{\"APN\":\"2\"}]}' WHEN 1 THEN '{\"results\":[]}' ELSE c_name END", lambda c: F.when(crm.assessor_result(c).isNotNull(), _parts(crm.assessor_result(c), "owner", "apn", "property_type", "address")), "CASE WHEN c_custkey % 3 = 0 THEN c_name || '|1-' || c_custkey || '|' || c_mktsegment || '|Mesa' END")
over("generic_people", "F13", "documents", "CASE doc_id % 4 WHEN 0 THEN 'Property Manager ' || source WHEN 1 THEN split_part(text, ' ', 1) WHEN 2 THEN split_part(text, ' ', 1) || ' Services, Inc.' ELSE left(text, 25) END", contacts.is_generic_person,
     f"lower(trim(coalesce(g, ''))) = '' OR regexp_matches(lower(trim(coalesce(g, ''))), '{'|'.join(contacts.GENERIC_TITLES)}') OR NOT contains({_SQUEEZED}, ' ') OR regexp_replace(list_last(string_split(lower({_SQUEEZED}), ' ')), '[.,]+$', '') IN ({', '.join(_sql(w) for w in contacts.GENERIC_LAST_WORDS)})")
over("single_companies", "F14", "documents", _START, scope.single_company, f"NOT contains(' ' || {norm('g')} || ' ', ' and ')")
over("reachable_contacts", "F15", "events", "CASE event_id % 3 WHEN 0 THEN event_type || '@x.com' WHEN 1 THEN '' END", lambda c: contacts.reachable(c, F.when(F.col("event_id") % 2 == 0, F.lit("")).otherwise(F.col("props"))), "coalesce(g, '') <> '' OR (event_id % 2 <> 0 AND props <> '')")
over("verification_candidates", "F15", "events", "CASE event_type WHEN 'click' THEN 'domain_mx_valid_mailbox_unverified' WHEN 'error' THEN NULL ELSE event_type END", lambda c: contacts.eligible_for_verification(F.when(F.col("event_id") % 5 == 0, "verified").otherwise("unknown"), c), "event_id % 5 = 0 OR coalesce(g, '') = 'domain_mx_valid_mailbox_unverified'")
over("custom_field_values", "X24: own keys, options by id, empties left out", "customer", "CASE c_custkey % 3 WHEN 0 THEN 'Big Site' WHEN 1 THEN c_mktsegment ELSE '' END", lambda c: _fields(c), "CASE WHEN g = '' THEN '{}' ELSE '{\"k1\":\"' || CASE WHEN lower(replace(g, ' ', '_')) = 'big_site' THEN '77' ELSE g END || '\",\"k2\":\"' || g || '\"}' END")
over("offline_screens", "F06", "pages", "CASE page_id % 4 WHEN 0 THEN 'Lease in Tempe ' WHEN 1 THEN 'Lease in Texas ' WHEN 2 THEN 'Lease ' ELSE 'Nothing in Tempe ' END || split_part(url, '/', 5)", lambda c: scope.offline_screen(c, F.lit("https://x.com/a"), F.lit(""), ("construct", "lease")), "CASE WHEN NOT contains(g, 'Lease') THEN 'ambiguous' WHEN contains(g, 'Tempe') THEN 'keep' WHEN contains(g, 'Texas') THEN 'reject' ELSE 'ambiguous' END")
over("archive_scopes", "F07", "pages", "CASE page_id % 4 WHEN 0 THEN 'https://azbex.com/news/' || CAST(page_id AS STRING) WHEN 1 THEN 'https://x.com/arizona/' || CAST(page_id AS STRING) WHEN 2 THEN url ELSE 'https://x.com/' END", lambda c: scope.archive_in_scope(c, F.lit(""), F.lit("https://x.com/arizona/page")), "contains(g, 'azbex.com') OR contains(g, '/arizona/') OR regexp_matches(g, '^https?://[^/?#]+/?($|[?#])')")
over("identity_mismatches", "X05", "customer", "CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN ' ' || upper(c_name) WHEN 2 THEN c_mktsegment ELSE '' END", lambda c: _mismatch(c), f"CASE WHEN {norm('g')} <> '' AND {norm('g')} <> {norm('c_name')} THEN 'name_mismatch' END")


def _payload(c: Column) -> Column:
    from siftline.plans.exports import push_payload

    return push_payload(c, F.lit("Owner "), F.lit("a@x.com"), F.lit(None).cast("string"))


def _fields(c: Column) -> Column:
    from siftline.operators.stages import custom_fields

    values = F.create_map(F.lit("size"), c, F.lit("name"), c, F.lit("unknown"), c)
    names, options = F.create_map(F.lit("size"), F.lit("k1"), F.lit("name"), F.lit("k2")), F.create_map(F.lit("size.big_site"), F.lit("77"))
    return F.to_json(custom_fields(values, names, options))


def _mismatch(c: Column) -> Column:
    from siftline.operators.stages import identity_mismatch

    return identity_mismatch(F.col("c_name"), c, F.lit("Acme"), F.lit("Acme Homes"))


@query("SELECT c_custkey, right('1602555' || lpad(c_custkey::VARCHAR, 4, '0'), 10) AS key FROM customer")
def phone_keys(spark, sf):
    """K07"""
    return table(spark, sf, "customer").select("c_custkey", contacts.phone_key(F.concat(F.lit("+1 (602) 555-"), F.lpad(F.col("c_custkey").cast("string"), 4, "0"))).alias("key"))
