"""Expressions on one row."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.functions import contacts, dates, deals, ids, text, urls
from siftline.functions.text import FOLDS
from siftline.operators import similarity
from siftline.plans.catalog import query
from siftline.plans.domain import LEAD_EVENTS, lead_events, log, pages
from siftline.session import table

_FOLDED = "lower(coalesce({0}, ''))"
for _letter, _others in FOLDS.items():
    _FOLDED = f"replace({_FOLDED}, '{_letter}', '{_others}')"
_NORM = f"trim(regexp_replace({_FOLDED}, '[^a-z0-9]+', ' ', 'g'))"


def _n(c: str) -> str:
    return _NORM.format(c)


@query(f"SELECT doc_id, {_n('text')} AS normal FROM documents")
def normalize_text(spark, sf):
    """P01"""
    return table(spark, sf, "documents").select("doc_id", text.normalize_text("text").alias("normal"))


_UUID = """WITH d AS (SELECT c_custkey, 'organization' || chr(31) || {name} || chr(31) || chr(31) AS m FROM customer),
h AS (SELECT c_custkey, sha1(unhex('83dfbcb1c9664b2994bd4d7747288992') || encode(m)) AS s FROM d)
SELECT c_custkey, left(s, 8) || '-' || s[9:12] || '-5' || s[14:16] || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', s[17:17]), 1) || s[18:20] || '-' || s[21:32] AS organization_id FROM h"""


@query(_UUID.format(name=_n("c_name")))
def stable_uuid_org(spark, sf):
    """An organization's id."""
    return table(spark, sf, "customer").select("c_custkey", ids.organization_id("c_name", F.lit(""), F.lit("")).alias("organization_id"))


@query("SELECT doc_id, sha256(trim(coalesce(lang, '')) || chr(31) || trim(coalesce(source, '')) || chr(31) || CASE WHEN n_chars = 0 THEN '' ELSE n_chars::VARCHAR END) AS h FROM documents")
def stable_hash_doc(spark, sf):
    """P05"""
    return table(spark, sf, "documents").select("doc_id", ids.stable_hash("lang", "source", "n_chars").alias("h"))


@query(f"WITH {LEAD_EVENTS} SELECT lead_event_id, sha256(company_id::VARCHAR || chr(31) || priority || chr(31) || record_status || chr(31) || left(date_posted::VARCHAR, 10)) AS fingerprint FROM lead_events")
def event_fingerprint(spark, sf):
    """P07"""
    return lead_events(spark, sf).select("lead_event_id", ids.event_fingerprint(F.col("company_id").cast("string"), "priority", "record_status", F.col("date_posted").cast("string")).alias("fingerprint"))


@query("WITH h AS (SELECT page_id, string_split(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '.') AS l FROM pages) SELECT page_id, array_to_string(l[greatest(1, len(l) - 1):], '.') AS domain FROM h")
def registrable_domain(spark, sf):
    """P08"""
    return pages(spark, sf).select("page_id", urls.registrable_domain("url").alias("domain"))


@query("""WITH w AS (SELECT DISTINCT regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\\.', '') AS h FROM pages), h AS (SELECT h FROM w UNION SELECT regexp_replace(h, '^(?:m|blog)\\.', '') FROM w)
SELECT a.h AS left_host, b.h AS right_host FROM h a JOIN h b ON a.h < b.h AND (ends_with(a.h, '.' || b.h) OR ends_with(b.h, '.' || a.h))""")
def same_site_pairs(spark, sf):
    """Hosts where one is a subdomain of the other, found by their own suffixes."""
    h = pages(spark, sf).select(F.regexp_replace(urls.host("url"), r"^www\.", "").alias("h"))
    h = h.select(F.explode(F.array("h", F.regexp_replace("h", r"^(?:m|blog)\.", ""))).alias("h")).distinct()  # a site's own host beside its mobile one and its blog
    labels = F.split("h", r"\.")
    up = h.select("h", F.explode(F.transform(F.sequence(F.lit(2), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("parent")).where("parent <> ''")
    return up.join(h.select(F.col("h").alias("parent")), "parent").select(F.least("h", "parent").alias("left_host"), F.greatest("h", "parent").alias("right_host"))


_HINTS = "|".join(urls.ARTICLE_HINTS)
_SCORE = """WITH p AS (SELECT page_id, CASE WHEN regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '') = '' THEN '/' ELSE lower(regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '')) END AS path, trim(regexp_replace(regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'si'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS title FROM pages)
SELECT page_id, (CASE WHEN path = '/' OR regexp_matches(path, '\\.(css|csv|doc|docx|gif|ico|jpeg|jpg|js|json|mp3|mp4|pdf|png|rss|svg|webp|xml|zip)$') OR regexp_matches(path || '/', '/(about|advertise|author|authors|careers|category|contact|events|login|privacy|search|subscribe|tag|terms)/') THEN 0
  ELSE CASE WHEN regexp_matches(path, '{hints}') THEN 2 ELSE 0 END + CASE WHEN len(list_filter(regexp_split_to_array(regexp_extract(path, '([^/]*)$', 1), '[-_\\s]+'), lambda w: w <> '')) >= 4 THEN 2 ELSE 0 END + CASE WHEN length(title) >= 25 THEN 1 ELSE 0 END{more} END)::INT AS score FROM p"""


@query(_SCORE.format(hints=_HINTS, more=f" + CASE WHEN regexp_matches({_n('title')}, '{'|'.join(urls.EVENT_TERMS)}') AND regexp_matches({_n('title')}, '{'|'.join(urls.PROPERTY_TERMS)}') THEN 2 ELSE 0 END + CASE WHEN regexp_matches({_n('title')}, '\\b({'|'.join(urls.PLACE_TERMS)})\\b') THEN 1 ELSE 0 END"))
def article_score(spark, sf):
    """P28"""
    return pages(spark, sf).select("page_id", urls.article_score("url", text.html_title("html"), F.lit("https://example.com/")).alias("score"))


@query(_SCORE.format(hints="|".join(urls.LEGACY_ARTICLE_HINTS), more=""))
def article_score_legacy(spark, sf):
    """P28, as it was: fewer hints, titles' words not read."""
    return pages(spark, sf).select("page_id", urls.article_score("url", text.html_title("html"), F.lit("https://example.com/"), legacy=True).alias("score"))


@query("SELECT event_id, ts::DATE::VARCHAR AS d, NULL::VARCHAR AS bad FROM events")
def date_from_url(spark, sf):
    """Dates out of paths in both forms, and none out of a path that only looks like one."""
    e = log(spark, sf)
    path = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "/yyyy/MM/dd/")).otherwise(F.date_format("ts", "/a/yyyy-M-d/"))
    return e.select("event_id", urls.date_from_url(F.concat(F.lit("https://x.com"), path, F.lit("title"))).cast("string").alias("d"), urls.date_from_url(F.concat(F.lit("https://x.com/2024/13/"), F.dayofmonth("ts").cast("string"), F.lit("/2024-01-01"))).cast("string").alias("bad"))


@query("SELECT c_custkey, trim(regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g')) AS k FROM customer")
def org_name_key(spark, sf):
    """A key that business suffixes don't change."""
    ends = F.element_at(F.array(*[F.lit(x) for x in (" LLC", ", L.L.C.", " Inc.", " Co", "")]), (F.col("c_custkey") % 5 + 1).cast("int"))
    return table(spark, sf, "customer").select("c_custkey", text.org_name_key(F.concat("c_name", ends)).alias("k"))


@query("""SELECT DISTINCT p_name, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z][a-z\\-]+'), lambda w: length(w) >= 3 AND NOT list_contains(['square','feet','foot','sqft','million','billion','units','unit','acre','acres','story','stories','from','with','into','near','that','this','they','their','will','have','more','than','tops','for','the','and','new'], w)))), ' ') AS tokens FROM part""")
def title_tokens(spark, sf):
    """P21"""
    return table(spark, sf, "part").select("p_name").distinct().select("p_name", F.array_join(text.title_tokens("p_name"), " ").alias("tokens"))


@query("""WITH w AS (SELECT DISTINCT p_name, unnest(string_split(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' ')) AS w FROM part) SELECT p_name, array_to_string(list_sort(list(DISTINCT regexp_replace(w, 's+$', ''))), ' ') AS tokens FROM w
WHERE length(w) >= 3 AND w NOT IN ('and', 'for', 'the', 'new', 'may', 'plans', 'planned', 'project', 'arizona') AND w <> string_split(lower(p_name), ' ')[1] GROUP BY p_name""")
def duplicate_tokens(spark, sf):
    """A title's stems without the company's own words."""
    titles = table(spark, sf, "part").select("p_name").distinct()
    out = titles.select("p_name", similarity.duplicate_tokens("p_name", F.substring_index("p_name", " ", 1)).alias("t"))
    return out.where(F.size("t") > 0).select("p_name", F.array_join("t", " ").alias("tokens"))


@query("SELECT s_suppkey, 'Supplier ' || s_suppkey AS name, 'Site Lead, West' AS role, 's' || s_suppkey || '@example.com' AS email, s_suppkey % 2 = 0 AS email_likely, '602-555-' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0') AS phone FROM supplier")
def unpack_contacts(spark, sf):
    """Packed contacts, whose parts come in either order."""
    k = F.col("s_suppkey")
    mail = F.concat(F.when(k % 2 == 0, "Likely ").otherwise(""), F.lit("s"), k.cast("string"), F.lit("@example.com"))
    phone = F.concat(F.lit("602-555-"), F.lpad((k % 10000).cast("string"), 4, "0"))
    raw = F.when(k % 3 == 0, F.concat_ws(" | ", F.concat(F.lit("Supplier "), k.cast("string")), F.lit("Site Lead"), F.lit("West"), mail, phone)).otherwise(F.concat_ws("|", F.concat(F.lit("Supplier "), k.cast("string")), phone, F.lit("Site Lead"), F.lit("West"), mail))
    return table(spark, sf, "supplier").select("s_suppkey", contacts.unpack_contact(raw).alias("c")).select("s_suppkey", "c.*")


@query("""SELECT p_partkey, CASE WHEN lower(p_type) LIKE '%standard%' THEN 'owner' WHEN lower(p_type) LIKE '%small%' THEN 'c_suite' WHEN lower(p_type) LIKE '%medium%' THEN 'vp' WHEN lower(p_type) LIKE '%large%' THEN 'director' WHEN lower(p_type) LIKE '%economy%' THEN 'manager' ELSE '' END AS seniority FROM part""")
def seniority(spark, sf):
    """P26"""
    kind = F.lower("p_type")
    title = F.when(kind.like("%standard%"), "Founder & CEO").when(kind.like("%small%"), "Regional COO").when(kind.like("%medium%"), "VP Sales").when(kind.like("%large%"), "Director, Ops").when(kind.like("%economy%"), "Site Manager").otherwise("Clerk")
    return table(spark, sf, "part").select("p_partkey", contacts.seniority(title).alias("seniority"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '+1' || lpad(c_custkey::VARCHAR, 10, '6') WHEN 1 THEN '+44' || lpad(c_custkey::VARCHAR, 10, '7') WHEN 2 THEN '' ELSE '+1' || lpad(c_custkey::VARCHAR, 10, '5') END AS phone FROM customer")
def normalize_phone(spark, sf):
    """P11"""
    k = F.col("c_custkey")
    digits = lambda fill: F.lpad(k.cast("string"), 10, fill)
    raw = F.when(k % 4 == 0, F.concat(F.lit("("), F.left(digits("6"), F.lit(3)), F.lit(") "), F.right(digits("6"), F.lit(7)))).when(k % 4 == 1, F.concat(F.lit("+44 "), digits("7"))).when(k % 4 == 2, F.lit("555-0199")).otherwise(F.concat(F.lit("1."), digits("5")))
    return table(spark, sf, "customer").select("c_custkey", contacts.normalize_phone(raw).alias("phone"))


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'email_syntax_invalid' WHEN 2 THEN 'email_domain_disposable' WHEN 3 THEN 'email_generic_role_mailbox' WHEN 4 THEN 'email_domain_organization_mismatch' ELSE '' END AS reason FROM customer""")
def email_rejection(spark, sf):
    """F11"""
    k = F.col("c_custkey")
    host = F.element_at(F.array(*[F.lit(x) for x in ("acme.com", "acme", "yopmail.com", "acme.com", "other.org", "mail.acme.com")]), (k % 6 + 1).cast("int"))
    local = F.when(k % 6 == 3, F.lit("Info+x")).otherwise(F.concat(F.lit("c"), k.cast("string")))
    return table(spark, sf, "customer").select("c_custkey", contacts.email_rejection(F.concat(local, F.lit("@"), host), F.array(F.lit("www.Acme.com"), F.lit(""))).alias("reason"))


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'verified' WHEN 1 THEN 'rejected' WHEN 2 THEN 'unknown' WHEN 3 THEN 'unknown' ELSE 'rejected' END AS status,
CASE c_custkey % 5 WHEN 0 THEN 'external_email_verifier_valid' WHEN 1 THEN 'email_domain_has_no_mx' WHEN 2 THEN 'domain_mx_valid_mailbox_unverified' WHEN 3 THEN 'sourced_contact_method_external_verification_unavailable' ELSE 'no_valid_contact_method' END AS reason FROM customer""")
def contact_verification(spark, sf):
    """F12"""
    k = F.col("c_custkey")
    mail = F.when(k % 5 < 3, F.lit("Ann@Acme.com")).otherwise("")
    phone = F.struct(F.when(k % 5 == 3, "6025550100").otherwise("").alias("raw"), contacts.normalize_phone(F.when(k % 5 == 3, "6025550100").otherwise("")).alias("value"))
    link = F.struct(F.lit("").alias("raw"), F.lit("").alias("value"))
    mx = F.when(k % 5 == 1, False).when(k % 5 < 3, True)
    out = contacts.verify(mail, phone, link, F.array(F.lit("acme.com")), mx, F.when(k % 5 == 0, True))
    return table(spark, sf, "customer").select("c_custkey", out.alias("v")).select("c_custkey", "v.status", "v.reason")


@query("""WITH r(property_type, rate) AS (VALUES ('office', 2.25), ('industrial', 0.55), ('multifamily', 100.0), ('retail', 1.5), ('medical', 3.0), ('mixed', 1.75), ('other', 1.0)),
a AS (SELECT p_partkey, (p_size * 1000 * CASE WHEN p_partkey % 10 = 0 THEN 200 ELSE 1 END) * CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 END AS sqft, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS units, CASE WHEN p_partkey % 5 = 0 THEN p_retailprice * 1000 END AS dollars, ['office', 'industrial', 'hotel', 'retail', 'medical'][p_partkey % 5 + 1] AS property_type FROM part)
SELECT p_partkey, CASE WHEN sqft > 0 AND sqft <= 5000000 AND rate IS NOT NULL THEN trunc(sqft * rate::DOUBLE * 12)::BIGINT WHEN units <> 0 THEN (units * 1440)::BIGINT WHEN dollars <> 0 THEN trunc(dollars * 0.002::DOUBLE)::BIGINT END AS estimate,
CASE WHEN sqft > 0 AND sqft <= 5000000 AND rate IS NOT NULL THEN 'sqft' WHEN units <> 0 THEN 'units' WHEN dollars <> 0 THEN 'dollar' ELSE 'none' END AS basis FROM a LEFT JOIN r USING (property_type)""")
def deal_size(spark, sf):
    """P29"""
    k = F.col("p_partkey")
    sqft = F.col("p_size") * 1000 * F.when(k % 10 == 0, 200).otherwise(1) * F.when(k % 4 == 0, 0).otherwise(1)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("office", "industrial", "hotel", "retail", "medical")]), (k % 5 + 1).cast("int"))
    out = deals.deal_size(sqft, F.when(k % 3 == 0, F.col("p_size")), F.when(k % 5 == 0, F.col("p_retailprice") * 1000), kind)
    return table(spark, sf, "part").select("p_partkey", out.alias("d")).select("p_partkey", "d.estimate", "d.basis")


@query("""SELECT doc_id, quality, CASE WHEN doc_id % 7 = 0 THEN 'not_az' WHEN toxic = 1 THEN 'low_priority' WHEN doc_id % 3 = 0 AND (doc_id % 10) / 10.0 < 0.6 THEN 'other_low_conf' WHEN (doc_id % 10) / 10.0 < 0.5 THEN 'low_conf' END AS reason FROM labels""")
def drop_reason(spark, sf):
    """the first rule that fires."""
    k = F.col("doc_id")
    out = deals.drop_reason(k % 7 != 0, F.when(F.col("toxic") == 1, "low").otherwise("high"), F.when(k % 3 == 0, "other").otherwise("lease"), (k % 10) / 10.0)
    return table(spark, sf, "labels").select("doc_id", "quality", out.alias("reason"))


@query(f"WITH {LEAD_EVENTS} SELECT lead_event_id, CASE WHEN lead_event_id % 9 = 0 THEN 'review' WHEN date_posted BETWEEN date '1995-01-01' AND date '1996-12-31' THEN 'keep' ELSE 'outside' END AS route FROM lead_events")
def window_route(spark, sf):
    """inside the window, outside it, or undated and so for review."""
    date = F.when(F.col("lead_event_id") % 9 != 0, F.col("date_posted"))
    return lead_events(spark, sf).select("lead_event_id", deals.window_route(date, "1995-01-01", "1996-12-31").alias("route"))


@query(f"WITH {LEAD_EVENTS}, r AS (SELECT CASE WHEN lead_event_id % 9 = 0 THEN 'undated' WHEN date_posted >= date '1996-01-01' THEN 'fresh' ELSE 'older' END AS kind FROM lead_events) SELECT kind, count(*) AS n FROM r GROUP BY kind")
def freshness_counts(spark, sf):
    """F02"""
    date = F.when(F.col("lead_event_id") % 9 != 0, F.col("date_posted"))
    kind = F.when(date.isNull(), "undated").when(date >= F.lit("1996-01-01").cast("date"), "fresh").otherwise("older")
    return lead_events(spark, sf).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, NOT (ts::DATE BETWEEN date '2024-01-10' AND date '2024-01-20') AS outside FROM events")
def listing_window(spark, sf):
    """listings whose own date lies outside the window."""
    url = F.concat(F.lit("https://x.com/list?Date="), F.date_format("ts", "yyyy-MM-dd"))
    return log(spark, sf).select("event_id", urls.outside_window(url, "2024-01-10", "2024-01-20").alias("outside"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def parse_datetimes(spark, sf):
    """Three ways of writing one moment."""
    k = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    raw = F.when(k % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k % 3 == 1, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss '+0000'")).otherwise(F.date_format(ts + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
    return log(spark, sf).select("event_id", F.date_format(dates.parse_datetime(raw), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT event_id, ts::DATE::VARCHAR AS d FROM events")
def judged_dates(spark, sf):
    """The forms in which an answer gives a date."""
    k = F.col("event_id")
    raw = F.when(k % 3 == 0, F.date_format("ts", "MMM d, yyyy")).when(k % 3 == 1, F.date_format("ts", "MM/dd/yyyy")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return log(spark, sf).select("event_id", deals.judged_date(raw).cast("string").alias("d"))


@query("SELECT n::INT AS attempts, least(3600, pow(2, least(n, 10)))::INT AS seconds FROM (SELECT DISTINCT l_linenumber + l_quantity::INT % 9 AS n FROM lineitem)")
def backoff(spark, sf):
    """T03"""
    n = table(spark, sf, "lineitem").select((F.col("l_linenumber") + F.col("l_quantity").cast("int") % 9).cast("int").alias("attempts")).distinct()
    return n.select("attempts", deals.backoff_seconds(F.col("attempts")).alias("seconds"))


@query("SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'si'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS title FROM pages")
def page_titles(spark, sf):
    """P48"""
    return pages(spark, sf).select("page_id", text.html_title("html").alias("title"))


@query("SELECT n_nationkey, lower(n_name) AS place FROM nation")
def locality(spark, sf):
    """One place out of an address."""
    return table(spark, sf, "nation").select("n_nationkey", text.locality(F.concat("n_name", F.lit(" area, AZ"))).alias("place"))


@query("SELECT c_custkey, 'Ann' AS first, 'Hi Ann, welcome.' AS line FROM customer")
def personalized_lines(spark, sf):
    """P13, P14"""
    name = F.element_at(F.array(*[F.lit(x) for x in ("Dr. Ann Lee", "Ann", "Mrs Ann B. Coe", "prof. Ann X")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    return table(spark, sf, "customer").select("c_custkey", text.first_name(name).alias("first"), text.personalize(F.lit("Hi [first name], welcome."), text.first_name(name)).alias("line"))
