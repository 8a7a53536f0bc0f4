"""Ranking, dedup, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.functions import urls
from siftline.functions.contacts import role_score
from siftline.functions.text import org_name_key
from siftline.operators import eligibility, identity, order, pick, similarity
from siftline.plans.catalog import query
from siftline.plans.domain import CONTACTS, LEAD_EVENTS, contacts, lead_events, log, pages
from siftline.session import table

_ANCHOR = "ORDER BY coalesce(score, -1) DESC, CASE priority WHEN 'high' THEN 2 WHEN 'medium' THEN 1 WHEN 'low' THEN 0 ELSE -1 END DESC, date_posted DESC NULLS LAST, lead_event_id"


@query(f"""WITH {LEAD_EVENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY company_id {_ANCHOR}) AS n FROM lead_events WHERE record_status = 'valid')
SELECT r.company_id, c.c_name AS company_name, r.lead_event_id, r.score, r.priority, r.date_posted::VARCHAR AS date_posted FROM r JOIN customer c ON c.c_custkey = r.company_id WHERE n = 1""")
def anchor_event_per_company(spark, sf):
    """Each company's anchor event among the valid ones."""
    anchors = pick.anchor_events(lead_events(spark, sf).where("record_status = 'valid'"))
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"))
    return anchors.join(names, "company_id").select("company_id", "company_name", "lead_event_id", "score", "priority", F.col("date_posted").cast("string").alias("date_posted"))


@query(f"""WITH {CONTACTS}, k AS (SELECT contact_candidate_id, CASE verification_status WHEN 'verified' THEN 2 WHEN 'unknown' THEN 1 ELSE 0 END AS level, * EXCLUDE contact_candidate_id FROM contacts),
r AS (SELECT *, row_number() OVER (PARTITION BY lead_event_id, person_id ORDER BY level = 0, level DESC, (email <> '') DESC, (phone <> '') DESC, evidence_count DESC, contact_candidate_id DESC) AS n FROM k)
SELECT lead_event_id, person_id, verification_status, evidence_count, n = 1 AND level > 0 AS selected, count(*) AS n_rows FROM r GROUP BY ALL""")
def select_best_contact(spark, sf):
    """Every contact with its flag, counted by what tells them apart."""
    out = pick.select_best_contacts(contacts(spark, sf))
    return out.groupBy("lead_event_id", "person_id", "verification_status", "evidence_count", "selected").agg(F.count(F.lit(1)).alias("n_rows"))


def _recipients(spark, sf):
    """People (suppliers) of companies (customers), by their orders' lines."""
    line = contacts(spark, sf).join(lead_events(spark, sf).select("company_id", "lead_event_id"), "lead_event_id")
    title = F.element_at(F.array(*[F.lit(t) for t in ("Facilities Manager", "VP Operations", "Owner", "Leasing Agent", "Development Lead", "Analyst")]), (F.col("person_id") % 6 + 1).cast("int"))
    scope = F.element_at(F.array(*[F.lit(t) for t in ("Phoenix portfolio", "national", "property operations", "regional")]), (F.col("person_id") % 4 + 1).cast("int"))
    provider = F.when(F.col("l_partkey") % 3 == 0, "apollo").otherwise("web")
    return line.select("company_id", "person_id", title.alias("title"), scope.alias("scope"), F.concat(F.lit("Ann P"), F.col("person_id").cast("string")).alias("name"), provider.alias("provider"), "email", "contact_candidate_id", (F.col("evidence_count") > 5).alias("selected"), "verification_status", F.when(F.col("verification_status") == "unknown", "domain_mx_valid_mailbox_unverified").otherwise("").alias("verification_reason"), "evidence_count")


def _recipient_sql(local: str) -> str:
    return f"""WITH {CONTACTS}, {LEAD_EVENTS}, p AS (
  SELECT e.company_id, c.person_id, ['Facilities Manager', 'VP Operations', 'Owner', 'Leasing Agent', 'Development Lead', 'Analyst'][c.person_id % 6 + 1] AS title,
         ['Phoenix portfolio', 'national', 'property operations', 'regional'][c.person_id % 4 + 1] AS scope,
         CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE 1 END AS own, c.* EXCLUDE (person_id, lead_event_id)
  FROM contacts c JOIN lead_events e USING (lead_event_id)
  WHERE evidence_count > 5 AND email <> '' AND verification_status <> 'rejected'),
b AS (SELECT *, row_number() OVER (PARTITION BY company_id, person_id ORDER BY own DESC, evidence_count DESC, contact_candidate_id DESC) AS k FROM p),
s AS (SELECT *, CASE person_id % 6 WHEN 0 THEN 100 WHEN 1 THEN 90 WHEN 2 THEN CASE WHEN scope = 'property operations' THEN 90 ELSE 70 END WHEN 3 THEN CASE WHEN scope = 'property operations' THEN 90 ELSE 70 END
        WHEN 4 THEN CASE WHEN scope = 'property operations' THEN 90 ELSE 50 END ELSE CASE WHEN scope = 'property operations' THEN 90 ELSE 0 END END
        + CASE WHEN scope = 'property operations' THEN 10 ELSE 0 END + CASE WHEN scope IN ('Phoenix portfolio', 'regional') THEN 5 ELSE 0 END + 2 * own AS role_score FROM b WHERE k = 1)
SELECT company_id, person_id, role_score::INT AS role_score, row_number() OVER (PARTITION BY company_id ORDER BY role_score DESC, own DESC{local}, person_id)::INT AS rank FROM s"""


@query(_recipient_sql(", (scope IN ('Phoenix portfolio', 'regional')) DESC"))
def recipient_rank(spark, sf):
    """People of each company by role."""
    return pick.rank_recipients(_recipients(spark, sf)).select("company_id", "person_id", "role_score", "rank")


@query(_recipient_sql(""))
def recipient_rank_bulk(spark, sf):
    """The same without the key for local people."""
    return pick.rank_recipients(_recipients(spark, sf), local_key=False).select("company_id", "person_id", "role_score", "rank")


@query("""WITH t AS (SELECT DISTINCT s_suppkey % 6 AS a, s_suppkey % 4 AS b FROM supplier),
x AS (SELECT ['Facilities Manager', 'VP Operations', 'Owner', 'Leasing Agent', 'Development Lead', 'Analyst'][a + 1] AS title, ['Phoenix portfolio', 'national', 'real property', 'regional'][b + 1] AS scope FROM t)
SELECT title, scope, (CASE WHEN title LIKE 'Facilities%' THEN 100 WHEN title LIKE '%Operations' OR scope = 'real property' THEN 90 WHEN title IN ('Owner', 'Leasing Agent') THEN 70 WHEN title LIKE 'Development%' THEN 50 ELSE 0 END
  + CASE WHEN scope = 'real property' THEN 10 ELSE 0 END + CASE WHEN scope IN ('Phoenix portfolio', 'regional') THEN 5 ELSE 0 END)::INT AS score FROM x""")
def role_scores(spark, sf):
    """P27 on its own."""
    s = table(spark, sf, "supplier").select((F.col("s_suppkey") % 6).alias("a"), (F.col("s_suppkey") % 4).alias("b")).distinct()
    title = F.element_at(F.array(*[F.lit(t) for t in ("Facilities Manager", "VP Operations", "Owner", "Leasing Agent", "Development Lead", "Analyst")]), (F.col("a") + 1).cast("int"))
    scope = F.element_at(F.array(*[F.lit(t) for t in ("Phoenix portfolio", "national", "real property", "regional")]), (F.col("b") + 1).cast("int"))
    named = s.select(title.alias("title"), scope.alias("scope"))
    return named.select("title", "scope", role_score("title", "scope")["score"].alias("score"))


_CANONICAL = """lower(regexp_extract(url, '^(https?)://', 1)) || '://' || lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) ||
  CASE WHEN regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '') = '' THEN '/' ELSE regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '') END ||
  CASE WHEN len(kept) = 0 THEN '' ELSE '?' || array_to_string(list_sort(kept), '&') END"""
_KEPT = "list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_') AND NOT list_contains(['fbclid', 'gclid', 'mc_cid', 'mc_eid', 'ref', 'source'], lower(split_part(x, '=', 1))))"


@query(f"WITH k AS (SELECT page_id, url, {_KEPT} AS kept FROM pages) SELECT page_id, {_CANONICAL} AS canonical_url FROM k")
def url_canonicalize_v2(spark, sf):
    """P02"""
    return pages(spark, sf).select("page_id", urls.canonicalize_url("url").alias("canonical_url"))


@query(f"""WITH k AS (SELECT page_id, url, list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_') AND NOT starts_with(x, 'mc_') AND NOT list_contains(['fbclid', 'gclid', 'yclid', 'msclkid', 'ref'], split_part(x, '=', 1))) AS kept FROM pages)
SELECT page_id, {_CANONICAL} AS canonical_url FROM k""")
def url_canonicalize_legacy(spark, sf):
    """P03"""
    return pages(spark, sf).select("page_id", urls.canonicalize_url_legacy("url").alias("canonical_url"))


@query(f"""WITH k AS (SELECT page_id, url, length(html) AS n, {_KEPT} AS kept FROM pages), c AS (SELECT page_id, n, {_CANONICAL} AS full_url FROM k),
d AS (SELECT page_id, n, regexp_replace(full_url, '[0-9]+[^?]*.*$', '') AS canonical_url FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY page_id % 3 = 0, page_id % 5 = 0, n DESC, page_id) AS k, count(*) OVER (PARTITION BY canonical_url) AS m FROM d)
SELECT canonical_url, page_id AS candidate_id, m::INT AS n_ids FROM r WHERE k = 1""")
def exact_url_dedup(spark, sf):
    """One candidate for each section of a site."""
    rows = pages(spark, sf).select(
        F.regexp_replace(urls.canonicalize_url("url"), "[0-9]+[^?]*.*$", "").alias("canonical_url"),
        F.col("page_id").alias("candidate_id"),
        F.when(F.col("page_id") % 3 == 0, "review").otherwise("valid").alias("record_status"),
        F.when(F.col("page_id") % 5 != 0, F.lit("2024-01-01").cast("timestamp")).alias("published_at"),
        F.col("html").alias("title"),
    )
    return pick.exact_winners(rows).select("canonical_url", "candidate_id", F.col("n").cast("int").alias("n_ids"))


@query(f"""WITH {LEAD_EVENTS} SELECT e.lead_event_id, e.company_id FROM lead_events e
WHERE record_status = 'valid' AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = e.lead_event_id AND l.l_returnflag = 'R')""")
def active_events_anti(spark, sf):
    """Valid events that weren't merged away."""
    merged = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("lead_event_id"))
    return lead_events(spark, sf).where("record_status = 'valid'").join(merged, "lead_event_id", "left_anti").select("lead_event_id", "company_id")


@query("""SELECT o_custkey AS company_id, count(*) AS n FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders q WHERE q.o_custkey = o.o_custkey AND q.o_orderstatus = 'F' AND q.o_orderdate < o.o_orderdate) GROUP BY 1""")
def novel_candidates_anti(spark, sf):
    """Orders that no earlier rejection of the same company shadows; the rejections are merged before they meet."""
    o = table(spark, sf, "orders")
    gone = o.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_rejection"))
    return o.join(gone, "o_custkey", "left").where("first_rejection is null or first_rejection >= o_orderdate").groupBy(F.col("o_custkey").alias("company_id")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_custkey AS company_id FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def accounted_ids(spark, sf):
    """Companies that both result sets have."""
    o = table(spark, sf, "orders")
    part = lambda s: o.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("company_id")).distinct()
    return part("O").intersect(part("F"))


@query("SELECT DISTINCT k AS link FROM (SELECT l_partkey AS k FROM lineitem UNION SELECT p_partkey FROM part)")
def union_known_links(spark, sf):
    """Accepted and rejected links as one set."""
    a = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("link")).distinct()
    return a.union(table(spark, sf, "part").select("p_partkey")).distinct()


@query("""WITH s AS (SELECT s_suppkey AS lead_id, s_nationkey AS cluster_id, (s_suppkey % 4)::INT AS n_contacts, (s_suppkey % 3)::INT AS num_filled, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE date '2024-01-01' + (s_suppkey % 10)::INT END AS added FROM supplier)
SELECT lead_id, cluster_id, first_value(lead_id) OVER (PARTITION BY cluster_id ORDER BY n_contacts DESC, num_filled DESC, added IS NULL, added, lead_id) AS keeper_id FROM s""")
def keeper_selection(spark, sf):
    """The keeper of each cluster."""
    s = table(spark, sf, "supplier")
    added = F.when(F.col("s_suppkey") % 7 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("s_suppkey") % 10).cast("int")))
    leads = s.select(F.col("s_suppkey").alias("lead_id"), F.col("s_nationkey").alias("cluster_id"), (F.col("s_suppkey") % 4).cast("int").alias("n_contacts"), (F.col("s_suppkey") % 3).cast("int").alias("num_filled"), added.alias("added"))
    return pick.keepers(leads).select("lead_id", "cluster_id", "keeper_id")


@query("""WITH c AS (SELECT s_suppkey AS lead_id, ['P' || (s_suppkey % 3) || ' | a', 'p' || (s_suppkey % 2) || ' | b'] AS a, ['Q' || (s_suppkey % 5) || ' | c', '', 'P' || (s_suppkey % 4) || ' | d', 'r | e'] AS b FROM supplier),
x AS (SELECT lead_id, unnest(list_filter(list_concat(a, b), lambda v: v <> '')) AS v, generate_subscripts(list_filter(list_concat(a, b), lambda v: v <> ''), 1) AS i FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY lead_id, lower(split_part(v, ' | ', 1)) ORDER BY i) AS d FROM x),
n AS (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY i) AS p FROM k WHERE d = 1)
SELECT lead_id, string_agg(v, ';' ORDER BY p) FILTER (WHERE p <= 3) AS kept, coalesce(string_agg(v, ';' ORDER BY p) FILTER (WHERE p > 3), '') AS overflow FROM n GROUP BY lead_id""")
def merge_contacts_cap3(spark, sf):
    """Contacts merged by name, three kept, the rest listed."""
    made = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    k = F.col("s_suppkey")
    a = F.array(made("P", k % 3, " | a"), made("p", k % 2, " | b"))
    b = F.array(made("Q", k % 5, " | c"), F.lit(""), made("P", k % 4, " | d"), F.lit("r | e"))
    out = table(spark, sf, "supplier").select(k.alias("lead_id"), pick.merge_contacts(a, b).alias("m"))
    return out.select("lead_id", F.array_join("m.kept", ";").alias("kept"), F.array_join("m.overflow", ";").alias("overflow"))


@query(f"""WITH {LEAD_EVENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY lead_event_id) AS n FROM lead_events) SELECT company_id, lead_event_id FROM r WHERE n <= 3""")
def cap_three_per_company(spark, sf):
    """W08"""
    return pick.cap_per_key(lead_events(spark, sf), ["company_id"], [F.col("lead_event_id")], 3).select("company_id", "lead_event_id")


@query(f"WITH {LEAD_EVENTS} SELECT lead_event_id, score FROM lead_events ORDER BY score DESC, lead_event_id LIMIT 3")
def top_three_scores(spark, sf):
    """A report of three."""
    return lead_events(spark, sf).select("lead_event_id", "score").orderBy(F.desc("score"), "lead_event_id").limit(3)


@query(f"WITH {LEAD_EVENTS} SELECT lead_event_id, ((row_number() OVER (ORDER BY lead_event_id) - 1) // 40)::BIGINT AS batch_no FROM lead_events")
def batches_of_40(spark, sf):
    """Events in order of id, 40 to a batch, numbered over range partitions."""
    return pick.batches(lead_events(spark, sf).select("lead_event_id"), "lead_event_id", 40)


@query("""WITH r AS (SELECT user_id, ts, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT user_id, count(*) FILTER (WHERE before IS NOT NULL AND before <> event_type)::BIGINT AS collisions FROM r GROUP BY user_id""")
def identity_collisions(spark, sf):
    """Changes of identity against the row before, so A, B, A counts two."""
    out = pick.identity_collisions(log(spark, sf), "user_id", ["event_type"], [F.col("ts"), F.col("event_id")])
    return out.groupBy("user_id").agg(F.count_if("collision").alias("collisions"))


@query("""WITH t AS (SELECT DISTINCT p_name FROM part), k AS (SELECT p_name, list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z][a-z\\-]+'), lambda w: length(w) >= 3 AND NOT list_contains(['square','feet','foot','sqft','million','billion','units','unit','acre','acres','story','stories','from','with','into','near','that','this','they','their','will','have','more','than','tops','for','the','and','new'], w))) AS t FROM t),
p AS (SELECT x.p_name AS a, y.p_name AS b, len(list_intersect(x.t, y.t)) AS c, len(x.t) + len(y.t) AS s FROM k x JOIN k y ON x.p_name < y.p_name)
SELECT a, b, c / (s - c) AS score FROM p WHERE c > 0 AND c / (s - c) >= 0.3""")
def title_jaccard_pairs(spark, sf):
    """Similar titles by their rarest tokens."""
    return similarity.title_pairs(table(spark, sf, "part"), 0.3, "p_name")


@query("""WITH RECURSIVE t AS (SELECT DISTINCT p_name FROM part), k AS (SELECT p_name, list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z][a-z\\-]+'), lambda w: length(w) >= 3 AND w NOT IN ('for','the','and','new','with','from'))) AS t FROM t),
e AS (SELECT x.p_name AS a, y.p_name AS b FROM k x JOIN k y ON x.p_name <> y.p_name AND len(list_intersect(x.t, y.t)) / (len(x.t) + len(y.t) - len(list_intersect(x.t, y.t))) >= 0.6),
r(a, b) AS (SELECT p_name, p_name FROM t UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT a AS p_name, min(b) AS component FROM r GROUP BY a""")
def title_clusters(spark, sf):
    """Connected components of similar titles."""
    return similarity.title_clusters(table(spark, sf, "part"), 0.6, "p_name")


@query("""WITH c AS (SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS k, c_nationkey FROM customer),
x AS (SELECT (c_custkey % 50) AS request_id, k FROM c) SELECT request_id, min(c.c_custkey) AS company_id, count(DISTINCT c.c_custkey) > 1 AS ambiguous FROM x JOIN c USING (k) GROUP BY request_id HAVING count(DISTINCT c.c_custkey) = 1
UNION ALL SELECT request_id, NULL, true FROM x JOIN c USING (k) GROUP BY request_id HAVING count(DISTINCT c.c_custkey) > 1""")
def resolve_companies(spark, sf):
    """Companies by any of their names; several matches are an ambiguity."""
    c = table(spark, sf, "customer")
    known = c.select(F.col("c_custkey").alias("company_id"), F.lit("").alias("domain"), F.array("c_name").alias("names"))
    asked = c.groupBy((F.col("c_custkey") % 50).alias("request_id")).agg(F.collect_list("c_name").alias("names")).withColumn("domain", F.lit(""))
    return identity.resolve_companies(asked, known).select("request_id", "company_id", "ambiguous")


@query("""WITH RECURSIVE n AS (SELECT 'c' || c_custkey AS id, 'n:' || (c_custkey // 3) AS k1, 'd:' || (c_custkey % 400) AS k2, c_custkey > 1000 OR c_custkey > (SELECT max(c_custkey) FROM customer) * 2 // 3 AS old FROM customer),
k AS (SELECT id, k1 AS k FROM n UNION SELECT id, k2 FROM n), m AS (SELECT k, min(id) AS l FROM k GROUP BY k),
e AS (SELECT k.id AS a, m.l AS b FROM k JOIN m USING (k) UNION SELECT m.l, k.id FROM k JOIN m USING (k)),
r(a, b) AS (SELECT id, id FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
g AS (SELECT a AS id, min(b) AS component FROM r GROUP BY a), o AS (SELECT component, min(g.id) AS known, count(*) AS c FROM g JOIN n USING (id) WHERE n.old GROUP BY component)
SELECT g.id AS company_id, coalesce(o.known, g.component) AS aligned_id, coalesce(o.c, 0) > 1 AS ambiguous FROM g JOIN n USING (id) LEFT JOIN o USING (component) WHERE NOT n.old""")
def align_companies(spark, sf):
    """Current companies under the ids of existing ones that they are joined to."""
    c = table(spark, sf, "customer")
    most = c.agg(F.max("c_custkey")).scalar()
    rows = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("company_id"), F.concat(F.lit("x"), (F.col("c_custkey") % 400).cast("string")).alias("domain"), F.array(F.concat(F.lit("y"), F.floor(F.col("c_custkey") / 3).cast("string"))).alias("names"), ((F.col("c_custkey") > 1000) | (F.col("c_custkey") > F.floor(most * 2 / 3))).alias("old"))
    return identity.align_companies(rows.where("not old").drop("old"), rows.where("old").drop("old"))


@query(f"""WITH {LEAD_EVENTS}, r AS (SELECT lead_event_id, score, record_status, CASE WHEN score >= 40 THEN 'high' ELSE 'low' END AS confidence, CASE company_id % 3 WHEN 0 THEN 'review' ELSE 'valid' END AS route, company_id % 11 = 0 AS held FROM lead_events)
SELECT lead_event_id, array_to_string(list_filter([CASE WHEN record_status <> 'valid' THEN 'event_record_not_valid' END, CASE WHEN confidence <> 'high' THEN 'event_confidence_not_high' END, CASE WHEN score <= 0 THEN 'event_score_zero' END,
  CASE WHEN route <> 'valid' THEN 'company_route_' || route END, CASE WHEN held THEN 'blocking_open_review' END], lambda x: x IS NOT NULL), ',') AS reasons FROM r""")
def event_eligibility(spark, sf):
    """F16: why events may not go to the sales system."""
    e = lead_events(spark, sf).withColumn("confidence", F.when(F.col("score") >= 40, "high").otherwise("low")).withColumn("route", F.when(F.col("company_id") % 3 == 0, "review").otherwise("valid"))
    held = e.where("company_id % 11 = 0").select(F.col("lead_event_id").alias("record_id"))
    return eligibility.event_eligibility(e, held).select("lead_event_id", F.array_join("exclusion_reasons", ",").alias("reasons"))


@query("""WITH s AS (SELECT s_suppkey AS sequence_id, 'M' || (s_suppkey % 40) || '@x.com' AS email, s_suppkey % 2 = 0 AS domain_matches, (s_suppkey % 3)::INT AS shared_tokens, date '2024-01-01' + (s_suppkey % 5)::INT AS anchor_date, (s_suppkey % 7)::INT AS score, (s_suppkey % 4)::INT AS role_score FROM supplier),
r AS (SELECT *, first_value(sequence_id) OVER (PARTITION BY lower(email) ORDER BY domain_matches DESC, shared_tokens DESC, anchor_date DESC, score DESC, role_score DESC, sequence_id) AS winner_id FROM s)
SELECT sequence_id, winner_id, lower(email) AS mailbox FROM r WHERE winner_id <> sequence_id""")
def mailbox_winners(spark, sf):
    """Ready sequences that lose their mailbox."""
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier").select(k.alias("sequence_id"), F.concat(F.lit("M"), (k % 40).cast("string"), F.lit("@x.com")).alias("email"), (k % 2 == 0).alias("domain_matches"), (k % 3).alias("shared_tokens"), F.date_add(F.lit("2024-01-01").cast("date"), (k % 5).cast("int")).alias("anchor_date"), (k % 7).alias("score"), (k % 4).alias("role_score"))
    return pick.mailbox_winners(s)


@query("""WITH n AS (SELECT c_custkey, trim(regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g')) AS k FROM customer), e AS (SELECT k, min(c_custkey) AS cached_id FROM n WHERE c_custkey % 2 = 0 GROUP BY k) SELECT n.c_custkey, e.cached_id FROM n LEFT JOIN e USING (k)""")
def cached_organizations(spark, sf):
    """Organizations with what the cache knows under their key."""
    n = table(spark, sf, "customer").select("c_custkey", org_name_key("c_name").alias("k"))
    cached = n.where("c_custkey % 2 = 0").groupBy("k").agg(F.min("c_custkey").alias("cached_id"))
    return n.join(cached, "k", "left").select("c_custkey", "cached_id")


@query("SELECT o_orderkey AS n_key, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders")
def numbered_orders(spark, sf):
    """A global number by price and key."""
    return order.numbered(table(spark, sf, "orders").select("o_totalprice", F.col("o_orderkey").alias("n_key")), ["o_totalprice", "n_key"]).select("n_key", "n")
