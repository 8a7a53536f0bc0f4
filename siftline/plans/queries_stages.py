"""What stages do with answers, contacts and saved rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.functions import crm, scope
from siftline.operators import stages
from siftline.operators.order import spread
from siftline.plans import exports
from siftline.plans.catalog import query
from siftline.plans.queries_scalar import _n as norm
from siftline.plans.domain import CONTACTS, LEAD_EVENTS, contacts, lead_events, log, pages
from siftline.session import table
from siftline.sources import listings


@query("SELECT doc_id, regexp_matches(lower(text), 'arizona|phoenix|tucson|mesa|tempe|scottsdale|chandler|gilbert') AND regexp_matches(lower(text), 'open|lease|tenant|occup|construction|redevelop|management|expansion|facility|property') AS fits FROM documents")
def prescreen(spark, sf):
    """S12"""
    return table(spark, sf, "documents").select("doc_id", scope.prescreen("text", F.lit("")).alias("fits"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false ELSE true END AS inside FROM customer")
def listing_scope(spark, sf):
    """titles about the right place, about another state, about another city, and with an owner from elsewhere."""
    title = F.element_at(F.array(*[F.lit(t) for t in ("Warehouse opens in Tempe", "Office in Texas by Tempe firm", "Chicago tower, Mesa owner", "Yuma site: Phoenix based investor")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    return spread(table(spark, sf, "customer").select("c_custkey")).select("c_custkey", scope.listing_in_scope(title, F.lit("https://x.com/a"), F.lit("")).alias("inside"))


@query(f"""WITH w AS (SELECT doc_id, string_split({norm('text')}, ' ') AS t FROM documents)
SELECT doc_id, list_contains(t, 'idiot') OR list_contains(t, 'clown') AS grounded FROM w""")
def business_grounding(spark, sf):
    """documents that hold a distinctive word of a name."""
    return table(spark, sf, "documents").select("doc_id", scope.grounded(F.lit("The Idiot Clown Group LLC"), "text").alias("grounded"))


@query(f"""WITH {LEAD_EVENTS}, {CONTACTS} SELECT e.company_id, count(*) AS n, count(DISTINCT o.lead_event_id) AS n_events FROM contacts c JOIN lead_events e USING (lead_event_id) JOIN lead_events o ON o.company_id = e.company_id GROUP BY 1""")
def project_contacts(spark, sf):
    """A company's contacts for all of its events."""
    e = lead_events(spark, sf)
    people = contacts(spark, sf).join(e.select("company_id", "lead_event_id"), "lead_event_id").drop("lead_event_id").withColumnRenamed("company_id", "organization_id")
    out = stages.project_contacts(people, e.withColumnRenamed("company_id", "organization_id"))
    return out.groupBy(F.col("organization_id").alias("company_id")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("lead_event_id").alias("n_events"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'own@x' WHEN c_custkey % 2 = 0 THEN 'p' || (c_custkey // 10) || '@found' ELSE '' END AS email FROM customer""")
def shared_lookup(spark, sf):
    """Blanks filled from one lookup for each person."""
    c = table(spark, sf, "customer")
    person = F.concat(F.lit("P "), F.floor(F.col("c_custkey") / 10).cast("string"))
    inputs = c.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, person).otherwise("").alias("person"), F.lit("Acme").alias("organization"), F.when(F.col("c_custkey") % 3 == 0, "own@x").otherwise("").alias("email"), F.lit("").alias("phone"), F.lit("").alias("linkedin"))
    n = F.floor(F.col("c_custkey") / 10).cast("string")
    results = c.select(F.concat(F.lit("p "), n).alias("person_key"), F.lit("acme").alias("organization_key"), F.concat(F.lit("p"), n, F.lit("@found")).alias("email"), F.lit("").alias("phone"), F.lit("").alias("linkedin")).distinct()
    return stages.resolve_shared(inputs, results)[0].select("c_custkey", "email")


@query("SELECT o_orderkey AS link, o_orderstatus AS v FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'old' FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 3 = 0")
def append_merge(spark, sf):
    """New rows shadow old ones of the same link."""
    o = table(spark, sf, "orders")
    return stages.append_merge(o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("link"), F.col("o_orderstatus").alias("v")), o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("link"), F.lit("old").alias("v")))


@query(f"""WITH {LEAD_EVENTS}, {CONTACTS}, s AS (SELECT lead_event_id, count(*) FILTER (WHERE evidence_count > 25) AS n FROM contacts GROUP BY 1) SELECT e.lead_event_id, coalesce(n, 0)::INT AS n FROM lead_events e LEFT JOIN s USING (lead_event_id)""")
def contact_rollup(spark, sf):
    """The selected contacts of each event, none for some."""
    some = contacts(spark, sf).withColumn("selected", F.col("evidence_count") > 25)
    out = stages.contact_rollup(lead_events(spark, sf).select("lead_event_id"), some)
    return out.select("lead_event_id", F.coalesce(F.when(F.col("contacts").isNotNull(), F.size("contacts")), F.lit(0)).alias("n"))


@query("SELECT user_id AS link, arg_max(event_type, event_id) AS kind FROM events GROUP BY 1")
def collect_last(spark, sf):
    """The last row of each link."""
    rows = log(spark, sf).select(F.col("user_id").alias("link"), F.col("event_type").alias("kind"), "event_id")
    return stages.collect_last(rows, "link", "event_id").select("link", "kind")


@query("""WITH m AS (SELECT min(o_orderkey) AS kept, o_custkey FROM orders GROUP BY o_custkey) SELECT kept AS lead_event_id, count(DISTINCT o_orderpriority)::INT AS n FROM m JOIN orders USING (o_custkey) GROUP BY kept""")
def merge_groups(spark, sf):
    """One event for each company with the supporters of all."""
    o = table(spark, sf, "orders")
    events = o.select(F.col("o_orderkey").alias("lead_event_id"), F.array("o_orderpriority").alias("supporting_ids"))
    groups = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("kept_id"), F.collect_list("o_orderkey").alias("member_ids"))
    return stages.merge_groups(events, groups)[0].select("lead_event_id", F.size("supporting_ids").alias("n"))


@query("""SELECT c_custkey, 'create' AS action FROM customer WHERE c_custkey % 100 NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey < 20) UNION ALL SELECT c_custkey, 'refresh_contacts' FROM customer WHERE c_custkey % 100 IN (SELECT c_nationkey FROM customer WHERE c_nationkey < 20)""")
def push_plan(spark, sf):
    """Leads to create, and those whose url is there already."""
    c = table(spark, sf, "customer")
    leads = c.select("c_custkey", F.concat(F.lit("https://X.com/"), (F.col("c_custkey") % 100).cast("string"), F.lit("?utm_source=a")).alias("url"), F.lit(True).alias("email_verified"))
    there = c.where("c_nationkey < 20").select(F.concat(F.lit("https://x.com/"), F.col("c_nationkey").cast("string"), F.lit("/")).alias("url"))
    return stages.push_plan(leads, there).select("c_custkey", "action")


@query("SELECT s_suppkey, s_name || ' — Lead (West)' AS label, lpad((s_suppkey % 100)::VARCHAR, 2, '0') || ' (US, 2024)' AS employees FROM supplier")
def person_labels(spark, sf):
    """P30"""
    count = F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0")
    return table(spark, sf, "supplier").select("s_suppkey", crm.person_label("s_name", F.lit("Lead"), F.lit("West")).alias("label"), crm.employee_label(count, F.lit("US"), F.lit("2024")).alias("employees"))


@query("""SELECT page_id, count(*)::BIGINT AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*href=["'']([^"'']+)', 1)) AS h FROM pages) GROUP BY page_id""")
def page_anchors(spark, sf):
    """Anchors of each page."""
    p = pages(spark, sf).select(F.col("page_id").cast("string").alias("source_id"), F.col("url").alias("source_url"), "url", F.col("html").alias("content"))
    return listings.raw_links(p).where("role = 'entry'").groupBy(F.col("source_id").cast("bigint").alias("page_id")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CONTACTS} SELECT l_partkey % 50 AS company_id, count(*) AS people, count(*) FILTER (WHERE verification_status = 'verified') AS n_email, CASE WHEN count(*) FILTER (WHERE verification_status = 'verified') > 0 THEN 'email' WHEN count(*) FILTER (WHERE verification_status = 'unknown') > 0 THEN 'phone' ELSE 'none' END AS best FROM contacts GROUP BY 1")
def company_export(spark, sf):
    """People of each company by status."""
    status = F.when(F.col("verification_status") == "verified", "email").when(F.col("verification_status") == "unknown", "phone").otherwise("none")
    out = exports.company_export(contacts(spark, sf).select((F.col("l_partkey") % 50).alias("company_id"), status.alias("status")))
    return out.select("company_id", "people", "n_email", "best")


@query(f"WITH {LEAD_EVENTS} SELECT CASE WHEN score >= 50 THEN 'priority' ELSE 'nurture' END AS bucket, count(*) AS n FROM lead_events GROUP BY 1")
def lead_buckets(spark, sf):
    """F20, K06"""
    return lead_events(spark, sf).groupBy(exports.bucket(F.col("score")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id AS delivery_key, count(*) FILTER (WHERE event_type = 'purchase') AS n FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE event_type = 'purchase') <> 1")
def delivery_monitor(spark, sf):
    """Keys that weren't delivered exactly once."""
    return exports.deliveries(log(spark, sf).select(F.col("user_id").alias("delivery_key"), F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("message_id")))
