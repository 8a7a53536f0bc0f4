"""Counts, coverage, scorecards and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.operators import aggregates, coverage
from siftline.plans.catalog import query
from siftline.plans.domain import LEAD_EVENTS, lead_events, log
from siftline.session import table


@query("""WITH p AS (SELECT e.event_type, j.key AS name, j.value::VARCHAR AS v FROM events e, json_each(e.props) j),
s AS (SELECT event_type, name, sum(trunc(v::DOUBLE)::BIGINT)::BIGINT AS total FROM p GROUP BY ALL)
SELECT event_type, name, total FROM s UNION ALL SELECT event_type, 'attempts', count(*) FROM events GROUP BY 1 UNION ALL SELECT event_type, 'billable', count(*) FILTER (WHERE user_id % 2 = 0) FROM events GROUP BY 1""")
def usage_summary(spark, sf):
    """A01"""
    return aggregates.usage_summary(log(spark, sf).withColumn("billable", F.col("user_id") % 2 == 0), ["event_type"], "props")


@query("SELECT user_id, count(*) + 1 AS next_attempt FROM events GROUP BY user_id")
def next_attempt(spark, sf):
    """A02"""
    return log(spark, sf).groupBy("user_id").agg((F.count(F.lit(1)) + 1).alias("next_attempt"))


@query(f"WITH {LEAD_EVENTS} SELECT priority, count(*) AS total, count(*) FILTER (WHERE record_status = 'valid') AS valid, count(*) FILTER (WHERE record_status = 'review') AS review, count(*) FILTER (WHERE record_status = 'rejected') AS rejected FROM lead_events GROUP BY priority")
def stage_counters(spark, sf):
    """A03, A18"""
    return aggregates.status_counts(lead_events(spark, sf), ["priority"], "record_status", ["valid", "review", "rejected"])


@query("""WITH f AS (SELECT l_suppkey AS source_id, l_partkey AS url, bool_or(l_returnflag = 'R' AND l_quantity > 49) AS bad FROM lineitem WHERE l_suppkey % 10 <> 3 GROUP BY ALL), g AS (SELECT source_id, count(*) AS urls, bool_or(bad) AS bad FROM f GROUP BY source_id)
SELECT s_suppkey AS source_id, coalesce(urls, 0)::BIGINT AS urls, coalesce(bad, false) AS incomplete, urls IS NULL AS uncovered FROM supplier LEFT JOIN g ON s_suppkey = source_id""")
def source_coverage(spark, sf):
    """Distinct urls of each source over two ways of finding them."""
    line = table(spark, sf, "lineitem").where("l_suppkey % 10 <> 3").select(F.col("l_suppkey").alias("source_id"), F.col("l_partkey").alias("url"), ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 49)).alias("incomplete"), "l_linenumber")
    direct, archive = line.where("l_linenumber % 2 = 0").drop("l_linenumber"), line.where("l_linenumber % 2 = 1").drop("l_linenumber")
    return aggregates.source_coverage(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("source_id")), direct, archive)


@query("SELECT user_id AS feed_id, count(*) AS entries, count(*) FILTER (WHERE event_type NOT IN ('error', 'view'))::BIGINT AS valid, count(*) FILTER (WHERE event_type IN ('error', 'view')) > count(*) FILTER (WHERE event_type NOT IN ('error', 'view')) AS mostly_invalid FROM events GROUP BY 1")
def feed_problems(spark, sf):
    """Valid and invalid entries of each feed."""
    problem = F.when(F.col("event_type") == "error", "invalid_url").when(F.col("event_type") == "view", "off_domain")
    return aggregates.problem_histogram(log(spark, sf).select(F.col("user_id").alias("feed_id"), problem.alias("problem")))


@query("SELECT lower(trim(p_name)) AS title_key, count(*) AS n, min(p_partkey) AS first_id FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_titles(spark, sf):
    """A16"""
    return aggregates.duplicate_titles(table(spark, sf, "part"), "p_name", "p_partkey")


@query("SELECT 'm' || (s_suppkey % 60) AS mailbox, count(*) AS n, min(s_suppkey) AS first_id FROM supplier GROUP BY 1 HAVING count(*) > 1")
def duplicate_mailboxes(spark, sf):
    """A17"""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sequence_id"), F.concat(F.lit(" M"), (F.col("s_suppkey") % 60).cast("string")).alias("email"))
    return aggregates.duplicate_mailboxes(s)


@query("""WITH r AS (SELECT o_custkey, o_orderkey, unnest([o_orderstatus, left(o_orderpriority, 1), o_orderstatus]) AS k, generate_subscripts([1, 2, 3], 1) AS p FROM orders),
f AS (SELECT o_custkey, k, min((o_orderkey, p)) AS first, max((o_orderkey, p)) AS last FROM r GROUP BY ALL)
SELECT o_custkey AS company_id, string_agg(k || ':' || row_no, ',' ORDER BY first) AS evidence FROM (SELECT *, (last[1]::BIGINT * 10 + last[2]::BIGINT)::VARCHAR AS row_no FROM f) GROUP BY o_custkey""")
def evidence_union(spark, sf):
    """Evidence of each company, one for each key: at its first position, with its last value."""
    at = lambda p: (F.col("o_orderkey") * 10 + p).cast("string")
    item = lambda k, p: F.struct(k.alias("url"), at(p).alias("note"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("company_id"), "o_orderkey", F.array(item(F.col("o_orderstatus"), 1), item(F.left("o_orderpriority", F.lit(1)), 2), item(F.col("o_orderstatus"), 3)).alias("evidence"))
    out = aggregates.keyed_union(o, ["company_id"], "evidence", "url", "o_orderkey")
    return out.select("company_id", F.array_join(F.transform("evidence", lambda e: F.concat_ws(":", e["url"], e["note"])), ",").alias("evidence"))


@query("""SELECT CASE WHEN c_custkey % 3 = 0 THEN 'd' || (c_custkey % 100) ELSE trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) END AS identity, count(DISTINCT c_name)::INT AS n_names, count(DISTINCT c_mktsegment)::INT AS n_locations, count(DISTINCT o_orderkey) AS n_events FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def company_profiles(spark, sf):
    """Companies by their domain, else their normalized name."""
    c = table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    domain = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("d"), (F.col("c_custkey") % 100).cast("string"))).otherwise("")
    events = c.select(F.col("o_orderkey").alias("lead_event_id"), F.col("c_custkey").alias("organization_id"), F.col("c_name").alias("name"), domain.alias("domain"), F.col("c_mktsegment").alias("location"))
    return aggregates.company_profiles(events).select("identity", F.size("names").alias("n_names"), F.size("locations").alias("n_locations"), "n_events")


_DAYS = "SELECT n_nationkey AS day, (n_nationkey % 11) / 10.0 AS retention, (n_nationkey % 7) / 6.0 AS reachable, (n_nationkey % 5) / 4.0 AS sourced, n_nationkey % 2 = 0 AS identity_ok, (n_nationkey % 4)::INT AS collisions, (n_nationkey % 9) / 8.0 AS provenance, (n_nationkey % 3) / 2.0 AS stages, n_nationkey % 5 <> 0 AS resumed, n_nationkey % 6 <> 0 AS intact, (n_nationkey % 3)::INT AS sent, true AS usage_recorded, (n_nationkey % 8)::INT AS duplicate_attempts FROM nation"


@query(f"""WITH d AS ({_DAYS}) SELECT day, least(20, round_even(20 * retention, 0))::INT AS v1_accounting, least(15, round_even(15 * (reachable + sourced) / 2, 0))::INT AS contact_contract_quality, CASE WHEN identity_ok AND collisions = 0 THEN 5 ELSE 0 END AS identity_invariants,
least(15, round_even(15 * provenance, 0))::INT AS provenance_contracts, least(10, round_even(4 * stages, 0) + CASE WHEN resumed THEN 3 ELSE 0 END + CASE WHEN intact THEN 3 ELSE 0 END)::INT AS pipeline_integrity,
CASE WHEN sent = 1 THEN 4 ELSE 0 END + 3 + CASE WHEN duplicate_attempts = 0 THEN 3 ELSE 0 END AS delivery_usage_apollo FROM d""")
def promotion_criteria(spark, sf):
    """Points rounded half to even."""
    n = F.col("n_nationkey")
    days = table(spark, sf, "nation").select(n.alias("day"), ((n % 11) / 10.0).alias("retention"), ((n % 7) / 6.0).alias("reachable"), ((n % 5) / 4.0).alias("sourced"), (n % 2 == 0).alias("identity_ok"), (n % 4).alias("collisions"), ((n % 9) / 8.0).alias("provenance"), ((n % 3) / 2.0).alias("stages"), (n % 5 != 0).alias("resumed"), (n % 6 != 0).alias("intact"), (n % 3).alias("sent"), F.lit(True).alias("usage_recorded"), (n % 8).alias("duplicate_attempts"))
    return aggregates.criteria_points(days)


@query("SELECT 3::BIGINT AS days, count(*) FILTER (WHERE n_nationkey <> 1)::BIGINT AS green_days, 'promote_v2' AS decision FROM nation WHERE n_nationkey < 3")
def promotion_gate(spark, sf):
    """The gate looks at three days' cards, so the table is cut to three rows that stand for them."""
    cards = table(spark, sf, "nation").where("n_nationkey < 3").select(F.col("n_nationkey").alias("day"), (F.col("n_nationkey") != 1).alias("green"), F.lit(False).alias("invalid"))
    return aggregates.promotion_gate(cards).select("days", "green_days", "decision")


@query("""WITH e AS (SELECT o_custkey % 20 AS batch_id, o_orderkey AS id FROM orders), s AS (SELECT batch_id, CASE WHEN id % 1000 = 7 THEN -id ELSE id END AS id FROM e WHERE id % 500 <> 3 UNION ALL SELECT batch_id, id FROM e WHERE id % 700 = 9),
ec AS (SELECT batch_id, id FROM e), sc AS (SELECT batch_id, id, count(*) AS n FROM s GROUP BY ALL)
SELECT coalesce(ec.batch_id, sc.batch_id) AS batch_id, coalesce(ec.id, sc.id) AS id, CASE WHEN sc.id IS NULL THEN 'missing' WHEN ec.id IS NULL THEN 'unknown' ELSE 'duplicate' END AS problem
FROM ec FULL JOIN sc ON ec.batch_id = sc.batch_id AND ec.id = sc.id WHERE sc.id IS NULL OR ec.id IS NULL OR sc.n <> 1""")
def coverage_problems(spark, sf):
    """Ids that an answer lacks, invents or repeats."""
    e = table(spark, sf, "orders").select((F.col("o_custkey") % 20).alias("batch_id"), F.col("o_orderkey").alias("id"))
    seen = e.where("id % 500 <> 3").select("batch_id", F.when(F.col("id") % 1000 == 7, -F.col("id")).otherwise(F.col("id")).alias("id")).unionAll(e.where("id % 700 = 9"))
    return coverage.id_coverage(e, seen, "batch_id", "id").where("problem is not null")


@query("""WITH s AS (SELECT o_custkey % 20 AS batch_id, o_orderkey AS id, CASE o_orderkey % 50 WHEN 0 THEN 101.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.0 ELSE 50.0 END AS score FROM orders)
SELECT id, CASE WHEN score <> floor(score) THEN 'not_integer' ELSE 'out_of_range' END AS problem FROM s WHERE score <> floor(score) OR score > 100""")
def score_problems(spark, sf):
    """Scores that aren't whole numbers from 0 to 100; zero is one."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 50
    scores = o.select((F.col("o_custkey") % 20).alias("batch_id"), F.col("o_orderkey").alias("id"), F.when(k == 0, 101.0).when(k == 1, 0.5).when(k == 2, 0.0).otherwise(50.0).alias("score"))
    return coverage.score_problems(scores.select("batch_id", "id"), scores).where("problem is not null").select("id", "problem")


@query("SELECT l_orderkey AS lead_event_id, count(*) AS n, 'unknown_company' AS violation FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 <> 0) GROUP BY 1")
def missing_references(spark, sf):
    """Rows whose company isn't there."""
    known = table(spark, sf, "supplier").where("s_suppkey % 4 <> 0")
    out = coverage.missing_references(table(spark, sf, "lineitem"), known, "l_suppkey", "s_suppkey", "unknown_company")
    return out.groupBy(F.col("l_orderkey").alias("lead_event_id"), "violation").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN quality = 1 AND doc_id % 5 = 0 THEN 'business_name_missing' END, CASE WHEN quality = 1 AND doc_id % 7 = 0 THEN 'date_posted_missing' END,
CASE WHEN quality = 0 AND doc_id % 3 = 0 THEN 'filter_reason_missing' END, CASE WHEN quality = 1 AND doc_id % 11 = 0 THEN 'priority_invalid' END], lambda x: x IS NOT NULL), ',') AS violations FROM labels""")
def judgment_violations(spark, sf):
    """judgments and what they lack."""
    k = F.col("doc_id")
    j = table(spark, sf, "labels").select(k, (F.col("quality") == 1).alias("qualified"), F.when(k % 5 != 0, "Acme").otherwise("").alias("business_name"), F.lit("Lease").alias("event"), F.when(k % 7 != 0, F.lit("2024-01-01").cast("date")).alias("date_posted"), F.lit("Mesa").alias("location"), F.lit("s").alias("summary"), F.lit("Arizona").alias("state"), F.when(k % 11 == 0, "urgent").otherwise("high").alias("priority"), F.lit("high").alias("confidence"), F.when(k % 3 == 0, "").otherwise("macro").alias("filter_reason"))
    return coverage.judgment_violations(j).select("doc_id", F.array_join("violations", ",").alias("violations"))
