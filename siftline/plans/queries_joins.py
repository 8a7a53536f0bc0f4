"""Joins and merges of the sales state."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.operators import aggregates, joins, stages
from siftline.plans.catalog import query
from siftline.plans.domain import CONTACTS, LEAD_EVENTS, contacts, lead_events
from siftline.session import table


@query("SELECT l_suppkey AS prospect_id, (l_partkey % 3)::INT AS campaign_id, arg_max(l_orderkey, (l_shipdate, l_orderkey)) AS sequence_id FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL")
def latest_sequences(spark, sf):
    """J05"""
    line = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("sequence_id"), F.col("l_suppkey").alias("primary_recipient_id"), (F.col("l_partkey") % 3).cast("int").alias("campaign_id"), F.col("l_shipdate").alias("updated_at"))
    people = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("recipient_id"), F.col("s_suppkey").alias("prospect_id"))
    return joins.latest_sequences(line, people)


@query(f"""WITH {LEAD_EVENTS}, b AS (SELECT DISTINCT l_suppkey AS sequence_id, l_orderkey AS lead_event_id FROM lineitem), r AS (SELECT sequence_id, lead_event_id, row_number() OVER (PARTITION BY sequence_id ORDER BY lead_event_id % 7 <> 0, lead_event_id) AS place FROM b JOIN lead_events USING (lead_event_id))
SELECT sequence_id, lead_event_id, place::INT AS place FROM r WHERE place <= 3""")
def sequence_events(spark, sf):
    """The first three events of each sequence, the anchor ones first."""
    bridge = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("sequence_id"), F.col("l_orderkey").alias("lead_event_id")).distinct()
    bridge = bridge.withColumn("event_role", F.when(F.col("lead_event_id") % 7 == 0, "anchor").otherwise("supporting"))
    return joins.sequence_events(bridge, lead_events(spark, sf)).where("place <= 3").select("sequence_id", "lead_event_id", "place")


@query(f"WITH {LEAD_EVENTS} SELECT trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS company_key, count(*) AS n FROM lead_events JOIN customer ON c_custkey = company_id GROUP BY 1")
def company_history(spark, sf):
    """J07"""
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("canonical_name"))
    return joins.company_history(lead_events(spark, sf), names).groupBy("company_key").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {LEAD_EVENTS}, {CONTACTS} SELECT lead_event_id, count(*) AS n FROM contacts WHERE lead_event_id IN (SELECT lead_event_id FROM lead_events WHERE record_status = 'valid') GROUP BY 1")
def contacts_in_scope(spark, sf):
    """Contacts of active events."""
    active = lead_events(spark, sf).where("record_status = 'valid'")
    return joins.in_scope(contacts(spark, sf), active, "lead_event_id").groupBy("lead_event_id").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT c_nationkey AS company_id, c_custkey AS profile_id, CASE WHEN c_custkey % 3 = 0 THEN 'valid' ELSE 'review' END AS record_status, c_mktsegment, c_custkey % 4 AS n FROM customer)
SELECT company_id, arg_min(profile_id, (record_status <> 'valid', -n, profile_id)) AS profile_id, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ',') AS aliases FROM p GROUP BY company_id""")
def merged_profiles(spark, sf):
    """The best profile of each company, with the names of all."""
    c = table(spark, sf, "customer")
    events = F.slice(F.array(*[F.lit(str(i)) for i in range(3)]), 1, (F.col("c_custkey") % 4).cast("int"))
    rows = c.select(F.col("c_nationkey").alias("company_id"), F.col("c_custkey").alias("profile_id"), F.when(F.col("c_custkey") % 3 == 0, "valid").otherwise("review").alias("record_status"), F.lit("w").alias("why_line"), F.array("c_mktsegment").alias("aliases"), events.alias("lead_event_ids"))
    return aggregates.merged_profiles(rows).select("company_id", "profile_id", F.array_join("aliases", ",").alias("aliases"))


@query("""WITH e AS (SELECT DISTINCT o_orderpriority AS day, o_custkey AS id FROM orders), a AS (SELECT DISTINCT o_orderpriority AS day, o_custkey AS id FROM orders WHERE o_orderstatus = 'O' OR o_custkey % 5 = 0),
c AS (SELECT o_orderpriority AS day, count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'F') AS r, count(*) FILTER (WHERE l_quantity > 10) AS s FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'A' GROUP BY 1)
SELECT e.day, count(a.id) / count(*) AS retention, any_value(r / n) AS reachable, any_value(s / n) AS sourced FROM e LEFT JOIN a ON a.day = e.day AND a.id = e.id JOIN c ON c.day = e.day GROUP BY e.day""")
def promotion_inputs(spark, sf):
    """A10: shares of what is accounted for, reachable and sourced."""
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("day"), F.col("o_custkey").alias("id"), "o_orderstatus", "o_orderkey")
    line = table(spark, sf, "lineitem").join(o, F.col("o_orderkey") == F.col("l_orderkey"))
    people = line.select("day", (F.col("l_returnflag") == "A").alias("selected"), F.when(F.col("l_linestatus") == "F", "m").otherwise("").alias("email"), F.lit("").alias("phone"), F.lit(None).cast("string").alias("linkedin"), F.when(F.col("l_quantity") > 10, 1).otherwise(0).alias("evidence_count"))
    return aggregates.promotion_inputs(o.select("day", "id"), o.where("o_orderstatus = 'O'").select("day", "id"), o.where("id % 5 = 0").select("day", "id"), people)


@query("SELECT c_custkey AS person_id, c_custkey % 2 = 1 AS billable FROM customer WHERE c_custkey NOT IN (SELECT l_orderkey % 40009 FROM lineitem WHERE l_linestatus = 'F')")
def contact_fallback(spark, sf):
    """People that no contact reaches."""
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("person_id"))
    some = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 40009).alias("person_id"), F.when(F.col("l_linestatus") == "F", "a@x").otherwise("").alias("email"), F.lit("").alias("phone"))
    return stages.contact_fallback(people, some, people.where("person_id % 2 = 0"))
