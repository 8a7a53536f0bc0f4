"""The driver's tables in the roles of the domain, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.session import table


def lead_events(spark: SparkSession, sf: str) -> DataFrame:
    """orders: company_id, lead_event_id, score, priority, record_status, date_posted."""
    o = table(spark, sf, "orders")
    priority = F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), "high").when(F.substring("o_orderpriority", 1, 1) == "3", "medium").otherwise("low")
    status = F.when(F.col("o_orderstatus") == "O", "valid").when(F.col("o_orderstatus") == "P", "review").otherwise("rejected")
    return o.select(F.col("o_custkey").alias("company_id"), F.col("o_orderkey").alias("lead_event_id"), (F.floor("o_totalprice") % 101).cast("int").alias("score"), priority.alias("priority"), status.alias("record_status"), F.col("o_orderdate").cast("date").alias("date_posted"))


LEAD_EVENTS = """lead_events AS (
  SELECT o_custkey AS company_id, o_orderkey AS lead_event_id, (floor(o_totalprice)::BIGINT % 101)::INT AS score,
         CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'high' WHEN left(o_orderpriority, 1) = '3' THEN 'medium' ELSE 'low' END AS priority,
         CASE o_orderstatus WHEN 'O' THEN 'valid' WHEN 'P' THEN 'review' ELSE 'rejected' END AS record_status,
         o_orderdate::DATE AS date_posted FROM orders)"""


def contacts(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem: lead_event_id, person_id, contact_candidate_id (a text that is unique), verification_status, email, phone, evidence_count."""
    line = table(spark, sf, "lineitem")
    status = F.when(F.col("l_returnflag") == "A", "verified").when(F.col("l_returnflag") == "N", "unknown").otherwise("rejected")
    id = F.format_string("%012d-%04d-%012d-%012d", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"))
    mail = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("p"), F.col("l_suppkey").cast("string"), F.lit("@example.com"))).otherwise("")
    return line.select(F.col("l_orderkey").alias("lead_event_id"), F.col("l_suppkey").alias("person_id"), id.alias("contact_candidate_id"), status.alias("verification_status"), mail.alias("email"), F.lit("").alias("phone"), F.col("l_quantity").cast("int").alias("evidence_count"), F.col("l_partkey"), F.col("l_extendedprice"))


CONTACTS = """contacts AS (
  SELECT l_orderkey AS lead_event_id, l_suppkey AS person_id,
         printf('%012d-%04d-%012d-%012d', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS contact_candidate_id,
         CASE l_returnflag WHEN 'A' THEN 'verified' WHEN 'N' THEN 'unknown' ELSE 'rejected' END AS verification_status,
         CASE WHEN l_linestatus = 'F' THEN 'p' || l_suppkey || '@example.com' ELSE '' END AS email, '' AS phone,
         l_quantity::INT AS evidence_count, l_partkey, l_extendedprice FROM lineitem)"""


def log(spark: SparkSession, sf: str) -> DataFrame:
    """events as a log of changes: user_id, seq (ts and event_id), event_type, value, props, ts."""
    e = table(spark, sf, "events")
    return e.select("user_id", F.struct("ts", "event_id").alias("seq"), "event_id", "ts", "event_type", "value", "props")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")
