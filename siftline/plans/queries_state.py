"""Upserts as folds, caches, queues and state machines over the events table as a log."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.operators import cache, fold, pick
from siftline.plans.catalog import query
from siftline.plans.domain import LEAD_EVENTS, lead_events, log
from siftline.session import table
from siftline.streaming import feed_health, queue, sequences, suppression, webhooks

_SEQ = "ts, event_id"


@query(f"""SELECT user_id, min(event_id) AS event_id, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY {_SEQ}) AS k FROM events) WHERE k = 1 GROUP BY user_id""")
def insert_if_absent(spark, sf):
    """M01, T01's batch twin: the first row of each user and type."""
    rows = pick.first_per_key(log(spark, sf).select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], [F.col("ts").alias("a"), F.col("event_id").alias("b")])
    return rows.groupBy("user_id").agg(F.min("event_id").alias("event_id"), F.count(F.lit(1)).alias("n"))


@query(f"SELECT user_id, arg_max(event_type, ({_SEQ})) AS event_type, round(arg_max(value, ({_SEQ})), 6) AS value, arg_min(event_id, ({_SEQ})) AS created FROM events GROUP BY user_id")
def last_writer_wins(spark, sf):
    """The last row's values, the first row's creation."""
    rows = log(spark, sf).withColumn("created", F.col("event_id"))
    out = fold.fold(rows, ["user_id"], "seq", {"event_type": fold.LAST, "value": fold.LAST, "created": fold.FIRST})
    return out.withColumn("value", F.round("value", 6))


@query(f"SELECT user_id, arg_max(event_id, ({_SEQ})) FILTER (WHERE event_type = 'purchase') AS bought, arg_max(event_type, ({_SEQ})) FILTER (WHERE event_type <> 'view') AS kind FROM events GROUP BY user_id")
def coalesce_and_non_empty(spark, sf):
    """Nulls never overwrite one column, empty texts never another."""
    rows = log(spark, sf).select("user_id", "seq", F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("bought"), F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("kind"))
    return fold.fold(rows, ["user_id"], "seq", {"bought": fold.COALESCE, "kind": fold.NON_EMPTY})


@query("SELECT user_id, max(event_id % 17)::BIGINT AS retry_count FROM events GROUP BY user_id")
def monotone_max(spark, sf):
    """M05"""
    return fold.fold(log(spark, sf).withColumn("retry_count", F.col("event_id") % 17), ["user_id"], "seq", {"retry_count": fold.MAX})


@query(f"""WITH p AS (SELECT user_id, ts, event_id, CASE WHEN event_type IN ('click', 'error') THEN 1 END AS has_a, CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS a FROM events)
SELECT user_id, arg_max_null(a, ({_SEQ})) FILTER (WHERE has_a = 1) AS a FROM p GROUP BY user_id""")
def patch_fold(spark, sf):
    """A patch that names a column sets it, also to null."""
    kind = F.col("event_type")
    patch = F.when(kind == "click", F.create_map(F.lit("a"), F.col("event_id"))).when(kind == "error", F.create_map(F.lit("a"), F.lit(None).cast("bigint"))).otherwise(F.create_map(F.lit("b"), F.col("event_id")))
    return fold.patch_fold(log(spark, sf).withColumn("patch", patch), ["user_id"], "seq", "patch", ["a"])


@query(f"SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'converted' ELSE arg_max(event_type, ({_SEQ})) END AS event_type FROM events GROUP BY user_id")
def sticky_conversion(spark, sf):
    """M22"""
    return fold.sticky(log(spark, sf), ["user_id"], "seq", "event_type", F.col("event_type") == "purchase", "converted")


@query(f"""WITH f AS (SELECT user_id, min((ts, event_id)) FILTER (WHERE event_type <> 'view') AS fixed FROM events GROUP BY user_id),
h AS (SELECT e.user_id, max(event_id % 3) AS held FROM events e JOIN f ON e.user_id = f.user_id AND (e.ts, e.event_id) = f.fixed GROUP BY e.user_id)
SELECT h.user_id, h.held AS content, count(*) FILTER (WHERE (e.ts, e.event_id) > f.fixed AND e.event_id % 3 <> h.held)::BIGINT AS violations FROM h JOIN f USING (user_id) JOIN events e ON e.user_id = h.user_id GROUP BY h.user_id, h.held""")
def immutable_after_approval(spark, sf):
    """The first row that isn't a draft fixes the content."""
    rows = log(spark, sf).withColumn("content", F.col("event_id") % 3)
    out = fold.immutable_after(rows, ["user_id"], "seq", "event_type", "view", "content")
    return out.where("fixed_at is not null").select("user_id", "content", "violations")


@query(f"""SELECT user_id, event_type AS stage, arg_max(s, ({_SEQ})) AS status, count(*) FILTER (WHERE s = 'running')::BIGINT AS attempts FROM (SELECT *, ['running', 'completed', 'failed'][event_id % 3 + 1] AS s FROM events) GROUP BY user_id, event_type""")
def stage_runs(spark, sf):
    """M18"""
    status = F.element_at(F.array(*[F.lit(x) for x in ("running", "completed", "failed")]), (F.col("event_id") % 3 + 1).cast("int"))
    rows = log(spark, sf).select(F.col("user_id").alias("run_id"), F.col("event_type").alias("stage"), "seq", status.alias("status"), F.col("ts").alias("at"))
    return fold.stage_runs(rows).select(F.col("run_id").alias("user_id"), "stage", "status", "attempts")


@query(f"""WITH {LEAD_EVENTS}, r AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R')
SELECT e.lead_event_id, CASE WHEN r.k IS NULL THEN e.record_status ELSE 'review' END AS record_status, CASE WHEN r.k IS NULL THEN 'kept' ELSE 'kept,returned' END AS errors FROM lead_events e LEFT JOIN r ON r.k = e.lead_event_id""")
def retire_events(spark, sf):
    """Events of retired candidates go to review."""
    e = lead_events(spark, sf).withColumn("primary_candidate_id", F.col("lead_event_id")).withColumn("validation_errors", F.array(F.lit("kept")))
    gone = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("candidate_id"), F.lit("returned").alias("reason"))
    return fold.retire(e, gone).select("lead_event_id", "record_status", F.array_join("validation_errors", ",").alias("errors"))


@query("SELECT c_mktsegment AS alias_value, count(DISTINCT c_nationkey)::INT AS n FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey) > 1")
def alias_conflicts(spark, sf):
    """M14"""
    a = table(spark, sf, "customer").select(F.lit("name").alias("alias_type"), F.col("c_mktsegment").alias("alias_value"), F.col("c_nationkey").alias("company_id"))
    return fold.alias_conflicts(a).select("alias_value", F.size("companies").alias("n"))


@query("""WITH e AS (SELECT event_type, user_id, max(event_id % 4) AS retry_count FROM events GROUP BY ALL) SELECT event_type AS stage, count(*) AS n FROM e WHERE retry_count < 3 AND user_id % 2 = 0 GROUP BY event_type""")
def eligible_reviews(spark, sf):
    """Open reviews with retries left, by stage."""
    rows = fold.fold(log(spark, sf).withColumn("retry_count", F.col("event_id") % 4), ["event_type", "user_id"], "seq", {"retry_count": fold.MAX})
    rows = rows.select(F.col("event_type").alias("stage"), F.when(F.col("user_id") % 2 == 0, "open").otherwise("resolved").alias("state"), "retry_count")
    return fold.eligible_reviews(rows, 3).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT user_id AS cache_key, max(CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END) AS t, bool_or(event_id % 5 = 0) AS forever FROM events WHERE user_id % 3 <> 0 GROUP BY user_id)
SELECT u.user_id AS cache_key, c.cache_key IS NOT NULL AS hit FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN c ON c.cache_key = u.user_id AND (c.forever OR c.t > timestamp '2024-01-29 00:00:00')""")
def cache_lookup(spark, sf):
    """Hits and misses as of a time."""
    e = log(spark, sf)
    entries = e.where("user_id % 3 <> 0").groupBy(F.col("user_id").alias("cache_key")).agg(F.when(~F.bool_or(F.col("event_id") % 5 == 0), F.max("ts").cast("timestamp")).alias("expires_at"))
    hits, misses = cache.lookup(e.select(F.col("user_id").alias("cache_key")).distinct(), entries, F.lit("2024-01-29 00:00:00").cast("timestamp"))
    return hits.select("cache_key", F.lit(True).alias("hit")).unionByName(misses.select("cache_key", F.lit(False).alias("hit")))


@query(f"""WITH r AS (SELECT *, sum(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY {_SEQ} ROWS UNBOUNDED PRECEDING) AS spent FROM events)
SELECT user_id, count(*) FILTER (WHERE event_id % 2 = 1 OR spent <= 20)::BIGINT AS allowed FROM r GROUP BY user_id""")
def request_cap(spark, sf):
    """The first twenty new requests of each key."""
    out = cache.within_cap(log(spark, sf).withColumn("is_new", F.col("event_id") % 2 == 0), ["user_id"], [F.col("ts"), F.col("event_id")], 20)
    return out.groupBy("user_id").agg(F.count_if("allowed").alias("allowed"))


@query("""WITH i AS (SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'running' ELSE 'completed' END AS status, ts AS run_after, ts + INTERVAL 5 MINUTES AS lease_until, (event_id % 4)::INT AS attempt_count FROM events)
SELECT id, 'running' AS status, attempt_count + 1 AS attempt_count FROM i WHERE (status = 'pending' AND run_after <= timestamp '2024-01-15 00:00:00') OR (status = 'running' AND lease_until < timestamp '2024-01-15 00:00:00') ORDER BY run_after, id LIMIT 15""")
def claim_work(spark, sf):
    """The next fifteen items that are due or whose lease ran out."""
    e = log(spark, sf)
    status = F.when(F.col("event_id") % 3 == 0, "pending").when(F.col("event_id") % 3 == 1, "running").otherwise("completed")
    items = e.select(F.col("event_id").alias("id"), status.alias("status"), F.col("ts").cast("timestamp").alias("run_after"), (F.col("ts").cast("timestamp") + F.expr("interval 5 minutes")).alias("lease_until"), (F.col("event_id") % 4).cast("int").alias("attempt_count"))
    return queue.claim(items, F.lit("2024-01-15 00:00:00").cast("timestamp"), "worker", 15, 300).select("id", "status", "attempt_count")


_ACTION = "CASE WHEN event_type IN ('click', 'signup') THEN 'claim' WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'replay' WHEN event_type IN ('error', 'purchase') THEN 'retry' ELSE CASE event_id % 4 WHEN 0 THEN 'complete' WHEN 1 THEN 'enqueue' ELSE 'defer' END END"


@query(f"""WITH RECURSIVE a AS (SELECT user_id, {_ACTION} AS action, row_number() OVER (PARTITION BY user_id ORDER BY {_SEQ}) AS n FROM events),
w AS (SELECT user_id, 0::BIGINT AS n, 'pending' AS status, 0::BIGINT AS attempts FROM (SELECT DISTINCT user_id FROM a)
UNION ALL SELECT a.user_id, a.n, CASE action WHEN 'claim' THEN 'running' WHEN 'complete' THEN 'completed' WHEN 'retry' THEN CASE WHEN attempts >= 3 THEN 'dead_letter' ELSE 'pending' END
  WHEN 'replay' THEN CASE WHEN status = 'dead_letter' THEN 'pending' ELSE status END ELSE 'pending' END,
  CASE action WHEN 'claim' THEN attempts + 1 WHEN 'defer' THEN greatest(0, attempts - 1) WHEN 'replay' THEN CASE WHEN status = 'dead_letter' THEN 0 ELSE attempts END ELSE attempts END
  FROM w JOIN a ON a.user_id = w.user_id AND a.n = w.n + 1)
SELECT user_id, status, attempts FROM w QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1""")
def queue_states(spark, sf):
    """Each work item after its log of claims, retries, deferrals, completions and replays, against the log step by step."""
    rows = log(spark, sf).select(F.col("user_id").alias("key"), "seq", F.expr(_ACTION).alias("action"))
    return queue.fold_actions(rows, 3).select(F.col("key").alias("user_id"), "status", "attempts")


@query(f"""WITH g AS (SELECT user_id, event_type = 'error' AS bad, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY {_SEQ}) - row_number() OVER (PARTITION BY user_id, event_type = 'error' ORDER BY {_SEQ}) AS grp FROM events),
r AS (SELECT user_id, grp, count(*) AS n, max((ts, event_id)) AS last FROM g WHERE bad GROUP BY user_id, grp), l AS (SELECT user_id, max((ts, event_id)) AS last, max(ts) FILTER (WHERE event_type <> 'error') AS ok FROM events GROUP BY user_id)
SELECT l.user_id, coalesce(r.n, 0)::BIGINT AS failures, CASE WHEN r.n IS NULL THEN 'active' WHEN r.n >= 7 OR l.ok IS NULL OR date_diff('day', l.ok::DATE, date '2024-02-05') >= 30 THEN 'disabled' WHEN r.n >= 3 OR date_diff('day', l.ok::DATE, date '2024-02-05') >= 14 THEN 'degraded' ELSE 'pending' END AS status
FROM l LEFT JOIN r ON r.user_id = l.user_id AND r.last = l.last""")
def feed_states(spark, sf):
    """Feeds by their failures in a row and days without an item."""
    checks = log(spark, sf).select(F.col("user_id").alias("feed_id"), "seq", F.to_date("ts").alias("day"), (F.col("event_type") == "error").alias("failed"))
    return feed_health.feed_states(checks, F.lit("2024-02-05").cast("date")).select(F.col("feed_id").alias("user_id"), "failures", "status")


@query(f"""SELECT user_id AS email, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS suppressed_at, arg_max(event_type, ({_SEQ})) AS reason, arg_max(event_id::VARCHAR, ({_SEQ})) FILTER (WHERE event_id % 4 <> 0) AS external_event_id FROM events WHERE event_type IN ('error', 'click') GROUP BY user_id""")
def suppressions(spark, sf):
    """The first time, the last reason and the last external id that isn't empty."""
    rows = log(spark, sf).where("event_type in ('error', 'click')").select(F.col("user_id").alias("email"), "seq", F.col("ts").alias("at"), F.col("event_type").alias("reason"), F.when(F.col("event_id") % 4 != 0, F.col("event_id").cast("string")).otherwise("").alias("external_event_id"))
    return suppression.fold_suppressions(rows).withColumn("suppressed_at", F.date_format("suppressed_at", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT event_type AS provider, count(DISTINCT user_id)::BIGINT AS n FROM events GROUP BY 1")
def webhook_items(spark, sf):
    """One work item for each provider and event id, however often it comes."""
    hooks = log(spark, sf).select(F.col("event_type").alias("provider"), F.col("user_id").cast("string").alias("provider_event_id"), F.lit("reply").alias("event_type"), F.col("props").alias("payload"), F.col("ts").cast("timestamp").alias("received_at"), F.lit(True).alias("signature_valid"))
    return webhooks.work_items(webhooks.accept(hooks)).groupBy("provider").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH s AS (SELECT user_id, ts, event_id, event_type FROM events) SELECT user_id AS sequence_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'replied' WHEN bool_or(event_type = 'error') THEN 'stopped' WHEN bool_or(event_type = 'click') THEN 'enrolled' ELSE 'draft' END AS state FROM s GROUP BY user_id""")
def sequence_states(spark, sf):
    """A reply outranks a stop, a stop an enrollment."""
    kind = F.when(F.col("event_type") == "purchase", "reply").when(F.col("event_type") == "error", "bounce").when(F.col("event_type") == "click", "enrolled").otherwise("opened")
    return sequences.fold_states(log(spark, sf).select(F.col("user_id").alias("sequence_id"), "seq", kind.alias("event_type")))


@query("SELECT count(*) AS n, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS upto FROM events WHERE ts > timestamp '2024-01-10 00:00:00' AND ts <= timestamp '2024-01-20 00:00:00'")
def digest_window(spark, sf):
    """What came after the last successful run, up to this one's start."""
    rows = queue.digest_window(log(spark, sf), "ts", F.lit("2024-01-10 00:00:00"), F.lit("2024-01-20 00:00:00"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("upto"))
