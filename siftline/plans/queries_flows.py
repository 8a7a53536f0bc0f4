"""What changes saved rows, decides on them and queues them."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.functions.ids import stable_hash
from siftline.operators import cache, eligibility, fold, pick, similarity, stages
from siftline.plans.catalog import query
from siftline.plans.domain import LEAD_EVENTS, lead_events
from siftline.session import table
from siftline.streaming import queue, sequences, suppression, webhooks


def _key(name: str):
    return F.col(name).cast("string")


def _orders(spark, sf):
    return table(spark, sf, "orders")


def _customers(spark, sf):
    return table(spark, sf, "customer")


# --- mutations

@query("SELECT o_orderkey, o_orderkey % 2 AS run FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def pruned_outreach(spark, sf):
    """Of one run the rows that are kept, of the other all."""
    state = _orders(spark, sf).select("o_orderkey", (F.col("o_orderkey") % 2).alias("run"), F.concat(F.lit("r"), (F.col("o_orderkey") % 2).cast("string")).alias("run_id"))
    kept = table(spark, sf, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return fold.prune(state, kept, "r1", "o_orderkey").select("o_orderkey", "run")


@query("SELECT o_custkey AS owner, o_orderkey AS member FROM orders WHERE o_custkey % 4 <> 0 OR o_orderstatus = 'F' AND o_custkey % 4 = 0 UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_custkey % 4 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def replaced_groups(spark, sf):
    """A group that comes anew replaces all of its old members."""
    old = _orders(spark, sf).select(F.col("o_custkey").alias("owner"), F.col("o_orderkey").alias("member"))
    some = _orders(spark, sf).where("o_orderstatus = 'F' and o_custkey % 4 = 0").select(F.col("o_custkey").alias("owner"), F.col("o_orderkey").alias("member"))
    none = _customers(spark, sf).where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("owner"), F.lit(-1).cast("long").alias("member")).join(some.select("owner").distinct(), "owner", "left_anti")
    return fold.replace_groups(old, some.unionByName(none), "owner")


@query("SELECT o_orderkey AS merged_event_id, min(o_orderkey) OVER (PARTITION BY o_custkey) AS kept_event_id FROM orders QUALIFY o_orderkey <> min(o_orderkey) OVER (PARTITION BY o_custkey)")
def merge_ledger(spark, sf):
    """Which event went into which, those that stay excluded."""
    o = _orders(spark, sf)
    events = o.select(F.col("o_orderkey").alias("lead_event_id"), F.array("o_orderpriority").alias("supporting_ids"))
    groups = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("kept_id"), F.collect_list("o_orderkey").alias("member_ids"))
    return stages.merge_groups(events, groups)[1]


@query("SELECT o_custkey AS dedupe_key, min(o_orderkey) AS item FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10) GROUP BY 1")
def enqueued_once(spark, sf):
    """One item for each key that the queue hasn't."""
    items = _orders(spark, sf).select(F.col("o_custkey").alias("dedupe_key"), F.col("o_orderkey").alias("item"))
    known = _customers(spark, sf).where("c_nationkey < 10").select(F.col("c_custkey").alias("dedupe_key"))
    return fold.enqueue_unless_known(items, known, [F.col("item").alias("i")])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'done' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def status_transitions(spark, sf):
    """Changed values by key, null included; changes of unknown keys do nothing."""
    o = _orders(spark, sf)
    changes = o.where("o_orderkey % 5 < 2").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 1, "done").alias("value"))
    unknown = spark.range(1).select((F.col("id") - 1).alias("o_orderkey"), F.lit("x").alias("value"))
    return fold.transition(o.select("o_orderkey", "o_orderstatus"), changes.unionByName(unknown), "o_orderkey", "o_orderstatus")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(value) AS best, arg_min(value, event_id) AS first_value, arg_max(value, event_id) FILTER (WHERE value IS NOT NULL) AS last_known FROM events GROUP BY 1")
def folded_upserts(spark, sf):
    """A log of upserts as the state that it leaves, each column by its own rule."""
    log = table(spark, sf, "events").withColumn("best", F.col("value")).withColumn("first_value", F.col("value")).withColumn("last_known", F.col("value"))
    return fold.fold(log, ["user_id"], "event_id", {"event_type": fold.LAST, "best": fold.MAX, "first_value": fold.FIRST, "last_known": fold.COALESCE})


@query("SELECT s_suppkey AS organization_id, 'supplier ' || lpad(s_suppkey::VARCHAR, 9, '0') AS alias FROM supplier UNION SELECT s_suppkey, 'shop ' || s_suppkey % 9 FROM supplier")
def alias_bridge(spark, sf):
    """An organization and its names in normal form, once each."""
    plain = F.concat(F.lit("Supplier#"), F.lpad(_key("s_suppkey"), 9, "0"))
    shop = F.concat(F.lit("SHOP  "), (F.col("s_suppkey") % 9).cast("string"))
    return fold.alias_bridge(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("organization_id"), plain.alias("canonical_name"), F.array(shop, F.lower(shop), F.lit(" ")).alias("aliases")))


@query("SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def unique_key_violations(spark, sf):
    """Values of a second unique key that several rows have."""
    return fold.key_violations(_orders(spark, sf), ["o_custkey", "o_orderpriority"])


@query("SELECT c_custkey, c_custkey * 2 AS stands_for FROM customer WHERE c_custkey % 3 = 0")
def resolved_tokens(spark, sf):
    """Tokens are stored as hashes only."""
    token = F.concat(F.lit("t"), _key("c_custkey"))
    c = _customers(spark, sf)
    stored = c.where("c_custkey % 3 = 0").select(F.sha2(token, 256).alias("token_hash"), (F.col("c_custkey") * 2).alias("stands_for"))
    return fold.resolve_tokens(c.select("c_custkey", token.alias("token")), stored).select("c_custkey", "stands_for")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 10 NOT IN (3, 7)")
def sendable_messages(spark, sf):
    """Messages to mailboxes that aren't suppressed, whatever their case."""
    mail = F.concat(F.lit(" P"), (F.col("c_custkey") % 10).cast("string"), F.lit("@X.com"))
    gone = spark.range(10).where("id in (3, 7)").select(F.concat(F.lit("p"), _key("id"), F.lit("@x.com ")).alias("email"))
    return suppression.may_send(_customers(spark, sf).select("c_custkey", mail.alias("email")), gone).select("c_custkey")


# --- caches

@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN true WHEN c_custkey % 4 = 1 THEN false END AS result, c_custkey % 4 < 3 AS cached FROM customer")
def cached_checks(spark, sf):
    """True, false or unknown; entries past their time count as not there."""
    c, k = _customers(spark, sf), F.col("c_custkey") % 4
    now = F.lit("2024-01-10").cast("timestamp")
    entries = c.select(stable_hash(F.lit("mx"), "c_name").alias("cache_key"), F.when(k == 0, "true").when(k == 1, "false").otherwise("unknown").alias("status"), F.when(k == 3, F.lit("2024-01-09")).otherwise(F.lit("2024-01-17")).cast("timestamp").alias("expires_at"))
    return cache.checked(c.select("c_custkey", F.col("c_name").alias("value")), entries, now, "mx").select("c_custkey", "result", "cached")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 2 THEN '2024-02-09' END AS until FROM orders WHERE o_orderkey % 4 < 3")
def lookup_outcomes(spark, sf):
    """Found and fatal stay, null for thirty days, transient isn't kept."""
    status = F.element_at(F.array(*[F.lit(s) for s in ("found", "fatal", "null", "transient")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    out = cache.lookup_outcomes(_orders(spark, sf).select("o_orderkey", status.alias("status")), F.lit("2024-01-10").cast("timestamp"))
    return out.select("o_orderkey", F.date_format("expires_at", "yyyy-MM-dd").alias("until"))


@query("SELECT user_id AS email, arg_max(event_type, event_id) AS status, max(event_id) AS reason FROM events WHERE event_id % 2 = 1 GROUP BY 1")
def policy_verifications(spark, sf):
    """The last status of each mailbox under one version of the policy."""
    log = table(spark, sf, "events").select(F.col("user_id").alias("email"), F.col("event_type").alias("status"), F.col("event_id").alias("reason"), F.col("event_id").alias("seq"), F.concat(F.lit("v"), (F.col("event_id") % 2).cast("string")).alias("policy_version"))
    return cache.policy_verified(log, "v1")


# --- queues and windows

@query("WITH l AS (SELECT user_id, arg_max(event_type, event_id) AS t, max(event_id) AS s FROM events GROUP BY 1) SELECT user_id AS operation_key, CASE WHEN t = 'view' AND s % 2 = 0 THEN 'uncertain' WHEN t = 'view' THEN 'started' ELSE 'completed' END AS status FROM l")
def provider_operations(spark, sf):
    """Started operations whose lease ran out are uncertain."""
    lease = F.when(F.col("event_id") % 2 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-03-01")).cast("timestamp")
    log = table(spark, sf, "events").select(F.col("user_id").alias("operation_key"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "view", "started").otherwise("completed").alias("status"), lease.alias("lease_until"))
    return queue.operations(log, F.lit("2024-02-01").cast("timestamp"))


_PADS = {name: bytes(b ^ byte for b in b"secret".ljust(64, b"\0")).hex() for name, byte in (("inner", 0x36), ("outer", 0x5C))}
_HMAC = f"sha256(unhex('{_PADS['outer']}') || unhex(sha256(unhex('{_PADS['inner']}') || encode(o_orderkey || '.' || o_orderstatus))))"


@query(f"SELECT o_orderkey, {_HMAC} AS mac FROM orders")
def webhook_macs(spark, sf):
    """The HMAC of a hook's time and payload."""
    return _orders(spark, sf).select("o_orderkey", webhooks.hmac_sha256("secret", F.concat_ws(".", _key("o_orderkey"), "o_orderstatus")).alias("mac"))


@query("SELECT o_orderkey, o_orderkey % 3 = 0 AND abs(o_orderkey * 1000 - 9000000) <= 300000 AS signature_valid FROM orders")
def signed_hooks(spark, sf):
    """A right signature within five minutes of now."""
    sent = F.col("o_orderkey") * 1000
    mac = webhooks.hmac_sha256("secret", F.concat_ws(".", sent.cast("string"), "o_orderstatus"))
    hooks = _orders(spark, sf).select("o_orderkey", sent.alias("sent_ms"), F.col("o_orderstatus").alias("payload"), F.when(F.col("o_orderkey") % 3 == 0, mac).when(F.col("o_orderkey") % 3 == 1, F.upper(mac)).alias("signature"))
    return webhooks.signed(hooks, "secret", 9_000_000).select("o_orderkey", "signature_valid")


@query("SELECT o_orderkey, abs(o_orderkey * 1000 - 9000000) <= 300000 AS inside FROM orders")
def replay_window(spark, sf):
    """Both ends count."""
    return _orders(spark, sf).select("o_orderkey", queue.in_replay_window(F.col("o_orderkey") * 1000, F.lit(9_000_000)).alias("inside"))


@query("WITH p AS (SELECT o_custkey, max(CASE WHEN o_orderkey % 97 > 0 THEN o_orderkey END) AS n, bool_or(o_orderkey % 97 = 0) AS gone FROM orders GROUP BY 1) SELECT c_custkey AS mailbox, CASE WHEN coalesce(gone, false) THEN NULL ELSE greatest(5000, coalesce(n, 5000)) END AS cursor, coalesce(gone, false) AS resync FROM customer LEFT JOIN p ON o_custkey = c_custkey")
def mail_cursors(spark, sf):
    """A cursor never goes back; where the old one is gone, all starts over."""
    state = _customers(spark, sf).select(F.col("c_custkey").alias("mailbox"), F.lit(5000).cast("long").alias("cursor"))
    return queue.advance_cursor(state, _orders(spark, sf).select(F.col("o_custkey").alias("mailbox"), F.when(F.col("o_orderkey") % 97 > 0, F.col("o_orderkey")).alias("next_cursor")))


@query("SELECT user_id AS key, CASE arg_max(event_type, event_id) WHEN 'view' THEN 'enqueue' ELSE 'claim' END AS last FROM events GROUP BY 1")
def worker_pass(spark, sf):
    """What is waiting is handled in batches that a restart repeats whole; a repeated batch changes nothing."""
    from siftline.plans.queries_intake import _scratch

    path, done = _scratch(spark, "pass"), _scratch(spark, "pass-checkpoint")
    out = f"{path}-out"
    log = table(spark, sf, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "view", "enqueue").otherwise("claim").alias("last"))
    log.repartition(3, "key").write.parquet(path)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(path)
    handle = lambda rows, batch: rows.groupBy("key").agg(F.max_by("last", "seq").alias("last"), F.max("seq").alias("seq")).write.mode("overwrite").parquet(f"{out}/batch={batch}")
    webhooks.run_available(stream, handle, done).awaitTermination()
    return spark.read.parquet(out).groupBy("key").agg(F.max_by("last", "seq").alias("last"))


@query("SELECT o_orderkey, o_orderstatus, before FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders) WHERE before IS NOT NULL AND before <> o_orderstatus")
def contact_revisions(spark, sf):
    """Rows whose value differs from the one before."""
    return queue.changed(_orders(spark, sf), ["o_custkey"], "o_orderstatus", [F.col("o_orderkey")]).select("o_orderkey", "o_orderstatus", "before")


@query("SELECT c_custkey AS sequence_id FROM customer WHERE c_custkey % 2 = 0 AND c_nationkey % 3 = 0")
def approved_sequences(spark, sf):
    """A batch that holds, is in time, and names the sequence with its hash."""
    c = _customers(spark, sf)
    seq = c.select(_key("c_custkey").alias("sequence_id"), _key("c_nationkey").alias("campaign_id"), F.lit("m").alias("manifest_hash"), F.concat(F.lit("h"), _key("c_custkey")).alias("merge_hash"))
    hashes = F.map_from_entries(F.collect_list(F.struct(_key("c_custkey"), F.concat(F.when(F.col("c_custkey") % 2 == 0, "h").otherwise("x"), _key("c_custkey")))))
    batches = c.groupBy("c_nationkey").agg(hashes.alias("merge_hashes")).select(_key("c_nationkey").alias("campaign_id"), F.lit("m").alias("manifest_hash"), F.when(F.col("c_nationkey") % 3 == 1, "2023-01-01").otherwise("2024-06-01").alias("expires_at"), F.when(F.col("c_nationkey") % 3 == 2, "2023-05-05").alias("revoked_at"), "merge_hashes")
    return sequences.approved(seq, batches, F.lit("2024-01-01")).select(F.col("sequence_id").cast("long").alias("sequence_id"))


@query("SELECT o_orderkey AS lead_event_id, CASE WHEN o_orderstatus = 'O' THEN 'converted' ELSE 'archived_supporting' END AS state FROM orders WHERE o_custkey % 2 = 0 AND o_custkey % 3 <> 0")
def conversions(spark, sf):
    """The events of converted sequences, those with a deal as they were."""
    bridge = _orders(spark, sf).select(F.col("o_custkey").alias("sequence_id"), F.col("o_orderkey").alias("lead_event_id"), F.when(F.col("o_orderstatus") == "O", "anchor").otherwise("supporting").alias("event_role"))
    ids = _customers(spark, sf).select(F.col("c_custkey").alias("sequence_id"))
    return sequences.conversions(bridge, ids.where("sequence_id % 2 = 0"), ids.where("sequence_id % 3 = 0")).select("lead_event_id", "state")


# --- picks and unions

@query("WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) SELECT o_orderkey, n <= 200 AS paid FROM r")
def spend_caps(spark, sf):
    """The first two hundred may cost something, the others wait. The cap is the budget."""
    first, rest = pick.spend_cap(_orders(spark, sf).select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 200)
    return first.select("o_orderkey", F.lit(True).alias("paid")).unionByName(rest.select("o_orderkey", F.lit(False).alias("paid")))


@query("WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS ids FROM r WHERE n <= 5 GROUP BY 1")
def judge_samples(spark, sf):
    """The first five rows of each key, in order, for a bounded question."""
    return pick.samples(_orders(spark, sf).select("o_custkey", "o_orderkey"), ["o_custkey"], [F.col("o_orderkey")], 5).select("o_custkey", F.array_join(F.transform("rows", lambda r: r["o_orderkey"].cast("string")), ",").alias("ids"))


@query("SELECT CASE WHEN bool_or(l_linenumber = 1 AND l_returnflag = 'A') THEN 'discover' WHEN bool_or(l_linenumber = 2 AND l_returnflag = 'A') THEN 'qualify' ELSE 'score' END AS stage FROM lineitem WHERE l_quantity < 3 AND l_linenumber > 1")
def retry_stages(spark, sf):
    """The earliest stage with an open review that may be retried."""
    stage = F.element_at(F.array(F.lit("discover"), F.lit("qualify"), F.lit("score")), F.least(F.col("l_linenumber"), F.lit(3)).cast("int"))
    rows = table(spark, sf, "lineitem").select(stage.alias("stage"), F.when(F.col("l_returnflag") == "A", "open").otherwise("closed").alias("state"), F.when((F.col("l_quantity") < 3) & (F.col("l_linenumber") > 1), 0).otherwise(9).alias("retry_count"))
    return pick.retry_stage(rows, ["discover", "qualify", "score"], 3)


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def discovery_union(spark, sf):
    """Batches one after another, the first of each key."""
    e = table(spark, sf, "events").select("user_id", "event_id")
    return pick.first_per_key(e.where("event_id % 2 = 0").unionByName(e.where("event_id % 2 = 1")), ["user_id"], [F.col("event_id").alias("e")])


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'a,' || c_custkey || ',b' ELSE 'b' END AS ids FROM customer")
def ordered_unions(spark, sf):
    """Values once each, in the order of their first place."""
    left = F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("a"), _key("c_custkey"), F.lit("a")))
    return _customers(spark, sf).select("c_custkey", F.array_join(pick.ordered_union(left, F.array(F.lit("b")), F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("a")))), ",").alias("ids"))


@query("SELECT c_custkey, 'p' || c_custkey || '@x.com,b@x.com' AS mails FROM customer")
def unique_recipients(spark, sf):
    """Mailboxes once each, whatever their case."""
    mail = F.concat(F.lit(" P"), _key("c_custkey"), F.lit("@x.com"))
    return _customers(spark, sf).select("c_custkey", F.array_join(pick.unique_recipients(F.array(mail, F.lit("b@X.com"), F.lower(mail), F.lit(None).cast("string"), F.lit(" "))), ",").alias("mails"))


# --- decisions

_ELIGIBLE = f"""WITH {LEAD_EVENTS}, r AS (SELECT *, lead_event_id % 4 AS k FROM lead_events)
SELECT lead_event_id, coalesce(array_to_string([CASE WHEN k = 0 THEN 'recipient_not_primary' END, CASE WHEN score < 70 THEN 'recipient_role_score_below_70' END, CASE WHEN priority = 'low' THEN 'company_profile_not_valid' END,
CASE WHEN k = 1 THEN 'why_line_status_review' END, CASE WHEN k = 2 THEN 'why_line_confidence_low' END, CASE WHEN record_status <> 'valid' THEN 'anchor_record_not_valid' END, CASE WHEN priority <> 'high' THEN 'anchor_confidence_not_high' END,
CASE WHEN score <= 0 THEN 'anchor_score_zero' END, CASE WHEN company_id % 5 = 0 THEN 'blocking_open_review' END, CASE WHEN k = 3 THEN 'recipient_first_name_missing' END], ','), '') AS reasons FROM r"""


@query(_ELIGIBLE)
def recipient_reasons(spark, sf):
    """every reason against a recipient, in order; a review of the company, anchor, person or contact blocks."""
    e, k = lead_events(spark, sf), F.col("lead_event_id") % 4
    rows = e.select(
        "lead_event_id", F.when(k == 0, 2).otherwise(1).alias("rank"), F.col("score").alias("role_score"), F.when(k == 3, "").otherwise("Ann").alias("first_name"), F.concat(F.lit("c"), _key("company_id")).alias("company_id"), F.concat(F.lit("p"), _key("lead_event_id")).alias("person_id"),
        F.lit("k").alias("contact_candidate_id"), F.when(F.col("priority") == "low", "review").otherwise("valid").alias("profile_status"), F.when(k == 1, "review").otherwise("valid").alias("why_line_status"), F.when(k == 2, "low").otherwise("high").alias("why_confidence"),
        F.concat(F.lit("e"), _key("lead_event_id")).alias("anchor_id"), F.col("record_status").alias("anchor_status"), F.col("priority").alias("anchor_confidence"), F.col("score").alias("anchor_score"),
    )
    held = e.where("company_id % 5 = 0").select(F.concat(F.lit("c"), _key("company_id")).alias("record_id"))
    return eligibility.recipient_eligibility(rows, held).select("lead_event_id", F.array_join("eligibility_reasons", ",").alias("reasons"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'key' WHEN 2 THEN 'live' ELSE 'key,live' END AS missing FROM customer")
def missing_settings(spark, sf):
    """settings that are null, empty or false."""
    k = F.col("c_custkey") % 4
    rows = _customers(spark, sf).select("c_custkey", F.when(k.isin(0, 2), "x").when(k == 1, "").alias("key"), k.isin(0, 1).alias("live"))
    return eligibility.missing_settings(rows, ["key", "live"]).select("c_custkey", F.array_join("missing", ",").alias("missing"))


@query("SELECT c_custkey, (['', 'campaign_not_active', 'manifest_hash_mismatch,mailboxes_mismatch', 'campaign_foreign', 'timezone_mismatch,mailboxes_mismatch,mailboxes_repeated'])[(c_custkey % 5) + 1] AS errors FROM customer")
def campaign_checks(spark, sf):
    """live campaigns and what isn't as it was approved."""
    c, k = _customers(spark, sf), F.col("c_custkey") % 5
    boxes = F.when(k == 2, F.array(F.lit("b@x"))).when(k == 4, F.array(F.lit("a@x"), F.lit("A@x "))).otherwise(F.array(F.lit("A@x")))
    live = c.select(_key("c_custkey").alias("campaign_id"), F.when(k == 1, "paused").otherwise("active").alias("status"), F.when(k == 2, "h2").otherwise("h").alias("manifest_hash"), F.when(k == 4, "UTC").otherwise("MST").alias("timezone"), boxes.alias("mailboxes"))
    expected = c.where(k != 3).select(_key("c_custkey").alias("campaign_id"), F.lit("active").alias("status"), F.lit("h").alias("manifest_hash"), F.lit("MST").alias("timezone"), F.array(F.lit("a@x")).alias("mailboxes"))
    return eligibility.campaign_violations(live, expected).select(F.col("campaign_id").cast("long").alias("c_custkey"), F.array_join("errors", ",").alias("errors"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'b' ELSE 'b,c' END AS changed FROM customer")
def hygiene_changes(spark, sf):
    """the entries that differ, null included."""
    k = _key("c_custkey")
    old, new = F.create_map(F.lit("a"), k, F.lit("b"), F.lit("1")), F.create_map(F.lit("a"), k, F.lit("b"), F.lit(None).cast("string"))
    new = F.when(F.col("c_custkey") % 2 == 0, new).otherwise(F.map_concat(new, F.create_map(F.lit("c"), F.lit("x"))))
    return eligibility.changed_fields(_customers(spark, sf).select("c_custkey", old.alias("old"), new.alias("new")), "old", "new").select("c_custkey", F.array_join(F.array_sort(F.map_keys("changes")), ",").alias("changed"))


_JUDGED = """WITH r AS (SELECT o_orderkey, (['event', 'review', 'rejected', 'outside', 'low'])[(o_orderkey % 5) + 1] AS k FROM orders)
SELECT o_orderkey, CASE k WHEN 'low' THEN 'event:review' WHEN 'event' THEN 'event:valid' WHEN 'review' THEN 'review' ELSE 'rejected' END AS route FROM r"""


@query(_JUDGED)
def applied_judgments(spark, sf):
    """Every judged row is an event, for review, or rejected."""
    k = F.col("o_orderkey") % 5
    day = F.when(k == 3, F.lit("2023-01-01")).otherwise(F.lit("2024-01-15")).cast("date")
    rows = _orders(spark, sf).select(
        _key("o_orderkey").alias("candidate_id"), F.lit(None).cast("timestamp").alias("published_at"), (k != 2).alias("qualified"), F.when(k == 1, "").otherwise(F.concat(F.lit("Biz "), _key("o_custkey"))).alias("business_name"), F.lit("sale").alias("event"), day.alias("date_posted"),
        F.lit("Mesa").alias("location"), F.lit("s").alias("summary"), F.lit("Arizona").alias("state"), F.lit("high").alias("priority"), F.when(k == 4, "low").otherwise("high").alias("confidence"), F.lit("macro").alias("filter_reason"), F.lit("Ann").alias("person"),
    )
    out = stages.apply_judgments(rows, "2024-01-01", "2024-02-01")
    id = lambda c: F.col(c).cast("long").alias("o_orderkey")
    found = out["events"].select(id("primary_candidate_id"), F.concat(F.lit("event:"), F.col("record_status")).alias("route"))
    return found.unionByName(out["review"].select(id("candidate_id"), F.lit("review").alias("route"))).unionByName(out["rejected"].select(id("candidate_id"), F.lit("rejected").alias("route")))


@query("""WITH e AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 1 THEN NULL WHEN o_orderkey % 6 = 2 THEN date '2023-01-01' ELSE date '2024-01-15' END AS d, o_custkey % 50 = 0 AS lost,
  o_orderkey % 6 = 3 AS other_day, o_orderkey % 6 = 4 AS other_name, o_orderkey % 7 = 0 AS before FROM orders),
f AS (SELECT o_orderkey, before, concat_ws(',', CASE WHEN d IS NULL THEN 'bulk_event_date_missing' END, CASE WHEN d < date '2024-01-01' THEN 'bulk_event_outside_requested_window' END, CASE WHEN lost THEN 'bulk_event_primary_candidate_missing' END,
  CASE WHEN NOT lost AND other_day THEN 'bulk_event_candidate_date_mismatch' END, CASE WHEN NOT lost AND other_name THEN 'bulk_event_business_not_grounded' END) AS found FROM e)
SELECT o_orderkey, CASE WHEN before OR found <> '' THEN 'review' ELSE 'valid' END AS record_status, CASE WHEN before THEN '' ELSE found END AS errors, NOT before AND found <> '' AND o_orderkey % 5 = 0 AS anchor FROM f""")
def qualification_audits(spark, sf):
    """events with what an audit says of them, and those that fail though a merge has kept them."""
    k, day = F.col("o_orderkey") % 6, F.lit("2024-01-15").cast("date")
    orders, id = _orders(spark, sf), _key("o_orderkey")
    dated = F.when(k == 1, F.lit(None).cast("date")).when(k == 2, F.lit("2023-01-01").cast("date")).otherwise(day)
    events = orders.select(id.alias("lead_event_id"), id.alias("primary_candidate_id"), _key("o_custkey").alias("organization_id"), dated.alias("date_posted"), F.when(F.col("o_orderkey") % 7 == 0, "review").otherwise("valid").alias("record_status"), F.array().cast("array<string>").alias("validation_errors"))
    word = F.concat(F.lit("Firm"), _key("o_custkey"))
    said = F.concat_ws(" ", F.lit("Land bought by"), F.when(k == 4, "another").otherwise(word))
    candidates = orders.where("o_custkey % 50 <> 0").select(id.alias("candidate_id"), F.when(k == 3, F.date_sub(day, 1)).otherwise(F.coalesce(dated, day)).cast("timestamp").alias("published_at"), said.alias("evidence"))
    organizations = _customers(spark, sf).select(_key("c_custkey").alias("organization_id"), F.concat(F.lit("The Firm"), _key("c_custkey"), F.lit(" LLC")).alias("canonical_name"))
    out = stages.audit_events(events, candidates, organizations, orders.where("o_orderkey % 5 = 0").select(id.alias("kept_event_id")), "2024-01-01", "2024-02-01")
    shown = out["events"].join(out["anchors"].withColumn("anchor", F.lit(True)), "lead_event_id", "left")
    return shown.select(F.col("lead_event_id").cast("long").alias("o_orderkey"), "record_status", F.array_join("validation_errors", ",").alias("errors"), F.coalesce("anchor", F.lit(False)).alias("anchor"))


_ANSWERS = "WITH q AS (SELECT o_orderkey AS id, o_custkey % 40 AS batch FROM orders), a AS (SELECT id, batch, id * 2 AS said FROM q WHERE id % 9 <> 0 UNION ALL SELECT id, batch, id * 2 FROM q WHERE id % 11 = 0 AND id % 9 <> 0)"


def _asked(spark, sf):
    q = _orders(spark, sf).select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 40).alias("batch"))
    a = q.where("id % 9 <> 0").withColumn("said", F.col("id") * 2)
    return q, a.unionByName(a.where("id % 11 = 0"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN 'model_contract_invalid:missing' WHEN o_orderkey % 11 = 0 THEN 'model_contract_invalid:duplicate' END AS reason FROM orders")
def answers_by_row(spark, sf):
    """A missing or repeated answer touches its own row only."""
    q, a = _asked(spark, sf)
    good, review = stages.answered(q, a.select("id", "said"), "id")
    return good.select("id", F.lit(None).cast("string").alias("reason")).unionByName(review.select("id", "reason"))


@query(f"{_ANSWERS}, b AS (SELECT batch, bool_or(id % 9 = 0) AS m, bool_or(id % 11 = 0 AND id % 9 <> 0) AS d FROM q GROUP BY 1) SELECT id, CASE WHEN m OR d THEN 'model_contract_invalid:' || CASE WHEN m AND d THEN 'duplicate,missing' WHEN m THEN 'missing' ELSE 'duplicate' END END AS reason FROM q JOIN b USING (batch)")
def answers_by_batch(spark, sf):
    """Any wrong id sends its batch to review."""
    q, a = _asked(spark, sf)
    good, review = stages.answered(q, a, "id", "batch")
    return good.select("id", F.lit(None).cast("string").alias("reason")).unionByName(review.select("id", "reason"))


@query("WITH q AS (SELECT o_orderkey AS id, o_custkey % 40 AS b FROM orders), g AS (SELECT b, bool_or(id % 97 = 0) AS broken FROM q GROUP BY 1) SELECT id, NOT broken OR id % 2 = 0 AS good FROM q JOIN g USING (b)")
def recovered_answers(spark, sf):
    """Rows of whole batches, and rows whose own answer, asked for alone, holds."""
    q = _orders(spark, sf).select(_key("o_orderkey").alias("id"), F.concat(F.lit("b"), (F.col("o_custkey") % 40).cast("string")).alias("batch"))
    a = q.where(F.col("id").cast("long") % 97 != 0).unionByName(q.where(F.col("id").cast("long") % 2 == 0).withColumn("batch", F.col("id"))).withColumn("said", F.lit(1))
    good, lost = stages.recovered(q, a, "id", "batch")
    return good.select(F.col("id").cast("long").alias("id"), F.lit(True).alias("good")).unionByName(lost.select(F.col("id").cast("long").alias("id"), F.lit(False).alias("good")))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 4 = 0)")
def organizations_to_research(spark, sf):
    """Organizations without a person who has a title and wasn't inferred."""
    people = _orders(spark, sf).select(F.col("o_custkey").alias("organization_id"), F.when(F.col("o_orderkey") % 2 == 0, "Owner").otherwise("").alias("title"), (F.col("o_orderkey") % 4 == 2).alias("inferred_identity"))
    return stages.to_research(_customers(spark, sf).select(F.col("c_custkey").alias("organization_id")), people).select(F.col("organization_id").alias("c_custkey"))


@query("SELECT c_custkey, (['', 'points_out_of_range', 'missing', 'evidence_unknown', 'repeated'])[(c_custkey % 5) + 1] AS problems FROM customer")
def judge_problems(spark, sf):
    """What is wrong with each criterion's judgment."""
    c, k = _customers(spark, sf), F.col("c_custkey") % 5
    id = _key("c_custkey").alias("criterion_id")
    rows = c.where(k != 2).select(id, F.when(k == 1, 9).otherwise(3).alias("points"), F.when(k == 3, F.array(F.lit("e9"))).otherwise(F.array(F.lit("e1"))).alias("evidence"))
    rows = rows.unionByName(c.where(k == 4).select(id, F.lit(3).alias("points"), F.array(F.lit("e1")).alias("evidence")))
    out = stages.judge_problems(c.select(id, F.lit(5).alias("maximum")), rows, c.select(id, F.lit("e1").alias("evidence_id")))
    return out.select(F.col("criterion_id").cast("long").alias("c_custkey"), F.array_join("problems", ",").alias("problems"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 'late' WHEN c_custkey % 2 = 0 THEN 'early' ELSE c_mktsegment END AS v, CASE WHEN c_custkey % 3 = 0 THEN 'w' || c_custkey END AS extra FROM customer")
def layered_rows(spark, sf):
    """X11: each column's last value that isn't empty among the layers."""
    c = _customers(spark, sf)
    one = c.where("c_custkey % 2 = 0").select("c_custkey", F.lit("early").alias("v"))
    two = c.where("c_custkey % 3 = 0").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "late").otherwise("").alias("v"), F.concat(F.lit("w"), _key("c_custkey")).alias("extra"))
    return stages.prefer_filled(c.select("c_custkey", F.col("c_mktsegment").alias("v")), one, two, keys=["c_custkey"])


@query("WITH m AS (SELECT o_orderkey AS link, min(o_orderkey) OVER (PARTITION BY o_custkey) AS k, o_orderpriority AS n FROM orders) SELECT k AS link, coalesce(string_agg(DISTINCT n, '; ' ORDER BY n) FILTER (WHERE link <> k), '') AS aka FROM m GROUP BY k")
def merged_names(spark, sf):
    """One row for each kept link with the other names of its group."""
    o = _orders(spark, sf)
    kept = o.join(o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("keep_link")), "o_custkey").where("o_orderkey <> keep_link").select(F.col("o_orderkey").alias("link"), "keep_link")
    return stages.dedup_by_map(o.select(F.col("o_orderkey").alias("link"), F.col("o_orderpriority").alias("business_name")), kept).select("link", "aka")


@query("SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'new ' || c_nationkey WHEN c_nationkey = 1 THEN NULL ELSE c_mktsegment END AS line FROM customer")
def revised_lines(spark, sf):
    """A company's revised columns, null included, in its rows; the others as they were."""
    lines = table(spark, sf, "nation").where("n_nationkey % 2 = 0 or n_nationkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") != 1, F.concat(F.lit("new "), _key("n_nationkey"))).alias("line"))
    return stages.revised_lines(_customers(spark, sf).select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("line")), lines, "c_nationkey", ["line"]).select("c_custkey", "line")


@query("SELECT o_custkey AS company, o_orderstatus AS status, min(o_orderkey) AS lead_event_id FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2")
def sync_outbox(spark, sf):
    """One job for each content that isn't known; the run isn't part of it."""
    o = _orders(spark, sf).select(F.col("o_custkey").alias("company"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("source_payload"))
    events = o.groupBy("company", "status").agg(F.min("source_payload").alias("lead_event_id")).withColumn("run_id", F.lit("r1"))
    again = events.withColumn("run_id", F.lit("r2"))
    known = stages.outbox(events.where("status = 'P'"), spark.range(0).select(F.lit("").alias("dedupe_key")))
    return stages.outbox(events.unionByName(again), known).select("company", "status", "lead_event_id")


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'ignore' WHEN 1 THEN 'enroll' WHEN 2 THEN 'suppress' ELSE 'hold' END AS action FROM customer")
def verified_actions(spark, sf):
    """Enroll, suppress or hold; a mailbox that has changed since is ignored."""
    c, k = _customers(spark, sf), F.col("c_custkey") % 4
    mail = F.concat(F.lit("P"), _key("c_custkey"), F.lit("@x"))
    checks = c.select(F.col("c_custkey").alias("contact_id"), mail.alias("email"), F.when(k == 2, "invalid").when(k == 3, "unknown").otherwise("valid").alias("status"))
    now = c.select(F.col("c_custkey").alias("contact_id"), F.when(k == 0, F.lit("other@x")).otherwise(F.lower(mail)).alias("email"))
    return stages.after_verification(checks, now).select(F.col("contact_id").alias("c_custkey"), "action")


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'step_delays_invalid' ELSE 'step_indexes_invalid,step_delays_invalid' END AS errors FROM customer")
def campaign_steps(spark, sf):
    """Delays 0, 3, 4, 7 and indexes without a gap."""
    k = F.col("c_custkey") % 3
    step = lambda i, d: F.struct(F.lit(i).alias("step"), F.lit(d).alias("delay_days"))
    good, late, gap = (F.array(*[step(i, d) for i, d in s]) for s in ([(0, 0), (1, 3), (2, 4), (3, 7)], [(0, 0), (1, 3), (2, 5), (3, 7)], [(0, 0), (2, 4)]))
    rows = _customers(spark, sf).select(F.col("c_custkey").alias("campaign_id"), F.inline(F.when(k == 0, good).when(k == 1, late).otherwise(gap)))
    return stages.campaign_errors(rows).select(F.col("campaign_id").alias("c_custkey"), F.array_join("errors", ",").alias("errors"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Mesa' WHEN 1 THEN 'Yuma' ELSE 'unknown' END AS location, 2 AS urls FROM customer")
def projected_companies(spark, sf):
    """The slot's place, else the first known, else unknown; urls once each."""
    k, none = F.col("c_custkey") % 3, F.array().cast("array<string>")
    rows = _customers(spark, sf).select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("canonical_name"), F.create_map(F.lit("location"), F.when(k == 0, "Mesa").otherwise("")).alias("slots"), F.when(k == 1, F.array(F.lit("Yuma"))).otherwise(none).alias("locations"), F.array(F.lit("u1")).alias("why_sources"), F.array(F.lit("u1"), F.lit("u2")).alias("source_urls"))
    return stages.company_organizations(rows).select(F.col("organization_id").alias("c_custkey"), "location", F.size("urls").alias("urls"))


@query("WITH m AS (SELECT c_custkey % 50 AS p, arg_max(c_custkey, (c_nationkey < 5, c_custkey)) AS id FROM customer GROUP BY 1), e AS (SELECT c_custkey % 70 AS p, arg_max(c_custkey, (c_nationkey < 5, c_custkey)) AS id FROM customer GROUP BY 1) SELECT o_orderkey, coalesce(m.id, e.id) AS mapping_id FROM orders LEFT JOIN m ON m.p = o_custkey % 60 LEFT JOIN e ON e.p = o_custkey % 80")
def event_mappings(spark, sf):
    """By prospect, else by mailbox; those of a campaign first, then the newest."""
    c = _customers(spark, sf)
    maps = c.select(F.col("c_custkey").alias("mapping_id"), F.concat(F.lit("P"), (F.col("c_custkey") % 50).cast("string")).alias("prospect_id"), F.lit("").alias("route_key"), F.concat(F.lit("m"), (F.col("c_custkey") % 70).cast("string")).alias("email"), F.when(F.col("c_nationkey") < 5, "c").alias("campaign_id"), F.col("c_custkey").alias("updated_at"))
    events = _orders(spark, sf).select("o_orderkey", F.concat(F.lit("p"), (F.col("o_custkey") % 60).cast("string")).alias("prospect_id"), F.lit("r").alias("route_key"), F.concat(F.lit("M"), (F.col("o_custkey") % 80).cast("string")).alias("email"))
    return stages.lookup_mapping(events, maps).select("o_orderkey", "mapping_id")


@query("SELECT o_orderkey AS lead_id, 1.0 / 3 AS score FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= '1996-12-02'")
def recent_similar(spark, sf):
    """Recent leads whose title is similar enough to one."""
    title = F.when(F.col("o_orderpriority") == "1-URGENT", "warehouse mesa").otherwise("office yuma")
    leads = _orders(spark, sf).select(F.col("o_orderkey").alias("lead_id"), title.alias("title"), F.col("o_orderdate").cast("timestamp").alias("added"))
    return similarity.recent_candidates(leads, F.lit("warehouse tempe"), F.lit("1997-01-01").cast("timestamp"), 30, 0.3).select("lead_id", F.col("score").cast("double").alias("score"))


_REPEATS = """WITH e AS (SELECT o_custkey AS c, lpad(o_orderkey::VARCHAR, 9, '0') AS id, o_orderkey % 7 AS u, o_orderstatus = 'F' AS old FROM orders),
p AS (SELECT c, u, min(id) FILTER (WHERE old) AS h, min(id) FILTER (WHERE NOT old) AS n FROM e GROUP BY 1, 2)
SELECT e.c::VARCHAR AS company_key, e.id AS lead_event_id, coalesce(h, nullif(n, e.id)) AS duplicate_of FROM e JOIN p USING (c, u) WHERE NOT e.old"""


def _shaped(spark, sf, day):
    o = _orders(spark, sf)
    return o.select("o_orderstatus", _key("o_custkey").alias("company_key"), F.lpad(_key("o_orderkey"), 9, "0").alias("lead_event_id"), F.lit("sale").alias("event"), F.lit("Mesa").alias("location"), day.alias("date_posted"), F.concat(F.lit("u"), (F.col("o_orderkey") % 7).cast("string")).alias("canonical_url"))


@query(_REPEATS)
def repeated_events(spark, sf):
    """Events whose url the company's history, or an event before it, has."""
    rows = _shaped(spark, sf, F.lit(None).cast("date"))
    out = similarity.cross_run_duplicates(rows.where("o_orderstatus <> 'F'"), rows.where("o_orderstatus = 'F'"))
    return out.select("company_key", "lead_event_id", "duplicate_of")


@query("""WITH RECURSIVE o AS (SELECT o_custkey AS c, lpad(o_orderkey::VARCHAR, 9, '0') AS id, o_orderdate::DATE AS d, o_orderstatus = 'F' AS old FROM orders),
f AS (SELECT e.c, e.id, arg_min(h.id, (h.d, h.id)) AS first FROM o e JOIN o h ON h.old AND h.c = e.c AND abs(e.d - h.d) <= 21 WHERE NOT e.old GROUP BY ALL),
e AS (SELECT o.c, o.id, o.d, f.first, row_number() OVER (PARTITION BY o.c ORDER BY o.d, o.id) AS n FROM o LEFT JOIN f ON f.c = o.c AND f.id = o.id WHERE NOT o.old),
w AS (SELECT c, id, n, first AS dup, CASE WHEN first IS NULL THEN id END AS kept, CASE WHEN first IS NULL THEN d END AS kept_on FROM e WHERE n = 1
UNION ALL SELECT e.c, e.id, e.n, coalesce(e.first, CASE WHEN e.d - w.kept_on <= 21 THEN w.kept END),
  CASE WHEN e.first IS NULL AND coalesce(e.d - w.kept_on > 21, true) THEN e.id ELSE w.kept END,
  CASE WHEN e.first IS NULL AND coalesce(e.d - w.kept_on > 21, true) THEN e.d ELSE w.kept_on END
  FROM w JOIN e ON e.c = w.c AND e.n = w.n + 1)
SELECT c::VARCHAR AS company_key, id AS lead_event_id, dup AS duplicate_of FROM w""")
def repeated_within_weeks(spark, sf):
    """Events that say the same number within three weeks of the company's history or of one that holds; a blocked one blocks nothing."""
    rows = _shaped(spark, sf, F.col("o_orderdate").cast("date")).withColumn("canonical_url", F.lit("")).withColumn("event", F.lit("250 homes"))
    return similarity.cross_run_duplicates(rows.where("o_orderstatus <> 'F'"), rows.where("o_orderstatus = 'F'")).select("company_key", "lead_event_id", "duplicate_of")


@query("SELECT o_orderkey AS lead_id FROM orders JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders GROUP BY 1) USING (o_custkey) WHERE o_orderkey <> k AND o_custkey % 3 <> 0")
def safe_deletes(spark, sf):
    """Losers whose keeper's merge succeeded."""
    o = _orders(spark, sf)
    plan = o.join(o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("keeper_id")), "o_custkey").select(F.col("o_orderkey").alias("lead_id"), "keeper_id", "o_custkey", (F.col("o_orderkey") == F.col("keeper_id")).alias("is_keeper"))
    return stages.safe_deletes(plan, plan.where("is_keeper and o_custkey % 3 <> 0").select("keeper_id")).select("lead_id")
