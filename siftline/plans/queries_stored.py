"""What is kept from one run to the next: snapshots, labels, accepted hooks, saved pages, and the history of events."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from siftline.functions import text
from siftline.operators import fold, history, identity, stages
from siftline.operators.order import shared_folder
from siftline.operators.snapshot import Snapshot
from siftline.plans import ledger
from siftline.plans.catalog import query
from siftline.plans.domain import log, pages
from siftline.plans.queries_fields import _plain
from siftline.session import table
from siftline.sources.paged import SavedPages
from siftline.streaming import webhooks

_SEQ = "ts, event_id"


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/siftline-{name}-{uuid.uuid4().hex}"


_RULES = {"event_type": fold.LAST, "value": fold.LAST, "bought": fold.COALESCE, "kind": fold.NON_EMPTY, "most": fold.MAX, "created": fold.FIRST}


def _stored(spark, sf) -> Snapshot:
    """The log of events in three batches, each with rows of all times, so most come later than newer ones."""
    kind = F.col("event_type")
    rows = log(spark, sf).select("user_id", "seq", "event_id", "event_type", "value", F.when(kind == "purchase", F.col("event_id")).alias("bought"), F.when(kind == "view", "").otherwise(kind).alias("kind"), (F.col("event_id") % 17).alias("most"), F.col("event_id").alias("created"))
    store = Snapshot(spark, _folder(spark, "upserts"), ["user_id"], "seq", _RULES, buckets=16, most_files=2)
    for batch in range(3):
        store.add(rows.where(F.col("event_id") % 3 == batch), batch)
    return store


def _as_of(where: str) -> str:
    return f"""SELECT user_id, arg_max(event_type, ({_SEQ})) AS event_type, round(arg_max(value, ({_SEQ})), 6) AS value, arg_max(event_id, ({_SEQ})) FILTER (WHERE event_type = 'purchase') AS bought,
arg_max(event_type, ({_SEQ})) FILTER (WHERE event_type <> 'view') AS kind, max(event_id % 17)::BIGINT AS most, arg_min(event_id, ({_SEQ})) AS created FROM events WHERE {where} GROUP BY user_id"""


@query(_as_of("true"))
def stored_upserts(spark, sf):
    """A stored snapshot after three batches, whatever order their rows came in."""
    return _stored(spark, sf).read().withColumn("value", F.round("value", 6))


@query(_as_of("event_id % 3 <> 2"))
def snapshot_as_of(spark, sf):
    """The same snapshot as of its second version."""
    return _stored(spark, sf).read(2).withColumn("value", F.round("value", 6))


@query("SELECT c_custkey, c_custkey // 16 * 16 AS least FROM customer")
def aligned_increments(spark, sf):
    """Companies of three increments; names join four of them, domains join four such groups."""
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(k.alias("company_id"), F.when(k % 4 == 0, F.format_string("d%d.com", F.floor(k / 16))).otherwise("").alias("domain"), F.array(F.format_string("Name %d", F.floor(k / 4))).alias("names"))
    labels = keys = None
    for part in range(3):
        labels, keys, _ = identity.align_increment(rows.where(F.col("company_id") % 3 == part), labels, keys)
        folder = _folder(spark, "labels")
        labels.write.parquet(f"{folder}/labels")
        keys.write.parquet(f"{folder}/keys")
        labels, keys = spark.read.parquet(f"{folder}/labels"), spark.read.parquet(f"{folder}/keys")
    least = labels.groupBy("label").agg(F.min("company_id").alias("least"))
    return labels.join(least, "label").select(F.col("company_id").alias("c_custkey"), "least")


@query("""WITH x AS (SELECT max(event_id) / 3 AS t FROM events), b AS (SELECT events.*, CASE WHEN event_id <= t THEN 0 WHEN event_id <= 2 * t THEN 1 ELSE 2 END AS batch FROM events, x), f AS (SELECT event_type AS provider, user_id::VARCHAR AS provider_event_id, min(batch) AS batch FROM b WHERE event_id % 7 <> 0 GROUP BY ALL)
SELECT f.provider, f.provider_event_id, f.batch, min(b.event_id) AS event_id FROM f JOIN b ON b.event_type = f.provider AND b.user_id::VARCHAR = f.provider_event_id AND b.batch = f.batch WHERE event_id % 7 <> 0 GROUP BY ALL""")
def accepted_for_good(spark, sf):
    """Hooks of three batches, each accepted once however late its copies come; every seventh isn't signed."""
    e = log(spark, sf)
    third = F.lit(e.agg(F.max("event_id")).first()[0]) / 3
    part = F.when(F.col("event_id") <= third, 0).when(F.col("event_id") <= 2 * third, 1).otherwise(2)
    hooks = e.select(part.alias("part"), F.col("event_type").alias("provider"), F.col("user_id").cast("string").alias("provider_event_id"), F.lit("reply").alias("event_type"), F.format_string("%012d", "event_id").alias("payload"), F.col("ts").cast("timestamp").alias("received_at"), (F.col("event_id") % 7 != 0).alias("signature_valid"))
    folder = _folder(spark, "hooks")
    for batch in (0, 1, 1, 2):  # the second comes again
        webhooks.accept_batch(hooks.where(F.col("part") == batch).drop("part"), batch, folder, 8)
    got = spark.read.parquet(f"{folder}/accepted")
    return got.select("provider", "provider_event_id", F.col("batch").cast("int").alias("batch"), F.col("payload").cast("long").alias("event_id"))


@query("""WITH r AS (SELECT event_type AS "group", event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS n FROM events)
SELECT "group", (n // 200 + 1)::INT AS page, event_id FROM r WHERE "group" <> 'error' OR n < 250""")
def saved_pages(spark, sf):
    """Pages of 200 saved records read back through the data source; a short one in between ends its group."""
    n = F.row_number().over(Window.partitionBy("event_type").orderBy("event_id")) - 1
    rows = log(spark, sf).select(F.col("event_type").alias("group"), n.alias("n"), F.col("event_id").cast("string").alias("value"))
    cut = (F.col("group") == "error") & F.col("n").between(250, 399)  # the second page of errors keeps fifty
    folder = _folder(spark, "pages")
    rows.where(~cut).select("group", F.floor(F.col("n") / 200 + 1).cast("int").alias("page"), "value").repartition("group", "page").write.partitionBy("group", "page").text(folder)
    spark.dataSource.register(SavedPages)
    got = spark.read.format("saved_pages").options(page_size=200, most_pages=10**6).load(folder)
    return got.select("group", "page", F.col("record").cast("long").alias("event_id"))


@query("""SELECT 'qualify' AS stage, unnest(['rows', 'open', 'value', 'companies_seen']) AS counter, unnest([count(*), count(*) FILTER (WHERE o_orderstatus = 'O'), sum(floor(o_totalprice)::BIGINT)::BIGINT, max(o_custkey)]) AS value FROM orders""")
def observed_counters(spark, sf):
    """A stage's counters as the tasks that wrote it saw them."""
    rows = table(spark, sf, "orders")
    counters = {"rows": F.count(F.lit(1)), "open": F.count_if(F.col("o_orderstatus") == "O"), "value": F.sum(F.floor("o_totalprice")), "companies_seen": F.max("o_custkey")}
    return ledger.write_counted(rows, _folder(spark, "counted"), "qualify", counters)


_CORPUS = """p AS (SELECT page_id, url, html, page_id % 7 AS source_id, CASE WHEN page_id % 5 <> 4 THEN date '2024-03-01' + (page_id % 40)::INT END AS day, page_id % 6 AS kind FROM pages),
j AS (SELECT *, CASE WHEN day IS NULL THEN 'undated' WHEN day NOT BETWEEN date '2024-03-05' AND date '2024-03-31' THEN 'outside' WHEN kind = 1 THEN 'missing' WHEN kind = 2 THEN 'mismatch' ELSE 'taken' END AS fate FROM p WHERE source_id <> 6)"""


def _corpus(spark, sf):
    """Pages as a saved run: of six, one lost its file, one's file has another date, one's file changed but says url and date, three are as they were."""
    k = F.col("page_id")
    day = F.when(k % 5 != 4, F.date_add(F.lit("2024-03-01").cast("date"), (k % 40).cast("int")))
    p = pages(spark, sf).select("page_id", "url", "html", (k % 7).alias("source_id"), day.alias("day"), (k % 6).alias("kind"))
    rows = p.select(F.col("page_id").alias("candidate_id"), "source_id", F.col("url").alias("canonical_url"), F.col("day").cast("timestamp").alias("published_at"), F.when(k % 2 == 0, "archive-search").otherwise("index").alias("provider"), F.concat(F.lit("f"), k.cast("string")).alias("raw_artifact_path"), F.when(k % 6 == 5, "").otherwise(F.sha2(F.col("html").cast("binary"), 256)).alias("raw_artifact_hash"), F.create_map(F.lit("bulk_qualified"), F.lit("x"), F.lit("title"), F.col("url")).alias("metadata"))
    stated = lambda d: F.concat(F.lit("<meta name='date' content='"), d.cast("string"), F.lit("'><a href='"), F.regexp_replace("url", "^https://", "http://"), F.lit("'>"))
    content = F.when(F.col("kind") == 2, stated(F.date_add("day", 1))).when(F.col("kind") == 3, stated(F.col("day"))).otherwise(F.col("html"))
    files = p.where("kind <> 1").select(F.concat(F.lit("f"), k.cast("string")).alias("path"), F.coalesce(content, F.lit("")).cast("binary").alias("content"))
    sources = spark.range(6).select(F.col("id").alias("source_id"))
    return stages.reused_corpus(rows, files, sources, "2024-03-05", "2024-03-31", "r2", "r1", ("bulk_qualified",))


@query(f"WITH {_CORPUS} SELECT page_id AS candidate_id, 'r2' AS run_id, (kind = 3)::VARCHAR AS revalidated, 3 AS kept FROM j WHERE fate = 'taken'")
def reused_corpus(spark, sf):
    """The candidates of a saved run that still are what they were, by hash or by page and date."""
    good = _corpus(spark, sf)[0]
    return good.select("candidate_id", "run_id", F.col("metadata")["corpus_hash_revalidated"].alias("revalidated"), F.size("metadata").alias("kept"))


@query(f"WITH {_CORPUS} SELECT source_id, count(*) FILTER (WHERE fate = 'taken') AS candidates, count(*) FILTER (WHERE fate = 'taken' AND page_id % 2 = 0) AS fallback_candidates, count(*) FILTER (WHERE fate = 'undated') AS omitted_undated, count(*) FILTER (WHERE fate = 'outside') AS omitted_outside FROM j GROUP BY source_id")
def corpus_coverage(spark, sf):
    """Per source what was taken over and what was left out."""
    return _corpus(spark, sf)[1]


@query(f"WITH {_CORPUS} SELECT page_id AS candidate_id, fate AS problem FROM j WHERE fate IN ('missing', 'mismatch')")
def corpus_problems(spark, sf):
    """Candidates whose file is gone, or is another page's or day's."""
    return _corpus(spark, sf)[2]


_SAVES = "s AS (SELECT user_id AS event, event_id, strftime(ts, '%Y-%m-%d') AS run, event_type, value FROM events)"


@query(f"""WITH {_SAVES}, e AS (SELECT event, run, max(event_id) AS last FROM s GROUP BY ALL), f AS (SELECT event, event_type, min(event_id) AS first FROM s GROUP BY ALL)
SELECT e.event AS user_id, e.run, string_agg(f.event_type, ',' ORDER BY f.first) AS supporters FROM e JOIN f ON f.event = e.event AND f.first <= e.last GROUP BY ALL""")
def event_supporters(spark, sf):
    """Q16: the kinds of a user's events so far, as of the end of each day, in order of their first."""
    e = log(spark, sf).select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("run"), "event_id", F.array("event_type", "event_type", F.lit(None).cast("string")).alias("supporters"))
    return history.supporters_as_of(e, "user_id", "run", "event_id", "supporters").select("user_id", "run", F.array_join("supporters", ",").alias("supporters"))


@query(f"""WITH {_SAVES}, e AS (SELECT event, run, max(event_id) AS last FROM s GROUP BY ALL), f AS (SELECT event, event_type, min(event_id) AS first FROM s GROUP BY ALL),
v AS (SELECT e.event, e.run, f.event_type, f.first, max(s.event_id) AS said FROM e JOIN f ON f.event = e.event AND f.first <= e.last JOIN s ON s.event = e.event AND s.event_type = f.event_type AND s.event_id <= e.last GROUP BY ALL)
SELECT event AS user_id, run, string_agg(event_type || '=' || said, ',' ORDER BY first) AS evidence FROM v GROUP BY ALL""")
def event_evidence(spark, sf):
    """Q16: a user's last event of each kind as of the end of each day, in order of the kinds' first."""
    piece = F.struct(F.col("event_type").alias("url"), F.lit("x").alias("supports"), F.col("event_id").alias("said"))
    e = log(spark, sf).select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("run"), "event_id", F.array(piece).alias("evidence"))
    out = history.evidence_as_of(e, "user_id", "run", "event_id", "evidence", ["url", "supports"])
    return out.select("user_id", "run", F.array_join(F.transform("evidence", lambda p: F.concat_ws("=", p["url"], p["said"].cast("string"))), ",").alias("evidence"))


_OUT = "|".join([r"(?is)<!--.*?-->", *(rf"<{t}\b.*?</{t}\s*>" for t in text.NO_ARTICLE), *(rf"<{t}\b[^>]*\b(?:class|id)\s*=\s*[\"'']?[^\"''>]*\b(?:{'|'.join(text.BESIDE)})\b[^>]*>.*?</{t}\s*>" for t in ("div", "section", "p", "ul", "span"))])


@query(rf"""WITH h AS (SELECT page_id, regexp_split_to_array(regexp_replace(coalesce(html, ''), '{_OUT}', ' ', 'g'), '(?i)</?(?:{'|'.join(text.BLOCKS)})\b[^>]*>') AS parts FROM pages),
b AS (SELECT page_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS i FROM h),
t AS (SELECT page_id, i, {_plain('raw')} AS said, coalesce(list_sum(list_transform(regexp_extract_all(raw, '(?is)<a\b[^>]*>(.*?)</a\s*>', 1), lambda a: length({_plain('a')}))), 0) AS linked FROM b),
f AS (SELECT page_id, said, row_number() OVER (PARTITION BY page_id ORDER BY i) AS k, length(said) - 2 * linked - {text.BLOCK_COST} AS w FROM t WHERE said <> ''),
s AS (SELECT *, sum(w) OVER (PARTITION BY page_id ORDER BY k) AS upto FROM f),
m AS (SELECT *, least(0, coalesce(min(upto) OVER (PARTITION BY page_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM s),
e AS (SELECT page_id, k AS last, low FROM m WHERE upto > low QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY upto - low DESC, k) = 1),
a AS (SELECT e.page_id, e.last, CASE WHEN e.low = 0 THEN 0 ELSE min(s.k) FILTER (WHERE s.upto = e.low) END AS before FROM e JOIN s ON s.page_id = e.page_id AND s.k < e.last + 1 GROUP BY e.page_id, e.last, e.low),
j AS (SELECT a.page_id, string_agg(f.said, ' ' ORDER BY f.k) AS said FROM a JOIN f ON f.page_id = a.page_id AND f.k > a.before AND f.k <= a.last GROUP BY a.page_id)
SELECT p.page_id, CASE WHEN length(j.said) >= 200 THEN left(j.said, 8000) END AS main FROM pages p LEFT JOIN j USING (page_id)""")
def main_texts(spark, sf):
    """P20: the article of each page by the weights of its blocks."""
    return pages(spark, sf).select("page_id", text.main_text("html").alias("main"))
