"""The opN_ queries: thin digests of the operators beside this module, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import byte_bpe as op10
from siftline.llm import exact_dedup as op9
from siftline.llm import fill_in_middle as op13
from siftline.llm import fst_tokens as op6
from siftline.llm import language_id as op1
from siftline.llm import line_dedup as op8
from siftline.llm import media_columns as op4
from siftline.llm import packing as op2
from siftline.llm import quality as op7
from siftline.llm import simhash as op3
from siftline.llm import suffix_dedup as op11
from siftline.llm import url_filters as op5
from siftline.llm import vector_codes as op12
from siftline.llm.common import is_held_out

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where this machine and the executors have the vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = is_held_out(F.col("doc_id"), 4, 2)
    out = op1.predict(docs, op1.learn(docs.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op2.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step_group")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op3.near_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op4.probe(op4.store(table(spark, sf_dir, "documents")), with_payload=True)
    track = F.col("tracks")[0]
    keys = track["keyframes"]
    ranges = F.array_join(F.transform(keys, lambda k: F.concat_ws("-", k["start"], k["end"])), ",")
    feature = F.concat_ws(";", "brand", track["handler"], track["codec"], track["duration_s"], track["n_samples"], F.size(keys), F.md5(ranges))
    return out.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
        track["codec"].alias("codec"),
        track["duration_s"].alias("duration_s"),
        keys.alias("keyframes"),
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.judge_urls(table(spark, sf_dir, "pages"), op5.rules_frame(spark, URL_RULES))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), limit=4096)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = is_held_out(F.col("doc_id"), 5, 0)
    out = op7.score(docs, op7.learn(docs, table(spark, sf_dir, "labels").where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op8.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.exact_dedup(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = op10.encode(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"), columns=("ids", "offsets", "decoded"), pattern=public_tokenizers.PATTERN)
    hashes = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("ids", "decoded", "offsets")]
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), *hashes)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op11.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = op12.compress(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "code", "error", F.col("label_error").cast("long").alias("label_error"), F.lit(op12.digest(books)).alias("codebooks_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op13.fill_in_middle(table(spark, sf_dir, "documents"), op13.seeded_draws(F.col("doc_id"), "7"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_simhash": op3_simhash,
    "op4_media_columns": op4_media_columns,
    "op5_url_filters": op5_url_filters,
    "op6_token_counts": op6_token_counts,
    "op7_quality": op7_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_fill_in_middle": op13_fill_in_middle,
}

def _vector_codes_sql() -> str:
    """Rounds are unrolled: entries e0, assignments s0, entries e1, ..., each a table of its own."""
    rounds = "".join(
        f"""
s{i} AS MATERIALIZED (
  SELECT id, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM (
    SELECT p.id, p.part, e.entry, sum((p.x - e.x) * (p.x - e.x))::HUGEINT AS far
    FROM p JOIN e{i} e ON e.part = p.part AND e.place = p.place GROUP BY p.id, p.part, e.entry) GROUP BY id, part),
e{i + 1} AS MATERIALIZED (
  SELECT e.part, e.entry, e.place, coalesce(n.x, e.x) AS x FROM e{i} e LEFT JOIN (
    SELECT p.part, s.entry, p.place, (sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
    FROM p JOIN s{i} s ON s.id = p.id AND s.part = p.part GROUP BY p.part, s.entry, p.place) n
  ON n.part = e.part AND n.entry = e.entry AND n.place = e.place),"""
        for i in range(3)
    )
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT id, (i - 1) // (len(embedding) // 16) AS part, (i - 1) % (len(embedding) // 16) AS place, floor(256 * embedding[i]::DOUBLE)::HUGEINT AS x
  FROM (SELECT id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM v)),
e0 AS MATERIALIZED (SELECT part, id - 1 AS entry, place, x FROM p WHERE id <= 64),{rounds}
r AS (SELECT v.vec_id, v.label, string_agg(format('{{:02x}}', s.entry), '' ORDER BY s.part) AS code, sum(s.far)::BIGINT AS error
      FROM v JOIN s2 s USING (id) GROUP BY v.id, v.vec_id, v.label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM e2) AS codebooks_sha256
FROM r
"""


ORACLE_SQL = {
    "op5_url_filters": r"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r(rule, h, q, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
)
SELECT u.page_id, u.host, u.path, arg_max(r.rule, length(r.rule)) AS rule, coalesce(arg_max(r.verdict, length(r.rule)), 'allow') AS verdict
FROM u LEFT JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.q)
GROUP BY u.page_id, u.host, u.path
""",
    "op8_line_dedup": r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM s),
k AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.*, o.owner IS NULL OR o.owner = k.doc_id AS stays FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE NOT stays)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM j GROUP BY doc_id
""",
    "op9_exact_dedup": r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
g AS (SELECT t, first(doc_id ORDER BY n DESC, doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g USING (t)
""",
    "op11_suffix_dedup": r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS MATERIALIZED (SELECT id, place, hash(substr(x, 2 * place + 1, 800)) AS h FROM (SELECT id, x, unnest(range(0, n - 399)) AS place FROM d WHERE n >= 400)),
m AS MATERIALIZED (SELECT id, place, x FROM (SELECT w.id, w.place, substr(d.x, 2 * w.place + 1, 800) AS x FROM w JOIN d USING (id)
                   WHERE w.h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)) QUALIFY count(*) OVER (PARTITION BY x) > 1),
s AS (SELECT id, place, place > coalesce(lag(place) OVER (PARTITION BY id ORDER BY place) + 400, -1) AS opens FROM m),
r AS (SELECT id, min(place) AS a, max(place) + 400 AS b FROM (SELECT id, place, sum(opens::INT) OVER (PARTITION BY id ORDER BY place) AS run FROM s) GROUP BY id, run),
k AS (SELECT id, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans FROM r GROUP BY id),
g AS (SELECT id, b AS a, lead(a) OVER (PARTITION BY id ORDER BY a) AS b FROM r UNION ALL SELECT id, 0, min(a) FROM r GROUP BY id),
t AS (SELECT g.id, string_agg(substr(d.x, 2 * g.a + 1, 2 * (coalesce(g.b, d.n) - g.a)), '' ORDER BY g.a) AS x FROM g JOIN d USING (id) GROUP BY g.id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans, sha256(unhex(coalesce(t.x, d.x))) AS kept_sha256
FROM d LEFT JOIN k USING (id) LEFT JOIN t USING (id)
""",
    "op12_vector_codes": _vector_codes_sql(),
    "op13_fill_in_middle": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units, len(regexp_extract_all(text, '[^\n]*\n|[^\n]+'))::BIGINT AS n FROM t),
h AS (SELECT *, ('0x' || substr(d, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(d, 9, 8))::BIGINT % (n + 1) AS b,
             ('0x' || substr(d, 25, 8))::BIGINT % 100 AS kind,
             text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || substr(d, 17, 8))::BIGINT % 100 >= 100 AS plain FROM u),
c AS (SELECT *, array_to_string(units[1:least(a, b)], '') AS p, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS m,
             array_to_string(units[greatest(a, b) + 1:], '') AS s, CASE WHEN plain THEN 'plain' WHEN kind < 50 THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n, form, CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
""",
}
