"""Tables of sources, contacts and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.functions.ids import stable_uuid
from siftline.functions.text import text_or_empty
from siftline.functions.urls import canonicalize_url, host
from siftline.operators.order import numbered


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns text, with ``_row`` for its order within the file."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    return raw.toDF(*[c.lstrip("﻿") for c in raw.columns]).withColumn("_row", F.monotonically_increasing_id())


def _either(df: DataFrame, *names: str):
    found = [F.nullif(F.btrim(F.col(f"`{c}`")), F.lit("")) for n in names for c in df.columns if c == n]
    return F.coalesce(*found, F.lit(""))


def curated_sources(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """source_id, name, url, domain; and the rows whose url isn't one. Rows without a url are left out.

    rows: ``Resource Name`` or ``name``, ``URL`` or ``url``.
    """
    url = _either(rows, "URL", "url")
    whole = F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("https://"), url))
    named = rows.where(url != "").select(_either(rows, "Resource Name", "name").alias("name"), whole.alias("given"), canonicalize_url(whole).alias("url"))
    good = named.where("url is not null").withColumn("domain", host("url"))
    return good.select(stable_uuid("source", "url").alias("source_id"), F.coalesce(F.nullif("name", F.lit("")), "domain").alias("name"), "url", "domain"), named.where("url is null").select("name", F.col("given").alias("url"), F.lit("invalid_url").alias("problem"))


def named_sources(rows: DataFrame, order: str = "_row") -> DataFrame:
    """Slug names, repeated ones numbered _2, _3 and so on in the file's order, beside the name and url.

    ``order`` numbers the file's rows; a nameless row is called source_ and its number from 1.
    """
    placed = numbered(rows, [order], "_at")
    slug = F.regexp_replace(F.regexp_replace(F.lower(_either(rows, "Resource Name", "name")), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    kept = placed.where(_either(rows, "URL", "url") != "").withColumn("base", F.when(slug == "", F.concat(F.lit("source_"), F.col("_at").cast("string"))).otherwise(slug))
    n = F.row_number().over(Window.partitionBy("base").orderBy("_at"))
    return kept.withColumn("_n", n).select(F.when(F.col("_n") == 1, F.col("base")).otherwise(F.concat_ws("_", "base", "_n")).alias("name"), F.coalesce(F.nullif(_either(rows, "Resource Name", "name"), F.lit("")), F.col("base")).alias("display_name"), _either(rows, "URL", "url").alias("endpoint"))


def contacts_csv(rows: DataFrame, run_id: str, order: str = "_row") -> tuple[DataFrame, DataFrame]:
    """Contact rows with is_primary (the first of each event in the file); rows of another run are violations."""
    good = rows.where(text_or_empty("run_id") == run_id)
    first = F.row_number().over(Window.partitionBy("lead_event_id").orderBy(order)) == 1
    return good.withColumn("is_primary", first), rows.where(text_or_empty("run_id") != run_id).withColumn("violation", F.lit("run_id_mismatch"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The rows of JSON lines by a schema, and the lines that don't fit it."""
    lines = spark.read.text(path)
    parsed = lines.select("value", F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    good = parsed.where("r is not null and r._bad is null").select("r.*").drop("_bad")
    return good, parsed.where("r is null or r._bad is not null").select("value").where(F.btrim("value") != "")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Path, sha256 and byte_count of every file below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_count"))


def pages_of(records: DataFrame, keys: list[str], order: list, most: int | None = None) -> DataFrame:
    """Provider records, the first of each key in order, at most ``most`` of each group if the frame has ``group``."""
    from siftline.operators.pick import cap_per_key, ranked

    capped = cap_per_key(records, ["group"], order, most) if most else records
    return ranked(capped, keys, order, "_n").where("_n = 1").drop("_n")


def robots_roots(robots: DataFrame) -> DataFrame:
    """Sitemap roots of each source: those its robots.txt names and the usual ones, without the given one.

    robots: source_id, site (scheme and host), body, explicit_url.
    """
    lines = F.split(text_or_empty("body"), r"\r?\n")
    named = F.transform(F.filter(lines, lambda x: F.regexp_like(x, F.lit(r"(?i)^\s*sitemap\s*:"))), lambda x: canonicalize_url(F.btrim(F.regexp_replace(x, r"(?i)^\s*sitemap\s*:", ""))))
    usual = F.array(*[F.concat("site", F.lit(p)) for p in ("/sitemap.xml", "/sitemap_index.xml", "/wp-sitemap.xml")])
    roots = F.array_except(F.array_union(F.array_compact(named), usual), F.array(canonicalize_url("explicit_url")))
    return robots.select("source_id", F.posexplode(roots).alias("pos", "url"))
