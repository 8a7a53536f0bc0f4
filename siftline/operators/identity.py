"""Which company a name or a domain belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.text import normalize_text, text_or_empty
from siftline.operators.graph import connected
from siftline.operators.order import cut


def resolve_companies(requests: DataFrame, companies: DataFrame) -> DataFrame:
    """Per request the company that its domain or any of its names matches, or null, and whether it is ambiguous.

    requests: request_id, domain, names; companies: company_id, domain, names. Names meet in normal form.
    """
    def keys(df: DataFrame, id: str) -> DataFrame:
        names = df.select(id, F.explode(F.transform("names", lambda n: F.concat(F.lit("n:"), normalize_text(n)))).alias("key"))
        return names.unionByName(df.select(id, F.concat(F.lit("d:"), F.lower(text_or_empty("domain"))).alias("key"))).where(F.length("key") > 2).distinct()

    matches = keys(requests, "request_id").join(keys(companies, "company_id"), "key").groupBy("request_id").agg(F.count_distinct("company_id").alias("n"), F.min("company_id").alias("found"))
    out = requests.join(matches, "request_id", "left")
    return out.select(*requests.columns, F.when(F.col("n") == 1, F.col("found")).alias("company_id"), (F.coalesce("n", F.lit(0)) > 1).alias("ambiguous"))


def company_keys(companies: DataFrame) -> DataFrame:
    """company_id, key: a company's names in normal form and its domain, each once."""
    names = companies.select("company_id", F.explode(F.transform("names", lambda n: F.concat(F.lit("n:"), normalize_text(n)))).alias("key"))
    return names.unionByName(companies.select("company_id", F.concat(F.lit("d:"), F.lower(text_or_empty("domain"))).alias("key"))).where(F.length("key") > 2).distinct()


def align_increment(new: DataFrame, labels: DataFrame | None = None, keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """J12, step by step: (labels, keys, merged) after new companies. new: company_id, domain, names.

    labels: company_id, label; keys: key, label; both as the step before left them, None at the first. A company whose keys
    are known has their label. Companies that only meet each other get the smallest of their ids. Where a new company
    joins several labels, the smallest of these stays and ``merged`` (label, into) says where the others went; no other
    label ever changes. New rows' keys are contracted onto the labels before anything is connected, so the graph
    has new companies and the labels that they touch; a key of very many companies costs one edge each. Of what
    is stored, keys are looked up and rows of merged labels renamed; no component is built anew. A company that comes
    again adds its keys.
    """
    named = cut(company_keys(new))
    company, label = (lambda c: F.struct(F.lit(1).alias("kind"), F.col(c).alias("id"))), (lambda c: F.struct(F.lit(0).alias("kind"), F.col(c).alias("id")))
    kind = new.schema["company_id"].dataType
    if labels is None or keys is None:
        none = new.sparkSession.createDataFrame([], "company_id string, key string, label string")
        labels, keys = none.select(F.col("company_id").cast(kind).alias("company_id"), F.col("label").cast(kind).alias("label")), none.select("key", F.col("label").cast(kind).alias("label"))
    known = named.join(keys, "key", "left").groupBy("company_id", "key").agg(F.min("label").alias("label"))
    known = cut(known)
    # Of companies that share a new key, each is tied to the smallest; of those with a known key, each to its label.
    least = known.where("label is null").groupBy("key").agg(F.min("company_id").alias("least"))
    by_key = known.where("label is null").select("company_id", "key").join(least, "key").select(company("company_id").alias("a"), company("least").alias("b"))
    by_label = known.where("label is not null").select(company("company_id").alias("a"), label("label").alias("b"))
    again = new.select("company_id").distinct().join(labels, "company_id").select(company("company_id").alias("a"), label("label").alias("b"))
    edges = cut(by_key.unionByName(by_label).unionByName(again).distinct())
    nodes = new.select(company("company_id").alias("node")).unionByName(edges.where("b.kind = 0").select(F.col("b").alias("node")))
    # Labels come before companies and smaller ids first, so a component is named by the label that stays, if it has one.
    found = cut(connected(nodes, edges).select("node", F.col("component.id").alias("into")))
    merged = found.where("node.kind = 0").select(F.col("node.id").alias("label"), "into").where("label <> into")
    fresh = found.where("node.kind = 1").select(F.col("node.id").alias("company_id"), F.col("into").alias("label"))
    renamed = lambda df: df.join(merged, "label", "left").withColumn("label", F.coalesce("into", "label")).drop("into")
    all_labels = renamed(labels.join(fresh, "company_id", "left_anti")).select("company_id", "label").unionByName(fresh)
    new_keys = known.where("label is null").select("company_id", "key").join(fresh, "company_id").groupBy("key").agg(F.min("label").alias("label"))
    return all_labels, renamed(keys).select("key", "label").unionByName(new_keys), merged


def align_companies(current: DataFrame, existing: DataFrame) -> DataFrame:
    """company_id and the id that it is known by: that of an existing company it is joined to by a domain or an alias,
    directly or through other current ones, else the smallest of the current ones joined with it.

    Both: company_id, domain, names. Companies meet through their shared keys, so a key that very many have gives each
    of them one edge, to the smallest of them.
    """
    both = current.withColumn("old", F.lit(False)).unionByName(existing.withColumn("old", F.lit(True)))
    keyed = company_keys(both)
    least = keyed.groupBy("key").agg(F.min("company_id").alias("least"))
    edges = keyed.join(least, "key").select(F.col("company_id").alias("a"), F.col("least").alias("b"))
    groups = connected(both.select(F.col("company_id").alias("node")), edges)
    known = groups.join(existing.select(F.col("company_id").alias("node")), "node").groupBy("component").agg(F.min("node").alias("known"), F.count(F.lit(1)).alias("n_known"))
    out = groups.join(current.select(F.col("company_id").alias("node")), "node", "left_semi").join(known, "component", "left")
    return out.select(F.col("node").alias("company_id"), F.coalesce("known", "component").alias("aligned_id"), (F.coalesce("n_known", F.lit(0)) > 1).alias("ambiguous"))
