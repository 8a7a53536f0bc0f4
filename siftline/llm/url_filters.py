"""URL filters: a sort-merge range join of urls with host and path prefixes.

A host becomes its labels in reverse, each ended by a dot (``www.example.net`` -> ``net.example.www.``), so a rule
for a host and all its subdomains is one prefix, and a prefix is one interval of the sorted keys. Intervals of
prefixes nest or are apart, so a sweep over sorted keys needs a stack: a start pushes a rule, an end pops back to
the rule around it. Each boundary carries the top of the stack from there on, which makes the sweep a running
"last boundary so far"; what lies below the top is read off the rule's own chain of ancestors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.llm.common import ascii_lower, cut_lineage

_END = "FF"  # no UTF-8 text has this byte, so prefix + FF ends the prefix's interval


def url_parts(url: Column) -> tuple[Column, Column]:
    """host and path; both empty where url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse order, each ended by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _boundaries(prefixes: DataFrame) -> DataFrame:
    """(at, top): from key ``at`` on, ``top`` is the innermost prefix. prefixes: distinct binary ``key``."""
    n = F.octet_length("key")
    inner = prefixes.where(n > 1).select("key", F.explode(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring("key", F.lit(1), i))).alias("outer"))
    parents = inner.join(prefixes.select(F.col("key").alias("outer")), "outer").groupBy("key").agg(F.max("outer").alias("parent"))
    ends = prefixes.join(parents, "key", "left").select(F.concat("key", F.unhex(F.lit(_END))).alias("at"), F.col("parent").alias("top"))
    return prefixes.select(F.col("key").alias("at"), F.col("key").alias("top")).unionByName(ends)


def innermost(probes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(key, top): for each distinct binary ``key`` of probes the longest of prefixes that it starts with, or null.

    Both sides are range-partitioned and sorted together. The swept rows are written once, so every later read
    sees the same partitions; the last boundary of each partition is then carried into those after it. What is
    carried has one row for each partition, whatever the input.
    """
    events = _boundaries(prefixes).select("at", F.lit(0).alias("kind"), F.struct("top").alias("top"))
    events = events.unionByName(probes.select(F.col("key").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("struct<top:binary>").alias("top")))
    part = F.spark_partition_id().alias("part")
    dealt = events.repartitionByRange("at", "kind").select("*", part)
    so_far = Window.partitionBy("part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = cut_lineage(dealt.withColumn("open", F.last("top", ignorenulls=True).over(so_far)))
    after = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    closing = swept.groupBy("part").agg(F.max_by("open", F.struct("at", "kind")).alias("closing"))
    carried = closing.select("part", F.last("closing", ignorenulls=True).over(after).alias("carried"))
    return swept.where("kind = 1").join(F.broadcast(carried), "part", "left").select(F.col("at").alias("key"), F.coalesce("open", "carried")["top"].alias("top"))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """A short list of rules given as (rule, verdict), the rule like ``example.net/en/``; a long one is a table."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")) for rule, verdict in rules])))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages.

    rules: rule, verdict. A rule is split like a url after its ``://``. It fits its host and all subdomains where
    the url's path starts with the rule's path. The longest fitting rule wins, then the one of the longer host.
    No fitting rule: rule is null and the verdict is ``default``. A url that is null or has no ``://`` has an empty
    host, which no rule fits. A rule without a host fits nothing; of repeated rules the smallest verdict counts.
    Repeated urls are judged once: hosts and paths are made distinct (merged before the shuffle) and joined back,
    so a host with a third of all urls does not meet in one task. Other columns of pages are not read.
    """
    host, path = url_parts(F.concat(F.lit("://"), F.col("rule")))
    rules = rules.groupBy("rule").agg(F.min("verdict").alias("verdict")).select("rule", "verdict", host.alias("rule_host"), path.alias("rule_path")).where("rule_host <> ''")
    rules = rules.withColumn("rule_key", host_key(F.col("rule_host")))

    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))

    # First sweep, over hosts: the stack of rule hosts that are open at each host.
    to_key = lambda c: F.encode(c, "utf-8")
    rule_hosts = rules.select("rule_key").distinct()
    labels = F.split(F.expr("substring(rule_key, 1, length(rule_key) - 1)"), r"\.")
    chain = rule_hosts.select("rule_key", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.array_join(F.slice(labels, F.lit(1), i), "."), F.lit(".")))).alias("below"))
    stacks = chain.join(rule_hosts.select(F.col("rule_key").alias("below")), "below").select(to_key(F.col("rule_key")).alias("top"), "below")
    hosts = urls.select("host").where("host <> ''").distinct().withColumn("key", to_key(host_key(F.col("host"))))
    tops = innermost(hosts.select("key"), rule_hosts.select(to_key(F.col("rule_key")).alias("key"))).where("top is not null")
    opened = hosts.join(tops, "key").join(stacks, "top").select("host", F.col("below").alias("rule_key"))

    # Second sweep, over paths below each open rule host: the innermost prefix is the longest path that fits.
    both = lambda path: F.encode(F.concat(F.col("rule_key"), F.lit("\x00"), F.col(path)), "utf-8")
    asked = urls.select("host", "path").distinct().join(opened, "host").withColumn("key", both("path"))
    keyed = rules.withColumn("top", both("rule_path"))
    fits = innermost(asked.select("key").distinct(), keyed.select(F.col("top").alias("key")).distinct()).where("top is not null")
    named = fits.join(keyed.groupBy("top").agg(F.min(F.struct("rule", "verdict")).alias("r"), F.first(F.length("rule_key")).alias("host_length")), "top")
    best = asked.join(named.select("key", "r", "host_length"), "key").groupBy("host", "path").agg(F.max(F.struct(F.length("r.rule").alias("n"), "host_length", "r")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("best.r.rule").alias("rule"), F.coalesce("best.r.verdict", F.lit(default)).alias("verdict"))
