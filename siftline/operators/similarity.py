"""Similar titles: exact Jaccard joins over token sets, clusters, and duplicates across runs."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from siftline.functions.text import normalize_text, title_tokens
from siftline.operators.graph import connected
from siftline.operators.order import cut

# Words that don't tell events apart, and stems that count as one.
STOP_WORDS = ("a", "an", "and", "at", "for", "in", "is", "of", "on", "the", "to", "new", "may", "plans", "planned", "project", "arizona", "az")
STEMS = {
    "approved": "approv", "approval": "approv", "approves": "approv",
    "build": "develop", "building": "develop", "built": "develop", "construction": "develop", "construct": "develop",
    "development": "develop", "develops": "develop", "developed": "develop", "expansion": "develop", "expand": "develop",
    "expands": "develop", "fab": "develop", "fabs": "develop",
    "condominium": "condo", "condominiums": "condo", "condos": "condo", "units": "unit",
}
MAX_DAYS, NEAR_DAYS, RATIO = 21, 7, 0.58
#: Open pairs for one task of a round.
PAIRS_PER_PART = 50_000


def jaccard_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """A, b, score for every two distinct token sets with Jaccard similarity of at least ``threshold``, a < b.

    sets: key (unique), tokens (array of distinct tokens). Tokens are ordered by how rare they are; two sets as similar
    as asked share one of their rarest |x| - ceil(t |x|) + 1 tokens, so only those are joined and a token that all
    sets have is never a join key of all of them. Sizes prune further; survivors are compared exactly.
    """
    filled = sets.where(F.size("tokens") > 0).select("key", "tokens")
    seen = filled.select("key", F.explode("tokens").alias("token"))
    rarity = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    by_rarity = F.transform(F.array_sort(F.collect_list(F.struct("n", "token"))), lambda x: x["token"])
    ordered = seen.join(rarity, "token").groupBy("key").agg(by_rarity.alias("tokens"))
    size = F.size("tokens")
    prefix = F.slice("tokens", F.lit(1), (size - F.ceil(size * F.lit(threshold) - F.lit(1e-9)) + 1).cast("int"))
    probes = ordered.select("key", size.alias("size"), F.explode(prefix).alias("token"))
    left, right = probes.select(F.col("key").alias("a"), "token", F.col("size").alias("na")), probes.select(F.col("key").alias("b"), "token", F.col("size").alias("nb"))
    close = (F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(threshold) - F.lit(1e-9)) & (F.col("a") < F.col("b"))
    pairs = left.join(right, "token").where(close).select("a", "b").distinct()
    one, two = filled.select(F.col("key").alias("a"), F.col("tokens").alias("ta")), filled.select(F.col("key").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    scored = pairs.join(one, "a").join(two, "b").select("a", "b", (both / (F.size("ta") + F.size("tb") - both)).alias("score"))
    return scored.where(F.col("score") >= threshold)


def title_pairs(df: DataFrame, threshold: float, title: str = "title") -> DataFrame:
    """J13 over the distinct titles of df: equal titles are one set, so copies are never paired with each other."""
    titles = df.select(F.col(title).alias("key")).where(F.col(title).isNotNull()).distinct()
    return jaccard_pairs(titles.select("key", title_tokens("key").alias("tokens")), threshold)


def title_clusters(df: DataFrame, threshold: float, title: str = "title") -> DataFrame:
    """Key (a distinct title) and component: the smallest title that a chain of similar ones reaches.

    Titles of one token set are one node, so they are never paired with each other; one without tokens is like no other.
    """
    titles = df.select(F.col(title).alias("node")).where(F.col(title).isNotNull()).distinct()
    titles = titles.withColumn("tokens", title_tokens("node")).withColumn("own", F.when(F.size("tokens") == 0, F.col("node")))
    sets = cut(titles.groupBy("tokens", "own").agg(F.min("node").alias("key")))
    found = connected(sets.select(F.col("key").alias("node")), jaccard_pairs(sets.select("key", "tokens"), threshold))
    of_set = sets.join(found.withColumnRenamed("node", "key"), "key").select("tokens", "own", "component")
    same = (titles["tokens"] == of_set["tokens"]) & titles["own"].eqNullSafe(of_set["own"])
    return titles.join(of_set, same).select(F.col("node").alias(title), "component")


def recent_candidates(leads: DataFrame, title: Column, now: Column, days: int, threshold: float) -> DataFrame:
    """Leads added within ``days`` before ``now`` with their similarity to one title, at least ``threshold``, best first."""
    mine, other = title_tokens(title), title_tokens("title")
    both = F.size(F.array_intersect(mine, other))
    score = F.when((F.size(mine) > 0) & (F.size(other) > 0), both / (F.size(mine) + F.size(other) - both)).otherwise(F.lit(0.0))
    recent = leads.where(F.col("added") >= now - F.make_dt_interval(F.lit(days)))
    return recent.withColumn("score", score).where(F.col("score") >= threshold).orderBy(F.desc("score"), "lead_id")


def duplicate_tokens(c: Column | str, company_key: Column | str) -> Column:
    """A text's words without stop words, the company's own and short ones; stems unified, else a trailing s cut."""
    own = F.split(normalize_text(company_key), " ")
    stems = F.create_map(*[F.lit(x) for item in STEMS.items() for x in item])
    words = F.filter(F.split(normalize_text(c), " "), lambda w: (F.length(w) >= 3) & ~w.isin(*STOP_WORDS) & ~F.array_contains(own, w))
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.coalesce(stems[w], F.regexp_replace(w, "s+$", "")))))


@F.pandas_udf(DoubleType())
def reads_alike(left: pd.Series, right: pd.Series) -> pd.Series:
    """How alike two texts read: the share of characters in matching blocks; there is no built-in for it."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right, strict=True)], dtype="float64")


def event_pairs(current: DataFrame, history: DataFrame) -> DataFrame:
    """now and prior (structs of order and id, and of the latter whether it is history) of events that repeat each other.

    Both: company_key, lead_event_id, event, location, date_posted (date), canonical_url. Two events of a company can
    repeat each other only with one url, or within three weeks; so they meet by company and url, or by company and
    three-week period, and a company's events are spread over as many tasks as it has periods.
    """
    day = F.unix_date("date_posted")
    columns = ["company_key", "lead_event_id", "canonical_url", day.alias("day"), normalize_text("event").alias("said"), duplicate_tokens("event", "company_key").alias("tokens"), duplicate_tokens("location", F.lit("")).alias("places")]
    shaped = lambda df, now: df.select(F.lit(now).alias("current"), *columns).withColumn("at", F.struct("current", F.coalesce("day", F.lit(-(2**31))).alias("day"), F.col("lead_event_id").alias("id")))
    events = shaped(current, 1).unionByName(shaped(history, 0))
    now = events.where("current = 1").select("company_key", F.struct("at", "canonical_url", "day", "said", "tokens", "places").alias("a"))
    prior = events.select("company_key", F.struct("at", "canonical_url", "day", "said", "tokens", "places").alias("b"))
    earlier = (F.col("b.at") < F.col("a.at")) & (F.col("a.at.id") != F.col("b.at.id"))

    by_url = now.withColumn("url", F.col("a.canonical_url")).where("url <> ''").join(prior.withColumn("url", F.col("b.canonical_url")), ["company_key", "url"]).where(earlier)
    period = lambda c: F.floor(F.col(f"{c}.day") / MAX_DAYS)
    near = now.where("a.day is not null").withColumn("period", F.explode(F.array(period("a") - 1, period("a"), period("a") + 1)))
    near = near.join(prior.where("b.day is not null").withColumn("period", period("b")), ["company_key", "period"])
    gap = F.abs(F.col("a.day") - F.col("b.day"))
    same_place = (F.size("a.places") == 0) | (F.size("b.places") == 0) | F.arrays_overlap("a.places", "b.places")
    near = near.where(earlier & (gap <= MAX_DAYS) & same_place)
    shared = F.array_intersect("a.tokens", "b.tokens")
    sure = (F.size(shared) >= 2) | F.exists(shared, lambda t: F.regexp_like(t, F.lit("^[0-9]+$"))) | ((gap <= NEAR_DAYS) & F.array_contains(shared, "develop"))
    alike = near.where(~sure & (F.col("a.said") != "") & (F.col("b.said") != "")).where(reads_alike("a.said", "b.said") >= RATIO)
    ends = ["company_key", F.col("a.at").alias("now"), F.col("b.at").alias("prior")]
    return by_url.select(*ends).unionByName(near.where(sure).select(*ends)).unionByName(alike.select(*ends)).distinct()


def blocked_events(pairs: DataFrame, steps: int = 4) -> DataFrame:
    """now, prior of each event that repeats a standing one; prior is the first such.

    pairs: now and prior, structs of (company_key, current, day, id) with prior before now. What isn't current stands. Going by date and
    id, an event is blocked if one before it that it pairs with stands. That order is peeled in parallel: events whose
    prior ones are all decided are decided at once. An event that has no undecided prior one stands; whatever pairs with
    it is blocked; a blocked event's pairs are gone, which leaves others without prior ones. A chain of n events that each
    pair with the one before takes n / 2 steps, so rounds follow the length of a company's history and not its rows.
    Each round does several steps and is checkpointed; a round's tasks follow the pairs that are left.
    """
    by_history = pairs.where("prior.current = 0").select("now").distinct()
    blocked = cut(by_history)
    open_ = cut(pairs.where("prior.current = 1").select("now", "prior").join(blocked, "now", "left_anti"))
    first = open_.count()
    as_prior = lambda df: df.select(F.col("now").alias("prior"))
    if first:  # pairs with events that history blocks are gone
        open_ = cut(open_.join(as_prior(blocked), "prior", "left_anti").select("now", "prior"))
    left = open_.count() if first else 0
    while left:
        parts, found = -(-left // PAIRS_PER_PART), None
        open_ = open_.coalesce(parts)
        for _ in range(steps):
            fresh = open_.join(as_prior(open_).distinct(), "prior", "left_anti").select("now").distinct()
            found = fresh if found is None else found.unionByName(fresh)
            open_ = open_.join(fresh, "now", "left_anti").join(as_prior(fresh), "prior", "left_anti").select("now", "prior")
        found = cut(found.coalesce(parts))
        blocked = blocked.unionByName(found)
        open_ = cut(open_.coalesce(parts))
        left = open_.count()
    gone = cut(blocked)
    standing = pairs.join(gone, "now").join(as_prior(gone), "prior", "left_anti")
    return standing.groupBy("now").agg(F.min("prior").alias("prior"))


def cross_run_duplicates(current: DataFrame, history: DataFrame) -> DataFrame:
    """Each current event with the earlier event that it repeats, or null.

    An event counts against its company's history and the current events before it, by date and id, that were not blocked
    themselves. Pairs are found by joins and decided by joins, so a company with very many events is many tasks' work.
    """
    of_company = lambda c: F.struct("company_key", f"{c}.current", f"{c}.day", f"{c}.id").alias(c)
    pairs = cut(event_pairs(current, history).select(of_company("now"), of_company("prior")))
    found = blocked_events(pairs).select("now.company_key", F.col("now.id").alias("lead_event_id"), F.col("prior.id").alias("duplicate_of"))
    return current.select("company_key", "lead_event_id").join(found, ["company_key", "lead_event_id"], "left")
