"""Ranking and picking: every order ends in a unique id, so a result never depends on the input's order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.contacts import eligible_for_verification, local_scope, role_score
from siftline.functions.text import contact_name_key, first_name, text_or_empty

MAX_CONTACTS = 3
ROLE_THRESHOLD = 70


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """df with each row's place within its keys. A filter on a small place reaches Spark as a group limit."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key.

    The winner is found by ``min_by``, which is merged before the shuffle, so a key with very many rows costs one row
    for each map task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def _exact_order(id: str) -> Column:
    """Valid rows come first, then dated ones, longer titles and the smallest id."""
    return F.struct((F.col("record_status") != "valid").alias("a"), F.col("published_at").isNull().alias("b"), (-F.length("title")).alias("c"), F.col(id).alias("id"))


def exact_winners(df: DataFrame, key: str = "canonical_url", id: str = "candidate_id") -> DataFrame:
    """The winning id of each key and the number of its rows. df: key, id, record_status, published_at, title.

    Merged before the shuffle, so a key that a third of all rows share costs one row for each map task.
    """
    return df.groupBy(key).agg(F.min_by(id, _exact_order(id)).alias(id), F.count(F.lit(1)).alias("n"))


def exact_duplicates(df: DataFrame, key: str = "canonical_url", id: str = "candidate_id") -> DataFrame:
    """One row for each key with the ids of all its rows in one array, the winner's first.

    The array is what the stage's records hold; where a key may have more rows than a record should, join
    ``exact_winners`` instead.
    """
    found = df.groupBy(key).agg(F.array_sort(F.collect_list(_exact_order(id))).alias("all"))
    ids = F.transform("all", lambda r: r["id"])
    return found.select(key, ids[0].alias(id), ids.alias("duplicate_ids"))


def select_best_contacts(df: DataFrame) -> DataFrame:
    """All rows with ``selected``: the best contact that isn't rejected of each event and person.

    Verified before unknown, with a mailbox, with a phone, more evidence, the *largest* id.
    df: lead_event_id, person_id, contact_candidate_id, verification_status, email, phone, evidence_count.
    """
    level = F.when(F.col("verification_status") == "verified", 2).when(F.col("verification_status") == "unknown", 1).otherwise(0)
    order = [(level == 0).asc(), level.desc(), (text_or_empty("email") != "").desc(), (text_or_empty("phone") != "").desc(), F.col("evidence_count").desc(), F.col("contact_candidate_id").desc()]
    return ranked(df, ["lead_event_id", "person_id"], order, "_n").withColumn("selected", (F.col("_n") == 1) & (level > 0)).drop("_n")


def anchor_order(score: Column, priority: Column, date: Column, id: Column) -> list[Column]:
    """Score (missing below 0), priority, later date (missing first of all), smallest id."""
    weight = F.when(priority == "high", 2).when(priority == "medium", 1).when(priority == "low", 0).otherwise(-1)
    return [(-F.coalesce(score, F.lit(-1))).alias("a"), (-weight).alias("b"), (-F.coalesce(F.unix_date(date), F.lit(-(10**7)))).alias("c"), id.alias("d")]


def anchor_events(df: DataFrame, key: str = "company_id") -> DataFrame:
    """The anchor event of each company. df: key, lead_event_id, score, priority, date_posted and any others."""
    return first_per_key(df, [key], anchor_order(F.col("score"), F.col("priority"), F.col("date_posted"), F.col("lead_event_id")))


def rank_recipients(contacts: DataFrame, local_key: bool = True) -> DataFrame:
    """W04, and W05 with ``local_key=False``: people of a company by role score, each by its preferred contact.

    contacts: company_id, person_id, title, scope, name, provider, email, contact_candidate_id, selected,
    verification_status, verification_reason, evidence_count. Adds role_score, rationale, rank, is_primary, first_name.
    """
    usable = contacts.where(F.col("selected") & (text_or_empty("email") != "") & eligible_for_verification("verification_status", "verification_reason"))
    own = F.lower(text_or_empty("provider")) != "apollo"
    preferred = ranked(usable, ["company_id", "person_id"], [own.desc(), F.col("evidence_count").desc(), F.col("contact_candidate_id").desc()], "_n").where("_n = 1").drop("_n")
    role = role_score("title", "scope")
    scored = preferred.withColumn("_role", role).withColumn("role_score", F.col("_role.score") + F.when(own, 2).otherwise(0))
    scored = scored.withColumn("rationale", F.when(own, F.concat("_role.rationale", F.array(F.lit("non_apollo_source_contact_candidate")))).otherwise(F.col("_role.rationale")))
    order = [F.col("role_score").desc(), own.desc(), *([local_scope("scope").desc()] if local_key else []), F.col("person_id").asc()]
    out = ranked(scored, ["company_id"], order)
    return out.withColumn("is_primary", F.col("rank") == 1).withColumn("first_name", first_name("name")).drop("_role")


def keeper_order(contacts: Column, filled: Column, added: Column, id: Column) -> list[Column]:
    """Most contacts, most filled fields, earliest (missing last), then the smallest id."""
    return [(-contacts).alias("a"), (-filled).alias("b"), added.isNull().alias("c"), added.alias("d"), id.alias("e")]


def keepers(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Every lead with ``keeper_id`` of its cluster and whether it is the keeper. df: cluster, lead_id, n_contacts, num_filled, added."""
    best = df.groupBy(cluster).agg(F.min_by("lead_id", F.struct(*keeper_order(F.col("n_contacts"), F.col("num_filled"), F.col("added"), F.col("lead_id")))).alias("keeper_id"))
    return df.join(best, cluster).withColumn("is_keeper", F.col("lead_id") == F.col("keeper_id"))


def merge_contacts(existing: Column | str, incoming: Column | str, most: int = MAX_CONTACTS) -> Column:
    """A struct of kept and overflow: the keeper's first, one for each name, at most ``most`` kept, none lost."""
    as_array = lambda c: F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast("array<string>"))
    whole = F.filter(F.concat(as_array(existing), as_array(incoming)), lambda x: F.btrim(text_or_empty(x)) != "")
    keys = F.transform(whole, lambda x: contact_name_key(x))
    once = F.filter(F.zip_with(whole, F.transform(keys, lambda k, i: F.array_position(keys, k) == i + 1), lambda x, new: F.struct(x.alias("x"), new.alias("new"))), lambda p: p["new"])
    unique = F.transform(once, lambda p: p["x"])
    return F.struct(F.slice(unique, 1, most).alias("kept"), F.slice(unique, most + 1, F.greatest(F.size(unique) - most, F.lit(0))).alias("overflow"))


def cap_per_key(df: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """At most ``most`` rows of each key."""
    return ranked(df, keys, order, "_n").where(F.col("_n") <= most).drop("_n")


def spend_cap(df: DataFrame, order: list[Column], most: int) -> tuple[DataFrame, DataFrame]:
    """The first ``most`` rows and the deferred rest: together all rows, also those that repeat or tie."""
    from siftline.operators.order import cut, numbered

    ranks = cut(numbered(df, order, "_rank"))  # both sides see one order of ties
    return ranks.where(F.col("_rank") <= most).drop("_rank"), ranks.where(F.col("_rank") > most).drop("_rank")


def mailbox_winners(df: DataFrame) -> DataFrame:
    """sequence_id and winner_id of ready sequences that lose their mailbox to another.

    df: sequence_id, email, domain_matches, shared_tokens, anchor_date, score, role_score; ready ones only.
    """
    order = F.struct((~F.col("domain_matches")).alias("a"), (-F.col("shared_tokens")).alias("b"), (-F.coalesce(F.unix_date("anchor_date"), F.lit(-(10**7)))).alias("c"), (-F.col("score")).alias("d"), (-F.col("role_score")).alias("e"), F.col("sequence_id").alias("f"))
    best = df.groupBy(F.lower(F.btrim("email")).alias("mailbox")).agg(F.min_by("sequence_id", order).alias("winner_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return df.withColumn("mailbox", F.lower(F.btrim("email"))).join(best, "mailbox").where("sequence_id <> winner_id").select("sequence_id", "winner_id", "mailbox")


def identity_collisions(df: DataFrame, id: str, identity: list[str], order: list[Column]) -> DataFrame:
    """Rows whose id or identity is blank, or whose identity differs from the row before of the same id."""
    blank = F.lit(False)
    for c in [id, *identity]:
        blank = blank | (text_or_empty(c) == "")
    now = F.struct(*[text_or_empty(c).alias(c) for c in identity])
    before = F.lag(now).over(Window.partitionBy(id).orderBy(*order))
    return df.withColumn("collision", blank | F.coalesce(now != before, F.lit(False)))


def batches(df: DataFrame, id: str, size: int, groups: list[str] | None = None) -> DataFrame:
    """Df with batch_no, rows in order of id, ``size`` to a batch, within each group if any are given.

    Without groups the rows are numbered by range partitions and their counts, not in one task.
    """
    if groups:
        return ranked(df, groups, [F.col(id)], "_n").withColumn("batch_no", F.floor((F.col("_n") - 1) / size)).drop("_n")
    from siftline.operators.order import numbered

    return numbered(df, [id], "_n").withColumn("batch_no", F.floor((F.col("_n") - 1) / size)).drop("_n")


def batch_ids(df: DataFrame, id: str, groups: list[str]) -> DataFrame:
    """Each batch with a hash of its ids in order."""
    return df.groupBy(*groups).agg(F.sha2(F.concat_ws("\x1f", F.array_sort(F.collect_list(F.col(id).cast("string")))), 256).alias("batch_id"), F.count(F.lit(1)).alias("n"))


def retry_stage(reviews: DataFrame, stages: list[str], most_retries: int) -> DataFrame:
    """The earliest stage with an open review that may be retried. reviews: stage, state, retry_count."""
    place = F.create_map(*[x for i, s in enumerate(stages) for x in (F.lit(s), F.lit(i))])
    usable = reviews.where((F.col("state") == "open") & (F.col("retry_count") < most_retries)).withColumn("_at", place[F.col("stage")])
    return usable.agg(F.min_by("stage", "_at").alias("stage"))


def unique_recipients(c: Column | str) -> Column:
    """Mailboxes once each, whatever their case, in their order."""
    mails = F.transform(F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast("array<string>")), lambda m: F.lower(F.btrim(text_or_empty(m))))
    return F.array_distinct(F.filter(mails, lambda m: m != ""))


def samples(df: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """The first rows of each key as one array, for a bounded question."""
    rest = [c for c in df.columns if c not in keys]
    rows = cap_per_key(df.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))), keys, order, most)
    made = F.transform(F.array_sort(F.collect_list(F.struct("_place", F.struct(*rest).alias("row")))), lambda r: r["row"])
    return rows.groupBy(*keys).agg(made.alias("rows"))


def backlog_first(backlog: DataFrame, fresh: DataFrame, at: str, id: str) -> DataFrame:
    """What waited, oldest first, then what is new; ties by id."""
    whole = backlog.withColumn("bucket", F.lit(0)).unionByName(fresh.withColumn("bucket", F.lit(1)))
    return whole.orderBy("bucket", at, id)


def ordered_union(*arrays: Column | str) -> Column:
    """The values of all arrays once each, in order of their first place."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(F.col(a) if isinstance(a, str) else a, none) for a in arrays]))
