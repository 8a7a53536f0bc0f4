"""Mutations as folds of a log: rows (key, seq, columns), reduced to the state that a sequence of upserts would leave.

All of them are aggregates that merge before the shuffle; none needs a key's rows in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST, COALESCE, NON_EMPTY, MAX, MIN, FIRST = "last", "coalesce", "non_empty", "max", "min", "first"


def _rule(column: str, rule: str, seq: str) -> Column:
    c = F.col(column)
    if rule == LAST:  # M02, M06: the last writer's value, null included
        return F.max_by(F.struct(c), F.col(seq))[column]
    if rule == COALESCE:  # M03: a null never overwrites
        return F.max_by(c, F.when(c.isNotNull(), F.col(seq)))
    if rule == NON_EMPTY:  # M04: neither null nor '' overwrites
        return F.max_by(c, F.when(F.coalesce(c != "", F.lit(False)), F.col(seq)))
    if rule == MAX:  # M05
        return F.max(c)
    if rule == MIN:
        return F.min(c)
    if rule == FIRST:  # M01, and created_at of M02
        return F.min_by(F.struct(c), F.col(seq))[column]
    raise ValueError(f"unknown rule {rule!r}")


def fold(log: DataFrame, keys: list[str], seq: str, rules: dict[str, str]) -> DataFrame:
    """The state of each key, column by column by its rule.

    seq orders a key's rows and is unique within it. A column whose rule finds no value is null.
    """
    return log.groupBy(*keys).agg(*[_rule(c, r, seq).alias(c) for c, r in rules.items()])


def upsert(state: DataFrame, changes: DataFrame, keys: list[str], seq: str, rules: dict[str, str]) -> DataFrame:
    """A snapshot and the log since, folded; the snapshot's rows come before all of the log's."""
    columns = [*keys, *rules]
    first = state.select(*columns, F.lit(0).alias("_log"), F.lit(None).cast(changes.schema[seq].dataType).alias("_seq"))
    whole = first.unionByName(changes.select(*columns, F.lit(1).alias("_log"), F.col(seq).alias("_seq")))
    return fold(whole.withColumn("_order", F.struct("_log", "_seq")), keys, "_order", rules)


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The rows of new that an insert-or-ignore would add: the first of each key that existing hasn't."""
    from siftline.operators.pick import first_per_key

    return first_per_key(new.join(existing.select(*keys).distinct(), keys, "left_anti"), keys, order)


def patch_fold(log: DataFrame, keys: list[str], seq: str, patch: str, columns: list[str]) -> DataFrame:
    """Partial updates in a map column: the last patch that *names* a column decides, also where it sets null."""
    value = lambda c: F.max_by(F.struct(F.try_element_at(F.col(patch), F.lit(c)).alias("v")), F.when(F.map_contains_key(F.col(patch), c), F.col(seq)))["v"]
    return log.groupBy(*keys).agg(*[value(c).alias(c) for c in columns])


def unknown_columns(log: DataFrame, patch: str, columns: list[str]) -> DataFrame:
    """Patches that are empty or name a column that isn't allowed."""
    odd = F.array_except(F.map_keys(F.col(patch)), F.array(*[F.lit(c) for c in columns]))
    return log.where((F.size(F.col(patch)) == 0) | (F.size(odd) > 0)).withColumn("unknown", odd)


def sticky(log: DataFrame, keys: list[str], seq: str, status: str, reached: Column, stays: str) -> DataFrame:
    """The last status, but ``stays`` once ``reached`` held for any row."""
    return log.groupBy(*keys).agg(F.when(F.bool_or(F.coalesce(reached, F.lit(False))), F.lit(stays)).otherwise(F.max_by(status, seq)).alias(status))


def immutable_after(log: DataFrame, keys: list[str], seq: str, state: str, draft: str, content: str) -> DataFrame:
    """Per key the content that holds and whether a later write tried to change it.

    The first row that isn't a draft fixes the content; later rows that differ from it are violations.
    """
    fixed = log.groupBy(*keys).agg(F.min(F.when(F.col(state) != draft, F.col(seq))).alias("_fixed"), F.max_by(content, seq).alias("_last"))
    rows = log.join(fixed, keys)
    at = F.max(F.when(F.col(seq) == F.col("_fixed"), F.col(content)))
    kept = rows.groupBy(*keys).agg(F.coalesce(at, F.max("_last")).alias(content), F.max("_fixed").alias("fixed_at"))
    late = log.join(kept.select(*keys, F.col(content).alias("_held"), "fixed_at"), keys).where((F.col(seq) > F.col("fixed_at")) & ~F.col(content).eqNullSafe(F.col("_held")))
    count = late.groupBy(*keys).agg(F.count(F.lit(1)).alias("violations"))
    return kept.join(count, keys, "left").withColumn("violations", F.coalesce("violations", F.lit(0)))


def stage_runs(log: DataFrame) -> DataFrame:
    """run_id, stage, status, attempts and completed_at of a log run_id, stage, seq, status, at."""
    done = F.col("status").isin("completed", "failed")
    return log.groupBy("run_id", "stage").agg(F.max_by("status", "seq").alias("status"), F.count_if(F.col("status") == "running").alias("attempts"), F.when(F.max_by(done, "seq"), F.max_by("at", "seq")).alias("completed_at"))


def retire(events: DataFrame, retired: DataFrame) -> DataFrame:
    """Events of retired candidates go to review, the reason added to their errors once. retired: candidate_id, reason."""
    why = retired.groupBy("candidate_id").agg(F.array_sort(F.collect_set("reason")).alias("_why"))
    out = events.join(why, events["primary_candidate_id"] == why["candidate_id"], "left").drop(why["candidate_id"])
    gone = F.col("_why").isNotNull()
    out = out.withColumn("record_status", F.when(gone, F.lit("review")).otherwise(F.col("record_status")))
    return out.withColumn("validation_errors", F.when(gone, F.array_union("validation_errors", "_why")).otherwise(F.col("validation_errors"))).drop("_why")


def alias_conflicts(aliases: DataFrame) -> DataFrame:
    """Aliases that more than one company claims. aliases: alias_type, alias_value, company_id."""
    found = aliases.groupBy("alias_type", "alias_value").agg(F.array_sort(F.collect_set("company_id")).alias("companies"))
    return found.where(F.size("companies") > 1)


def eligible_reviews(reviews: DataFrame, most_retries: int) -> DataFrame:
    """Open reviews that may be retried."""
    return reviews.where((F.col("state") == "open") & (F.col("retry_count") < most_retries))


def enqueue_unless_known(items: DataFrame, queue: DataFrame, order: list[Column]) -> DataFrame:
    """One item for each dedupe_key that the queue hasn't; what gates the item gates what is saved with it."""
    return insert_if_absent(queue, items, ["dedupe_key"], order)


def prune(state: DataFrame, kept: DataFrame, run_id: str, id: str) -> DataFrame:
    """State without the run's rows whose id isn't kept; other runs' rows stay."""
    return state.where(F.col("run_id") != run_id).unionByName(state.where(F.col("run_id") == run_id).join(kept.select(id).distinct(), id, "left_semi").select(*state.columns))


def replace_groups(bridge: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Every group that new has is replaced whole."""
    return bridge.join(new.select(key).distinct(), key, "left_anti").select(*bridge.columns).unionByName(new.select(*bridge.columns))


def transition(state: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """State with the changed values of one column; changes of unknown keys do nothing. changes: unique key, value."""
    new = changes.select(key, F.struct(F.col("value").alias("v")).alias("_new"))
    return state.join(new, key, "left").withColumn(column, F.when(F.col("_new").isNotNull(), F.col("_new.v")).otherwise(F.col(column))).drop("_new").select(*state.columns)


def alias_bridge(organizations: DataFrame) -> DataFrame:
    """Organization and normalized alias, once each. organizations: organization_id, canonical_name, aliases."""
    from siftline.functions.text import normalize_text

    names = F.array_union(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return organizations.select("organization_id", F.explode(F.transform(names, lambda n: normalize_text(n))).alias("alias")).where("alias <> ''").distinct()


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Values of a unique key that several rows have."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def resolve_tokens(tokens: DataFrame, stored: DataFrame) -> DataFrame:
    """What tokens stand for; only their hashes are stored. tokens: token; stored: token_hash and others."""
    return tokens.withColumn("token_hash", F.sha2("token", 256)).join(stored, "token_hash").drop("token_hash")
