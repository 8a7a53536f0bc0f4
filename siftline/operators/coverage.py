"""Contracts on rows: exact coverage of ids, violations, foreign keys. Nothing is dropped: every row comes out somewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(**tests: Column) -> Column:
    """An array of the names of the tests that hold, in the order given; a null test doesn't hold."""
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in tests.items()]))


def split(df: DataFrame, violations: str = "violations") -> tuple[DataFrame, DataFrame]:
    """Rows without and with violations."""
    return df.where(F.size(violations) == 0), df.where(F.size(violations) > 0)


def id_coverage(expected: DataFrame, seen: DataFrame, batch: str, id: str) -> DataFrame:
    """Per id its batch and problem: missing, unknown or duplicate; ok ids have null.

    Both sides are counted before they meet, so an id that an answer repeats very often is one row.
    """
    e = expected.groupBy(batch, id).agg(F.count(F.lit(1)).alias("_expected"))
    s = seen.groupBy(batch, id).agg(F.count(F.lit(1)).alias("_seen"))
    both = e.join(s, [batch, id], "full")
    problem = F.when(F.col("_seen").isNull(), "missing").when(F.col("_expected").isNull(), "unknown").when(F.col("_seen") != 1, "duplicate")
    return both.select(batch, id, problem.alias("problem"))


def grouping_problems(expected: DataFrame, groups: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Batches whose grouping isn't exact. expected: batch, id; groups: batch, kept_id, member_ids."""
    members = groups.select(batch, F.explode("member_ids").alias("id"))
    covered = id_coverage(expected.select(batch, "id"), members, batch, "id").where("problem is not null").groupBy(batch).agg(F.array_sort(F.collect_set("problem")).alias("problems"))
    bad = (F.coalesce(F.col("kept_id"), F.lit("")) == "") | (F.size("member_ids") < 1) | ~F.array_contains("member_ids", F.col("kept_id"))
    unkept = groups.where(F.coalesce(bad, F.lit(True))).groupBy(batch).agg(F.array(F.lit("kept_not_member")).alias("problems"))
    return covered.unionByName(unkept).groupBy(batch).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("problems")))).alias("problems"))


def score_problems(expected: DataFrame, scores: DataFrame, batch: str = "batch_id", id: str = "id", value: str = "score") -> DataFrame:
    """id_coverage, and per id ``not_integer`` or ``out_of_range`` for a value that isn't a whole number from 0 to 100."""
    covered = id_coverage(expected, scores, batch, id)
    odd = scores.groupBy(batch, id).agg(F.max(F.when(F.col(value).isNull() | (F.col(value) != F.floor(value)), "not_integer").when(~F.col(value).between(0, 100), "out_of_range")).alias("_odd"))
    return covered.join(odd, [batch, id], "left").select(batch, id, F.coalesce("problem", "_odd").alias("problem"))


def missing_references(child: DataFrame, parent: DataFrame, column: str, key: str, code: str) -> DataFrame:
    """Child rows whose non-null reference no parent has, with the code."""
    known = parent.select(F.col(key).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti").withColumn("violation", F.lit(code))


def judgment_violations(df: DataFrame) -> DataFrame:
    """judgments with what they lack. df: qualified, business_name, event, date_posted, location, summary, state,
    priority, confidence, filter_reason; '' and null are missing."""
    lacks = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    yes, no = F.coalesce(F.col("qualified"), F.lit(False)), ~F.coalesce(F.col("qualified"), F.lit(True))
    tests = {f"{c}_missing": yes & lacks(c) for c in ("business_name", "event", "date_posted", "location", "summary")}
    tests |= {"qualified_missing": F.col("qualified").isNull(), "filter_reason_missing": no & lacks("filter_reason")}
    tests |= {"state_invalid": yes & (F.coalesce("state", F.lit("")) != "Arizona"), "priority_invalid": yes & ~F.coalesce("priority", F.lit("")).isin("high", "medium", "low"), "confidence_invalid": yes & ~F.coalesce("confidence", F.lit("")).isin("high", "low")}
    return df.withColumn("violations", reasons(**tests))
