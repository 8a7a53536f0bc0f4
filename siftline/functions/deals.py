"""Deal size, drop rules and other small decisions on one article."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Monthly rates by property type, and the bounds and shares of the estimate.
RATES = {"office": 2.25, "industrial": 0.55, "multifamily": 100.0, "retail": 1.50, "medical": 3.00, "mixed": 1.75, "other": 1.00}
SQFT_CAP = 5_000_000
UNIT_MONTHLY_RATE = 120
DOLLAR_SHARE = 0.002
OTHER_MIN_CONFIDENCE, GENERAL_MIN_CONFIDENCE = 0.6, 0.5


def deal_size(sqft: Column, units: Column, dollars: Column, property_type: Column) -> Column:
    """A struct of estimate, cut to a whole number, and the basis it has: sqft, units, dollar or none."""
    rate = F.create_map(*[F.lit(x) for item in RATES.items() for x in item])[property_type]
    made = lambda value, basis: F.struct(value.cast("bigint").alias("estimate"), F.lit(basis).alias("basis"))
    by_area = (sqft > 0) & (sqft <= SQFT_CAP) & rate.isNotNull()
    return (
        F.when(by_area, made(sqft * rate * 12, "sqft"))
        .when(units != 0, made(units * UNIT_MONTHLY_RATE * 12, "units"))
        .when(dollars != 0, made(dollars * F.lit(DOLLAR_SHARE), "dollar"))
        .otherwise(made(F.lit(None), "none"))
    )


def drop_reason(in_state: Column, priority: Column, signal: Column, confidence: Column) -> Column:
    """the first rule that drops an article, or null if it qualifies."""
    return (
        F.when(~in_state, "not_az")
        .when(priority == "low", "low_priority")
        .when((signal == "other") & (confidence < OTHER_MIN_CONFIDENCE), "other_low_conf")
        .when(confidence < GENERAL_MIN_CONFIDENCE, "low_conf")
    )


def window_route(date: Column, since: str, until: str) -> Column:
    """keep inside the window (both ends count), review if undated, else outside."""
    return F.when(date.isNull(), "review").when(date.between(F.lit(since).cast("date"), F.lit(until).cast("date")), "keep").otherwise("outside")


def judged_date(c: Column) -> Column:
    """``Aug 30, 2026``, ``August 30, 2026``, ``08/30/2026`` or ISO; null for anything else."""
    text = F.btrim(F.coalesce(c, F.lit("")))
    forms = ("yyyy-MM-dd", "MM/dd/yyyy", "MMM d, yyyy", "MMMM d, yyyy")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in forms])


def confidence_label(c: Column) -> Column:
    """A number up to 1 is a share, above it a percentage; one half and more is high."""
    return F.when(c.isNull(), None).when(F.when(c.between(0, 1), c >= 0.5).otherwise(c >= 50), "high").otherwise("low")


def backoff_seconds(attempts: Column) -> Column:
    """Two to the power of the attempts, ten at most (the stated cap of an hour never binds); jitter is the caller's."""
    return F.least(F.lit(3600), F.pow(F.lit(2), F.least(attempts, F.lit(10))).cast("int"))
