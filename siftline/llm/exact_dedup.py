"""Exact dedup: rows whose texts are equal after white space is deleted.

Rows are grouped by a 128-bit hash of the normalised text; what is shuffled for that is the hash and three numbers, not
the text. Only in groups of several rows are bytes compared: their texts, merged with their copies before the shuffle,
are grouped by the hash and the bytes, so two texts with one hash make two classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import ASCII_SPACE, integral, scratch

#: doc_id fits 20 digits; a row's rank is its length times this, less its doc_id.
_STEP = "100000000000000000000"
_NO_ID = "9300000000000000000"
_CLASS = ["_h", "_sha"]


def normalised(text: Column) -> Column:
    """The text without any of [\\x20\\x09-\\x0D]; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in ASCII_SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def content_hash(norm: Column) -> Column:
    """128 bits of the content."""
    return F.unhex(F.md5(norm))


def _keyed(docs: DataFrame, hashed, *more: str) -> DataFrame:
    """_id, _n (code points), _h and _norm of each row, and further columns."""
    norm = normalised(F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("_n"), norm.alias("_norm"), *more).withColumn("_h", hashed(F.col("_norm")))


def classes(docs: DataFrame, hashed=content_hash) -> tuple[DataFrame, DataFrame]:
    """(rows, several): _id, _n, _h, _sha of each row; _h, _sha, _keep_id, _keep_n, _size of each class of two or more rows.

    Both are written to the shared folder, so texts are hashed once and Spark knows how large the hashes of groups of
    several rows are: it sends them to the documents where they are small, and shuffles where they aren't. The aggregates'
    buffers are counts and one decimal, so they merge copies before the shuffle: a group with a third of all rows
    reaches it as one row for each map task.
    """
    spark, folder = docs.sparkSession, scratch(docs.sparkSession, "exact")
    _keyed(integral(docs), hashed).select("_id", "_n", "_h", F.sha2("_norm", 256).alias("_sha")).write.parquet(f"{folder}/rows")
    rows = spark.read.schema("_id long, _n long, _h binary, _sha string").parquet(f"{folder}/rows")
    rows.groupBy("_h").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_h").write.parquet(f"{folder}/hashes")
    hashes = spark.read.schema("_h binary").parquet(f"{folder}/hashes")

    n, d = F.col("_n").cast("decimal(11,0)"), F.coalesce(F.col("_id").cast("decimal(20,0)"), F.lit(_NO_ID).cast("decimal(20,0)"))
    rank = (n * F.lit(_STEP).cast("decimal(21,0)") - d).cast("decimal(38,0)")
    found = _keyed(docs, hashed).join(hashes, "_h").groupBy("_h", "_norm").agg(F.max(rank).alias("_rank"), F.max("_n").alias("_keep_n"), F.count(F.lit(1)).alias("_size"))
    kept = (F.col("_keep_n").cast("decimal(11,0)") * F.lit(_STEP).cast("decimal(21,0)") - F.col("_rank")).cast("decimal(20,0)")
    kept = F.when(kept != F.lit(_NO_ID).cast("decimal(20,0)"), kept.cast("long"))
    found.where("_size > 1").select("_h", F.sha2("_norm", 256).alias("_sha"), kept.alias("_keep_id"), "_keep_n", "_size").write.parquet(f"{folder}/classes")
    return rows, spark.read.schema("_h binary, _sha string, _keep_id long, _keep_n long, _size long").parquet(f"{folder}/classes")


def _kept() -> Column:
    return F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_n") == F.col("_keep_n"))


def exact_dedup(docs: DataFrame, hashed=content_hash) -> DataFrame:
    """Per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points before normalisation stays, then the smallest doc_id.
    Null text is empty, and all empty texts are one class. A null doc_id ranks last and stays only in a class
    without ids. Repeated rows with one doc_id and one length tie: each is marked as kept here, and
    ``keep_one`` keeps one of them. No rows in, no rows out. Other columns of docs are not read. doc_id must be a whole
    number. A row finds its class by the 128 bits and SHA-256 together.
    """
    rows, several = classes(docs, hashed)
    alone = F.col("_size").isNull()
    return rows.join(several, _CLASS, "left").select(
        F.col("_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep_id")).cast(docs.schema["doc_id"].dataType).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | _kept()).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of each class, all columns as they were; nulls, ties and empty tables as in ``exact_dedup``.

    A row whose class has no other goes through. Where the row that stays is there several times, with one doc_id and one
    text, one of them is taken; that step, the only one to rank rows, is left out where there is no such row.
    """
    names = docs.columns
    rows, several = classes(docs)
    again = rows.join(several, _CLASS).where(_kept()).groupBy(*_CLASS, "_id").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")
    left = _keyed(docs, content_hash, row).withColumn("_sha", F.sha2("_norm", 256)).drop("_norm")
    stay = left.join(several, _CLASS, "left").where(F.col("_size").isNull() | _kept())
    if again.isEmpty():
        return stay.select("_row.*")
    tied = again.select(*_CLASS, F.lit(True).alias("_tied"))
    stay = stay.join(tied, _CLASS, "left")
    first = Window.partitionBy(*_CLASS).orderBy(F.lit(1))
    one = stay.where("_tied").withColumn("_copy", F.row_number().over(first)).where("_copy = 1")
    return stay.where("_tied is null").select("_row.*").unionByName(one.select("_row.*"))
