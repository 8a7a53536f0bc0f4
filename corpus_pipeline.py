"""The corpus pipeline: documents that score and read well, one of each group of copies, packed for training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import exact_dedup, language_id, near_copies, packing, quality, simhash
from siftline.llm.common import is_held_out, scratch
from siftline.llm.queries import table, tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects.

    Null and empty texts are scored by the labels' mean. Rows that repeat are judged alike, an empty table gives no rows,
    and all columns stay as they were, whatever their names.
    """
    labels = table(spark, sf_dir, "labels").where(~is_held_out(F.col("doc_id"), 5, 0))
    return quality.keep_good(docs, quality.learn(docs, labels))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told.

    Those are null and empty texts, texts without a letter, and ties. Where no row has a lang, none can be told and none
    stays. Rows that repeat are judged alike, an empty table gives no rows, and all columns stay as they were.
    """
    return language_id.keep_identified(docs, language_id.learn(docs.where(~is_held_out(F.col("doc_id"), 4, 2))))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of equal texts: the longest before white space is deleted, then the one of smallest doc_id.

    Nulls are empty texts and equal to each other; a null doc_id ranks last. Of rows that repeat one stays. An empty table
    gives no rows, and all columns stay as they were.
    """
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the one of smallest doc_id.

    A group is what op 3's fingerprints link (three differing bits or fewer) and what five-word shingles that are similar by
    0.8 or more link, which finds the block edits and repeats that fingerprints miss; links of both kinds join. Texts without a word, null ones too, are one group; a null doc_id stays only in a group without any other. An empty
    table gives no rows, and all columns stay as they were.
    """
    return near_copies.keep_one(docs, groups=simhash.near_groups(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences to train on.

    Null and empty texts are the end id alone. Rows that repeat are packed each for itself, an empty table gives no rows,
    and only doc_id and text are read.
    """
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("packing", packing_stage),
]

#: Trained models, connected components and a tokenizer decide the rows; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage's rows are written to the shared folder, so a lost executor costs no earlier stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
