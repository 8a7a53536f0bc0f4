"""Line dedup: levelled sorted runs of line hashes.

Documents come in batches in order of doc_id. A run holds the hashes of lines first seen in some batches, hashed to
buckets and sorted. A batch is merge-anti-joined with the runs: hashes that no run has become a new run at level
zero, and lines whose hash an earlier run has are repeats. When a level has ``fanout`` runs they are compacted into
one run of the next level, so a batch meets a number of runs that grows with the logarithm of the batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm.common import ASCII_SPACE, ascii_lower, asked, integral, scratch

MIN_KEY = 10
#: A null doc_id comes after every other.
LAST_ID = 2**63 - 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def key_hash(key: Column) -> Column:
    """128 bits of the key."""
    return F.unhex(F.md5(key))


@contextmanager
def sorted_runs(spark: SparkSession) -> Iterator[None]:
    """While this lasts, Spark takes a bucket that is one sorted file as sorted, so a run is merged and not sorted anew."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class LineRuns:
    """The runs of line hashes, kept as bucketed and sorted tables in ``folder``; ``close`` drops them.

    A run is written from rows that are already hashed to as many partitions as it has buckets, so each bucket is one
    file, sorted by h.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 4, buckets: int | None = None):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.written: list[str] = []

    def write(self, hashes: DataFrame, level: int = 0) -> DataFrame:
        """A new run of hashes that no run has, read back."""
        name = f"line_run_{uuid.uuid4().hex}"
        self.written.append(name)
        hashes.write.bucketBy(self.buckets, "h").sortBy("h").option("path", f"{self.folder}/{name}").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return self.spark.table(name)

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def without(self, hashes: DataFrame) -> DataFrame:
        """The rows of hashes whose h is in no run: a merge with each."""
        for name in self.runs():
            hashes = hashes.hint("merge").join(self.spark.table(name).select("h").hint("merge"), "h", "left_anti")
        return hashes

    def compact(self) -> None:
        """Full levels become one run of the next: their sorted buckets are merged, without a shuffle."""
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self.spark.table(old[0]).select("h").hint("merge")
            for name in old[1:]:  # no two runs share a hash, so a full join is their merge
                merged = merged.join(self.spark.table(name).select("h").hint("merge"), "h", "full_outer")
            self.write(merged, level + 1)
            self._drop(old)
            level += 1

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.written.remove(name)

    def close(self) -> None:
        self._drop(list(self.written))
        self.levels = []


def fresh_hashes(runs: LineRuns, lines: DataFrame) -> DataFrame:
    """h, owner: the hashes of a batch that no run has, each with the smallest doc_id that holds it.

    Hashes are merged before the shuffle, so a line that a third of all documents have reaches it once for each
    map task.
    """
    return runs.without(lines.groupBy("h").agg(F.min("doc_id").alias("owner")))


def line_dedup(docs: DataFrame, batches: int = 4, fanout: int = 2, min_key: int = MIN_KEY) -> DataFrame:
    """Per row of docs: doc_id, text, n_lines, n_dropped, where text keeps the lines that stay, joined by \\n.

    A key of at least ``min_key`` code points that two or more documents have stays in the smallest doc_id only,
    with all its lines there; shorter keys always stay. Keys are compared by 128 bits of MD5. Null text and empty
    text are one empty line. A null doc_id comes last, and all null doc_ids are one document; rows that repeat a
    doc_id are one document too, each keeping its own lines. An empty table gives no rows. ``batches`` splits
    doc_id into ranges of about as many rows; the result is the same for any number. doc_id must be a whole number;
    other columns of docs are not read.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "lines")
    texts = integral(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"))
    texts = texts.withColumn("tag", F.xxhash64("text"))  # tells rows with one doc_id apart

    edges = texts.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 10_000)).first()[0] or [] if batches > 1 else []
    batch = F.lit(0)
    for edge in sorted(set(edges)):
        batch = batch + (F.col("id") > edge).cast("int")
    number = len(set(edges)) + 1

    # Every line that counts, once, narrow: what a batch needs of its documents.
    keyed = texts.select("id", "tag", batch.alias("batch"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = keyed.select("batch", "id", "tag", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_key)
    keyed.select("batch", "id", "tag", "pos", key_hash(F.col("key")).alias("h")).write.partitionBy("batch").parquet(f"{folder}/keys")
    keys = spark.read.schema("id long, tag long, pos int, h binary, batch int").parquet(f"{folder}/keys")

    runs = LineRuns(spark, folder, fanout)
    try:
        with sorted_runs(spark):
            for i in range(number):
                lines = keys.where(F.col("batch") == i).select(F.col("id").alias("doc_id"), "tag", "pos", "h")
                fresh = runs.write(fresh_hashes(runs, lines))
                dropped = lines.join(fresh, (lines["h"] == fresh["h"]) & (lines["doc_id"] == fresh["owner"]), "left_anti")
                dropped.select("doc_id", "tag", "pos").write.parquet(f"{folder}/dropped/{i}")
                runs.compact()
    finally:  # also where a batch fails, or the tables would stay in the catalog
        runs.close()

    gone = spark.read.schema("doc_id long, tag long, pos int").parquet(*[f"{folder}/dropped/{i}" for i in range(number)])
    gone.groupBy(F.col("doc_id").alias("id"), "tag").agg(F.sort_array(F.collect_set("pos")).alias("gone")).write.parquet(f"{folder}/gone")
    gone = spark.read.schema("id long, tag long, gone array<int>").parquet(f"{folder}/gone")
    lines = F.split("text", "\n")
    n_gone = F.coalesce(F.size("gone"), F.lit(0))
    # The lines between two dropped ones, for each gap: as many steps as the document has lines.
    gaps = F.expr("transform(sequence(0, size(gone)), i -> slice(lines, if(i = 0, 0, gone[i - 1] + 1) + 1, if(i = size(gone), size(lines), gone[i]) - if(i = 0, 0, gone[i - 1] + 1)))")
    # Texts that lose nothing stay where they are; of the others few can be told apart from those only by the join.
    none = F.lit(0).cast("long").alias("n_dropped")
    whole = asked(texts, gone, ["id", "tag"], "left_anti").select("doc_id", "text", F.size(lines).cast("long").alias("n_lines"), none)
    out = asked(texts, gone, ["id", "tag"]).join(gone, ["id", "tag"], "left").withColumn("lines", lines)
    left = out.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(gaps), "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(n_gone).cast("long").alias("n_dropped"),
    )
    return whole.unionByName(left)
