"""A keyed snapshot that is stored: upserts merged bucket by bucket, published at once, readable as of any version.

What is stored of a key is not its values alone but, for each column, the value and the place in the log that it comes from.
Such states merge in any order and any grouping, so a batch of changes is first folded by itself and then laid beside
what is there; only a bucket with many such files is rewritten, and late or repeated changes end where the whole log would.

``data/add=<id>/bucket=<n>`` has the files; ``versions`` has, for each version, one file that lists the folders of each bucket. It
appears by one rename, so a reader sees the version before or the new one, and never part of it. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from siftline.operators.fold import COALESCE, FIRST, LAST, MAX, MIN, NON_EMPTY

_VERSIONS = "version long, batch long, bucket int, path string"


def _told(column: str, rule: str) -> Column:
    """The place of a column's value in the log, where the rule lets it count."""
    c, at = F.col(f"{column}.value"), F.col(f"{column}.at")
    if rule == COALESCE:
        return F.when(c.isNotNull(), at)
    if rule == NON_EMPTY:
        return F.when(F.coalesce(c != "", F.lit(False)), at)
    return at


def _merged(column: str, rule: str) -> Column:
    """One column's state of several: value, and at as its place."""
    c = F.col(column)
    if rule in (LAST, COALESCE, NON_EMPTY):
        return F.max_by(c, _told(column, rule))
    if rule == FIRST:
        return F.min_by(c, F.col(f"{column}.at"))
    if rule in (MAX, MIN):
        best = F.max if rule == MAX else F.min
        return F.struct(best(f"{column}.value").alias("value"), F.max(f"{column}.at").alias("at"))
    raise ValueError(f"unknown rule {rule!r}")


class Snapshot:
    """M02 to M06, M15, M20 on stored state, in ``folder``, which all executors reach.

    rules: the rule of each column, as in ``fold``. seq is unique within a key and of one type for good; equal rows are one.
    ``buckets`` is fixed when the first batch is added. A bucket is rewritten once it has more than ``most_files`` folders.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], seq: str, rules: dict[str, str], buckets: int = 64, most_files: int = 4):
        self.spark, self.folder, self.keys, self.seq, self.rules = spark, folder.rstrip("/"), keys, seq, rules
        self.buckets, self.most_files = buckets, most_files

    def _listing(self, version: int | None = None) -> list:
        """The rows of the last version, or of the one asked for: at most a few for each bucket."""
        try:
            rows = self.spark.read.schema(_VERSIONS).parquet(f"{self.folder}/versions")
            wanted = rows.where(F.col("version") <= version) if version is not None else rows
            last = wanted.agg(F.max("version")).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [] if last is None else rows.where(F.col("version") == last).collect()

    def _publish(self, version: int, batch: int, folders: list[tuple[int, str]]) -> None:
        rows = [(version, batch, bucket, path) for bucket, path in folders] or [(version, batch, -1, "")]
        self.spark.createDataFrame(rows, _VERSIONS).coalesce(1).write.mode("append").parquet(f"{self.folder}/versions")

    def _merge(self, states: DataFrame) -> DataFrame:
        return states.groupBy("bucket", *self.keys).agg(*[_merged(c, r).alias(c) for c, r in self.rules.items()])

    def _write(self, states: DataFrame, tasks: int) -> list[tuple[int, str]]:
        """Writes states by bucket; the folders."""
        path = f"{self.folder}/data/add={uuid.uuid4().hex}"
        states.repartition(tasks, "bucket").write.partitionBy("bucket").parquet(path)
        found = self.spark.read.schema("bucket int").parquet(path).distinct().collect()
        return [(r.bucket, f"{path}/bucket={r.bucket}") for r in found]

    def _states(self, folders: list[tuple[int, str]], schema: StructType) -> DataFrame:
        """The states in those folders, each with its bucket."""
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/data").parquet(*[path for _, path in folders])

    def add(self, changes: DataFrame, batch: int) -> bool:
        """Merges a batch of changes: keys, seq and the rules' columns; False if the batch was added before.

        Batches have growing numbers; one that is repeated after a failure changes nothing. Copies of a key merge before
        the shuffle. Buckets without changes are not read.
        """
        listed = self._listing()
        if listed and listed[0].batch >= batch:
            return False
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")
        shaped = changes.select(bucket, *self.keys, *[F.struct(F.col(c).alias("value"), F.col(self.seq).alias("at")).alias(c) for c in self.rules])
        fresh = self._merge(shaped)
        folders = [(r.bucket, r.path) for r in listed if r.bucket >= 0] + self._write(fresh, self.buckets)
        count: dict[int, int] = {}
        for b, _ in folders:
            count[b] = count.get(b, 0) + 1
        full = {b for b, n in count.items() if n > self.most_files}
        if full:
            merged = self._merge(self._states([f for f in folders if f[0] in full], fresh.schema))
            folders = [f for f in folders if f[0] not in full] + self._write(merged, len(full))
        self._publish((listed[0].version if listed else 0) + 1, batch, folders)
        return True

    def last_batch(self) -> int:
        """The last batch that was added; -1 before any."""
        listed = self._listing()
        return listed[0].batch if listed else -1

    def version(self) -> int:
        """The last version; 0 before any."""
        listed = self._listing()
        return listed[0].version if listed else 0

    def read(self, version: int | None = None, buckets: set[int] | None = None) -> DataFrame | None:
        """keys and the rules' columns as of a version, the last by default, of all ``buckets`` or some; None before any."""
        folders = [(r.bucket, r.path) for r in self._listing(version) if r.bucket >= 0 and (buckets is None or r.bucket in buckets)]
        if not folders:
            return None
        schema = self.spark.read.parquet(folders[0][1]).schema.add("bucket", IntegerType())
        return self._merge(self._states(folders, schema)).select(*self.keys, *[F.col(f"{c}.value").alias(c) for c in self.rules])
