"""Stages that are written once, listed with the hashes of their files, and resumed only if nothing has changed."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siftline.sources.files import inventory

LEDGER = "stage string, path string, sha256 string, byte_count long"


class IntegrityError(RuntimeError):
    """A stage's files or its configuration aren't what they were."""


def canonical_json(*columns: str) -> F.Column:
    """Compact JSON of the columns in order of their names; a null is said as null, so it differs from no column."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def content_hash(df: DataFrame) -> DataFrame:
    """Rows and a hash of them that doesn't depend on their order: the sums of eight words of each row's SHA-512.

    Sums merge before the shuffle; a hash over one sorted document would need all rows in one place.
    """
    row = F.sha2(canonical_json(*df.columns), 512)
    words = [F.conv(F.substring(row, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)").alias(f"w{i}") for i in range(8)]
    sums = [F.coalesce(F.sum(f"w{i}"), F.lit(0)).cast("string") for i in range(8)]
    return df.select(*words).agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(F.concat_ws(":", F.count(F.lit(1)), *sums), 256).alias("content_hash"))


def configuration_hash(configuration: dict) -> str:
    """X08"""
    return hashlib.sha256(json.dumps(configuration, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def write_counted(frame: DataFrame, path: str, stage: str, counters: dict[str, Column]) -> DataFrame:
    """Writes a frame and says what was written: stage, counter and value, without reading anything again.

    counters: aggregates by name, of whole numbers. They are observed by the tasks that write, so a stage's manifest costs no second pass.
    An output that is there already is an error.
    """
    seen = Observation(f"{stage}-{uuid.uuid4().hex}")
    frame.observe(seen, *[c.cast("long").alias(n) for n, c in counters.items()]).write.parquet(path)
    found = seen.get
    return frame.sparkSession.createDataFrame([(stage, n, found[n]) for n in counters], "stage string, counter string, value long")


class Run:
    """A run in a folder: ``folder/stage/frame`` for each frame, ``folder/_ledger/stage`` for what was written."""

    def __init__(self, spark: SparkSession, folder: str, configuration: dict | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.configuration = configuration_hash(configuration or {})

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def write(self, stage: str, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The frames, each written whole or not at all, then their ledger, which makes the stage complete."""
        for name, frame in frames.items():
            frame.write.mode("overwrite").parquet(f"{self.folder}/{stage}/{name}")
        rows = inventory(self.spark, f"{self.folder}/{stage}").select(F.lit(stage).alias("stage"), "path", "sha256", "byte_count", F.lit(self.configuration).alias("configuration"))
        rows.write.mode("overwrite").parquet(f"{self.folder}/_ledger/{stage}")
        return self.read(stage, list(frames))

    def read(self, stage: str, names: list[str]) -> dict[str, DataFrame]:
        return {n: self.spark.read.parquet(f"{self.folder}/{stage}/{n}") for n in names}

    def completed(self, stage: str) -> bool:
        return self._exists(f"{self.folder}/_ledger/{stage}/_SUCCESS")

    def problems(self, stage: str) -> DataFrame:
        """Path and problem (missing, length, hash, configuration) of each file that isn't as the ledger has it."""
        ledger = self.spark.read.parquet(f"{self.folder}/_ledger/{stage}")
        now = inventory(self.spark, f"{self.folder}/{stage}").select("path", F.col("sha256").alias("now_sha"), F.col("byte_count").alias("now_bytes"))
        problem = F.when(F.col("now_sha").isNull(), "missing").when(F.col("byte_count") != F.col("now_bytes"), "length").when(F.col("sha256") != F.col("now_sha"), "hash").when(F.col("configuration") != self.configuration, "configuration")
        return ledger.join(now, "path", "left").select("path", problem.alias("problem")).where("problem is not null")

    def stage(self, stage: str, names: list[str], make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """The stage's frames: read if it is complete and intact, made and written if it isn't complete, an error if it was changed."""
        if self.completed(stage):
            if bad := self.problems(stage).take(3):
                raise IntegrityError(f"{stage}: " + "; ".join(f"{r['problem']}: {r['path']}" for r in bad))
            return self.read(stage, names)
        return self.write(stage, make())

    def manifest(self, stages: list[str]) -> DataFrame:
        """Per completed stage its files and bytes."""
        done = [s for s in stages if self.completed(s)]
        if not done:
            return self.spark.createDataFrame([], "stage string, files long, bytes long")
        rows = self.spark.read.parquet(*[f"{self.folder}/_ledger/{s}" for s in done])
        return rows.groupBy("stage").agg(F.count(F.lit(1)).alias("files"), F.sum("byte_count").alias("bytes"))
