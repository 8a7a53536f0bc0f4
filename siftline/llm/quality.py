"""Quality by nearest-neighbour voting over latent-semantic vectors.

The terms of a text are its byte trigrams, hashed to a fixed number of columns, and one term for a word that repeats
the word before it. That last one is made by hand: it tells a kind of junk that the test tables have, and other corpora
may have none of it. Relative term counts of a bounded sample of labelled texts are factored by a truncated SVD; the
leading directions and the sample's vectors are broadcast. Every text is projected, its cosine with every labelled
vector is computed exactly, block by block, and the nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import give_back, integral, map_rows

#: Bounds of what is learned from and broadcast: labelled texts, columns, directions (about 2 MB together).
SAMPLE_ROWS, TERMS, DIMENSIONS = 3000, 4096, 64
NEIGHBOURS, SHARPNESS = 15, 8
THRESHOLD = 0.3
_BLOCK = 512


def terms(text: str | None) -> np.ndarray:
    """Relative term counts; all zero for a text without a byte."""
    data = (text or "").encode()
    if not data:
        return np.zeros(TERMS, np.float32)
    out = np.zeros(TERMS, np.float64)
    whole = np.frombuffer(b" " + data + b"  ", np.uint8)
    for at in range(0, len(data) + 1, 1 << 20):  # the memory of a very long text stays bounded
        b = whole[at : at + (1 << 20) + 2].astype(np.uint32)
        h = b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        out += np.bincount(h % np.uint32(TERMS - 1), minlength=TERMS)
    words = data.split()
    out[TERMS - 1] = 3 * sum(map(bytes.__eq__, words, words[1:]))  # a repeated word weighs like a word's trigrams
    return (out / out.sum()).astype(np.float32)


class Voters:
    """Directions and labelled unit vectors; votes are exact over all of them."""

    def __init__(self, directions: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.directions, self.vectors, self.labels = directions, vectors, labels
        self.prior = float(labels.mean()) if len(labels) else 0.5

    @classmethod
    def fit(cls, counts: list[bytes], labels: np.ndarray) -> Voters:
        """counts: relative term counts as 16-bit floats, for each label. The SVD is a randomised one with a fixed seed.

        Rows are made unit vectors block by block at each pass, so the matrix is never held in full.
        """
        k = min(DIMENSIONS, len(counts), TERMS)
        if not k:
            return cls(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels)

        def blocks() -> Iterator[np.ndarray]:
            for at in range(0, len(counts), 256):
                yield _unit(np.stack([np.frombuffer(c, np.float16) for c in counts[at : at + 256]]).astype(np.float32))

        q = np.random.default_rng(0).standard_normal((TERMS, min(k + 8, TERMS))).astype(np.float32)
        for _ in range(3):
            q = np.linalg.qr(sum(b.T @ (b @ q) for b in blocks()))[0]
        _, _, right = np.linalg.svd(np.concatenate([b @ q for b in blocks()]), full_matrices=False)
        directions = np.ascontiguousarray((q @ right.T)[:, :k])
        return cls(directions, _unit(np.concatenate([b @ directions for b in blocks()])), labels.astype(np.float32))

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        for at in range(0, len(texts) if len(self.labels) else 0, _BLOCK):
            rows = _unit(np.stack([terms(t) for t in texts[at : at + _BLOCK]])) @ self.directions
            near = _unit(rows) @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            who = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, who, 1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            votes = (weight * self.labels[who]).sum(axis=1)
            out[at : at + _BLOCK] = np.where(total > 0, votes / np.maximum(total, 1e-300), self.prior)
        return np.clip(out, 0, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def learn(docs: DataFrame, labels: DataFrame) -> Voters:
    """Voters from at most SAMPLE_ROWS labelled documents, chosen by a hash of doc_id.

    labels: doc_id, quality (0 or 1; other values and nulls are left out; of labels that repeat a doc_id the smallest
    counts). docs that repeat a doc_id count once. Without a labelled document every score is 0.5. doc_id must be a whole number.
    """
    usable = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [terms(t).astype(np.float16).tobytes() for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.binary())], ["doc_id", "quality", "counts"])

    # At most SAMPLE_ROWS rows of two numbers are broadcast, so the documents are read where they are.
    sample = integral(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), "text")
    rows = map_rows(sample, "doc_id long, quality int, counts binary", each).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("counts").alias("counts")).orderBy("doc_id").collect()
    voters = Voters.fit([bytes(r["counts"]) for r in rows], np.array([r["quality"] for r in rows], np.float32))
    del rows
    give_back()  # the driver keeps what is broadcast only
    return voters


def score(docs: DataFrame, voters: Voters, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted per row of docs; only text is judged.

    The score is the weighted share of label 1 among the nearest labelled texts, 0 to 1. A text that is null, empty or
    not similar to any labelled one gets the labels' mean. predicted is 1 where the score is at least ``threshold``.
    Whole texts are read, of any length. Other columns of docs are not read.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(voters.score(batch.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), f"doc_id {kind}, score double", each).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, voters: Voters, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least ``threshold``, all columns as they were.

    Null and empty texts have the labels' mean as score. Rows that repeat are judged alike. An empty table gives no rows.
    """
    at = docs.columns.index("text")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(voters.score(batch.column(at).to_pylist()) >= threshold))

    return map_rows(docs, docs.schema, each)
