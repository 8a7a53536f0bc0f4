"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from siftline.operators.graph import labels
from siftline.operators.order import cut, shared_folder

#: The characters that count as white space in every contract: [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: Bytes of text that a worker handles at once, but for a single text that has more.
MOST_BYTES = 8 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def scratch(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nobody else writes."""
    return f"{shared_folder(spark).rstrip('/')}/siftline-{what}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of df: later plans read files that survive the loss of any executor."""
    return cut(df)


def integral(docs: DataFrame) -> DataFrame:
    """docs, whose doc_id must be a column of whole numbers: other types are an error here rather than in a task."""
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"doc_id must be a whole number, not {kind.simpleString()}")
    return docs


def is_held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of doc_id as text, modulo modulus, equals remainder; a null doc_id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is. All-ASCII values take the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def give_back() -> None:
    """Returns memory that this process has freed to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def sweep(spark: SparkSession) -> None:
    """Deletes shuffle files that nothing can read any more.

    Spark deletes them once the driver has collected the objects that stand for them, which an idle driver may not do for
    half an hour; a job of many rounds asks for it, so that its disk holds one round.
    """
    give_back()
    spark._jvm.System.gc()


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of edges (u, v); each round's shuffle files are swept away."""
    pairs = edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
    return labels(pairs, after_round=lambda: sweep(edges.sparkSession))


#: Slots of the set of keys that ``asked`` sends to all tasks: at most so many numbers, however many keys there are.
SLOTS = 1 << 20


def asked(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Rows that may have a partner in keys, or surely have none (left_anti), told where they lie by slots of their key.

    What has surely none need not be shuffled for a join. The more keys there are the more slots are taken, up to all.
    """
    slot = lambda df: F.pmod(F.xxhash64(*[df[c] for c in on]), F.lit(SLOTS))
    taken = keys.select(slot(keys).alias("_slot")).distinct()
    return rows.join(F.broadcast(taken), slot(rows) == F.col("_slot"), how)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, after which the worker gives the memory that it no longer uses back to the machine.

    Python workers stay for the next task; what they hold meanwhile is lost to the executor's JVM beside them.
    """

    @wraps(run)
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return inner


def slices(batch: pa.RecordBatch, rows: int = 512, most_bytes: int = MOST_BYTES) -> Iterator[pa.RecordBatch]:
    """batch in parts of at most ``rows`` rows and ``most_bytes`` of text; a row that alone has more is a part of its own."""
    size = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    upto, at = np.r_[0, np.cumsum(size)], 0
    while at < batch.num_rows:
        end = int(np.searchsorted(upto, upto[at] + most_bytes, "right")) - 1
        end = min(max(end, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def map_rows(df: DataFrame, schema: str, each: Callable[[pa.RecordBatch], pa.RecordBatch | None], rows: int = 512, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Arrow batches of at most ``rows`` rows and ``most_bytes`` of text through ``each``: memory is bounded by both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows, most_bytes):
                out = each(part)
                if out is not None:
                    yield out

    return df.mapInArrow(frugal(run), schema)
