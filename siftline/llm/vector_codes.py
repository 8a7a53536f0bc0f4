"""Vector code compression: product codes whose nearest entries are found by segment-mean lower bounds.

A vector of whole numbers is cut into equal parts, and each part is coded by the nearest entry of its part's codebook. For
a part x and an entry c, cut alike into blocks of b components with means and residual norms (the length of what is left
beside the mean), the squared distance is at least the sum over blocks of b * (mean_x - mean_c)^2 + (norm_x - norm_c)^2.
Blocks go from the whole part to halves, quarters and so on. An entry whose bound, made smaller by more than its rounding
error, exceeds the exact distance to the most promising one is out; what survives gets its exact distance in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import frugal, map_rows, scratch, slices

PARTS, ENTRIES, ROUNDS, STEP = 16, 64, 2, 256
#: Beyond this components are handled as Python integers, which can't overflow.
_FAST = 1 << 20
#: The largest component; sums of any number of rows' components fit a decimal then.
MOST = 2**60
#: The largest error.
MOST_ERROR = 2**63 - 1
#: Labels up to this many are sent to all tasks; more are shuffled.
MOST_LABELS = 100_000


def whole(vectors: np.ndarray, step: int = STEP) -> np.ndarray:
    """floor(step * x), as int64 where all are small and as Python integers else, those beyond MOST in size being MOST."""
    scaled = vectors.astype(np.float64)
    if np.abs(scaled).max(initial=0) * step < _FAST:
        return np.floor(scaled * step).astype(np.int64)
    held = np.clip(np.floor(np.clip(scaled, -MOST, MOST) * step), -MOST, MOST)
    return np.array([[int(v) for v in row] for row in held.reshape(len(held), -1)], object).reshape(held.shape)


def _moments(parts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and residual norms of each part's blocks. b * sum(x^2) - sum(x)^2 is a whole number: nothing cancels."""
    cut = parts.reshape(*parts.shape[:-1], -1, block)
    total = cut.sum(-1)
    return total.astype(np.float64), np.sqrt((block * (cut * cut).sum(-1) - total * total).astype(np.float64) / block)


def _bounds(x: tuple, c: tuple, block: int) -> np.ndarray:
    """Below the exact squared distance, whatever the rounding."""
    apart = np.maximum(np.abs(x[1] - c[1]) - 1e-12 * (x[1] + c[1]), 0)
    return ((x[0] - c[0]) ** 2 / block + apart**2).sum(-1) * (1 - 1e-9)


def blocks(width: int) -> list[int]:
    """The widths of blocks, coarse to fine: halves as long as they are whole, down to two components."""
    out = [width]
    while out[-1] % 2 == 0 and out[-1] > 2:
        out.append(out[-1] // 2)
    return out


def nearest(parts: np.ndarray, entries: np.ndarray, tally: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The index of each part's nearest entry, ties to the lower, and its exact squared distance. parts (n, w), entries (k, w)."""
    n, k = len(parts), len(entries)
    if parts.dtype == object or entries.dtype == object:
        far = np.stack([((parts - e) ** 2).sum(1) for e in entries], 1)
        best = np.array([min(range(k), key=row.__getitem__) for row in far], np.int64)
        return best, far[np.arange(n), best]
    widths = blocks(parts.shape[1])
    low = _bounds([m[:, None] for m in _moments(parts, widths[0])], [m[None] for m in _moments(entries, widths[0])], widths[0])
    likely = low.argmin(1)
    most = ((parts - entries[likely]) ** 2).sum(1)
    row, entry = np.nonzero(low <= most[:, None])
    counted = [n * k, len(row)]
    for block in widths[1:]:
        x, c = _moments(parts, block), _moments(entries, block)
        stay = _bounds([m[row] for m in x], [m[entry] for m in c], block) <= most[row]
        row, entry = row[stay], entry[stay]
        counted.append(len(row))
    exact = ((parts[row] - entries[entry]) ** 2).sum(1)
    # np.nonzero goes through rows, and through a row's entries in order: of a row's least, the first is the lower index
    opens = np.searchsorted(row, np.arange(n))
    least = np.minimum.reduceat(exact, opens) if n else exact
    hits = np.flatnonzero(exact == least[row])
    best = entry[hits[np.searchsorted(row[hits], np.arange(n))]] if n else entry
    if tally is not None:
        for i, c in enumerate(counted):
            tally[f"level {i}"] = tally.get(f"level {i}", 0) + c
    return best, least


def usable(vectors: DataFrame, column: str, parts: int = PARTS) -> DataFrame:
    """vec_id, vector and label of the rows to code.

    Not those with a null vector, null or non-finite components, or another width than that of the smallest vec_id that is
    left. A width that ``parts`` does not divide can't be cut, so it counts as null. A null vec_id comes last.
    """
    vector = F.col(column)
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select("vec_id", vector.alias("vector"), "label").where(vector.isNotNull() & fine & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
    first = kept.select("vec_id", F.size("vector").alias("width")).orderBy(F.col("vec_id").asc_nulls_last(), "width").first()
    return kept.where(F.size("vector") == (first.width if first else 0))


def first_books(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, step: int = STEP) -> list[np.ndarray]:
    """One codebook a part: that part of the vectors with the ``entries`` smallest vec_ids, equal ids by their vectors."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not rows:
        return [np.zeros((0, 1), np.int64)] * parts
    seen = whole(np.array([r.vector for r in rows], np.float64), step).reshape(len(rows), parts, -1)
    return [seen[:, p] for p in range(parts)]


def _parts(column: pa.Array, parts: int, step: int) -> np.ndarray:
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return whole(flat, step).reshape(len(column), parts, -1)


def trained(kept: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS, step: int = STEP) -> list[np.ndarray]:
    """The codebooks after rounds of assigning every part and taking floor(sum / count); an entry without parts stays.

    A task adds up its parts by entry and hands over one row a component of an entry, as does the whole job to the driver.
    """
    parts = len(books)
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            counts = [np.zeros(len(b), np.int64) for b in books]
            totals = [np.zeros(b.shape, object) for b in books]
            for batch in batches:
                for part in slices(batch, 2048):
                    x = _parts(part.column(0), parts, step)
                    for p, book in enumerate(books):
                        best, _ = nearest(x[:, p], book)
                        used, at, n = np.unique(np.sort(best), return_index=True, return_counts=True)
                        counts[p][used] += n
                        totals[p][used] += np.add.reduceat(x[np.argsort(best, kind="stable"), p], at, axis=0)
            rows = [(p, e, i, int(n), Decimal(int(v))) for p in range(parts) for e, n in enumerate(counts[p]) if n for i, v in enumerate(totals[p][e])]
            if rows:
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "entry", "at", "n", "total"])

        sums = kept.select("vector").mapInArrow(frugal(run), "part int, entry int, at int, n long, total decimal(38,0)")
        new = [b.astype(object) for b in books]
        for r in sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            new[r.part][r.entry, r.at] = int(r.total) // r.n
        books = [b.astype(np.int64) if max(map(abs, b.ravel().tolist()), default=0) < _FAST else b for b in new]
    return books


def coded(kept: DataFrame, books: list[np.ndarray], step: int = STEP) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of each row."""
    parts = len(books)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _parts(batch.column("vector"), parts, step)
        found = [nearest(x[:, p], book) for p, book in enumerate(books)]
        codes = np.stack([best for best, _ in found], 1).astype(np.uint8)
        errors = [min(MOST_ERROR, sum(map(int, row))) for row in zip(*[far for _, far in found], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    return map_rows(kept.select("vec_id", "label", "vector"), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long", each, rows=2048)


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components, by part, entry and place."""
    return hashlib.sha256(",".join(str(v) for book in books for entry in book.tolist() for v in entry).encode()).hexdigest()


def compress(vectors: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, step: int = STEP) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, code, error, label_error of each row that can be coded; the codebooks).

    Which rows those are is said in ``usable``. Components are floor(step * x); one beyond 2^60 counts as 2^60, and an error
    beyond 2^63 - 1 is that. label_error is the sum of the errors of all rows with the row's label, nulls together, as a
    decimal. Fewer rows than ``entries`` give that many entries. Rows that repeat get the same code, an empty table gives no
    rows, and other columns are not read. ``entries`` is at most 256. Codebooks have a size fixed by the parameters and are
    sent to every task. Codes are written to the shared folder once and added up from there.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    spark, path = vectors.sparkSession, scratch(vectors.sparkSession, "codes")
    kept = usable(vectors, column, parts)
    books = trained(kept, first_books(kept, parts, entries, step), rounds, step)
    rows = coded(kept, books, step)
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    by_label = rows.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    if by_label.limit(MOST_LABELS + 1).count() <= MOST_LABELS:
        by_label = F.broadcast(by_label)
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error"), books
