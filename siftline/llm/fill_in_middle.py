"""Fill-in-middle transformation: texts cut at two of their units' ends, by overlapping chunks.

A unit is a line with its \\n (the last may have none). Texts are laid out as bytes and cut into chunks that overlap by
one byte, so whether a unit starts at a byte follows from it and the one before it alone: \\n, then anything. Chunks
count their starts independently; the prefix sums of the counts say which chunk owns the start of a given rank, and only
the two chunks that own a text's cuts are read again for the place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import map_rows

CHUNK = 1 << 13
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_NEWLINE = 10


def chunk_counts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, at, counts): text t's chunks are first[t] to first[t + 1], each with its place in data and its units' starts.

    Every chunk sees the byte before it; a text's first byte starts a unit whatever stands before it.
    """
    n_chunks = -(-(ends - starts) // chunk)
    first = np.r_[0, np.cumsum(n_chunks)]
    text = np.repeat(np.arange(len(starts)), n_chunks)
    at = starts[text] + (np.arange(first[-1]) - first[text]) * chunk
    stop = np.minimum(at + chunk, ends[text])
    after_newline = np.r_[False, data == _NEWLINE][: len(data)]
    counts = np.zeros(len(at), np.int64)
    if len(at):
        bounds = np.empty(2 * len(at), np.int64)
        bounds[0::2], bounds[1::2] = at, stop
        # reduceat over [at, stop), [stop, next at), ...; the last bound may be the end of the data, where nothing is left to add
        counts = np.add.reduceat(np.r_[after_newline, False].astype(np.int64), bounds)[0::2]
        opens = first[:-1][n_chunks > 0]
        counts[opens] += 1 - after_newline[at[opens]]
    return first, at, counts


def unit_starts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunks: tuple, text: np.ndarray, rank: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The place of the unit of each rank (from 0) of each text; the number of units itself is the text's end."""
    first, at, counts = chunks
    upto = np.r_[0, np.cumsum(counts)]
    out = ends[text].copy()
    inside = np.flatnonzero(rank < upto[first[text + 1]] - upto[first[text]])
    wanted = upto[first[text[inside]]] + rank[inside]
    owner = np.searchsorted(upto, wanted, "right") - 1
    for i, c, nth in zip(inside.tolist(), owner.tolist(), (wanted - upto[owner]).tolist(), strict=True):
        a, t = int(at[c]), text[i]
        hit = np.flatnonzero(data[max(a - 1, 0) : min(a + chunk, ends[t]) - 1] == _NEWLINE) + max(a - 1, 0) + 1
        hit = hit[(hit >= a) & (hit > starts[t])]
        if a == starts[t]:
            hit = np.r_[a, hit]
        out[i] = hit[nth]
    return out


def restored(output: bytes, form: str, tokens: tuple[bytes, bytes, bytes]) -> bytes:
    """The text that an output of this form was made of. No token can begin where another ends, so the first find is the one."""
    p, s, m = tokens
    if form == "plain":
        return output
    one, two = (p, s) if form == "psm" else (s, p)
    a, b, c = output.index(one), output.index(two), output.index(m)
    early, late, middle = output[a + len(one) : b], output[b + len(two) : c], output[c + len(m) :]
    return early + middle + late if form == "psm" else late + middle + early


def _points(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points between byte places: bytes that don't continue one."""
    upto = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    return upto[end] - upto[begin]


def fill_in_middle(
    docs: DataFrame,
    draws: list[Column],
    rate: int = 100,
    spm_rate: int = 50,
    tokens: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
    chunk: int = CHUNK,
) -> DataFrame:
    """Per row of docs: doc_id, n, form, prefix_chars, middle_chars, output, restored.

    ``draws`` are four whole numbers of a row. The prefix ends after the smaller of the first two, modulo the units + 1, the
    middle after the larger. A text stays plain if it is empty or contains one of ``tokens`` (prefix, suffix, middle), or
    if the third modulo 100 is ``rate`` or more; the fourth modulo 100 below ``spm_rate`` gives spm, else psm. Null text is
    empty: no units, plain. Nulls among the draws count as 0. output is what to train on, and restored is what is read
    back from it. Chars are null where the form is plain. Rows that repeat are cut alike, an empty table gives no rows, and
    other columns of docs are not read. A text of any length is one row's work; its arrays are a small multiple of it.
    """
    marks = tuple(t.encode() for t in tokens)
    if not all(marks) or any(a != b and a in b for a in marks for b in marks) or any(a[i:] == b[: len(a) - i] for a in marks for b in marks for i in range(1, len(a))):
        raise ValueError("a token must not be empty, part of another, or end as one begins")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or b"" for t in batch.column(1).to_pylist()]
        h = [c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        starts = np.r_[0, ends[:-1]]
        chunks = chunk_counts(data, starts, ends, chunk)
        upto = np.r_[0, np.cumsum(chunks[2])]
        n = upto[chunks[0][1:]] - upto[chunks[0][:-1]]
        one, two = h[0] % (n + 1), h[1] % (n + 1)
        plain = np.array([not t or any(m in t for m in marks) for t in texts], bool) | (h[2] % 100 >= rate)
        form = np.where(plain, "plain", np.where(h[3] % 100 < spm_rate, "spm", "psm"))
        cut = np.flatnonzero(~plain)
        both = unit_starts(data, starts, ends, chunks, np.r_[cut, cut], np.r_[np.minimum(one, two)[cut], np.maximum(one, two)[cut]], chunk)
        first, second = both[: len(cut)], both[len(cut) :]
        outputs = list(texts)
        for i, a, b in zip(cut.tolist(), (first - starts[cut]).tolist(), (second - starts[cut]).tolist(), strict=True):
            t = texts[i]
            p, m, s = t[:a], t[a:b], t[b:]
            outputs[i] = b"".join([marks[1], s, marks[0], p, marks[2], m] if form[i] == "spm" else [marks[0], p, marks[1], s, marks[2], m])
        chars = np.zeros((2, len(texts)), np.int64)
        chars[0, cut], chars[1, cut] = _points(data, starts[cut], first), _points(data, first, second)
        back = [restored(o, f, marks) for o, f in zip(outputs, form.tolist(), strict=True)]
        arrays = [batch.column(0), pa.array(n), pa.array(form.tolist(), pa.string()), *[pa.array(c, mask=plain) for c in chars]]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(outputs, pa.binary()), pa.array(back, pa.binary())], _NAMES)

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = [F.coalesce(d.cast("long"), F.lit(0)).alias(f"h{i}") for i, d in enumerate(draws)]
    made = map_rows(docs.select("doc_id", F.col("text").cast("binary").alias("text"), *numbers), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary, restored binary", each)
    return made.withColumn("output", F.col("output").cast("string")).withColumn("restored", F.col("restored").cast("string"))


_NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]


def seeded_draws(doc_id: Column, seed: str) -> list[Column]:
    """Four numbers below 2^32 from the SHA-256 of ``seed:doc_id``; a null doc_id is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
