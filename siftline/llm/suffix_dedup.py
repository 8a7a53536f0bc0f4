"""Suffix-array dedup: bytes in strings of a given length that start at two or more places are removed.

A window is a string of ``length`` bytes at one place. Windows that are equal agree in the least hash of the shorter
strings (half as long) in them, so windows in a row with one least hash are a segment, dealt by that hash to a bucket.
A bucket with one segment, in which the least string is there once, holds no repeat; where all its segments are one such
text, all of it repeats. The others' segments are put in suffix order (see ``lyndon``), each different text once: equal
windows are neighbours there, and neighbours are compared byte by byte.

A bucket with more than ``most`` different segments is hot: a passage shorter than a window that very many texts have.
Its segments are dealt anew by the least hash under another function, at last by 128 bits of each window, where
all segments of a bucket are one text. So no bucket is unbounded, and no window meets only some of those equal to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import asked, frugal, integral, map_rows, scratch, slices
from siftline.llm.lyndon import suffix_order

LENGTH = 400
#: Different segments of a bucket that are put in one suffix order.
MOST_SEGMENTS = 64
#: Times that a hot bucket is dealt anew by a least hash before it is dealt by whole windows.
DEALS = 2
#: Bytes of segments ordered at once, and of text hashed at once.
BATCH, PIECE = 1 << 18, 1 << 18
#: A key with more than one row in so many is hot, so there are at most so many hot keys.
HOT_SHARE = 2000
LAST_ID = 2**63 - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


# ---- windows and segments, in tasks ----------------------------------------------------------------------------------


def _powers(base: int, n: int) -> np.ndarray:
    """base to the power of 0, 1, ..., n - 1, modulo 2^64."""
    return _all_powers(base, 1 << n.bit_length())[:n]


@cache
def _all_powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = x ^ np.uint64(seed * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def string_hashes(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """64 bits of each string of ``length`` bytes in data."""
    n = len(data)
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=upto[1:])
    return _mixed((upto[length:] - upto[:-length]) * _powers(_INVERSE, n)[: n - length + 1], seed)


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row: of a block's end and the next one's beginning."""
    n = len(values) - width + 1
    blocks = np.r_[values, np.full(-len(values) % width, np.uint64(2**64 - 1))].reshape(-1, width)
    begun = np.minimum.accumulate(blocks, 1).ravel()
    rest = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(rest[:n], begun[width - 1 : width - 1 + n])


def segments(texts: list[bytes], length: int, deal: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, at, n, key, a, b, twin) of the segments of texts, in parts: n windows from byte ``at``; a, b are 128 bits of them.

    twin: the least string is there more than once, so windows of one segment may be equal. The last deal makes every window a segment. Texts longer than a piece are cut into pieces that share no window.
    """
    small = max(1, length // 2)
    pieces = [(i, at, min(at + PIECE + length - 1, len(t))) for i, t in enumerate(texts) for at in range(0, len(t) - length + 1, PIECE)]
    begin = 0
    while begin < len(pieces):
        end, size = begin, 0
        while end < len(pieces) and (end == begin or size + pieces[end][2] - pieces[end][1] <= PIECE):
            size += pieces[end][2] - pieces[end][1]
            end += 1
        joined = b"".join([texts[i][a:b] for i, a, b in pieces[begin:end]])
        data = np.frombuffer(joined, np.uint8)
        stops = np.cumsum([b - a for _, a, b in pieces[begin:end]])
        starts = np.r_[0, stops[:-1]]
        inside = np.zeros(len(data) + 1, np.int64)
        inside[starts] += 1
        np.subtract.at(inside, stops - length + 1, 1)
        valid = np.cumsum(inside)[: len(data) - length + 1] > 0
        if deal > DEALS:
            key = string_hashes(data, length, deal)
            at = np.flatnonzero(valid)
            n = np.ones(len(at), np.int64)
            twin = np.zeros(len(at), bool)
        else:
            hashes, width = string_hashes(data, small, deal), length - small + 1
            key = least_of(hashes, width)
            new = np.r_[True, key[1:] != key[:-1]]
            new[starts[starts < len(new)]] = True
            edge = np.r_[np.flatnonzero(new | ~valid), len(key)]
            run = np.flatnonzero(new & valid)
            n = edge[np.searchsorted(edge, run, "right")] - run
            times = -(-n // length)  # a hash that stays least for long (a text that repeats itself) makes several segments
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at = np.repeat(run, times) + nth * length
            n = np.minimum(np.repeat(n, times) - nth * length, length)
            view = np.lib.stride_tricks.sliding_window_view(hashes, width)
            twin = np.zeros(len(at), bool)
            for i in range(0, len(at), 4096):
                a, m = at[i : i + 4096], n[i : i + 4096]
                hit = key[a][:, None]
                one, other = (view[a] == hit).argmax(1), (view[a + m - 1] == hit)[:, ::-1].argmax(1)
                twin[i : i + 4096] = a + one != a + m - 1 + width - 1 - other
        content = b"".join([xxhash.xxh3_128_digest(joined[s:e], 7) for s, e in zip(at.tolist(), (at + n + length - 1).tolist(), strict=True)])
        bits = np.frombuffer(content, np.int64).reshape(-1, 2)
        piece = np.searchsorted(stops, at, "right")
        text = np.array([p[0] for p in pieces[begin:end]], np.int64)
        offset = np.array([p[1] for p in pieces[begin:end]], np.int64) - starts
        yield text[piece], at + offset[piece], n, key[at].view(np.int64), bits[:, 0], bits[:, 1], twin
        begin = end


def repeats_in(buckets: list[list[bytes]], length: int) -> list[list[np.ndarray]]:
    """For each segment of each bucket whether each of its windows is also elsewhere in the bucket."""
    parts, bounds = [b"\0"], [0, 1]
    for bucket in buckets:
        parts += [part for body in bucket for part in (body, b"\0")]
        bounds.append(bounds[-1] + sum(len(body) + 1 for body in bucket))
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(body) for bucket in buckets for body in bucket])
    starts = np.cumsum(sizes + 1) - sizes
    symbols = np.zeros(len(data), np.int64)
    body = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[body] = data[body].astype(np.int64) + 1  # UTF-8 has no byte 255
    window = np.zeros(len(data) + 1, np.int64)
    window[starts] += 1
    np.subtract.at(window, starts + sizes - length + 1, 1)
    window = np.cumsum(window)[: len(data)] > 0

    order = suffix_order(symbols, np.array(bounds))
    a, b = order[:-1], order[1:]
    inner = np.ones(len(order) - 1, bool)
    inner[np.array(bounds[1:-1]) - 1] = False
    both = inner & window[a] & window[b]
    a, b = a[both], b[both]
    wide = 8 if length >= 8 else 1
    words = np.ndarray((len(data),), f"<u{wide}", np.r_[data, np.zeros(8, np.uint8)].tobytes(), 0, (1,))
    for at in [*range(0, length - wide + 1, wide), length - wide]:
        same = words[a + at] == words[b + at]
        a, b = a[same], b[same]
    hit = np.zeros(len(data), bool)
    hit[a] = hit[b] = True
    flags = iter(hit[s : s + n - length + 1] for s, n in zip(starts.tolist(), sizes.tolist(), strict=True))
    return [[next(flags) for _ in bucket] for bucket in buckets]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(at, n) of each run of true flags."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return list(zip(edge[0::2].tolist(), (edge[1::2] - edge[0::2]).tolist(), strict=True))


# ---- the search, on Spark ---------------------------------------------------------------------------------------------

_SEGMENT = ["key", "a", "b"]


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def _joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """left with what right has for its key; right has one row a key, with ``c``, the key's rows in left.

    Keys with more than one row in 2,000 of left are met where its rows lie: there can't be more than 2,000 of them. Both
    sides are split by one test of the key.
    """
    most = left.count() // HOT_SHARE + 1
    name = F.xxhash64(*on)
    hot = [r[0] for r in right.where(F.col("c") > most).select(name).distinct().collect()]
    if not hot:
        return left.join(right, on)
    is_hot = name.isin(hot)
    return left.where(is_hot).join(F.broadcast(right.where(is_hot)), on).unionByName(left.where(~is_hot).join(right.where(~is_hot), on))


_SPANS = "array<struct<at:long,n:long>>"


def _span(at: Column, n: Column) -> Column:
    return F.array(F.struct(at.cast("long").alias("at"), n.cast("long").alias("n"))).cast(_SPANS)


def _united(spans: Column) -> Column:
    """Runs of windows in order, those that overlap or touch as one."""
    end = lambda s: s["at"] + s["n"]
    longer = lambda last, s: F.struct(last["at"].alias("at"), (F.greatest(end(last), end(s)) - last["at"]).alias("n"))

    def add(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joins = F.coalesce(s["at"] <= end(last), F.lit(False))
        return F.when(joins, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer(last, s)))).otherwise(F.array_append(done, s))

    return F.aggregate(F.array_sort(spans), F.array().cast(_SPANS), add)


def _deal(sources: DataFrame, length: int, deal: int) -> DataFrame:
    """ref, at, n, key, a, b, twin of the segments of sources (ref, body)."""
    schema = sources.select("ref").schema
    kind = schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most_bytes=4 * PIECE):
                refs = part.column(0)
                for text, *columns, twin in segments(part.column(1).to_pylist(), length, deal):
                    yield pa.RecordBatch.from_arrays([refs.take(pa.array(text)), *[pa.array(c, pa.int64()) for c in columns], pa.array(twin)], ["ref", "at", "n", *_SEGMENT, "twin"])

    long = sources.where(F.octet_length("body") >= length).select("ref", "body")
    return long.mapInArrow(frugal(run), f"ref {kind}, at long, n long, key long, a long, b long, twin boolean")


def _ordered(bodies: DataFrame, length: int) -> DataFrame:
    """key, a, b, found (at, n of runs of windows) of bodies (key, a, b, body), which come with a bucket's rows together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[list[tuple[int, int, int]]] = []
        bodies: list[list[bytes]] = []
        held, last = 0, None

        def out() -> pa.RecordBatch | None:
            rows = [(*name, _runs(flags)) for some, found in zip(names, repeats_in(bodies, length), strict=True) for name, flags in zip(some, found, strict=True) if flags.any()]
            if not rows:
                return None
            spans = pa.array([[{"at": x, "n": y} for x, y in r[3]] for r in rows], pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())])))
            return pa.RecordBatch.from_arrays([*[pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], spans], [*_SEGMENT, "found"])

        for batch in batches:
            for part in slices(batch, 1024):
                for row in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if row[:3] == last:  # a source row that repeats
                        continue
                    if last is None or row[0] != last[0]:
                        if held >= BATCH:
                            made = out()
                            if made is not None:
                                yield made
                            names, bodies, held = [], [], 0
                        names.append([])
                        bodies.append([])
                    last = row[:3]
                    names[-1].append(last)
                    bodies[-1].append(row[3])
                    held += len(row[3])
        if names:
            made = out()
            if made is not None:
                yield made

    return bodies.select(*_SEGMENT, "body").mapInArrow(frugal(run), "key long, a long, b long, found array<struct<at:long,n:long>>")


def repeated_windows(sources: DataFrame, length: int = LENGTH, most: int = MOST_SEGMENTS, deal: int = 0) -> DataFrame:
    """ref, spans: runs of n windows from byte ``at`` that start at other places, too, for sources (ref, body).

    A ref may have several rows. Rows with one ref and one body count as two texts, and both are met by what is found for the ref.
    """
    spark, folder = sources.sparkSession, scratch(sources.sparkSession, f"repeats{deal}")
    dealt = _written(_deal(sources, length, deal), folder, "dealt")
    keys = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("c"), ((F.min("a") != F.max("a")) | (F.min("b") != F.max("b")) | F.max("twin")).alias("several"))
    keys = _written(keys.where("c > 1 or several"), folder, "keys")
    again = _written(_joined(dealt.drop("twin"), keys, ["key"]).drop("c"), folder, "again")
    whole = again.where("not several").select("ref", _span(F.col("at"), F.col("n")).alias("spans"))
    if not keys.where("several").limit(1).count():
        return whole

    mixed = again.where("several").drop("several")
    texts = mixed.groupBy(*_SEGMENT).agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("ref", "at", "n")).alias("first"))
    texts = _written(texts, folder, "texts")
    width = _written(texts.groupBy("key").agg(F.count(F.lit(1)).alias("c")), folder, "width")
    wanted = _joined(texts, width, ["key"]).select(F.col("first.ref").alias("ref"), F.struct(*_SEGMENT, (F.col("c") > most).alias("hot"), F.col("first.at").alias("at"), F.col("first.n").alias("n")).alias("s"))
    wanted = _written(wanted.groupBy("ref").agg(F.collect_list("s").alias("wanted")), folder, "wanted")
    part = lambda s: F.substring(F.col("body"), (s["at"] + 1).cast("int"), (s["n"] + length - 1).cast("int"))
    cut = F.transform("wanted", lambda s: F.struct(*[s[c].alias(c) for c in (*_SEGMENT, "hot")], part(s).alias("body")))
    bodies = asked(sources.select("ref", "body"), wanted, ["ref"]).join(wanted, "ref").select(F.explode(cut).alias("s")).select("s.*")
    bodies = _written(bodies, folder, "bodies")

    size = bodies.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    tasks = size // (32 * BATCH) + spark.sparkContext.defaultParallelism
    found = _ordered(bodies.where("not hot").repartition(tasks, "key").sortWithinPartitions(*_SEGMENT), length)
    hot = bodies.where("hot")
    if not hot.isEmpty():
        anew = repeated_windows(hot.dropDuplicates(_SEGMENT).select(F.struct(*_SEGMENT).alias("ref"), "body"), length, most, deal + 1)
        found = found.unionByName(anew.select("ref.*", F.col("spans").alias("found")))
    copies = texts.where("times > 1").select(*_SEGMENT, _span(F.lit(0), F.col("first.n")).alias("found"))
    found = found.unionByName(copies).groupBy(*_SEGMENT).agg(_united(F.flatten(F.collect_list("found"))).alias("found"))
    found = _written(found.join(texts.select(*_SEGMENT, F.col("times").alias("c")), _SEGMENT), folder, "found")
    moved = F.transform("found", lambda f: F.struct((F.col("at") + f["at"]).alias("at"), f["n"].alias("n")))
    return whole.unionByName(_joined(mixed, found, _SEGMENT).select("ref", moved.cast(_SPANS).alias("spans")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, most: int = MOST_SEGMENTS) -> DataFrame:
    """Per row of docs: doc_id, kept (bytes), n_bytes, n_removed, n_spans.

    A byte goes if a string of ``length`` bytes over it starts at another place, too, in any text's UTF-8; such strings
    may overlap, don't cross texts, and are judged on the texts as they come in. n_spans counts the runs of bytes that
    go. What is kept may not be UTF-8, where a cut goes through a code point. Null text is empty. Rows that repeat repeat
    all their strings; a null doc_id is a document like any other. Texts below ``length`` bytes stay whole. An empty
    table gives no rows. doc_id must be a whole number; other columns of docs are not read.
    """
    if length < 1 or most < 1:
        raise ValueError("length and most must be 1 or more")
    kind = docs.schema["doc_id"].dataType.simpleString()
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # doc_id and 128 bits of the text name a row; rows that share both have the same strings
    ref = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("tag"))
    texts = integral(docs).select("doc_id", body.alias("body"), ref.alias("ref"))
    folder = scratch(docs.sparkSession, "spans")
    spans = repeated_windows(texts.select("ref", "body"), length, most)
    spans = _written(spans.groupBy("ref").agg(_united(F.flatten(F.collect_list("spans"))).alias("spans")), folder, "spans")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            kept, upto, removed, runs = [], 0, 0, 0
            for at, end in sorted((s["at"], s["at"] + s["n"] + length - 1) for s in found or []):
                if end <= upto:
                    continue
                runs += at > upto or not removed
                kept.append(text[upto:at])
                removed += end - max(at, upto)
                upto = end
            kept.append(text[upto:])
            rows.append((b"".join(kept), len(text), removed, runs))
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.binary()), *[pa.array(c, pa.int64()) for c in columns[1:]]], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    some = asked(texts, spans, ["ref"]).join(spans, "ref", "left").select("doc_id", "body", "spans")
    made = map_rows(some, f"doc_id {kind}, kept binary, n_bytes long, n_removed long, n_spans long", each)
    none = F.lit(0).cast("long")
    rest = asked(texts, spans, ["ref"], "left_anti").select("doc_id", F.col("body").alias("kept"), F.octet_length("body").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"))
    return made.unionByName(rest)
