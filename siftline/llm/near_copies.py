"""Near copies by a prefix filter over shingles and exact shingle similarity.

A text is the set of its distinct five-word shingles, so repeats count for nothing. All sets are sorted in one order. Two
sets with a Jaccard similarity of t share at least t of each, so the first of those that they share is among the first
1 - t of both (and one more): texts that share none of these prefixes need no comparison, and no pair is lost. The order
puts shingles that a sample of the texts shows to be common last; any order is right, this one makes few candidates.

Of texts that share a prefix's shingle, those whose sizes or parity bits differ by more than similar sets can are
dropped; that, too, loses no pair. The others' shingles are then compared exactly, and only links of at least the asked
similarity count.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import components, cut_lineage, frugal, integral, map_rows, sweep
from siftline.llm.simhash import shingles

WIDTH, SIMILARITY = 5, 0.8
#: Texts that common shingles are looked for in, about, and the most common ones of which the order takes account.
SAMPLE_TEXTS, COMMON_SHINGLES = 4096, 32_768
#: Words of 64 parity bits of a small set, and of the largest; each step between is four times the one before.
PARITY_WORDS, MOST_PARITY_WORDS = 16, 256
#: Texts with one shingle that one task compares; more meet the first of them and then only those that aren't near it.
BUCKET_CHUNK = 4096
#: Bytes of text whose shingles one task compares at once, about; larger candidate groups are dealt in the same way.
CHUNK_BYTES = 4 << 20


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    return np.unique(np.array([xxhash.xxh64_intdigest(s) for s in shingles(text, width)], np.uint64))


def similar(a: frozenset, b: frozenset, least: float) -> bool:
    """Jaccard similarity of at least ``least``; two texts without a word are equal."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(a & b)
    return both >= least * (len(a) + len(b) - both)


def spanning_links(sets: list[frozenset], least: float) -> list[tuple[int, int]]:
    """Pairs that join what all similar pairs join: breadth first, so that a text meets those not yet reached only."""
    left, out = dict.fromkeys(range(len(sets))), []
    while left:
        seed = next(iter(left))
        del left[seed]
        queue = [seed]
        for x in queue:
            reached = [y for y in left if similar(sets[x], sets[y], least)]
            for y in reached:
                del left[y]
                out.append((x, y))
            queue += reached
    return out


def meetings(base: DataFrame, key: str, most: int, payload: list[str], make: Callable[[DataFrame], DataFrame], near: Callable) -> tuple[DataFrame, DataFrame | None]:
    """key, low, high, tag and payload: tasks (key, low, high) in which rows of a key meet; and u, v: what is joined before.

    base: key, tag (distinct in a key), weight; ``make`` gives its rows their payload. A key with at most ``most`` weight is
    one task. In a larger one, rows meet the one of smallest tag first, and ``near`` says which are near it: those are joined
    through it, so they need not meet each other. They meet the other rows in tasks of about three times ``most`` at most, and
    these meet each other. So a key whose rows are all near one of them costs one comparison a row, and no pair is lost.
    """
    columns = [key, "low", "high", "tag", *payload]
    large = cut_lineage(base.groupBy(key).agg(F.sum("weight").alias("whole")).where(F.col("whole") > most))
    if large.isEmpty():
        return make(base).withColumns({"low": F.lit(0), "high": F.lit(0)}).select(columns), None
    small = make(base.join(large, key, "left_anti")).withColumns({"low": F.lit(0), "high": F.lit(0)}).select(columns)
    big = cut_lineage(make(base.join(large.select(key), key, "left_semi")).select(key, "tag", "weight", *payload))
    first = big.groupBy(key).agg(F.min_by(F.struct("tag", *payload), "tag").alias("first"))
    both = big.join(first, key).select(big["*"], *[F.col(f"first.{c}").alias(f"first_{c}") for c in ["tag", *payload]])

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        is_near = near([batch.column(c) for c in payload], [batch.column(f"first_{c}") for c in payload])
        kept = [key, "tag", "weight", *payload, "first_tag"]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(is_near, pa.bool_())], [*kept, "near"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in big.schema)
    judged = cut_lineage(map_rows(both, f"{fields}, first_tag long, near boolean", each))
    parts = lambda c: F.ceil(F.col(c) / most).cast("int")
    apart = judged.where("not near").groupBy(key).agg(F.sum("weight").alias("apart")).join(large, key).select(key, parts("whole").alias("lows"), parts("apart").alias("highs"))
    dealt = judged.join(apart, key).withColumns({c: F.pmod(F.xxhash64("tag"), F.col(f"{c}s")).cast("int") for c in ("low", "high")})
    as_any = F.transform(F.sequence(F.lit(0), F.col("highs") - 1), lambda x: F.struct(F.col("low").alias("low"), x.alias("high")))
    as_apart = F.transform(F.sequence(F.lit(0), F.col("lows") - 1), lambda x: F.struct(x.alias("low"), F.col("high").alias("high")))
    dealt = dealt.withColumn("at", F.explode(F.when(F.col("near"), as_any).otherwise(F.array_union(as_any, as_apart))))
    dealt = dealt.withColumns({"low": F.col("at.low"), "high": F.col("at.high")}).select(columns)
    return small.unionByName(dealt), judged.where("near and tag <> first_tag").select(F.col("first_tag").alias("u"), F.col("tag").alias("v"))


def verified_links(texts: DataFrame, least: float, width: int, chunk_bytes: int) -> DataFrame:
    """u, v: spanning links between tags. texts: comp, tag, text, weight (the text's bytes), distinct tags.

    A group with more than ``chunk_bytes`` of text is dealt to several tasks by ``meetings``.
    """

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [shingle_set((t or "").encode(), width).tobytes() for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary()), batch.column(3)], ["comp", "tag", "set", "weight"])

    def make(some: DataFrame) -> DataFrame:
        return map_rows(some.select("comp", "tag", "text", "weight"), "comp long, tag long, set binary, weight long", sets)

    def near(own: list[pa.Array], first: list[pa.Array]) -> list[bool]:
        def of(column: pa.Array) -> list[np.ndarray]:
            return [np.frombuffer(data, np.uint64) for data in column.to_pylist()]

        def alike(a: np.ndarray, b: np.ndarray) -> bool:
            both = len(np.intersect1d(a, b, assume_unique=True))
            return both >= least * (len(a) + len(b) - both)

        return [alike(a, b) for a, b in zip(of(own[0]), of(first[0]), strict=True)]

    rows, joined = meetings(texts, "comp", chunk_bytes, ["set"], make, near)
    keys = ["comp", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tags, held = None, [], []

        def found() -> pa.RecordBatch:
            pairs = spanning_links(held, least)
            return pa.RecordBatch.from_arrays([pa.array([tags[i] for i, _ in pairs], pa.int64()), pa.array([tags[j] for _, j in pairs], pa.int64())], ["u", "v"])

        for batch in batches:
            for comp, low, high, tag, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (comp, low, high) != key:
                    if len(tags) > 1:
                        yield found()
                    key, tags, held = (comp, low, high), [], []
                tags.append(tag)
                held.append(frozenset(np.frombuffer(data, np.uint64).tolist()))
        if len(tags) > 1:
            yield found()

    met = rows.repartition(*keys).sortWithinPartitions(*keys, "tag").mapInArrow(frugal(compare), "u long, v long")
    return (met.unionByName(joined) if joined is not None else met).distinct()


def common_shingles(docs: DataFrame, texts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample have, sorted, and in how many of them. They order the shingles, no more."""
    every, tag = max(1, texts // SAMPLE_TEXTS), F.xxhash64(F.coalesce("text", F.lit("")))
    sample = docs.where(F.pmod(tag, F.lit(every)) == 0).select(tag.alias("tag"), "text").groupBy("tag").agg(F.first("text").alias("text"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set((t or "").encode(), width) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["shingle"])

    counts = map_rows(sample, "shingle long", each).groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = counts.orderBy(F.col("n").desc(), "shingle").limit(COMMON_SHINGLES).toArrow()
    common, n = found.column("shingle").to_numpy().astype(np.int64).view(np.uint64), found.column("n").to_numpy().astype(np.int64)
    order = np.argsort(common)
    return common[order], n[order]


def prefix(found: np.ndarray, least: float, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles of a sorted set of which two sets similar by ``least`` share one; zero stands for the empty set."""
    if not len(found):
        return np.zeros(1, np.uint64)
    keep = len(found) - max(1, math.ceil(least * len(found) - 1e-6)) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        known = common[at] == found
        if known.any():
            found = found[np.lexsort((found, np.where(known, counts[at], 0)))]
    return found[:keep]


def parity(found: np.ndarray) -> np.ndarray:
    """Words of bits, each the parity of the shingles dealt to it: two sets differ in at least as many shingles as bits."""
    words = PARITY_WORDS
    while len(found) > 100 * words and words < MOST_PARITY_WORDS:
        words *= 4
    dealt = np.bincount((found & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words)
    return np.packbits((dealt & 1).astype(np.uint8)).view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The parity bits that as many words would have."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


class Sketches:
    """Sizes and parity bits of sets, to tell which can't be similar."""

    def __init__(self, n: np.ndarray, bits: list[bytes], least: float):
        self.n, self.least = n, least
        self.bits = [np.frombuffer(b, np.uint64) for b in bits]
        self.long = np.array([len(b) > PARITY_WORDS for b in self.bits], bool)
        self.base = np.stack([folded(b, PARITY_WORDS) if long else b for b, long in zip(self.bits, self.long, strict=True)])

    def may(self, x: np.ndarray | int, y: np.ndarray) -> np.ndarray:
        """For each y and its x: False only where the similarity is below ``least``."""
        a, b = self.n[x], self.n[y]
        most = (1 - self.least) / (1 + self.least) * (a + b) + 1e-6
        near = np.bitwise_count(self.base[x] ^ self.base[y]).sum(axis=1, dtype=np.int64) <= most
        near &= np.minimum(a, b) >= self.least * np.maximum(a, b)
        x = np.broadcast_to(x, y.shape)
        for k in np.flatnonzero(near & self.long[x] & self.long[y]):
            p, q = self.bits[x[k]], self.bits[y[k]]
            words = min(len(p), len(q))
            near[k] = np.bitwise_count(folded(p, words) ^ folded(q, words)).sum(dtype=np.int64) <= most[k]
        return near

    def links(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that join what all pairs inside the buckets, which begin at ``starts``, join that may be similar."""
        ends = np.r_[starts[1:], len(self.n)]
        first = np.repeat(starts, ends - starts)
        rows = np.arange(len(first))
        met = np.zeros(len(first), bool)
        later = rows[rows != first]
        met[later] = self.may(first[later], later)
        us, vs = [first[met]], [rows[met]]
        open_ = np.add.reduceat((~met).astype(np.int64), starts) > 1  # the first row of each isn't met
        for a, b in zip(starts[open_].tolist(), ends[open_].tolist(), strict=True):
            queue, left = (a + np.flatnonzero(met[a:b])).tolist(), a + 1 + np.flatnonzero(~met[a + 1 : b])
            while len(left):
                if not queue:
                    queue, left = [left[0]], left[1:]
                for x in queue:
                    if not len(left):
                        break
                    near = self.may(x, left)
                    reached, left = left[near], left[~near]
                    us.append(np.full(len(reached), x))
                    vs.append(reached)
                    queue += reached.tolist()
                queue = []
        return np.concatenate(us), np.concatenate(vs)


def buckets(chunk: int):
    """From rows (sig, tag) in order: those of each sig with several tags, with a hash of the tags in place of the sig.

    Near copies share most of their prefixes, so many buckets hold the same texts: they get one name, and are one once rows
    are made distinct. A bucket of more than ``chunk`` texts is passed on under its sig, as it comes. Buckets that by chance
    have one name are compared as one, which loses no pair.
    """

    def named(rows: np.ndarray, large: int | None) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
        sizes = np.diff(np.r_[starts, len(rows)])
        mixed = rows[:, 1].view(np.uint64) if rows.flags.c_contiguous else np.ascontiguousarray(rows[:, 1]).view(np.uint64)
        mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        names = np.add.reduceat(mixed ^ mixed >> np.uint64(32), starts).view(np.int64)
        as_is = (sizes > chunk) | (np.zeros(len(starts), bool) if large is None else rows[starts, 0] == large)
        names = np.repeat(np.where(as_is, rows[starts, 0], names), sizes)
        keep = np.repeat(as_is | (sizes > 1), sizes)
        return pa.RecordBatch.from_arrays([pa.array(names[keep]), pa.array(rows[keep, 1])], ["sig", "tag"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = np.zeros((0, 2), np.int64), None
        for batch in batches:
            rows = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)])
            if not len(rows):
                continue
            last = int(np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])[-1])
            if last:
                yield named(rows[:last], large)
            held = rows[last:]
            if large is not None and held[0, 0] != large:
                large = None
            if large is None and len(held) > chunk:
                large = int(held[0, 0])
            if large is not None:
                yield named(held, large)
                held = held[-1:]
        if len(held) and large is None:
            yield named(held, None)

    return run


def candidate_links(docs: DataFrame, texts: DataFrame, least: float, width: int, chunk: int = BUCKET_CHUNK) -> DataFrame:
    """u, v: links between tags that join all texts similar by ``least``, and some that are a little less similar.

    texts: h, tag of each distinct text. Texts that share a prefix's shingle make a bucket. One of more than ``chunk``
    texts is dealt to several tasks by ``meetings``, so that no task holds a large bucket and no pair is lost.
    """
    common, counts = common_shingles(docs, texts.count(), width)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set((t or "").encode(), width) for t in batch.column(1).to_pylist()]
        sigs = [prefix(s, least, common, counts) for s in sets]
        offsets = np.cumsum([0, *map(len, sigs)]).astype(np.int32)
        sigs = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sigs).view(np.int64)))
        bits = pa.array([parity(s).tobytes() for s in sets], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), bits, sigs], ["h", "n", "bits", "sigs"])

    marks = map_rows(docs.select(text_hash().alias("h"), "text"), "h binary, n long, bits binary, sigs array<long>", each)
    marks = marks.groupBy("h").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("sigs").alias("sigs"))
    marks = cut_lineage(marks.join(texts.select("h", "tag"), "h").select("tag", "n", "bits", "sigs"))
    dealt = marks.select(F.explode("sigs").alias("sig"), "tag").repartition("sig").sortWithinPartitions("sig", "tag")
    dealt = cut_lineage(dealt.mapInArrow(frugal(buckets(chunk)), "sig long, tag long").distinct())
    sweep(docs.sparkSession)

    def near(own: list[pa.Array], first: list[pa.Array]) -> np.ndarray:
        n = np.concatenate([own[0].to_numpy(), first[0].to_numpy()])
        rows = np.arange(len(own[0]))
        return Sketches(n, own[1].to_pylist() + first[1].to_pylist(), least).may(rows, rows + len(rows))

    base = dealt.withColumn("weight", F.lit(1).cast("long"))
    met, joined = meetings(base, "sig", chunk, ["n", "bits"], lambda some: some.join(marks, "tag").select("sig", "tag", "weight", "n", "bits"), near)
    keys = ["sig", "low", "high"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: np.ndarray, bits: list[bytes]) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
            u, v = Sketches(rows[:, 4], bits, least).links(starts)
            pairs = np.unique(np.sort(np.stack([rows[u, 3], rows[v, 3]], axis=1), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

        held, bits = np.zeros((0, 5), np.int64), []
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:5]], axis=1)])
            bits += batch.column(5).to_pylist()
            last = np.flatnonzero((held[:, :3] != held[-1:, :3]).any(axis=1))
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole:  # the last bucket may go on in the next batch
                yield found(held[:whole], bits[:whole])
                held, bits = held[whole:], bits[whole:]
        if len(held):
            yield found(held, bits)

    found = met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(frugal(search), "u long, v long")
    return (found.unionByName(joined) if joined is not None else found).distinct()


def text_hash() -> Column:
    """128 bits of the column ``text``; null is empty."""
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _group_links(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """u, v: each text's tag and the least tag of its group. texts: x, tag; groups: tag (as x), component_fp."""
    named = cut_lineage(texts.select("x", "tag").join(groups.select(F.col("tag").alias("x"), "component_fp").distinct(), "x").select("tag", "component_fp"))
    least = named.groupBy("component_fp").agg(F.min("tag").alias("u"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return named.join(least, "component_fp").where("tag <> u").select("u", F.col("tag").alias("v"))


def keep_one(docs: DataFrame, least: float = SIMILARITY, width: int = WIDTH, chunk_bytes: int = CHUNK_BYTES, groups: DataFrame | None = None) -> DataFrame:
    """docs with one row of each group of near copies, all columns as they were.

    A group is what links of at least ``least`` join, directly or through others, and what ``groups`` has together: rows of
    tag (xxhash64 of the text, null as empty) and component_fp, as ``simhash.near_groups`` gives them. Its smallest doc_id stays, a null
    one only where all are null. Equal texts are one node, told apart by 128 bits of hash, and are near copies of each
    other; so are all texts without a word. Rows that repeat both doc_id and text stay or go together: exact dedup is
    what removes them. An empty table gives no rows. doc_id must be a whole number.
    """
    h = text_hash()
    rows = cut_lineage(integral(docs).select(F.col("doc_id").cast("long").alias("doc_id"), h.alias("h"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("x")))
    # A number for each distinct text; the checkpoint fixes it.
    texts = rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("x").alias("x"))
    texts = cut_lineage(texts.withColumn("tag", F.monotonically_increasing_id()))
    grouped = components(candidate_links(docs, texts, least, width)).select(F.col("node").alias("tag"), F.col("label").alias("comp"))
    candidates = cut_lineage(texts.join(grouped, "tag").select("h", "tag", "comp", "first"))
    sweep(docs.sparkSession)

    # One row for each candidate text, by the doc_id that stands for it, so equal texts are read once.
    read = docs.select(F.col("doc_id").cast("long").alias("_id"), "text", h.alias("_h"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("_size"))
    read = read.join(candidates, (F.col("_h") == F.col("h")) & F.col("_id").eqNullSafe(F.col("first"))).select("comp", "tag", "text", "_size")
    read = cut_lineage(read.groupBy("comp", "tag").agg(F.first("text").alias("text"), F.first("_size").alias("weight")))
    linked = verified_links(read, least, width, chunk_bytes)
    if groups is not None:
        linked = linked.unionByName(_group_links(texts, groups))
    labels = components(linked)

    members = texts.select("h", "tag", "first").join(labels, F.col("tag") == F.col("node")).select("h", "label", "first")
    smallest = cut_lineage(members.groupBy("label").agg(F.min("first").alias("keep")))
    keepers = members.join(smallest, "label").select("h", "keep")
    alone = texts.where("n > 1").join(keepers, "h", "left_anti").select("h", F.col("first").alias("keep"))
    gone = rows.join(keepers.unionByName(alone), "h").where(~F.col("doc_id").eqNullSafe(F.col("keep"))).select("doc_id", "h")
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_id"), h.alias("_h"))
    return left.join(gone, left["_id"].eqNullSafe(gone["doc_id"]) & (left["_h"] == gone["h"]), "left_anti").select("_row.*")
