"""SimHash near-dedup with a Gray-order hierarchical index.

The bits of a fingerprint make radius + 2 blocks; fingerprints that differ in at most ``radius`` bits agree in two of
them. Each distinct fingerprint is dealt to a bucket for every two blocks, so all links lie inside buckets; a large
bucket's other bits make blocks in turn. In a bucket, fingerprints are sorted by Gray rank, so neighbours share most
bits; eight neighbours form a node that holds the bits all of them share, and eight nodes one above it, whose shared
bits are taken out of the nodes below. A query adds up its differences on the way down and drops a whole node as soon
as the sum is over the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import components, cut_lineage, frugal, integral, map_rows

SEED = 42
RADIUS = 3
WIDTH = 3
#: Distinct fingerprints of one bucket that one task compares; a larger bucket is dealt anew by more bits.
CHUNK = 2048
#: A bucket whose fingerprints agree in all but this many bits is not dealt anew: it can't hold more than 2 ** SMALL_BITS.
SMALL_BITS = 11
FAN = 8
#: Blocks in which a bucket's fingerprints agree, and those when a bucket is dealt anew.
AGREE, AGREE_AGAIN = 2, 3
_BLOCK = 1 << 19  # candidate pairs that the search holds at once


# --- fingerprints

def shingles(text: bytes, width: int) -> list[bytes]:
    """The width-word shingles of text, A-Z lower-cased; repeats are kept. Fewer words: one shingle of them all."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    return [joined[a : b - 1] for a, b in zip(starts, ends[width - 1 :], strict=False)] or [joined]


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64; no words: zero."""
    digest = xxhash.xxh64_intdigest
    all_of = shingles(text, width)
    if not all_of:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(all_of), 65_536):
        part = all_of[at : at + 65_536]
        h = np.fromiter((digest(s, seed) for s in part), np.uint64, len(part))
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(all_of)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WIDTH, seeds: tuple[int, ...] = (SEED,)) -> DataFrame:
    """doc_id, tag (a hash of the text), and fp (the 64 bits as a signed long), or fp0, fp1, ... for several seeds.

    Null text is empty.
    """
    names = ["fp"] if len(seeds) == 1 else [f"fp{i}" for i in range(len(seeds))]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
        found = [pa.array(np.array([fingerprint(t, width, seed) for t in texts], np.uint64).view(np.int64)) for seed in seeds]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *found], ["doc_id", "tag", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"))
    return map_rows(rows, ", ".join(f"{c} long" for c in ["doc_id", "tag", *names]), each)


# --- the index

def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Where each code stands in Gray order: the prefix parities of its bits."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A forest over fingerprints sorted by bucket and Gray rank: one tree for each bucket.

    label: a number for each fingerprint; pairs of one label are not looked for, and nodes of one label are dropped whole.
    """

    def __init__(self, bucket: np.ndarray, fp: np.ndarray, label: np.ndarray):
        self.order = np.lexsort((gray_rank(fp), bucket))
        self.fp, self.label, bucket = fp[self.order], label[self.order], bucket[self.order]
        self.given = self.label
        self.tree = owner = np.cumsum(np.r_[True, bucket[1:] != bucket[:-1]]) - 1
        self.size = np.bincount(self.tree)[self.tree]
        #: From the fingerprints upwards: shared bits, their mask less what is shared above, label range, children.
        value, mask, low, high = self.fp, np.full(len(fp), ~np.uint64(0)), self.label, self.label
        self.levels = []
        while True:
            first = np.r_[True, owner[1:] != owner[:-1]]
            place = np.arange(len(owner)) - np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0))
            starts = np.flatnonzero(place % FAN == 0)
            ends = np.r_[starts[1:], len(owner)]
            all_ones, any_one = np.bitwise_and.reduceat(value, starts), np.bitwise_or.reduceat(value, starts)
            shared = np.bitwise_and.reduceat(mask, starts) & ~(all_ones ^ any_one)
            parent = np.repeat(np.arange(len(starts)), ends - starts)
            self.levels.append((value, mask & ~shared[parent], low, high, starts, ends))
            value, mask, owner = all_ones & shared, shared, owner[starts]
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            if len(owner) == owner[-1] + 1:
                break
        self.top = (value, mask)

    def relabel(self, label: np.ndarray) -> None:
        """Takes larger groups as labels, so that nodes which have become one group are dropped whole from here on."""
        self.label = low = high = label
        for depth, (value, mask, _, _, starts, ends) in enumerate(self.levels):
            self.levels[depth] = (value, mask, low, high, starts, ends)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (i, j), i before j in index order: all pairs of a bucket within radius and of different labels."""
        load = np.cumsum(self.size)
        at = 0
        while at < len(self.fp):
            end = max(at + 1, int(np.searchsorted(load, (load[at - 1] if at else 0) + _BLOCK, "right")))
            yield self._below(np.arange(at, end), radius)
            at = end

    def _below(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        node = self.tree[query]
        value, mask = self.top
        sum_of = np.bitwise_count((self.fp[query] ^ value[node]) & mask[node]).astype(np.int16)
        for depth, (value, rest, low, high, starts, ends) in enumerate(reversed(self.levels)):
            fan = ends[node] - starts[node]
            child = np.repeat(starts[node] - np.r_[0, np.cumsum(fan)[:-1]], fan) + np.arange(fan.sum())
            query, sum_of = np.repeat(query, fan), np.repeat(sum_of, fan)
            sum_of = sum_of + np.bitwise_count((self.fp[query] ^ value[child]) & rest[child])
            own = self.label[query]
            near = (sum_of <= radius) & ((low[child] != own) | (high[child] != own))
            if depth == len(self.levels) - 1:
                near &= child > query
            query, node, sum_of = query[near], child[near], sum_of[near]
        return query, node


def spanning(index: GrayIndex, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of labels that join what the pairs within radius join, at most one for each label.

    What a block of queries has joined is one group for the next: a cluster of n near copies costs about n comparisons
    once it hangs together, not their square.
    """
    _, first, root = np.unique(index.given, return_index=True, return_inverse=True)
    root = first[root]  # rows of one label start as one
    start = root.copy()
    for i, j in index.links(radius):
        joined = False
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            joined = True
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
        if joined:
            index.relabel(root)
    moved = np.unique(start[root != start])
    return index.given[moved], index.given[root[moved]]


def bucket_masks(radius: int, agree: int = AGREE, within: int = 0) -> list[int]:
    """Masks of the bits that a bucket's fingerprints agree in: every pair within radius agrees in one of them.

    The bits outside ``within``, in which all agree already, make radius + agree blocks, of which at most radius can
    differ.
    """
    open_bits = [bit for bit in range(64) if not within >> bit & 1]
    edges = [len(open_bits) * i // (radius + agree) for i in range(radius + agree + 1)]
    blocks = [sum(1 << bit for bit in open_bits[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return [within | sum(some) for some in combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(points: DataFrame, finer: dict[int, list[int]]) -> DataFrame:
    """Points under each finer mask of their ``mask``, with the bits that it takes. The masks depend on no data."""
    table = [(_signed(mask), _signed(m)) for mask, some in finer.items() for m in some]
    masks = points.sparkSession.createDataFrame(table, "mask long, finer long")
    return points.join(F.broadcast(masks), "mask").select("fp", "label", F.col("finer").alias("mask"))


def dealt_buckets(points: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """fp, label, mask, shared: buckets (mask, shared) that hold every pair within radius and are bounded in size.

    points: distinct fp, each with its label. A bucket of more than ``chunk`` points is dealt anew by further bits that
    pairs within radius must agree in, until it holds at most ``chunk``, or so few bits are open that distinct fingerprints
    can't be more than 2 ** SMALL_BITS. A point comes in a fixed number of buckets at most, so the work grows with the
    points however many share a bucket. A large bucket of one label is left out. Buckets are counted before the shuffle.
    """
    shared = F.col("fp").bitwiseAND(F.col("mask"))
    dealt = points.select("fp", "label", F.explode(F.array(*[F.lit(_signed(m)) for m in bucket_masks(radius)])).alias("mask")).withColumn("shared", shared)
    ready = []
    while True:
        counts = dealt.where(F.bit_count("mask") < 64 - SMALL_BITS).groupBy("mask", "shared")
        counts = counts.agg(F.count(F.lit(1)).alias("n"), (F.min("label") < F.max("label")).alias("several"))
        large = cut_lineage(counts.where(F.col("n") > chunk).select("mask", "shared", "several"))
        masks = {r.mask: r.several for r in large.groupBy("mask").agg(F.max("several").alias("several")).collect()}  # as many as masks
        if not masks:
            break
        ready.append(dealt.join(large, ["mask", "shared"], "left_anti"))
        again = cut_lineage(dealt.join(large.where("several"), ["mask", "shared"], "left_semi").select("fp", "label", "mask"))
        dealt = _deal(again, {m & ~(-1 << 64): bucket_masks(radius, AGREE_AGAIN, m & ~(-1 << 64)) for m in masks}).withColumn("shared", shared)
    for some in ready:
        dealt = dealt.unionByName(some)
    return dealt


def links(points: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """u, v: links between labels that join all labels with points within radius. points: distinct fp, each with its label."""
    keys = ["mask", "shared"]
    met = dealt_buckets(points, radius, chunk).select(*keys, "fp", "label")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(rows)])
            several = np.minimum.reduceat(rows[:, 3], starts) != np.maximum.reduceat(rows[:, 3], starts)
            keep = np.repeat(several, sizes)
            if not several.any():
                return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["u", "v"])
            bucket = np.repeat(np.arange(len(starts)), sizes)[keep]
            u, v = spanning(GrayIndex(bucket, rows[keep, 2].view(np.uint64), rows[keep, 3]), radius)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        held = np.zeros((0, 4), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)])
            whole = len(held) - int((held[::-1, :2] == held[-1, :2]).all(axis=1).argmin() or len(held)) if len(held) else 0
            if whole:  # the last bucket may go on in the next batch
                yield found(np.ascontiguousarray(held[:whole]))
                held = held[whole:]
        if len(held):
            yield found(np.ascontiguousarray(held))

    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(frugal(search), "u long, v long").distinct()


def near_groups(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Per row of docs: doc_id, fp, tag, component_id (the smallest doc_id reachable over links within radius), component_fp (its name among fingerprints).

    Null and empty texts and texts of white space have fingerprint zero and link like any other. Null doc_ids take
    part; component_id is null only where all of a component's doc_ids are. Equal fingerprints are merged before
    anything is compared, so copies cost nothing further. Repeated rows are returned as often as they come; an empty
    table gives no rows. Other columns of docs are not read. doc_id must be a whole number.
    """
    rows = cut_lineage(fingerprints(integral(docs), width))
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    labels = components(links(distinct.select("fp", F.col("fp").alias("label")), radius, chunk))
    linked = distinct.join(labels, distinct["fp"] == labels["node"]).select("fp", "label", "first")
    smallest = cut_lineage(linked.groupBy("label").agg(F.min("first").alias("smallest")))
    reached = linked.join(smallest, "label").select("fp", "label", "smallest")
    by_fp = distinct.join(reached, "fp", "left").select("fp", F.coalesce("smallest", "first").alias("component_id"), F.coalesce("label", "fp").alias("component_fp"))
    by_fp = cut_lineage(by_fp)  # so that the join shuffles both sides, and Spark can split a fingerprint that very many have
    return rows.join(by_fp, "fp").select("doc_id", "fp", "tag", "component_id", "component_fp")
