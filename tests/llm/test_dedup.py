"""Exact dedup, SimHash, near copies, line dedup: brute force on small frames with nulls, ties, copies and long texts."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siftline.llm import common, exact_dedup, line_dedup, near_copies, simhash

SPACE = re.compile(r"[\x20\x09-\x0D]")


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"doc_id long, text string{extra}")


ROWS = [(1, "a b"), (2, "a  b\n"), (3, "ab"), (4, None), (5, ""), (6, " \t"), (None, "ab "), (7, "A b"), (8, "x" * 300_000), (9, "x" * 150_000 + "\n" + "x" * 150_000), (-3, "a b")]


def test_exact_dedup_equals_brute_force(spark):
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(frame(spark, ROWS)).collect()}
    groups = {}
    for i, t in ROWS:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    for i, t in ROWS:
        key = SPACE.sub("", t or "")
        keep = min(groups[key])
        assert (got[i].keep_id, got[i].group_size, got[i].text_sha256) == (keep[3], len(groups[key]), hashlib.sha256(key.encode()).hexdigest())
        assert got[i].kept == ((-len(t or ""), i) == (keep[0], keep[3]))


def test_exact_dedup_tells_collisions_apart(spark):
    weak = lambda norm: F.lit(b"same")
    texts = [SPACE.sub("", t or "") for _, t in ROWS]
    for hashed in (exact_dedup.content_hash, weak):
        assert exact_dedup.classes(frame(spark, ROWS), hashed)[1].count() == len({t for t in texts if texts.count(t) > 1})
    strong, all_one = (sorted(map(tuple, exact_dedup.exact_dedup(frame(spark, ROWS), h).collect()), key=str) for h in (exact_dedup.content_hash, weak))
    assert strong == all_one


def test_keep_one_and_clashing_columns(spark):
    rows = [(1, "a b", "k"), (1, "a b", "k"), (2, "ab", None), (None, "z", "q")]
    df = frame(spark, rows, ", _h string").withColumnRenamed("_h", "_rank")
    out = exact_dedup.keep_one(df)
    assert out.columns == df.columns and sorted(map(tuple, out.collect()), key=str) == [(1, "a b", "k"), (None, "z", "q")]
    assert exact_dedup.keep_one(df.limit(0)).count() == 0


def _fingerprint(text, width=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    bits = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def _groups(values, linked):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def _texts(seed, n=60):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.choice([1, 4, 60, 120]))] for _ in range(n // 4)]
    out = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"
        out.append((i, " ".join(words)))
    return [*out, (n, None), (n + 1, " \n"), (n + 2, "É é x"), (n + 3, out[0][1].upper())]


@pytest.mark.parametrize("chunk", [3, 512])
def test_simhash_equals_brute_force(spark, chunk):
    rows = _texts(chunk)
    fps = [_fingerprint(t) for _, t in rows]
    root = _groups(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    got = {r.doc_id: r for r in simhash.near_groups(frame(spark, rows), chunk=chunk).collect()}
    assert [got[i].fp & (2**64 - 1) for i, _ in rows] == fps
    assert [got[i].component_id for i, _ in rows] == [rows[r][0] for r in root]


def test_simhash_null_ids_and_empty(spark):
    got = simhash.near_groups(frame(spark, [(None, "a b c d"), (5, "a b c d"), (None, "q r s t u"), (5, "a b c d")])).collect()
    assert sorted(str(r.component_id) for r in got) == ["5", "5", "5", "None"]
    assert simhash.near_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_gray_index_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 8, dtype=np.uint64)
    flips = lambda: np.uint64(1) << rng.integers(0, 64, 8, dtype=np.uint64)
    fp = np.unique(np.concatenate([base, *[base ^ flips() ^ flips() for _ in range(20)]]))
    bucket, label = rng.integers(0, 3, len(fp)), rng.integers(0, 50, len(fp))
    index = simhash.GrayIndex(bucket, fp, label)
    got = {frozenset((int(index.fp[i]), int(index.fp[j]))) for a, b in index.links(4) for i, j in zip(a, b, strict=True)}
    want = {frozenset((int(fp[i]), int(fp[j]))) for i in range(len(fp)) for j in range(i) if bucket[i] == bucket[j] and label[i] != label[j] and int(fp[i] ^ fp[j]).bit_count() <= 4}
    assert got == want


@pytest.mark.parametrize("radius", [1, 3, 8])
def test_every_close_pair_shares_a_bucket(radius):
    rng = random.Random(radius)
    masks = simhash.bucket_masks(radius)
    for _ in range(300):
        x, flipped = rng.getrandbits(64), sum(1 << b for b in rng.sample(range(64), radius))
        assert any(x & m == (x ^ flipped) & m for m in masks)


@pytest.mark.parametrize("radius", [1, 3])
def test_every_close_pair_shares_a_finer_bucket(radius):
    rng = random.Random(radius)
    for within in simhash.bucket_masks(radius)[::3]:
        for _ in range(50):
            x, open_bits = rng.getrandbits(64), [b for b in range(64) if not within >> b & 1]
            flipped = sum(1 << b for b in rng.sample(open_bits, radius))
            masks = simhash.bucket_masks(radius, simhash.AGREE_AGAIN, within)
            assert all(m & within == within and m != within for m in masks)
            assert any(x & m == (x ^ flipped) & m for m in masks)


def test_a_hot_bucket_is_dealt_in_bounded_buckets_and_loses_no_link(spark):
    rng = np.random.default_rng(1)
    base = int(rng.integers(0, 2**63)) & ~((1 << 40) - 1)  # all agree in 24 bits, many within 3 bits of each other
    seeds = rng.integers(0, 1 << 40, 40).tolist()
    fps = {base | s ^ sum(1 << int(b) for b in rng.choice(40, int(rng.integers(0, 5)), replace=False)) for s in seeds for _ in range(40)}
    fps |= {base | int(x) for x in rng.integers(0, 1 << 40, 400)}
    signed = [x - (1 << 64) if x >> 63 else x for x in sorted(fps)]
    points = spark.createDataFrame([(x, x) for x in signed], "fp long, label long")
    dealt = simhash.dealt_buckets(points, 3, 64)
    assert dealt.where(F.bit_count("mask") < 64 - simhash.SMALL_BITS).groupBy("mask", "shared").count().where("count > 64").isEmpty()
    assert dealt.groupBy("fp", "mask").count().where("count > 1").isEmpty()
    root = _groups(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 3)
    got = {r.node: r.label for r in common.components(simhash.links(points, 3, 64)).collect()}
    mine = [got.get(x, x) for x in signed]
    assert len({(a, b) for a, b in zip(mine, root, strict=True)}) == len(set(mine)) == len(set(root)) < len(fps)


def test_a_large_bucket_of_one_label_is_left_out(spark):
    points = spark.createDataFrame([(x, 7) for x in range(200)] + [(1 << 60, 9)], "fp long, label long")
    assert simhash.links(points, 3, 16).where("u <> v").count() == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, i) for i in range(900, 950)] + [(7, 7)]
    got = {r.node: r.label for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 900 for i in [*range(900, 950), 1000]}
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("chunk_bytes", [200, 4 << 20])
def test_near_copies_equal_brute_force(spark, chunk_bytes):
    rows = _texts(7)
    sets = [frozenset(near_copies.shingle_set((t or "").encode()).tolist()) for _, t in rows]
    root = _groups(sets, lambda a, b: near_copies.similar(a, b, 0.8))
    out = near_copies.keep_one(frame(spark, [(*r, "x") for r in rows], ", comp string"), chunk_bytes=chunk_bytes)
    assert out.columns == ["doc_id", "text", "comp"]
    assert sorted(r.doc_id for r in out.collect()) == sorted({rows[r][0] for r in root})


def _block_edits(seed, pairs=20):
    """Each text beside itself with a block appended, cut off or replaced, so that the similarity is just 0.8 or just less."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    out = []
    for edit in ("append", "cut", "replace"):
        for k in range(pairs):
            words = [word() for _ in range(rng.choice([24, 44, 120, 400]))]
            n = len(words) - 4
            if edit == "append":  # n of n + x shingles
                other = words + [word() for _ in range(n // 4 + k % 2)]
            elif edit == "cut":  # n - x of n
                other = words[n // 5 + k % 2 :]
            else:  # n - x of n + x, a block of x words at the end
                x = n // 9 + k % 2
                other = words[:-x] + [word() for _ in range(x)]
            out += [" ".join(words), " ".join(other)]
    return list(enumerate(out))


def _kept(rows):
    sets = [frozenset(near_copies.shingle_set((t or "").encode()).tolist()) for _, t in rows]
    return sorted({rows[r][0] for r in _groups(sets, lambda a, b: near_copies.similar(a, b, 0.8))})


def test_near_copies_find_block_edits(spark):
    rows = _block_edits(1)
    want = _kept(rows)
    assert len(rows) * 0.5 < len(want) < len(rows) * 0.9
    assert sorted(r.doc_id for r in near_copies.keep_one(frame(spark, rows)).collect()) == want


def test_near_copies_find_repeated_passages(spark):
    rng = random.Random(5)
    rows = []
    for times in (2, 4, 8):
        for _ in range(8):
            words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
            rows += [" ".join(words), " ".join(words + words[:30] * times)]
    rows = list(enumerate(rows))
    want = _kept(rows)
    assert len(want) == len(rows) // 2
    assert sorted(r.doc_id for r in near_copies.keep_one(frame(spark, rows)).collect()) == want


@pytest.mark.parametrize("seed", range(3))
def test_similar_sets_share_a_prefix_and_pass_the_sketch(seed):
    rng = np.random.default_rng(seed)
    for size in (0, 1, 2, 5, 9, 40, 333, 2000, 9000):
        a = rng.integers(0, 2**64, size, dtype=np.uint64)
        common = np.unique(a[rng.random(size) < 0.7])
        counts = rng.integers(2, 9, len(common))
        for gone, more in [(0, 0.25), (0.2, 0), (1 / 9, 1 / 9), (0.05, 0.1)]:
            b = np.r_[a[int(gone * size) :], rng.integers(0, 2**64, int(more * size), dtype=np.uint64)]
            a, b = np.unique(a), np.unique(b)
            assert near_copies.similar(frozenset(a.tolist()), frozenset(b.tolist()), 0.8)
            for known in ((common, counts), (common[:0], counts[:0])):
                assert set(near_copies.prefix(a, 0.8, *known).tolist()) & set(near_copies.prefix(b, 0.8, *known).tolist())
            sketches = near_copies.Sketches(np.array([len(a), len(b)]), [near_copies.parity(x).tobytes() for x in (a, b)], 0.8)
            assert sketches.may(0, np.array([1])).all() and [x.tolist() for x in sketches.links(np.array([0]))] == [[0], [1]]
        other = near_copies.parity(rng.integers(0, 2**64, size, dtype=np.uint64)).tobytes()
        if size > 2:
            assert not near_copies.Sketches(np.array([len(a), size]), [near_copies.parity(a).tobytes(), other], 0.8).may(0, np.array([1])).any()


@pytest.mark.parametrize("chunk", [5, 4096])
def test_candidate_links_in_large_buckets(spark, chunk):
    rng = random.Random(chunk)
    lines = [" ".join(f"l{k}x{i}" for i in range(12)) for k in range(6)]
    texts = [" ".join(rng.sample(lines, rng.randrange(1, 6))) for _ in range(80)]
    rows = list(enumerate(sorted(set(texts))))
    df = frame(spark, rows)
    texts = df.select(near_copies.text_hash().alias("h"), F.col("doc_id").alias("tag"))
    links = [(r.u, r.v) for r in near_copies.candidate_links(df, texts, 0.8, 5, chunk).collect()]
    sets = [frozenset(near_copies.shingle_set(t.encode()).tolist()) for _, t in rows]
    joined = _groups(list(range(len(rows))), lambda a, b: (a, b) in links or (b, a) in links)
    similar = [(i, j) for i in range(len(rows)) for j in range(i) if near_copies.similar(sets[i], sets[j], 0.8)]
    assert similar and all(joined[i] == joined[j] for i, j in similar)


def test_meetings_lose_no_pair_and_leave_out_what_is_joined(spark):
    rows = [(1, i, 1, i) for i in range(90)] + [(2, i, 1, i % 7) for i in range(50)] + [(3, i, 1, i) for i in range(4)]
    base = spark.createDataFrame(rows, "k long, tag long, weight long, x long")
    near = lambda own, first: [abs(a - b) <= 40 for a, b in zip(own[0].to_pylist(), first[0].to_pylist(), strict=True)]
    met, joined = near_copies.meetings(base, "k", 8, ["x"], lambda some: some, near)
    cells = {}
    for r in met.collect():
        cells.setdefault((r.k, r.low, r.high), []).append(r.tag)
    assert all(len(tags) == len(set(tags)) <= 40 for tags in cells.values())
    together = {(k, a, b) for (k, _, _), tags in cells.items() for a in tags for b in tags}
    assert all((1, a, b) in together for a in range(90) for b in range(41, 90))
    assert not any(k == 2 for k, _, _ in cells) and sorted(cells[3, 0, 0]) == [0, 1, 2, 3]
    assert {(r.u, r.v) for r in joined.collect()} == {(0, i) for i in range(1, 50)}
    assert near_copies.meetings(base.where("k = 3"), "k", 8, ["x"], lambda some: some, near)[1] is None


def test_near_copies_keep_different_texts(spark):
    rng = random.Random(3)
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(i, shared + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(120))) for i in range(30)]
    assert near_copies.keep_one(frame(spark, rows)).count() == 30
    assert near_copies.keep_one(frame(spark, [])).count() == 0


LINES = [
    (1, "Hello World 12\nshort\nunique line one"),
    (2, "\t hello world 12 \nshort\n\nunique line two"),
    (3, "HELLO WORLD 12"),
    (4, None),
    (5, ""),
    (6, "hello world 12\nhello world 12\r\n"),
    (7, "own line twice\nown line twice"),
    (None, "hello world 12\nlast of all\n"),
    (8, "last of all"),
    (9, "línea común Ñ\nÀ long line"),
    (10, "línea común Ñ\nà long line"),
    (11, "\n".join(f"many lines {i}" for i in range(3000))),
    (12, "\n".join(f"many lines {i}" for i in range(0, 3000, 2))),
]


def _line_dedup(rows):
    strip = " \t\n\x0b\x0c\r"
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(strip))
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(low(line), set()).add((i is None, i or 0))
    out = {}
    for i, t in rows:
        kept = [x for x in (t or "").split("\n") if len(low(x)) < 10 or min(holders[low(x)]) == (i is None, i or 0)]
        out[i] = ("\n".join(kept), len((t or "").split("\n")), len((t or "").split("\n")) - len(kept))
    return out


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (3, 2), (9, 3)])
def test_line_dedup_equals_brute_force(spark, batches, fanout):
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(frame(spark, LINES), batches, fanout).collect()}
    assert got == _line_dedup(LINES)


def test_line_dedup_repeated_ids_and_empty(spark):
    rows = [(1, "the same line"), (1, "the same line"), (2, "the same line"), (1, "other text ok")]
    got = sorted((r.doc_id, r.text) for r in line_dedup.line_dedup(frame(spark, rows)).collect())
    assert got == [(1, "other text ok"), (1, "the same line"), (1, "the same line"), (2, "")]
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def test_runs_are_compacted(spark):
    from siftline.llm.common import scratch

    runs = line_dedup.LineRuns(spark, scratch(spark, "test"), fanout=2, buckets=2)
    for i in range(4):
        runs.write(spark.createDataFrame([(bytearray([i]),)], "h binary").repartition(2, "h"))
        runs.compact()
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    left = runs.without(spark.createDataFrame([(bytearray([i]),) for i in range(6)], "h binary"))
    assert sorted(bytes(r.h)[0] for r in left.collect()) == [4, 5]
    with line_dedup.sorted_runs(spark):  # the run is merged as it lies
        plan = runs.without(spark.createDataFrame([(bytearray([9]),)], "h binary"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1
    runs.close()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_large_and_equal_buckets():
    import pyarrow as pa

    rows = [(1, 5), (1, 6), (2, 5), (2, 6), (3, 7), (4, 5), (4, 6), (4, 7), *[(5, i) for i in range(40)], (6, 1), (6, 2)]
    for size in (1, 3, 100):
        parts = [pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows[i : i + size]], pa.int64()), pa.array([b for _, b in rows[i : i + size]], pa.int64())], ["sig", "tag"]) for i in range(0, len(rows), size)]
        found = {}
        for batch in near_copies.buckets(8)(iter(parts)):
            for sig, tag in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found.setdefault(sig, set()).add(tag)
        assert sorted(map(sorted, found.values())) == [list(range(40)), [1, 2], [5, 6], [5, 6, 7]]


@pytest.mark.parametrize("run", [exact_dedup.exact_dedup, exact_dedup.keep_one, simhash.near_groups, line_dedup.line_dedup, near_copies.keep_one])
def test_doc_id_must_be_a_number(spark, run):
    with pytest.raises(TypeError, match="whole number"):
        run(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_near_copies_with_clashing_columns(spark):
    rows = [(1, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2), (None, "q", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone string, h long").withColumn("_h", F.lit(1)).withColumn("_row", F.lit(2)).withColumn("first", F.lit(3))
    out = near_copies.keep_one(df)
    assert out.columns == df.columns and sorted(str(r.doc_id) for r in out.collect()) == ["1", "None"]


def test_a_cluster_of_near_copies_is_joined_whole():
    rng = np.random.default_rng(2)
    fp = np.unique(np.uint64(0xABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64)))
    label = np.arange(len(fp))
    u, v = simhash.spanning(simhash.GrayIndex(np.zeros(len(fp), np.int64), fp, label), 4)
    assert len(u) == len(fp) - 1 and set(v.tolist()) == {0}


def test_near_stage_joins_what_fingerprints_link(spark, sf):
    """Texts that differ in scattered words: fingerprints of three-word shingles link some whose five-word shingles are below 0.8."""
    import corpus_pipeline

    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words))]
    for at in range(1, 60):
        rows.append((at + 1, " ".join("changed" if i in (at, (at + 30) % 60, (at + 15) % 60) else w for i, w in enumerate(words))))
    rows += [(1000, "quite another text that nothing is like at all"), (1000, "and one more with the same doc_id but of other words")]
    df = frame(spark, rows)
    fps = {r.doc_id: r.fp for r in simhash.fingerprints(df.where("doc_id < 1000")).collect()}
    sets = {i: frozenset(near_copies.shingle_set(t.encode()).tolist()) for i, t in rows}
    ids, root = sorted(fps), {i: i for i in fps}
    by_fp = lambda a, b: ((fps[a] ^ fps[b]) & (1 << 64) - 1).bit_count() <= 3
    assert any(by_fp(a, b) and not near_copies.similar(sets[a], sets[b], 0.8) for a in ids for b in ids if a < b)
    for a in ids:
        for b in ids:
            if a < b and root[a] != root[b] and (by_fp(a, b) or near_copies.similar(sets[a], sets[b], 0.8)):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert sorted(r.doc_id for r in corpus_pipeline.near_stage(spark, df, sf).collect()) == sorted({*root.values()}) + [1000, 1000]
