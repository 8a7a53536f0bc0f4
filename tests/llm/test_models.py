"""Language ID, quality, media, urls, the queries and the pipeline."""

import random
import struct
import zlib

import numpy as np
import pytest
from compare import same
from pyspark.sql import functions as F

from siftline.llm import language_id, media_columns, quality, queries, url_filters
from siftline.llm.common import is_held_out


def test_held_out(spark):
    df = spark.range(200).select(is_held_out(F.col("id"), 4, 2).alias("h"), "id")
    assert {r.id: r.h for r in df.collect()} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


def test_language_is_right_on_held_out_rows(spark, sf):
    out = queries.op1_language_id(spark, sf)
    docs = queries.table(spark, sf, "documents").select("doc_id", "lang")
    right = out.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95 and out.count() == docs.count()
    assert out.where("score < 0 or score > 1").count() == 0


def test_language_edges(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog are here " * 30, "en"), (2, "le chat et le chien sont ici " * 30, "fr"), (3, None, "en"), (4, "x", None)], "doc_id long, text string, lang string")
    samples = language_id.learn(docs)
    assert set(samples) == {"en", "fr"}
    probe = spark.createDataFrame([(1, "the dog and the cat"), (2, "le chien et le chat"), (3, None), (4, "12 34!"), (None, ""), (5, "the dog " * 100_000)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in language_id.predict(probe, samples).collect()}
    assert got == {1: ("en", False), 2: ("fr", False), 3: ("und", True), 4: ("und", True), None: ("und", True), 5: ("en", False)}
    assert sorted(r.doc_id for r in language_id.keep_identified(probe, samples).collect()) == [1, 2, 5]
    assert {r.lang_pred for r in language_id.predict(probe, {}).collect()} == {"und"} and language_id.predict(probe.limit(0), samples).count() == 0
    assert language_id.learn(docs.limit(0)) == {}


def test_repeated_and_letterless_rows_lose_no_language(spark):
    say = lambda i: " ".join(chr(97 + (i * 7 + j * j) % 26) * 3 for j in range(12))
    rows = [(7, "une seule ligne qui se répète", "fr")] * 5000 + [(i, say(i) if i % 100 == 0 else f"{i} 12", "es") for i in range(5000)]
    rows += [(i, f"the line number {say(i)}", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    samples = language_id.learn(docs)
    assert list(samples) == ["en", "es", "fr"]
    assert samples["fr"] == b"une seule ligne qui se r\xc3\xa9p\xc3\xa8te "
    assert len(samples["es"].split()) > 100
    # doc_id decides nothing
    assert samples == language_id.learn(docs.withColumn("doc_id", F.col("doc_id") * 3 + 1))


def test_more_languages_than_ever(spark):
    docs = spark.createDataFrame([(i, f"{chr(0x4E00 + i)}{chr(0x5E00 + i)}" * 30, f"l{i:03}") for i in range(300)], "doc_id long, text string, lang string")
    samples = language_id.learn(docs)
    assert len(samples) == 300
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in language_id.predict(docs, samples).collect()}
    assert sum(got[i][0] == f"l{i:03}" for i in range(300)) > 290
    small = language_id.learn(docs, 300 * 40)
    assert max(map(len, small.values())) <= 41 and len(small) == 300


def test_language_equals_brute_force(spark, sf):
    """Sizes, margins and scores recomputed with the compressor alone, of the query's own rows."""
    import math
    import re

    import zstandard

    docs = queries.table(spark, sf, "documents")
    learned = language_id.learn(docs.where(~is_held_out(F.col("doc_id"), 4, 2)))
    texts = dict(docs.select("doc_id", "text").collect())
    rows = queries.op1_language_id(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        said = " ".join(re.findall(r"[^\W\d_]+", (texts[r.doc_id] or "").lower())).encode()
        if not said:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        sizes = {}
        for lang, sample in learned.items():
            content = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            press = zstandard.ZstdCompressor(dict_data=content, level=6, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = sum(len(press.compress(said[i : i + 4096] + bytes(64))) for i in range(0, len(said), 4096))
        first, second = sorted(sizes.values())[:2]
        assert sizes[r.lang_pred] == first and r.lang_pred == min(sizes, key=sizes.get)
        assert r.margin == pytest.approx((second - first) / second)
        assert r.rejected == ((second - first) / second < 0.01)
        assert r.score == pytest.approx(1 / sum(math.exp(20 * (first - x) / first) for x in sizes.values()))
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_language_sample_is_bounded_by_bytes(spark):
    rows = [(i, f"word{chr(97 + i)} " * (400 if i % 2 else 10), "en") for i in range(20)] + [(50, "mots " * 3000, "fr"), (51, "longs " * 4000, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {lang: set(sample.split()) for lang, sample in language_id.learn(docs, 2 * 32 * 100).items()}
    # Short rows first, then long ones as far as the bytes go; a language of too long rows is learned from its shortest.
    assert {f"word{chr(97 + i)}".encode() for i in range(0, 20, 2)} < got["en"] and len(got["en"]) == 11
    assert got["fr"] == {b"mots"}
    assert {lang: len(set(sample.split())) for lang, sample in language_id.learn(docs).items()} == {"en": 20, "fr": 2}


def test_quality_is_right_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = queries.table(spark, sf, "labels")
    out = queries.op7_quality(spark, sf)
    right = out.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert right > 0.95 and out.where("score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count() == 0


def test_quality_edges(spark):
    docs = spark.createDataFrame([(i, ("$$$ " * 40 if i % 2 else "plain words of a text " * 9)) for i in range(40)] + [(99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)] + [(None, 1), (5, None), (7, 3), (3, 1)], "doc_id long, quality int")
    voters = quality.learn(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, voters).collect()}
    assert got[1].predicted == 0 and got[2].predicted == 1 and got[99].score == pytest.approx(voters.prior)
    assert quality.keep_good(docs, voters).where("doc_id % 2 = 1 and doc_id < 40").count() == 0
    empty = quality.learn(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, empty).collect()} == {0.5} and quality.score(docs.limit(0), voters).count() == 0


def test_quality_votes_equal_brute_force():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc $"), 50)) for _ in range(60)]
    voters = quality.Voters.fit([quality.terms(t).astype(np.float16).tobytes() for t in texts], rng.integers(0, 2, 60).astype(np.float32))
    unit = lambda x: x / np.linalg.norm(x)
    for text, score in zip(texts[:10], voters.score(texts[:10]), strict=True):
        near = np.array([unit(unit(quality.terms(text)) @ voters.directions) @ v for v in voters.vectors])
        who = np.argsort(-near)[: quality.NEIGHBOURS]
        w = np.maximum(near[who], 0) ** quality.SHARPNESS
        assert score == pytest.approx((w * voters.labels[who]).sum() / w.sum(), abs=1e-3)


@pytest.mark.parametrize("size", [0, 1, 191, 192, 193, 5000, 200_000])
def test_media_round_trip(size):
    data = random.Random(size).randbytes(size)
    payload = media_columns.padded(data)
    assert len(payload) % 192 == 0 and len(payload) >= 192 and payload.startswith(data) and set(payload[size:]) <= {32}
    file = media_columns.mux(payload)
    box = media_columns.Container(file)
    offsets, sizes, sync = box.samples(box.tracks[0])
    assert box.payload(box.tracks[0]) == payload and len(sizes) == len(payload) // 192 and sync.sum() == -(-len(sizes) // 12)
    assert box.duration(box.tracks[0]) == pytest.approx(len(sizes) / 25) and file[offsets[0] : offsets[0] + 192] == payload[:192]


def test_media_fragments_and_small_tables():
    full, box = media_columns._full, media_columns._box
    u32 = lambda *v: struct.pack(f">{len(v)}I", *v)
    tkhd, mdhd, hdlr = full(b"tkhd", bytes(8), u32(7, 0, 0), bytes(60)), full(b"mdhd", bytes(8), u32(10, 0), bytes(4)), full(b"hdlr", bytes(4), b"vide", bytes(13))
    stsd = full(b"stsd", u32(1), box(b"avc1", bytes(78)))
    stz2 = full(b"stz2", b"\0\0\0\4", u32(3), bytes([0x23, 0x40]))
    stbl = box(b"stbl", stsd, full(b"stts", u32(1, 3, 5)), full(b"stsc", u32(2, 1, 2, 1, 2, 1, 1)), stz2, full(b"stco", u32(2, 4, 20)))
    moov = box(b"moov", box(b"mvex", full(b"trex", u32(7, 1, 4, 6, 0))), box(b"trak", tkhd, box(b"mdia", mdhd, hdlr, box(b"minf", stbl))))
    traf = box(b"traf", full(b"tfhd", u32(7)), full(b"trun", u32(2), struct.pack(">i", 8), u32(0, 1 << 16), flags=0x401))
    data = box(b"ftyp", b"iso5", bytes(4)) + moov
    moof = box(b"moof", traf)
    c = media_columns.Container(data + moof + box(b"mdat", bytes(40)))
    offsets, sizes, sync = c.samples(c.tracks[0])
    base = len(data)
    assert (c.brand, c.tracks[0].codec, c.tracks[0].handler, c.tracks[0].number) == ("iso5", "avc1", "vide", 7)
    assert offsets.tolist() == [4, 6, 20, base + 8, base + 14] and sizes.tolist() == [2, 3, 4, 6, 6] and sync.tolist() == [True, True, True, True, False]
    assert c.duration(c.tracks[0]) == pytest.approx((15 + 8) / 10)


def test_bad_media_is_said_not_raised(spark):
    good = media_columns.mux(media_columns.padded(b"x"))
    bad = [None, b"", b"abc", good[:40], good[:-100], b"\0\0\0\x09moov", good.replace(b"stsc", b"free")]
    df = spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in enumerate([good, *bad])], "i int, media binary")
    got = {r.i: (r.error, r.tracks) for r in media_columns.probe(df).collect()}
    assert got[0][0] is None and got[0][1][0].codec == "raw " and all(got[i][0] and got[i][1] is None for i in range(1, len(bad) + 1))
    assert media_columns.probe(df.limit(0)).count() == 0 and media_columns.store(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError, match="already has"):
        media_columns.probe(df.withColumn("Tracks", F.lit(1)))


def _table(name, body, other=None):
    """A file whose sample sizes are in a box of this body."""
    full, box = media_columns._full, media_columns._box
    u32 = lambda *v: struct.pack(f">{len(v)}I", *v)
    tables = other or [full(b"stsc", u32(1, 1, 1, 1)), full(b"stco", u32(1, 0))]
    return box(b"moov", box(b"trak", box(b"mdia", box(b"minf", box(b"stbl", full(name, body), *tables)))))


def _nested(deep):
    out = b""
    for _ in range(deep):
        out = media_columns._box(b"trak", out)
    return media_columns._box(b"moov", out)


def test_malformed_tables_are_said_not_raised(spark):
    u32 = lambda *v: struct.pack(f">{len(v)}I", *v)
    full = media_columns._full
    huge = [full(b"stsc", u32(2, 1, 1, 1, 0xFFFFFFF0, 1, 1)), full(b"stco", u32(1, 0))]
    many = [full(b"stsc", u32(1, 1, 0xFFFFFFFF, 1)), full(b"stco", u32(1, 0))]
    bad = [_table(b"stsz", u32(0)), _table(b"stz2", b"\0\0\0\7" + u32(3)), _table(b"stz2", b"\0\0\0\4" + u32(9)), _table(b"stsz", u32(1, 0xFFFFFFF0)), _table(b"stsz", u32(0, 0xFFFFFFF0)), _table(b"stsz", u32(9, 9), huge), _table(b"stco", u32(0xFFFFFFFF))]
    odd = [_nested(2000), _table(b"stsz", u32(1, 9), many)]  # read, or said, but never raised
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate([*bad, *odd])], "i int, media binary")
    got = {r.i: r.error for r in media_columns.probe(df, with_payload=True).collect()}
    assert len(got) == len(bad) + len(odd) and all(got[i] for i in range(len(bad) - 1)), got


def test_slices_bound_rows_and_bytes():
    import pyarrow as pa

    from siftline.llm.common import slices

    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, None, "b" * 100, "c", "", "d" * 5])], ["i", "t"])
    assert [p.num_rows for p in slices(batch, 3, 12)] == [2, 1, 3] and [p.num_rows for p in slices(batch, 4, 10**6)] == [4, 2]
    assert list(slices(batch.slice(0, 0))) == []


def test_no_language_is_lost(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog are here " * 30, "en"), (2, "漢", "zh"), (3, "123", "xx")], "doc_id long, text string, lang string")
    samples = language_id.learn(docs)
    assert set(samples) == {"en", "zh"}
    got = language_id.predict(spark.createDataFrame([(1, "漢漢漢")], "doc_id long, text string"), samples).first()
    assert got.lang_pred in samples
    empty = docs.limit(0)
    assert language_id.keep_identified(empty, samples).count() == 0 and language_id.keep_identified(docs, {}).count() == 0


def test_urls_equal_brute_force(spark):
    rng = random.Random(5)
    hosts = ["net", "a.net", "b.a.net", "xnet", "example.com", "m.example.com", "", "COM", "a..net", "example.com:80", "é.net"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/EN/", "/fr/", "/e", "/en/fr/"]
    rows = [(i, f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/en/', '#f', '?://x'])}") for i in range(300)]
    rows += [(900, None), (901, ""), (902, "no scheme"), (None, "http://a.net/en/"), (1, "http://a.net/en/")]
    rules = [("net/", "block"), ("net/en/", "allow"), ("a.net/en", "block"), ("example.com/", "block"), ("m.example.com", "allow"), ("com/en/fr/", "block"), ("a.net/en", "allow"), ("/x", "block")]

    def split(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        tail = rest[cut:]
        end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]

    parsed = {}
    for rule, verdict in rules:
        h, p = split("://" + rule)
        if h:
            parsed[rule] = (h, p, min(v for r, v in rules if r == rule))
    got = {}
    for r in url_filters.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), url_filters.rules_frame(spark, rules)).collect():
        got.setdefault(r.page_id, []).append((r.host, r.path, r.rule, r.verdict))
    for i, url in rows:
        host, path = split(url)
        fits = [(len(rule), len(h), rule) for rule, (h, p, _) in parsed.items() if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits)[2] if fits else None
        assert (host, path, best, parsed[best][2] if best else "allow") in got[i]
    assert sum(map(len, got.values())) == len(rows)
    assert url_filters.judge_urls(spark.createDataFrame([], "page_id long, url string"), url_filters.rules_frame(spark, rules)).count() == 0
    none = url_filters.judge_urls(spark.createDataFrame(rows[:3], "page_id long, url string"), url_filters.rules_frame(spark, rules).limit(0)).collect()
    assert {r.verdict for r in none} == {"allow"}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_sql(spark, sf, duck, name):
    same(queries.QUERIES[name](spark, sf).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df())


def test_media_query(spark, sf):
    import hashlib

    docs = {r.doc_id: r.text or "" for r in queries.table(spark, sf, "documents").collect()}
    for r in queries.op4_media_columns(spark, sf).collect():
        payload = media_columns.padded(docs[r.doc_id].encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(docs[r.doc_id].encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert r.media_sha256 == hashlib.sha256(media_columns.mux(payload)).hexdigest()


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = queries.table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "exact_dedup", "near_dedup", "packing"]
    pieces = corpus_pipeline.run(spark, sf).select("doc_id", "start", "length", "doc_tokens").collect()
    packed = {r.doc_id for r in pieces}
    assert packed and packed < {r.doc_id for r in docs.select("doc_id").collect()}
    for doc in packed:
        mine = [r for r in pieces if r.doc_id == doc]
        assert sum(r.length for r in mine) == mine[0].doc_tokens


def test_pipeline_keeps_what_brute_force_keeps(spark, sf):
    import re

    import corpus_pipeline
    from siftline.llm import near_copies, quality

    docs = queries.table(spark, sf, "documents")
    model = quality.learn(docs, queries.table(spark, sf, "labels").where(~is_held_out(F.col("doc_id"), 5, 0)))
    good = quality.keep_good(docs, model).checkpoint()
    known = language_id.keep_identified(good, language_id.learn(good.where(~is_held_out(F.col("doc_id"), 4, 2)))).select("doc_id", "text").collect()
    exact = {}
    for r in known:
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        exact[key] = min(exact.get(key, (1, 0, "")), (-len(r.text or ""), r.doc_id, r.text or ""))
    left = sorted((i, t) for _, i, t in exact.values())
    sets = [frozenset(near_copies.shingle_set(t.encode()).tolist()) for _, t in left]
    root = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if near_copies.similar(sets[i], sets[j], 0.8) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    want = {left[r][0] for r in root if left[r][1].split()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()} == want


def _tables(spark, folder, rows, labels):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _h string, h long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_with_nulls_copies_and_clashing_names(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    words = {"en": "the cat and dog are here with some more words of plain text".split(), "fr": "le chat et le chien sont ici avec encore des mots simples".split()}
    prose = lambda lang, n: " ".join(rng.choice(words[lang]) + str(rng.randrange(40)) for _ in range(n))
    texts = [(i, prose("en" if i % 2 else "fr", 60)) for i in range(60)]
    hot, near = texts[1][1], texts[3][1].split()
    texts += [(100 + i, hot + " " * (i % 3)) for i in range(40)]  # a third of all rows
    texts += [(200 + i, " ".join([*near[:-1], f"w{i}"])) for i in range(20)]
    rows = [(i, t, "en" if i % 2 or i >= 60 else "fr", "s", len(t), "x", 1) for i, t in texts] + [(None, None, None, None, None, None, None), (900, "", "en", "s", 0, "x", 1), (901, "12 34", None, "s", 5, "x", 1), (1, hot, "en", "s", 9, "y", 2)]
    labels = [(i, 1, 0) for i in range(60)] + [(900, 0, 0), (None, 1, 0)]
    sf = _tables(spark, f"{tmp_path}/a", rows, labels)
    docs, names = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).checkpoint()
        names[name] = docs.columns
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_h", "h"]
    kept = {r.doc_id for r in docs.collect()}
    assert {i for i in kept if i is not None and i < 60} >= set(range(60)) - {1} and not kept & {900, 901, None}
    assert len(kept & {1, *range(100, 140)}) == 1 and not kept & set(range(200, 220))
    packed = {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()}
    assert packed == kept
    empty = _tables(spark, f"{tmp_path}/b", [], [])
    assert corpus_pipeline.run(spark, empty).count() == 0
