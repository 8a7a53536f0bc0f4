"""The registered queries themselves, column by column, against the libraries and brute force."""

import hashlib
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
xxhash = pytest.importorskip("xxhash")

from siftline.llm import byte_bpe, media_columns, queries  # noqa: E402


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in queries.table(spark, sf, "documents").select("doc_id", "text").collect()}


def rows_of(spark, sf, name):
    return queries.QUERIES[name](spark, sf).collect()


def test_op2(spark, sf, texts):
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {d: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4") for d, t in texts.items()}
    pieces, sequences = {}, {}
    for r in rows_of(spark, sf, "op2_packing"):
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and len(part) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d in texts:
        at = 0
        for start, length in sorted(pieces[d]):
            assert start == at
            at += length
        assert at == len(ids[d])
    used = padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        used, padded = used + at, padded + (at if at & (at - 1) == 0 else 1024)
    assert padded < 1.05 * used


def test_op3(spark, sf, texts):
    def fingerprint(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]
        if not words:
            return 0
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
        return sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))

    want = {d: fingerprint(t) for d, t in texts.items()}
    label = {d: d for d in texts}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (want[a] ^ want[b]).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(spark, sf, "op3_simhash")} == {d: (f"{want[d]:016x}", root(d)) for d in texts}


def test_op4(spark, sf, texts):
    for r in rows_of(spark, sf, "op4_media_columns"):
        data = texts[r.doc_id].encode()
        payload = data.ljust(max(192, -(-len(data) // 192) * 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        media = media_columns.mux(payload)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        assert r.codec and r.duration_s > 0 and all(0 < k.start < k.end <= len(media) for k in r.keyframes) and r.keyframes
        assert media[r.keyframes[0].start : r.keyframes[0].end] == payload[: r.keyframes[0].end - r.keyframes[0].start]


def test_op6(spark, sf, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = {d: (len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 4096) for d, t in texts.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows_of(spark, sf, "op6_token_counts")} == want


def test_op10(spark, sf, texts):
    library = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.ByteBPE(P.path("byte_bpe_50k.tiktoken")).ranks, special_tokens={})
    for r in rows_of(spark, sf, "op10_byte_bpe"):
        ids = library.encode_ordinary(texts[r.doc_id])
        offsets = np.r_[0, np.cumsum([len(library.decode_single_token_bytes(i)) for i in ids])].astype("<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.offsets_sha256 == hashlib.sha256(offsets.tobytes()).hexdigest()


def test_another_pattern_is_refused(spark, sf):
    assert byte_bpe.PATTERN == P.PATTERN
    with pytest.raises(ValueError, match="pattern"):
        byte_bpe.encode(queries.table(spark, sf, "documents"), P.path("byte_bpe_50k.tiktoken"), pattern=r"\s+")


def test_extra_columns_of_clashing_names(spark):
    """Columns named like an operator's own neither stop it nor change what comes out."""
    from pyspark.sql import functions as F

    from siftline.llm import fst_tokens, line_dedup, packing

    docs = spark.createDataFrame([(1, "one line here\nanother line"), (2, "one line here"), (None, None), (2, "")], "doc_id long, text string")
    extra = docs
    for name in ("id", "tag", "h", "key", "batch", "pos", "ids", "offsets", "decoded", "n_tokens", "n_bytes", "start", "length", "n"):
        extra = extra.withColumn(name, F.lit("x"))
    for make in (
        line_dedup.line_dedup,
        lambda d: byte_bpe.encode(d, P.path("byte_bpe_50k.tiktoken"), ("ids", "offsets", "decoded")),
        lambda d: fst_tokens.count_tokens(d, P.path("piece_bpe_32k.model"), limit=2),
        lambda d: packing.pack(d, P.path("byte_bpe_50k.json")).select("doc_id", "start", "length", "doc_tokens", "ids"),
    ):
        plain, clashing = (sorted(map(repr, map(tuple, make(d.coalesce(1)).collect()))) for d in (docs, extra))
        assert plain == clashing and len(plain) >= 4


def test_packing_a_very_long_text(spark):
    from siftline.llm import packing

    text = "some words of a long text. " * 40_000
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, P.path("byte_bpe_50k.json")).select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids").collect()
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
    parts = sorted((r.start, bytes(r.ids)) for r in rows if r.doc_id == 1)
    assert b"".join(p for _, p in parts) == want.tobytes()
    assert max(r.offset + r.length for r in rows) <= 1024
