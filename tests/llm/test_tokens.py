"""Tokenizers, packing: against the libraries, and exact round trips."""

import random
import re

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
sentencepiece = pytest.importorskip("sentencepiece")

from siftline.llm import byte_bpe, fst_tokens, packing  # noqa: E402

PARTS = ["'", "'s", "'re", "ve", "ll", "m", " ", "  ", "\n", "\r\n", "\t", "a", "É", "9", "²", "!", "　", "\xa0", "😀", "漢字", "'S", "…", "_", "the", " represent", "ation", "<s>", "</s>", "<0x0A>", "<|endoftext|>", "▁", "____", "\x00", "‍", "0123"]


def texts(seed, n=1500):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(18))) for _ in range(n)] + ["", " ", "ab" * 3000, "x y " * 3000, "." * 999, "漢" * 500]


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBPE(P.path("byte_bpe_50k.tiktoken"), most_cached=500)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@pytest.mark.parametrize("seed", range(3))
def test_byte_bpe_equals_library(bpe, library, seed):
    given = texts(seed)
    for text, ids in zip(given, bpe.encode_batch(given), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()
        assert bpe.offsets(ids)[-1] == len(text.encode())


def test_pieces_equal_pattern():
    regex = pytest.importorskip("regex")
    for text in texts(9, 800):
        points = np.frombuffer((text).encode("utf-32-le"), np.uint32)
        points = np.append(points, 0x110000).astype(np.uint32)
        starts = np.flatnonzero(byte_bpe.piece_starts(points))[:-1].tolist()
        assert starts == [m.start() for m in regex.finditer(P.PATTERN, text)]


def test_encode_frame(spark):
    df = spark.createDataFrame([(1, "hello"), (None, None), (3, ""), (1, "hello")], "doc_id long, text string")
    got = byte_bpe.encode(df, P.path("byte_bpe_50k.tiktoken"), ("ids", "offsets", "decoded")).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded), len(r.offsets)) for r in got) == [("1", b"hello", 8), ("1", b"hello", 8), ("3", b"", 4), ("None", b"", 4)]
    assert byte_bpe.encode(df.limit(0), P.path("byte_bpe_50k.tiktoken")).count() == 0


@pytest.fixture(scope="module")
def counter():
    return fst_tokens.Transducer(fst_tokens.read_vocabulary(P.path("piece_bpe_32k.model")), most_states=3000, most_words=200)


@pytest.mark.parametrize("chunk", [5, 64, 1 << 16])
def test_counts_equal_library(counter, chunk, monkeypatch):
    monkeypatch.setattr(fst_tokens, "_CHUNK", chunk)
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    given = [t for t in texts(chunk, 700) if len(t) < 200 or chunk > 5]
    assert [counter.count(t) for t in given] == [len(x) for x in sp.encode(given)]


def test_maps_compose_in_any_order(counter):
    begin, parts = counter.start.places, ("▁the▁re", "present", "ation▁", "▁▁x", "y▁z")
    guesses = [begin, begin, counter.run("▁a", counter.start)[0].places]  # true or not
    for guess in guesses:
        maps = [counter.chunk(x, begin if not i else guess) for i, x in enumerate(parts)]
        left = maps[0]
        for m in maps[1:]:
            left = left.then(m)
        right = maps[-1]
        for m in maps[-2::-1]:
            right = m.then(right)
        assert left.at(begin) == right.at(begin) and left.at(begin)[1] == counter.run("".join(parts), counter.start)[1]


@pytest.mark.parametrize("sign", ["a", "漢", ".", " ", "ab"])
def test_counts_of_long_texts_without_a_break(counter, sign):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    text = sign * 200_000
    assert counter.count(text) == len(sp.encode(text))


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, "." * 200_000, "a \n\n b's" * 90_000, "x" + "\t" * 400_000 + "y z"])
def test_long_texts(bpe, library, text, monkeypatch):
    ids = packing.ids_of(P.path("byte_bpe_50k.json"))
    assert ids.encode(text).tolist() == ids.library.encode(text, add_special_tokens=False).ids
    got = bpe.encode_long(text)
    assert bpe.decode(got) == text.encode()
    monkeypatch.setattr(byte_bpe, "_PART", 1 << 30)
    assert got == bpe.encode_batch([text])[0]


def test_count_frame(spark):
    df = spark.createDataFrame([(1, "a " * 5000), (2, None), (None, "x")], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.over_limit) for r in fst_tokens.count_tokens(df, P.path("piece_bpe_32k.model")).collect()}
    assert got == {1: (10000, True), 2: (0, False), None: (1, False)}
    assert fst_tokens.count_tokens(df.limit(0), P.path("piece_bpe_32k.model")).count() == 0


def test_packing_ids_equal_library():
    ids = packing.ids_of(P.path("byte_bpe_50k.json"))
    assert ids.fast is not None
    for text in texts(4, 400):
        assert ids.encode(text).tolist() == ids.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("lengths", [[7] * 3, [1024] * 5, [1], [1, 2, 5, 127, 128, 129, 300, 1023, 1025, 5000] * 40])
def test_packer_cuts_each_token_once(lengths):
    packer, out = packing.Packer(), []
    for i, n in enumerate(lengths):
        out += packer.add(i, n)
        if i % 100 == 99:
            out += packer.pack()
    out += packer.pack()
    closed = len(out)
    out += packer.pack(last=True)
    assert len(out) - closed <= 1 and all(sum(p[2] for p in ps) == w for w, ps in out[:closed])
    seen = {}
    for _, pieces in out:
        assert sum(p[2] for p in pieces) <= 1024
        for doc, start, length in pieces:
            seen.setdefault(doc, []).append((start, length))
    for i, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at and length > 0
            at += length
        assert at == n


def test_step_groups_are_balanced():
    windows = [1024] * 50 + [512] * 33 + [128] * 7
    groups = packing.step_groups(windows, 8192)
    loads = {}
    for w, g in zip(windows, groups, strict=True):
        loads[g] = loads.get(g, 0) + w
    assert max(loads.values()) - min(loads.values()) <= 1024 and max(loads.values()) <= 8192 + 1024


def test_pack_frame(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(999)}" for _ in range(rng.randrange(900)))) for i in range(80)] + [(80, None), (81, "a<|endoftext|>b"), (None, "x"), (5, "again")]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), P.path("byte_bpe_50k.json")).collect()
    by_sequence = {}
    for r in out:
        assert len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    ids = packing.ids_of(P.path("byte_bpe_50k.json"))
    for doc, text in rows[:5] + rows[80:83]:
        mine = sorted((r.start, bytes(r.ids)) for r in out if r.doc_id == doc and r.doc_tokens == len(ids.encode(text or "")) + 1)
        assert b"".join(b for _, b in mine) == np.append(ids.encode(text or ""), 0).astype("<u4").tobytes()
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), P.path("byte_bpe_50k.json")).count() == 0
    assert re.fullmatch(r"\d+", str(out[0].step_group))
