"""Suffix dedup, vector codes and fill-in-middle: against brute force, exact round trips and SQL."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("xxhash")

from pyspark.sql import functions as F  # noqa: E402

from siftline.llm import fill_in_middle, lyndon, suffix_dedup, vector_codes  # noqa: E402

# ---- suffix orders ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("letters", [1, 2, 3, 26])
def test_suffix_order_is_sorted(letters):
    rng = random.Random(letters)
    for _ in range(60):
        symbols, bounds = [0], [0, 1]
        for _ in range(rng.randrange(1, 8)):
            for _ in range(rng.randrange(1, 6)):
                symbols += [rng.randrange(1, letters + 1) for _ in range(rng.randrange(1, 40))] + [0]
            bounds.append(len(symbols))
        order = lyndon.suffix_order(np.array(symbols), np.array(bounds)).tolist()

        def suffix(at, symbols=symbols):
            return symbols[at : symbols.index(0, at)]

        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            assert sorted(order[a:b]) == list(range(a, b))
            seen = [suffix(p) for p in order[a:b]]
            assert seen == sorted(seen)


# ---- suffix dedup -----------------------------------------------------------------------------------------------------


def brute_repeats(texts: list[bytes], length: int):
    where = defaultdict(int)
    for t in texts:
        for i in range(len(t) - length + 1):
            where[t[i : i + length]] += 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if where[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((bytes(np.frombuffer(t, np.uint8)[~gone]), len(t), int(gone.sum()), runs))
    return out


def given_texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghé漢") for _ in range(rng.randrange(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(6) for _ in range(4)]
    texts = ["", "ab", "x" * 300, "ab " * 90, "abcabcabd" * 20]
    for _ in range(50):
        parts = [prose(rng.randrange(0, 8)) for _ in range(rng.randrange(1, 5))]
        if rng.random() < 0.7:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        texts.append(" ".join(parts))
    texts += texts[5:9] + [t + " " + prose(3) for t in texts[9:14]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("length", "most"), [(12, 64), (25, 2), (7, 3), (40, 1), (1, 8)])
def test_repeats_equal_brute_force(spark, length, most):
    texts = given_texts(length)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs, length, most).collect()}
    want = brute_repeats([t.encode() for t in texts], length)
    assert len(got) == len(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_hot_passage_below_and_above_length(spark):
    """One passage in all rows, as a third-of-all-rows bucket: dealt anew, and nothing in it is lost or made up."""
    rng = random.Random(5)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for size in (35, 60):
        passage = prose(size)
        texts = [prose(30) + passage + prose(30) for _ in range(150)] + [prose(90) for _ in range(20)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs, 40, 4).collect()}
        assert [got[i] for i in range(len(texts))] == brute_repeats([t.encode() for t in texts], 40)


def test_repeats_edges(spark):
    text = "the same passage of some length, more than thirty bytes"
    rows = [(1, text, "a"), (1, text, "b"), (None, text[:20], "c"), (2, None, "d"), (3, "", "e"), (None, None, "f"), (4, "alone and never seen anywhere else at all", "g")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, body string").withColumn("ref", F.lit(1)).withColumn("key", F.lit(2))
    got = sorted((str(r.doc_id), bytes(r.kept), r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs, 30).collect())
    n = len(text)
    assert got == sorted([("1", b"", n, 1), ("1", b"", n, 1), ("None", text[:20].encode(), 0, 0), ("2", b"", 0, 0), ("3", b"", 0, 0), ("None", b"", 0, 0), ("4", rows[-1][1].encode(), 0, 0)])
    assert suffix_dedup.remove_repeats(docs.limit(0), 30).count() == 0
    with pytest.raises(TypeError):
        suffix_dedup.remove_repeats(docs.withColumn("doc_id", F.lit("x")))


def test_long_text_by_pieces(monkeypatch):
    rng = random.Random(3)
    text = bytes(rng.randrange(97, 100) for _ in range(4000))
    whole = [x for part in suffix_dedup.segments([text], 50, 0) for x in zip(*[c.tolist() for c in part], strict=True)]
    monkeypatch.setattr(suffix_dedup, "PIECE", 333)
    parts = [x for part in suffix_dedup.segments([text, text[:60]], 50, 0) for x in zip(*[c.tolist() for c in part], strict=True)]
    windows = lambda rows, text: sorted((x[1] + i, x[3]) for x in rows if x[0] == text for i in range(x[2]))
    assert windows(parts, 0) == windows(whole, 0)
    assert [at for at, _ in windows(parts, 1)] == list(range(11))


# ---- vector codes -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("width", [1, 2, 4, 6, 16])
def test_nearest_equals_exact(width):
    rng = np.random.default_rng(width)
    for scale in (3, 300, 500_000):
        parts, entries = rng.integers(-scale, scale, (300, width)), rng.integers(-scale, scale, (40, width))
        entries[7] = entries[3]
        parts[:5] = entries[3]
        far = ((parts[:, None] - entries[None]) ** 2).sum(-1)
        tally = {}
        best, least = vector_codes.nearest(parts, entries, tally)
        assert best.tolist() == far.argmin(1).tolist()
        assert least.tolist() == far.min(1).tolist()
        assert tally["level 0"] == 300 * 40
        assert tally[f"level {len(vector_codes.blocks(width))}"] < 300 * 40
        slow = vector_codes.nearest(parts.astype(object), entries.astype(object))
        assert (slow[0].tolist(), slow[1].tolist()) == (best.tolist(), least.tolist())


def brute_codes(rows, parts, entries, rounds):
    kept = sorted([r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])], key=lambda r: r[0])
    x = np.array([[int(np.floor(256 * v)) for v in r[1]] for r in kept], np.int64).reshape(len(kept), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]

    def assign(p):
        far = ((x[:, p][:, None] - books[p][None]) ** 2).sum(-1)
        return far.argmin(1), far.min(1)

    for _ in range(rounds):
        for p in range(parts):
            best, _ = assign(p)
            books[p] = np.array([x[best == e, p].sum(0) // (best == e).sum() if (best == e).any() else books[p][e] for e in range(len(books[p]))])
    found = [assign(p) for p in range(parts)]
    error = sum(f[1] for f in found)
    by_label = defaultdict(int)
    for r, e in zip(kept, error.tolist(), strict=True):
        by_label[r[2]] += e
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b.tolist() for v in e).encode()).hexdigest()
    return {r[0]: ("".join(f"{f[0][i]:02x}" for f in found), int(error[i]), by_label[r[2]]) for i, r in enumerate(kept)}, sha


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(3).tolist(), [None, 0, 1][i % 3]) for i in range(200)]
    rows += [(500, None, 1), (501, [1.0] * 7 + [None], 1), (502, [1.0] * 7 + [float("nan")], 0), (503, [float("-inf")] + [1.0] * 7, 0), (504, rows[3][1], 1), (505, [1.0] * 7, 1), (506, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit("x")).withColumn("vector", F.lit(1)).repartition(4)
    got, books = vector_codes.compress(frame, parts=4, entries=8)
    want, sha = brute_codes(rows[:200] + [rows[204]], 4, 8, 2)
    assert {r.vec_id: (r.code, r.error, int(r.label_error)) for r in got.collect()} == want
    assert vector_codes.digest(books) == sha


def test_codes_edges(spark):
    schema = "vec_id long, embedding array<float>, label string"
    none = spark.createDataFrame([], schema)
    got, books = vector_codes.compress(none, parts=2)
    assert got.count() == 0 and sum(map(len, books)) == 0
    few = spark.createDataFrame([(None, [1.0, 2.0], "a"), (2, [3.0, -4.0], None), (2, [3.0, -4.0], None)], schema)
    got, books = vector_codes.compress(few, parts=2)
    assert [len(b) for b in books] == [3, 3]
    assert sorted((str(r.vec_id), r.code, r.error) for r in got.collect()) == [("2", "0000", 0), ("2", "0000", 0), ("None", "0202", 0)]
    huge = spark.createDataFrame([(1, [3e38, -1.0], "a"), (2, [1.0, 1.0], "a"), (3, [-3e38, 1.0], "b")], schema)
    got, books = vector_codes.compress(huge, parts=2, entries=2)
    assert max(map(abs, books[0].ravel().tolist())) <= vector_codes.MOST
    assert {r.vec_id: r.code for r in got.collect()}[1] == "0000"


# ---- fill-in-middle ---------------------------------------------------------------------------------------------------


def brute_fim(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm_rate else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 8192])
def test_fill_in_middle_equals_brute_force(spark, chunk):
    rng = random.Random(chunk)
    texts = [None, "", "\n", "\n\n", "a", "a\n", "\na", "é\n漢字\n😀", "x <P> y\nz", "<", "ends with <\nand <S"]
    texts += ["".join(rng.choice(["\n", "a", "bc", "é", "漢", "<", "<P", ">", "S>"]) for _ in range(rng.randrange(40))) for _ in range(120)]
    rows = [(i if i % 11 else None, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, output string, n int").repartition(3)
    for rate in (100, 50):
        got = fill_in_middle.fill_in_middle(docs, fill_in_middle.seeded_draws(F.col("doc_id"), "7"), rate, chunk=chunk).collect()
        want = [(d, *brute_fim(d, t, rate), t or "") for d, t, _ in rows]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_fill_in_middle_refuses_tokens(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for tokens in (("<P>", "<P>x", "<M>"), ("aba", "b", "c"), ("", "b", "c"), ("ab", "bc", "d")):
        with pytest.raises(ValueError, match="token"):
            fill_in_middle.fill_in_middle(docs, [F.lit(1)] * 4, tokens=tokens)


def test_fill_in_middle_long_text(spark):
    text = "line of text\n" * 300_000
    docs = spark.createDataFrame([(5, text)], "doc_id long, text string")
    row = fill_in_middle.fill_in_middle(docs, fill_in_middle.seeded_draws(F.col("doc_id"), "7")).first()
    assert (row.n, row.form, row.prefix_chars, row.middle_chars, row.output) == brute_fim(5, text)
    assert row.restored == text


@pytest.mark.parametrize("name", ["op11_suffix_dedup", "op12_vector_codes", "op13_fill_in_middle"])
def test_queries_equal_sql(spark, sf, duck, name):
    from compare import same
    from siftline.llm import queries

    same(queries.QUERIES[name](spark, sf).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df())
