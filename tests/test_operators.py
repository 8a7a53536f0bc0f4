"""Operators on small frames: ties, nulls, empty inputs, order of rows."""

import random

import pytest
from pyspark.sql import functions as F

from siftline.operators import aggregates, cache, coverage, eligibility, fold, graph, identity, order, pick, similarity
from siftline.streaming import queue, sequences, suppression


def test_best_contact_ties_take_the_largest_id(spark):
    rows = [(1, 1, "a", "unknown", "m", "", 2), (1, 1, "b", "unknown", "m", "", 2), (1, 1, "c", "rejected", "m", "p", 9), (2, 1, "d", "rejected", "m", "", 1)]
    df = spark.createDataFrame(rows, "lead_event_id int, person_id int, contact_candidate_id string, verification_status string, email string, phone string, evidence_count int")
    assert {r.contact_candidate_id: r.selected for r in pick.select_best_contacts(df).collect()} == {"a": False, "b": True, "c": False, "d": False}


def test_exact_duplicates_take_the_smallest_id(spark):
    rows = [("u", "b", "valid", None, "long"), ("u", "a", "valid", None, "long"), ("u", "c", "review", None, "longest")]
    df = spark.createDataFrame(rows, "canonical_url string, candidate_id string, record_status string, published_at timestamp, title string")
    assert [tuple(r) for r in pick.exact_duplicates(df).collect()] == [("u", "a", ["a", "b", "c"])]
    assert [tuple(r) for r in pick.exact_winners(df).collect()] == [("u", "a", 3)]


def test_anchor_prefers_a_zero_score_to_none(spark):
    rows = [(1, 10, None, "high", "2024-01-01"), (1, 11, 0, "low", None), (1, 12, 0, "low", "2024-01-01"), (1, 13, 0, "low", "2024-01-01")]
    df = spark.createDataFrame(rows, "company_id int, lead_event_id int, score int, priority string, date_posted string").withColumn("date_posted", F.col("date_posted").cast("date"))
    assert pick.anchor_events(df).first().lead_event_id == 12


def test_merge_contacts(spark):
    df = spark.createDataFrame([(["A  b | x", " "], ["a B | y", "c", "d", "e"]), (None, None)], "a array<string>, b array<string>")
    got = [r[0] for r in df.select(pick.merge_contacts("a", "b")).collect()]
    assert (got[0].kept, got[0].overflow) == (["A  b | x", "c", "d"], ["e"]) and got[1].kept == []


def test_identity_collisions_count_returns(spark):
    df = spark.createDataFrame([("x", i, v) for i, v in enumerate("ABA")] + [("", 9, "A")], "id string, pos int, v string")
    assert pick.identity_collisions(df, "id", ["v"], [F.col("pos")]).where("collision").count() == 3


@pytest.mark.parametrize("seed", range(3))
def test_folds_do_not_depend_on_order(spark, seed):
    rows = [("k", 1, "a", "x", 5), ("k", 2, None, "", 3), ("k", 3, "b", None, 4), ("l", 1, None, None, None)]
    random.Random(seed).shuffle(rows)
    log = spark.createDataFrame(rows, "key string, seq int, v string, w string, n int")
    rules = {"v": fold.COALESCE, "w": fold.NON_EMPTY, "n": fold.MAX}
    assert {r.key: tuple(r)[1:] for r in fold.fold(log, ["key"], "seq", rules).collect()} == {"k": ("b", "x", 5), "l": (None, None, None)}
    last = {r.key: (r.v, r.w) for r in fold.fold(log, ["key"], "seq", {"v": fold.LAST, "w": fold.LAST}).collect()}
    assert last == {"k": ("b", None), "l": (None, None)}
    once = fold.upsert(fold.fold(log, ["key"], "seq", rules), log, ["key"], "seq", rules)
    assert {r.key: tuple(r)[1:] for r in once.collect()} == {"k": ("b", "x", 5), "l": (None, None, None)}


def test_patch_sets_null(spark):
    log = spark.createDataFrame([("k", 1, {"a": "1"}), ("k", 2, {"a": None}), ("k", 3, {"b": "2"}), ("k", 4, {})], "key string, seq int, p map<string,string>")
    assert tuple(fold.patch_fold(log, ["key"], "seq", "p", ["a", "b"]).first()) == ("k", None, "2")
    assert [r.seq for r in fold.unknown_columns(log, "p", ["a"]).orderBy("seq").collect()] == [3, 4]


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "k string, n int")
    old = spark.createDataFrame([("b", 0)], "k string, n int")
    assert [tuple(r) for r in fold.insert_if_absent(old, new, ["k"], [F.col("n").alias("n")]).collect()] == [("a", 1)]


def test_grouping_problems(spark):
    expected = spark.createDataFrame([(b, i) for b in "abc" for i in "12"], "batch_id string, id string")
    groups = spark.createDataFrame([("a", "1", ["1", "2"]), ("b", "1", ["1", "1", "9"]), ("c", "2", ["1"]), ("c", "2", ["2"])], "batch_id string, kept_id string, member_ids array<string>")
    got = {r.batch_id: r.problems for r in coverage.grouping_problems(expected, groups).collect()}
    assert got == {"b": ["duplicate", "missing", "unknown"], "c": ["kept_not_member"]}


def test_connected_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 140)]
    nodes = sorted({x for e in edges for x in e} | set(range(80)))
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = graph.connected(spark.createDataFrame([(n,) for n in nodes], "node int"), spark.createDataFrame(edges, "a int, b int"))
    assert {r.node: r.component for r in got.collect()} == {n: find(n) for n in nodes}


def test_jaccard_pairs_equal_brute_force(spark):
    rng = random.Random(2)
    sets = [(i, sorted({rng.choice("abcdefgh") for _ in range(rng.randrange(6))})) for i in range(40)]
    for t in (0.3, 0.5, 0.8, 1.0):
        want = {(a, b) for a, x in sets for b, y in sets if a < b and x and y and len(set(x) & set(y)) / len(set(x) | set(y)) >= t}
        got = similarity.jaccard_pairs(spark.createDataFrame(sets, "key int, tokens array<string>"), t)
        assert {(r.a, r.b) for r in got.collect()} == want


def test_cross_run_duplicates(spark):
    schema = "company_key string, lead_event_id string, event string, location string, date_posted string, canonical_url string"
    history = [("acme", "h1", "Acme opens 250 unit tower", "Mesa", "2024-01-01", "u1")]
    now = [
        ("acme", "e1", "Something else entirely", "Mesa", "2024-06-01", "u1"),
        ("acme", "e2", "Acme tower with 250 homes", "Mesa", "2024-01-10", "u2"),
        ("acme", "e3", "Acme tower with 250 homes", "Tempe", "2024-01-10", "u3"),
        ("acme", "e4", "Acme tower with 250 homes", "Mesa", "2024-03-10", "u4"),
        ("acme", "e5", "Acme tower with 250 homes", "Mesa", None, "u5"),
        ("beta", "e6", "Acme opens 250 unit tower", "Mesa", "2024-01-01", "u1"),
    ]
    frame = lambda rows: spark.createDataFrame(rows, schema).withColumn("date_posted", F.col("date_posted").cast("date"))
    got = {r.lead_event_id: r.duplicate_of for r in similarity.cross_run_duplicates(frame(now), frame(history)).collect()}
    assert got == {"e1": "h1", "e2": "h1", "e3": None, "e4": None, "e5": None, "e6": None}


@pytest.mark.parametrize("seed", [1, 2])
def test_cross_run_duplicates_equal_steps(spark, seed):
    """Against one event after the other: chains, ties, a company with a third of all events, history on both sides."""
    import datetime

    rng = random.Random(seed)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    rows = []
    for i in range(240):
        company = "hot" if i % 3 == 0 else f"c{rng.randrange(4)}"
        when = None if rng.random() < 0.05 else rng.randrange(900)
        rows.append((company, f"e{i:03}", "250 homes", "", when, f"u{rng.randrange(60)}" if rng.random() < 0.2 else "", rng.random() < 0.15))
    rows += [("chain", f"k{i:03}", "250 homes", "", 20 * i, "", False) for i in range(40)]  # each pairs with the one before only
    schema = "company_key string, lead_event_id string, event string, location string, date_posted date, canonical_url string"
    frame = lambda some: spark.createDataFrame([(*r[:4], None if r[4] is None else day(r[4]), r[5]) for r in some], schema)
    now, past = [r for r in rows if not r[6]], [r for r in rows if r[6]]
    want, standing = {}, list(past)
    for r in sorted(now, key=lambda r: (r[0], -(2**31) if r[4] is None else r[4], r[1])):
        near = [p for p in standing if p[0] == r[0] and ((r[5] and p[5] == r[5]) or (None not in (p[4], r[4]) and abs(p[4] - r[4]) <= 21))]
        first = min(near, key=lambda p: (not p[6], -(2**31) if p[4] is None else p[4], p[1]), default=None)
        want[r[1]] = first and first[1]
        if not first:
            standing.append(r)
    got = similarity.cross_run_duplicates(frame(now), frame(past)).collect()
    assert {r.lead_event_id: r.duplicate_of for r in got} == want and len(got) == len(now)
    assert similarity.cross_run_duplicates(frame(now).limit(0), frame(past)).count() == 0


def test_resolve_and_align(spark):
    schema = "company_id string, domain string, names array<string>"
    old = spark.createDataFrame([("A", "a.com", ["Acme, Inc."]), ("B", "", ["Beta"])], schema)
    new = spark.createDataFrame([("n1", "", ["acme inc", "Gamma"]), ("n2", "", ["Gamma"]), ("n3", "", ["acme inc", "beta"]), ("n4", "z.com", ["Z"])], schema)
    got = {r.request_id: (r.company_id, r.ambiguous) for r in identity.resolve_companies(new.withColumnRenamed("company_id", "request_id"), old).collect()}
    assert got == {"n1": ("A", False), "n2": (None, False), "n3": (None, True), "n4": (None, False)}
    aligned = {r.company_id: r.aligned_id for r in identity.align_companies(new.where("company_id <> 'n3'"), old).collect()}
    assert aligned == {"n1": "A", "n2": "A", "n4": "n4"}


def test_alignment_by_increments_equals_one_run(spark):
    rng = random.Random(3)
    rows = [(i, f"d{rng.randrange(40)}.com" if rng.random() < 0.4 else "", [f"name {rng.randrange(90)}" for _ in range(rng.randrange(3))]) for i in range(90)]
    rows += [(200 + i, "everyone.com", []) for i in range(20)]
    schema = "company_id long, domain string, names array<string>"
    frame = lambda some: spark.createDataFrame(some, schema)
    want = {r.company_id: r.label for r in identity.align_increment(frame(rows))[0].collect()}
    nodes = {r[0] for r in rows}
    assert set(want) == nodes
    rng.shuffle(rows)
    labels = keys = None
    before = {}
    for i in range(3):
        labels, keys, merged = identity.align_increment(frame(rows[i * 37 : i * 37 + 37]), labels, keys)
        labels, keys, gone = order.cut(labels), order.cut(keys), {r.label: r.into for r in merged.collect()}
        now = {r.company_id: r.label for r in labels.collect()}
        assert {c: gone.get(x, x) for c, x in before.items()} == {c: now[c] for c in before}  # nothing but merged labels changes
        before = now
    group = lambda found: {frozenset(c for c in found if found[c] == x) for x in set(found.values())}
    assert group(before) == group(want) and labels.count() == len(nodes)
    assert len(group(want)) < len(nodes) - 20
    again, _, merged = identity.align_increment(frame(rows[:5]), labels, keys)
    assert {r.company_id: r.label for r in again.collect()} == before and merged.count() == 0


def test_snapshot_increments_equal_the_whole_log(spark, tmp_path):
    """In any order of batches, late rows included; only touched buckets are written; a reader sees whole versions."""
    from siftline.operators.snapshot import Snapshot

    rng = random.Random(8)
    rules = {"a": fold.LAST, "b": fold.COALESCE, "c": fold.NON_EMPTY, "d": fold.MAX, "e": fold.FIRST, "f": fold.MIN}
    pick_one = lambda: rng.choice([None, "", "x", "y", "z"])
    rows = [(f"k{rng.randrange(12)}", i, pick_one(), pick_one(), pick_one(), rng.choice([None, 1, 5]), pick_one(), rng.randrange(9)) for i in range(200)]
    schema = "key string, seq long, a string, b string, c string, d int, e string, f int"
    whole = fold.fold(spark.createDataFrame(rows, schema), ["key"], "seq", rules)
    read = lambda df: sorted((tuple(r) for r in df.select("key", *rules).collect()), key=repr)
    rng.shuffle(rows)
    store = Snapshot(spark, str(tmp_path / "s"), ["key"], "seq", rules, buckets=4, most_files=2)
    assert store.read() is None and store.version() == 0
    seen = []
    for i in range(8):
        assert store.add(spark.createDataFrame(rows[25 * i : 25 * i + 25], schema), i)
        seen.append(read(store.read()))
    assert seen[-1] == read(whole)
    assert not store.add(spark.createDataFrame(rows[:25], schema), 7)  # the last batch again
    assert [read(store.read(v)) for v in range(1, 9)] == seen  # as of every version
    listed = store._listing()
    one = spark.createDataFrame([("k1", 999, "new", None, None, None, None, None)], schema)
    store.add(one, 8)
    touched = {r.bucket for r in store._listing()} & {r.bucket for r in store._listing() if (r.bucket, r.path) not in {(x.bucket, x.path) for x in listed}}
    assert len(touched) == 1
    assert {r.key: r.a for r in store.read().collect()}["k1"] == "new"
    store.add(one.limit(0), 9)
    assert store.version() == 10 and len(read(store.read())) == 12


def test_spend_cap_loses_no_row(spark):
    rows = [(1, 9), (1, 5), (2, 7), (3, 1), (1, 9)]
    first, rest = pick.spend_cap(spark.createDataFrame(rows, "a int, b int"), [F.col("b").desc()], 1)
    assert first.collect() == [(1, 9)] and sorted(map(tuple, rest.collect())) == [(1, 5), (1, 9), (2, 7), (3, 1)]


def test_clusters_pair_no_two_titles_of_one_set(spark):
    titles = [f"Unit {i} sold" for i in range(60)] + ["unit sold downtown", "other thing", "12", "13", "unit sold"]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    got = {r.title: r.component for r in similarity.title_clusters(df, 0.5).collect()}
    assert len(got) == 65 and {got[f"Unit {i} sold"] for i in range(60)} == {"Unit 0 sold"} and got["unit sold downtown"] == got["unit sold"] == "Unit 0 sold"
    assert (got["12"], got["13"], got["other thing"]) == ("12", "13", "other thing")


def test_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert {r.k: r.n for r in order.numbered(df, ["k"]).collect()} == {i: i + 1 for i in range(1000)}
    assert order.numbered(df.limit(0), ["k"]).count() == 0


def test_usage_counts_booleans_and_skips_text(spark):
    df = spark.createDataFrame([(1, True, '{"a": 1.9, "b": true, "c": "7", "d": {"e": 1}}'), (1, False, '{"a": 1.9}'), (1, None, "bad")], "k int, billable boolean, usage_json string")
    odd = spark.createDataFrame([(2, None, '{"tokens": 5, "detail": {"tokens": "many"}}'), (2, None, "[1, 2]"), (2, None, None), (2, None, '{"x.y": -2.7, "z": null}')], df.schema)
    assert {r.name: r.total for r in aggregates.usage_summary(odd, ["k"]).collect()} == {"tokens": 5, "x.y": -2, "attempts": 4, "billable": 0}
    got = {r.name: r.total for r in aggregates.usage_summary(df, ["k"]).collect()}
    assert got == {"a": 2, "b": 1, "attempts": 3, "billable": 1}


def test_keyed_union_keeps_first_place_and_last_value(spark):
    df = spark.createDataFrame([("x", 1, [("a", "1"), ("b", "1")]), ("x", 2, [("a", "2"), ("c", "1")])], "k string, o int, items array<struct<url:string,v:string>>")
    assert [tuple(i) for i in aggregates.keyed_union(df, ["k"], "items", "url", "o").first()["items"]] == [("a", "2"), ("b", "1"), ("c", "1")]


def test_promotion_gate(spark):
    card = lambda *days: spark.createDataFrame([(i, g, b) for i, (g, b) in enumerate(days)], "day int, green boolean, invalid boolean")
    decide = lambda *d: aggregates.promotion_gate(card(*d)).first().decision
    assert decide((True, False), (True, False), (False, False)) == "promote_v2"
    assert decide((True, False), (True, False), (False, True)) == "retain_v1"
    assert decide((True, False)) == "error_needs_three_days"


def test_cache(spark):
    now = F.lit("2024-01-02").cast("timestamp")
    entries = spark.createDataFrame([("a", None), ("b", "2024-01-01"), ("c", "2024-01-03")], "cache_key string, expires_at string").withColumn("expires_at", F.col("expires_at").cast("timestamp"))
    hits, misses = cache.lookup(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "cache_key string"), entries, now)
    assert sorted(r.cache_key for r in hits.collect()) == ["a", "c"] and sorted(r.cache_key for r in misses.collect()) == ["b", "d"]


def test_queue(spark):
    rows = [(1, "pending", "2024-01-01", None, 0), (2, "running", "2024-01-01", "2024-01-01", 7), (3, "running", "2024-01-01", "2024-02-01", 1), (4, "pending", "2024-03-01", None, 0), (5, "completed", "2024-01-01", None, 1)]
    items = spark.createDataFrame(rows, "id int, status string, run_after string, lease_until string, attempt_count int")
    items = items.withColumns({c: F.col(c).cast("timestamp") for c in ("run_after", "lease_until")})
    now = F.lit("2024-01-15").cast("timestamp")
    claimed = queue.claim(items, now, "w", 10, 5)
    assert [(r.id, r.attempt_count) for r in claimed.orderBy("id").collect()] == [(1, 1), (2, 8)]
    assert [r.status for r in queue.after_retry(claimed, now, 8).orderBy("id").collect()] == ["pending", "dead_letter"]
    assert [r.attempt_count for r in queue.after_defer(claimed, now).orderBy("id").collect()] == [0, 7]


def test_recipient_reasons(spark):
    row = (1, 100, "Ann", "c", "p", "k", "valid", "review", "low", "e", "valid", "high", 0)
    schema = "rank int, role_score int, first_name string, company_id string, person_id string, contact_candidate_id string, profile_status string, why_line_status string, why_confidence string, anchor_id string, anchor_status string, anchor_confidence string, anchor_score int"
    held = spark.createDataFrame([("e",)], "record_id string")
    got = eligibility.recipient_eligibility(spark.createDataFrame([row], schema), held).first()
    assert got.eligibility_reasons == ["why_line_status_review", "why_line_confidence_low", "anchor_score_zero", "blocking_open_review"] and got.eligibility_status == "blocked"


def test_sequences_and_suppression(spark):
    batch = spark.createDataFrame([("c", "m", "2024-02-01", None, {"s1": "h1", "s2": "h2"})], "campaign_id string, manifest_hash string, expires_at string, revoked_at string, merge_hashes map<string,string>")
    seq = spark.createDataFrame([("s1", "c", "m", "h1"), ("s2", "c", "m", "other")], "sequence_id string, campaign_id string, manifest_hash string, merge_hash string")
    assert [r.sequence_id for r in sequences.approved(seq, batch, F.lit("2024-01-01")).collect()] == ["s1"]
    assert sequences.approved(seq, batch, F.lit("2024-03-01")).count() == 0
    mail = spark.createDataFrame([(" A@x.com",), ("b@x.com",)], "email string")
    assert [r.email for r in suppression.may_send(mail, spark.createDataFrame([("a@X.com",)], "email string")).collect()] == ["b@x.com"]


def test_group_writes(spark):
    frame = spark.createDataFrame
    state = frame([("r1", 1), ("r1", 2), ("r2", 1)], "run_id string, id int")
    assert sorted(map(tuple, fold.prune(state, frame([(2,)], "id int"), "r1", "id").collect())) == [("r1", 2), ("r2", 1)]
    bridge = frame([("s1", "a"), ("s1", "b"), ("s2", "c")], "seq string, e string")
    assert sorted(map(tuple, fold.replace_groups(bridge, frame([("s1", "z")], "seq string, e string"), "seq").collect())) == [("s1", "z"), ("s2", "c")]
    moved = fold.transition(frame([(1, "new"), (2, "new")], "id int, status string"), frame([(1, None), (9, "x")], "id int, value string"), "id", "status")
    assert sorted(map(tuple, moved.collect()), key=str) == [(1, None), (2, "new")]
    names = fold.alias_bridge(frame([(1, "Acme, Inc", ["ACME inc", "Beta"]), (2, "Z", None)], "organization_id int, canonical_name string, aliases array<string>"))
    assert sorted(map(tuple, names.collect())) == [(1, "acme inc"), (1, "beta"), (2, "z")]
    assert fold.key_violations(state, ["id"]).count() == 1
    stored = frame([("2c26b46b68ffc68ff99b453c1d30413413422d706483bfa0f98a5e886266e7ae", "x")], "token_hash string, email string")
    assert [r.email for r in fold.resolve_tokens(frame([("foo",), ("bar",)], "token string"), stored).collect()] == ["x"]


def test_ordered_picks(spark):
    frame = spark.createDataFrame
    assert frame([([" A@x", "a@X", "", "b@x"],)], "m array<string>").select(pick.unique_recipients("m")).first()[0] == ["a@x", "b@x"]
    rows = frame([("k", i) for i in (3, 1, 2)] + [("l", 5)], "k string, n int")
    assert {r.k: [x.n for x in r.rows] for r in pick.samples(rows, ["k"], [F.col("n")], 2).collect()} == {"k": [1, 2], "l": [5]}
    got = pick.backlog_first(frame([("b", 5)], "id string, at int"), frame([("a", 1)], "id string, at int"), "at", "id")
    assert [r.id for r in got.collect()] == ["b", "a"]
    first, rest = pick.spend_cap(frame([(i,) for i in range(5)], "id int"), [F.col("id").desc()], 2)
    assert sorted(r.id for r in first.collect()) == [3, 4] and sorted(r.id for r in rest.collect()) == [0, 1, 2]
    df = frame([("qualify", "open", 0), ("score", "open", 0), ("discover", "resolved", 0)], "stage string, state string, retry_count int")
    assert pick.retry_stage(df, ["discover", "qualify", "score"], 3).first().stage == "qualify"


def test_spread_deals_small_rows_to_many_tasks(spark):
    df = order.spread(spark.range(100, numPartitions=1), 30)
    assert df.rdd.getNumPartitions() == 4 and sorted(r.id for r in df.collect()) == list(range(100))
    assert order.spread(spark.range(0), 30).count() == 0


def test_a_recipient_id_that_all_have_is_no_hot_key(spark, monkeypatch):
    monkeypatch.setattr(eligibility, "HOT_ROWS", 5)
    n, row = F.col("id"), {"rank": "1", "role_score": "100", "first_name": "'Ann'", "profile_status": "'valid'", "why_line_status": "'valid'", "why_confidence": "'high'", "anchor_status": "'valid'", "anchor_confidence": "'high'", "anchor_score": "1"}
    rows = spark.range(40).select(F.concat(F.lit("c"), (n % 2).cast("string")).alias("company_id"), F.concat(F.lit("p"), n.cast("string")).alias("person_id"), F.lit("k").alias("contact_candidate_id"), F.when(n % 3 > 0, F.concat(F.lit("e"), n.cast("string"))).alias("anchor_id"), *[F.expr(v).alias(c) for c, v in row.items()])
    blocked = lambda held: sorted(int(r.person_id[1:]) for r in eligibility.recipient_eligibility(rows, spark.createDataFrame([(h,) for h in held], "record_id string")).where("eligibility_status = 'blocked'").collect())
    assert blocked(["k"]) == list(range(40)) and blocked(["c1", "e2", "nobody", None]) == sorted({*range(1, 40, 2), 2}) and blocked(["p4"]) == [4] and blocked([None]) == []
