"""State machines as streams: several batches leave the state that the batch fold gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siftline.streaming import feed_health, queue, sequences, stateful, suppression, webhooks


def run(spark, rows, schema, make, folder, parts=3):
    """The last state of each key after the rows came in ``parts`` batches, the stream stopped and started between them."""
    out = {}
    for i in range(parts):
        some = rows[len(rows) * i // parts : len(rows) * (i + 1) // parts]
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = make(spark.readStream.schema(schema).parquet(f"{folder}/in"))
        query = stream.writeStream.outputMode("update").foreachBatch(lambda df, _: df.write.mode("append").parquet(f"{folder}/out")).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
        assert query.awaitTermination(120)
    states = spark.read.parquet(f"{folder}/out")
    key = states.columns[0]
    for r in states.groupBy(key).agg(F.max_by(F.struct(*states.columns[1:]), "seq").alias("s")).collect():
        out[r[0]] = r.s
    return out


def stepped(rows, most):
    """One action after the other."""
    out = {}
    for key, _, action in sorted(rows, key=lambda r: r[1]):
        status, attempts = out.get(key, ("pending", 0))
        if action == "claim":
            status, attempts = "running", attempts + 1
        elif action == "complete":
            status = "completed"
        elif action == "defer":
            status, attempts = "pending", max(0, attempts - 1)
        elif action == "retry":
            status = "dead_letter" if attempts >= most else "pending"
        elif action == "replay":
            status, attempts = ("pending", 0) if status == "dead_letter" else (status, attempts)
        else:
            status = "pending"
        out[key] = status, attempts
    return out


def test_queue_stream_and_fold_equal_steps(spark, tmp_path):
    rng, rows = random.Random(1), [("x", 0, "replay"), ("y", 1, "claim"), ("y", 2, "defer"), ("y", 3, "defer"), ("y", 4, "claim")]
    for key in range(60):
        for _ in range(rng.randrange(1, 25)):
            rows.append((f"k{key}", len(rows), rng.choice(["claim", "claim", "retry", "retry", "defer", "complete", "replay", "enqueue"])))
    rng.shuffle(rows)
    schema = "key string, seq long, action string"
    for most in (1, 2, 4):
        got = queue.fold_actions(spark.createDataFrame(rows, schema).repartition(3), most).collect()
        assert {r.key: (r.status, r.attempts) for r in got} == stepped(rows, most)
    assert queue.fold_actions(spark.createDataFrame([], schema), 2).count() == 0
    rows.sort(key=lambda r: r[1])
    got = run(spark, rows, schema, lambda s: stateful.queue_states(s, 2), tmp_path)
    assert {k: (v.status, v.attempts) for k, v in got.items()} == stepped(rows, 2)


def test_leases_end_by_themselves(spark, tmp_path):
    start = datetime(2024, 1, 1)
    at = lambda s: start + timedelta(seconds=s)
    schema = "key string, seq long, action string, at timestamp, seconds int"
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    parts = [
        [("lost", 1, "claim", at(0), 60), ("done", 1, "claim", at(0), 60), ("again", 1, "claim", at(0), 5), ("dead", 1, "claim", at(0), 60), ("dead", 2, "claim", at(1), 60)],
        [("done", 2, "complete", at(10), None), ("again", 2, "retry", at(10), None), ("dead", 3, "retry", at(10), None), ("clock", 1, "enqueue", at(11), None)],
        [("done", 2, "complete", at(10), None), ("clock", 2, "enqueue", at(300), None)],  # a row again, and time goes on
        [("dead", 2, "claim", at(310), 60), ("dead", 4, "replay", at(310), None), ("clock", 3, "enqueue", at(5000), None)],
    ]
    try:
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            states = stateful.lease_queue(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 2, keep_seconds=1000, delay="100 seconds")
            write = lambda df, batch: df.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{tmp_path}/out")
            query = states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
            assert query.awaitTermination(180)
    finally:
        spark.conf.unset(key)
    seen = {}
    for r in sorted(spark.read.parquet(f"{tmp_path}/out").collect(), key=lambda r: (r.batch, r.seq)):
        seen.setdefault(r.key, []).append((r.status, r.attempts, r.why))
    assert seen["lost"] == [("running", 1, "action"), ("pending", 1, "lease_lost")]
    assert seen["again"] == [("running", 1, "action"), ("waiting", 1, "action"), ("pending", 1, "due")]
    assert seen["done"] == [("running", 1, "action"), ("completed", 1, "action"), ("complete", 1, "late"), ("forgotten", 1, "kept_long_enough")]
    assert seen["dead"] == [("running", 2, "action"), ("dead_letter", 2, "action"), ("claim", 2, "late"), ("pending", 0, "action")]


def test_hooks_are_accepted_once_for_good(spark, tmp_path):
    rng, start = random.Random(6), datetime(2024, 1, 1)
    schema = "provider string, provider_event_id string, event_type string, payload string, received_at timestamp, signature_valid boolean"
    rows = [("p", f"e{rng.randrange(25)}", "t", str(i), start + timedelta(days=i), rng.random() < 0.8) for i in range(60)]
    for i in range(3):
        spark.createDataFrame(rows[20 * i : 20 * i + 20], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        assert webhooks.accept_for_good(stream, f"{tmp_path}/out", f"{tmp_path}/ck", 4).awaitTermination(180)
    got = spark.read.parquet(f"{tmp_path}/out/accepted")
    first = {}
    for r in rows:
        if r[5]:
            first.setdefault(r[1], r[3])
    assert {r.provider_event_id: r.payload for r in got.collect()} == first and got.count() == len(first)
    webhooks.accept_batch(spark.createDataFrame(rows[40:], schema), 2, f"{tmp_path}/out", 4)  # the last batch again
    assert spark.read.parquet(f"{tmp_path}/out/accepted").count() == len(first)


def test_feed_stream_equals_fold(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f, n, 19000 + n // 3, rng.random() < p) for f, p in (("a", 0.9), ("b", 0.2), ("c", 1.0), ("d", 0.0), ("e", 0.6)) for n in range(30)]
    rng.shuffle(rows)
    rows.sort(key=lambda r: r[1])
    schema = "feed_id string, seq long, day int, failed boolean"
    got = run(spark, rows, schema, lambda s: stateful.feed_states(s, 19015), tmp_path)
    days = spark.createDataFrame(rows, schema).withColumn("day", F.date_from_unix_date("day"))
    want = feed_health.feed_states(days, F.date_from_unix_date(F.lit(19015))).collect()
    assert {k: (v.failures, v.status) for k, v in got.items()} == {r.feed_id: (r.failures, r.status) for r in want}


def last_states(spark, rows, schema, make, keys, folder, parts=3):
    """The last states after the rows came in ``parts`` batches, each row of a batch's end again in the next one."""
    for i in range(parts):
        some = rows[max(0, len(rows) * i // parts - 2) : len(rows) * (i + 1) // parts]
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        query = stateful.write_states(make(spark.readStream.schema(schema).parquet(f"{folder}/in")), f"{folder}/out", f"{folder}/ck", keys)
        assert query.awaitTermination(120)
    return stateful.latest(spark, f"{folder}/out", keys)


def as_rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_suppression_stream_equals_fold(spark, tmp_path):
    rng, start = random.Random(3), datetime(2024, 1, 1)
    rows = [(rng.choice("abcd") + "@x.com", n, start + timedelta(hours=rng.randrange(900)), rng.choice(["bounce", "unsubscribe", None]), rng.choice(["", None, f"e{n}"])) for n in range(40)] + [(None, 40, start, "bounce", "e40")]
    schema = "email string, seq long, at timestamp, reason string, external_event_id string"
    got = last_states(spark, rows, schema, stateful.suppressions, ["email"], tmp_path)
    assert as_rows(got) == as_rows(suppression.fold_suppressions(spark.createDataFrame(rows, schema)))


def test_sequence_stream_equals_fold(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "c", "nobody", None]), n, rng.choice(["approved", "enrolled", "opened", "bounce", "reply"] if n > 20 else ["approved", "opened"])) for n in range(40)]
    schema = "email string, seq long, event_type string"
    table = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "quiet"), (6, None)], "sequence_id long, email string")
    got = last_states(spark, rows, schema, lambda s: stateful.sequence_states(s, table), ["sequence_id"], tmp_path)
    want = sequences.fold_states(spark.createDataFrame(rows, schema).join(table, "email"))
    assert as_rows(got) == as_rows(want) and {r.sequence_id for r in got.collect()} == {1, 2, 3, 4}


def test_operation_stream_says_what_is_uncertain(spark, tmp_path):
    now = datetime(2024, 2, 1)
    late, early = now + timedelta(days=1), now - timedelta(days=1)
    rows = [("a", 1, "started", early), ("b", 2, "started", late), ("c", 3, "started", early), ("d", 4, "started", early), ("c", 5, "completed", None), ("d", 6, "failed", early), ("d", 7, "started", late)]
    schema = "operation_key string, seq long, status string, lease_until timestamp"
    got = queue.operations(last_states(spark, rows, schema, stateful.operations, ["operation_key"], tmp_path), F.lit(now))
    assert as_rows(got) == as_rows(queue.operations(spark.createDataFrame(rows, schema), F.lit(now)))
    assert {r.operation_key: r.status for r in got.collect()} == {"a": "uncertain", "b": "started", "c": "completed", "d": "started"}


def test_digest_window_stays_open_until_sent(spark):
    day = lambda n: datetime(2024, 1, n)
    rows = spark.createDataFrame([(i, day(i)) for i in range(1, 11)] + [(11, None)], "id long, at timestamp")
    runs = lambda *ends: spark.createDataFrame([(e,) for e in ends], "ran_at timestamp")
    seen = []

    def send(found):
        seen.append(sorted(r.id for r in found.collect()))
        return len(seen) != 2

    assert queue.digest_run(rows, "at", runs(), day(3), send) == (day(3), True)
    assert queue.digest_run(rows, "at", runs(day(3)), day(6), send) == (day(3), False)
    assert queue.digest_run(rows, "at", runs(day(3)), day(8), send) == (day(8), True)
    assert queue.digest_run(rows, "at", runs(day(3), day(20)), day(25), send) == (day(25), True)  # nothing came: a success
    assert seen == [[1, 2, 3], [4, 5, 6], [4, 5, 6, 7, 8]]
