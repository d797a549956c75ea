"""Streams and state tables of the serving side: delayed answers with late rows, all as-of families from keyed
state, buckets that untouched epochs leave alone, lookups that move asked rows only."""

import os
import uuid
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from interlog.operators import asof, containers, joins
from interlog.session import checkpoint_dir
from interlog.streaming import answers, families, serving
from interlog.streaming.buckets import BucketedState, ServingTables
from tests.conftest import SMALL


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), "tests", f"{name}-{uuid.uuid4().hex}")


T0 = datetime(2024, 1, 1)
H = timedelta(hours=1)


def _streams(spark, asked, answered):
    """Two file streams; each list of rows is one trigger's file."""
    out = []
    for name, schema, files in (("q", "row_id long, asked_at timestamp", asked),
                                ("a", "row_id long, answered_correctly long, answered_at timestamp", answered)):
        src = _scratch(spark, name)
        for rows in files:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        out.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src))
    return out


def _run(spark, out):
    sink, ckpt = _scratch(spark, "out"), _scratch(spark, "ckpt")
    q = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink), q.recentProgress


@pytest.mark.parametrize("how", ["inner", "left_outer"])
def test_late_and_missing_answers(spark, how):
    asked = [[(1, T0), (2, T0 + H), (3, T0 + 2 * H)], [(4, T0 + 30 * H), (9, T0 - 40 * H)], [(5, T0 + 90 * H)], [(6, T0 + 200 * H)]]
    answered = [[(1, 1, T0 + 6 * H), (2, 0, T0 + 14 * H)],        # 2: past the 12 hours
                [(4, 1, T0 + 31 * H)], [(5, 0, T0 + 91 * H)],
                [(3, 1, T0 + 8 * H), (6, 1, T0 + 201 * H)]]           # 3: in time, but behind the watermark
    qs, ans = _streams(spark, asked, answered)
    res, _ = _run(spark, answers.stream_attach_delayed_answers(qs, ans, how=how).select("row_id", "answered_correctly"))
    got = {r.row_id: r.answered_correctly for r in res.collect()}
    want = {1: 1, 4: 1, 5: 0, 6: 1} | ({2: None, 3: None} if how == "left_outer" else {})
    assert {k: v for k, v in got.items() if k != 9} == want       # 9 came 70 hours late


def test_stream_equals_batch_and_state_is_dropped(spark):
    n, files = 600, 12
    rows = [(i, T0 + timedelta(hours=i), i % 2) for i in range(n)]
    step = n // files
    qs, ans = _streams(spark, [[(i, t) for i, t, _ in rows[k:k + step]] for k in range(0, n, step)],
                       [[(i, a, t + 6 * H) for i, t, a in rows[k:k + step]] for k in range(0, n, step)])
    res, progress = _run(spark, answers.stream_attach_delayed_answers(qs, ans).select("row_id", "answered_correctly"))
    assert Counter(map(tuple, res.collect())) == Counter((i, a) for i, _, a in rows)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert len(held) >= files and max(held) <= 6 * step           # two sides, a file and the bound of each


def test_join_on_batch_and_position_equals_the_batch_form(spark):
    rows = spark.createDataFrame([(i, i // 5, (i * 7) % 2) for i in range(23)], "row_id long, batch_id long, answered_correctly long")
    at = F.timestamp_seconds(F.col("batch_id") * 21_600)
    placed = serving.batch_positions(rows)
    msgs = serving.delayed_answer_messages(rows, chunk=2)
    ans = msgs.select((F.col("batch_id") - 1).alias("batch_id"), "msg_offset", F.posexplode(F.from_json("prior_group_answers_correct", "array<int>")))
    ans = ans.select("batch_id", (F.col("msg_offset") + F.col("pos")).alias("pos"), F.col("col").cast("long").alias("answered_correctly"),
                     (at + F.expr("INTERVAL 6 HOURS")).alias("answered_at"))
    got = answers.stream_attach_delayed_answers(placed.drop("answered_correctly").withColumn("asked_at", at), ans, keys=["batch_id", "pos"])
    assert sorted(got.select("row_id", "answered_correctly").collect()) == sorted(rows.select("row_id", "answered_correctly").collect())


def test_all_families_equal_the_batch_families(spark):
    from interlog.plans.train_features import tables
    t = tables(spark, SMALL)
    raw = t.interactions()
    src = _scratch(spark, "src")
    parts = serving.replay_files(raw, src, n_chunks=3, partitions=2)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", parts).parquet(src)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with families.settings(spark, families.ROCKSDB):
        out = serving.run_to_table(spark, families.streaming_asof_families(stream, t.content()), _scratch(spark, "o"), _scratch(spark, "c"))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    batch = asof.asof_tags(asof.asof_user_content_part(t.train_base(), t.content()), t.tag_response()).where(containers.is_q())
    cols = [c for c in out.columns if c != "content_type_id"]
    got, want = (sorted(map(tuple, df.select(*cols).collect())) for df in (out.where(containers.is_q()), batch))
    assert len(got) == batch.count() and got == want


# ---- buckets --------------------------------------------------------------------------------------------------

COLS = "row_id long, user_id long, timestamp long, content_id long, content_type_id long, answered_correctly long"


@pytest.fixture()
def catalogue(spark):
    """Questions 10-12 and lecture 30."""
    return spark.createDataFrame([(0, 10, None, 1, [5, 6]), (1, 11, None, 2, [6]), (2, 12, None, 1, [7]), (3, None, 30, 2, [6])],
                                 "ql_id long, question_id long, lecture_id long, part long, tags_array array<long>")


def _rows(seed, n=400, users=60):
    import random

    rng = random.Random(seed)
    out = []
    for i in range(n):
        lecture = rng.random() < 0.2
        out.append((seed * 10_000 + i, rng.randrange(users), seed * 10_000_000 + i * 1000, 30 if lecture else rng.choice([10, 11, 12]),
                    int(lecture), -1 if lecture else rng.randrange(2)))
    return out


def _sums(rows, keys_of):
    ac, r, lec = Counter(), Counter(), Counter()
    for row in rows:
        for k in keys_of(row):
            lec[k] += row[4]
            r[k] += 1 - row[4]
            ac[k] += row[5] * (1 - row[4])
    return {(*k, ac[k], r[k] - ac[k], r[k], lec[k]) for k in set(r) | set(lec)}


TAGS, PART = {10: [5, 6], 11: [6], 12: [7], 30: [6]}, {10: 1, 11: 2, 12: 1, 30: 2}


def test_five_tables_over_epochs_and_replay(spark, catalogue):
    serve = ServingTables(spark, _scratch(spark, "serve"), catalogue, buckets=4)
    epochs = [_rows(1), _rows(2), _rows(3, n=9, users=3)]
    for e, rows in enumerate(epochs):
        serve.merge(e, spark.createDataFrame(rows, COLS))
    serve.merge(2, spark.createDataFrame(epochs[2], COLS))         # replayed after a failure
    rows = sum(epochs, [])
    got = {name: {tuple(r) for r in s.read().collect()} for name, s in serve.keyed.items()}
    asked = [r for r in rows if r[4] == 0]
    assert got["users_content"] == _sums(asked, lambda r: [(r[1], r[3])])
    assert got["questions"] == _sums(asked, lambda r: [(r[3],)])
    assert got["users_part"] == _sums(rows, lambda r: [(r[1], PART[r[3]])])
    assert got["users_tag"] == _sums(rows, lambda r: [(r[1], t) for t in TAGS[r[3]]])
    whole = spark.createDataFrame([], ", ".join(f"{c} long" for c in serving.USER_STATE))
    for part in epochs:
        whole = serving.upsert_user_state(whole, spark.createDataFrame(part, COLS))
        whole = spark.createDataFrame(whole.collect(), whole.schema)
    assert sorted(serve.users.read().collect()) == sorted(whole.select(*serving.USER_STATE).collect())


def _files(state):
    return {os.path.join(d, f) for d, _, fs in os.walk(state.path.removeprefix("file:")) for f in fs if f.endswith(".parquet") and "bucket=" in d}


def test_untouched_buckets_keep_their_files_and_old_versions_go(spark):
    state = BucketedState(spark, _scratch(spark, "state"), "k long, v long", ["k"], buckets=8)
    assert state.read().count() == 0 and state.pointer() == {}
    state.create(spark.range(200).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v")))
    first = _files(state)
    rows = spark.createDataFrame([(7, 5), (1000, 2)], "k long, v long")
    touched = set(state._buckets_of(rows))
    add = lambda old, d: old.unionByName(d).groupBy("k").agg(F.sum("v").alias("v"))
    state.merge(0, rows, lambda old: add(old, rows))
    assert first <= _files(state) and {b for b, v in state.pointer().items() if v == 0} == touched
    assert {v for b, v in state.pointer().items() if b not in touched} == {-1}
    want = {k: 1 for k in range(200)} | {7: 6, 1000: 2}
    assert {r.k: r.v for r in state.read().collect()} == want
    more = rows.select("k", F.lit(1).cast("long").alias("v"))
    for e in (1, 2):
        state.merge(e, more, lambda old: add(old, more))
    assert state.vacuum(keep=2) == 2 * len(touched)                # their versions -1 and 0
    assert {f for f in first if int(f.split("bucket=")[1].split("/")[0]) not in touched} <= _files(state)
    assert {r.k: r.v for r in state.read().collect()} == want | {7: 8, 1000: 4}
    assert {r.k for r in state.read_for(rows).collect()} < set(want) and state.read_for(rows).where("k = 1000").count() == 1


def test_a_pointer_without_its_success_file_does_not_count(spark):
    state = BucketedState(spark, _scratch(spark, "torn"), "k long, v long", ["k"], buckets=2)
    one = spark.createDataFrame([(1, 1)], "k long, v long")
    state.create(one)
    state.merge(5, one, lambda old: old.select("k", (F.col("v") + 1).alias("v")))
    os.remove(os.path.join(state.path.removeprefix("file:"), "pointer", "epoch=5", "_SUCCESS"))
    assert state.epochs() == [-1] and state.read().collect() == [(1, 1)]


# ---- lookups ----------------------------------------------------------------------------------------------------

def test_lookup_moves_asked_rows_only(spark, catalogue):
    serve = ServingTables(spark, _scratch(spark, "lookup"), catalogue, buckets=4)
    serve.merge(0, spark.createDataFrame(_rows(4, n=3000, users=500), COLS))
    qs = catalogue.where("question_id is not null").select("question_id", "part", F.element_at("tags_array", 1).alias("tag_0"), "tags_array")
    batch = spark.createDataFrame([(1, 3, 10, 10**9, 1500.0), (2, 3, 11, 10**9, 1500.0), (3, 77, 12, 10**9, None), (4, 9999, 10, 0, None)],
                                  "row_id long, user_id long, content_id long, timestamp long, prior_question_elapsed_time double")
    states = [serve.users.read(), *(serve.keyed[n].read() for n in ("users_content", "users_tag", "users_part"))]
    keys = joins.asked_keys(batch, qs)
    moved = [joins.asked_rows(s, k).count() for s, k in zip(states, keys, strict=True)]
    matched = [s.join(k, k.columns).select(*k.columns).distinct().count() for s, k in zip(states, keys, strict=True)]
    assert all(m <= 2 * n for m, n in zip(moved, matched, strict=True)) and sum(moved) < 20 < sum(s.count() for s in states) / 50
    plan = joins.asked_rows(states[1], keys[1])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    got = sorted(map(tuple, joins.state_lookup(batch, *states, qs).collect()))
    assert got == sorted(map(tuple, joins.state_lookup(batch, *states, qs, max_keys=0).collect()))
    assert got == sorted(map(tuple, serve.lookup(batch, qs).collect())) and len(got) == 4
