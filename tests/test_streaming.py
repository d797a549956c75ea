"""Serving: keyed streaming state equals the batch as-of features; delayed answers; state upserts
(checks modelled on the reference's state-update assertions)."""

import math
import os
import uuid

import pytest
from pyspark.sql import functions as F

from interlog.operators import asof, containers, joins
from interlog.session import checkpoint_dir
from interlog.streaming import serving
from tests.conftest import SMALL

H = 3_600_000


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), "tests", f"{name}-{uuid.uuid4().hex}")


def test_stream_equals_batch_asof(spark):
    from interlog.plans.train_features import tables
    t = tables(spark, SMALL)
    raw = t.interactions()
    src = _scratch(spark, "src")
    parts = serving.replay_files(raw, src, n_chunks=3, partitions=2)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", parts).parquet(src)
    out = serving.run_to_table(spark, serving.streaming_asof_features(stream), _scratch(spark, "out"),
                               _scratch(spark, "ckpt"))
    batch = asof.asof_user_content_part(t.train_base(), t.content()).where(containers.is_q())
    cols = ["row_id", "ac_cumsum", "r_cumcnt", "l_cumcnt", "pqet_cumsum", "ac_cumsum_pct", "pqet_cumavg"]
    got = out.join(batch.select("row_id"), "row_id", "left_semi").select(*cols)
    assert got.count() == batch.count()
    assert got.exceptAll(batch.select(*cols)).count() == 0


def test_delayed_answers_round_trip(spark):
    rows = spark.createDataFrame([(i, i // 5, i % 3, (i * 7) % 2) for i in range(23)],
                                 "row_id long, batch_id long, user_id long, answered_correctly long")
    msgs = serving.delayed_answer_messages(rows, chunk=2)
    assert msgs.count() == sum((n + 1) // 2 for n in (5, 5, 5, 5, 3))
    back = serving.attach_delayed_answers(rows.drop("answered_correctly"), msgs)
    assert sorted(back.select("row_id", "answered_correctly").collect()) == sorted(
        rows.select("row_id", "answered_correctly").collect())


QCOLS = "row_id long, user_id long, content_id long, timestamp long, prior_question_elapsed_time double"


@pytest.fixture()
def serving_frames(spark):
    users = spark.createDataFrame(
        [(1, 5, 3, 8, 2, 5, 3, 8, 2, 1, 3, 1, 100 * H, 2), (2, 0, 1, 1, 0, 0, 1, 1, 0, 1, 1, 0, 50 * H, 0)],
        ", ".join(f"{c} long" for c in serving.USER_STATE))
    questions = spark.createDataFrame([(10, 1, 5, [5, 6]), (11, 2, 6, [6]), (12, 1, 7, [7])],
                                      "question_id long, part long, tag_0 long, tags_array array<long>")
    uc = spark.createDataFrame([(1, 10, 2, 1, 3, 0)], "user_id long, content_id long, ac_cumsum_content_id long, "
                               "aic_cumsum_content_id long, r_cumcnt_content_id long, l_cumcnt_content_id long")
    ut = spark.createDataFrame([(1, 5, 2, 1, 3, 0), (1, 6, 1, 0, 1, 1)], "user_id long, tag long, ac_cumsum_tag long, "
                               "aic_cumsum_tag long, r_cumcnt_tag long, l_cumcnt_tag long")
    up = spark.createDataFrame([(1, 1, 4, 2, 6, 1)], "user_id long, part long, ac_cumsum_part long, "
                               "aic_cumsum_part long, r_cumcnt_part long, l_cumcnt_part long")
    # batch: <= 20 rows, a lecture, a user with several questions, a new user
    batch = spark.createDataFrame(
        [(1, 1, 10, 0, 101 * H, 1500.0, 1), (2, 1, 11, 0, 101 * H, 1500.0, 0), (3, 1, 12, 1, 101 * H, None, -1),
         (4, 2, 12, 0, 52 * H, 800.0, 1), (5, 3, 11, 0, 0, None, 1), (6, 3, 10, 0, 0, None, 0)],
        "row_id long, user_id long, content_id long, content_type_id long, timestamp long, "
        "prior_question_elapsed_time double, answered_correctly long")
    return users, questions, uc, ut, up, batch


def _deltas(batch, questions):
    q = batch.where("content_type_id = 0")
    tags = q.join(questions.select(F.col("question_id").alias("content_id"), F.explode("tags_array").alias("tag")),
                  "content_id")
    parts = q.join(questions.select(F.col("question_id").alias("content_id"), "part"), "content_id")
    return tags, parts


def _lookup(batch, users, uc, ut, up, questions, shift=0):
    qs = batch.where("content_type_id = 0").select(
        "row_id", "user_id", "content_id", (F.col("timestamp") + shift).alias("timestamp"),
        "prior_question_elapsed_time")
    return {r.row_id: r for r in joins.state_lookup(qs, users, uc, ut, up, questions, 72).collect()}


def test_state_update_checks(spark, serving_frames):
    users, questions, uc, ut, up, batch = serving_frames
    before = _lookup(batch, users, uc, ut, up, questions)
    users2 = serving.upsert_user_state(users, batch, 72, 10)
    tags, parts = _deltas(batch, questions)
    uc2 = serving.upsert_keyed_totals(uc, batch.where("content_type_id = 0"), ["user_id", "content_id"], "_content_id")
    ut2 = serving.upsert_keyed_totals(ut, tags, ["user_id", "tag"], "_tag")
    up2 = serving.upsert_keyed_totals(up, parts, ["user_id", "part"], "_part")
    after = _lookup(batch, users2, uc2, ut2, up2, questions)
    u_before = {r.user_id: r for r in users.collect()}
    u_after = {r.user_id: r for r in users2.collect()}
    nq = {1: 2, 2: 1, 3: 2}
    nac = {1: 1, 2: 1, 3: 1}
    for rid, r in before.items():
        a = after[rid]
        assert r.ts_minute == r.timestamp // 60000 if hasattr(r, "timestamp") else True
        assert a.r_cumcnt == r.r_cumcnt + nq[r.user_id], "r_cumcnt increments by the user's questions"
        assert a.r_cumcnt_clip == min(r.r_cumcnt + nq[r.user_id], 300)
        assert a.ac_cumsum == r.ac_cumsum + nac[r.user_id], "ac_cumsum increments by correct answers"
    assert u_after[1].l_cumcnt == u_before[1].l_cumcnt + 1, "lectures increment"
    assert u_after[1].aic_cumsum == u_before[1].aic_cumsum + 1, "aic increments by incorrect answers"
    # gap below 72 h: same session, session counters keep adding
    assert u_after[1].session == u_before[1].session
    assert u_after[1].ac_cumsum_session == u_before[1].ac_cumsum_session + 1
    # first-n counters stop at 10
    assert u_after[1].r_cumcnt_upto == 10 and u_after[3].r_cumcnt_upto == 2
    # 73 h later: next session, session counters start from zero
    later = _lookup(batch, users2, uc2, ut2, up2, questions, shift=73 * H)
    for rid, r in later.items():
        if r.user_id in (1, 2):
            assert r.session == after[rid].session + 1
            assert r.ac_cumsum_session == 0 and r.r_cumcnt_session == 0 and r.l_cumcnt_session == 0
    # part and tag counters
    assert after[1].r_cumcnt_part == before[1].r_cumcnt_part + 1
    assert after[1].r_cumcnt_tag_0 == before[1].r_cumcnt_tag_0 + 1
    assert after[2].r_cumcnt_tag_0 == before[2].r_cumcnt_tag_0 + 2   # contents 10 and 11 both carry tag 6
    assert after[1].ac_cumsum_content_id == before[1].ac_cumsum_content_id + 1


def test_lecture_gap_restarts_lecture_session(spark):
    users = spark.createDataFrame([(1, 1, 0, 1, 0, 1, 0, 1, 1, 0, 1, 4, 0, 0)],
                                  ", ".join(f"{c} long" for c in serving.USER_STATE))
    batch = spark.createDataFrame([(1, 1, 80 * H, 1, -1), (2, 1, 80 * H, 1, -1)],
                                  "row_id long, user_id long, timestamp long, content_type_id long, answered_correctly long")
    r = serving.upsert_user_state(users, batch, 72).first()
    assert r.l_cumcnt == 2 and r.l_cumcnt_session == 1 and r.timestamp == 0 and r.session == 0


def test_upsert_whole_batch_equals_container_by_container(spark):
    users = spark.createDataFrame([(1, 5, 3, 8, 2, 5, 3, 8, 2, 1, 3, 1, 10 * H, 2)],
                                  ", ".join(f"{c} long" for c in serving.USER_STATE))
    cols = "row_id long, user_id long, timestamp long, content_type_id long, answered_correctly long"
    rows = [(1, 1, 20 * H, 0, 1), (2, 1, 20 * H, 1, -1), (3, 1, 30 * H, 0, 0), (4, 1, 30 * H, 0, 1),
            (5, 1, 120 * H, 1, -1), (6, 1, 121 * H, 0, 1), (7, 1, 300 * H, 1, -1), (8, 1, 300 * H, 1, -1),
            (9, 2, 5 * H, 1, -1), (10, 2, 100 * H, 0, 1), (11, 3, 7 * H, 0, 0), (12, 3, 7 * H, 0, 1)]
    whole = serving.upsert_user_state(users, spark.createDataFrame(rows, cols), 72, 3)
    step = users
    for ts in sorted({r[2] for r in rows}):
        step = serving.upsert_user_state(step, spark.createDataFrame([r for r in rows if r[2] == ts], cols), 72, 3)
        step = spark.createDataFrame(step.collect(), step.schema)
    assert sorted(whole.collect()) == sorted(step.select(*whole.columns).collect())
    u1 = {r.user_id: r for r in whole.collect()}[1]
    assert u1.session == 3 and u1.l_cumcnt_session == 1 and u1.timestamp == 121 * H


def test_foreach_batch_scoring_brute_force(spark):
    """Each prediction = mean of the embedding probability and the user's correct rate over the
    history plus the question rows of earlier micro-batches (state as of the start of its batch)."""
    from __spark_entry__ import queries
    from interlog.operators import embedding
    from interlog.plans.q_more import _emb
    from interlog.plans.q_stream import users_state0
    from interlog.plans.train_features import tables

    preds = queries()["foreach_batch_scoring"](spark, SMALL).toPandas()
    t = tables(spark, SMALL)
    hist = {r.user_id: (r.ac_cumsum, r.r_cumcnt) for r in users_state0(t).collect()}
    rows = t.ftrain().where("fold IS NOT NULL AND content_type_id = 0").select(
        "row_id", "user_id", "content_id", "answered_correctly").toPandas()
    users, contents = _emb(spark, SMALL)
    emb = embedding.embedding_logit(t.ftrain().where("fold IS NOT NULL AND content_type_id = 0")
                                    .select("row_id", "user_id", "content_id"), users, contents, logits=False)
    prob = {r.row_id: r.pred_collab for r in emb.collect()}
    df = rows.merge(preds.rename(columns={"answered_correctly": "pred"}), on="row_id")
    assert len(df) == len(preds) == len(rows)
    for _, r in df.iterrows():
        ac, n = hist.get(r.user_id, (0, 0))
        earlier = df[(df.user_id == r.user_id) & (df.epoch < r.epoch)]
        ac, n = ac + earlier.answered_correctly.sum(), n + len(earlier)
        rate = 0.5 if n == 0 else math.floor(ac * 100 / n + 0.5) / 100
        assert abs(r.pred - (prob[r.row_id] + rate) / 2) < 1e-9, r.row_id
