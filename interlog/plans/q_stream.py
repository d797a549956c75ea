"""Registered queries: delayed answers, state upserts, keyed streaming state and scoring."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from interlog.functions.expr import safe_pct
from interlog.operators import embedding, state
from interlog.operators.asof import with_part
from interlog.operators.containers import TC, is_q
from interlog.plans.q_more import EMB_SQL, FOLDS, _emb
from interlog.plans.registry import T, register
from interlog.session import checkpoint_dir
from interlog.streaming import answers, families, serving
from interlog.streaming.buckets import ServingTables


def scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a machine-local temp folder)."""
    return os.path.join(checkpoint_dir(spark), "interlog-stream", f"{name}-{uuid.uuid4().hex}")


@register("attach_delayed_answers", "SELECT row_id, answered_correctly FROM interactions")
def q_attach(spark, sf):
    rows = T(spark, sf).interactions().select("row_id", "batch_id", "user_id", "answered_correctly")
    msgs = serving.delayed_answer_messages(rows)
    return serving.attach_delayed_answers(rows.drop("answered_correctly"), msgs).select("row_id", "answered_correctly")


@register("stream_attach_delayed_answers", "SELECT row_id, answered_correctly FROM interactions")
def q_stream_attach(spark, sf):
    """Questions and answers replayed as two streams; an answer comes with the next 6-hour batch."""
    rows = T(spark, sf).interactions()
    asked = F.timestamp_seconds(F.col("batch_id") * 21_600)
    qs = rows.select("row_id", "user_id", asked.alias("asked_at"))
    ans = rows.select("row_id", "answered_correctly", (asked + F.expr("INTERVAL 6 HOURS")).alias("answered_at"))
    streams = []
    for name, df in (("asked", qs), ("answered", ans)):
        src = scratch(spark, name)
        answers.replay_by_time(df, src, f"{name}_at", 4)
        streams.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src))
    out = answers.stream_attach_delayed_answers(*streams)
    res = serving.run_to_table(spark, out.select("row_id", "answered_correctly"), scratch(spark, "attach-out"),
                               scratch(spark, "attach-ckpt"))
    return res


def users_state0(t):
    """Serving user state (the reference's users table) from the rows before each fold start."""
    hist = t.user_history().where(F.col("fold").isNull())
    f = state.user_final_state(hist, 10)
    return f.select(
        "user_id", "ac_cumsum", (F.col("r_cumcnt") - F.col("ac_cumsum")).alias("aic_cumsum"), "r_cumcnt", "l_cumcnt",
        "ac_cumsum_upto", (F.col("r_cumcnt_upto") - F.col("ac_cumsum_upto")).alias("aic_cumsum_upto"), "r_cumcnt_upto",
        "ac_cumsum_session", (F.col("r_cumcnt_session") - F.col("ac_cumsum_session")).alias("aic_cumsum_session"),
        "r_cumcnt_session", "l_cumcnt_session", "timestamp", "session")


def first_fold_container(t):
    f = t.folds().select(F.col("user_id_s").alias("user_id"), "task_container_id_min")
    return (with_part(t.fbase(), t.content()).where(F.col("fold").isNotNull()).join(f, "user_id")
             .where(F.col(TC) == F.col("task_container_id_min")).drop("task_container_id_min"))


_U0 = """
, hist2 AS (SELECT * FROM ftrain WHERE fold IS NULL),
fu AS (SELECT user_id, SUM(answered_correctly) AS ac_cumsum, SUM(CAST(content_type_id = 0 AS BIGINT)) AS r_cumcnt,
              SUM(content_type_id) AS l_cumcnt, MAX("timestamp") AS "timestamp", MAX(session) AS session,
              SUM(CASE WHEN r_cumcnt <= 10 THEN answered_correctly END) AS ac_cumsum_upto,
              SUM(CASE WHEN r_cumcnt <= 10 THEN CAST(content_type_id = 0 AS BIGINT) END) AS r_cumcnt_upto
       FROM hist2 GROUP BY user_id),
fs AS (SELECT h.user_id, SUM(h.answered_correctly) AS ac_s, SUM(CAST(h.content_type_id = 0 AS BIGINT)) AS r_s,
              SUM(h.content_type_id) AS l_s FROM hist2 h JOIN fu ON h.user_id = fu.user_id AND h.session = fu.session
       GROUP BY h.user_id),
u0 AS (SELECT fu.user_id, ac_cumsum, r_cumcnt - ac_cumsum AS aic_cumsum, r_cumcnt, l_cumcnt, ac_cumsum_upto,
              r_cumcnt_upto - ac_cumsum_upto AS aic_cumsum_upto, r_cumcnt_upto, ac_s AS ac_cumsum_session,
              r_s - ac_s AS aic_cumsum_session, r_s AS r_cumcnt_session, l_s AS l_cumcnt_session, "timestamp", session
       FROM fu JOIN fs ON fu.user_id = fs.user_id),
d AS (SELECT t.* FROM ftrain t JOIN folds f ON t.user_id = f.user_id_s
      WHERE t.fold IS NOT NULL AND t.task_container_id = f.task_container_id_min),
dq AS (SELECT user_id, MAX("timestamp") AS qts, SUM(answered_correctly) AS ac, SUM(1 - answered_correctly) AS aic,
              COUNT(*) AS r, list(answered_correctly ORDER BY row_id) AS items
       FROM d WHERE content_type_id = 0 GROUP BY user_id),
dl AS (SELECT user_id, MAX("timestamp") AS lts, COUNT(*) AS l FROM d WHERE content_type_id = 1 GROUP BY user_id),
j AS (SELECT COALESCE(u0.user_id, dq.user_id, dl.user_id) AS uid, u0.*, dq.qts, dq.ac, dq.aic, dq.r, dq.items,
             dl.lts, dl.l
      FROM u0 FULL JOIN dq ON u0.user_id = dq.user_id FULL JOIN dl ON COALESCE(u0.user_id, dq.user_id) = dl.user_id),
k AS (SELECT j.*, "timestamp" IS NOT NULL AND r IS NOT NULL AND qts - "timestamp" > 72 * 3600000 AS ns,
             list_slice(items, 1, greatest(10 - COALESCE(r_cumcnt_upto, 0), 0)) AS first_items FROM j)
SELECT uid AS user_id,
  COALESCE(ac_cumsum, 0) + COALESCE(ac, 0) AS ac_cumsum, COALESCE(aic_cumsum, 0) + COALESCE(aic, 0) AS aic_cumsum,
  COALESCE(r_cumcnt, 0) + COALESCE(r, 0) AS r_cumcnt, COALESCE(l_cumcnt, 0) + COALESCE(l, 0) AS l_cumcnt,
  COALESCE(ac_cumsum_upto, 0) + CASE WHEN r IS NOT NULL THEN COALESCE(list_sum(first_items), 0) ELSE 0 END AS ac_cumsum_upto,
  COALESCE(aic_cumsum_upto, 0) + CASE WHEN r IS NOT NULL THEN len(first_items) - COALESCE(list_sum(first_items), 0) ELSE 0 END
    AS aic_cumsum_upto,
  COALESCE(r_cumcnt_upto, 0) + CASE WHEN r IS NOT NULL THEN len(first_items) ELSE 0 END AS r_cumcnt_upto,
  CASE WHEN ns THEN ac ELSE COALESCE(ac_cumsum_session, 0) + COALESCE(ac, 0) END AS ac_cumsum_session,
  CASE WHEN ns THEN aic ELSE COALESCE(aic_cumsum_session, 0) + COALESCE(aic, 0) END AS aic_cumsum_session,
  CASE WHEN ns THEN r ELSE COALESCE(r_cumcnt_session, 0) + COALESCE(r, 0) END AS r_cumcnt_session,
  CASE WHEN l IS NOT NULL AND "timestamp" IS NOT NULL AND r IS NULL AND lts - "timestamp" > 72 * 3600000 THEN 1
       ELSE COALESCE(l_cumcnt_session, 0) + COALESCE(l, 0) END AS l_cumcnt_session,
  COALESCE(CASE WHEN r IS NOT NULL THEN qts ELSE "timestamp" END, lts) AS "timestamp",
  CASE WHEN ns THEN COALESCE(session, 0) + 1 ELSE COALESCE(session, 0) END AS session
FROM k"""


def _upsert_query(kind):
    def q(spark, sf):
        t = T(spark, sf)
        d = first_fold_container(t).select("row_id", "user_id", "timestamp", "content_type_id", "answered_correctly")
        if kind is not None:
            d = d.where(F.col("content_type_id") == kind)
        return serving.upsert_user_state(users_state0(t), d, 72, 10)
    return q


# row 94 + 95 in the reference's per-batch order (questions, then lectures), and each rule set alone
register("upsert_user_state", FOLDS + _U0)(_upsert_query(None))
register("upsert_question_state", FOLDS + _U0.replace(
    "WHERE t.fold IS NOT NULL AND t.task_container_id = f.task_container_id_min),",
    "WHERE t.fold IS NOT NULL AND t.task_container_id = f.task_container_id_min AND t.content_type_id = 0),"))(
    _upsert_query(0))
register("upsert_lecture_state", FOLDS + _U0.replace(
    "WHERE t.fold IS NOT NULL AND t.task_container_id = f.task_container_id_min),",
    "WHERE t.fold IS NOT NULL AND t.task_container_id = f.task_container_id_min AND t.content_type_id = 1),"))(
    _upsert_query(1))


@register("upsert_part_state", FOLDS + """
, hist2 AS (SELECT * FROM ftrain WHERE fold IS NULL),
d AS (SELECT t.* FROM ftrain t JOIN folds f ON t.user_id = f.user_id_s
      WHERE t.fold IS NOT NULL AND t.task_container_id = f.task_container_id_min),
old AS (SELECT h.user_id, h.part, SUM(CASE WHEN content_type_id = 0 THEN answered_correctly ELSE 0 END) AS ac,
               SUM(CASE WHEN content_type_id = 0 THEN 1 - answered_correctly ELSE 0 END) AS aic,
               SUM(CAST(content_type_id = 0 AS BIGINT)) AS r, SUM(CAST(content_type_id = 1 AS BIGINT)) AS l
        FROM hist2 h GROUP BY h.user_id, h.part),
dd AS (SELECT user_id, part, SUM(CASE WHEN content_type_id = 0 THEN answered_correctly ELSE 0 END) AS ac,
              SUM(CASE WHEN content_type_id = 0 THEN 1 - answered_correctly ELSE 0 END) AS aic,
              SUM(CAST(content_type_id = 0 AS BIGINT)) AS r, SUM(CAST(content_type_id = 1 AS BIGINT)) AS l
       FROM d GROUP BY user_id, part)
SELECT user_id, part, SUM(ac) AS ac_cumsum_part, SUM(aic) AS aic_cumsum_part, SUM(r) AS r_cumcnt_part,
       SUM(l) AS l_cumcnt_part
FROM (SELECT * FROM old UNION ALL SELECT * FROM dd) GROUP BY user_id, part""")
def q_upsert_part(spark, sf):
    """(user, part) question and lecture counters merged with one micro-batch (rows 94 / 95)."""
    t = T(spark, sf)
    hist = with_part(t.fbase(), t.content()).where(F.col("fold").isNull())
    old = serving.upsert_keyed_totals(
        t.spark.createDataFrame([], "user_id long, part long, ac_cumsum_part long, aic_cumsum_part long, "
                                    "r_cumcnt_part long, l_cumcnt_part long"), hist, ["user_id", "part"], "_part")
    return serving.upsert_keyed_totals(old, first_fold_container(t), ["user_id", "part"], "_part")


ASOF_COLS = ["row_id", "user_id", "ac_cumsum", "r_cumcnt", "l_cumcnt", "pqet_cumsum", "ac_cumsum_pct", "pqet_cumavg"]


@register("streaming_asof_features", f"SELECT {', '.join(ASOF_COLS)} FROM f50 WHERE content_type_id = 0")
def q_streaming_asof(spark, sf):
    """Replays the interactions as a time-ordered file stream through the keyed state operator."""
    raw = T(spark, sf).interactions()
    src = scratch(spark, "asof-src")
    parts = serving.replay_files(raw, src, n_chunks=4, partitions=spark.sparkContext.defaultParallelism)
    stream = (spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", parts).parquet(src))
    out = serving.streaming_asof_features(stream)
    res = serving.run_to_table(spark, out, scratch(spark, "asof-out"), scratch(spark, "asof-ckpt"))
    q = raw.where(is_q()).select("row_id")
    return res.join(q, "row_id", "left_semi").select(*ASOF_COLS)


FAMILY_COLS = [f"{c}{s}" for s in ("", *families.FAMILIES) for c in ("ac_cumsum", "r_cumcnt", "l_cumcnt", "pqet_cumsum",
                                                                        "ac_cumsum_pct", "pqet_cumavg")
               if not (c == "l_cumcnt" and s == "_content_id")] + ["r_cumcnt_clip"]


@register("streaming_asof_families", "SELECT row_id, user_id, "
          + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in FAMILY_COLS) + " FROM f51 WHERE content_type_id = 0")
def q_streaming_families(spark, sf):
    """Interactions replayed in time order through the per-user value and map states (rows 50 and 51)."""
    t = T(spark, sf)
    raw = t.interactions()
    src = scratch(spark, "families-src")
    parts = serving.replay_files(raw, src, n_chunks=4, partitions=spark.sparkContext.defaultParallelism)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", parts).parquet(src)
    with families.settings(spark, families.ROCKSDB):
        res = serving.run_to_table(spark, families.streaming_asof_families(stream, t.content()),
                                   scratch(spark, "families-out"), scratch(spark, "families-ckpt"))
    return res.where(is_q()).select("row_id", "user_id", *FAMILY_COLS)


def _merged(spark, sf, name):
    """A state table that starts from the rows before each fold's start and then takes the fold rows in three
    micro-batches, several containers of a user in each."""
    t = T(spark, sf)
    cols = ("row_id", "user_id", "timestamp", "content_id", "content_type_id", "answered_correctly")
    serve = ServingTables(spark, scratch(spark, name), t.content(), buckets=16)
    serve.merge(0, t.fbase().where(F.col("fold").isNull()).select(*cols), only=[name])
    live = t.fbase().where(F.col("fold").isNotNull())
    low, high = live.agg(F.min("batch_id"), F.max("batch_id")).first()
    if low is not None:
        place = F.floor((F.col("batch_id") - low) * 3 / (high - low + 1))
        for i in range(3):
            serve.merge(i + 1, live.where(place == i).select(*cols), only=[name])
    return serve.keyed[name].read()


def _totals_sql(keys: str, suffix: str, source: str, extra: str = "") -> str:
    q = "CASE WHEN content_type_id = 0 THEN {} ELSE 0 END"
    return FOLDS + f"""
SELECT {keys}, CAST(SUM({q.format('answered_correctly')}) AS BIGINT) AS ac_cumsum{suffix},
  CAST(SUM({q.format('1 - answered_correctly')}) AS BIGINT) AS aic_cumsum{suffix},
  CAST(SUM({q.format('1')}) AS BIGINT) AS r_cumcnt{suffix},
  CAST(SUM(CASE WHEN content_type_id = 1 THEN 1 ELSE 0 END) AS BIGINT) AS l_cumcnt{suffix}
FROM {source} {extra} GROUP BY {keys}"""


@register("upsert_user_content_state", _totals_sql("user_id, content_id", "_content_id", "ftrain", "WHERE content_type_id = 0"))
def q_upsert_user_content(spark, sf):
    return _merged(spark, sf, "users_content")


@register("upsert_user_tag_state", _totals_sql(
    "user_id, tag", "_tag", "(SELECT t.user_id, t.answered_correctly, t.content_type_id, u.tag FROM ftrain t "
    "JOIN content c ON t.ql_id = c.ql_id, UNNEST(c.tags_array) AS u(tag))"))
def q_upsert_user_tag(spark, sf):
    return _merged(spark, sf, "users_tag")


@register("upsert_question_totals", _totals_sql("content_id", "_question", "ftrain", "WHERE content_type_id = 0"))
def q_upsert_question_totals(spark, sf):
    return _merged(spark, sf, "questions")


@register("foreach_batch_scoring")
def q_foreach(spark, sf):
    """Serving replay: fold rows stream in by batch; each micro-batch is scored from the current user
    state (as-of rate averaged with the embedding score) and then merged into the state."""
    t = T(spark, sf)
    users, contents = _emb(spark, sf)
    rows = (t.fbase().where(F.col("fold").isNotNull())
             .select("row_id", "user_id", "content_id", "timestamp", "content_type_id", "answered_correctly", "batch_id"))
    src = scratch(spark, "score-src")
    parts = serving.replay_files(rows, src, n_chunks=4, partitions=spark.sparkContext.defaultParallelism)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", parts).parquet(src)

    def score(q, state_users):
        pct = safe_pct("ac_cumsum", "r_cumcnt")
        rate = state_users.select("user_id", F.when(pct < 0, F.lit(0.5)).otherwise(pct / 100.0).alias("rate"))
        e = embedding.embedding_logit(q.select("row_id", "user_id", "content_id"), users, contents, logits=False)
        j = e.join(rate, "user_id", "left").fillna({"rate": 0.5})
        return serving.average_ensemble(j, ["pred_collab", "rate"]).select("row_id", "answered_correctly")

    out_dir = scratch(spark, "score-out")
    serving.foreach_batch_scoring(stream, scratch(spark, "score-state"), out_dir, scratch(spark, "score-ckpt"),
                                  users_state0(t), score)
    return spark.read.parquet(out_dir).select("row_id", "epoch", "answered_correctly")


@register("average_ensemble", EMB_SQL + """
, j AS (SELECT t.row_id, t.ac_cumsum_pct, COALESCE(u.vector, (SELECT vector FROM umean)) AS uvec,
               COALESCE(c.vector, (SELECT vector FROM cmean)) AS cvec,
               COALESCE(u.bias, (SELECT bias FROM ub)) AS ubias, COALESCE(c.bias, (SELECT bias FROM cb)) AS cbias
        FROM f50 t LEFT JOIN uv u ON t.user_id = u.id LEFT JOIN cv c ON t.content_id = c.id
        WHERE t.content_type_id = 0),
l AS (SELECT row_id, ac_cumsum_pct, list_sum(list_transform(list_zip(uvec, cvec),
                     lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) + ubias + cbias AS logit FROM j)
SELECT row_id, round((1 / (1 + exp(-logit)) + CASE WHEN ac_cumsum_pct < 0 THEN 0.5 ELSE ac_cumsum_pct / 100.0 END) / 2, 6)
       AS answered_correctly FROM l""")
def q_average_ensemble(spark, sf):
    users, contents = _emb(spark, sf)
    t = T(spark, sf)
    q = asof_q(t)
    e = embedding.embedding_logit(q, users, contents, logits=False)
    e = e.withColumn("rate", F.when(F.col("ac_cumsum_pct") < 0, 0.5).otherwise(F.col("ac_cumsum_pct") / 100.0))
    d = serving.average_ensemble(e, ["pred_collab", "rate"])
    return d.select("row_id", F.round("answered_correctly", 6).alias("answered_correctly"))


def asof_q(t):
    from interlog.operators.asof import asof_user_content_part
    return asof_user_content_part(t.train_base(), t.content()).where(is_q()).select(
        "row_id", "user_id", "content_id", "ac_cumsum_pct", "answered_correctly")


@register("prediction_scorecard", EMB_SQL + """
, j AS (SELECT t.row_id, t.answered_correctly AS y, COALESCE(u.vector, (SELECT vector FROM umean)) AS uvec,
               COALESCE(c.vector, (SELECT vector FROM cmean)) AS cvec,
               COALESCE(u.bias, (SELECT bias FROM ub)) AS ubias, COALESCE(c.bias, (SELECT bias FROM cb)) AS cbias
        FROM train t LEFT JOIN uv u ON t.user_id = u.id LEFT JOIN cv c ON t.content_id = c.id
        WHERE t.content_type_id = 0),
s AS (SELECT y, 1 / (1 + exp(-(list_sum(list_transform(list_zip(uvec, cvec),
                     lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) + ubias + cbias))) AS x FROM j),
r AS (SELECT y, RANK() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2.0 AS rk FROM s),
a AS (SELECT SUM(CASE WHEN y = 1 THEN rk ELSE 0 END) AS rs, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS p,
             SUM(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS n FROM r)
SELECT round((rs - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n), 6) AS auc, p AS n_pos, n AS n_neg FROM a""")
def q_scorecard(spark, sf):
    users, contents = _emb(spark, sf)
    q = T(spark, sf).train_base().where(is_q()).select("row_id", "user_id", "content_id", "answered_correctly")
    pred = embedding.embedding_logit(q, users, contents, logits=False).withColumnRenamed("pred_collab", "p")
    d = serving.prediction_scorecard(pred.select("row_id", F.col("p").alias("answered_correctly")), q)
    return d.select(F.round("auc", 6).alias("auc"), "n_pos", "n_neg")
