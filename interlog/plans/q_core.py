"""Registered queries: cleaning, dimension, container transforms and as-of families."""

from __future__ import annotations


from interlog.operators import asof, containers, content as content_ops
from interlog.plans import oracle as O
from interlog.plans.registry import T, arr_text, register

ASOF50 = ["ac_cumsum", "r_cumcnt", "ac_cumsum_pct", "l_cumcnt", "pqet_cumsum", "pqet_cumavg",
          "ac_cumsum_content_id", "r_cumcnt_content_id", "ac_cumsum_pct_content_id",
          "pqet_cumsum_content_id", "pqet_cumavg_content_id",
          "ac_cumsum_part", "r_cumcnt_part", "ac_cumsum_pct_part", "l_cumcnt_part", "pqet_cumsum_part",
          "pqet_cumavg_part", "r_cumcnt_clip"]
ASOF51 = [f"{f}{s}" for s in ("_tags", "_part_tags")
          for f in ("ac_cumsum", "r_cumcnt", "ac_cumsum_pct", "l_cumcnt", "pqet_cumsum", "pqet_cumavg")]
ASOF52 = ["session"] + [f"{f}_session" for f in
                        ("ac_cumsum", "r_cumcnt", "ac_cumsum_pct", "l_cumcnt", "pqet_cumsum", "pqet_cumavg")]
ASOF66 = [f"{f}_upto" for f in ("ac_cumsum", "r_cumcnt", "ac_cumsum_pct", "pqet_cumsum", "pqet_cumavg")]


def _cols(cols):
    return ", ".join(cols)


# ---- 2.2 cleaning -------------------------------------------------------------------------------

@register("fill_missing", """
SELECT row_id, COALESCE(prior_question_elapsed_time, 0) AS prior_question_elapsed_time,
       COALESCE(prior_question_had_explanation, false) AS prior_question_had_explanation
FROM interactions""")
def q_fill_missing(spark, sf):
    t = T(spark, sf).interactions()
    t = containers.fill_missing(t, "prior_question_elapsed_time", 0.0)
    t = containers.fill_missing(t, "prior_question_had_explanation", False)
    return t.select("row_id", "prior_question_elapsed_time", "prior_question_had_explanation")


@register("zero_lecture_answers", """
SELECT row_id, CASE WHEN content_type_id = 1 THEN 0 ELSE answered_correctly END AS answered_correctly
FROM interactions""")
def q_zero_lecture_answers(spark, sf):
    return containers.zero_lecture_answers(T(spark, sf).interactions()).select("row_id", "answered_correctly")


@register("keep_original_container", """
SELECT row_id, task_container_id AS tid_orig FROM interactions""")
def q_keep_original(spark, sf):
    return containers.keep_original_container(T(spark, sf).interactions()).select("row_id", "tid_orig")


@register("safe_pct", """
SELECT row_id, COALESCE(CAST(round(CAST(ac_cumsum_content_id AS DOUBLE) * 100 / NULLIF(r_cumcnt_content_id, 0)) AS BIGINT), -1)
         AS pct_content_id,
       COALESCE(CAST(round(CAST(pqet_cumsum AS DOUBLE) / NULLIF(r_cumcnt, 0)) AS BIGINT), -1) AS avg_pqet
FROM f50""")
def q_safe_pct(spark, sf):
    from interlog.functions.expr import safe_avg, safe_pct
    t = T(spark, sf).train50()
    return t.select("row_id", safe_pct("ac_cumsum_content_id", "r_cumcnt_content_id").alias("pct_content_id"),
                    safe_avg("pqet_cumsum", "r_cumcnt").alias("avg_pqet"))


@register("clip_count", "SELECT row_id, LEAST(r_cumcnt, 30) AS r_cumcnt_clip30 FROM f50")
def q_clip_count(spark, sf):
    from interlog.functions.expr import clip_count
    return T(spark, sf).train50().select("row_id", clip_count("r_cumcnt", 30).alias("r_cumcnt_clip30"))


# ---- 2.3 dimension ------------------------------------------------------------------------------

@register("content_dimension", """
SELECT ql_id, question_id, lecture_id, bundle_id, correct_answer, part, tags,
       array_to_string(tags_array, ' ') AS tags_array, tags_code
FROM content""")
def q_content_dimension(spark, sf):
    t = T(spark, sf)
    c = content_ops.content_dimension(t.questions(), t.lectures())
    return c.withColumn("tags_array", arr_text("tags_array"))


@register("tags_code", """
SELECT ql_id, tags, tags_code FROM content""")
def q_tags_code(spark, sf):
    return T(spark, sf).content().select("ql_id", "tags", "tags_code")


@register("assign_ql_id", """
SELECT i.row_id, c.ql_id FROM interactions i LEFT JOIN content c
  ON i.content_id = COALESCE(c.question_id, c.lecture_id)
 AND i.content_type_id = CASE WHEN c.question_id IS NULL THEN 1 ELSE 0 END""")
def q_assign_ql_id(spark, sf):
    t = T(spark, sf)
    return content_ops.assign_ql_id(t.interactions(), t.content()).select("row_id", "ql_id")


@register("one_hots", O.HOTS + " SELECT ql_id, name, hot FROM hots")
def q_one_hots(spark, sf):
    return content_ops.long_hots(content_ops.one_hots(T(spark, sf).content()))


@register("content_tag_pairs", """
SELECT question_id, part, tags_array[1] AS tag_0, u.tag
FROM content, UNNEST(tags_array) AS u(tag) WHERE question_id IS NOT NULL""")
def q_content_tag_pairs(spark, sf):
    return content_ops.content_tag_pairs(T(spark, sf).content())


@register("padded_tags", """
SELECT question_id, """ + ", ".join(
    f"list_concat(tags_array, [188, 188, 188, 188, 188, 188])[{i + 1}] AS tag_{i}" for i in range(6)) + """
FROM content WHERE question_id IS NOT NULL""")
def q_padded_tags(spark, sf):
    return content_ops.padded_tags(T(spark, sf).content())


@register("distinct_tags", """
SELECT DISTINCT tags FROM content WHERE question_id IS NOT NULL""")
def q_distinct_tags(spark, sf):
    return content_ops.distinct_tags(T(spark, sf).content())


# ---- 2.5 container transforms -------------------------------------------------------------------

@register("rerank_containers", """
SELECT row_id, tc AS task_container_id FROM rk""")
def q_rerank(spark, sf):
    t = containers.rerank_containers(T(spark, sf).interactions())
    return t.select("row_id", "task_container_id")


@register("rerank_containers_questions", """
SELECT row_id, tcq AS task_container_id_q FROM rk""")
def q_rerank_q(spark, sf):
    t = containers.rerank_containers(T(spark, sf).interactions(), containers.TCQ, excl_lectures=True)
    return t.select("row_id", "task_container_id_q")


def _ranked(spark, sf):
    t = containers.rerank_containers(T(spark, sf).interactions(), containers.TCQ, excl_lectures=True)
    return t


@register("elapsed_current", """
SELECT rk.row_id, CASE WHEN rk.content_type_id = 1 THEN 0 ELSE nx.pqet_current END AS pqet_current
FROM rk LEFT JOIN nx ON rk.row_id = nx.row_id""")
def q_elapsed_current(spark, sf):
    return containers.elapsed_current(_ranked(spark, sf)).select("row_id", "pqet_current")


@register("ts_delta", """
SELECT rk.row_id, CASE WHEN rk.content_type_id = 1 THEN 0 ELSE nx.ts_delta END AS ts_delta
FROM rk LEFT JOIN nx ON rk.row_id = nx.row_id""")
def q_ts_delta(spark, sf):
    return containers.ts_delta(_ranked(spark, sf)).select("row_id", "ts_delta")


BASE_COLS = ["row_id", "timestamp", "user_id", "content_id", "content_type_id", "task_container_id",
             "task_container_id_q", "tid_orig", "answered_correctly", "prior_question_elapsed_time",
             "prior_question_had_explanation", "ql_id", "pqet_current", "ts_delta"]


@register("train_transforms", f"SELECT {_cols(BASE_COLS)} FROM train")
def q_train_transforms(spark, sf):
    return T(spark, sf).train_base().select(*BASE_COLS)


# ---- 2.4 / 2.5 as-of families --------------------------------------------------------------------

@register("asof_user_content_part", f"SELECT row_id, user_id, task_container_id, {_cols(ASOF50)} FROM f50")
def q_asof50(spark, sf):
    return T(spark, sf).train50().select("row_id", "user_id", "task_container_id", *ASOF50)


TR_COLS = ["user_id", "row_id", "task_container_id", "task_container_id_q", "ql_id", "content_type_id",
           "part", "tag", "answered_correctly", "pqet_current"]


@register("tag_response", f"SELECT {_cols(TR_COLS)} FROM tag_response")
def q_tag_response(spark, sf):
    t = T(spark, sf)
    return asof.tag_response(t.train_base(), t.content()).select(*TR_COLS)


@register("asof_tags", f"SELECT row_id, {_cols(ASOF51)} FROM f51")
def q_asof51(spark, sf):
    t = T(spark, sf)
    return asof.asof_tags(t.train_base(), t.tag_response()).select("row_id", *ASOF51)


@register("asof_session", f"SELECT row_id, {_cols(ASOF52)} FROM f52")
def q_asof52(spark, sf):
    t = T(spark, sf)
    return asof.asof_session(t.train_base(), 18).select("row_id", *ASOF52)


@register("asof_upto", f"SELECT row_id, {_cols(ASOF66)} FROM feats")
def q_asof66(spark, sf):
    return asof.asof_upto(T(spark, sf).train50(), 10).select("row_id", *ASOF66)


TOP = (3, 17, 42, 64, 99)
_top_sel = ", ".join(
    [f"COALESCE(SUM(CAST(answered_correctly = 1 AND content_id = {c} AS BIGINT)) OVER w, 0) AS ac_cumsum_top_cid_{c}"
     for c in TOP] +
    [f"COALESCE(SUM(CAST(content_id = {c} AS BIGINT)) OVER w, 0) AS r_cumcnt_top_cid_{c}" for c in TOP])


@register("top_content_cumsums", f"""
SELECT row_id_tc, {", ".join([f"ac_cumsum_top_cid_{c}" for c in TOP] + [f"r_cumcnt_top_cid_{c}" for c in TOP])},
  {", ".join(f"COALESCE(CAST(round(CAST(ac_cumsum_top_cid_{c} AS DOUBLE) * 100 / NULLIF(r_cumcnt_top_cid_{c}, 0)) AS BIGINT), -1) AS ac_cumsum_pct_top_cid_{c}" for c in TOP)}
FROM (SELECT row_id AS row_id_tc, {_top_sel} FROM train WHERE content_type_id = 0
      WINDOW w AS (PARTITION BY user_id ORDER BY task_container_id_q RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
def q_top_content(spark, sf):
    return asof.top_content_cumsums(T(spark, sf).train_base(), TOP)
