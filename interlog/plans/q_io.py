"""Registered queries: sources / sinks (round trips read back) and Spark ML models."""

from __future__ import annotations

from pyspark.sql import functions as F

from interlog.operators import content as content_ops, ml
from interlog.operators.containers import is_q
from interlog.operators.folds import feature_columns
from interlog.plans.q_more import FOLDS
from interlog.plans.q_stream import scratch
from interlog.plans import oracle as O
from interlog.plans.registry import T, register
from interlog.sources import fixture, io


def _tag(sf: str) -> str:
    import hashlib
    return hashlib.sha1(sf.rstrip("/").encode()).hexdigest()[:10]

ICOLS = ["row_id", "timestamp", "user_id", "content_id", "content_type_id", "answered_correctly",
         "prior_question_elapsed_time", "prior_question_had_explanation"]
ISCHEMA = ("row_id long, timestamp long, user_id long, content_id long, content_type_id long, "
           "answered_correctly long, prior_question_elapsed_time double, prior_question_had_explanation boolean")


@register("load_csv", f"SELECT {', '.join(ICOLS)} FROM interactions")
def q_load_csv(spark, sf):
    path = scratch(spark, "csv")
    T(spark, sf).interactions().select(*ICOLS).write.option("header", True).csv(path)
    return io.load_csv(spark, path, ISCHEMA)


@register("load_json_lines", O.HOTS + " SELECT ql_id, name, hot FROM hots")
def q_load_json(spark, sf):
    """The whole multi-hot table written as JSON lines and read back under its schema."""
    path = scratch(spark, "json")
    hots = content_ops.one_hots(T(spark, sf).content())
    hots.write.json(path)
    schema = ", ".join(f"{c} {t}" for c, t in hots.dtypes)
    return content_ops.long_hots(io.load_json_lines(spark, path, schema))


@register("read_table", "SELECT ql_id, question_id, part, tags FROM content")
def q_read_table(spark, sf):
    io.ensure_database(spark, "interlog_db", scratch(spark, "db"))
    name = f"interlog_db.content_{_tag(sf)}"
    io.replace_table(T(spark, sf).content().select("ql_id", "question_id", "part", "tags"), name,
                     scratch(spark, "table"))
    return io.read_table(spark, name, None, {"ql_id": "int64", "question_id": "int64", "part": "int64"})


@register("export_query", "SELECT row_id, ac_cumsum, r_cumcnt FROM feats")
def q_export(spark, sf):
    root = scratch(spark, "export")
    df = T(spark, sf).train().select("row_id", "ac_cumsum", "r_cumcnt")
    path = io.export_query(df, root, "csv", header=True)
    assert io.export_query(df, root, "csv", header=True) == path  # second call reuses the export
    return io.read_exported(spark, path, "csv", "row_id long, ac_cumsum long, r_cumcnt long")


@register("read_exported", "SELECT user_id, tag, ac_cumsum_tag, r_cumcnt_tag FROM (" + """
SELECT user_id, tag, SUM(answered_correctly) AS ac_cumsum_tag, SUM(CAST(content_type_id = 0 AS BIGINT)) AS r_cumcnt_tag
FROM tag_response GROUP BY user_id, tag)""")
def q_read_exported(spark, sf):
    from interlog.operators.state import user_tag_state
    root = scratch(spark, "export-json")
    df = user_tag_state(T(spark, sf).tag_response()).select("user_id", "tag", "ac_cumsum_tag", "r_cumcnt_tag")
    path = io.export_query(df, root, "json")
    return io.read_exported(spark, path, "json", "user_id long, tag long, ac_cumsum_tag long, r_cumcnt_tag long")


@register("typed_snapshot", """
SELECT row_id, CAST(COALESCE(ts_delta, -1) AS INTEGER) AS ts_delta, CAST(COALESCE(pqet_current, -1) AS INTEGER) AS pqet_current,
       CAST(COALESCE(ac_cumsum_pct, -1) AS SMALLINT) AS ac_cumsum_pct, CAST(COALESCE(ts_delta, -1) AS BIGINT) AS ts_delta_64
FROM f50""")
def q_typed_snapshot(spark, sf):
    t = T(spark, sf).train().select("row_id", "ts_delta", "pqet_current", "ac_cumsum_pct",
                                    F.col("ts_delta").alias("ts_delta_64"))
    snap, failed = io.typed_snapshot(t, scratch(spark, "snap"), {"row_id": "int64", "ac_cumsum_pct": "int16",
                                                                "ts_delta_64": "int64"}, default="int", fill=-1)
    return snap


@register("fold_export", FOLDS + """
SELECT answered_correctly, ac_cumsum_pct, r_cumcnt, fold FROM ftrain WHERE content_type_id = 0 AND fold IS NOT NULL""")
def q_fold_export(spark, sf):
    path = scratch(spark, "folds-csv")
    df = T(spark, sf).ftrain().where(is_q() & F.col("fold").isNotNull())
    io.fold_export(df, path, "answered_correctly", ["ac_cumsum_pct", "r_cumcnt"])
    return spark.read.schema("answered_correctly long, ac_cumsum_pct long, r_cumcnt long, fold long").csv(path)


@register("shard_export", FOLDS + """
SELECT CASE WHEN fold IN (0, 1) THEN 'valid' ELSE 'train' END AS split, COUNT(*) AS n_rows, true AS within_limit
FROM ftrain WHERE content_type_id = 0 GROUP BY 1""")
def q_shard_export(spark, sf):
    df = (T(spark, sf).fbase().where(is_q())
          .withColumn("split", F.when(F.col("fold").isin(0, 1), "valid").otherwise("train"))
          .select("row_id", "user_id", "content_id", "answered_correctly", "split"))
    files = io.shard_export(df, scratch(spark, "shards"), "split", 1000)
    return files.groupBy("split").agg(F.sum("rows").alias("n_rows"), (F.max("rows") <= 1000).alias("within_limit"))


@register("exact_shards", FOLDS + """
, placed AS (SELECT CASE WHEN fold IN (0, 1) THEN 'valid' ELSE 'train' END AS split, row_id,
                    ROW_NUMBER() OVER (PARTITION BY fold IN (0, 1) IS TRUE ORDER BY row_id) - 1 AS place
             FROM ftrain WHERE content_type_id = 0)
SELECT split, CAST(place // 1000 AS BIGINT) AS shard, COUNT(*) AS n_rows, COUNT(*) AS named_rows, CAST(1 AS BIGINT) AS files,
       CAST(SUM(row_id) AS BIGINT) AS row_ids, MIN(row_id) AS first_row, MAX(row_id) AS last_row
FROM placed GROUP BY 1, 2""")
def q_exact_shards(spark, sf):
    """The manifest's shards with what their files hold: rows, the sum and bounds of their ids."""
    df = (T(spark, sf).fbase().where(is_q())
          .withColumn("split", F.when(F.col("fold").isin(0, 1), "valid").otherwise("train"))
          .select("row_id", "user_id", "content_id", "answered_correctly", "split"))
    path = scratch(spark, "exact-shards")
    manifest = io.exact_shards(df, path, "split", 1000, ["row_id"], {
        "row_ids": F.sum("row_id"), "first_row": F.min("row_id"), "last_row": F.max("row_id")})
    named = F.regexp_extract("folder", "-([0-9]+)rows", 1).cast("long").alias("named_rows")
    return manifest.select("split", "shard", F.col("rows").alias("n_rows"), named, "files", "row_ids", "first_row", "last_row")


_TP = list(fixture.TABLES)


@register("table_profile", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, (SELECT COUNT(*) FROM (DESCRIBE {n})) AS n_columns, (SELECT COUNT(*) FROM {n}) AS n_rows"
    for n in _TP))
def q_table_profile(spark, sf):
    for n in _TP:
        fixture.read(spark, sf, n).createOrReplaceTempView(n)
    return io.table_profile(spark, _TP)


@register("table_profile_size")
def q_table_sizes(spark, sf):
    """Storage size of the same tables (files and bytes); DuckDB views expose no file sizes."""
    for n in _TP:
        fixture.read(spark, sf, n).createOrReplaceTempView(n)
    return io.table_sizes(spark, _TP)


@register("ensure_database", "SELECT ql_id, part FROM content")
def q_ensure_db(spark, sf):
    io.ensure_database(spark, "interlog_db", scratch(spark, "db"))
    name = f"interlog_db.tmp_{_tag(sf)}"
    io.drop_table(spark, name)
    return io.replace_table(T(spark, sf).content().select("ql_id", "part"), name, scratch(spark, "table"))


@register("add_columns", """
SELECT row_id, CAST(NULL AS BIGINT) AS ac_rollsum, CAST(NULL AS SMALLINT) AS r_rollcnt, CAST(NULL AS DOUBLE) AS w FROM train""")
def q_add_columns(spark, sf):
    return io.add_columns(T(spark, sf).train_base().select("row_id"),
                          {"ac_rollsum": "int64", "r_rollcnt": "int16", "w": "float"})


@register("write_state_snapshot")
def q_state_snapshot(spark, sf):
    from interlog.plans.q_more import serving_state
    users, uc, ut, up, qs = serving_state(T(spark, sf))
    return io.write_state_snapshot({"users": users, "users_content": uc, "users_tag": ut, "users_part": up,
                                    "questions": qs}, scratch(spark, "state"), feature_columns(train=True))


# ---- Spark ML ------------------------------------------------------------------------------------------------

NUM = [c for c in feature_columns(train=True) if c != "prior_question_had_explanation"]


def _model_frame(spark, sf):
    ft = T(spark, sf).ftrain().where(is_q())
    return (ft.select("row_id", "user_id", "content_id", "answered_correctly", "fold", *NUM)
              .fillna(-1, subset=NUM)
              .withColumn("is_valid", F.col("fold").isin(0, 1) & F.col("fold").isNotNull()))


@register("gbt_train_score")
def q_gbt(spark, sf):
    _, scored = ml.gbt_train_score(_model_frame(spark, sf), NUM, max_iter=10, max_depth=4)
    return scored.where("is_valid").select("row_id", F.round("prob", 6).alias("prob"))


@register("linear_train_score")
def q_linear(spark, sf):
    df = _model_frame(spark, sf).withColumn("part_s", F.col("part").cast("string"))
    _, scored = ml.linear_train_score(df, ["part_s"], [c for c in NUM if c != "part"], max_iter=20)
    return scored.where("is_valid").select("row_id", F.round("prob", 6).alias("prob"))


@register("factorization_train")
def q_als(spark, sf):
    from interlog.operators.sequence import latest_per_user_content
    df = latest_per_user_content(T(spark, sf).train_base().where(is_q()))
    users, items = ml.factorization_train(df, rank=8, max_iter=5)
    text = F.array_join(F.transform("vector", lambda x: F.round(x, 4).cast("string")), " ").alias("vector")
    return users.select(F.lit("user").alias("side"), "id", text).unionByName(
        items.select(F.lit("content").alias("side"), "id", text))


@register("logistic_factorization")
def q_logistic(spark, sf):
    """The same answers under the logistic loss, with biases."""
    from interlog.operators.sequence import latest_per_user_content
    df = latest_per_user_content(T(spark, sf).train_base().where(is_q()))
    users, items = ml.logistic_factorization_train(df, rank=8, rounds=8)
    text = F.array_join(F.transform("vector", lambda x: F.round(x, 4).cast("string")), " ").alias("vector")
    both = users.select(F.lit("user").alias("side"), "*").unionByName(items.select(F.lit("content").alias("side"), "*"))
    return both.select("side", "id", text, F.round("bias", 4).alias("bias"))


@register("feature_importance")
def q_importance(spark, sf):
    model, _ = ml.gbt_train_score(_model_frame(spark, sf), NUM, max_iter=10, max_depth=4)
    return ml.feature_importance(spark, model, NUM)
