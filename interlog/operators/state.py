"""Final state tables: one row per user (or user and attribute) with totals for serving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from interlog.operators.containers import is_q, TC


def _totals(suffix: str, cond=None):
    def f(c):
        return F.when(cond, c) if cond is not None else c
    return [F.sum(f(F.col("answered_correctly"))).alias(f"ac_cumsum{suffix}"),
            F.sum(f(is_q().cast("long"))).alias(f"r_cumcnt{suffix}"),
            F.sum(f(F.col("content_type_id"))).alias(f"l_cumcnt{suffix}"),
            F.sum(f(F.col("pqet_current"))).alias(f"pqet_cumsum{suffix}")]


def user_final_state(train: DataFrame, n: int = 10) -> DataFrame:
    """Per user: totals, last-row attributes, first-n totals and last-session totals.
    Everything is an aggregate with partial combining; the last session is picked with max_by."""
    users = train.groupBy("user_id").agg(
        F.max("row_id").alias("row_id"), F.max("tid_orig").alias("task_container_id"),
        F.max("timestamp").alias("timestamp"), F.max("session").alias("session"),
        *_totals(""), F.max("r_cumcnt_clip").alias("r_cumcnt_clip"),
        F.max_by("ts_delta", "row_id").alias("ts_delta"),
        *_totals("_upto", F.col("r_cumcnt") <= n))
    sess = (train.groupBy("user_id", "session").agg(*_totals("_session"))
            .groupBy("user_id").agg(F.max_by(F.struct(*[f"{p}_session" for p in
                                                       ("ac_cumsum", "r_cumcnt", "l_cumcnt", "pqet_cumsum")]),
                                             "session").alias("_s"))
            .select("user_id", "_s.*"))
    return users.join(sess, "user_id")


def user_content_state(train: DataFrame) -> DataFrame:
    return train.groupBy("user_id", "content_id").agg(*_totals("_content_id"))


def user_part_state(train: DataFrame, content: DataFrame) -> DataFrame:
    base = train if "part" in train.columns else train.join(content.select("ql_id", "part"), "ql_id")
    return base.groupBy("user_id", "part").agg(*_totals("_part"))


def user_tag_state(tag_resp: DataFrame) -> DataFrame:
    return tag_resp.groupBy("user_id", "tag").agg(*_totals("_tag"))


def user_part_tag_state(tag_resp: DataFrame) -> DataFrame:
    return tag_resp.groupBy("user_id", "part", "tag").agg(*_totals("_part_tag"))


def argmax_row(train: DataFrame, cols=("ts_delta", "timestamp", "content_id")) -> DataFrame:
    """Attributes of each user's last row (max row id) via max_by, no join back."""
    return train.groupBy("user_id").agg(F.max("row_id").alias("row_id"),
                                        *[F.max_by(c, "row_id").alias(c) for c in cols])


def first_row_per_container(train: DataFrame) -> DataFrame:
    return train.groupBy("user_id", TC).agg(F.min("row_id").alias("min_row"))


def user_container_bounds(train: DataFrame) -> DataFrame:
    return train.groupBy("user_id").agg(F.min(TC).alias("task_container_id_min"),
                                        F.max(TC).alias("task_container_id_max"))
