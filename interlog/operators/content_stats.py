"""Content difficulty aggregates written back onto the content dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from interlog.functions.expr import round_long, safe_avg, safe_pct
from interlog.operators.containers import is_q, elapsed_current

def _neg():
    return F.lit(-1).cast("long")


def content_correct_pct(train: DataFrame, content: DataFrame, col: str) -> DataFrame:
    """% correct over question rows per ``col`` (question_id or part), on every content row with that value."""
    calc = (train.where(is_q()).select("ql_id", "answered_correctly")
            .join(content.select("ql_id", col), "ql_id")
            .groupBy(col).agg(F.coalesce(round_long(
                F.try_divide(F.sum("answered_correctly") * 100, F.count("answered_correctly"))), _neg())
                .alias(f"{col}_correct_pct")))
    return content.join(calc, col, "left")


def content_elapsed_avg(train: DataFrame, content: DataFrame, col: str) -> DataFrame:
    """Average of the next container's elapsed time per ``col``; -1 when undefined."""
    nxt = elapsed_current(train.where(is_q()), "prior_question_elapsed_time", "_next", rounded=False)
    calc = (nxt.select("ql_id", "_next").join(content.select("ql_id", col), "ql_id")
               .groupBy(col).agg(F.coalesce(round_long(F.avg("_next")), _neg()).alias(f"{col}_pqet_avg")))
    return content.join(calc, col, "left")


def _tag_totals(tag_resp: DataFrame, keys: list[str]) -> DataFrame:
    return (tag_resp.where(is_q()).groupBy(*keys)
            .agg(F.sum("answered_correctly").alias("_ac"), F.count("answered_correctly").alias("_r"),
                 F.sum("pqet_current").alias("_e")))


def _content_tags(content: DataFrame) -> DataFrame:
    """Array membership as explode + equi-join (an array predicate in a join plans a cartesian product)."""
    return content.select("ql_id", "part", F.explode(F.array_distinct("tags_array")).alias("tag"))


def content_tag_totals(tag_resp: DataFrame, content: DataFrame) -> DataFrame:
    """Per content: totals over all its tags -> ``tags_correct_pct`` and ``tags_pqet_avg``."""
    calc = (_content_tags(content).join(_tag_totals(tag_resp, ["tag"]), "tag")
            .groupBy("ql_id").agg(F.sum("_ac").alias("_ac"), F.sum("_r").alias("_r"), F.sum("_e").alias("_e"))
            .select("ql_id", round_long(F.try_divide(F.col("_ac") * 100, F.col("_r"))).alias("tags_correct_pct"),
                    round_long(F.try_divide(F.col("_e"), F.col("_r"))).alias("tags_pqet_avg")))
    return content.join(calc, "ql_id", "left")


def content_part_tag_totals(tag_resp: DataFrame, content: DataFrame) -> DataFrame:
    """Same keyed by (part, tag); -1 when undefined."""
    calc = (_content_tags(content).join(_tag_totals(tag_resp, ["part", "tag"]), ["part", "tag"])
            .groupBy("ql_id").agg(F.sum("_ac").alias("_ac"), F.sum("_r").alias("_r"), F.sum("_e").alias("_e"))
            .select("ql_id", safe_pct("_ac", "_r").alias("part_tags_correct_pct"),
                    safe_avg("_e", "_r").alias("part_tags_pqet_avg")))
    return content.join(calc, "ql_id", "left")


def content_after(train: DataFrame, tag_resp: DataFrame, content: DataFrame) -> DataFrame:
    """All difficulty columns in the reference's order (question_id, part, tags, part + tags)."""
    out = content
    for col in ("question_id", "part"):
        out = content_correct_pct(train, out, col)
        out = content_elapsed_avg(train, out, col)
    out = content_tag_totals(tag_resp, out)
    return content_part_tag_totals(tag_resp, out)
