"""Per-user interaction sequences, latest interactions and history filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from interlog.operators.containers import is_q, TC
from interlog.operators.prefix import prior_totals

MAX_CHUNK = 10_000


def latest_per_user_content(df: DataFrame) -> DataFrame:
    """Most recent interaction per (user, content); ties on time broken by the larger row id.
    An aggregate (max_by) rather than a window, so a hot pair is combined map-side."""
    best = F.max_by(F.struct("row_id", "answered_correctly"), F.struct("timestamp", "row_id"))
    return (df.groupBy("user_id", "content_id").agg(best.alias("_b"))
              .select("_b.row_id", "user_id", "content_id", "_b.answered_correctly"))


def trailing_records(df: DataFrame, minutes: int) -> DataFrame:
    """Rows within ``minutes`` of the user's last event (per-user max by aggregate + join)."""
    last = df.groupBy("user_id").agg(F.max("timestamp").alias("_last"))
    return (df.join(last, "user_id").where(F.col("_last") - F.col("timestamp") <= minutes * 60_000)
              .drop("_last"))


def min_history_filter(df: DataFrame, min_max: int = 9) -> DataFrame:
    """Question rows of users whose largest question-row container exceeds ``min_max``."""
    q = df.where(is_q())
    keep = q.groupBy("user_id").agg(F.max(TC).alias("_m")).where(F.col("_m") > min_max)
    return q.join(keep.select("user_id"), "user_id", "left_semi")


def sequence_positions(df: DataFrame, chunk_size: int = 4096) -> DataFrame:
    """0-based position of each row in its user's (timestamp, row_id) order, with the user's length.

    Rows before the current timestamp are counted with the chunked prefix; ties inside one timestamp
    (one container) are ranked by row id."""
    before = prior_totals(df, ["user_id"], "timestamp", {"_before": F.lit(1).cast("long")}, 86_400_000)
    tie = Window.partitionBy("user_id", "timestamp").orderBy("row_id")
    n = df.groupBy("user_id").agg(F.count("*").alias("seq_len"))
    return (df.join(before, ["user_id", "timestamp"])
              .withColumn("pos", F.col("_before") + F.row_number().over(tie) - 1)
              .drop("_before").join(n, "user_id"))


def user_sequences(df: DataFrame, max_chunk: int = MAX_CHUNK) -> DataFrame:
    """Ordered arrays of (content + 1) and (answer + 1) per user; 0 is left for padding.

    A user's sequence is emitted in pieces of at most ``max_chunk`` items (``seq_chunk`` 0, 1, ...), so no
    group grows with the hottest user; users shorter than ``max_chunk`` get exactly one row."""
    pos = sequence_positions(df).withColumn("seq_chunk", (F.col("pos") / max_chunk).cast("long"))
    items = F.array_sort(F.collect_list(F.struct("pos", (F.col("content_id") + 1).alias("c"),
                                                 (F.col("answered_correctly") + 1).alias("a"))))
    return (pos.groupBy("user_id", "seq_chunk").agg(items.alias("_it"))
               .select("user_id", "seq_chunk", F.transform("_it", lambda x: x["c"]).alias("content_id"),
                       F.transform("_it", lambda x: x["a"]).alias("answered_correctly")))


def pad_sequences(df: DataFrame, n: int, keep: str = "last") -> DataFrame:
    """Fixed-length sequences: the last (or first) ``n`` items, left-padded with 0.
    Only the kept items are collected, so each group holds at most ``n`` items."""
    pos = sequence_positions(df)
    cond = F.col("pos") >= F.col("seq_len") - n if keep == "last" else F.col("pos") < n
    items = F.array_sort(F.collect_list(F.struct("pos", (F.col("content_id") + 1).alias("c"),
                                                 (F.col("answered_correctly") + 1).alias("a"))))
    g = pos.where(cond).groupBy("user_id").agg(items.alias("_it"))

    def pad(arr):
        return F.concat(F.array_repeat(F.lit(0).cast("long"), F.lit(n) - F.size(arr)), arr)
    return g.select("user_id", pad(F.transform("_it", lambda x: x["c"])).alias("content_id"),
                    pad(F.transform("_it", lambda x: x["a"])).alias("answered_correctly"))


def sequence_targets(padded: DataFrame) -> DataFrame:
    """label = last answer is correct (2); prior answers = all but the last; padding mask (1 = pad)."""
    resp = F.col("answered_correctly")
    return padded.select(
        "user_id", "content_id",
        (F.element_at(resp, -1) == 2).cast("double").alias("label"),
        F.slice(resp, 1, F.size(resp) - 1).alias("resp_prior"),
        F.transform("content_id", lambda x: (x == 0).cast("int")).alias("mask"))
