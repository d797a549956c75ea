"""Per-row derived features, row filters and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from interlog.functions.expr import log_clip, log_odds, ratio_or_neg, time_units
from interlog.operators.containers import is_l, is_q

# Fixed list: (name, as-of feature, content aggregate) pairs of the ratio features.
RATIO_PAIRS = (
    ("ac_cumsum_pct_content_id_idx", "ac_cumsum_pct_content_id", "question_id_correct_pct"),
    ("ac_cumsum_pct_part_idx", "ac_cumsum_pct_part", "part_correct_pct"),
    ("ac_cumsum_pct_part_tags_idx", "ac_cumsum_pct_part_tags", "part_tags_correct_pct"),
    ("pqet_cumavg_content_id_idx", "pqet_cumavg_content_id", "question_id_pqet_avg"),
    ("pqet_cumavg_part_idx", "pqet_cumavg_part", "part_pqet_avg"),
    ("pqet_cumavg_part_tags_idx", "pqet_cumavg_part_tags", "part_tags_pqet_avg"),
)


def log_features(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp_log", log_clip("timestamp")).withColumn("r_cumcnt_log", log_clip("r_cumcnt"))


def log_odds_feature(df: DataFrame, pct: str = "ac_cumsum_pct") -> DataFrame:
    return df.withColumn(f"{pct[:-4]}_log_odds", log_odds(pct))


def ratio_index(df: DataFrame) -> DataFrame:
    for name, num, den in RATIO_PAIRS:
        df = df.withColumn(name, ratio_or_neg(num, den))
    return df


def with_time_units(df: DataFrame) -> DataFrame:
    m, s = time_units("timestamp", "prior_question_elapsed_time")
    return df.withColumn("ts_minute", m).withColumn("pqet_sec", s)


def shuffle_rows(df: DataFrame, seed: int = 42) -> DataFrame:
    """Full permutation ordered by a seeded hash of the row key (independent of partitioning)."""
    return df.orderBy(F.xxhash64("row_id", F.lit(seed)), "row_id")


def question_rows(df: DataFrame) -> DataFrame:
    return df.where(is_q())


def lecture_rows(df: DataFrame) -> DataFrame:
    return df.where(is_l())


def dataset_checks(df: DataFrame, exclude: tuple[str, ...] = ("lecture_id",)) -> DataFrame:
    """One row of violation counts: lectures present, lectures with a non-zero answer, null cells in
    question rows."""
    cols = [c for c in df.columns if c not in exclude]
    nulls = sum((F.when(is_q() & F.col(c).isNull(), 1).otherwise(0) for c in cols), F.lit(0))
    return df.agg(F.sum(is_l().cast("long")).alias("n_lectures"),
                  F.sum((is_l() & (F.col("answered_correctly") != 0)).cast("long")).alias("n_lecture_answers"),
                  F.sum(nulls).cast("long").alias("n_question_nulls"))


def user_history_slice(df: DataFrame, user_id) -> DataFrame:
    """One user's question rows with elapsed hours, for inspection."""
    cond = F.col("user_id") == user_id
    return df.where(cond & is_q()).withColumn("timestamp_hours", F.col("timestamp") / 3_600_000)
