"""Deterministic per-user folds and the fold-aware selections built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from interlog.operators.containers import is_q, TC
from interlog.session import sized_broadcast

# Fixed values of the integer generator used for per-user uniforms (Lehmer / MINSTD).
MODULUS = 2_147_483_647
MULTIPLIER = 48_271
SEED_STRIDE = 1_000_003
WARMUP = 3


def user_uniforms(user: Column, seed: int, count: int) -> list[Column]:
    """``count`` uniforms in [0, 1) from a seeded integer generator over the user id.

    Pure integer arithmetic (pmod, products below 2**47), so the draw does not depend on partitioning
    and any SQL engine reproduces it."""
    h = F.pmod(user + F.lit(seed * SEED_STRIDE + 1), F.lit(MODULUS))
    out = []
    for i in range(WARMUP + count):
        h = F.pmod(h * F.lit(MULTIPLIER), F.lit(MODULUS))
        if i >= WARMUP:
            out.append(h / F.lit(float(MODULUS)))
    return out


def user_uniforms_sql(user: str, seed: int, count: int) -> list[str]:
    h = f"(({user} + {seed * SEED_STRIDE + 1}) % {MODULUS})"
    out = []
    for i in range(WARMUP + count):
        h = f"(({h} * {MULTIPLIER}) % {MODULUS})"
        if i >= WARMUP:
            out.append(f"(CAST({h} AS DOUBLE) / {float(MODULUS)!r})")
    return out


def make_folds(train: DataFrame, n_folds: int = 40, p_beg: float = 0.1, p_late: float = 0.6,
               late_start: float = 0.5, seed: int = 0) -> DataFrame:
    """One row per user: random fold, start class and the first container that belongs to the fold.
    ``beg``: from container 0; ``late``: uniform in the upper part; ``early``: uniform in the lower part."""
    users = train.groupBy("user_id").agg(F.max(TC).alias("task_container_id_max"))
    u0, u1, u2, u3 = user_uniforms(F.col("user_id"), seed, 4)
    mx = F.col("task_container_id_max")
    start = F.when(u1 < p_beg, "beg").when(u2 < p_late, "late").otherwise("early")
    tmin = (F.when(u1 < p_beg, F.lit(0).cast("long"))
            .when(u2 < p_late, F.floor(mx * late_start + u3 * (mx * (1 - late_start))).cast("long"))
            .otherwise(F.floor(u3 * mx * late_start).cast("long")))
    return users.select(F.col("user_id").alias("user_id_s"), F.floor(u0 * n_folds).cast("long").alias("fold"),
                        start.alias("seq_start"), "task_container_id_max", tmin.alias("task_container_id_min"))


def apply_folds(train: DataFrame, folds: DataFrame) -> DataFrame:
    """Rows from the user's fold start onward get the fold; earlier rows keep null."""
    f = folds.select(F.col("user_id_s").alias("user_id"), F.col("fold").alias("_fold"), "task_container_id_min")
    out = train.drop("fold") if "fold" in train.columns else train
    return (out.join(sized_broadcast(f), "user_id", "left")            # a row per user
               .withColumn("fold", F.when(F.col(TC) >= F.col("task_container_id_min"), F.col("_fold")))
               .drop("_fold", "task_container_id_min"))


def history_before_fold(train: DataFrame, folds: DataFrame, fold_list: Sequence[int]) -> DataFrame:
    """Question rows strictly before the fold start of users whose fold is listed (equi + theta join)."""
    f = folds.where(F.col("fold").isin(list(fold_list))).select(
        F.col("user_id_s").alias("user_id"), "task_container_id_min")
    return (train.where(is_q()).join(f, "user_id")
                 .where(F.col(TC) < F.col("task_container_id_min")).drop("task_container_id_min"))


def merge_max_container(df: DataFrame, folds: DataFrame) -> DataFrame:
    return df.join(folds.select(F.col("user_id_s").alias("user_id"), "task_container_id_max"), "user_id", "left")


def train_valid_split(df: DataFrame, folds_train: Sequence[int], folds_val: Sequence[int],
                      null_fold: bool = False) -> DataFrame:
    """``split`` = train / valid by fold membership (null elsewhere)."""
    in_train = F.col("fold").isin(list(folds_train))
    if null_fold:
        in_train = in_train | F.col("fold").isNull()
    return df.withColumn("split", F.when(F.col("fold").isin(list(folds_val)), "valid")
                         .when(in_train, "train"))


def fold_runs(folds: Sequence[int], n_runs: int = 5, n_val: int = 2, seed: int = 0) -> list[dict]:
    """Repeated random fold splits: each run shuffles the fold list and validates on the first
    ``n_val`` folds (a small parameter list built on the driver)."""
    import random
    rnd = random.Random(seed)
    f = list(folds)
    runs = []
    for _ in range(n_runs):
        rnd.shuffle(f)
        runs.append({"folds_train": sorted(f[n_val:]), "folds_val": sorted(f[:n_val])})
    return runs


def split_runs(df: DataFrame, runs: Sequence[dict], null_fold: bool = True) -> DataFrame:
    """Rows per (run, split) for a list of fold splits, from one aggregate per run."""
    out = None
    for i, r in enumerate(runs):
        d = (train_valid_split(df, r["folds_train"], r["folds_val"], null_fold)
             .groupBy("split").agg(F.count("*").alias("n")).withColumn("run", F.lit(i)))
        out = d if out is None else out.unionByName(d)
    return out.select("run", "split", "n")


def select_features(df: DataFrame, columns: Sequence[str], folds: Sequence[int], excl_lectures: bool = False,
                    null_fold: bool = False, limit: int | None = None) -> DataFrame:
    """Fold disjunction (optionally null folds), optional lecture exclusion, canonical order, limit."""
    cond = F.col("fold").isin(list(folds))
    if null_fold:
        cond = cond | F.col("fold").isNull()
    if excl_lectures:
        cond = cond & is_q()
    out = df.where(cond).orderBy("user_id", TC, "row_id").select(*columns)
    return out.limit(limit) if limit else out


def user_sample(df: DataFrame, user_id_max: int = 50000) -> DataFrame:
    return df.where(F.col("user_id") <= user_id_max).orderBy("user_id", TC, "row_id")


# name -> (exported, used for training)
FEATURES: dict[str, tuple[bool, bool]] = {
    "row_id": (True, False), "user_id": (True, False), "fold": (True, False),
    "answered_correctly": (True, False), "timestamp": (True, True), "part": (True, True),
    "prior_question_elapsed_time": (True, True), "prior_question_had_explanation": (True, True),
    "ac_cumsum": (True, True), "r_cumcnt": (True, True), "ac_cumsum_pct": (True, True),
    "l_cumcnt": (True, True), "pqet_cumavg": (True, True), "r_cumcnt_clip": (True, False),
    "ac_cumsum_pct_content_id": (True, True), "r_cumcnt_content_id": (True, True),
    "ac_cumsum_pct_part": (True, True), "ac_cumsum_pct_tags": (True, True),
    "ac_cumsum_pct_part_tags": (True, True), "session": (True, False),
    "ac_cumsum_pct_session": (True, True), "r_cumcnt_session": (True, True),
    "ac_cumsum_pct_upto": (True, True), "ts_delta": (True, True),
}


def feature_columns(flags: dict[str, tuple[bool, bool]] = FEATURES, train: bool = False) -> list[str]:
    idx = 1 if train else 0
    return [c for c, f in flags.items() if f[idx]]
