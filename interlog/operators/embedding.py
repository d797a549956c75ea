"""Dictionary encoding, cold-start mean vectors and embedding dot-product scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from interlog.operators.analysis import vocabulary

UNSEEN = -1


def encode_ids(train: DataFrame, valid: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Codes = rank of the value among the sorted distinct training values; unseen -> -1.
    Codes are positions over ranges of the values, so no single task sorts the whole vocabulary."""
    enc_t, enc_v = train, valid
    for c in cols:
        codes = vocabulary(train, c, f"{c}_code")
        enc_t = enc_t.join(codes, c, "left")
        enc_v = enc_v.join(codes, c, "left").withColumn(
            f"{c}_code", F.coalesce(F.col(f"{c}_code"), F.lit(UNSEEN).cast("long")))
    return enc_t, enc_v


def append_mean_embedding(emb: DataFrame, mean_id: int = UNSEEN) -> DataFrame:
    """Add one cold-start row (``id = mean_id``) whose vector and bias are the means of all rows.
    Vector positions and the bias (position -1) are averaged in one groupBy and re-assembled in order."""
    pos = emb.select(F.posexplode("vector").alias("p", "x")).unionByName(
        emb.select(F.lit(-1).alias("p"), F.col("bias").cast("double").alias("x")))
    mean_row = (pos.groupBy("p").agg(F.avg("x").alias("x"))
                   .agg(F.array_sort(F.collect_list(F.struct("p", "x"))).alias("_v"))
                   .select(F.lit(mean_id).cast("long").alias("id"),
                           F.transform(F.filter("_v", lambda e: e["p"] >= 0), lambda e: e["x"]).alias("vector"),
                           F.filter("_v", lambda e: e["p"] < 0)[0]["x"].alias("bias")))
    return emb.select(F.col("id").cast("long"), F.transform("vector", lambda x: x.cast("double")).alias("vector"),
                      F.col("bias").cast("double")).unionByName(mean_row)


def _lookup(df: DataFrame, emb: DataFrame, key: str, tag: str) -> DataFrame:
    """Attach ``emb`` rows by ``key``; ids without a row use the ``UNSEEN`` (mean) row.
    Both steps are equi-joins; the many rows that fall back to the one mean key are split by AQE's
    skew-join handling instead of landing in one task."""
    seen = emb.where(F.col("id") != UNSEEN).select(F.col("id").alias(key), F.lit(True).alias(f"_{tag}seen"))
    keyed = df.join(seen, key, "left").withColumn(
        f"_{tag}key", F.when(F.col(f"_{tag}seen"), F.col(key)).otherwise(F.lit(UNSEEN).cast("long")))
    vecs = emb.select(F.col("id").alias(f"_{tag}key"), F.col("vector").alias(f"_{tag}v"),
                      F.col("bias").alias(f"_{tag}b"))
    return keyed.join(vecs, f"_{tag}key", "left").drop(f"_{tag}seen", f"_{tag}key")


def embedding_logit(df: DataFrame, users: DataFrame, contents: DataFrame, logits: bool = True) -> DataFrame:
    """dot(user vector, content vector) + user bias + content bias; unseen ids use the mean row.

    ``users`` / ``contents`` must already contain the mean row (``append_mean_embedding``)."""
    j = _lookup(_lookup(df, users, "user_id", "u"), contents, "content_id", "c")
    dot = F.aggregate(F.zip_with("_uv", "_cv", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    logit = dot + F.col("_ub") + F.col("_cb")
    out = logit if logits else 1 / (1 + F.exp(-logit))
    return j.withColumn("pred_collab_logit" if logits else "pred_collab", out).drop("_uv", "_ub", "_cv", "_cb")
