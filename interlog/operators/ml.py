"""Models on the assembled feature frame with Spark ML (distributed training, no export step)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from interlog.session import cut_lineage


def _prob(df: DataFrame) -> DataFrame:
    return df.withColumn("prob", vector_to_array("probability")[1])


def gbt_train_score(df: DataFrame, cols: Sequence[str], label: str = "answered_correctly",
                    valid_col: str = "is_valid", max_iter: int = 20, max_depth: int = 5, seed: int = 0):
    """Boosted trees with validation-based early stopping (``valid_col`` marks validation rows).
    Returns (model, scored frame with ``prob``)."""
    asm = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=max_depth,
                        validationIndicatorCol=valid_col, seed=seed)
    model = Pipeline(stages=[asm, gbt]).fit(df.withColumn(label, F.col(label).cast("double")))
    return model, _prob(model.transform(df))


def linear_train_score(df: DataFrame, cat: Sequence[str], num: Sequence[str], label: str = "answered_correctly",
                       valid_col: str = "is_valid", max_iter: int = 50):
    """Logistic regression on one-hot categoricals plus numeric columns, fitted on the rows that
    ``valid_col`` does not mark and applied to all."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in cat]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cat], outputCols=[f"{c}_ohe" for c in cat])
    asm = VectorAssembler(inputCols=[f"{c}_ohe" for c in cat] + list(num), outputCol="features", handleInvalid="keep")
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter)
    model = Pipeline(stages=[*idx, ohe, asm, lr]).fit(df.where(~F.col(valid_col)).withColumn(label, F.col(label).cast("double")))
    return model, _prob(model.transform(df))


def factorization_train(df: DataFrame, rank: int = 16, max_iter: int = 10, reg: float = 0.1, seed: int = 0):
    """User x content factorization of the latest answers (ALS on 0/1 labels; squared loss, not the
    reference's logistic loss). Returns (user vectors, content vectors) as (id, vector, bias) frames
    with bias 0, ready for ``append_mean_embedding`` / ``embedding_logit``."""
    als = ALS(userCol="user_id", itemCol="content_id", ratingCol="answered_correctly", rank=rank,
              maxIter=max_iter, regParam=reg, seed=seed, coldStartStrategy="nan")
    model = als.fit(df.withColumn("answered_correctly", F.col("answered_correctly").cast("float")))

    def vecs(f):
        return f.select(F.col("id").cast("long"), F.transform("features", lambda x: x.cast("double")).alias("vector"),
                        F.lit(0.0).alias("bias"))
    return vecs(model.userFactors), vecs(model.itemFactors)


#: gradients are summed in this fixed point, so that sums do not depend on the order of their parts
FIXED = 2.0 ** 28


def _fixed(value: Column) -> Column:
    """The value in fixed point, rounded half away from zero. The whole part and what it leaves are exact, so no decimal is
    made for each value, as ``F.round`` does."""
    scaled = value * FIXED
    whole = scaled.cast("long")
    rest = scaled - whole
    return whole + (rest >= 0.5).cast("long") - (rest <= -0.5).cast("long")


def _fixed_sum(value: Column) -> Column:
    return F.sum(_fixed(value)) / FIXED


def logistic_factorization_train(df: DataFrame, rank: int = 8, rounds: int = 10, reg: float = 0.1, seed: int = 0,
                                 start: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """User x content factorization under the logistic loss: log odds = user vector . content vector + both biases.

    Sides take turns. With the other side fixed, each side's vectors and biases move to the minimum of a separable
    upper bound of the regularised loss, so the loss never rises. A step is two equi-joins and one grouped sum with
    partial aggregation, and each side's new table is written; nothing but the mean answer reaches the driver.
    Returns (user vectors, content vectors) as (id, vector, bias); the mean log odds lie in the content biases. Rows
    without an answer are left out; reruns agree."""
    rows = cut_lineage(df.where(F.col("answered_correctly").isNotNull()).select(
        "user_id", "content_id", F.col("answered_correctly").cast("double").alias("y")), "answers")
    share = rows.agg(F.avg("y")).first()[0]
    share = min(max(share if share is not None else 0.5, 1e-6), 1 - 1e-6)
    mean = math.log(share / (1 - share))

    def begun(key: str, side: str) -> DataFrame:
        first = [((F.pmod(F.xxhash64(F.lit(f"{seed}:{side}:{k}"), F.col(key)), F.lit(2001)) / 1000.0 - 1) * start).alias(f"{side}{k}")
                 for k in range(rank)]
        return cut_lineage(rows.select(key).distinct().select(key, *first, F.lit(0.0).alias(f"{side}b")), f"{key}_vectors")

    tables = {"u": begun("user_id", "u"), "c": begun("content_id", "c")}
    keys = {"u": "user_id", "c": "content_id"}
    for _ in range(rounds):
        for side, other in ("uc", "cu"):
            x = [F.col(f"{other}{k}") for k in range(rank)] + [F.lit(1.0)]
            z = sum((F.col(f"u{k}") * F.col(f"c{k}") for k in range(rank)), F.lit(mean) + F.col("ub") + F.col("cb"))
            error = F.col("y") - 1 / (1 + F.exp(-z))
            size = sum((F.abs(v) for v in x), F.lit(0.0))
            met = rows.join(tables["u"], "user_id").join(tables["c"], "content_id")
            met = met.select(keys[side], error.alias("e"), (size / 4).alias("s"), *[v.alias(f"x{k}") for k, v in enumerate(x)])
            sums = met.groupBy(keys[side]).agg(*[_fixed_sum(F.col("e") * F.col(f"x{k}")).alias(f"g{k}") for k in range(rank + 1)],
                                               *[_fixed_sum(F.col("s") * F.abs(f"x{k}")).alias(f"h{k}") for k in range(rank + 1)])
            names = [f"{side}{k}" for k in range(rank)] + [f"{side}b"]
            moved = [(F.col(n) + (F.col(f"g{k}") - reg * F.col(n)) / (F.col(f"h{k}") + reg)).alias(n) for k, n in enumerate(names)]
            tables[side] = cut_lineage(tables[side].join(sums, keys[side]).select(keys[side], *moved), f"{keys[side]}_vectors")

    def vectors(side: str, add: float) -> DataFrame:
        return tables[side].select(F.col(keys[side]).cast("long").alias("id"), F.array(*[f"{side}{k}" for k in range(rank)]).alias("vector"),
                                   (F.col(f"{side}b") + add).alias("bias"))
    return vectors("u", 0.0), vectors("c", mean)


def feature_importance(spark, model, cols: Sequence[str], min_importance: float = 0.0) -> DataFrame:
    """Importance table sorted descending with its cumulative share, low importances filtered.
    The table has one row per feature, so building it on the driver is bounded."""
    from interlog.operators.analysis import cumulative_share

    stage = model.stages[-1]
    imp = stage.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(cols, [float(x) for x in imp])), "feature string, importance double")
    shares = cumulative_share(df.where(F.col("importance") > min_importance), "importance", "feature")
    return shares.orderBy(F.col("importance").desc(), "feature")
