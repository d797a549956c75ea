"""The chunked primitives equal the plain window forms for every chunk size."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from interlog.operators.prefix import dense_rank0, halo_chunks, prior_extreme, prior_totals


def _data(spark, n=400, users=5, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.randrange(users), rnd.randrange(60), rnd.randrange(-3, 10), rnd.choice([None, 1, 2]))
            for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, k long, o long, v long, w long")


@pytest.mark.parametrize("chunk", [1, 3, 7, 4096])
def test_prior_totals_equals_range_window(spark, chunk):
    df = _data(spark)
    got = prior_totals(df, ["k"], "o", {"sv": F.col("v"), "sw": F.col("w")}, chunk)
    w = Window.partitionBy("k").orderBy("o").rangeBetween(Window.unboundedPreceding, -1)
    exp = df.select("k", "o", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("sv"),
                    F.coalesce(F.sum("w").over(w), F.lit(0)).alias("sw")).distinct()
    assert sorted(got.collect()) == sorted(exp.collect())


@pytest.mark.parametrize("chunk", [1, 5, 1000])
def test_dense_rank0_equals_dense_rank(spark, chunk):
    df = _data(spark)
    got = dense_rank0(df, ["k"], "o", "r", chunk)
    exp = df.select("k", "o").distinct().select(
        "k", "o", (F.dense_rank().over(Window.partitionBy("k").orderBy("o")) - 1).alias("r"))
    assert sorted(got.collect()) == sorted(exp.collect())


@pytest.mark.parametrize("chunk,halo", [(10, 10), (25, 10), (7, 0)])
def test_halo_chunks_exact_for_bounded_frames(spark, chunk, halo):
    df = _data(spark)
    frame = Window.partitionBy("k", "_chunk").orderBy("o").rangeBetween(-halo, 0)
    got = (halo_chunks(df, "o", chunk, halo).select("row_id", "_own", F.sum("v").over(frame).alias("s"))
           .where("_own").select("row_id", "s"))
    exp = df.select("row_id", F.sum("v").over(Window.partitionBy("k").orderBy("o").rangeBetween(-halo, 0)).alias("s"))
    assert sorted(got.collect()) == sorted(exp.collect())


@pytest.mark.parametrize("chunk,how", [(1, "min"), (4, "max"), (4096, "min")])
def test_prior_extreme_equals_range_window(spark, chunk, how):
    df = _data(spark)
    agg = {"min": F.min, "max": F.max}[how]
    got = prior_extreme(df, ["k"], "o", {"m": F.col("w")}, how, chunk)
    w = Window.partitionBy("k").orderBy("o").rangeBetween(Window.unboundedPreceding, -1)
    exp = df.select("k", "o", agg("w").over(w).alias("m")).distinct()
    assert sorted(got.collect()) == sorted(exp.collect())


def test_prior_rows_join_handles_out_of_order_ids(spark):
    from interlog.operators.joins import prior_rows_join
    # user 1's container 1 holds row id 100, larger than container 2's first id (an out-of-order row)
    rows = [(1, 1, 0, 1), (2, 1, 0, 0), (100, 1, 1, 1), (5, 1, 2, 1), (6, 1, 3, 0), (30, 2, 0, 1), (31, 2, 1, 1)]
    df = spark.createDataFrame(rows, "row_id long, user_id long, task_container_id long, answered_correctly long")
    got = {r.row_id: (r.roll_count, r.answered_correctly_rollsum) for r in prior_rows_join(df, 2).collect()}
    exp = {}
    for rid, u, c, a in rows:
        m = min(r[0] for r in rows if r[1] == u and r[2] == c)
        hits = [r for r in rows if r[1] == u and r[2] < c and r[0] >= m - 3]
        exp[rid] = (len(hits), sum(r[3] for r in hits))
    assert got == exp


def test_hot_key_is_split_into_bounded_groups(spark):
    """One user holds most rows: every window group of the chunked prefix stays within the chunk size,
    and the results still equal the plain window over the whole key."""
    hot = [(i, 0, i // 3, 1, None) for i in range(3000)]          # user 0: 1000 containers, 3000 rows
    cold = [(3000 + i, 1 + i % 5, i, 1, None) for i in range(300)]
    df = spark.createDataFrame(hot + cold, "row_id long, k long, o long, v long, w long")
    chunk = 64
    from interlog.operators.prefix import CHUNK, _chunk
    groups = (df.withColumn(CHUNK, _chunk("o", chunk)).select("k", CHUNK, "o").distinct()
              .groupBy("k", CHUNK).count().agg(F.max("count")).first()[0])
    assert groups <= chunk
    got = prior_totals(df, ["k"], "o", {"sv": F.col("v")}, chunk)
    w = Window.partitionBy("k").orderBy("o").rangeBetween(Window.unboundedPreceding, -1)
    exp = df.select("k", "o", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("sv")).distinct()
    assert sorted(got.collect()) == sorted(exp.collect())
