"""Gradients in fixed point, rounded without decimals."""

from pyspark.sql import functions as F

from interlog.operators import ml


def test_fixed_point_is_half_away_from_zero_without_decimals(spark):
    values = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 4503599627370497.0, 9007199254740993.0, 0.0, -3.2, None,
              12.499999999, 1e15 + 0.5]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        ml._fixed(F.col("v") / ml.FIXED).alias("a"), F.round(F.col("v") / ml.FIXED * ml.FIXED).cast("long").alias("b"))
    assert all(r.a == r.b for r in rows.collect())
    assert "round(" not in rows.select("a")._jdf.queryExecution().optimizedPlan().toString()
