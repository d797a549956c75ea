"""Running totals over sampled ranges, and what is built on them, against plain recomputations."""

import glob
import random
import statistics

import pytest
from pyspark.sql import functions as F

from interlog.operators import analysis
from interlog.operators.embedding import encode_ids
from interlog.operators.ranges import positions, running_totals
from interlog.sources.io import exact_shards
from tests.test_plans import plan


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_running_totals_equal_a_plain_loop(spark, ranges):
    draw = random.Random(ranges)
    # a third of the rows share one value; some have none
    rows = [(i, draw.choice([7, 7, draw.randrange(1000), None]), draw.choice([1, 5, None]), draw.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, x long, v long, w double")
    got = {r.id: r for r in running_totals(df, [F.col("x").desc(), "id"], {"before": F.col("v"), "weight": F.col("w")}, ranges).collect()}
    ordered = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    before, weight = 0, 0.0
    for i, x, v, w in ordered:
        assert got[i].before == before and abs(got[i].weight - weight) < 1e-9 and (got[i].x, got[i].v) == (x, v)
        before, weight = before + (v or 0), weight + w
    assert len(got) == 900
    none = df.where("false")
    assert running_totals(none, ["id"], {"before": F.col("v")}, ranges).count() == 0 and positions(none, ["id"]).count() == 0


def test_ranks_without_a_single_partition_and_with_even_ranges(spark):
    df = spark.range(200_000).select("id", F.rand(3).alias("score"), (F.rand(4) < 0.3).cast("int").alias("y"))
    ranked = positions(df, ["score", "id"], "at", 16)
    assert ranked.agg(F.count_distinct("at"), F.min("at"), F.max("at")).first()[:] == (200_000, 0, 199_999)
    sizes = [r["count"] for r in df.repartitionByRange(16, "score").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * statistics.median(sizes)
    for made in (ranked, analysis.cumulative_share(df, "score", "id"), analysis.vocabulary(df, "score"),
                 encode_ids(df, df, ["score"])[1]):
        assert "SinglePartition" not in plan(made)


def test_auc_quantiles_share_and_codes_by_hand(spark):
    draw = random.Random(5)
    rows = [(i, draw.choice([0.5, draw.random()]), draw.randrange(2)) for i in range(300)] + [(300, None, 1)]
    df = spark.createDataFrame(rows, "id long, s double, y int")
    known = [r for r in rows if r[1] is not None]
    wins = sum((a[1] > b[1]) + 0.5 * (a[1] == b[1]) for a in known if a[2] for b in known if not b[2])
    auc = analysis.roc_auc(df, "y", "s").first()
    assert auc.n_pos + auc.n_neg == 300 and abs(auc.auc - wins / (auc.n_pos * auc.n_neg)) < 1e-12
    codes = {r.s: r.code for r in analysis.vocabulary(df, "s").collect()}
    assert codes == {s: i for i, s in enumerate(sorted({r[1] for r in known}))}
    total, upto = sum(r[1] for r in known), 0.0
    share = {r.id: r.cum_share for r in analysis.cumulative_share(df.where("s is not null"), "s", "id").collect()}
    for i, s, _ in sorted(known, key=lambda r: (-r[1], r[0])):
        upto += s
        assert abs(share[i] - upto / total) < 1e-9
    assert analysis.cumulative_share(df.where("false"), "s", "id").count() == 0
    assert analysis.exact_quantiles(df, "s", [0.0, 1.0]) == [min(r[1] for r in known), max(r[1] for r in known)]


def test_exact_shards_hold_exactly_the_asked_rows(spark, tmp_path):
    df = spark.range(1, 1201).select("id", F.when(F.col("id") % 3 == 0, "valid").when(F.col("id") % 3 == 1, "train").alias("split"))
    path = str(tmp_path / "shards")
    got = sorted((r.split or "", r.shard, r.rows, r.files, r.folder) for r in exact_shards(df, path, "split", 90, ["id"]).collect())
    assert got == [(s, k, n, 1, f"{k:05d}-{n}rows") for s in ("", "train", "valid") for k, n in enumerate([90, 90, 90, 90, 40])]
    assert len(glob.glob(path + "/split=*/shard=*/*.parquet")) == 15
    held = spark.read.parquet(path).groupBy("split", "shard").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("split = 'valid'")
    assert sorted((r.a, r.b) for r in held.collect()) == [(1 + 270 * k + 2, min(270 * (k + 1), 1200)) for k in range(5)]


def test_exact_shards_manifest_tells_what_the_files_hold(spark, tmp_path):
    df = spark.range(250).select("id", F.when(F.col("id") < 100, "valid").alias("split"))
    got = exact_shards(df, str(tmp_path / "held"), "split", 60, ["id"], {"ids": F.sum("id"), "low": F.min("id")}).collect()
    want = [("valid", 0, 0, 60), ("valid", 1, 60, 100), (None, 0, 100, 160), (None, 1, 160, 220), (None, 2, 220, 250)]
    assert {(r.split, r.shard, r.rows, r.files, r.ids, r.low) for r in got} == {(s, k, b - a, 1, sum(range(a, b)), a) for s, k, a, b in want}
