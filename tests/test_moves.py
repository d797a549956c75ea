"""Rows move once: the shuffles of a plan do not grow with its families and windows, and a hot user's chunks add up."""

import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from interlog.operators import asof, containers, folds, rolling
from interlog.operators.prefix import with_prior_sums

BASE = ("row_id long, timestamp long, user_id long, content_id long, part long, content_type_id long, task_container_id long, "
        "task_container_id_q long, answered_correctly long, prior_question_elapsed_time double, pqet_current long, ts_delta long")


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def drawn(spark, n=300):
    draw = random.Random(7)
    rows = []
    for i in range(n):
        c, kind = draw.randrange(40), draw.choice([0, 0, 0, 1])
        rows.append((i, c * 60_000, draw.choice([1, 1, 1, 2, None]), draw.choice([1, 2, None]), draw.choice([1, 2]), kind, draw.choice([c, c, c, None]),
                     c if kind == 0 else None, 0 if kind else draw.choice([0, 1]), draw.choice([None, 5.0]), draw.randrange(9), draw.randrange(9)))
    return spark.createDataFrame(rows, BASE), rows


@pytest.mark.parametrize("chunk", [3, 4096])
def test_prior_sums_of_several_keys(spark, chunk):
    df, rows = drawn(spark)
    value = {"a": F.col("answered_correctly"), "n": F.lit(1).cast("long")}
    got = {r.row_id: r for r in with_prior_sums(df, ["user_id"], "task_container_id", [
        (["user_id"], value), (["user_id", "content_id"], {f"{k}_content": v for k, v in value.items()})], chunk).collect()}
    assert len(got) == len(rows)
    for r in rows:
        mine = [x for x in rows if x[2] == r[2] and x[6] is not None and r[6] is not None and x[6] < r[6]]
        same = [x for x in mine if x[3] == r[3]]
        want = (sum(x[8] for x in mine), len(mine)) if None not in (r[2], r[6]) else (None, None)
        wantc = (sum(x[8] for x in same), len(same)) if None not in (r[2], r[3], r[6]) else (None, None)
        g = got[r[0]]
        assert (g.a, g.n, g.a_content, g.n_content) == (*want, *wantc), r


@pytest.mark.parametrize("hours", [1, 10_000])
def test_ranks_over_chunks_of_time(spark, hours):
    df, rows = drawn(spark)
    got = {r.row_id: r for r in containers.rerank_both(df, chunk_ms=hours * 300_000).collect()}
    assert len(got) == len(rows)
    for r in rows:
        mine = [x for x in rows if x[2] == r[2] and x[1] < r[1]]
        want = None if r[2] is None else len({x[1] for x in mine})
        wantq = None if r[2] is None or r[5] else len({x[1] for x in mine if x[5] == 0})
        assert (got[r[0]].task_container_id, got[r[0]].task_container_id_q) == (want, wantq)


def test_families_move_the_rows_once(spark):
    df, _ = drawn(spark, 20)
    keyed = sum(1 for line in asof.asof_user_content_part(df, None)._jdf.queryExecution().executedPlan().toString().splitlines()
                if "Join" in line)
    assert keyed == 0
    assert "Join" not in asof.top_content_cumsums(df, [1, 2])._jdf.queryExecution().executedPlan().toString()


def test_windows_move_the_rows_once(spark):
    df, _ = drawn(spark, 20)
    own = {"s": ("sum", F.col("ts_delta")), "lo": ("min", F.col("ts_delta")), "hi": ("max", F.col("ts_delta"))}
    assert shuffles(rolling.rolling_time_stats(df)) == 1
    assert shuffles(rolling.rolling_container_stats(df)) == 1
    assert shuffles(rolling.rolling_custom_stats(df, own, (1, 5, 10))) == 1


def test_folds_do_not_move_the_rows(spark):
    df, _ = drawn(spark, 20)
    assert shuffles(folds.apply_folds(df, spark.createDataFrame([(1, 2, 0)], "user_id_s long, fold long, task_container_id_min long"))) == 0


def test_ewma_weights_weighs_every_row(spark):
    df = queries()["ewma_weights"](spark, "/root/testdata/sf0.001")
    assert df.columns[0] == "row_id_e"
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()


def test_a_user_of_many_keys_lies_in_small_pages():
    """Totals in pages survive growing, and a small user takes one call."""
    from interlog.streaming import families

    class Kept(dict):
        calls = 0

        def getValue(self, key):
            self.calls += 1
            return self.get(key)

        def updateValue(self, key, value):
            self.calls += 1
            self[key] = value

    state, depth, count, want = Kept(), 0, 0, {}
    for batch in range(20):
        pages = families._Pages(state, depth, count)
        for i in range(200):
            key = (i * 7 + batch * 150, -i % 3)
            pages.totals(*key)[1] += 1
            want[key] = want.get(key, 0) + 1
        pages.write()
        depth, count = pages.depth, pages.count
        assert batch or state.calls == 2
    assert count == len(want) and depth > 2
    again = families._Pages(state, depth, count)
    assert {k: again.totals(*k)[1] for k in want} == want
    assert again.count == count and max(len(p) for p in again.pages.values()) < 3 * families.PAGE


def test_whole_words_count_as_their_prefixes():
    """A text's tokens and its longest prefix within a limit, against the counts of all prefixes."""
    import numpy as np
    import public_tokenizers
    from interlog.llm.token_counts import PrefixCounter

    counter = PrefixCounter(str(public_tokenizers.path("word_bpe_49k.json")))
    draw = random.Random(3)
    texts = ["", "  ", "a  b\n\nc", "don't 'S it's", "x<|endoftext|>y z", " end "]
    texts += ["".join(draw.choice(["a", "b", " ", "'", "\n", ".", "é", "中", "9", "<|endoftext|>"]) for _ in range(50)) for _ in range(100)]
    for text in texts:
        counts = np.concatenate(list(counter.text(text)))
        for limit in (0, 1, 3, 10, 30):
            want = len(text) if counts[-1] <= limit else int(np.flatnonzero(counts <= limit)[-1])
            assert counter.whole(text, limit) == (int(counts[-1]), want), (text, limit)
