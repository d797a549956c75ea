"""Queries that read no as-of feature leave those tables unmade, and see the same rows."""

import datetime
import random
from collections import Counter

import pytest

from __spark_entry__ import queries
from interlog.plans.train_features import Tables, tables
from interlog.streaming import serving


def _events(spark, path):
    """Events with null and repeated ids, several in a container, lectures among them."""
    draw, start = random.Random(3), datetime.datetime(2024, 1, 1)
    rows = []
    for i in range(900):
        user = None if i % 97 == 0 else draw.randrange(12)
        at = start + datetime.timedelta(hours=draw.randrange(400))
        rows.append((i - i % 50 if i % 53 == 0 else i, at, user, draw.choice(["view", "click", "signup"]), draw.uniform(0, 40), f'{{"k": {draw.randrange(9)}}}'))
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df.write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.mark.parametrize("name, unmade", [
    ("upsert_user_tag_state", {"train50", "tag_response", "train"}),
    ("exact_shards", {"train50", "tag_response", "train"}),
    ("write_state_snapshot", {"tag_response", "train"})])
def test_only_what_a_query_reads_is_made(spark, tmp_path, name, unmade):
    folder = _events(spark, tmp_path)
    assert queries()[name](spark, folder).count() > 0
    assert not unmade & set(tables(spark, folder).cache)


def test_lean_tables_hold_the_rows_of_the_whole_one(spark, tmp_path):
    t = Tables(spark, _events(spark, tmp_path))
    whole = t.ftrain()                       # its joins leave out rows without a user, before any fold
    for lean in (t.fbase(), t.user_history()):
        rows, want = (Counter(map(tuple, df.select(*lean.columns).collect())) for df in (lean, whole))
        assert sum(rows.values()) > 850 and rows == want


def test_a_micro_batch_moves_once(spark):
    rows = spark.createDataFrame([(1, 5, 0, 1), (1, 5, 0, 0), (1, 5, 1, -1), (2, 5, 0, None), (None, 6, 0, 1)],
                                 "user_id long, tag long, content_type_id long, answered_correctly long")
    cols = "user_id long, tag long, ac_cumsum_tag long, aic_cumsum_tag long, r_cumcnt_tag long, l_cumcnt_tag long"
    state = spark.createDataFrame([(1, 5, 1, 1, 2, 0), (3, 5, 1, 0, 1, 4)], cols)
    out = serving.upsert_keyed_totals(state, rows, ["user_id", "tag"], "_tag")
    assert set(map(tuple, out.collect())) == {(1, 5, 2, 2, 4, 1), (3, 5, 1, 0, 1, 4), (2, 5, None, None, 1, 0), (None, 6, 1, 0, 1, 0)}
    assert out._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") == 2         # before and after one move
