"""Plan shape: no cartesian products or nested-loop joins; filters and projections reach the scan."""

import contextlib
import io

import pytest

from __spark_entry__ import queries
from tests.conftest import SMALL

SKIP = {"streaming_asof_features", "foreach_batch_scoring", "gbt_train_score", "linear_train_score",
        "factorization_train", "logistic_factorization", "feature_importance", "write_state_snapshot", "load_csv", "load_json_lines",
        "export_query", "read_exported", "typed_snapshot", "fold_export", "shard_export", "exact_shards", "read_table",
        "ensure_database", "table_profile", "quantile_histogram", "stream_attach_delayed_answers",
        "streaming_asof_families", "upsert_user_content_state", "upsert_user_tag_state", "upsert_question_totals"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(set(queries()) - SKIP))
def test_no_cartesian_or_nested_loop(spark, key):
    p = plan(queries()[key](spark, SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_filter_and_columns_reach_the_scan(spark):
    from pyspark.sql import functions as F

    from interlog.sources import fixture
    ev = fixture.read(spark, SMALL, "events")
    p = plan(ev.where(F.col("user_id") < 10).select("event_id", "user_id"))
    assert "PushedFilters: [IsNotNull(user_id), LessThan(user_id,10)]" in p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in p
