"""Registered queries against their DuckDB oracles on the smallest driver tables."""

import duckdb
import pytest

from interlog.plans import registry
from interlog.sources.fixture import TABLES
from tests.conftest import SMALL
from tools.check import digest

CORE = ["train_transforms", "content_dimension", "asof_user_content_part", "asof_tags", "asof_session",
        "asof_upto", "top_content_cumsums", "rolling_time_stats", "rolling_container_stats", "ewma_ac_pct",
        "ewma_l_cnt", "content_tag_totals", "user_final_state", "make_folds", "prior_rows_join", "state_lookup",
        "user_sequences", "embedding_logit", "roc_auc", "quantile_histogram", "upsert_user_state",
        "attach_delayed_answers", "load_csv", "typed_snapshot", "fold_export", "shard_export", "table_profile",
        "export_query", "streaming_asof_features", "content_user_correlation", "top_k",
        "one_hots", "one_hot_join", "load_json_lines", "ewma_weights", "feature_join", "upsert_user_tag_state", "metrics_wide",
        "exact_shards", "rolling_custom_stats", "cumulative_share", "vocabulary", "encode_ids", "prediction_scorecard"]


def queries():
    registry.load_all()
    return registry.QUERIES


def oracle_sql():
    registry.load_all()
    return registry.ORACLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", CORE)
def test_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SMALL)
    res = duck.execute(oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    rows = [tuple(r) for r in df.collect()]
    orows = res.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_an_oracle_or_is_listed():
    no_sql = set(queries()) - set(oracle_sql())
    assert no_sql == {"factorization_train", "feature_importance", "foreach_batch_scoring", "gbt_train_score",
                      "linear_train_score", "logistic_factorization", "shuffle_rows", "table_profile_size", "write_state_snapshot"}


#: queries whose SQL names its types itself; the others' are recorded in plans/schemas.py
OWN_TYPES = {"one_hots", "one_hot_join", "load_json_lines", "ewma_weights", "feature_join", "stream_attach_delayed_answers",
             "streaming_asof_families", "upsert_user_content_state", "upsert_user_tag_state", "upsert_question_totals", "metrics_wide",
             "exact_shards", "rolling_custom_stats",
             "logistic_factorization"}


def test_oracles_are_typed():
    from interlog.plans.schemas import SCHEMAS
    assert set(SCHEMAS) == set(queries()) - OWN_TYPES
    for key in set(oracle_sql()) - OWN_TYPES:
        assert oracle_sql()[key].startswith("SELECT CAST(_o."), key
