"""As-of families on a hand-made frame (ties in a container, null elapsed time, lectures, a one-row user)
against a brute-force Python evaluation of the definitions."""

import pytest
from pyspark.sql import functions as F

from interlog.operators import asof, containers
from tests.conftest import rows_frame

H = 3_600_000
# row_id, user, ts, content, type, answer, prior elapsed
ROWS = [
    (1, 1, 0, 10, 0, 1, None), (2, 1, 0, 11, 0, 0, None),          # container 0, two questions (tie)
    (3, 1, 5 * H, 12, 1, -1, 900.0),                                 # lecture-only container
    (4, 1, 10 * H, 10, 0, 1, 1500.0), (5, 1, 10 * H, 12, 0, 1, 1500.0),
    (6, 1, 40 * H, 11, 0, 0, 2000.0),                                # gap > 18 h: new session
    (7, 1, 41 * H, 12, 1, -1, 700.0),
    (8, 1, 42 * H, 10, 0, 1, 1250.0),
    (9, 2, 0, 10, 0, 0, None),                                       # one-row user
    (10, 3, 0, 11, 1, -1, None), (11, 3, 2 * H, 11, 0, 1, 400.0), (12, 3, 3 * H, 11, 0, 1, 600.0),
]
PART = {10: 1, 11: 2, 12: 1}


@pytest.fixture(scope="module")
def base(spark):
    raw = rows_frame(spark, ROWS).withColumn("task_container_id", F.lit(0).cast("long"))
    t = containers.keep_original_container(raw)
    t = containers.rerank_containers(t, containers.TC, chunk_ms=4 * H)
    t = containers.rerank_containers(t, containers.TCQ, excl_lectures=True, chunk_ms=4 * H)
    t = containers.container_neighbours(t)
    t = containers.zero_lecture_answers(containers.fill_missing(t, "prior_question_elapsed_time", 0.0))
    part = F.create_map(*[x for k, v in PART.items() for x in (F.lit(k), F.lit(v))])
    return t.withColumn("part", part[F.col("content_id")].cast("long")).cache()


def _brute(rows, key):
    out = {}
    for r in rows:
        prior = [s for s in rows if key(s) == key(r) and s["task_container_id"] < r["task_container_id"]]
        out[r["row_id"]] = (sum(s["answered_correctly"] for s in prior),
                            sum(1 for s in prior if s["content_type_id"] == 0),
                            sum(s["content_type_id"] for s in prior),
                            sum(s["pqet_current"] or 0 for s in prior))
    return out


def test_container_ranks_and_neighbours(base):
    got = {r.row_id: r for r in base.collect()}
    assert [got[i].task_container_id for i in range(1, 9)] == [0, 0, 1, 2, 2, 3, 4, 5]
    assert got[3].task_container_id_q is None and got[4].task_container_id_q == 1
    # elapsed time of a container is the next question container's prior field; lectures 0
    assert got[1].pqet_current == 1500 and got[4].pqet_current == 2000 and got[3].pqet_current == 0
    assert got[8].pqet_current is None and got[6].ts_delta == 30 * H and got[1].ts_delta is None


@pytest.mark.parametrize("chunk", [1, 4096])
def test_user_content_part_matches_brute_force(spark, base, chunk):
    out = asof.asof_user_content_part(base, None, chunk_size=chunk).collect()
    rows = [r.asDict() for r in base.collect()]
    for key, sfx in ((lambda r: r["user_id"], ""), (lambda r: (r["user_id"], r["content_id"]), "_content_id"),
                     (lambda r: (r["user_id"], r["part"]), "_part")):
        exp = _brute(rows, key)
        for r in out:
            ac, rc, lc, e = exp[r.row_id]
            assert r[f"ac_cumsum{sfx}"] == ac and r[f"r_cumcnt{sfx}"] == rc and r[f"pqet_cumsum{sfx}"] == e
            if sfx != "_content_id":
                assert r[f"l_cumcnt{sfx}"] == lc
            assert r[f"ac_cumsum_pct{sfx}"] == (round(ac * 100 / rc) if rc else -1)


def test_prior_values_constant_inside_container_and_monotone(base):
    out = asof.asof_user_content_part(base, None).collect()
    by = {}
    for r in out:
        by.setdefault((r.user_id, r.task_container_id), set()).add((r.ac_cumsum, r.r_cumcnt))
    assert all(len(v) == 1 for v in by.values())
    for u in {k[0] for k in by}:
        seq = [next(iter(by[k]))[1] for k in sorted(k for k in by if k[0] == u)]
        assert seq == sorted(seq)


def test_session_numbering_and_lectures(base):
    out = {r.row_id: r for r in asof.asof_session(base, 18).collect()}
    assert out[3].session == 0 and out[7].session == 0          # lectures stay in session 0
    assert out[4].session == 0 and out[6].session == 1 and out[8].session == 1
    assert out[6].r_cumcnt_session == 0 and out[8].r_cumcnt_session == 1 and out[8].ac_cumsum_session == 0
    assert out[4].l_cumcnt_session == 1 and out[8].l_cumcnt_session == 0


def test_upto_freezes_after_n(base):
    feats = asof.asof_user_content_part(base, None)
    out = {r.row_id: r for r in asof.asof_upto(feats, 2).collect()}
    # user 1 reaches r_cumcnt 3 at container 3; frozen values are the maxima over r_cumcnt <= 2
    assert out[6].r_cumcnt_upto == 2 and out[8].r_cumcnt_upto == 2 and out[8].ac_cumsum_upto == 1


def test_tags_sum_over_row_tags(spark, base):
    content = spark.createDataFrame([(0, 10, 1, [1, 2]), (1, 11, 2, [2]), (2, 12, 1, [3])],
                                    "ql_id long, question_id long, part long, tags_array array<long>")
    t = base.drop("part").join(content.select(F.col("question_id").alias("content_id"), "ql_id"), "content_id", "left")
    tr = asof.tag_response(t, content)
    out = {r.row_id: r for r in asof.asof_tags(t, tr).collect()}
    # row 8 (content 10: tags 1, 2): earlier questions with tag 1 -> rows 1, 4; with tag 2 -> rows 1, 2, 4, 6
    assert out[8].r_cumcnt_tags == 6 and out[8].ac_cumsum_tags == 4
    assert out[3].r_cumcnt_tags is None                            # lectures have no tag entry


def test_rerank_both_equals_two_reranks(spark):
    raw = rows_frame(spark, ROWS).withColumn("task_container_id", F.lit(0).cast("long"))
    one = containers.rerank_both(raw, chunk_ms=7 * H).select("row_id", "task_container_id", "task_container_id_q")
    two = containers.rerank_containers(containers.rerank_containers(raw, chunk_ms=3 * H), containers.TCQ,
                                       excl_lectures=True, chunk_ms=5 * H)
    assert sorted(one.collect()) == sorted(two.select(*one.columns).collect())
