"""Property checks on random histories."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from interlog.operators import asof, containers, state

H = 3_600_000

row = st.tuples(st.integers(0, 2), st.integers(0, 12), st.integers(0, 3), st.integers(0, 1), st.integers(0, 1))


@settings(max_examples=2, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=25))
def test_prior_properties(spark, rows):
    data = [(i, u, t * H, c, typ, -1 if typ else a, None if t == 0 else float(100 * (t + 1)), 0)
            for i, (u, t, c, typ, a) in enumerate(rows)]
    raw = spark.createDataFrame(data, "row_id long, user_id long, timestamp long, content_id long, "
                                      "content_type_id long, answered_correctly long, "
                                      "prior_question_elapsed_time double, task_container_id long")
    t = containers.keep_original_container(raw)
    t = containers.rerank_both(t, chunk_ms=5 * H)
    t = containers.container_neighbours(t)
    t = containers.zero_lecture_answers(containers.fill_missing(t, "prior_question_elapsed_time", 0.0))
    t = t.withColumn("part", (F.col("content_id") % 2).cast("long"))
    f = asof.asof_user_content_part(t, None, chunk_size=2)
    f = asof.asof_session(f, 18, chunk_size=2).cache()
    out = f.collect()
    by = {}
    for r in out:
        by.setdefault((r.user_id, r.task_container_id), []).append(r)
    for rs in by.values():   # constant inside a container
        assert len({(r.ac_cumsum, r.r_cumcnt, r.l_cumcnt, r.pqet_cumsum) for r in rs}) == 1
    for u in {k[0] for k in by}:   # monotone over containers
        seq = [by[k][0] for k in sorted(k for k in by if k[0] == u)]
        for a, b in zip(seq, seq[1:]):
            assert a.r_cumcnt <= b.r_cumcnt and a.ac_cumsum <= b.ac_cumsum and a.l_cumcnt <= b.l_cumcnt
    final = {r.user_id: r for r in state.user_final_state(f.withColumn("r_cumcnt_clip", F.col("r_cumcnt")), 10)
             .collect()}
    for u in {k[0] for k in by}:   # final state = last PRIOR value + last container
        last = max(k for k in by if k[0] == u)
        rs = by[last]
        assert final[u].ac_cumsum == rs[0].ac_cumsum + sum(r.answered_correctly for r in rs)
        assert final[u].r_cumcnt == rs[0].r_cumcnt + sum(1 for r in rs if r.content_type_id == 0)
        assert final[u].l_cumcnt == rs[0].l_cumcnt + sum(r.content_type_id for r in rs)
    f.unpersist()
