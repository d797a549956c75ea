"""Container neighbours from one pass over the container table."""

from interlog.operators import containers


def test_container_neighbours_make_the_container_table_once(spark):
    rows = [(u, 0, c, c * 1000 + u, float(c) if c % 3 else None) for u in (1, 2) for c in range(5)] + [(None, 0, 0, 5, 1.0), (1, 1, None, 7, None)]
    df = spark.createDataFrame(rows, "user_id long, content_type_id long, task_container_id_q long, timestamp long, "
                                     "prior_question_elapsed_time double")
    got = {(r.user_id, r.task_container_id_q): (r.pqet_current, r.ts_delta) for r in containers.container_neighbours(df).collect()}
    assert got[1, 0] == (1, None) and got[1, 2] == (None, 1000) and got[2, 4] == (None, 1000) and got[None, 0] == (None, None)
    assert got[1, None] == (0, 0) and len(got) == 12
    plan = containers.container_neighbours(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
