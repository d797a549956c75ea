"""Streaming totals: a bucket of users equals each user alone."""

import math
import random

import pandas as pd

from interlog.streaming import serving


class _State:
    def __init__(self):
        self.held = None

    exists = property(lambda self: self.held is not None)
    get = property(lambda self: self.held)

    def update(self, value):
        self.held = value


def test_a_bucket_of_users_over_batches_equals_each_user_alone():
    rnd = random.Random(4)
    rows = [(i, u, i // 3, int(rnd.random() < 0.2), rnd.randrange(2), rnd.choice([None, rnd.random() * 9])) for i in range(240)
            for u in [rnd.choice([0, 7, 8, None])]]
    cols = ["row_id", "_user", "timestamp", "content_type_id", "answered_correctly", "prior_question_elapsed_time"]
    state, got = _State(), {}
    for lo in range(0, 240, 60):
        part = [r for r in rows[lo:lo + 60] if lo != 60 or r[1] != 7]            # a user without rows in one batch
        pdf = pd.DataFrame([(r[0], r[1] or 0, *r[2:]) for r in part], columns=cols)
        pdf = pdf.assign(_no_user=[r[1] is None for r in part], _no_row=False, _no_time=False).sample(frac=1, random_state=1)
        pdf["prior_question_elapsed_time"] = pdf["prior_question_elapsed_time"].astype(float)
        for out in serving._asof_step((0,), iter([pdf]), state):
            for r in out.itertuples():
                got[r.row_id] = (r.ac_cumsum, r.r_cumcnt, r.l_cumcnt, r.pqet_cumsum)
    for u in (0, 7, 8, None):
        ac = n = lec = e = pending = 0
        mine = [r for r in rows if r[1] == u and not (u == 7 and 60 <= r[0] < 120)]
        for t in sorted({r[2] for r in mine}):
            box = [r for r in mine if r[2] == t]
            asked = [r for r in box if r[3] == 0]
            times = [r[5] for r in asked if r[5] is not None]
            if pending and times:
                e += pending * math.floor(max(times) + 0.5)
            assert all(got[r[0]] == (ac, n, lec, e) for r in box)
            ac, n, lec = ac + sum(r[4] for r in asked), n + len(asked), lec + len(box) - len(asked)
            pending = len(asked) or pending
    assert len(state.held[0]) == 4
