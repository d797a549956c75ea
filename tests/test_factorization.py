"""Logistic factorization against a plain numpy fit, and against squared loss on held-out answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from interlog.operators import ml


def made(n_users=60, n_items=40, seed=1):
    draw = np.random.default_rng(seed)
    u, c = draw.normal(size=(n_users, 2)), draw.normal(size=(n_items, 2))
    z = u @ c.T + draw.normal(size=n_users)[:, None] + draw.normal(size=n_items)
    y = (draw.random(z.shape) < 1 / (1 + np.exp(-z))).astype(int)
    held = draw.random(z.shape) < 0.2
    return y, held


def log_loss(y, p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))


def arrays(frames):
    out = []
    for frame in frames:
        rows = sorted((r.id, r.vector, r.bias) for r in frame.collect())
        out += [np.array([r[1] for r in rows]), np.array([r[2] for r in rows])]
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    y, held = made()
    rows = [(int(i), int(j), int(y[i, j])) for i, j in zip(*np.nonzero(~held))] + [(3, 4, None)]
    df = spark.createDataFrame(rows, "user_id long, content_id long, answered_correctly long").repartition(5)
    return y, held, df


def test_equals_a_plain_fit_and_the_loss_falls(fitted):
    y, held, df = fitted
    u, bu, c, bc = arrays(ml.logistic_factorization_train(df, rank=2, rounds=0, reg=0.5))
    mean = bc[0]
    seen = ~held
    assert abs(mean - np.log(y[seen].mean() / (1 - y[seen].mean()))) < 1e-12 and not bu.any()
    bc = bc - mean
    losses = []
    for _ in range(4):
        for turn in range(2):
            p = 1 / (1 + np.exp(-(mean + u @ c.T + bu[:, None] + bc)))
            penalty = 0.25 * (np.sum(u * u) + np.sum(c * c) + bu @ bu + bc @ bc)
            losses.append(log_loss(y[seen], p[seen]) * seen.sum() + penalty)
            e, mine, own, other, mask = (y - p) * seen, u, bu, c, seen
            if turn:
                e, mine, own, other, mask = e.T, c, bc, u, seen.T
            size = (1 + np.abs(other).sum(1)) / 4
            new = mine + (e @ other - 0.5 * mine) / (mask @ (size[:, None] * np.abs(other)) + 0.5)
            bias = own + (e.sum(1) - 0.5 * own) / (mask @ size + 0.5)
            if turn:
                c, bc = new, bias
            else:
                u, bu = new, bias
    assert all(b < a for a, b in zip(losses, losses[1:]))
    got = arrays(ml.logistic_factorization_train(df, rank=2, rounds=4, reg=0.5))
    for a, b in zip(got, (u, bu, c, bc + mean)):
        assert np.abs(a - b).max() < 1e-5
    again = arrays(ml.logistic_factorization_train(df.repartition(3), rank=2, rounds=4, reg=0.5))
    assert all((a == b).all() for a, b in zip(got, again))


def test_held_out_loss_is_below_squared_loss(fitted):
    y, held, df = fitted
    u, bu, c, bc = arrays(ml.logistic_factorization_train(df, rank=2, rounds=15, reg=1.0))
    als_u, _, als_c, _ = arrays(ml.factorization_train(df.where(F.col("answered_correctly").isNotNull()), rank=2, max_iter=10))
    mine = 1 / (1 + np.exp(-(u @ c.T + bu[:, None] + bc)))
    assert log_loss(y[held], mine[held]) < log_loss(y[held], (als_u @ als_c.T)[held])


def test_empty_and_one_sided_answers(spark):
    df = spark.createDataFrame([], "user_id long, content_id long, answered_correctly long")
    assert [f.count() for f in ml.logistic_factorization_train(df, rank=2, rounds=1)] == [0, 0]
    one = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], df.schema)
    assert np.isfinite(np.concatenate([a.ravel() for a in arrays(ml.logistic_factorization_train(one, rank=2, rounds=2))])).all()
