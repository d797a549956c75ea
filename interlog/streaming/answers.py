"""Delayed answers on streams (row 93): questions and their answers arrive on two streams.

The batch form (``serving.attach_delayed_answers``) needs the whole previous batch at hand. Here both sides are
streams with watermarks, joined on the row's key within a time bound, so the state of either side holds only
rows whose partner may still come and the watermark drops the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_attach_delayed_answers(questions: DataFrame, answers: DataFrame, keys: Sequence[str] = ("row_id",),
                                  asked: str = "asked_at", answered: str = "answered_at", within: str = "12 hours",
                                  lateness: str = "6 hours", how: str = "left_outer") -> DataFrame:
    """``questions`` with the columns of ``answers``, matched on ``keys`` where the answer comes not before the
    question and at most ``within`` after it.

    ``lateness`` is the watermark delay of both streams: a row later than that is dropped, as is an answer past
    ``within``. ``inner`` emits a question when its answer is there; ``left_outer`` also emits a question without one,
    with nulls, once the watermark has passed the time its answer could come. ``keys`` may be a row's id or its batch
    and position. On static frames the same call is an ordinary join."""
    q = questions.withWatermark(asked, lateness).alias("q")
    renamed = answers.withWatermark(answered, lateness)
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_answer_{k}")
    a = renamed.alias("a")
    on = [F.col(f"q.{k}") == F.col(f"a._answer_{k}") for k in keys]
    on += [F.col(f"a.{answered}") >= F.col(f"q.{asked}"),
           F.col(f"a.{answered}") <= F.col(f"q.{asked}") + F.expr(f"INTERVAL {within}")]
    match = on[0]
    for c in on[1:]:
        match = match & c
    return q.join(a, match, how).drop(*[f"_answer_{k}" for k in keys])


def replay_by_time(df: DataFrame, path: str, column: str, files: int) -> None:
    """Write a static table as ``files`` appends in the order of ``column``, for a file stream that takes one a
    trigger. Rows of one time stay in one file."""
    low, high = df.agg(F.min(F.col(column).cast("double")), F.max(F.col(column).cast("double"))).first()
    if low is None:
        df.write.mode("append").parquet(path)
        return
    width = (high - low) / files + 1e-3
    place = ((F.col(column).cast("double") - low) / width).cast("int")
    for i in range(files):
        df.where(place == i).coalesce(1).write.mode("append").parquet(path)
