"""Serving over micro-batches: delayed answers, state upserts, keyed as-of state, scoring.

The reference serves one batch at a time: attach the previous batch's answers, update the user /
content / tag / part state, read the state for the new questions, score, emit. Here the state lives in
Spark: either in the streaming state store (``streaming_asof_features``, a row per bucket of users) or in
bucketed tables of which ``foreachBatch`` rewrites what a micro-batch touches (``foreach_batch_scoring``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from interlog.functions.expr import safe_avg, safe_pct
from interlog.operators.containers import is_l, is_q
from interlog.operators.prefix import dense_rank0

MESSAGE_CHUNK = 1024
SESSION_HOURS = 72
UPTO = 10


# ---- row 93: answers of batch g arrive with batch g + 1 ------------------------------------------------

def batch_positions(rows: DataFrame, chunk_size: float = 1 << 20) -> DataFrame:
    """Position of each row inside its batch (row-id order), from the chunked distinct-rank."""
    pos = dense_rank0(rows, ["batch_id"], "row_id", "pos", chunk_size)
    return rows.join(pos, ["batch_id", "row_id"])


def delayed_answer_messages(rows: DataFrame, chunk: int = MESSAGE_CHUNK) -> DataFrame:
    """The upstream side: list-text answers of batch g, delivered with batch g + 1 in pieces of at most
    ``chunk`` positions (``msg_offset`` = first position of the piece)."""
    p = batch_positions(rows).withColumn("_m", (F.col("pos") / chunk).cast("long"))
    items = F.array_sort(F.collect_list(F.struct("pos", "answered_correctly")))
    g = p.groupBy("batch_id", "_m").agg(items.alias("_it"))
    text = F.concat(F.lit("["), F.array_join(F.transform("_it", lambda e: e["answered_correctly"].cast("string")),
                                             ", "), F.lit("]"))
    return g.select((F.col("batch_id") + 1).alias("batch_id"), (F.col("_m") * chunk).alias("msg_offset"),
                    text.alias("prior_group_answers_correct"))


def attach_delayed_answers(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """Parse the list text (``from_json`` + ``posexplode``) and match answers to the previous batch by
    position: an equi-join on (batch, position)."""
    ans = messages.select((F.col("batch_id") - 1).alias("batch_id"), "msg_offset",
                          F.posexplode(F.from_json("prior_group_answers_correct", "array<int>")).alias("p", "a"))
    ans = ans.select("batch_id", (F.col("msg_offset") + F.col("p")).alias("pos"),
                     F.col("a").cast("long").alias("answered_correctly"))
    base = rows.drop("answered_correctly") if "answered_correctly" in rows.columns else rows
    return batch_positions(base).join(ans, ["batch_id", "pos"], "left").drop("pos")


# ---- rows 94 / 95: state upserts (batch form) ---------------------------------------------------------------

USER_STATE = ["user_id", "ac_cumsum", "aic_cumsum", "r_cumcnt", "l_cumcnt", "ac_cumsum_upto", "aic_cumsum_upto",
              "r_cumcnt_upto", "ac_cumsum_session", "aic_cumsum_session", "r_cumcnt_session", "l_cumcnt_session",
              "timestamp", "session"]


def empty_user_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} long" for c in USER_STATE))


def upsert_user_state(users: DataFrame, delta: DataFrame, hours: float = SESSION_HOURS,
                      upto: int = UPTO) -> DataFrame:
    """Merge one micro-batch of answered rows into the user state, as if its containers (rows sharing
    a timestamp) were applied one after another in time order, questions before lectures:

    * totals add; first-``upto`` counters add only while fewer than ``upto`` responses were counted
      (row order);
    * a question container more than ``hours`` after the stored time starts a new session, and the
      session counters restart at that container; the stored time moves to each question container;
    * a lecture container more than ``hours`` after the stored time (lectures never move it) sets the
      session lecture counter to 1, else adds; a user's very first row sets the stored time.

    The sequential rules become window expressions over each user's containers inside the micro-batch
    (bounded by the trigger size), then one aggregate per user and a full outer join with the state."""
    gap = int(hours * 3_600_000)
    z = F.lit(0).cast("long")
    q = delta.where(is_q())
    rank = dense_rank0(q, ["user_id"], "row_id", "_k", 1 << 20)
    firsts = q.join(rank, ["user_id", "row_id"]).groupBy("user_id").agg(
        F.collect_list(F.struct("_k", "answered_correctly")).alias("_items"))
    cont = delta.groupBy("user_id", "timestamp").agg(
        F.sum(is_q().cast("long")).alias("_nq"),
        F.sum(F.when(is_q(), F.col("answered_correctly")).otherwise(0)).alias("_acq"),
        F.sum(is_l().cast("long")).alias("_nl"))
    old_ts = users.select("user_id", F.col("timestamp").alias("_t_old"))
    w = Window.partitionBy("user_id").orderBy("timestamp")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto_here = w.rowsBetween(Window.unboundedPreceding, 0)
    q_ts = F.when(F.col("_nq") > 0, F.col("timestamp"))
    c = (cont.join(old_ts, "user_id", "left")
             .withColumn("_t0", F.coalesce(F.col("_t_old"), F.min("timestamp").over(Window.partitionBy("user_id"))))
             .withColumn("_tq_prev", F.coalesce(F.last(q_ts, ignorenulls=True).over(before), F.col("_t0")))
             .withColumn("_tq_here", F.coalesce(F.last(q_ts, ignorenulls=True).over(upto_here), F.col("_t0")))
             .withColumn("_qflag", (F.col("_nq") > 0) & (F.col("timestamp") - F.col("_tq_prev") > gap))
             .withColumn("_lflag", (F.col("_nl") > 0) & (F.col("timestamp") - F.col("_tq_here") > gap)))
    last_q = F.max(F.when(F.col("_qflag"), F.col("timestamp")))
    last_l = F.max(F.when(F.col("_lflag"), F.col("timestamp")))
    per_user = c.groupBy("user_id").agg(
        F.first("_t0").alias("_t0"),
        F.sum("_acq").alias("_ac"), F.sum(F.col("_nq") - F.col("_acq")).alias("_aic"), F.sum("_nq").alias("_r"),
        F.sum("_nl").alias("_l"), F.max(q_ts).alias("_qts"),
        F.sum(F.col("_qflag").cast("long")).alias("_nflags"), last_q.alias("_last_q"), last_l.alias("_last_l"),
        F.collect_list(F.struct("timestamp", "_nq", "_acq", "_nl")).alias("_conts"))
    j = users.join(per_user, "user_id", "full").join(firsts, "user_id", "left")
    old = {k: F.coalesce(F.col(k), z) for k in USER_STATE if k != "user_id"}
    flagged = F.coalesce(F.col("_nflags"), z) > 0
    since_q = F.filter("_conts", lambda e: e["timestamp"] >= F.col("_last_q"))
    after_l = F.filter("_conts", lambda e: e["timestamp"] > F.col("_last_l"))

    def total(arr, f):
        return F.aggregate(arr, z, lambda acc, e: acc + e[f])
    room = F.greatest(F.lit(upto) - old["r_cumcnt_upto"], z)
    first = F.filter(F.coalesce(F.col("_items"), F.array().cast("array<struct<_k:bigint,answered_correctly:bigint>>")),
                     lambda e: e["_k"] < room)
    up_ac = F.aggregate(first, z, lambda acc, e: acc + e["answered_correctly"])
    up_n = F.size(first).cast("long")

    def add(col, d):
        return old[col] + F.coalesce(F.col(d), z)
    sess_ac = F.when(flagged, total(since_q, "_acq")).otherwise(add("ac_cumsum_session", "_ac"))
    sess_r = F.when(flagged, total(since_q, "_nq")).otherwise(add("r_cumcnt_session", "_r"))
    sess_aic = F.when(flagged, total(since_q, "_nq") - total(since_q, "_acq")).otherwise(
        add("aic_cumsum_session", "_aic"))
    sess_l = F.when(F.col("_last_l").isNotNull(), 1 + total(after_l, "_nl")).otherwise(add("l_cumcnt_session", "_l"))
    return j.select(
        "user_id",
        add("ac_cumsum", "_ac").alias("ac_cumsum"), add("aic_cumsum", "_aic").alias("aic_cumsum"),
        add("r_cumcnt", "_r").alias("r_cumcnt"), add("l_cumcnt", "_l").alias("l_cumcnt"),
        (old["ac_cumsum_upto"] + up_ac).alias("ac_cumsum_upto"),
        (old["aic_cumsum_upto"] + up_n - up_ac).alias("aic_cumsum_upto"),
        (old["r_cumcnt_upto"] + up_n).alias("r_cumcnt_upto"),
        sess_ac.alias("ac_cumsum_session"), sess_aic.alias("aic_cumsum_session"), sess_r.alias("r_cumcnt_session"),
        sess_l.alias("l_cumcnt_session"),
        F.coalesce(F.col("_qts"), F.col("timestamp"), F.col("_t0")).alias("timestamp"),
        (old["session"] + F.coalesce(F.col("_nflags"), z)).alias("session"),
    )


def upsert_keyed_totals(state: DataFrame, delta: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    """(user, attribute) totals: old state plus the micro-batch, merged with union + groupBy. The rows go into the one
    grouping as they are, so they are added up before they move and move once."""
    names = [f"{p}{suffix}" for p in ("ac_cumsum", "aic_cumsum", "r_cumcnt", "l_cumcnt")]
    values = (F.when(is_q(), F.col("answered_correctly")).otherwise(0), F.when(is_q(), 1 - F.col("answered_correctly")).otherwise(0),
              is_q().cast("long"), is_l().cast("long"))
    d = delta.select(*keys, *[v.alias(n) for n, v in zip(names, values, strict=True)])
    return state.select(*keys, *names).unionByName(d).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])


# ---- row 96: keyed streaming state ---------------------------------------------------------------------------

ASOF_OUT = ("row_id long, _no_row boolean, _user long, _no_user boolean, ac_cumsum long, r_cumcnt long, l_cumcnt long, "
            "pqet_cumsum long")
ASOF_BUCKETS = 2048
#: the users of a bucket (null has a flag) with their totals and the size of their last question container
ASOF_HELD = ("user", "none", "ac", "r", "l", "e", "pending")
ASOF_STATE = ", ".join(f"{c} array<long>" for c in ASOF_HELD)


def _asof_step(key, pdfs, state):
    """Per bucket of users: for each container (a user's rows sharing a timestamp) in time order, emit the totals of the
    user's earlier containers, then add the container. The elapsed time of the last question container is only known
    when the next question container arrives (its "prior" field), so it stays pending. All users of the bucket are
    worked on at once: running sums over the sorted rows, less what they are where the user begins."""
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return
    pdf = pd.concat(frames)
    order = np.lexsort([pdf[c].to_numpy() for c in ("row_id", "_no_row", "timestamp", "_no_time", "_user", "_no_user")])
    col = {c: pdf[c].to_numpy()[order] for c in pdf.columns}
    none, user, ts, late = (col[c] for c in ("_no_user", "_user", "timestamp", "_no_time"))
    new_user = np.r_[True, (user[1:] != user[:-1]) | (none[1:] != none[:-1])]
    new = new_user | np.r_[True, (ts[1:] != ts[:-1]) | late[1:]]        # rows without a time stand alone
    starts = np.flatnonzero(new)
    first = np.flatnonzero(new_user[starts])                             # a user's first container
    own = np.cumsum(new_user[starts]) - 1                                # the user of each container
    isq = col["content_type_id"] == 0
    counts = {"ac": np.where(isq, np.clip(col["answered_correctly"], 0, None), 0), "r": isq, "l": col["content_type_id"] == 1}
    counts = {c: np.add.reduceat(x.astype("int64"), starts) for c, x in counts.items()}
    pq = col["prior_question_elapsed_time"].astype("float64")
    pq_max = np.maximum.reduceat(np.where(isq & ~np.isnan(pq), pq, -np.inf), starts)

    # what the state holds of the users at hand; users without rows in this batch keep their place
    held = [np.asarray(x, "int64") for x in state.get] if state.exists else [np.zeros(0, "int64")] * len(ASOF_HELD)
    place = {u: i for i, u in enumerate(zip(held[0].tolist(), held[1].tolist(), strict=True))}
    mine = list(zip(user[starts[first]].tolist(), none[starts[first]].astype("int64").tolist(), strict=True))
    at = np.array([place.setdefault(u, len(place)) for u in mine])
    names = np.array(list(place), "int64").reshape(-1, 2)
    table = {c: np.r_[x, np.zeros(len(place) - len(x), "int64")] for c, x in zip(ASOF_HELD[2:], held[2:], strict=True)}
    table |= {"user": names[:, 0], "none": names[:, 1]}

    asked = counts["r"] > 0
    last = np.maximum.accumulate(np.where(asked, np.arange(len(starts)), -1))
    before = np.r_[-1, last[:-1]]                                        # the question container before, if of the same user
    pending = np.where(before >= first[own], counts["r"][before], table["pending"][at][own])
    known = asked & (pending > 0) & np.isfinite(pq_max)
    elapsed = np.where(known, pq_max, 0.0)
    added = pending * (np.floor(np.abs(elapsed) + 0.5) * np.where(elapsed >= 0, 1, -1)).astype("int64") * known
    out = {}
    for c, x in {**counts, "e": added}.items():
        total = np.cumsum(x)
        total = total - (total - x)[first][own] + table[c][at][own]      # with this container
        table[c][at] = total[np.r_[first[1:], len(starts)] - 1]
        out[c] = total if c == "e" else total - x                        # elapsed times are those of earlier containers
    ends = last[np.r_[first[1:], len(starts)] - 1]
    table["pending"][at] = np.where(ends >= first, counts["r"][ends], table["pending"][at])
    state.update(tuple(table[c].tolist() for c in ASOF_HELD))
    cid = np.cumsum(new) - 1
    yield pd.DataFrame({"row_id": col["row_id"], "_no_row": col["_no_row"], "_user": user, "_no_user": none,
                        "ac_cumsum": out["ac"][cid], "r_cumcnt": out["r"][cid], "l_cumcnt": out["l"][cid], "pqet_cumsum": out["e"][cid]})


def streaming_asof_features(stream: DataFrame, buckets: int = ASOF_BUCKETS) -> DataFrame:
    """As-of user totals on a stream of raw interactions (row 50's user family, question rows equal).

    The state is keyed by a bucket of users (``buckets``, fixed for a checkpoint), so a micro-batch costs a Python call for
    each bucket that its users fall into, however many users it has."""
    zero = F.lit(0).cast("long")
    cols = stream.select(F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int").alias("_bucket"),
                         *[F.coalesce(c, zero).alias(n) for c, n in (("user_id", "_user"), ("row_id", "row_id"), ("timestamp", "timestamp"))],
                         *[F.col(c).isNull().alias(n) for c, n in (("user_id", "_no_user"), ("row_id", "_no_row"), ("timestamp", "_no_time"))],
                         F.coalesce("content_type_id", F.lit(-1).cast("long")).alias("content_type_id"),
                         F.coalesce("answered_correctly", zero).alias("answered_correctly"), "prior_question_elapsed_time")
    out = cols.groupBy("_bucket").applyInPandasWithState(
        _asof_step, ASOF_OUT, ASOF_STATE, "append", GroupStateTimeout.NoTimeout)
    out = out.select(F.when(~F.col("_no_row"), F.col("row_id")).alias("row_id"), F.when(~F.col("_no_user"), F.col("_user")).alias("user_id"),
                     "ac_cumsum", "r_cumcnt", "l_cumcnt", "pqet_cumsum")
    return (out.withColumn("ac_cumsum_pct", safe_pct("ac_cumsum", "r_cumcnt"))
               .withColumn("pqet_cumavg", safe_avg("pqet_cumsum", "r_cumcnt")))


def replay_files(df: DataFrame, path: str, n_chunks: int, partitions: int) -> int:
    """Write a static table as a time-ordered file stream: ``n_chunks`` appends by batch range, each
    hash-partitioned by user so that one user's rows of a chunk sit in one file. Reading it with
    ``maxFilesPerTrigger = partitions`` then feeds every user's containers in time order."""
    lo, hi = df.agg(F.min("batch_id"), F.max("batch_id")).first()
    width = (hi - lo) // n_chunks + 1
    for i in range(n_chunks):
        part = df.where((F.col("batch_id") >= lo + i * width) & (F.col("batch_id") < lo + (i + 1) * width))
        part.repartition(partitions, "user_id").write.mode("append").parquet(path)
    return partitions


def run_to_table(spark: SparkSession, out: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a streaming query to completion (available-now trigger) into parquet and read it back."""
    q = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
            .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


# ---- rows 97-99: scoring ---------------------------------------------------------------------------------------

def average_ensemble(df: DataFrame, cols: list[str], name: str = "answered_correctly") -> DataFrame:
    """Mean of several model scores."""
    total = sum((F.col(c) for c in cols), F.lit(0.0))
    return df.withColumn(name, total / len(cols))


def prediction_scorecard(pred: DataFrame, truth: DataFrame, score: str = "answered_correctly") -> DataFrame:
    """Join predictions to the true answers by row id and compute the exact AUC."""
    from interlog.operators.analysis import roc_auc
    j = pred.select("row_id", F.col(score).alias("y_pred")).join(
        truth.select("row_id", F.col("answered_correctly").alias("y_true")), "row_id")
    return roc_auc(j, "y_true", "y_pred")


def foreach_batch_scoring(stream: DataFrame, state_dir: str, out_dir: str, checkpoint: str,
                          users0: DataFrame, score_fn, buckets: int = 32) -> None:
    """Per micro-batch: read the current state of the batch's users, look up features for its
    questions, score them (``score_fn(questions, users) -> DataFrame(row_id, answered_correctly)``),
    append the predictions, then merge the batch's answers into the state.

    The state lies in buckets (``buckets.BucketedState``): an epoch reads and rewrites the buckets of its own
    users only, and versions before the last two are removed. Predictions are a folder per epoch. A replayed
    epoch (after a failure) starts from the state before it and rewrites exactly its own files."""
    from interlog.streaming.buckets import BucketedState

    spark = users0.sparkSession
    state = BucketedState(spark, state_dir, ", ".join(f"{c} long" for c in USER_STATE), ["user_id"], buckets)
    state.create(users0)

    def step(batch: DataFrame, epoch: int):
        users = state.read_for(batch, epoch)
        score_fn(batch.where(is_q()), users).write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")
        state.merge(epoch, batch, lambda old: upsert_user_state(old, batch))
        state.vacuum()

    q = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
