"""Row cleaning and container re-ranking (the first train transforms)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from interlog.functions.expr import round_long
from interlog.operators.prefix import CHUNK, dense_rank0, several_chunks

TC = "task_container_id"
TCQ = "task_container_id_q"
DAY_MS = 86_400_000
RANK_MS = 128 * DAY_MS


def is_q():
    return F.col("content_type_id") == 0


def is_l():
    return F.col("content_type_id") == 1


def fill_missing(df: DataFrame, column: str, value) -> DataFrame:
    """Null -> constant."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value).cast(df.schema[column].dataType)))


def zero_lecture_answers(df: DataFrame) -> DataFrame:
    """Answer flag is -1 on lectures in the raw data; set it to 0 so window totals include lectures."""
    return df.withColumn("answered_correctly", F.when(is_l(), F.lit(0).cast("long"))
                         .otherwise(F.col("answered_correctly")))


def keep_original_container(df: DataFrame, save_as: str = "tid_orig") -> DataFrame:
    return df.withColumn(save_as, F.col(TC))


def rerank_containers(df: DataFrame, column: str = TC, excl_lectures: bool = False,
                      chunk_ms: int = DAY_MS) -> DataFrame:
    """``column`` = dense rank - 1 of the timestamp per user (question rows only if ``excl_lectures``;
    lectures then get null). Ranks come from the chunked prefix count, then an equi-join on
    (user, timestamp) puts them back on the rows."""
    src = df.where(is_q()) if excl_lectures else df
    ranks = dense_rank0(src, ["user_id"], "timestamp", column, chunk_ms)
    out = df.drop(column) if column in df.columns else df
    out = out.join(ranks, ["user_id", "timestamp"], "left")
    if excl_lectures:
        out = out.withColumn(column, F.when(is_q(), F.col(column)))
    return out


def rerank_both(df: DataFrame, chunk_ms: int = RANK_MS) -> DataFrame:
    """Both re-rankings in one pass: per distinct (user, timestamp), the number of earlier distinct
    timestamps (``task_container_id``) and of earlier question timestamps (``task_container_id_q``,
    kept on question rows only), from one move of the rows by (user, chunk of time). A moment counts once: on the
    first of its rows."""
    t, chunk = F.col("timestamp"), F.floor(F.col("timestamp") / F.lit(chunk_ms))
    here = Window.partitionBy("user_id", CHUNK).orderBy("timestamp")
    rows = df.drop(TC, TCQ).withColumns({CHUNK: chunk, "_q": is_q()}).repartition("user_id", CHUNK)
    first = ~F.lag("timestamp").over(here).eqNullSafe(t)
    first_q = ~F.lag("timestamp").over(Window.partitionBy("user_id", CHUNK, "_q").orderBy("timestamp")).eqNullSafe(t)
    rows = rows.withColumn("_new", first.cast("long")).withColumn("_newq", (is_q() & first_q).cast("long"))
    before = here.rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({TC: F.coalesce(F.sum("_new").over(before), F.lit(0)), TCQ: F.coalesce(F.sum("_newq").over(before), F.lit(0))})
    # what a user's earlier chunks hold; nothing where the table lies in one chunk
    moments = (df.where(several_chunks(df, "timestamp", chunk_ms)).dropna(subset=["user_id", "timestamp"]).withColumn(CHUNK, chunk)
               .groupBy("user_id", CHUNK, "timestamp").agg(F.max(is_q().cast("long")).alias("_hq")))
    totals = moments.groupBy("user_id", CHUNK).agg(F.count("*").alias("_all"), F.sum("_hq").alias("_asked"))
    ahead = Window.partitionBy("user_id").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select("user_id", CHUNK, F.sum("_all").over(ahead).alias("_all"), F.sum("_asked").over(ahead).alias("_asked"))
    out = rows.join(earlier, ["user_id", CHUNK], "left")
    known = t.isNotNull() & F.col("user_id").isNotNull()
    zero = F.lit(0).cast("long")
    return out.withColumns({TC: F.when(known, F.col(TC) + F.coalesce("_all", zero)),
                            TCQ: F.when(known & is_q(), F.col(TCQ) + F.coalesce("_asked", zero))}).select(*rows.drop(CHUNK, "_q", "_new", "_newq").columns)


def _question_containers(df: DataFrame, value: str) -> DataFrame:
    return (df.where(is_q()).groupBy("user_id", TCQ)
              .agg(F.max(value).alias("_v"), F.max("timestamp").alias("_ts")))


def elapsed_current(df: DataFrame, source: str = "prior_question_elapsed_time",
                    name: str = "pqet_current", rounded: bool = True) -> DataFrame:
    """Elapsed time of this question container = the "prior" field of the next one (lectures 0).

    Next-container lookup is an equi-join on (user, container + 1) of a per-container table."""
    nxt = _question_containers(df, source).select(
        "user_id", (F.col(TCQ) - 1).alias(TCQ), F.col("_v").alias("_nv"))
    val = round_long("_nv") if rounded else F.col("_nv")
    return (df.join(nxt, ["user_id", TCQ], "left")
              .withColumn(name, F.when(is_l(), F.lit(0)).otherwise(val))
              .drop("_nv"))


def ts_delta(df: DataFrame) -> DataFrame:
    """Time since the previous question container; lectures 0, first container null."""
    prev = _question_containers(df, "timestamp").select(
        "user_id", (F.col(TCQ) + 1).alias(TCQ), F.col("_ts").alias("_prev_ts"))
    return (df.join(prev, ["user_id", TCQ], "left")
              .withColumn("ts_delta", F.when(is_l(), F.lit(0).cast("long"))
                          .otherwise(F.col("timestamp") - F.col("_prev_ts")))
              .drop("_prev_ts"))


def container_neighbours(df: DataFrame) -> DataFrame:
    """``pqet_current`` and ``ts_delta`` with one per-container table, made once, and one join: each container tells the
    one before it its elapsed time and the one after it its time."""
    qc = _question_containers(df, "prior_question_elapsed_time")
    kinds = {c: qc.schema[c].dataType for c in ("_v", "_ts")}
    told = F.array(F.struct((F.col(TCQ) - 1).alias(TCQ), F.col("_v").alias("_next"), F.lit(None).cast(kinds["_ts"]).alias("_prev_ts")),
                   F.struct((F.col(TCQ) + 1).alias(TCQ), F.lit(None).cast(kinds["_v"]).alias("_next"), F.col("_ts").alias("_prev_ts")))
    both = (qc.select("user_id", F.explode(told).alias("_told")).select("user_id", "_told.*")
            .groupBy("user_id", TCQ).agg(F.max("_next").alias("_next"), F.max("_prev_ts").alias("_prev_ts")))
    return (df.join(both, ["user_id", TCQ], "left")
              .withColumn("pqet_current", F.when(is_l(), F.lit(0).cast("long")).otherwise(round_long("_next")))
              .withColumn("ts_delta", F.when(is_l(), F.lit(0).cast("long"))
                          .otherwise(F.col("timestamp") - F.col("_prev_ts")))
              .drop("_next", "_prev_ts"))
