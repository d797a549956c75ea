"""Star joins of side tables, array membership, semi joins, serving state lookup and the row-band join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from interlog.functions.expr import clip_count, safe_pct, time_units
from interlog.operators.containers import TC
from interlog.operators.prefix import prior_extreme


def feature_join(train: DataFrame, content: DataFrame, *row_tables: tuple[DataFrame, str]) -> DataFrame:
    """LEFT joins: the content dimension on ``ql_id`` (small, size-checked broadcast upstream) and
    row-keyed side tables on their row key (a shuffle join on a unique key; no skew possible)."""
    out = train.join(content.drop(*[c for c in content.columns if c in train.columns and c != "ql_id"]),
                     "ql_id", "left")
    for table, key in row_tables:
        out = out.join(table, out["row_id"] == table[key], "left").drop(key)
    return out


def one_hot_join(train: DataFrame, content: DataFrame, hots: DataFrame) -> DataFrame:
    return feature_join(train, content).join(hots.drop("part"), "ql_id", "left")


def array_membership_join(left: DataFrame, content: DataFrame, on_part: bool = False) -> DataFrame:
    """``left.tag IN content.tags_array`` (and optionally the same part) as explode + equi-join."""
    ct = content.select("ql_id", "part", F.explode(F.array_distinct("tags_array")).alias("tag"))
    keys = ["part", "tag"] if on_part else ["tag"]
    if not on_part:
        ct = ct.drop("part")
    return left.join(ct, keys)


def known_ids_filter(test: DataFrame, history: DataFrame) -> DataFrame:
    """Rows whose user and content both occur in ``history`` (two semi joins)."""
    return (test.join(history.select("user_id").distinct(), "user_id", "left_semi")
                .join(history.select("content_id").distinct(), "content_id", "left_semi"))


def asked_rows(state: DataFrame, asked: DataFrame, max_keys: int = 1_000_000) -> DataFrame:
    """The rows of ``state`` whose key occurs in ``asked`` (its key columns). Up to ``max_keys`` counted rows the keys
    are broadcast and the semi-join runs where the state is scanned, before any shuffle; beyond, it is an ordinary
    semi-join."""
    small = asked.limit(max_keys + 1).count() <= max_keys
    return state.join(F.broadcast(asked) if small else asked, asked.columns, "left_semi")


def state_lookup(batch: DataFrame, users: DataFrame, users_content: DataFrame, users_tag: DataFrame,
                 users_part: DataFrame, questions: DataFrame, session_hours: float = 72,
                 max_keys: int = 1_000_000) -> DataFrame:
    """Serving features for a batch of question rows from the state tables; 0 / -1 where absent.

    ``questions`` carries (question_id, part, tag_0, tags_array) and any per-question columns. Each state table is
    cut down to the keys that the batch asks for before it is moved (``asked_rows``), so a small batch does not
    shuffle whole states."""
    gap = session_hours * 3_600_000
    users, users_content, users_tag, users_part = (
        asked_rows(state, asked, max_keys) for state, asked in zip(
            (users, users_content, users_tag, users_part), asked_keys(batch, questions), strict=True))
    u = users.select("user_id", *[F.col(c).alias(f"u_{c}") for c in users.columns if c != "user_id"])
    tag_sum = (batch.select("row_id", "user_id", "content_id")
               .join(questions.select(F.col("question_id").alias("content_id"),
                                      F.explode("tags_array").alias("tag")), "content_id")
               .join(users_tag, ["user_id", "tag"])
               .groupBy("row_id").agg(F.sum("ac_cumsum_tag").alias("ac_cumsum_tags"),
                                      F.sum("r_cumcnt_tag").alias("r_cumcnt_tags"),
                                      F.sum("l_cumcnt_tag").alias("l_cumcnt_tags")))
    q = questions.select(F.col("question_id").alias("content_id"), "part", "tag_0")
    j = (batch.join(u, "user_id", "left").join(users_content, ["user_id", "content_id"], "left")
              .join(q, "content_id", "left")
              .join(users_tag.select("user_id", F.col("tag").alias("tag_0"),
                                     F.col("ac_cumsum_tag").alias("ac_cumsum_tag_0"),
                                     F.col("r_cumcnt_tag").alias("r_cumcnt_tag_0"),
                                     F.col("l_cumcnt_tag").alias("l_cumcnt_tag_0")), ["user_id", "tag_0"], "left")
              .join(users_part, ["user_id", "part"], "left")
              .join(tag_sum, "row_id", "left"))
    z = F.lit(0).cast("long")
    new_session = (F.col("timestamp") - F.col("u_timestamp")) > gap
    minute, second = time_units("timestamp", "prior_question_elapsed_time")

    def zero(c):
        return F.coalesce(F.col(c), z)

    sess = {c: F.coalesce(F.when(new_session, z).otherwise(F.col(f"u_{c}")), z)
            for c in ("ac_cumsum_session", "r_cumcnt_session", "l_cumcnt_session")}
    return j.select(
        "row_id", "user_id", "content_id", minute.alias("ts_minute"), second.alias("pqet_sec"),
        F.coalesce(clip_count("u_r_cumcnt", 300), z).alias("r_cumcnt_clip"),
        F.coalesce(F.when(new_session, F.col("u_session") + 1).otherwise(F.col("u_session")), z).alias("session"),
        *[v.alias(k) for k, v in sess.items()],
        F.when(new_session, F.lit(-1).cast("long"))
         .otherwise(safe_pct("u_ac_cumsum_session", "u_r_cumcnt_session")).alias("ac_cumsum_pct_session"),
        F.coalesce("u_ac_cumsum", z).alias("ac_cumsum"), safe_pct("u_ac_cumsum", "u_r_cumcnt").alias("ac_cumsum_pct"),
        F.coalesce("u_r_cumcnt", z).alias("r_cumcnt"), F.coalesce("u_l_cumcnt", z).alias("l_cumcnt"),
        F.coalesce("u_ac_cumsum_upto", z).alias("ac_cumsum_upto"),
        safe_pct("u_ac_cumsum_upto", "u_r_cumcnt_upto").alias("ac_cumsum_pct_upto"),
        F.coalesce("u_r_cumcnt_upto", z).alias("r_cumcnt_upto"),
        zero("ac_cumsum_content_id").alias("ac_cumsum_content_id"),
        safe_pct("ac_cumsum_content_id", "r_cumcnt_content_id").alias("ac_cumsum_pct_content_id"),
        zero("r_cumcnt_content_id").alias("r_cumcnt_content_id"),
        zero("ac_cumsum_tag_0").alias("ac_cumsum_tag_0"),
        safe_pct("ac_cumsum_tag_0", "r_cumcnt_tag_0").alias("ac_cumsum_pct_tag_0"),
        zero("r_cumcnt_tag_0").alias("r_cumcnt_tag_0"), zero("l_cumcnt_tag_0").alias("l_cumcnt_tag_0"),
        zero("ac_cumsum_tags").alias("ac_cumsum_tags"), zero("r_cumcnt_tags").alias("r_cumcnt_tags"),
        zero("l_cumcnt_tags").alias("l_cumcnt_tags"),
        safe_pct("ac_cumsum_tags", "r_cumcnt_tags").alias("ac_cumsum_pct_tags"),
        zero("ac_cumsum_part").alias("ac_cumsum_part"),
        safe_pct("ac_cumsum_part", "r_cumcnt_part").alias("ac_cumsum_pct_part"),
        zero("r_cumcnt_part").alias("r_cumcnt_part"), zero("l_cumcnt_part").alias("l_cumcnt_part"),
        "part", "tag_0")


def asked_keys(batch: DataFrame, questions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The keys that question rows ask of the states by user, (user, content), (user, tag) and (user, part)."""
    rows = batch.select("user_id", "content_id").distinct()
    of = rows.join(questions.select(F.col("question_id").alias("content_id"), "part", "tags_array"), "content_id")
    return (rows.select("user_id").distinct(), rows, of.select("user_id", F.explode("tags_array").alias("tag")).distinct(),
            of.select("user_id", "part").distinct())


def prior_rows_join(train: DataFrame, window: int = 10) -> DataFrame:
    """Per row: count and answer sum of the user's rows in earlier containers whose row id is at least
    the container's first row id minus (window + 1).

    Rows whose id is below every later container's first id (ids growing with time, the normal case) can
    only qualify inside a band of ``window + 1`` ids below that first id: those candidates are generated
    with ``sequence`` + explode and matched by an equi-join on (user, row id). Rows that break the order
    (their id reaches a later container's first id) are matched against the later containers of the same
    user with an equi-join on user; their number is zero when ids follow time."""
    rows = train.select("user_id", "row_id", TC, "answered_correctly")
    cont = rows.groupBy("user_id", TC).agg(F.min("row_id").alias("min_row"))
    band = cont.select("user_id", TC, F.explode(F.sequence(F.col("min_row") - (window + 1),
                                                           F.col("min_row") - 1)).alias("row_id"))
    hits = (band.join(rows.select("user_id", "row_id", F.col(TC).alias("_tc2"), "answered_correctly"),
                      ["user_id", "row_id"])
                .where(F.col("_tc2") < F.col(TC)))
    # smallest first-row id among each container's later containers (chunked suffix minimum)
    suffix = prior_extreme(cont.withColumn("_neg", -F.col(TC)), ["user_id"], "_neg",
                           {"_later_min": F.col("min_row")}, "min").select(
        "user_id", (-F.col("_neg")).alias(TC), "_later_min")
    odd = (rows.join(suffix, ["user_id", TC]).where(F.col("row_id") >= F.col("_later_min"))
               .select("user_id", "row_id", F.col(TC).alias("_tc2"), "answered_correctly"))
    odd_hits = (cont.join(odd, "user_id")
                    .where((F.col("_tc2") < F.col(TC)) & (F.col("row_id") >= F.col("min_row")))
                    .select("user_id", TC, "row_id", "_tc2", "answered_correctly"))
    allhits = hits.select("user_id", TC, "row_id", "answered_correctly").unionByName(
        odd_hits.select("user_id", TC, "row_id", "answered_correctly"))
    per_cont = allhits.groupBy("user_id", TC).agg(F.count("row_id").alias("roll_count"),
                                                  F.sum("answered_correctly").alias("_acs"))
    z = F.lit(0).cast("long")
    return (train.select("row_id", "user_id", TC).join(per_cont, ["user_id", TC], "left")
                 .select("row_id", F.coalesce("_acs", z).alias("answered_correctly_rollsum"),
                         F.coalesce("roll_count", z).alias("roll_count")))
