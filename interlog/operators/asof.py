"""As-of ("strictly before this container") statistics per user, content, part, tag and session.

Every PRIOR sum comes from two-level chunked prefix sums (``with_prior_sums`` on the rows themselves, ``prior_totals``
as a table by (keys, container)), so no task ever holds more than one chunk of one key's containers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from interlog.functions.expr import clip_count, round_long, safe_avg, safe_pct
from interlog.operators.containers import TC, TCQ, is_q
from interlog.operators.prefix import prior_totals, several_chunks, with_prior_sums
from interlog.session import cut_lineage, sized_broadcast

CHUNK_CONTAINERS = 4096


def _families(suffix: str, with_lectures: bool = True) -> dict[str, Column]:
    vals = {f"ac_cumsum{suffix}": F.col("answered_correctly"),
            f"r_cumcnt{suffix}": is_q().cast("long")}
    if with_lectures:
        vals[f"l_cumcnt{suffix}"] = F.col("content_type_id")
    vals[f"pqet_cumsum{suffix}"] = F.col("pqet_current")
    return vals


def _ratios(df: DataFrame, suffix: str, guard: Column | None = None) -> DataFrame:
    pct = safe_pct(f"ac_cumsum{suffix}", f"r_cumcnt{suffix}")
    avg = safe_avg(f"pqet_cumsum{suffix}", f"r_cumcnt{suffix}")
    if guard is not None:
        pct, avg = F.when(guard, pct), F.when(guard, avg)
    return df.withColumn(f"ac_cumsum_pct{suffix}", pct).withColumn(f"pqet_cumavg{suffix}", avg)


def with_part(df: DataFrame, content: DataFrame) -> DataFrame:
    if "part" in df.columns:
        return df
    return df.join(content.select("ql_id", "part"), "ql_id", "left")


def asof_user_content_part(df: DataFrame, content: DataFrame,
                           chunk_size: int = CHUNK_CONTAINERS) -> DataFrame:
    """PRIOR totals by (user), (user, content_id), (user, part) ordered by container, with pct / avg
    and the clipped response count."""
    base = with_part(df, content)
    out = with_prior_sums(base, ["user_id"], TC, [
        (["user_id"], _families("")), (["user_id", "content_id"], _families("_content_id", with_lectures=False)),
        (["user_id", "part"], _families("_part"))], chunk_size)
    for s in ("", "_content_id", "_part"):
        out = _ratios(out, s)
    return out.withColumn("r_cumcnt_clip", clip_count("r_cumcnt", 300))


def tag_response(train: DataFrame, content: DataFrame) -> DataFrame:
    """Question rows exploded by their content's tags: one row per (interaction, tag)."""
    tags = content.select("ql_id", "part", F.explode("tags_array").alias("tag"))
    q = train.where(is_q()).select("user_id", "row_id", TC, TCQ, "ql_id", "content_type_id",
                                 "answered_correctly", "pqet_current")
    return q.join(tags, "ql_id").select(
        "user_id", "row_id", TC, TCQ, "ql_id", "content_type_id", "part", "tag",
        "answered_correctly", "pqet_current")


def asof_tags(train: DataFrame, tag_resp: DataFrame, chunk_size: int = CHUNK_CONTAINERS) -> DataFrame:
    """PRIOR totals by (user, tag) and (user, part, tag), summed over each row's tags.
    Lecture rows have no tags entry and keep nulls."""
    fam_t, fam_pt = _families("_tags"), _families("_part_tags")
    names = [*fam_t, *fam_pt]
    used = tag_resp.select("row_id", "user_id", "part", "tag", TC, "answered_correctly", "content_type_id", "pqet_current")
    sums = with_prior_sums(used, ["user_id"], TC, [(["user_id", "tag"], fam_t), (["user_id", "part", "tag"], fam_pt)], chunk_size)
    per_row = (sums.dropna(subset=["user_id", "part", "tag", TC])
               .groupBy("row_id").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]))
    out = train.join(per_row, "row_id", "left")
    for s in ("_tags", "_part_tags"):
        out = _ratios(out, s, guard=F.col(f"r_cumcnt{s}").isNotNull())
    return out


def asof_session(df: DataFrame, hours: float = 18, chunk_size: int = CHUNK_CONTAINERS) -> DataFrame:
    """Session number = running count of rows whose gap to the previous question container exceeds
    ``hours`` (lecture rows: session 0); PRIOR totals inside (user, session).

    Both are prior sums over one row per (user, question container), which then joins the rows once. The lecture
    count is ordered by the full container id; lectures all sit in session 0, so it equals the user lecture count there.
    """
    gap = int(hours * 3_600_000)
    per = (df.where(is_q()).dropna(subset=["user_id", TCQ]).groupBy("user_id", TCQ).agg(
        F.sum(F.when(F.col("ts_delta") > gap, 1).otherwise(0)).cast("long").alias("_flags"), F.sum("answered_correctly").alias("_a"),
        F.count("*").alias("_n"), F.sum("pqet_current").alias("_p")))
    several = several_chunks(df.where(is_q()), TCQ, chunk_size)
    cont = (with_prior_sums(per, ["user_id"], TCQ, [(["user_id"], {"_f": F.col("_flags")})], chunk_size, several)
            .withColumn("session", F.col("_f") + F.col("_flags")))
    sums = {"ac_cumsum_session": F.col("_a"), "r_cumcnt_session": F.col("_n"), "pqet_cumsum_session": F.col("_p")}
    cont = with_prior_sums(cont, ["user_id"], TCQ, [(["user_id", "session"], sums)], chunk_size, several).select(
        "user_id", TCQ, "session", *sums)
    base = df
    if "l_cumcnt" not in base.columns:
        lec = prior_totals(df, ["user_id"], TC, {"l_cumcnt": F.col("content_type_id")}, chunk_size)
        base = base.join(lec, ["user_id", TC], "left")
    out = base.drop("session") if "session" in base.columns else base
    out = out.join(cont, ["user_id", TCQ], "left")
    zero = F.lit(0).cast("long")
    out = (out.withColumn("session", F.coalesce("session", zero))
              .withColumn("ac_cumsum_session", F.coalesce("ac_cumsum_session", zero))
              .withColumn("r_cumcnt_session", F.coalesce("r_cumcnt_session", zero))
              .withColumn("pqet_cumsum_session", F.coalesce("pqet_cumsum_session", zero))
              .withColumn("l_cumcnt_session", F.when(F.col("session") == 0, F.col("l_cumcnt")).otherwise(zero)))
    if "l_cumcnt" not in df.columns:
        out = out.drop("l_cumcnt")
    return _ratios(out, "_session")


def asof_upto(df: DataFrame, n: int = 10) -> DataFrame:
    """Features frozen after the first ``n`` responses: own as-of value while ``r_cumcnt <= n``,
    else the user's maxima / sums over the rows with ``r_cumcnt <= n``."""
    m = (df.where(F.col("r_cumcnt") <= n).groupBy("user_id")
           .agg(F.max("ac_cumsum").alias("_ac_max"), F.max("r_cumcnt").alias("_rc_max"),
                F.sum("pqet_current").alias("_e_sum"), F.avg("pqet_current").alias("_e_avg")))
    m = sized_broadcast(cut_lineage(m, "first_answers"))        # a row per user
    early = F.col("r_cumcnt") <= n
    ac = F.when(early, F.col("ac_cumsum")).otherwise(F.col("_ac_max"))
    rc = F.when(early, F.col("r_cumcnt")).otherwise(F.col("_rc_max"))
    return (df.join(m, "user_id", "left")
              .withColumn("ac_cumsum_upto", ac).withColumn("r_cumcnt_upto", rc)
              .withColumn("ac_cumsum_pct_upto", safe_pct(ac, rc))
              .withColumn("pqet_cumsum_upto", round_long(F.when(early, F.col("pqet_cumsum")).otherwise(F.col("_e_sum"))))
              .withColumn("pqet_cumavg_upto", round_long(F.when(early, F.col("pqet_cumavg").cast("double"))
                                                         .otherwise(F.col("_e_avg"))))
              .drop("_ac_max", "_rc_max", "_e_sum", "_e_avg"))


def top_content_cumsums(df: DataFrame, content_ids: Sequence[int],
                        chunk_size: int = CHUNK_CONTAINERS) -> DataFrame:
    """PRIOR counts of answers to a fixed list of contents, per user, by question container.
    Output: one row per question row (``row_id_tc``) with ac / r / pct columns per content id."""
    q = df.where(is_q())
    vals: dict[str, Column] = {}
    for cid in content_ids:
        vals[f"ac_cumsum_top_cid_{cid}"] = ((F.col("answered_correctly") == 1) & (F.col("content_id") == cid)).cast("long")
    for cid in content_ids:
        vals[f"r_cumcnt_top_cid_{cid}"] = (F.col("content_id") == cid).cast("long")
    rows = q.select("row_id", "user_id", TCQ, "answered_correctly", "content_id").dropna(subset=["user_id", TCQ])
    out = with_prior_sums(rows, ["user_id"], TCQ, [(["user_id"], vals)], chunk_size)
    pcts = [safe_pct(f"ac_cumsum_top_cid_{c}", f"r_cumcnt_top_cid_{c}").alias(f"ac_cumsum_pct_top_cid_{c}")
            for c in content_ids]
    return out.select(F.col("row_id").alias("row_id_tc"), *vals, *pcts)
