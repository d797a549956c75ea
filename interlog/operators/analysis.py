"""Analysis aggregates: correlations, exact quantiles, histograms, ranking metrics, sorting helpers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from interlog.operators.containers import is_q, TC
from interlog.operators.ranges import positions, running_totals


def content_user_correlation(train: DataFrame) -> DataFrame:
    """Per content: response volume, overall rate, and the Pearson correlation between a user's rate on
    the content and the user's overall rate (two groupBys and a join on user)."""
    q = train.where(is_q())
    uc = q.groupBy("user_id", "content_id").agg(F.sum("answered_correctly").alias("ac"),
                                                F.count("answered_correctly").alias("r"))
    u = q.groupBy("user_id").agg(F.sum("answered_correctly").alias("u_ac"), F.count("answered_correctly").alias("u_r"))
    j = uc.join(u, "user_id").select(
        "content_id", "ac", "r", F.try_divide("ac", "r").alias("rate_uc"), F.try_divide("u_ac", "u_r").alias("rate_u"))
    return j.groupBy("content_id").agg(
        F.sum("r").alias("r_cumcnt"), (F.sum("ac") / F.sum("r")).alias("ac_cumsum_pct"),
        # Pearson correlation; null when either side has no variance (ANSI corr would raise there)
        F.try_divide(F.covar_pop("rate_uc", "rate_u"),
                     F.stddev_pop("rate_uc") * F.stddev_pop("rate_u")).alias("corr"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float]:
    """Linear-interpolation quantiles (as pandas / R-7) without gathering the column anywhere.

    Values are counted per distinct value (partial aggregation), positions come from running totals over
    ranges, and only the <= 2 * len(probs) rows at the needed positions reach the driver."""
    v = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_x"))
    n = v.count()
    if n == 0:
        return []
    pos = sorted({p for q in probs for p in (math.floor((n - 1) * q), min(math.floor((n - 1) * q) + 1, n - 1))})
    counts = v.groupBy("_x").agg(F.count("*").alias("_c"))
    hit = running_totals(counts, ["_x"], {"_b": F.col("_c")}).where(
        F.exists(F.array(*[F.lit(p) for p in pos]), lambda p: (F.col("_b") <= p) & (p < F.col("_b") + F.col("_c"))))
    rows = sorted((r["_b"], r["_c"], r["_x"]) for r in hit.collect())

    def at(k):
        for b, c, x in rows:
            if b <= k < b + c:
                return x
        raise ValueError(k)
    out = []
    for q in probs:
        h = (n - 1) * q
        lo = math.floor(h)
        hi = min(lo + 1, n - 1)
        out.append(at(lo) + (h - lo) * (at(hi) - at(lo)))
    return out


def quantile_histogram(df: DataFrame, col: str, q: int = 10) -> DataFrame:
    """Counts per quantile bin (lower, upper]; duplicate edges dropped; the first bin includes its lower edge."""
    edges = sorted(set(exact_quantiles(df, col, [i / q for i in range(q + 1)])))
    x = F.col(col).cast("double")
    b = F.lit(None).cast("int")
    for i in range(len(edges) - 1, 0, -1):
        b = F.when(x <= edges[i], F.lit(i - 1)).otherwise(b)
    lower = F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("bin") + 1)
    upper = F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("bin") + 2)
    return (df.where(F.col(col).isNotNull()).select(b.alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
              .select("bin", lower.alias("lower"), upper.alias("upper"), "n"))


def split_counts(df: DataFrame, col: str = "fold") -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def vocabulary(df: DataFrame, col: str, name: str = "code") -> DataFrame:
    """Sorted distinct values with 0-based codes; null is none."""
    return positions(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], name)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC AUC (ties count one half): sum over scores of positives x (negatives below + half the
    negatives at that score), over positives x negatives. Counts are per distinct score; the negatives
    below come from running totals over ranges of the score. Rows without a score are left out."""
    s = df.select(F.col(score).cast("double").alias("_s"), F.col(label).alias("_y")).where("_s is not null")
    g = s.groupBy("_s").agg(F.sum(F.when(F.col("_y") == 1, 1).otherwise(0)).alias("_p"),
                            F.sum(F.when(F.col("_y") == 1, 0).otherwise(1)).alias("_n"))
    j = running_totals(g, ["_s"], {"_nb": F.col("_n")})
    tot = j.agg(F.sum(F.col("_p") * (F.col("_nb") + F.col("_n") * 0.5)).alias("_u"),
                F.sum("_p").alias("n_pos"), F.sum("_n").alias("n_neg"))
    return tot.select(F.try_divide(F.col("_u"), F.col("n_pos") * F.col("n_neg")).alias("auc"), "n_pos", "n_neg")


def logloss_error(df: DataFrame, label: str, prob: str, by: str | list[str] = "split", eps: float = 1e-15) -> DataFrame:
    """Log loss (probabilities clipped to [eps, 1 - eps]) and 0.5-threshold error, one row per ``by``."""
    by = [by] if isinstance(by, str) else by
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    ll = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    err = ((F.col(prob) > 0.5).cast("double") != y).cast("double")
    return df.groupBy(*by).agg(F.avg(ll).alias("logloss"), F.avg(err).alias("error"), F.count("*").alias("n"))


def metrics_long(wide: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """(keys, metric, result): a row for each metric, as evaluation logs hold them. Missing results give no row."""
    results = wide.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics])
    return results.unpivot(keys, metrics, "metric", "result").where("result is not null")


def metrics_wide(long: DataFrame, keys: list[str], metrics: list[str], name: str = "metric", value: str = "result") -> DataFrame:
    """(keys, a column for each of ``metrics``): the last form of an evaluation log. The metrics are given, so no pass
    over the rows looks for them; a metric that a key lacks is null. Of repeated results the largest stays."""
    return long.groupBy(*keys).pivot(name, metrics).agg(F.max(value))


def cumulative_share(df: DataFrame, value: str, key: str) -> DataFrame:
    """Share of the total covered by the rows sorted by ``value`` descending (ties by key); null where the total is 0."""
    total = df.agg(F.sum(value)).first()[0]
    before = running_totals(df.select(key, value), [F.col(value).desc(), F.col(key)], {"_before": F.col(value)})
    return before.select(key, value, F.try_divide(F.col("_before") + F.col(value), F.lit(total)).alias("cum_share"))


def canonical_sort(df: DataFrame) -> DataFrame:
    return df.orderBy("user_id", TC, "row_id")


def top_k(df: DataFrame, by: str, k: int, key: str, volume: str | None = None,
          min_volume: float | None = None) -> DataFrame:
    """Top ``k`` rows by ``by`` (descending, ties by key) after an optional volume filter."""
    if volume is not None and min_volume is not None:
        df = df.where(F.col(volume) > min_volume)
    return df.where(F.col(by).isNotNull() & ~F.isnan(F.col(by))).orderBy(F.col(by).desc(), F.col(key)).limit(k)


def limit_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
