"""Scalar expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: "undefined" sentinel used for ratios and missing history.
UNDEFINED = -1


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_long(x) -> Column:
    """Float to integer the way the warehouse casts: round half away from zero."""
    return F.round(_c(x)).cast("long")


def safe_pct(num, den) -> Column:
    """round(num * 100 / den) as long; -1 when the ratio is undefined."""
    return F.coalesce(round_long(F.try_divide(_c(num) * 100, _c(den))), F.lit(UNDEFINED).cast("long"))


def safe_avg(total, count) -> Column:
    """round(total / count) as long; -1 when undefined."""
    return F.coalesce(round_long(F.try_divide(_c(total), _c(count))), F.lit(UNDEFINED).cast("long"))


def clip_count(x, upper: int = 300) -> Column:
    return F.least(_c(x), F.lit(upper))


def log_clip(x) -> Column:
    """ln(max(x, 1))."""
    return F.log(F.greatest(_c(x).cast("double"), F.lit(1.0)))


def log_odds(pct) -> Column:
    """ln(p) - ln(1 - p) with p = clip(pct, 1, 99) / 100."""
    p = F.least(F.greatest(_c(pct).cast("double"), F.lit(1.0)), F.lit(99.0)) / 100
    return F.log(p) - F.log(1 - p)


def ratio_or_neg(num, den) -> Column:
    """num / den when positive, else -1 (division by zero is undefined, hence -1)."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.when(r > 0, r).otherwise(F.lit(float(UNDEFINED)))


def time_units(ts_ms, elapsed_ms) -> tuple[Column, Column]:
    """(minutes, seconds) truncated towards zero."""
    return ((_c(ts_ms) / 60000).cast("long"), (_c(elapsed_ms) / 1000).cast("long"))
