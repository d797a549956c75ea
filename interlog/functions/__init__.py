from interlog.functions.expr import (  # noqa: F401
    clip_count, log_clip, log_odds, ratio_or_neg, round_long, safe_avg, safe_pct, time_units,
)
