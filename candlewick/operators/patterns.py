"""Pattern and signal operators that are projections of the series
columns (EMA trend, pt_side_1/2/3).  Previous-row patterns (pt_ema_cross,
pt_ema_slope, pt_fi13_spike) are in ``recursions``, extrema, swings, divergence
and power pairs in ``swings``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.params import DEFAULT_PATTERNS, PatternParams


def trend_of(slope: Column) -> Column:
    return F.when(slope > 0, "Up").when(slope < 0, "Down")


def signal_columns(pp: PatternParams = DEFAULT_PATTERNS) -> dict[str, tuple[tuple[str, ...], Column]]:
    """The three Long/Short signals: the columns each reads and its expression."""
    n1, n2 = (f"{ind}_trend" for ind, _ in pp.divergence[:2])
    ema_trend = f"EMA{pp.ema_short}_trend"
    t1, t2, up = F.col(n1), F.col(n2), F.col(ema_trend)
    return {
        "Side_1": ((n1, n2), F.when((t1 == "Up") & (t2 == "Up"), "Long").when((t1 == "Down") & (t2 == "Down"), "Short")),
        "Side_2": ((ema_trend, "FI_2_Trough", "FI_2_Peak"),
                   F.when((up == "Up") & F.col("FI_2_Trough"), "Long").when((up == "Down") & F.col("FI_2_Peak"), "Short")),
        "Side_3": (("Bear_Power_trend", "Lower_Trough", "Bull_Power_trend", "Higher_Peak"),
                   F.when((F.col("Bear_Power_trend") == "Up") & F.col("Lower_Trough"), "Long")
                   .when((F.col("Bull_Power_trend") == "Down") & F.col("Higher_Peak"), "Short"))}


def with_patterns(df: DataFrame, pp: PatternParams = DEFAULT_PATTERNS) -> DataFrame:
    """EMA trend and the three Long/Short signals from the series columns."""
    slope = F.col(f"EMA{pp.ema_short}_slope")
    out = df.select("*", trend_of(slope).alias(f"EMA{pp.ema_short}_trend"))
    return out.select("*", *[e.alias(c) for c, (_, e) in signal_columns(pp).items()])
