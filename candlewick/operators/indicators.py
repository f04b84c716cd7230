"""Technical indicators (in_*) and patterns (pt_*) of bar series.

Plan of the series stage (one shuffle by ticker for everything):

1. ``with_window_indicators``: every indicator a window can express (SMA,
   STOCH, WILLR, FI, the rolling standard deviation of the bands) with Spark
   window functions partitioned by (ticker, period), ordered by Date;
2. ``series``: each series becomes one row of arrays, once;
   ``recursions``: EMA, MACD, ATR, DI, ADX and EMAs of FI by a fold over its
   bars, previous-row patterns from the states before and after a bar;
   ``swings``: extrema, swings and the searches between them by array functions,
   only if one of these is asked for;
3. ``derived_columns``: projections that combine them (bands, power, signals).

Each step makes only the columns that are asked for and what they rest on, on
the same partitioning by ticker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.operators.patterns import signal_columns, trend_of
from candlewick.operators.recursions import ema_column, recursive_columns, row_columns
from candlewick.operators.series import outside_stage, with_series
from candlewick.operators.swings import swing_columns
from candlewick.params import DEFAULT_INDICATORS, DEFAULT_PATTERNS, IndicatorParams, PatternParams

SERIES_KEY = ["ticker", "period"]


def series_window() -> Window:
    return Window.partitionBy(*SERIES_KEY).orderBy("Date")


def by_ticker(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Hash-partition by ticker into ``partitions`` tasks, by default
    ``spark.sql.shuffle.partitions``, which is sized to the data.

    The count is explicit because the stage is CPU-bound: it must not be
    coalesced into a few tasks just because its bytes are few.  Every later
    per-ticker step (period anchor window, resample aggregation, series
    folds, indicator windows, as-of window) reuses this partitioning."""
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, "ticker")


def with_window_indicators(df: DataFrame, ip: IndicatorParams = DEFAULT_INDICATORS, wanted=None, also=None) -> DataFrame:
    """The ``wanted`` (default: all) of SMA, STOCH, WILLR, FI and the internal
    band standard deviations ``_std_bb`` and ``_std_17``, per series, and the window columns ``also``.

    Each distinct window aggregate is computed once, all of them over the bars in one
    window step, and the indicators are projections of those columns: a frame's own count
    tells whether it is full and has no missing value, and the sums behind STOCH read
    the four rows before by ``lag`` in a second step."""
    if "period" not in df.columns:
        df = df.withColumn("period", F.lit("D"))

    def asked(*names):
        return wanted is None or any(n in wanted for n in names)

    stoch, willr, force = asked("STOCH_slowk", "STOCH_slowd"), asked("WILLR"), asked("FI")
    smas = [n for n in ip.sma_periods if asked(f"SMA{n}")]
    stds = [(c, n) for c, n in (("_std_bb", ip.bb_period), ("_std_17", ip.sd17_period)) if asked(c)]
    w = series_window()
    hlc = F.when(F.col("High").isNotNull() & F.col("Low").isNotNull() & F.col("Close").isNotNull(), 1)

    def frame(n):
        return w.rowsBetween(-(n - 1), 0)

    raw = dict(also or {})
    for n in sorted({n for n, on in ((ip.stoch_fastk, stoch), (ip.willr_period, willr)) if on}):
        raw |= {f"_hh{n}": F.max("High").over(frame(n)), f"_ll{n}": F.min("Low").over(frame(n)), f"_ph{n}": F.count(hlc).over(frame(n))}
    for n in sorted({*smas, *(n for _, n in stds)}):
        raw[f"_pc{n}"] = F.count("Close").over(frame(n))
    for n in sorted(set(smas)):
        raw[f"_sum{n}"] = F.sum("Close").over(frame(n))
    for n in sorted({n for _, n in stds}):
        raw[f"_sd{n}"] = F.stddev_pop("Close").over(frame(n))
    if force:
        raw |= {"_close": F.lag("Close").over(w), "_any": F.lag(F.lit(1)).over(w)}
    out = df.select("*", *[e.alias(c) for c, e in raw.items()])

    def hl(n):
        return F.when(F.col(f"_ph{n}") == n, F.col(f"_hh{n}")), F.when(F.col(f"_ph{n}") == n, F.col(f"_ll{n}"))

    made = {}
    if force:
        step = (F.col("Close") - F.col("_close")) * F.col("Volume")
        made["FI"] = F.when(F.col("_any").isNotNull(), step).when(F.col("Volume").isNotNull(), F.lit(0.0))
    if stoch:
        hh, ll = hl(ip.stoch_fastk)
        made["_fastk"] = (F.when((hh - ll) != 0, (F.col("Close") - ll) / ((hh - ll) / 100.0)).when(hh.isNotNull(), F.lit(0.0)))
    if willr:
        hh, ll = hl(ip.willr_period)
        made["WILLR"] = (F.when((hh - ll) != 0, (hh - F.col("Close")) / ((hh - ll) / -100.0)).when(hh.isNotNull(), F.lit(0.0)))
    made |= {f"SMA{n}": F.when(F.col(f"_pc{n}") == n, F.col(f"_sum{n}") / n) for n in smas}
    made |= {c: F.when(F.col(f"_pc{n}") == n, F.col(f"_sd{n}")) for c, n in stds}
    out = out.select("*", *[e.alias(c) for c, e in made.items()]).drop(*(c for c in raw if c not in (also or {})))
    if not stoch:
        return out
    before = [f"_fastk{m}" for m in range(1, ip.stoch_slowk + ip.stoch_slowd - 1)]
    out = out.select("*", *[F.lag("_fastk", m).over(w).alias(c) for m, c in enumerate(before, 1)])

    def mean(values):
        """NULL with a missing value; summed from the first row on, as a window does."""
        total = F.lit(0.0)
        for v in values:
            total = total + v
        return total / len(values)

    fastk = [F.col(c) for c in (*reversed(before), "_fastk")]
    slowk = [mean(fastk[i:i + ip.stoch_slowk]) for i in range(ip.stoch_slowd)]
    slowd = mean(slowk)
    return out.select("*", F.when(slowd.isNotNull(), slowk[-1]).alias("STOCH_slowk"), slowd.alias("STOCH_slowd")).drop("_fastk", *before)


def previous_row_columns(pp: PatternParams) -> list[str]:
    return ["rn", "EMA_bullbear", f"EMA{pp.ema_short}_slope", "FI_13_diff", "FI_13_Peak", "FI_13_Trough"]


def rests_on(ip: IndicatorParams, pp: PatternParams) -> dict[str, tuple[str, ...]]:
    """The recursive columns that previous-row and swing columns are made of."""
    short, long, power = (ema_column(n, ip) for n in (pp.ema_short, pp.ema_long, ip.power_period))
    first, last = f"FI_{ip.fi_periods[0]}", f"FI_{ip.fi_periods[-1]}"
    found = {"EMA_bullbear": (short, long), f"EMA{pp.ema_short}_slope": (short,),
             **{c: (last,) for c in ("FI_13_diff", "FI_13_Peak", "FI_13_Trough")},
             **{c: ("ATR",) for c in ("Higher_Peak", "Lower_Trough", "price_search")}, "FI_2_Peak": (first,), "FI_2_Trough": (first,)}
    for name, own in [*((n, n) for n, _ in pp.divergence), ("Bull_Power", power), ("Bear_Power", power)]:
        found |= {f"{name}_trend": ("ATR", own), f"{name}_trend_pair": ("ATR", own)}
    return found


def derived_columns(ip: IndicatorParams, pp: PatternParams) -> list[dict[str, tuple[tuple[str, ...], Column]]]:
    """Columns that are projections of others, in two layers: what each reads
    and its expression."""
    bb, sd, power = (ema_column(p, ip) for p in (ip.bb_period, ip.sd17_period, ip.power_period))
    slope = f"EMA{pp.ema_short}_slope"
    first = {
        "upperband": ((bb, "_std_bb"), F.col(bb) + F.col("_std_bb") * ip.bb_dev),
        "middleband": ((bb,), F.col(bb)),
        "lowerband": ((bb, "_std_bb"), F.col(bb) - F.col("_std_bb") * ip.bb_dev),
        "upper_1_7": ((sd, "_std_17"), F.col(sd) + F.col("_std_17") * ip.sd17_dev),
        "lower_1_7": ((sd, "_std_17"), F.col(sd) - F.col("_std_17") * ip.sd17_dev),
        "Bull_Power": ((power, "High"), F.col("High") - F.col(power)),
        "Bear_Power": ((power, "Low"), F.col("Low") - F.col(power)),
        f"EMA{pp.ema_short}_trend": ((slope,), trend_of(F.col(slope)))}
    return [first, signal_columns(pp)]


def indicators_and_patterns(bars: DataFrame, ip: IndicatorParams = DEFAULT_INDICATORS,
                            pp: PatternParams = DEFAULT_PATTERNS, columns=None) -> DataFrame:
    """in_all + pt_mark_all: windows, kernel, projections (one shuffle).

    ``columns`` chooses outputs (default: all): the result is ticker, period,
    Date and those, and only what they rest on is computed.  If a window can
    express them all, there is no Python step.  Every period of ``ip`` is
    free; EMA, SMA and FI columns are named by theirs."""
    layers = derived_columns(ip, pp)
    reads = rests_on(ip, pp)
    needed = None
    if columns is not None:
        needed = set(columns)
        for layer in reversed(layers):
            needed |= {c for name, (own, _) in layer.items() if name in needed for c in own}
        needed |= {c for name in needed for c in reads.get(name, ())}
    in_fold = {c for c in recursive_columns(ip, pp) if needed is None or c in needed}
    by_row = {c for c in previous_row_columns(pp) if needed is None or c in needed}
    in_swings = {c for c in swing_columns(pp) if needed is None or c in needed}
    if needed is not None and any(c.startswith("FI_") for c in in_fold):
        needed.add("FI")
    if "period" not in bars.columns:
        bars = bars.withColumn("period", F.lit("D"))
    if needed is not None:
        kept = {"ticker", "period", "Date", "High", "Low", "Close", "Volume", pp.price_column, *needed}
        bars = bars.select(*[F.col(f"`{c}`") for c in bars.columns if c in kept])
    per_row = row_columns(moves=bool(in_fold & {"ATR", "ADX", "PLUS_DI", "MINUS_DI"})) if in_fold or by_row or in_swings else {}
    out = with_window_indicators(bars, ip, needed, per_row)
    if per_row:
        out = with_series(out, ip, pp, in_fold, by_row, in_swings, ema_column(ip.power_period, ip))
    for layer in layers:
        found = [e.alias(c) for c, (_, e) in layer.items() if needed is None or c in needed]
        if found:
            out = outside_stage(out, *found) if needed is None else out.select("*", *found)
    if columns is not None:
        return out.select("ticker", "period", "Date", *[F.col(f"`{c}`") for c in columns])
    return out.drop("_std_bb", "_std_17", *(c for c in out.columns if c.startswith("_ema")))
