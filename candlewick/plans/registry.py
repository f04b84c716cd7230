"""Registered queries: one Spark callable per operator of the inventory,
with its independent DuckDB oracle where SQL can express it.

Every query reads the driver tables through the fixture views of
``candlewick.sources.fixtures`` over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.asof import asof_periods
from candlewick.operators.clean import clean_audit, clean_ohlcv
from candlewick.operators.indicators import by_ticker, indicators_and_patterns
from candlewick.operators.resample import resample
from candlewick.params import ASOF_OFFSET_DAYS, PERIODS
from candlewick.plans import oracles as O
from candlewick.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def rnd(col: str, digits: int = 6):
    """Round half up with plain double arithmetic (same result as the oracle)."""
    scale = float(10 ** digits)
    return (F.floor(F.col(f"`{col}`") * scale + 0.5) / scale).alias(col)


# ----------------------------------------------------------------------------
# Cleaning
# ----------------------------------------------------------------------------

@register("flt_clean_ohlcv", f"""
SELECT ticker, "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Stock Splits"
FROM ({O.BRONZE}) b
WHERE "Open" IS NOT NULL AND "High" IS NOT NULL AND "Low" IS NOT NULL AND "Close" IS NOT NULL
  AND "Adj Close" IS NOT NULL AND "Volume" IS NOT NULL""")
def q_clean(spark, sf):
    return clean_ohlcv(fx.bronze(spark, sf)).drop("created_at")


@register("ag_clean_audit", f"""
SELECT ticker, count(*) AS raw_rows, CAST(count_if(valid) AS BIGINT) AS kept_rows,
       count(*) - CAST(count_if(valid) AS BIGINT) AS dropped_rows,
       'success' AS status
FROM (SELECT ticker, ("Close" IS NOT NULL AND "Volume" IS NOT NULL AND "Open" IS NOT NULL AND "High" IS NOT NULL
                      AND "Low" IS NOT NULL AND "Adj Close" IS NOT NULL) AS valid FROM ({O.BRONZE}) b) x
GROUP BY ticker""")
def q_audit(spark, sf):
    return clean_audit(fx.bronze(spark, sf))


# ----------------------------------------------------------------------------
# Resampling
# ----------------------------------------------------------------------------

def _wide_bars(spark, sf):
    return fx.bars_wide(spark, sf)


def _resample_query(period):
    def q(spark, sf):
        bars = resample(_wide_bars(spark, sf), periods=(period,), gap_policy="drop")
        return bars.select("ticker", "period", "Date", "Open", "High", "Low", "Close", "`Adj Close`", "Volume")
    return q


for _p in PERIODS[1:]:
    register(f"ag_resample_{_p.lower()}", O.resample_sql(_p))(_resample_query(_p))


@register("ag_resample_gaps", f"""
WITH b AS ({O.resample_sql('W')}),
span AS (SELECT ticker, min("Date") AS lo, max("Date") AS hi FROM b GROUP BY ticker),
grid AS (SELECT ticker, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS "Date" FROM span)
SELECT g.ticker, g."Date", b."Close", COALESCE(b."Volume", 0) AS "Volume"
FROM grid g LEFT JOIN b USING (ticker, "Date")""")
def q_resample_gaps(spark, sf):
    bars = resample(_wide_bars(spark, sf), periods=("W",), gap_policy="emit")
    return bars.select("ticker", "Date", "Close", "Volume")


# ----------------------------------------------------------------------------
# Indicators on the daily series of every supplier ticker
# ----------------------------------------------------------------------------

def _analysed_daily(spark, sf, *columns):
    bars = _wide_bars(spark, sf).withColumn("period", F.lit("D"))
    return indicators_and_patterns(by_ticker(bars), columns=columns)


def _ind_query(cols, digits=6):
    def q(spark, sf):
        return _analysed_daily(spark, sf, *cols).select("ticker", "Date", *[rnd(c, digits) for c in cols])
    return q


_IND = O.indicators_sql()


def _ind_sql(cols, digits=6):
    return f"SELECT ticker, \"Date\", {', '.join(O.r(c, digits) for c in cols)} FROM ({_IND}) i"


_WINDOW_SQL = f"""
SELECT ticker, "Date", "Close", "High", "Low", rn,
       CASE WHEN count("Close") OVER w50 = 50 THEN avg("Close") OVER w50 END AS "SMA50",
       CASE WHEN count("Close") OVER w200 = 200 THEN avg("Close") OVER w200 END AS "SMA200",
       CASE WHEN count(*) OVER w5 = 5 THEN max("High") OVER w5 END AS hh5,
       CASE WHEN count(*) OVER w5 = 5 THEN min("Low") OVER w5 END AS ll5,
       CASE WHEN count(*) OVER w7 = 7 THEN max("High") OVER w7 END AS hh7,
       CASE WHEN count(*) OVER w7 = 7 THEN min("Low") OVER w7 END AS ll7
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY "Date") - 1 AS rn FROM ({O.BARS_WIDE}) b) x
WINDOW w50 AS (PARTITION BY ticker ORDER BY "Date" ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
       w200 AS (PARTITION BY ticker ORDER BY "Date" ROWS BETWEEN 199 PRECEDING AND CURRENT ROW),
       w5 AS (PARTITION BY ticker ORDER BY "Date" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
       w7 AS (PARTITION BY ticker ORDER BY "Date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

register("in_sma", f'SELECT ticker, "Date", {O.r("SMA50")}, {O.r("SMA200")} FROM ({_WINDOW_SQL}) w')(
    _ind_query(["SMA50", "SMA200"]))

register("in_willr", f"""
SELECT ticker, "Date", {O.rnd('CASE WHEN hh7 - ll7 <> 0 THEN (hh7 - "Close") / ((hh7 - ll7) / -100.0::DOUBLE) WHEN hh7 IS NOT NULL THEN 0.0 END')} AS "WILLR"
FROM ({_WINDOW_SQL}) w""")(_ind_query(["WILLR"]))

register("in_stoch", f"""
WITH k AS (SELECT ticker, "Date", rn,
                  CASE WHEN hh5 - ll5 <> 0 THEN ("Close" - ll5) / ((hh5 - ll5) / 100.0::DOUBLE)
                       WHEN hh5 IS NOT NULL THEN 0.0::DOUBLE END AS fastk FROM ({_WINDOW_SQL}) w),
s AS (SELECT *, CASE WHEN count(fastk) OVER w3 = 3 THEN avg(fastk) OVER w3 END AS slowk FROM k
      WINDOW w3 AS (PARTITION BY ticker ORDER BY "Date" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
d AS (SELECT *, CASE WHEN count(slowk) OVER w3 = 3 THEN avg(slowk) OVER w3 END AS slowd FROM s
      WINDOW w3 AS (PARTITION BY ticker ORDER BY "Date" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT ticker, "Date", {O.rnd('CASE WHEN slowd IS NOT NULL THEN slowk END')} AS "STOCH_slowk",
       {O.rnd('slowd')} AS "STOCH_slowd" FROM d""")(_ind_query(["STOCH_slowk", "STOCH_slowd"]))

register("in_force_index", _ind_sql(["FI"]))(_ind_query(["FI"]))
register("in_ema", _ind_sql(["EMA13", "EMA26"]))(_ind_query(["EMA13", "EMA26"]))
register("in_force_ema", _ind_sql(["FI_2", "FI_13"]))(_ind_query(["FI_2", "FI_13"]))
register("in_bull_bear", _ind_sql(["Bull_Power", "Bear_Power"]))(_ind_query(["Bull_Power", "Bear_Power"]))
register("in_macd", _ind_sql(["MACD", "MACD_signal", "MACD_hist"]))(_ind_query(["MACD", "MACD_signal", "MACD_hist"]))
register("in_atr", _ind_sql(["ATR"]))(_ind_query(["ATR"]))
register("in_di", _ind_sql(["PLUS_DI", "MINUS_DI"]))(_ind_query(["PLUS_DI", "MINUS_DI"]))
register("in_adx", _ind_sql(["ADX"]))(_ind_query(["ADX"]))

register("in_bbands", f"""
SELECT ticker, "Date", {O.rnd('"EMA13" + std13 * 2.7::DOUBLE', 4)} AS upperband, {O.rnd('"EMA13"', 4)} AS middleband,
       {O.rnd('"EMA13" - std13 * 2.7::DOUBLE', 4)} AS lowerband FROM ({_IND}) i""")(
    _ind_query(["upperband", "middleband", "lowerband"], 4))
register("in_bands_1_7", f"""
SELECT ticker, "Date", {O.rnd('"EMA13" + std13 * 1.7::DOUBLE', 4)} AS upper_1_7,
       {O.rnd('"EMA13" - std13 * 1.7::DOUBLE', 4)} AS lower_1_7 FROM ({_IND}) i""")(
    _ind_query(["upper_1_7", "lower_1_7"], 4))

# ----------------------------------------------------------------------------
# Window-expressible patterns
# ----------------------------------------------------------------------------

register("pt_ema_cross", f"""
SELECT ticker, "Date", CASE WHEN ema_diff > 0 AND ema_diff_prev < 0 THEN 'Long'
                            WHEN ema_diff < 0 AND ema_diff_prev > 0 THEN 'Short' END AS "EMA_bullbear"
FROM ({_IND}) i""")(lambda spark, sf: _analysed_daily(spark, sf, "EMA_bullbear").select("ticker", "Date", "EMA_bullbear"))

register("pt_ema_slope", f"""
SELECT ticker, "Date", {O.r("EMA13_slope")},
       CASE WHEN "EMA13_slope" > 0 THEN 'Up' WHEN "EMA13_slope" < 0 THEN 'Down' END AS "EMA13_trend"
FROM ({_IND}) i""")(lambda spark, sf: _analysed_daily(spark, sf, "EMA13_slope", "EMA13_trend").select(
    "ticker", "Date", rnd("EMA13_slope"), "EMA13_trend"))

register("pt_fi13_spike", f"""
SELECT ticker, "Date", {O.r("FI_13_diff")},
       COALESCE("FI_13" > 0 AND "FI_13_diff" > 0 AND (fi13_prev = 0 OR abs("FI_13_diff" / fi13_prev) * 100 >= 70), false) AS "FI_13_Peak",
       COALESCE("FI_13" < 0 AND "FI_13_diff" < 0 AND (fi13_prev = 0 OR abs("FI_13_diff" / fi13_prev) * 100 >= 70), false) AS "FI_13_Trough"
FROM ({_IND}) i""")(lambda spark, sf: _analysed_daily(spark, sf, "FI_13_diff", "FI_13_Peak", "FI_13_Trough").select(
    "ticker", "Date", rnd("FI_13_diff"), "FI_13_Peak", "FI_13_Trough"))


# ----------------------------------------------------------------------------
# As-of join
# ----------------------------------------------------------------------------

@register("jn_asof_period", O.asof_sql(("Close",)))
def q_asof(spark, sf):
    bars = resample(_wide_bars(spark, sf), gap_policy="drop")
    j = asof_periods(bars, value_cols=("Close",))
    cols = [F.col("ticker"), F.col("Date").alias("Date_D")]
    for p in ASOF_OFFSET_DAYS:
        cols += [F.col(f"_asof_{p}.Date").alias(f"Date_{p}"), F.col(f"_asof_{p}.Close").alias(f"Close_{p}")]
    return j.select(*cols)


# The remaining registrations live in a second module (imported for effect).
from candlewick.plans import registry_tables  # noqa: E402,F401
