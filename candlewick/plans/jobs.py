"""Composite jobs (job_*): each is a lazy DataFrame chain; writing happens
only at the end, through ``candlewick.sinks``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewick.functions.scalars import truncate_numeric
from candlewick.operators.asof import conclusion
from candlewick.operators.clean import clean_audit, clean_ohlcv
from candlewick.operators.indicators import indicators_and_patterns
from candlewick.operators.resample import resample
from candlewick.operators.screen import screen
from candlewick.operators.series import outside_stage
from candlewick.operators.upsert import upsert_company_list, upsert_snapshot
from candlewick.params import DEFAULT_INDICATORS, DEFAULT_PATTERNS, PERIODS, IndicatorParams, PatternParams
from candlewick.schemas import GOLD_BASE, GOLD_INDICATORS, GOLD_PATTERNS
from candlewick.sources.records import clean_fundamentals, fundamentals_rows, parse_company_json
from candlewick.sources.tables import read_modified_between, with_ticker_from_path


def analyse(bars: DataFrame, ip: IndicatorParams = DEFAULT_INDICATORS,
            pp: PatternParams = DEFAULT_PATTERNS, columns=None) -> DataFrame:
    """in_all + pt_mark_all over (ticker, period) series, untruncated; all
    columns, or those chosen."""
    return indicators_and_patterns(bars, ip, pp, columns)


def job_silver(bronze: DataFrame) -> DataFrame:
    """job_silver: bronze -> clean silver rows."""
    return clean_ohlcv(bronze)


def job_silver_of_day(spark: SparkSession, root: str, start: str, end: str | None = None, *,
                      schema: StructType) -> tuple[DataFrame, DataFrame]:
    """job_silver over the bronze files modified in [start, end): the silver
    rows and the audit per input ticker.  A day without files gives empty frames."""
    bronze = with_ticker_from_path(read_modified_between(spark, root, start, end, schema=schema))
    return clean_ohlcv(bronze), clean_audit(bronze)


def job_company_list(docs: DataFrame, old: DataFrame | None, batch_time) -> DataFrame:
    """job_company_list: company JSON documents -> the merged company list."""
    batch = parse_company_json(docs, batch_time).select("cik", "ticker", "title")
    return upsert_company_list(old, batch, batch_time)


def job_fundamentals(info: DataFrame, daily: DataFrame | None, old: DataFrame | None) -> DataFrame:
    """job_fundamentals: attribute JSON and daily prices -> clean rows of all 27
    columns, merged into the snapshot table."""
    return upsert_snapshot(old, clean_fundamentals(fundamentals_rows(info, daily=daily)))


def job_screen(fundamentals: DataFrame, old: DataFrame | None) -> DataFrame:
    """job_screen: the latest batch of the fundamentals table through the screen,
    merged into the screen table."""
    latest = fundamentals.agg(F.max("created_at").alias("d")).scalar()
    return upsert_snapshot(old, screen(fundamentals.filter(F.col("created_at") == latest)))


def staging_view(gold: DataFrame, period: str, as_of: str | None = None, lookback_years: int = 2) -> DataFrame:
    """flt_period / flt_daily_lookback: ticker, Date and the three signals of one
    period; on a table partitioned by period only that partition is read."""
    rows = gold.filter(F.col("period") == period)
    if as_of is not None:
        rows = rows.filter(F.col("Date") >= F.add_months(F.to_date(F.lit(as_of)), -12 * lookback_years))
    return rows.select("ticker", "Date", "Side_1", "Side_2", "Side_3")


def job_gold(silver: DataFrame, periods=PERIODS, gap_policy: str = "emit",
             ip: IndicatorParams = DEFAULT_INDICATORS, pp: PatternParams = DEFAULT_PATTERNS,
             truncate: bool = True, columns=None) -> DataFrame:
    """job_gold: silver daily -> every period's bars with 24 indicator and 24
    pattern/signal columns; numbers truncated to 2 decimals at the end.  With
    ``columns``: ticker, period, Date and those, and no others are computed."""
    bars = resample(silver, periods, gap_policy)
    if columns is None:
        out = outside_stage(analyse(bars, ip, pp).select(*[f"`{c}`" for c in GOLD_BASE + GOLD_INDICATORS + GOLD_PATTERNS]))
    else:
        out = analyse(bars, ip, pp, tuple(columns))
    return truncate_numeric(out, 2) if truncate else out


def job_conclusion(gold: DataFrame, as_of: str | None = None, allow_future: bool = True) -> DataFrame:
    """job_conclusion: gold -> multi-period entry-conclusion mart."""
    return conclusion(gold, as_of=as_of, allow_future=allow_future)


def job_gold_per_period(silver: DataFrame, params: dict, gap_policy: str = "emit",
                        truncate: bool = True) -> DataFrame:
    """job_gold with indicator / pattern parameters per period.

    ``params`` maps a period to ``(IndicatorParams, PatternParams)``; periods
    sharing the same parameters are computed together, groups are unioned.
    Periods are independent series, so the result equals one job_gold run
    per period.  The gold schema names EMA13/EMA26/SMA50/SMA200 columns, so
    overrides are for the other settings (windows, deviations, thresholds,
    extrema distance and prominence, ...)."""
    groups: dict = {}
    for period in PERIODS:
        if period in params:
            groups.setdefault(params[period], []).append(period)
    parts = [job_gold(silver, tuple(ps), gap_policy, ip, pp, truncate) for (ip, pp), ps in groups.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
