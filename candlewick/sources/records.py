"""Record-level sources: company list JSON, fundamentals attribute JSON and
trade envelopes (src_company_json, src_fundamentals_rows, src_trades_envelope)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.window import Window

from candlewick.functions.scalars import (inf_to_null, nan_to_null, none_text_to_null, safe_ratio, to_numeric,
                                          truncate)
from candlewick.schemas import COMPANY_JSON, FUNDAMENTAL_NUMERIC, TRADE_ENVELOPE

# --- fixed values: vendor attribute key of each fundamentals column -----------
VENDOR_KEYS = {
    "market_cap": "marketCap",
    "trailing_pe": "trailingPE",
    "forward_pe": "forwardPE",
    "price_to_sales": "priceToSalesTrailing12Months",
    "current_ratio": "currentRatio",
    "debt_to_equity": "debtToEquity",
    "roe": "returnOnEquity",
    "roa_ttm": "returnOnAssets",
    "eps_ttm": "epsTrailingTwelveMonths",
    "eps_growth": "earningsGrowth",
    "eps_forward": "forwardEps",
    "net_income": "netIncomeToCommon",
    "operating_cash_flow": "operatingCashflow",
    "revenue_growth": "revenueGrowth",
    "revenue": "totalRevenue",
    "current_price": "currentPrice",
    "low_52w": "fiftyTwoWeekLow",
    "high_52w": "fiftyTwoWeekHigh",
    "change_52w": "52WeekChange",
    "avg_daily_volume": "averageDailyVolume3Month",
    "institutional_share": "heldPercentInstitutions",
    "analyst_mean": "recommendationMean",
    "analyst_key": "recommendationKey",
}
# -----------------------------------------------------------------------------


def parse_company_json(docs: DataFrame, batch_time, value: str = "value") -> DataFrame:
    """src_company_json: JSON map-of-objects documents -> one row per company,
    stamped with the batch time and active."""
    parsed = docs.select(F.explode(F.map_values(F.from_json(F.col(value), COMPANY_JSON))).alias("r"))
    ts = batch_time if isinstance(batch_time, Column) else F.to_timestamp(F.lit(batch_time))
    return parsed.select(F.col("r.cik_str").alias("cik"), F.col("r.ticker").alias("ticker"),
                         F.col("r.title").alias("title"), ts.alias("last_updated"), F.lit(True).alias("is_active"))


def high_ratios(daily: DataFrame) -> DataFrame:
    """ag_high_ratio: per ticker the last close and its highs: all-time and over
    the 365 days up to the last date.

    One pass: the last date is a window maximum over the ticker, then one
    aggregation on the same partitioning."""
    dated = daily.filter(F.col("Close").isNotNull()).select(
        "ticker", "Date", "Close", F.max("Date").over(Window.partitionBy("ticker")).alias("_last"))
    recent = F.when(F.col("Date") > F.date_sub("_last", 365), F.col("Close"))
    return dated.groupBy("ticker").agg(F.max_by("Close", "Date").alias("last_close"), F.max("Close").alias("all_time_high"),
                                       F.max(recent).alias("high_52w_close"))


def with_high_ratios(rows: DataFrame, highs: DataFrame) -> DataFrame:
    """Set ``current_price`` (falling back to the last close),
    ``all_time_high_ratio`` and ``high_52w_ratio`` from ``high_ratios``; a ratio
    is NULL without a price or with a zero or missing high."""
    j = rows.join(highs, "ticker", "left")
    price = F.coalesce(to_numeric(F.col("current_price")), F.col("last_close"))
    return (j.withColumn("all_time_high_ratio", safe_ratio(price, F.col("all_time_high")))
            .withColumn("high_52w_ratio", safe_ratio(price, F.col("high_52w_close")))
            .withColumn("current_price", price).select(*rows.columns))


def fundamentals_rows(info: DataFrame, value: str = "info", daily: DataFrame | None = None) -> DataFrame:
    """src_fundamentals_rows: (created_at, ticker, attribute JSON) -> one wide
    row of the 27 ASCII-aliased columns; a missing key gives NULL.  The two
    high ratios and the fallback of the current price come from ``daily``
    (ticker, Date, Close); without it the ratios are NULL."""
    m = F.from_json(F.col(value), T.MapType(T.StringType(), T.StringType()))
    rows = info.select("created_at", "ticker", m.alias("_m")).select(
        "created_at", "ticker", *[F.col("_m").getItem(k).alias(a) for a, k in VENDOR_KEYS.items()],
        *[F.lit(None).cast("double").alias(c) for c in ("all_time_high_ratio", "high_52w_ratio")])
    return rows if daily is None else with_high_ratios(rows, high_ratios(daily))


def clean_fundamentals(rows: DataFrame, digits: int = 3) -> DataFrame:
    """job_fundamentals coercions: text -> number (unparsable NULL), +-inf and
    NaN -> NULL, truncation to 3 decimals; 'None'/'none' texts -> NULL."""
    out = [F.to_date("created_at").alias("created_at"), F.col("ticker")]
    for c in rows.columns:
        if c in ("created_at", "ticker"):
            continue
        if c in FUNDAMENTAL_NUMERIC:
            out.append(truncate(nan_to_null(inf_to_null(to_numeric(F.col(c)))), digits).alias(c))
        else:
            out.append(none_text_to_null(F.col(c)).alias(c))
    return rows.select(*out)


def parse_trade_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """src_trades_envelope: '{"type": "trade", "data": [...]}' messages -> one
    row per trade with its position ``pos`` in the message (the order of
    arrival of equal times); other types and malformed JSON are dropped."""
    env = F.from_json(F.col(value), TRADE_ENVELOPE)
    return (messages.select(env.alias("e")).filter(F.col("e.type") == "trade")
            .select(F.posexplode("e.data").alias("pos", "d")).select("d.*", "pos"))


def normalise_prices(raw: DataFrame, batch_time) -> DataFrame:
    """src_price_normalise: vendor daily history (Date as a timestamp) ->
    bronze rows with Date truncated to DATE and the batch time stamped."""
    ts = batch_time if isinstance(batch_time, Column) else F.to_timestamp(F.lit(batch_time))
    rest = [c for c in raw.columns if c not in ("ticker", "Date", "created_at")]
    return raw.select("ticker", F.to_date("Date").alias("Date"), *[F.col(f"`{c}`") for c in rest],
                      ts.alias("created_at"))


def fetch_status(requested: DataFrame, rows: DataFrame) -> DataFrame:
    """Per requested ticker: rows received and status; an empty history is a
    failed item (partial counts per partition before the shuffle)."""
    counts = rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"))
    return (requested.select("ticker").distinct().join(counts, "ticker", "left")
            .select("ticker", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
            .withColumn("status", F.when(F.col("n_rows") > 0, "success").otherwise("failed")))
