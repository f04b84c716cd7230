"""Fixed schemas and column groups of the price, company, fundamentals,
screen and trade tables."""

from __future__ import annotations

from pyspark.sql import types as T

SILVER_PRICES = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("Date", T.DateType(), False),
    T.StructField("Open", T.DoubleType(), False),
    T.StructField("High", T.DoubleType(), False),
    T.StructField("Low", T.DoubleType(), False),
    T.StructField("Close", T.DoubleType(), False),
    T.StructField("Adj Close", T.DoubleType(), False),
    T.StructField("Volume", T.LongType(), False),
    T.StructField("Dividends", T.DoubleType(), True),
    T.StructField("Stock Splits", T.DoubleType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

OHLCV = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]

# --- fixed values: gold column groups, in table order -------------------------
GOLD_BASE = ["Date", "Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends",
             "Stock Splits", "created_at", "ticker", "period"]
GOLD_INDICATORS = [
    "ADX", "MACD", "MACD_signal", "MACD_hist", "PLUS_DI", "MINUS_DI", "STOCH_slowk", "STOCH_slowd",
    "WILLR", "upperband", "middleband", "lowerband", "upper_1_7", "lower_1_7", "EMA13", "EMA26",
    "SMA50", "SMA200", "ATR", "FI", "FI_2", "FI_13", "Bull_Power", "Bear_Power",
]
GOLD_PATTERNS = [
    "EMA_bullbear", "EMA13_slope", "EMA13_trend", "price_Peak", "price_Trough", "Higher_Peak",
    "Lower_Trough", "price_search", "FI_2_Peak", "FI_2_Trough", "FI_13_diff", "FI_13_Peak",
    "FI_13_Trough", "MACD_hist_trend", "FI_13_trend", "MACD_hist_trend_pair", "FI_13_trend_pair",
    "Bull_Power_trend", "Bear_Power_trend", "Bull_Power_trend_pair", "Bear_Power_trend_pair",
    "Side_1", "Side_2", "Side_3",
]
GOLD_KEY = ["Date", "ticker", "period"]
# ------------------------------------------------------------------------------

# Company list JSON: {"0": {"cik_str": 1045810, "ticker": "NVDA", "title": "NVIDIA CORP"}, ...}
COMPANY_JSON = T.MapType(T.StringType(), T.StructType([
    T.StructField("cik_str", T.LongType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("title", T.StringType()),
]))

# --- fixed values: fundamentals columns, reference name -> ASCII alias -------
FUNDAMENTAL_COLUMNS = [
    ("市值", "market_cap"),
    ("本益比(trailingP/E)", "trailing_pe"),
    ("預期本益比(forwardP/E)", "forward_pe"),
    ("市銷率P/S", "price_to_sales"),
    ("流動比率", "current_ratio"),
    ("產權比率/負債權益比", "debt_to_equity"),
    ("ROE", "roe"),
    ("ROA(TTM)", "roa_ttm"),
    ("EPS(TTM)", "eps_ttm"),
    ("EPS增長率", "eps_growth"),
    ("EPS預期", "eps_forward"),
    ("淨利潤", "net_income"),
    ("經營現金流", "operating_cash_flow"),
    ("年度收入增長", "revenue_growth"),
    ("年銷售收入", "revenue"),
    ("目前價格", "current_price"),
    ("52週價格最低/priceLow52W", "low_52w"),
    ("52週價格最高/priceHigh52W", "high_52w"),
    ("52週價格變化/priceChange52W", "change_52w"),
    ("歷史新高率", "all_time_high_ratio"),
    ("52週新高率", "high_52w_ratio"),
    ("上一季日均成交/avgDailyVolumeLastQuarter", "avg_daily_volume"),
    ("機構持股比例", "institutional_share"),
    ("分析師平均評級/analystRatingMean", "analyst_mean"),
    ("分析師建議/analystRatingKey", "analyst_key"),
]
# -----------------------------------------------------------------------------
FUNDAMENTAL_NUMERIC = [a for _, a in FUNDAMENTAL_COLUMNS if a != "analyst_key"]

TRADE = T.StructType([
    T.StructField("s", T.StringType()),
    T.StructField("p", T.DoubleType()),
    T.StructField("t", T.LongType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("c", T.ArrayType(T.StringType())),
])

TRADE_ENVELOPE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("data", T.ArrayType(TRADE)),
])

HOLIDAYS = T.StructType([
    T.StructField("atDate", T.StringType(), False),
    T.StructField("tradingHour", T.StringType(), True),
])


def fundamentals_to_ascii(df):
    """Rename reference-named fundamentals columns to their ASCII aliases."""
    mapping = dict(FUNDAMENTAL_COLUMNS)
    for ref, alias in mapping.items():
        if ref in df.columns:
            df = df.withColumnRenamed(ref, alias)
    return df


def fundamentals_to_reference(df):
    """Rename ASCII aliases back to the reference column names (for export)."""
    for ref, alias in FUNDAMENTAL_COLUMNS:
        if alias in df.columns:
            df = df.withColumnRenamed(alias, ref)
    return df
