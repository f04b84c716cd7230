"""flt_screen / ag_screen_summary: the ordered fundamentals rule screen."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: tiers of the screen, the first that holds wins ------------
# column, comparison, bound
TIERS = (
    ("HighGrowth", (
        ("market_cap", ">=", 1e9), ("price_to_sales", ">=", 2), ("price_to_sales", "<=", 10), ("roe", ">", 0.05),
        ("roe", "<=", 0.25), ("current_ratio", ">=", 2.5), ("debt_to_equity", "<=", 10), ("roa_ttm", ">", 0),
        ("eps_ttm", ">", 0), ("operating_cash_flow", ">", 0), ("institutional_share", ">=", 0.4),
        ("institutional_share", "<", 0.95), ("analyst_mean", "<=", 3))),
    ("SteadyGrowth", (
        ("market_cap", ">=", 4e8), ("price_to_sales", ">=", 2), ("price_to_sales", "<=", 7), ("roe", ">", 0.15),
        ("roe", "<=", 0.25), ("current_ratio", ">=", 2), ("debt_to_equity", "<=", 10), ("roa_ttm", ">", 0),
        ("eps_ttm", ">", 0), ("operating_cash_flow", ">", 0), ("current_price", ">=", 15), ("revenue", ">=", 5e7),
        ("institutional_share", ">=", 0.4), ("institutional_share", "<", 0.95), ("analyst_mean", "<=", 2))),
    ("Distressed", (
        ("price_to_sales", "<=", 1.5), ("roe", ">", 0.15), ("roe", "<=", 0.25), ("current_ratio", ">=", 1.1),
        ("debt_to_equity", "<=", 50), ("roa_ttm", ">", 0), ("eps_ttm", ">", 0), ("current_price", ">", 0),
        ("revenue", ">=", 5e7), ("avg_daily_volume", ">=", 50000), ("institutional_share", ">=", 0.4),
        ("institutional_share", "<", 0.95), ("analyst_mean", ">=", 3))),
    ("Super", (
        ("change_52w", ">=", 3), ("high_52w_ratio", ">=", 0.9), ("current_price", ">=", 15),
        ("avg_daily_volume", ">=", 50000), ("institutional_share", ">=", 0.4), ("institutional_share", "<", 0.95),
        ("analyst_mean", "<=", 2), ("analyst_key", "known", None))),
)
MAGNIFICENT_8 = ("AAPL", "MSFT", "GOOGL", "AMZN", "NVDA", "META", "TSLA", "NFLX")
ETF_1 = ("QQQ", "SPY", "DIA")
# -----------------------------------------------------------------------------

_COMPARE = {">=": Column.__ge__, "<=": Column.__le__, ">": Column.__gt__, "<": Column.__lt__,
            "known": lambda column, _: column.isNotNull()}


def screen_tier() -> Column:
    """Ordered rule classifier; the first satisfied tier wins, a NULL operand
    fails its tier (SQL three-valued logic), no match gives NULL."""
    listed = F.when(F.col("ticker").isin(*MAGNIFICENT_8), "Magnificent_8").when(F.col("ticker").isin(*ETF_1), "ETF_1")
    for tier, rules in reversed(TIERS):
        holds = reduce(and_, (_COMPARE[op](F.col(column), bound) for column, op, bound in rules))
        listed = F.when(holds, tier).otherwise(listed)
    return listed


def screen(fundamentals: DataFrame) -> DataFrame:
    """flt_screen: (created_at, ticker, is_selected) of the matching rows."""
    return (fundamentals.select("created_at", "ticker", screen_tier().alias("is_selected"))
            .filter(F.col("is_selected").isNotNull()))


def screen_summary(screened: DataFrame) -> DataFrame:
    """ag_screen_summary: rows per batch date and tier."""
    return screened.groupBy("created_at", "is_selected").agg(F.count(F.lit(1)).alias("n_rows"))
