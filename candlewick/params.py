"""Parameters of the indicator and pattern operators.

The defaults are fixed values that must equal the reference pipeline's
configuration for identical results; they are stated together here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must match the reference configuration) -----------------
# Periods, in pipeline order.  "D" is the daily series itself.
PERIODS = ("D", "W", "2W", "3W", "ME", "2ME", "3ME")
# Forward tolerance (days) of the multi-period as-of lookup, per period.
ASOF_OFFSET_DAYS = {"W": 8, "2W": 15, "3W": 22, "ME": 32, "2ME": 63, "3ME": 93}
# Column suffix used by the conclusion mart for each period.
MART_SUFFIX = {"D": "D", "W": "W", "2W": "2W", "3W": "3W", "ME": "ME", "2ME": "2M", "3ME": "3M"}
# ---------------------------------------------------------------------------


def period_step(period: str) -> tuple[str, int]:
    """('week' | 'month' | 'day', n) for a period code such as '2W' or '3ME'."""
    if period == "D":
        return "day", 1
    if period.endswith("ME"):
        n = period[:-2]
        return "month", int(n) if n else 1
    if period.endswith("W"):
        n = period[:-1]
        return "week", int(n) if n else 1
    raise ValueError(f"unsupported period {period!r}")


@dataclass(frozen=True)
class IndicatorParams:
    # --- fixed values (reference configuration) ---
    adx_period: int = 14
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9
    di_period: int = 13
    stoch_fastk: int = 5
    stoch_slowk: int = 3
    stoch_slowd: int = 3
    willr_period: int = 7
    bb_period: int = 13
    bb_dev: float = 2.7
    sd17_period: int = 13
    sd17_dev: float = 1.7
    ema_periods: tuple[int, ...] = (13, 26)
    sma_periods: tuple[int, ...] = (50, 200)
    atr_period: int = 14
    fi_periods: tuple[int, ...] = (2, 13)
    power_period: int = 13


@dataclass(frozen=True)
class PatternParams:
    # --- fixed values (reference configuration) ---
    ema_short: int = 13
    ema_long: int = 26
    price_column: str = "Close"
    price_distance: int = 5
    fi2_distance: int = 5
    price_prominence: float = 1.0
    fi2_prominence: float = 5.0
    search_quantity: int = 2
    # (indicator, threshold in percent) pairs of the divergence search.
    divergence: tuple[tuple[str, float], ...] = field(
        default=(("MACD_hist", 30.0), ("FI_13", 70.0)))
    fi13_spike_pct: float = 70.0


DEFAULT_INDICATORS = IndicatorParams()
DEFAULT_PATTERNS = PatternParams()
