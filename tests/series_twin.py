"""Per-series recursive work: the one grouped-map function of the engine.

Everything that can be phrased as a Spark window, projection or aggregate is
done in Spark (see ``indicators.py`` / ``patterns.py``).  What is left here is
what a window cannot express:

* first-order recursions (EMA, MACD, Wilder smoothing for ATR / DI / ADX),
* local-extrema detection with the greedy minimum-distance rule and the
  prominence walk,
* the swing searches that look back to the previous two swing points
  (higher peak / lower trough, divergence, two-largest power bars).

One call handles one ``(ticker, period)`` series.  A series holds at most one
row per calendar day of its ticker, so its size is bounded by the covered
time span, not by the size of the input data.

Arithmetic follows the usual technical-analysis library conventions
(TA-Lib): sequential seed sums, ``e = (x - e) * k + e`` recursions, Wilder
``s = s - s / n + x`` sums, NaN poisoning from a missing bar onward, and a
start at the first row where all inputs are present.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

from candlewick.params import IndicatorParams, PatternParams

NAN = float("nan")


def _first_valid(*cols: list[float]) -> int:
    """First index where every input is a number (not NaN)."""
    n = len(cols[0])
    for i in range(n):
        if all(c[i] == c[i] for c in cols):
            return i
    return n


def ema(x: list[float], n: int, begin: int | None = None) -> list[float]:
    """Exponential moving average; seed = mean of the first n values."""
    size = len(x)
    out = [NAN] * size
    b = _first_valid(x) if begin is None else begin
    if size - b < n:
        return out
    return _ema_seeded(x, n, b, b + n - 1, out)


def _ema_seeded(x: list[float], n: int, seed_start: int, first_out: int,
                out: list[float]) -> list[float]:
    """EMA whose seed is the mean of x[seed_start : seed_start + n], placed at
    ``first_out`` (== seed_start + n - 1), recursing afterwards."""
    total = 0.0
    for i in range(seed_start, seed_start + n):
        total += x[i]
    e = total / n
    out[first_out] = e
    k = 2.0 / (n + 1)
    for i in range(first_out + 1, len(x)):
        e = (x[i] - e) * k + e
        out[i] = e
    return out


def macd(close: list[float], fast: int, slow: int, signal: int):
    """MACD line, signal and histogram.  Both EMAs start on the same row
    (slow - 1); the first value of all three is on row slow + signal - 2."""
    size = len(close)
    if slow < fast:
        fast, slow = slow, fast
    line = [NAN] * size
    sig = [NAN] * size
    hist = [NAN] * size
    b = _first_valid(close)
    start = b + slow - 1
    first = start + signal - 1
    if first >= size:
        return line, sig, hist
    slow_e = _ema_seeded(close, slow, b, start, [NAN] * size)
    fast_e = _ema_seeded(close, fast, start - fast + 1, start, [NAN] * size)
    raw = [NAN] * size
    for i in range(start, size):
        raw[i] = fast_e[i] - slow_e[i]
    sig_all = _ema_seeded(raw, signal, start, first, [NAN] * size)
    for i in range(first, size):
        line[i] = raw[i]
        sig[i] = sig_all[i]
        hist[i] = raw[i] - sig_all[i]
    return line, sig, hist


def _is_zero(v: float) -> bool:
    return -0.00000001 < v < 0.00000001


def _true_range(h: float, l: float, prev_c: float) -> float:
    g = h - l
    v = abs(prev_c - h)
    if v > g:
        g = v
    v = abs(prev_c - l)
    if v > g:
        g = v
    return g


def ranges(high, low, close):
    """True range and directional movements of every row (row 0: NaN / 0)."""
    size = len(close)
    tr = [NAN] * size
    pdm = [0.0] * size
    mdm = [0.0] * size
    for i in range(1, size):
        tr[i] = _true_range(high[i], low[i], close[i - 1])
        pdm[i], mdm[i] = _dm(high[i], low[i], high[i - 1], low[i - 1])
    return tr, pdm, mdm


def atr(high, low, close, n: int, pre=None) -> list[float]:
    """Average true range: the first value (row n) is the mean of the true
    ranges of rows 1..n, then ``a = (a * (n - 1) + tr) / n``."""
    size = len(close)
    out = [NAN] * size
    b = _first_valid(high, low, close)
    if size - b <= n:
        return out
    tr = (pre or ranges(high, low, close))[0]
    total = 0.0
    for i in range(b + 1, b + n + 1):
        total += tr[i]
    a = total / n
    out[b + n] = a
    for i in range(b + n + 1, size):
        a = a * (n - 1)
        a = a + tr[i]
        a = a / n
        out[i] = a
    return out


def _dm(h, l, ph, pl):
    up = h - ph
    down = pl - l
    plus = up if (up > 0 and up > down) else 0.0
    minus = down if (down > 0 and up < down) else 0.0
    return plus, minus


def directional(high, low, close, n: int, pre=None):
    """PLUS_DI and MINUS_DI: Wilder sums seeded by plain sums of rows
    1..n-1, first value on row n; 0 when the true-range sum is 0."""
    size = len(close)
    plus_out = [NAN] * size
    minus_out = [NAN] * size
    b = _first_valid(high, low, close)
    if size - b <= n:
        return plus_out, minus_out
    tr, pdm, mdm = pre or ranges(high, low, close)
    sp = sm = st = 0.0
    for i in range(b + 1, b + n):
        sp += pdm[i]
        sm += mdm[i]
        st += tr[i]
    for i in range(b + n, size):
        sp = sp - sp / n + pdm[i]
        sm = sm - sm / n + mdm[i]
        st = st - st / n + tr[i]
        if _is_zero(st):
            plus_out[i] = 0.0
            minus_out[i] = 0.0
        else:
            plus_out[i] = 100.0 * (sp / st)
            minus_out[i] = 100.0 * (sm / st)
    return plus_out, minus_out


def adx(high, low, close, n: int, pre=None) -> list[float]:
    """Average directional index; first value on row 2n-1 = mean of n DX."""
    size = len(close)
    out = [NAN] * size
    b = _first_valid(high, low, close)
    if size - b <= 2 * n - 1:
        return out
    tr, pdm, mdm = pre or ranges(high, low, close)
    sp = sm = st = 0.0
    for i in range(b + 1, b + n):
        sp += pdm[i]
        sm += mdm[i]
        st += tr[i]

    def step(i):
        nonlocal sp, sm, st
        sm = sm - sm / n + mdm[i]
        sp = sp - sp / n + pdm[i]
        st = st - st / n + tr[i]
        if _is_zero(st):
            return None
        mdi = 100.0 * (sm / st)
        pdi = 100.0 * (sp / st)
        tot = mdi + pdi
        if _is_zero(tot):
            return None
        return 100.0 * (abs(mdi - pdi) / tot)

    sum_dx = 0.0
    for i in range(b + n, b + 2 * n):
        dx = step(i)
        if dx is not None:
            sum_dx += dx
    a = sum_dx / n
    out[b + 2 * n - 1] = a
    for i in range(b + 2 * n, size):
        dx = step(i)
        if dx is not None:
            a = (a * (n - 1) + dx) / n
        out[i] = a
    return out


# --------------------------------------------------------------------------
# Local extrema (peak finding with minimum distance and prominence)
# --------------------------------------------------------------------------

def local_maxima(x: np.ndarray) -> np.ndarray:
    """Samples (or flat runs, reported at their middle) strictly above both
    neighbours.  The first and last sample never count; NaN never matches."""
    n = len(x)
    if n < 3:
        return np.empty(0, dtype=np.int64)
    change = np.ones(n, dtype=bool)
    change[1:] = x[1:] != x[:-1]
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:] - 1, n - 1)
    ok = (starts >= 1) & (ends <= n - 2)
    s, e = starts[ok], ends[ok]
    with np.errstate(invalid="ignore"):
        is_peak = (x[s - 1] < x[s]) & (x[e + 1] < x[s])
    return ((s[is_peak] + e[is_peak]) // 2).astype(np.int64)


def select_by_distance(peaks: np.ndarray, priority: np.ndarray, distance: int) -> np.ndarray:
    """Greedy: from the highest peak down (later sample first on ties), each
    kept peak removes the peaks closer than ``distance`` samples."""
    m = len(peaks)
    keep = np.ones(m, dtype=bool)
    d = math.ceil(distance)
    order = np.argsort(priority, kind="stable")
    pk = peaks.tolist()
    for r in range(m - 1, -1, -1):
        j = int(order[r])
        if not keep[j]:
            continue
        k = j - 1
        while k >= 0 and pk[j] - pk[k] < d:
            keep[k] = False
            k -= 1
        k = j + 1
        while k < m and pk[k] - pk[j] < d:
            keep[k] = False
            k += 1
    return peaks[keep]


def _lowest_until_higher(x: list[float], peaks: set[int], order) -> dict[int, float]:
    """Per peak the lowest sample met walking back along ``order`` until a higher
    one (or a missing one), by a stack of falling samples: each sample enters
    and leaves it once, however far a peak would have to look."""
    stack: list[tuple[float, float]] = []  # (sample, lowest since the sample below it)
    out = {}
    for i in order:
        v = x[i]
        if v != v:  # a missing value stops every walk
            stack.clear()
            continue
        low = v
        while stack and stack[-1][0] <= v:
            low = min(low, stack.pop()[1])
        stack.append((v, low))
        if i in peaks:
            out[i] = low
    return out


def prominences(x: list[float], peaks: list[int]) -> list[float]:
    """Height of each peak over the higher of its two bases; a base is the
    lowest sample met walking away from the peak until a higher one."""
    at = set(peaks)
    left = _lowest_until_higher(x, at, range(len(x)))
    right = _lowest_until_higher(x, at, range(len(x) - 1, -1, -1))
    return [x[p] - max(left[p], right[p]) for p in peaks]


def find_extrema(x: np.ndarray, distance: int, prominence: float) -> np.ndarray:
    peaks = local_maxima(x)
    if len(peaks) == 0:
        return peaks
    if distance and distance > 1:
        peaks = select_by_distance(peaks, x[peaks], distance)
    xl = x.tolist()
    prom = prominences(xl, peaks.tolist())
    return peaks[np.asarray(prom) >= prominence] if len(peaks) else peaks


# --------------------------------------------------------------------------
# Swing searches
# --------------------------------------------------------------------------

def swing_search(price: list[float], tolerance: list[float], points: list[int],
                 back: int, higher: bool):
    """For each swing point after the first ``back`` ones, look at the
    previous ``back`` swing points and take the earliest one that this point
    exceeds (higher=True) or undercuts (higher=False) by at most the
    tolerance.  Returns {ordinal: ordinal of that earlier point}."""
    found = {}
    for idx in range(back, len(points)):
        i = points[idx]
        tol = tolerance[i]
        for jdx in range(idx - back, idx):
            j = points[jdx]
            diff = abs(price[i] - price[j])
            better = price[i] > price[j] if higher else price[i] < price[j]
            if diff <= tol and better:
                found[i] = j
                break
    return found


def divergence(values: list[float], i: int, start: int, threshold: float, down: bool):
    """Row j in [start, i) with the largest percentage change of ``values``
    from j to i, counting only moves against the price (down: values[i] <
    values[j]) of at least ``threshold``.  Earliest j on ties; None if none."""
    vi = values[i]
    best_j = None
    best = -1.0
    for j in range(start, i):
        vj = values[j]
        if (vi < vj) if down else (vi > vj):
            change = math.inf if vj == 0 else abs(vi - vj) / abs(vj) * 100
            if change >= threshold and change > best:
                best = change
                best_j = j
    return best_j


def power_pair(values: list[float], i: int, start: int, positive: bool):
    """The two rows of [start, i) with the largest |values| among values > 0
    (positive) or < 0; returns (first, second) when the largest comes first."""
    v1 = v2 = -1.0
    j1 = j2 = None
    for j in range(start, i):
        v = values[j]
        if (v > 0) if positive else (v < 0):
            a = abs(v)
            if j1 is None or a > v1:
                v2, j2 = v1, j1
                v1, j1 = a, j
            elif j2 is None or a > v2:
                v2, j2 = a, j
    if j1 is not None and j2 is not None and j1 < j2:
        return j1, j2
    return None


# --------------------------------------------------------------------------
# Grouped-map entry point
# --------------------------------------------------------------------------

def ema_column(period: int, ip: IndicatorParams) -> str:
    """The column of an EMA: an output if its period is chosen, else internal."""
    return f"EMA{period}" if period in ip.ema_periods else f"_ema{period}"


def kernel_columns(ip: IndicatorParams, pp: PatternParams) -> list[tuple[str, str]]:
    """Name and type of every column the kernel can emit under the parameters."""
    emas = dict.fromkeys([*ip.ema_periods, ip.bb_period, ip.sd17_period, ip.power_period])
    doubles = [*(ema_column(p, ip) for p in emas), "MACD", "MACD_signal", "MACD_hist", "ADX", "PLUS_DI", "MINUS_DI", "ATR",
               "FI", *(f"FI_{p}" for p in ip.fi_periods)]
    trends = [f"{name}_trend" for name, _ in pp.divergence] + ["Bull_Power_trend", "Bear_Power_trend"]
    return [("rn", "int"), *((c, "double") for c in doubles),
            *((c, "boolean") for c in ("price_Peak", "price_Trough", "Higher_Peak", "Lower_Trough")), ("price_search", "int"),
            ("FI_2_Peak", "boolean"), ("FI_2_Trough", "boolean"),
            *((c, "string") for t in trends for c in (t, f"{t}_pair")),
            ("EMA_bullbear", "string"), (f"EMA{pp.ema_short}_slope", "double"),
            ("FI_13_diff", "double"), ("FI_13_Peak", "boolean"), ("FI_13_Trough", "boolean")]


def _lag(a: np.ndarray) -> np.ndarray:
    out = np.empty_like(a)
    if len(a):
        out[0] = np.nan
        out[1:] = a[:-1]
    return out


def lag_patterns(ema_short: np.ndarray, ema_long: np.ndarray, fi13: np.ndarray, spike_pct: float):
    """EMA cross, EMA slope and FI_13 spikes: previous-row comparisons,
    computed here so the series needs no second pass after the kernel."""
    with np.errstate(invalid="ignore", divide="ignore"):
        diff = ema_short - ema_long
        prev = _lag(diff)
        cross = np.where((diff > 0) & (prev < 0), "Long", np.where((diff < 0) & (prev > 0), "Short", None))
        slope = ema_short - _lag(ema_short)
        fprev = _lag(fi13)
        fdiff = fi13 - fprev
        big = np.where(fprev == 0, True, np.abs(fdiff / fprev) * 100 >= spike_pct)
        peak = (fi13 > 0) & (fdiff > 0) & big
        trough = (fi13 < 0) & (fdiff < 0) & big
    return cross.astype(object), slope, fdiff, peak, trough


def analyse_series(pdf: pd.DataFrame, ip: IndicatorParams, pp: PatternParams, wanted=None) -> pd.DataFrame:
    """Input columns plus the kernel columns of one series (any row order)."""
    pdf = pdf.sort_values("Date", kind="stable").reset_index(drop=True)
    return _assemble(pdf, [0, len(pdf)], ip, pp, wanted)


def analyse_partition(batches, ip: IndicatorParams, pp: PatternParams, wanted=None):
    """Stream over Arrow batches of a partition sorted by (ticker, period,
    Date): every completed series is analysed, the series still open at a
    batch end is carried over.  Memory holds one batch plus one series; the
    output is assembled once per batch, not once per series."""
    pending = None
    for pdf in batches:
        if pending is not None and len(pending):
            pdf = pd.concat([pending, pdf], ignore_index=True)
        if not len(pdf):
            continue
        ticker, period = pdf["ticker"].to_numpy(dtype=object), pdf["period"].to_numpy(dtype=object)
        cuts = np.flatnonzero((ticker[1:] != ticker[:-1]) | (period[1:] != period[:-1])) + 1
        last_start = int(cuts[-1]) if len(cuts) else 0
        pending = pdf.iloc[last_start:].reset_index(drop=True)
        if last_start:
            yield _assemble(pdf.iloc[:last_start].reset_index(drop=True), [0, *cuts[:-1].tolist(), last_start], ip, pp, wanted)
    if pending is not None and len(pending):
        yield _assemble(pending, [0, len(pending)], ip, pp, wanted)


INPUTS = ("High", "Low", "Close", "Volume", "FI")


def made_before(ip: IndicatorParams, pp: PatternParams) -> list[str]:
    """Recursive columns that the kernel reads where the rows already hold them."""
    return ["ATR", *(name for name, _ in pp.divergence), f"FI_{ip.fi_periods[0]}", ema_column(ip.power_period, ip)]


def _assemble(pdf: pd.DataFrame, bounds, ip, pp, wanted) -> pd.DataFrame:
    names = dict.fromkeys([*(c for c in (*INPUTS, *made_before(ip, pp)) if c in pdf), *((pp.price_column,) if pp.price_column in pdf else ())])
    arrays = {c: pdf[c].to_numpy(dtype=np.float64, na_value=np.nan) for c in names}
    emitted = [c for c, _ in kernel_columns(ip, pp) if c not in pdf and (wanted is None or c in wanted)]
    parts = [series_columns({c: v[a:b] for c, v in arrays.items()}, ip, pp, emitted) for a, b in zip(bounds[:-1], bounds[1:])]
    cols = {c: pdf[c] for c in pdf.columns}
    for name in emitted:
        cols[name] = np.concatenate([p[name] for p in parts])
    if "price_search" in cols:
        cols["price_search"] = pd.Series(cols["price_search"]).astype("Int32")
    return pd.DataFrame(cols)


def force_index(close: np.ndarray, volume: np.ndarray) -> np.ndarray:
    """(Close - previous Close) * Volume; 0 on the first row."""
    out = (close - _lag(close)) * volume
    if len(out):
        out[0] = 0.0 if volume[0] == volume[0] else NAN
    return out


def series_columns(data, ip: IndicatorParams, pp: PatternParams, wanted=None) -> dict:
    """The ``wanted`` kernel columns (default: all) of one series whose rows are
    sorted by Date; only what they rest on is computed."""
    data = {c: np.asarray(data[c], dtype=np.float64)
            for c in dict.fromkeys([*INPUTS, *made_before(ip, pp), pp.price_column]) if c in data}
    names = [c for c, _ in kernel_columns(ip, pp)] if wanted is None else list(wanted)
    n = len(data["Close"])
    lists: dict[str, list[float]] = {}
    known: dict[str, object] = {}

    def lst(name):
        if name not in lists:
            lists[name] = data[name].tolist()
        return lists[name]

    def once(name, make):
        if name not in known:
            known[name] = make()
        return known[name]

    def ema_of(p):
        if ema_column(p, ip) in data:
            return lst(ema_column(p, ip))
        return once(("ema", p), lambda: ema(lst("Close"), p))

    def fi():
        return once("fi", lambda: data["FI"] if "FI" in data else force_index(data["Close"], data["Volume"]))

    def fi_ema(p):
        if f"FI_{p}" in data:
            return lst(f"FI_{p}")
        return once(("fi", p), lambda: ema(fi().tolist(), p))

    def macds():
        return once("macd", lambda: macd(lst("Close"), ip.macd_fast, ip.macd_slow, ip.macd_signal))

    def moves():
        return once("moves", lambda: ranges(lst("High"), lst("Low"), lst("Close")))

    def bars():
        return lst("High"), lst("Low"), lst("Close")

    def atrs():
        if "ATR" in data:
            return lst("ATR")
        return once("atr", lambda: atr(*bars(), ip.atr_period, moves()))

    def dis():
        return once("di", lambda: directional(*bars(), ip.di_period, moves()))

    def indicator(name):
        if name in data:
            return lst(name)
        if name.startswith("FI_"):
            return fi_ema(int(name[3:]))
        if name.startswith("EMA"):
            return ema_of(int(name[3:]))
        return {"MACD": lambda: macds()[0], "MACD_signal": lambda: macds()[1], "MACD_hist": lambda: macds()[2],
                "ADX": lambda: adx(*bars(), ip.adx_period, moves()), "PLUS_DI": lambda: dis()[0],
                "MINUS_DI": lambda: dis()[1], "ATR": atrs, "FI": fi}[name]()

    def extrema(sign):
        x = data[pp.price_column]
        return once(("price", sign), lambda: find_extrema(sign * x, pp.price_distance, pp.price_prominence))

    def swings(sign):
        return once(("swing", sign), lambda: swing_search(data[pp.price_column].tolist(), atrs(), extrema(sign).tolist(),
                                                          pp.search_quantity, higher=sign > 0))

    def fi2_extrema(sign):
        def make():
            x = sign * np.asarray(fi_ema(ip.fi_periods[0]), dtype=np.float64)
            found = find_extrema(x, pp.fi2_distance, pp.fi2_prominence)
            return found[x[found] > 0]
        return once(("fi2", sign), make)

    def trend(name):
        """{row: (direction, pair)} of a divergence or a power pair."""
        out = {}
        thresholds = dict(pp.divergence)
        for sign, word in ((1, "Down"), (-1, "Up")):
            for i, s in swings(sign).items():
                if name in thresholds:
                    j = divergence(indicator(name), i, s, thresholds[name], sign > 0)
                    pair = None if j is None else (j, i)
                else:
                    bull = name == "Bull_Power"
                    if bull != (sign > 0):
                        continue
                    power = once(name, lambda: (data["High" if bull else "Low"] - np.asarray(ema_of(ip.power_period))).tolist())
                    pair = power_pair(power, i, s, positive=bull)
                if pair:
                    out[i] = word, f"{pair[0]}_{pair[1]}"
        return out

    def flags(rows):
        out = np.zeros(n, dtype=bool)
        out[list(rows)] = True
        return out

    def lags():
        return once("lags", lambda: lag_patterns(np.asarray(ema_of(pp.ema_short)), np.asarray(ema_of(pp.ema_long)),
                                                 np.asarray(fi_ema(ip.fi_periods[-1]), dtype=np.float64), pp.fi13_spike_pct))

    special = {
        "rn": lambda: np.arange(n, dtype=np.int32),
        "price_Peak": lambda: flags(extrema(1)), "price_Trough": lambda: flags(extrema(-1)),
        "Higher_Peak": lambda: flags(swings(1)), "Lower_Trough": lambda: flags(swings(-1)),
        "FI_2_Peak": lambda: flags(fi2_extrema(1)), "FI_2_Trough": lambda: flags(fi2_extrema(-1)),
        "EMA_bullbear": lambda: lags()[0], f"EMA{pp.ema_short}_slope": lambda: lags()[1], "FI_13_diff": lambda: lags()[2],
        "FI_13_Peak": lambda: lags()[3], "FI_13_Trough": lambda: lags()[4]}
    cols = {}
    for name in names:
        if name in special:
            cols[name] = special[name]()
        elif name == "price_search":
            cols[name] = np.full(n, np.nan)
            for i, j in {**swings(1), **swings(-1)}.items():
                cols[name][i] = j
        elif name.endswith(("_trend", "_trend_pair")):
            base, part = (name[:-6], 0) if name.endswith("_trend") else (name[:-11], 1)
            cols[name] = np.full(n, None, dtype=object)
            for i, found in once(("trend", base), lambda: trend(base)).items():
                cols[name][i] = found[part]
        elif name.startswith("_ema"):
            cols[name] = np.asarray(ema_of(int(name[4:])), dtype=np.float64)
        else:
            cols[name] = np.asarray(indicator(name), dtype=np.float64)
    return cols
