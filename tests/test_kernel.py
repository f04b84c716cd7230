"""Series kernel: hand-worked values and independent brute-force twins."""

import math
import random

import numpy as np
import pandas as pd
import pytest

import series_twin as K
from candlewick.params import IndicatorParams, PatternParams


def nan_eq(a, b, tol=1e-9):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return abs(a - b) <= tol * max(1.0, abs(a))


def test_ema_seed_and_recursion():
    x = [1.0, 2.0, 3.0, 4.0, 5.0]
    out = K.ema(x, 3)
    assert math.isnan(out[0]) and math.isnan(out[1])
    assert out[2] == 2.0                     # mean of the first three
    assert out[3] == (4.0 - 2.0) * 0.5 + 2.0  # k = 2 / (3 + 1)
    assert out[4] == (5.0 - 3.0) * 0.5 + 3.0


def test_ema_starts_after_leading_nan_and_poisons_after_gap():
    x = [float("nan"), 1.0, 2.0, 3.0, float("nan"), 5.0]
    out = K.ema(x, 2)
    assert math.isnan(out[1]) and out[2] == 1.5
    assert math.isnan(out[4]) and math.isnan(out[5])


def test_macd_alignment():
    rng = random.Random(1)
    x = [100 + rng.random() for _ in range(60)]
    line, sig, hist = K.macd(x, 12, 26, 9)
    first = next(i for i, v in enumerate(line) if not math.isnan(v))
    assert first == 33
    # fast EMA seeded on rows 14..25, slow on 0..25
    fast = sum(x[14:26]) / 12
    slow = sum(x[0:26]) / 26
    k12, k26 = 2 / 13, 2 / 27
    for i in range(26, 34):
        fast = (x[i] - fast) * k12 + fast
        slow = (x[i] - slow) * k26 + slow
    assert nan_eq(line[33], fast - slow)
    assert nan_eq(hist[40], line[40] - sig[40])


def test_atr_di_adx_first_rows():
    rng = random.Random(2)
    close = [50 + rng.random() * 5 for _ in range(80)]
    high = [c + rng.random() for c in close]
    low = [c - rng.random() for c in close]
    a = K.atr(high, low, close, 14)
    assert math.isnan(a[13]) and not math.isnan(a[14])
    tr = [max(high[i] - low[i], abs(close[i - 1] - high[i]), abs(close[i - 1] - low[i])) for i in range(1, 15)]
    assert nan_eq(a[14], sum(tr) / 14)
    p, m = K.directional(high, low, close, 13)
    assert math.isnan(p[12]) and not math.isnan(p[13])
    assert all(0 <= v <= 100 for v in p[13:]) and all(0 <= v <= 100 for v in m[13:])
    adx = K.adx(high, low, close, 14)
    assert math.isnan(adx[26]) and not math.isnan(adx[27])
    assert all(0 <= v <= 100 for v in adx[27:])


# ---------------------------------------------------------------------------
# Independent brute-force peak finder (definition-level, quadratic)
# ---------------------------------------------------------------------------

def brute_peaks(x, distance, prominence):
    n = len(x)
    cands = []
    i = 1
    while i < n - 1:
        j = i
        while j + 1 < n and x[j + 1] == x[i]:
            j += 1
        left_ok = x[i - 1] < x[i]
        right_ok = j + 1 <= n - 1 and j <= n - 2 and x[j + 1] < x[i]
        if left_ok and right_ok:
            cands.append((i + j) // 2)
        i = j + 1
    # greedy by height, later index first on ties
    order = sorted(range(len(cands)), key=lambda r: (x[cands[r]], r), reverse=True)
    removed = set()
    for r in order:
        if r in removed:
            continue
        for q in range(len(cands)):
            if q != r and abs(cands[q] - cands[r]) < distance:
                removed.add(q)
    kept = [cands[r] for r in range(len(cands)) if r not in removed]
    out = []
    for p in kept:
        lo = p
        while lo - 1 >= 0 and not (x[lo - 1] > x[p]) and x[lo - 1] == x[lo - 1]:
            lo -= 1
        hi = p
        while hi + 1 < n and not (x[hi + 1] > x[p]) and x[hi + 1] == x[hi + 1]:
            hi += 1
        base = max(min(x[lo:p + 1]), min(x[p:hi + 1]))
        if x[p] - base >= prominence:
            out.append(p)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_find_extrema_matches_brute_force(seed):
    rng = random.Random(seed)
    n = rng.randint(3, 120)
    # small integer alphabet -> many plateaus and ties
    x = [float(rng.randint(0, 6)) for _ in range(n)]
    got = K.find_extrema(np.asarray(x), 5, 1.0).tolist()
    assert got == brute_peaks(x, 5, 1.0)
    neg = [-v for v in x]
    assert K.find_extrema(np.asarray(neg), 5, 1.0).tolist() == brute_peaks(neg, 5, 1.0)


def test_plateau_reports_middle_and_edges_never_count():
    x = np.asarray([0, 2, 2, 2, 0, 5, 5], dtype=float)
    assert K.local_maxima(x).tolist() == [2]


# ---------------------------------------------------------------------------
# Swing search, divergence, power pairs vs direct transcriptions of the rules
# ---------------------------------------------------------------------------

def brute_swings(price, tol, points, back, higher):
    res = {}
    for a in range(back, len(points)):
        i = points[a]
        cands = [points[b] for b in range(a - back, a)
                 if abs(price[i] - price[points[b]]) <= tol[i]
                 and ((price[i] > price[points[b]]) if higher else (price[i] < price[points[b]]))]
        if cands:
            res[i] = min(cands)
    return res


def brute_divergence(v, i, s, thr, down):
    best = None
    for j in range(s, i):
        if (v[i] < v[j]) if down else (v[i] > v[j]):
            ch = math.inf if v[j] == 0 else abs(v[i] - v[j]) / abs(v[j]) * 100
            if ch >= thr and (best is None or ch > best[1]):
                best = (j, ch)
    return None if best is None else best[0]


def brute_power(v, i, s, positive):
    c = [(j, abs(v[j])) for j in range(s, i) if ((v[j] > 0) if positive else (v[j] < 0))]
    c.sort(key=lambda t: (-t[1], t[0]))
    if len(c) >= 2 and c[0][0] < c[1][0]:
        return c[0][0], c[1][0]
    return None


@pytest.mark.parametrize("seed", range(30))
def test_swings_divergence_power(seed):
    rng = random.Random(100 + seed)
    n = 200
    price = [float(rng.randint(0, 30)) for _ in range(n)]
    tol = [float(rng.randint(0, 10)) for _ in range(n)]
    ind = [float(rng.randint(-5, 5)) for _ in range(n)]
    peaks = K.find_extrema(np.asarray(price), 5, 1.0).tolist()
    for higher in (True, False):
        got = K.swing_search(price, tol, peaks, 2, higher)
        assert got == brute_swings(price, tol, peaks, 2, higher)
        for i, s in got.items():
            for down in (True, False):
                assert K.divergence(ind, i, s, 30.0, down) == brute_divergence(ind, i, s, 30.0, down)
            for pos in (True, False):
                assert K.power_pair(ind, i, s, pos) == brute_power(ind, i, s, pos)


def test_analyse_series_shapes_and_bounds():
    rng = np.random.default_rng(3)
    n = 300
    close = 100 + np.cumsum(rng.normal(size=n))
    pdf = pd.DataFrame({"ticker": "X", "period": "D", "Date": pd.date_range("2020-01-01", periods=n).date,
                        "Open": close, "High": close + 1, "Low": close - 1, "Close": close, "Volume": 1000})
    out = K.analyse_series(pdf.sample(frac=1, random_state=1), IndicatorParams(), PatternParams())
    assert len(out) == n and out["rn"].tolist() == list(range(n))
    assert out["price_Peak"].sum() > 0 and out["price_Trough"].sum() > 0
    assert not (out["price_Peak"] & out["price_Trough"]).any()
    hp = out[out["Higher_Peak"]]
    assert (hp["price_search"] < hp["rn"]).all()
    # streaming over batches gives the same columns as one call per series
    two = pd.concat([pdf, pdf.assign(ticker="Y")], ignore_index=True)
    batches = [two.iloc[:170], two.iloc[170:450], two.iloc[450:]]
    streamed = pd.concat(list(K.analyse_partition(batches, IndicatorParams(), PatternParams())), ignore_index=True)
    one = K.analyse_series(pdf, IndicatorParams(), PatternParams())
    a = streamed[streamed.ticker == "Y"].reset_index(drop=True)
    for c in ("EMA13", "MACD_hist", "ADX", "ATR", "FI_2"):
        assert np.allclose(a[c], one[c], equal_nan=True)
    for c in ("price_Peak", "Higher_Peak", "FI_2_Trough", "Bull_Power_trend_pair"):
        assert a[c].tolist() == one[c].tolist()


def test_chosen_columns_equal_those_of_the_full_run():
    rng = np.random.default_rng(8)
    close = np.round(100 + np.cumsum(rng.standard_normal(300) * 6), 2)
    data = {"High": close + 3, "Low": close - 3, "Close": close, "Volume": rng.integers(1, 50, 300).astype(float)}
    ip, pp = IndicatorParams(), PatternParams()
    full = K.series_columns(data, ip, pp)
    assert list(full) == [c for c, _ in K.kernel_columns(ip, pp)]
    for name, column in full.items():
        alone = K.series_columns(data, ip, pp, [name])
        assert list(alone) == [name]
        assert all(a == b or (a != a and b != b) for a, b in zip(alone[name].tolist(), column.tolist()))


def test_prominence_equals_the_walk():
    rng = np.random.default_rng(12)
    for _ in range(200):
        x = rng.integers(0, 12, 60).astype(float)
        x[rng.random(60) < 0.05] = np.nan
        peaks = K.local_maxima(x).tolist()

        def walk(p, step):
            low, i = x[p], p
            while 0 <= i < 60 and x[i] <= x[p]:
                low, i = min(low, x[i]), i + step
            return low
        assert K.prominences(x.tolist(), peaks) == [x[p] - max(walk(p, -1), walk(p, 1)) for p in peaks]


def test_periods_are_free(spark):
    from pyspark.sql import functions as F

    from candlewick.operators.indicators import by_ticker, indicators_and_patterns
    from candlewick.sources import fixtures as fx
    from conftest import SF_SMALL
    bars = by_ticker(fx.bars_wide(spark, SF_SMALL).withColumn("period", F.lit("D")))
    ip = IndicatorParams(ema_periods=(12, 26), fi_periods=(3, 13), sma_periods=(20,), bb_period=9, power_period=5)
    free = indicators_and_patterns(bars, ip)
    assert {"EMA12", "EMA26", "FI_3", "FI_13", "SMA20", "upperband", "Bull_Power", "Side_2"} <= set(free.columns)
    assert not [c for c in free.columns if c.startswith("_")]
    plain = indicators_and_patterns(bars, columns=("EMA13", "EMA26", "SMA200"))
    assert plain.columns == ["ticker", "period", "Date", "EMA13", "EMA26", "SMA200"]
    key = ["ticker", "Date"]
    joined = free.select(*key, F.col("EMA26").alias("a")).join(plain.select(*key, "EMA26"), key)
    assert joined.filter(~F.col("a").eqNullSafe(F.col("EMA26"))).count() == 0 and joined.count() == bars.count()


def test_no_indicator_or_pattern_needs_python(spark):
    from candlewick.plans.registry import QUERIES
    from conftest import SF_SMALL
    for key in ("in_sma", "in_ema", "in_adx", "pt_local_extrema", "pt_side_1"):
        plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "InPandas" not in plan and "InArrow" not in plan


def test_series_with_gaps_equal_the_twin(spark):
    """Short, long, flat and broken series, prices with ties: every column of the plain per-series version."""
    import numpy as np
    import pandas as pd

    from candlewick.operators.indicators import indicators_and_patterns
    from candlewick.params import IndicatorParams, PatternParams

    rng = np.random.default_rng(4)
    frames = []
    for i, n in enumerate([1, 2, 13, 14, 27, 28, 40, 90, 150, 330]):
        close = np.round(50 + np.cumsum(rng.integers(-3, 4, n)) * 0.5, 2) if i % 3 else np.full(n, 20.0)
        pdf = pd.DataFrame({"ticker": f"T{i}", "period": "D", "Date": pd.date_range("2020-01-01", periods=n).date, "Open": close,
                            "High": close + rng.integers(0, 3, n), "Low": close - rng.integers(0, 3, n), "Close": close,
                            "Volume": rng.integers(1, 50, n).astype(float)})
        if i == 7:
            pdf.loc[:4, ["High", "Low", "Close"]] = None   # missing at the start
        if i == 8:
            pdf.loc[100, ["High", "Low", "Close"]] = None  # a gap
        frames.append(pdf)
    ip = IndicatorParams(ema_periods=(13, 26), fi_periods=(2, 13))
    pp = PatternParams(price_prominence=0.75, search_quantity=2, divergence=(("MACD_hist", 10.0), ("FI_13", 20.0)))
    schema = "ticker string, period string, Date date, Open double, High double, Low double, Close double, Volume double"
    data = pd.concat(frames).astype(object)
    bars = spark.createDataFrame(list(data.where(data.notna(), None).itertuples(index=False, name=None)), schema)
    got = indicators_and_patterns(bars, ip, pp).toPandas().sort_values(["ticker", "Date"]).reset_index(drop=True)
    columns = [c for c, _ in K.kernel_columns(ip, pp) if c not in ("rn", "FI") and not c.startswith("_")]
    swings = 0
    for i, pdf in enumerate(frames):
        want = K.analyse_series(pdf, ip, pp, None)
        own = got[got["ticker"] == f"T{i}"].reset_index(drop=True)
        for c in columns:
            a, b = own[c], want[c]
            same = (a == b) | (a.isna() & b.isna())
            if a.dtype == np.float64 and c != "price_search":
                same |= np.isclose(a.astype(float), b.astype(float), rtol=1e-12, atol=1e-12, equal_nan=True)
            assert same.all(), (i, c, a[~same].head(3).tolist(), b[~same].head(3).tolist(), np.flatnonzero(~same)[:3])
        swings += int(want["Higher_Peak"].sum() + want["Lower_Trough"].sum())
    assert swings > 5


def test_marks_of_a_long_series_are_placed_not_searched(spark):
    """Marks come as arrays aligned with the bars, so no bar searches the extrema; the distance rule ranks
    close runs of candidates alone.  Long series, ties and plateaus give the plain version's rows."""
    from candlewick.operators.indicators import indicators_and_patterns

    rng = np.random.default_rng(31)
    names = ["price_Peak", "price_Trough", "FI_2_Peak", "FI_2_Trough", "Higher_Peak", "Lower_Trough", "price_search",
             "MACD_hist_trend_pair", "FI_13_trend_pair", "Bull_Power_trend_pair", "Bear_Power_trend_pair"]
    frames = []
    for i, (n, spread) in enumerate([(1500, 3), (400, 1), (3, 2), (5, 2)]):
        close = 60.0 + np.cumsum(rng.integers(-spread, spread + 1, n)) * 0.5
        frames.append(pd.DataFrame({
            "ticker": f"T{i}", "period": "D", "Date": pd.date_range("2015-01-01", periods=n).date, "High": close + rng.integers(0, 3, n),
            "Low": close - rng.integers(0, 3, n), "Close": close, "Volume": rng.integers(1, 50, n).astype(float)}))
    bars = spark.createDataFrame(list(pd.concat(frames).astype(object).itertuples(index=False, name=None)),
                                 "ticker string, period string, Date date, High double, Low double, Close double, Volume double")
    marked = indicators_and_patterns(bars, columns=names)
    assert "array_contains" not in marked._jdf.queryExecution().optimizedPlan().toString()
    got = marked.toPandas().sort_values(["ticker", "Date"]).reset_index(drop=True)
    for i, pdf in enumerate(frames):
        want = K.analyse_series(pdf.assign(Open=pdf["Close"]), IndicatorParams(), PatternParams(), None)
        own = got[got["ticker"] == f"T{i}"].reset_index(drop=True)
        for c in names:
            same = (own[c] == want[c]) | (own[c].isna() & want[c].isna())
            assert same.all(), (i, c, own[c][~same].head(3).tolist(), want[c][~same].head(3).tolist())


def test_adx_is_made_in_the_fold_of_its_sums(spark):
    """One pass over a series gives ADX too (values: the twin test); before, its bars were collected twice."""
    from candlewick.operators.indicators import indicators_and_patterns

    bars = spark.createDataFrame([], "ticker string, period string, Date date, High double, Low double, Close double, Volume double")
    plan = indicators_and_patterns(bars.repartition(2, "ticker"), columns=("ADX", "PLUS_DI"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("collect_list") == 1
