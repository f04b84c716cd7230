"""Resampling (against pandas resample as an independent oracle) and the
multi-period as-of lookup (against a brute-force scan)."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators.asof import asof_periods
from candlewick.operators.resample import resample
from candlewick.params import ASOF_OFFSET_DAYS
from candlewick.sources import fixtures as fx

PANDAS_RULE = {"W": "W", "2W": "2W", "3W": "3W", "ME": "ME", "2ME": "2ME", "3ME": "3ME"}


def _random_daily(seed, tickers=3, n=150):
    rng = random.Random(seed)
    rows = []
    for t in range(tickers):
        d = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 40))
        for _ in range(n):
            d += dt.timedelta(days=rng.choice([1, 1, 1, 2, 3, 5]))
            c = float(rng.randint(100, 200))
            rows.append((f"T{t}", d, c - 1, c + 2, c - 3, c, c, rng.randint(1, 50)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_resample_matches_pandas(spark, seed):
    rows = _random_daily(seed)
    cols = ["ticker", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"]
    df = spark.createDataFrame(rows, cols)
    got = resample(df, gap_policy="emit").toPandas()
    pdf = pd.DataFrame(rows, columns=cols)
    for (tk, period), g in got.groupby(["ticker", "period"]):
        src = pdf[pdf.ticker == tk].set_index(pd.to_datetime(pdf[pdf.ticker == tk]["Date"]))
        if period == "D":
            assert len(g) == len(src)
            continue
        exp = src.resample(PANDAS_RULE[period]).agg(
            {"Open": "first", "High": "max", "Low": "min", "Close": "last", "Volume": "sum"})
        g = g.sort_values("Date")
        assert [pd.Timestamp(d) for d in g["Date"]] == list(exp.index), (tk, period)
        assert g["Volume"].tolist() == exp["Volume"].tolist()
        assert g["Close"].fillna(-1).tolist() == exp["Close"].fillna(-1).tolist()
        assert g["Open"].fillna(-1).tolist() == exp["Open"].fillna(-1).tolist()


def test_resample_conserves_volume(spark):
    rows = _random_daily(5)
    df = spark.createDataFrame(rows, ["ticker", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"])
    out = resample(df).groupBy("period").agg(F.sum("Volume").alias("v")).collect()
    total = sum(r[7] for r in rows)
    assert {r["v"] for r in out} == {total}


def test_asof_matches_brute_force(spark):
    rows = _random_daily(9, tickers=2, n=120)
    df = spark.createDataFrame(rows, ["ticker", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"])
    bars = resample(df, gap_policy="drop")
    got = asof_periods(bars, value_cols=("Close",)).toPandas()
    allp = bars.select("ticker", "period", "Date", "Close").toPandas()
    for _, r in got.sample(60, random_state=1).iterrows():
        for p, n in ASOF_OFFSET_DAYS.items():
            cand = allp[(allp.ticker == r.ticker) & (allp.period == p)
                        & (allp.Date <= r.Date + dt.timedelta(days=n))]
            hit = r[f"_asof_{p}"]
            if len(cand) == 0:
                assert hit is None
            else:
                best = cand.sort_values("Date").iloc[-1]
                assert hit["Date"] == best.Date and hit["Close"] == best.Close


def test_gold_with_empty_bins_poisons_recursions(spark):
    """Empty bins (gap_policy='emit') carry NULL prices; recursive indicators
    are NULL from the first empty bin of a series on, nothing fails."""
    from conftest import SF_SMALL
    from candlewick.plans.jobs import job_gold

    g = job_gold(fx.with_silver_columns(fx.bars_long(spark, SF_SMALL)), gap_policy="emit").filter(F.col("period") == "W")
    pdf = g.select("ticker", "Date", "Close", "EMA13", "SMA50", "Side_1").toPandas().sort_values(["ticker", "Date"])
    assert pdf["Close"].isna().any()
    for _, s in pdf.groupby("ticker"):
        gaps = s.index[s["Close"].isna()]
        if len(gaps):
            after = s.loc[gaps[0]:]
            assert after["EMA13"].isna().all()


def test_conclusion_lookback_and_drop_latest(spark):
    from conftest import SF_SMALL
    from candlewick.operators.asof import conclusion
    from candlewick.plans.jobs import job_gold

    g = job_gold(fx.with_silver_columns(fx.bars_long(spark, SF_SMALL)), gap_policy="drop")
    full = conclusion(g)
    recent = conclusion(g, as_of="1998-12-31")
    assert recent.count() < full.count()
    assert recent.filter(F.col("Date_D") < F.lit("1996-12-31").cast("date")).count() == 0
    # each ticker's latest daily row is dropped
    latest = g.filter("period = 'D'").groupBy("ticker").agg(F.max("Date").alias("m"))
    assert full.join(latest, (full.ticker == latest.ticker) & (full.Date_D == latest.m)).count() == 0
    # the as-of never looks further ahead than the tolerance
    assert full.filter(F.datediff("Date_W", "Date_D") > 8).count() == 0
    assert full.filter(F.datediff("Date_3M", "Date_D") > 93).count() == 0


def test_per_period_parameters(spark):
    from conftest import SF_SMALL
    from candlewick.params import IndicatorParams, PatternParams
    from candlewick.plans.jobs import job_gold, job_gold_per_period

    silver = fx.with_silver_columns(fx.bars_long(spark, SF_SMALL))
    base = (IndicatorParams(), PatternParams())
    fast = (IndicatorParams(stoch_fastk=9, bb_dev=2.0), PatternParams(price_distance=3, price_prominence=5.0))
    out = job_gold_per_period(silver, {"D": base, "W": fast}, gap_policy="drop")
    assert {r.period for r in out.select("period").distinct().collect()} == {"D", "W"}
    d_ref = job_gold(silver, ("D",), "drop").filter("period = 'D'")
    assert out.filter("period = 'D'").exceptAll(d_ref).count() == 0
    w_default = job_gold(silver, ("W",), "drop")
    assert out.filter("period = 'W'").exceptAll(w_default).count() > 0     # the override took effect


def test_daily_rows_pass_through_even_twice(spark):
    rows = [("A", "2024-01-02", 1.0, 5.0), ("A", "2024-01-02", 2.0, 9.0), ("A", "2024-01-03", 3.0, 4.0)]
    df = spark.createDataFrame(rows, "ticker string, Date string, Open double, High double").selectExpr(
        "ticker", "to_date(Date) AS Date", "Open", "High", "Open AS Low", "Open AS Close", "Open AS `Adj Close`", "CAST(1 AS BIGINT) AS Volume")
    got = resample(df, periods=("D", "W"), gap_policy="drop").collect()
    assert sorted((r.Open, r.High) for r in got if r.period == "D") == [(1.0, 5.0), (2.0, 9.0), (3.0, 4.0)]
    assert [(r.High, r.Volume) for r in got if r.period == "W"] == [(9.0, 3)]
