"""The series step: one collection per series, wide projections that the JVM compiles."""

SCHEMA = "ticker string, period string, Date date, Open double, High double, Low double, Close double, Volume double"


def _plan(spark, columns):
    from candlewick.operators.indicators import indicators_and_patterns
    bars = spark.createDataFrame([], SCHEMA).repartition(2, "ticker")
    return indicators_and_patterns(bars, columns=columns)._jdf.queryExecution().optimizedPlan().toString()


def test_a_series_is_collected_and_unfolded_once(spark):
    """Before, folds and swings each collected a series and eleven window steps went over its bars."""
    for columns, windows in ((None, 2), (("Side_1", "Side_2", "Side_3"), 1)):
        optimized = _plan(spark, columns)
        assert optimized.count("collect_list") == 1 and optimized.count("inline(") == 1
        assert sum(line.lstrip(" +-:").startswith("Window ") for line in optimized.split("\n")) == windows


def test_golds_columns_are_projected_outside_whole_stage_code(spark):
    """A stage's method with gold's columns passes 8,000 bytes, which the JVM does not compile."""
    from candlewick.plans.jobs import job_gold

    silver = spark.createDataFrame([], "ticker string, Date date, Open double, High double, Low double, Close double, "
                                       "`Adj Close` double, Volume bigint, Dividends double, `Stock Splits` double, created_at timestamp")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows its stages when it has run
    try:
        plan = job_gold(silver)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = [line.lstrip(" +-:") for line in plan]
    above = lines[:next(i for i, line in enumerate(lines) if "inline(" in line)]
    assert [line for line in lines if line.startswith("*(")]
    assert above and all(line.startswith("Project") for line in above)


def test_what_is_collected_and_the_labels_are_made_by_generated_code(spark):
    """A collection and the unfolding of labels evaluate plain columns: before, true range and movements were
    interpreted inside the collection, and seven labels stood in one method that the JVM does not compile."""
    from candlewick.operators.resample import resample

    lines = _plan(spark, ("Side_1", "Side_2", "Side_3")).split("\n")
    collecting = next(line for line in lines if "collect_list" in line)
    assert "greatest" not in collecting and "isnan" not in collecting
    daily = spark.createDataFrame([], "ticker string, Date date, Open double, High double, Low double, Close double, `Adj Close` double, Volume bigint")
    lines = resample(daily, gap_policy="drop")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    unfolding = next(line for line in lines if "explode(" in line)
    assert "date_add" not in unfolding and "last_day" not in unfolding


def test_late_fields_reach_the_last_bars(spark):
    """MACD's signal and ADX come one and two bars late in the fold: series that end on their first values have them."""
    import numpy as np
    import pandas as pd

    import series_twin as K
    from candlewick.operators.indicators import indicators_and_patterns
    from candlewick.params import IndicatorParams, PatternParams

    rng = np.random.default_rng(9)
    frames, names = [], ["MACD", "MACD_signal", "MACD_hist", "ADX", "ATR", "EMA13"]
    for n in (1, 27, 28, 29, 33, 34, 35, 64, 65, 66):
        close = 40 + np.cumsum(rng.integers(-3, 4, n)) * 0.25
        frames.append(pd.DataFrame({"ticker": f"T{n}", "period": "D", "Date": pd.date_range("2021-01-01", periods=n).date, "Open": close,
                                    "High": close + 1.5, "Low": close - 0.5, "Close": close, "Volume": rng.integers(1, 9, n).astype(float)}))
    bars = spark.createDataFrame(list(pd.concat(frames).astype(object).itertuples(index=False, name=None)), SCHEMA)
    got = indicators_and_patterns(bars, columns=names).toPandas().sort_values(["ticker", "Date"])
    for pdf in frames:
        want = K.analyse_series(pdf, IndicatorParams(), PatternParams(), None)
        own = got[got["ticker"] == pdf["ticker"].iloc[0]]
        for c in names:
            assert np.array_equal(own[c].astype(float).to_numpy(), want[c].astype(float).to_numpy(), equal_nan=True), (len(pdf), c)
