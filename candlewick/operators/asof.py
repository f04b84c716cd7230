"""jn_asof_period: multi-period as-of lookup, and the conclusion mart.

For each base (daily) row and each longer period P with tolerance N_P days,
take the latest row of the same ticker in period P whose Date is at most the
daily Date + N_P (no lower bound; no match gives NULLs).

Instead of a correlated lookup per period, all periods of a ticker are
stacked in one window partition ordered by day number.  For P the frame
``rangeBetween(unboundedPreceding, N_P)`` of a daily row covers exactly the
rows dated up to Date + N_P, and ``last(struct if period = P, ignorenulls)``
picks the latest P row in it.  All six lookups share one partitioning and
ordering: one shuffle by ticker, one sort, one Window operator, each frame
evaluated in a single streaming pass (growing frame, no pairs built).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.params import ASOF_OFFSET_DAYS, MART_SUFFIX


def asof_periods(df: DataFrame, value_cols=("Side_1", "Side_2", "Side_3"), offsets=None,
                 base_period: str = "D", allow_future: bool = True) -> DataFrame:
    """Base rows with one struct column ``_asof_<P>`` (Date + value_cols) per period.

    ``df`` has ticker, period, Date and ``value_cols`` for all periods.
    ``allow_future=False`` drops the forward tolerance (Date <= base Date).
    """
    offsets = dict(ASOF_OFFSET_DAYS if offsets is None else offsets)
    periods = list(offsets)
    rows = df.filter(F.col("period").isin(base_period, *periods)).select(
        "ticker", "period", "Date", *value_cols, F.unix_date("Date").alias("_day"))
    w = Window.partitionBy("ticker").orderBy("_day")
    lookups = []
    for p, n in offsets.items():
        hit = F.when(F.col("period") == p, F.struct("Date", *value_cols))
        frame = w.rangeBetween(Window.unboundedPreceding, n if allow_future else 0)
        lookups.append(F.last(hit, ignorenulls=True).over(frame).alias(f"_asof_{p}"))
    return rows.select("*", *lookups).filter(F.col("period") == base_period).drop("_day")


def conclusion(gold: DataFrame, as_of: str | None = None, lookback_years: int = 2,
               drop_latest: bool = True, allow_future: bool = True) -> DataFrame:
    """job_conclusion: the entry-conclusion mart.

    Daily rows (within ``lookback_years`` of ``as_of`` when given) with the
    as-of Date and Side_1..3 of every longer period, minus each ticker's
    latest daily row.
    """
    sides = ["Side_1", "Side_2", "Side_3"]
    src = gold.select("ticker", "period", "Date", *sides)
    if as_of is not None:
        lookback = F.add_months(F.to_date(F.lit(as_of)), -12 * lookback_years)
        src = src.filter((F.col("period") != "D") | (F.col("Date") >= lookback))
    j = asof_periods(src, sides, allow_future=allow_future)
    cols = [F.col("ticker"), F.col("Date").alias("Date_D")]
    for p in ASOF_OFFSET_DAYS:
        cols.append(F.col(f"_asof_{p}.Date").alias(f"Date_{MART_SUFFIX[p]}"))
    for s in sides:
        cols.append(F.col(s).alias(f"{s}_D"))
        for p in ASOF_OFFSET_DAYS:
            cols.append(F.col(f"_asof_{p}.{s}").alias(f"{s}_{MART_SUFFIX[p]}"))
    out = j.select(*cols)
    if drop_latest:
        latest = F.max("Date_D").over(Window.partitionBy("ticker"))
        out = out.withColumn("_max", latest).filter(F.col("Date_D") < F.col("_max")).drop("_max")
    return out
