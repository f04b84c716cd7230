"""ag_resample / ag_resample_gaps: daily bars to weekly and monthly bars.

All periods are produced by ONE aggregation: every daily bar is tagged with
its label in each period (an ``explode`` of at most 7 small structs) and a
single ``groupBy(ticker, period, label)`` builds every bar.  The per-ticker
anchor date comes from a window over the same ``ticker`` partitioning, so the
whole step needs one shuffle by ticker.  A ticker's daily series holds at
most one row per calendar day, so one partition never holds more than the
ticker's calendar span.

Label rule (right-closed bins, labelled by their last day, anchored on each
ticker's first date d0):

* ``nW``: s0 = first Sunday on or after d0; label = s0 + 7n*ceil((d - s0) / 7n).
* ``nME``: month ordinal m = 12*year + month - 1; label month =
  m0 + n*ceil((m - m0) / n); label = last day of that month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.params import PERIODS, period_step

BASE_COLUMNS = ["ticker", "period", "Date", "Open", "High", "Low", "Close", "Adj Close",
                "Volume", "Dividends", "Stock Splits", "created_at"]


def _month_ordinal(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d) - 1


def _month_end(ordinal: Column) -> Column:
    return F.last_day(F.make_date(F.floor(ordinal / 12).cast("int"), (ordinal % 12 + 1).cast("int"), F.lit(1)))


def first_sunday_on_or_after(d: Column) -> Column:
    return F.date_add(d, F.pmod(8 - F.dayofweek(d), F.lit(7)))


def period_label(period: str, d: Column, d0: Column) -> Column:
    """Label (period-end date) of daily date ``d`` for a series starting on ``d0``."""
    kind, n = period_step(period)
    if kind == "day":
        return d
    if kind == "week":
        s0 = first_sunday_on_or_after(d0)
        step = 7 * n
        k = F.floor((F.datediff(d, s0) + (step - 1)) / step)
        return F.date_add(s0, (k * step).cast("int"))
    m, m0 = _month_ordinal(d), _month_ordinal(d0)
    k = F.floor((m - m0 + (n - 1)) / n)
    return _month_end(m0 + k * n)


def resample(daily: DataFrame, periods=PERIODS, gap_policy: str = "emit") -> DataFrame:
    """Bars of every requested period from a silver daily table.

    ``daily`` has ticker, Date, Open, High, Low, Close, Adj Close, Volume and
    optionally Dividends, Stock Splits, created_at.  "D" passes through row by
    row with all columns (two rows of one date stay two rows); other periods get Open first, High max, Low min, Close and
    Adj Close last, Volume sum, the series' first created_at and NULL
    dividends/splits.  ``gap_policy='emit'`` adds empty bins between a
    series' first and last label (prices NULL, Volume 0); ``'drop'`` omits them.
    """
    if gap_policy not in ("emit", "drop"):
        raise ValueError("gap_policy must be 'emit' or 'drop'")
    for c, t in (("Dividends", "double"), ("Stock Splits", "double"), ("created_at", "timestamp")):
        if c not in daily.columns:
            daily = daily.withColumn(c, F.lit(None).cast(t))
    from candlewick.operators.indicators import by_ticker as _by_ticker
    from candlewick.operators.series import outside_stage

    by_ticker = Window.partitionBy("ticker")
    anchored = (_by_ticker(daily).withColumn("_d0", F.min("Date").over(by_ticker))
                .withColumn("_c0", F.min_by("created_at", "Date").over(by_ticker)))
    # the labels are made outside whole-stage code: in the method that unfolds and aggregates the bars, seven of
    # them pass the size that the JVM compiles
    labelled = outside_stage(anchored, *(period_label(p, F.col("Date"), F.col("_d0")).alias(f"_label_{p}") for p in periods))
    tagged = (
        labelled.withColumn("_tag", F.explode(F.array(*[
            F.struct(F.lit(p).alias("period"), F.col(f"_label_{p}").alias("label")) for p in periods])))
        .select("*", "_tag.period", "_tag.label")
        # daily rows are groups of their own; the number never leaves its partition
        .withColumn("_row", F.when(F.col("_tag.period") == "D", F.monotonically_increasing_id()))
    )
    is_d = F.col("period") == "D"
    bars = (
        tagged.groupBy("ticker", "period", "label", "_row")
        .agg(
            F.min_by("Open", "Date").alias("Open"),
            F.max("High").alias("High"),
            F.min("Low").alias("Low"),
            F.max_by("Close", "Date").alias("Close"),
            F.max_by("Adj Close", "Date").alias("Adj Close"),
            F.sum("Volume").alias("Volume"),
            F.max_by("Dividends", "Date").alias("Dividends"),
            F.max_by("Stock Splits", "Date").alias("Stock Splits"),
            F.max_by("created_at", "Date").alias("_c_row"),
            F.first("_c0").alias("_c0"),
        )
        .select(
            "ticker", "period", F.col("label").alias("Date"),
            "Open", "High", "Low", "Close", "Adj Close", F.col("Volume").cast("bigint").alias("Volume"),
            F.when(is_d, F.col("Dividends")).alias("Dividends"),
            F.when(is_d, F.col("Stock Splits")).alias("Stock Splits"),
            F.when(is_d, F.col("_c_row")).otherwise(F.col("_c0")).alias("created_at"),
        )
    )
    if gap_policy == "drop":
        return bars
    return _emit_gaps(bars, [p for p in periods if p != "D"])


def _emit_gaps(bars: DataFrame, periods) -> DataFrame:
    """Add the empty bins of every non-daily series (prices NULL, Volume 0).

    Each bar emits itself followed by the empty labels up to the next bar of
    its series (``lead`` over the series window), in one ``explode``: no
    second scan, join or union of the bars."""
    if not periods:
        return bars
    steps = F.create_map(*[x for p in periods for x in (F.lit(p), F.lit(period_step(p)[1]))])
    kinds = F.create_map(*[x for p in periods for x in (F.lit(p), F.lit(period_step(p)[0]))])
    n = steps[F.col("period")]
    kind = kinds[F.col("period")]
    nxt = F.lead("Date").over(Window.partitionBy("ticker", "period").orderBy("Date"))
    week_gap = F.floor(F.datediff(nxt, F.col("Date")) / (n * 7)) - 1
    month_gap = F.floor((_month_ordinal(nxt) - _month_ordinal(F.col("Date"))) / n) - 1
    gap_k = F.coalesce(F.when(kind == "week", week_gap).when(kind == "month", month_gap), F.lit(0)).cast("int")
    fields = ["Date", "Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Stock Splits", "created_at"]
    self_row = F.struct(*[F.col(f"`{c}`").alias(c) for c in fields])

    def empty(k):
        label = F.when(kind == "week", F.date_add(F.col("Date"), (k * n * 7).cast("int"))) \
            .otherwise(_month_end(_month_ordinal(F.col("Date")) + k * n))
        return F.struct(label.alias("Date"),
                        *[F.lit(None).cast("double").alias(c) for c in ("Open", "High", "Low", "Close", "Adj Close")],
                        F.lit(0).cast("bigint").alias("Volume"), F.lit(None).cast("double").alias("Dividends"),
                        F.lit(None).cast("double").alias("Stock Splits"), F.col("created_at").alias("created_at"))

    ks = F.when(F.col("_gapk") >= 1, F.sequence(F.lit(1), F.col("_gapk"))).otherwise(F.array().cast("array<int>"))
    rows = F.concat(F.array(self_row), F.transform(ks, empty))
    return (bars.withColumn("_gapk", gap_k).select("ticker", "period", F.explode(rows).alias("_r"))
            .select("ticker", "period", *[F.col(f"_r.`{c}`").alias(c) for c in fields]))
