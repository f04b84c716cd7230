"""Trade-tick operators in batch form (flt_condition_codes, flt_session,
ag_group_collect, st_monitor, st_alert_config, st_alert_batch).

Ticks are ordered per symbol by ``(t, event_id)``.  A symbol may carry a
large share of all ticks, so per-symbol sequential steps never put a whole
symbol into one window buffer:

* previous price: ``lag`` inside (symbol, time bucket) partitions, and the
  last price of the previous non-empty bucket (one row per bucket) for each
  bucket's first tick;
* cooldown: only the threshold crossings go through a sequential scan, cut
  into segments at gaps longer than the cooldown, where the scan starts
  afresh; sorted, they stream through ``mapInPandas`` with per-key state, so
  a key is never materialised as one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from candlewick.schemas import HOLIDAYS

# --- fixed values: market rules of the live-trade pipeline --------------------
EXCLUDED_CODES = ("24", "25")          # outside-market trade condition codes
MARKET_TZ = "America/New_York"
SESSION_OPEN = "09:30"
SESSION_CLOSE = "16:00"
# threshold label -> (cooldown seconds, level)
ALERT_LINES = {"upperband": (60, "critical"), "lowerband": (60, "critical"),
               "upper_1_7": (30, "warning"), "lower_1_7": (30, "warning")}
# -----------------------------------------------------------------------------

BUCKET_MS = 3_600_000  # one hour of ticks per (symbol, bucket) partition


def exclude_codes(ticks: DataFrame, codes=EXCLUDED_CODES) -> DataFrame:
    """flt_condition_codes: drop trades whose code list holds an excluded
    code; a missing code list passes."""
    hit = F.arrays_overlap(F.col("c"), F.array(*[F.lit(c) for c in codes]))
    return ticks.filter(~F.coalesce(hit, F.lit(False)))


EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def local_time(t: Column, tz: str = MARKET_TZ) -> Column:
    """sc_epoch_tz: epoch ms -> wall-clock time in ``tz`` as TIMESTAMP_NTZ.

    Built from NTZ arithmetic and ``convert_timezone``, so hour, date and
    formatting do not depend on the session time zone."""
    utc_wall = F.timestamp_add("MILLISECOND", t, F.expr(EPOCH_NTZ))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def epoch_ms(ts_ntz: Column) -> Column:
    """Epoch milliseconds of a UTC wall-clock TIMESTAMP_NTZ (truncated)."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), ts_ntz.cast("timestamp_ntz"))


def _seconds_of_day(hhmm: Column) -> Column:
    parts = F.split(hhmm, ":")
    return parts[0].cast("int") * 3600 + parts[1].cast("int") * 60


def in_session(ticks: DataFrame, holidays: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """flt_session: keep trades inside the exchange session (weekdays,
    09:30 inclusive to 16:00 exclusive local time); a holiday with empty
    hours is closed, one with 'HH:MM-HH:MM' is a short day.

    The holiday calendar has a handful of rows per year, so it is broadcast."""
    local = local_time(F.col("t"), tz)
    t = ticks.withColumn("_local", local).withColumn("_day", F.date_format("_local", "yyyy-MM-dd"))
    cal = F.broadcast(holidays.select(F.col("atDate").alias("_day"), F.col("tradingHour").alias("_hours")))
    j = t.join(cal, "_day", "left")
    hours = F.split(F.col("_hours"), "-")
    open_s = F.when(F.col("_hours").isNull(), _seconds_of_day(F.lit(SESSION_OPEN))).otherwise(_seconds_of_day(hours[0]))
    close_s = F.when(F.col("_hours").isNull(), _seconds_of_day(F.lit(SESSION_CLOSE))).otherwise(_seconds_of_day(hours[1]))
    sod = (F.hour("_local") * 3600 + F.minute("_local") * 60 + F.second("_local")).cast("double") \
        + (F.col("t") % 1000) / 1000.0
    weekday = ~F.dayofweek("_local").isin(1, 7)
    closed = F.coalesce(F.col("_hours") == "", F.lit(False))
    keep = weekday & ~closed & (sod >= open_s) & (sod < close_s)
    return j.filter(keep).drop("_local", "_day", "_hours")


def holiday_table(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, HOLIDAYS)


def group_collect(ticks: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """ag_group_collect: per symbol and local date, first / last time and count
    (the landing file key {symbol}/{date}/{start}_{end})."""
    return (ticks.withColumn("date", F.to_date(local_time(F.col("t"), tz)))
            .groupBy("s", "date")
            .agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count(F.lit(1)).alias("n_trades")))


def monitor_lines(ticks: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """st_monitor: one formatted line per trade: local time, symbol, price, volume."""
    ts = F.date_format(local_time(F.col("t"), tz), "HH:mm:ss")
    line = F.format_string("[%s]  %-6s  %10.3f  vol:%6s", ts, F.col("s"), F.col("p"), F.col("v").cast("string"))
    return ticks.select("s", "t", line.alias("line"))


def missing_tickers(screened: DataFrame, daily: DataFrame) -> DataFrame:
    """jn_missing: screened tickers without any daily row, each once."""
    return screened.select("ticker").distinct().join(daily.select("ticker").distinct(), "ticker", "left_anti")


def alert_config(latest_daily: DataFrame, screened: DataFrame | None = None) -> DataFrame:
    """st_alert_config: four threshold rows per ticker from its latest daily
    row (upperband, lowerband critical 60 s; upper_1_7, lower_1_7 warning 30 s),
    for the ``screened`` tickers if given."""
    if screened is not None:
        latest_daily = latest_daily.join(screened.select("ticker").distinct(), "ticker", "left_semi")
    rows = F.explode(F.array(*[
        F.struct(F.lit(label).alias("label"), F.col(label).alias("threshold"),
                 F.lit(cd).alias("cooldown"), F.lit(level).alias("level"))
        for label, (cd, level) in ALERT_LINES.items()]))
    return latest_daily.select("ticker", rows.alias("_r")).select(
        "ticker", "_r.label", "_r.threshold", "_r.cooldown", "_r.level")


# ids are signed 64-bit: shifted to 0 .. 2**64 they fit below one step of the time
_ID_STEP = "100000000000000000000"
_ID_SHIFT = "9223372036854775808"


def _order_key() -> Column:
    """(t, event_id) as one decimal in the same order, negative ids included; a
    struct key would force the partial aggregation into a sort."""
    return (F.col("t").cast("decimal(38,0)") * F.lit(_ID_STEP).cast("decimal(38,0)")
            + F.col("event_id").cast("decimal(38,0)") + F.lit(_ID_SHIFT).cast("decimal(38,0)"))


def with_previous_price(ticks: DataFrame, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Add ``prev_p``: the price of the symbol's previous tick by (t, event_id).

    Two-level: lag inside (symbol, bucket); each bucket's first tick takes the
    last price of the symbol's previous non-empty bucket."""
    b = ticks.withColumn("_bucket", F.floor(F.col("t") / bucket_ms))
    inner = Window.partitionBy("s", "_bucket").orderBy("t", "event_id")
    b = b.withColumn("_prev", F.lag("p").over(inner))
    last = (b.groupBy("s", "_bucket")
            .agg(F.max_by("p", _order_key()).alias("_last"))
            .withColumn("_carry", F.lag("_last").over(Window.partitionBy("s").orderBy("_bucket")))
            .select("s", "_bucket", "_carry"))
    return (b.join(last, ["s", "_bucket"], "left")
            .withColumn("prev_p", F.coalesce("_prev", "_carry"))
            .drop("_bucket", "_prev", "_carry"))


def crossings(ticks: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Threshold crossings: upper lines fire when prev <= thr < price, lower
    lines when prev >= thr > price; the first tick of a symbol never fires.
    ``ticks`` must already exclude filtered trades (they do not update prev).

    A symbol's few lines are one row, so a tick meets them once and only the
    lines it crosses become rows."""
    lines = (thresholds.groupBy(F.col("ticker").alias("s"))
             .agg(F.collect_list(F.struct("label", "threshold", "cooldown", "level")).alias("_lines")))
    j = with_previous_price(ticks).filter(F.col("prev_p").isNotNull()).join(lines, "s")

    def hit(line):
        up = line["label"].contains("upper") & (F.col("prev_p") <= line["threshold"]) & (F.col("p") > line["threshold"])
        down = line["label"].contains("lower") & (F.col("prev_p") >= line["threshold"]) & (F.col("p") < line["threshold"])
        return up | down

    crossed = j.withColumn("_hits", F.filter("_lines", hit)).filter(F.size("_hits") > 0).drop("_lines")
    return crossed.withColumn("_hit", F.explode("_hits")).select("*", "_hit.*").drop("_hits", "_hit")


def with_segment(crossed: DataFrame, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Add ``segment``: the time of the (symbol, line)'s last crossing that
    followed its predecessor by more than the cooldown.

    Such a crossing always fires, as the last sent alert is no later than the
    predecessor, so what comes before it does not matter and each segment can
    be scanned by itself.  Two-level like the previous price: no symbol is
    one window."""
    key = ["s", "label"]
    b = crossed.withColumn("_bucket", F.floor(F.col("t") / bucket_ms))
    inner, outer = Window.partitionBy(*key, "_bucket").orderBy("t", "event_id"), Window.partitionBy(*key).orderBy("_bucket")
    before = (b.groupBy(*key, "_bucket").agg(F.max("t").alias("_last"))
              .withColumn("_carry", F.lag("_last").over(outer)).select(*key, "_bucket", "_carry"))
    b = b.withColumn("_prev", F.lag("t").over(inner)).join(before, [*key, "_bucket"], "left")
    prev = F.coalesce("_prev", "_carry")
    starts = prev.isNull() | (F.col("t") - prev > F.col("cooldown") * 1000)
    b = b.withColumn("_start", F.when(starts, F.col("t"))).drop("_prev", "_carry")
    so_far = inner.rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("_own", F.max("_start").over(so_far))
    until = outer.rowsBetween(Window.unboundedPreceding, -1)
    opened = (b.groupBy(*key, "_bucket").agg(F.max("_start").alias("_s"))
              .withColumn("_open", F.max("_s").over(until)).select(*key, "_bucket", "_open"))
    return (b.join(opened, [*key, "_bucket"], "left").withColumn("segment", F.coalesce("_own", "_open"))
            .drop("_bucket", "_start", "_own", "_open"))


ALERT_SCHEMA = T.StructType([
    T.StructField("s", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("t", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("prev_p", T.DoubleType()), T.StructField("p", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()), T.StructField("cooldown", T.IntegerType()),
    T.StructField("level", T.StringType()),
])


def _cooldown_scan(batches):
    """Sorted (s, label, segment, t, event_id) stream -> crossings that pass
    the cooldown: strictly more than ``cooldown`` seconds since the last sent
    alert of the same (symbol, label).  A segment's first crossing fires (or
    is the symbol's first); state carries across batches."""
    import pandas as pd

    last_key, last_sent = None, None
    for pdf in batches:
        keep = []
        s, lab, seg = pdf["s"].tolist(), pdf["label"].tolist(), pdf["segment"].tolist()
        t, cd = pdf["t"].tolist(), pdf["cooldown"].tolist()
        for i in range(len(pdf)):
            key = (s[i], lab[i], seg[i])
            if key != last_key:
                last_key, last_sent = key, 0
            ok = t[i] - last_sent > cd[i] * 1000
            if ok:
                last_sent = t[i]
            keep.append(ok)
        yield pdf[pd.Series(keep, index=pdf.index, dtype=bool)]


def alerts(ticks: DataFrame, thresholds: DataFrame) -> DataFrame:
    """st_alert_batch: alerts over stored ticks (batch twin of st_cross_alert)."""
    x = with_segment(crossings(exclude_codes(ticks), thresholds).select(*[f.name for f in ALERT_SCHEMA.fields]))
    ordered = (x.repartition("s", "label", "segment")
               .sortWithinPartitions("s", "label", "segment", "t", "event_id"))
    scanned = T.StructType([*ALERT_SCHEMA.fields, T.StructField("segment", T.LongType())])
    return ordered.mapInPandas(_cooldown_scan, scanned).drop("segment")


# --- fixed values: alert message parts ----------------------------------------
ALERT_EMOJI = {"critical": "🚨", "warning": "⚠️"}
ALERT_DIRECTION = {"upper": "▲ 升破", "lower": "▼ 跌破"}
# -----------------------------------------------------------------------------


def alert_text(a: DataFrame) -> DataFrame:
    """st_alert_text: '<emoji> [ LEVEL   ] SYMBOL <direction> label(threshold)：prev → price'."""
    emoji = F.when(F.col("level") == "critical", ALERT_EMOJI["critical"]).otherwise(ALERT_EMOJI["warning"])
    direction = F.when(F.col("label").contains("upper"), ALERT_DIRECTION["upper"]).otherwise(ALERT_DIRECTION["lower"])
    text = F.format_string("%s [ %-8s] %-6s %s %-12s(%8.3f)：%8.3f → %8.3f", emoji, F.upper("level"), F.col("s"),
                           direction, F.col("label"), F.col("threshold"), F.col("prev_p"), F.col("p"))
    return a.withColumn("text", text)


def tick_thresholds(ticks: DataFrame, lines: dict[str, float]) -> DataFrame:
    """Fixed threshold lines for every symbol seen in ``ticks``."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(lab).alias("label"), F.lit(float(v)).alias("threshold"),
                 F.lit(ALERT_LINES[lab][0]).alias("cooldown"), F.lit(ALERT_LINES[lab][1]).alias("level"))
        for lab, v in lines.items()]))
    return (ticks.select(F.col("s").alias("ticker")).distinct()
            .select("ticker", rows.alias("_r")).select("ticker", "_r.label", "_r.threshold", "_r.cooldown", "_r.level"))

