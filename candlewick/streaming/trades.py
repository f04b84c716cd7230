"""Structured Streaming versions of the live-trade jobs (job_realtime):
st_filter, st_landing, st_monitor and st_cross_alert.

Each consumer purpose of the reference is one streaming query with its own
checkpoint (the checkpoint replaces the consumer group and its offsets).
Sources: a directory of envelope JSON files (tests, replay) or Kafka when the
connector is on the classpath (it is not bundled here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from candlewick.operators.ticks import ALERT_LINES, exclude_codes, monitor_lines
from candlewick.sources.records import parse_trade_envelopes


#: Intake per micro-batch: what bounds the work of one hot symbol in one batch.
FILES_PER_TRIGGER = 1_000
OFFSETS_PER_TRIGGER = 1_000_000


def envelope_file_stream(spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """src_trades_stream over a directory of envelope messages (one JSON text
    per line), at most ``files_per_trigger`` files a micro-batch."""
    return parse_trade_envelopes(spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path))


def kafka_stream(spark: SparkSession, servers: str, topic: str = "trades",
                 offsets_per_trigger: int = OFFSETS_PER_TRIGGER) -> DataFrame:
    """src_trades_stream over Kafka (key = symbol, value = trade JSON), at most
    ``offsets_per_trigger`` messages a micro-batch; malformed JSON is dropped.
    Needs the spark-sql-kafka connector on the classpath."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", "earliest")
           .option("maxOffsetsPerTrigger", offsets_per_trigger).load())
    return parse_topic(raw)


def parse_topic(raw: DataFrame) -> DataFrame:
    """Topic messages (value, offset) -> trades; what is no trade is dropped."""
    from candlewick.schemas import TRADE

    # messages are keyed by symbol, so a symbol's trades share one topic
    # partition and the offset is their arrival order: the tie-break for
    # equal event times, as in the reference's arrival-order processing
    return (raw.select(F.from_json(F.col("value").cast("string"), TRADE).alias("d"),
                       F.col("offset").alias("event_id"))
            .select("d.*", "event_id").filter("s IS NOT NULL AND t IS NOT NULL"))


def trades_to_kafka(trades: DataFrame) -> DataFrame:
    """snk_trades_topic: key = symbol, value = the trade as JSON."""
    return trades.select(F.col("s").alias("key"), F.to_json(F.struct(*trades.columns)).alias("value"))


def with_event_id(trades: DataFrame) -> DataFrame:
    """A tie-break for equal event times: the position inside the envelope where
    it is known (``pos``), then a hash of the trade."""
    if "event_id" in trades.columns:
        return trades
    own = F.xxhash64("s", "t", "p", "v")
    if "pos" in trades.columns:
        own = F.shiftleft(F.col("pos").cast("bigint"), 40) + F.pmod(own, F.lit(1 << 40))
    return trades.withColumn("event_id", own)


def start_landing(trades: DataFrame, out_path: str, checkpoint: str, trigger_seconds: int = 600,
                  tz: str = "America/New_York"):
    """st_landing: JSON files partitioned by symbol and local trade date;
    the checkpoint makes the file output exactly-once."""
    from candlewick.operators.ticks import local_time
    date = F.to_date(local_time(F.col("t"), tz))
    return (exclude_codes(trades).drop("pos").withColumn("date", date).writeStream.format("json")
            .option("path", out_path).option("checkpointLocation", checkpoint)
            .partitionBy("s", "date").trigger(processingTime=f"{trigger_seconds} seconds").start())


def start_monitor(trades: DataFrame, checkpoint: str, sink: str = "console", query_name: str = "monitor"):
    """st_monitor: one formatted line per trade."""
    return (monitor_lines(exclude_codes(trades)).writeStream.format(sink).queryName(query_name)
            .option("checkpointLocation", checkpoint).outputMode("append").start())


# ----------------------------------------------------------------------------
# st_cross_alert: stateful threshold-cross alerts per symbol
# ----------------------------------------------------------------------------

LABELS = list(ALERT_LINES)
ALERT_OUT = T.StructType([
    T.StructField("s", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("t", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("prev_p", T.DoubleType()), T.StructField("p", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()), T.StructField("level", T.StringType()),
])
#: the state store that the alert query needs (value and map states)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def thresholds_wide(thresholds: DataFrame) -> DataFrame:
    """Threshold rows (ticker, label, threshold, ...) -> one row per ticker."""
    return thresholds.groupBy(F.col("ticker").alias("s")).pivot("label", LABELS).agg(F.first("threshold"))


class CrossAlerts(StatefulProcessor):
    """Per symbol: the previous price (value state), the time of the last alert sent
    and the threshold by line (map states).

    Of a micro-batch's rows of one symbol only times, ids and prices are held, as
    plain arrays (24 bytes a trade; the intake bounds their number); they are put in
    (t, event_id) order and compared as arrays, so only crossings are looped over.
    A threshold message counts for trades from its time on and replaces the
    line's threshold for good.  ``idle_ms`` lets the states of a symbol that sends
    nothing for so long expire."""

    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.previous = handle.getValueState("previous", "p double", self.idle_ms)
        self.sent = handle.getMapState("sent", "label string", "t long", self.idle_ms)
        self.lines = handle.getMapState("lines", "label string", "threshold double", self.idle_ms)

    def handleInputRows(self, key, rows, timerValues):
        import numpy as np
        import pandas as pd

        parts, updates, static = [], [], {}
        for pdf in rows:
            news = pdf["label"].notna().to_numpy()
            if news.any():
                updates += list(pdf.loc[news, ["t", "label", "threshold"]].itertuples(index=False, name=None))
            trades = pdf[~news]
            if len(trades):
                static = {lab: float(trades[lab].iloc[0]) for lab in LABELS}
                parts.append([trades[c].to_numpy() for c in ("t", "event_id", "p")])
        updates.sort(key=lambda u: u[0])
        held = {lab: (self.lines.getValue((lab,))[0] if self.lines.containsKey((lab,)) else static.get(lab, np.nan)) for lab in LABELS}
        out = []
        if parts:
            t, event, price = (np.concatenate([x[i] for x in parts]) for i in range(3))
            order = np.lexsort((event, t))
            t, event, price = t[order].astype(np.int64), event[order].astype(np.int64), price[order].astype(np.float64)
            first = self.previous.get()[0] if self.previous.exists() else np.nan
            before = np.concatenate([[np.nan if first is None else first], price[:-1]])
            for lab in LABELS:
                own = [(at, value) for at, name, value in updates if name == lab]
                line = np.full(len(t), held[lab])
                for at, value in own:  # few: one per message about this line
                    line[np.searchsorted(t, at):] = value
                crossed = ((before <= line) & (line < price)) if "upper" in lab else ((before >= line) & (line > price))
                hits = np.flatnonzero(crossed)
                if not len(hits):
                    continue
                cooldown, level = ALERT_LINES[lab]
                last = self.sent.getValue((lab,))[0] if self.sent.containsKey((lab,)) else 0
                at = 0
                while at < len(hits):  # one step per alert sent
                    at += int(np.searchsorted(t[hits[at:]], last + cooldown * 1000, side="right"))
                    if at < len(hits):
                        i = hits[at]
                        last = int(t[i])
                        out.append((key[0], lab, last, int(event[i]), float(before[i]), float(price[i]), float(line[i]), level))
                        at += 1
                self.sent.updateValue((lab,), (last,))
            self.previous.update((float(price[-1]),))
        for _, lab, value in updates:
            self.lines.updateValue((lab,), (float(value),))
        yield pd.DataFrame(out, columns=[f.name for f in ALERT_OUT.fields])

    def close(self) -> None:
        pass


def cross_alerts(trades: DataFrame, thresholds: DataFrame, broadcast_thresholds: bool = False,
                 updates: DataFrame | None = None, idle_ms: int | None = None) -> DataFrame:
    """st_cross_alert over a streaming trade DataFrame.

    ``thresholds`` is a static table, one row per symbol after pivoting; a
    caller that knows it to be small may have it broadcast.  ``updates`` is a
    stream of (ticker, label, threshold, t): new thresholds reach the running
    query without a restart.  The session's state store must be ``STATE_STORE``."""
    spark = trades.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STATE_STORE:
        raise RuntimeError(f"set spark.sql.streaming.stateStore.providerClass to {STATE_STORE}")
    t = with_event_id(exclude_codes(trades)).select("s", "p", "t", "event_id")
    lines = thresholds_wide(thresholds)
    j = t.join(F.broadcast(lines) if broadcast_thresholds else lines, "s", "left")
    j = j.withColumn("label", F.lit(None).cast("string")).withColumn("threshold", F.lit(None).cast("double"))
    if updates is not None:
        news = updates.filter("ticker IS NOT NULL AND label IS NOT NULL AND t IS NOT NULL")
        j = j.unionByName(news.select(F.col("ticker").alias("s"), F.col("label"), F.col("threshold").cast("double"),
                                      F.col("t").cast("long").alias("t")), allowMissingColumns=True)
    return j.groupBy("s").transformWithStateInPandas(CrossAlerts(idle_ms), ALERT_OUT, "Append",
                                                     "ProcessingTime" if idle_ms else "None")


def start_alerts(trades: DataFrame, thresholds: DataFrame, checkpoint: str, sink: str = "parquet",
                 path: str | None = None, query_name: str = "alerts", updates: DataFrame | None = None):
    """Alert query; a file sink (default) is exactly-once across restarts with
    the checkpoint, the memory sink is for interactive use only."""
    w = (cross_alerts(trades, thresholds, updates=updates).writeStream.format(sink).queryName(query_name)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if path is not None:
        w = w.option("path", path)
    return w.start()


def start_realtime(trades, thresholds: DataFrame, root: str, landing_seconds: int = 600) -> list:
    """job_realtime: landing, monitor and alerts as three queries over the trade
    stream that ``trades()`` opens, each with its own checkpoint under ``root``."""
    return [start_landing(trades(), f"{root}/landing", f"{root}/checkpoints/landing", landing_seconds),
            start_monitor(trades(), f"{root}/checkpoints/monitor", sink="memory", query_name="monitor"),
            start_alerts(trades(), thresholds, f"{root}/checkpoints/alerts", path=f"{root}/alerts")]
