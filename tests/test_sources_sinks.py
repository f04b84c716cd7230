"""Incremental file source, Kafka message shape, monitor stream, alert text."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from candlewick.operators import ticks as tk
from candlewick.sources import fixtures as fx
from candlewick.sources.tables import read_modified_between
from candlewick.streaming import trades as st
from conftest import SF_SMALL


def test_incremental_source_reads_only_new_files(spark):
    root = tempfile.mkdtemp(prefix="cw-inc-")
    bars = fx.bars_wide(spark, SF_SMALL)
    bars.filter("ticker = 'S1'").coalesce(1).write.parquet(f"{root}/old")
    bars.filter("ticker = 'S2'").coalesce(1).write.parquet(f"{root}/new")
    old_ts = time.time() - 10 * 86400
    for dirpath, _, files in os.walk(f"{root}/old"):
        for f in files:
            os.utime(os.path.join(dirpath, f), (old_ts, old_ts))
    since = time.strftime("%Y-%m-%dT%H:%M:%S", time.localtime(time.time() - 86400))
    got = read_modified_between(spark, root, since, schema=bars.schema, time_zone=time.strftime("%Z") or "UTC")
    assert {r.ticker for r in got.select("ticker").distinct().collect()} == {"S2"}


def test_incremental_source_includes_its_bounds(spark):
    root = tempfile.mkdtemp(prefix="cw-mid-")
    bars = fx.bars_wide(spark, SF_SMALL).filter("ticker = 'S1'").coalesce(1)
    for name, stamp in (("before", 1_700_006_399), ("midnight", 1_700_006_400), ("next", 1_700_092_800)):
        bars.withColumn("ticker", F.lit(name)).write.parquet(f"{root}/{name}")
        for dirpath, _, files in os.walk(f"{root}/{name}"):
            for f in files:
                os.utime(os.path.join(dirpath, f), (stamp, stamp))
    got = read_modified_between(spark, root, "2023-11-15T00:00:00", "2023-11-16T00:00:00", schema=bars.schema, time_zone="UTC")
    assert {r.ticker for r in got.select("ticker").distinct().collect()} == {"midnight"}


def test_paths_landing_and_report_files(spark, tmp_path):
    from candlewick.sinks.files import write_report, write_tick_landing
    from candlewick.sources.tables import exclude_paths
    bars = fx.bars_wide(spark, SF_SMALL).limit(20)
    for name in ("us_W", "us_final_all", "conclusion"):
        bars.write.parquet(f"{tmp_path}/in/{name}")
    read = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    assert exclude_paths(read, "final_all", "conclusion").count() == 20
    ticks = fx.ticks(spark, SF_SMALL)
    write_tick_landing(ticks, f"{tmp_path}/land")
    assert spark.read.json(f"{tmp_path}/land").count() == ticks.count()
    mart = spark.createDataFrame([("A", "2024-01-01", None), ("B", "2024-01-02", "Long"), ("A", "2024-01-02", "Short")],
                                 "ticker string, Date_D string, Side_1_D string").withColumn("Date_D", F.to_date("Date_D"))
    write_report(mart, f"{tmp_path}/report")
    lines = [f"{r.Date_D} {r.ticker} {r.Side_1_D}" for r in spark.read.option("header", True).csv(f"{tmp_path}/report").collect()]
    assert lines == ["2024-01-02 A Short", "2024-01-02 B Long", "2024-01-01 A None"]


def test_malformed_topic_messages_are_dropped(spark):
    raw = spark.createDataFrame([('{"s": "A", "p": 1.0, "t": 5, "v": 1.0}', 1), ("{broken", 2), ("null", 3), ('{"p": 2}', 4)],
                                "value string, offset long")
    assert [(r.s, r.event_id) for r in st.parse_topic(raw).collect()] == [("A", 1)]


def test_envelope_keeps_the_order_of_arrival(spark):
    from candlewick.sources.records import parse_trade_envelopes
    trades = ", ".join(f'{{"s": "A", "p": {p}, "t": 7, "v": 1}}' for p in (5.0, 1.0, 9.0))
    df = parse_trade_envelopes(spark.createDataFrame([(f'{{"type": "trade", "data": [{trades}]}}',)], "value string"))
    ids = [(r.event_id, r.p) for r in st.with_event_id(df).orderBy("event_id").collect()]
    assert [p for _, p in ids] == [5.0, 1.0, 9.0] and all(i >= 0 for i, _ in ids)


def test_kafka_message_shape(spark):
    msgs = st.trades_to_kafka(fx.ticks(spark, SF_SMALL).select("s", "p", "t", "v", "c"))
    row = msgs.first()
    assert set(msgs.columns) == {"key", "value"} and row.key in row.value


def test_monitor_stream_lines(spark):
    root = tempfile.mkdtemp(prefix="cw-mon-")
    os.makedirs(f"{root}/in")
    msgs = fx.trade_messages(spark, SF_SMALL).limit(200).collect()
    with open(f"{root}/in/a.txt", "w") as fh:
        fh.write("\n".join(m.value for m in msgs) + "\n")
    q = st.start_monitor(st.envelope_file_stream(spark, f"{root}/in"), f"{root}/ck", sink="memory",
                         query_name="monitor_lines")
    q.processAllAvailable()
    q.stop()
    lines = spark.sql("SELECT line FROM monitor_lines").collect()
    assert lines and all(r.line.startswith("[") and "vol:" in r.line for r in lines)


def test_alert_text(spark):
    t = fx.ticks(spark, SF_SMALL)
    a = tk.alert_text(tk.alerts(t, tk.tick_thresholds(t, fx.TICK_LINES)))
    r = a.filter(F.col("label") == "upperband").first()
    assert r.text.startswith("🚨 [ CRITICAL]") and "▲" in r.text and "→" in r.text


def test_report_computes_its_input_once(spark):
    """The global sort samples its input for the ranges; the rows must not be made a second time for that."""
    import datetime

    from pyspark.sql import functions as F

    from candlewick.sinks.files import report_frame
    made = spark.sparkContext.accumulator(0)

    def note(n):
        made.add(1)
        return n
    rows = [(f"T{i % 7}", datetime.date(2020, 1, 1) + datetime.timedelta(days=i % 30), i) for i in range(200)]
    rows += [(None, None, None), ("T1", None, 5)]
    frame = spark.createDataFrame(rows, "ticker string, Date_D date, n int").repartition(4)
    noted = frame.select("ticker", "Date_D", F.udf(note, "int").asNondeterministic()("n").alias("n"))
    got = [tuple(r) for r in report_frame(noted).collect()]
    assert made.value == len(rows)
    text = lambda v: "None" if v is None else str(v)
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or datetime.date.min).toordinal(), r[0] is not None, r[0] or ""))
    assert [(t, d) for t, d, _ in got] == [(text(t), text(d)) for t, d, _ in order]
    assert sorted(got) == sorted(tuple(map(text, r)) for r in rows)
