"""Tick operators: alerts against a brute-force replay, and the streaming
query against its batch twin, across micro-batches and a restart."""

import os
import tempfile

from pyspark.sql import functions as F

from candlewick.operators import ticks as tk
from candlewick.sources import fixtures as fx
from candlewick.streaming import trades as st
from conftest import SF_SMALL

LINES = fx.TICK_LINES


def brute_alerts(rows):
    """rows: (event_id, s, p, t, c) in any order -> set of (s, label, t)."""
    prev, last, out = {}, {}, set()
    for eid, s, p, t, c in sorted(rows, key=lambda r: (r[3], r[0])):
        if c and set(c) & {"24", "25"}:
            continue
        q = prev.get(s)
        if q is not None:
            for lab, thr in LINES.items():
                up = "upper" in lab
                crossed = (q <= thr < p) if up else (q >= thr > p)
                if crossed and t - last.get((s, lab), 0) > tk.ALERT_LINES[lab][0] * 1000:
                    out.add((s, lab, t))
                    last[(s, lab)] = t
        prev[s] = p
    return out


def test_batch_alerts_match_brute_force(spark):
    t = fx.ticks(spark, SF_SMALL)
    rows = [(r.event_id, r.s, r.p, r.t, r.c) for r in t.collect()]
    got = {(r.s, r.label, r.t) for r in tk.alerts(t, tk.tick_thresholds(t, LINES)).collect()}
    assert got == brute_alerts(rows)
    assert len(got) > 0


def test_previous_price_with_negative_ids(spark):
    rows = [("A", 1.0, 999, 2 ** 62), ("A", 2.0, 1000, -5), ("A", 3.0, 1000, 7), ("A", 4.0, 2000, -(2 ** 63)), ("B", 9.0, 0, -1)]
    df = spark.createDataFrame(rows, "s string, p double, t long, event_id long")
    for bucket in (500, 1000, 10 ** 9):
        got = {r.p: r.prev_p for r in tk.with_previous_price(df, bucket_ms=bucket).collect()}
        assert got == {1.0: None, 2.0: 1.0, 3.0: 2.0, 4.0: 3.0, 9.0: None}


def test_one_symbol_is_cut_into_segments(spark):
    t = fx.ticks(spark, SF_SMALL).withColumn("s", F.lit("HOT"))
    rows = [(r.event_id, r.s, r.p, r.t, r.c) for r in t.collect()]
    th = tk.tick_thresholds(t, LINES)
    assert {(r.s, r.label, r.t) for r in tk.alerts(t, th).collect()} == brute_alerts(rows)
    x = tk.crossings(tk.exclude_codes(t), th)
    for bucket in (60_000, 3_600_000):
        segments = tk.with_segment(x, bucket).select("label", "segment", "t").collect()
        assert len({(r.label, r.segment) for r in segments}) > 20 and all(r.segment <= r.t for r in segments)


def test_previous_price_across_buckets(spark):
    t = fx.ticks(spark, SF_SMALL)
    small = tk.with_previous_price(t, bucket_ms=60_000).select("event_id", "prev_p").collect()
    big = tk.with_previous_price(t, bucket_ms=10 ** 12).select("event_id", "prev_p").collect()
    assert sorted(small, key=lambda r: r.event_id) == sorted(big, key=lambda r: r.event_id)


def test_stream_alerts_equal_batch_twin_with_restart(spark):
    t = fx.ticks(spark, SF_SMALL).orderBy("t", "event_id")
    rows = [(r.event_id, r.s, r.p, r.t, r.c) for r in t.collect()]
    thresholds = tk.tick_thresholds(t, LINES)
    root = tempfile.mkdtemp(prefix="cw-stream-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    # envelopes in time order, split over several files -> several micro-batches
    msgs = fx.trade_messages(spark, SF_SMALL).collect()
    chunks = [msgs[i:i + 250] for i in range(0, len(msgs), 250)]

    def write_chunk(i):
        path = os.path.join(src, f"part-{i:04d}.txt")
        with open(path, "w") as fh:
            fh.write("\n".join(m.value for m in chunks[i]) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))   # arrival order = time order

    half = len(chunks) // 2
    for i in range(half):
        write_chunk(i)
    ckpt = os.path.join(root, "ckpt")
    stream = st.envelope_file_stream(spark, src, files_per_trigger=1)
    out = os.path.join(root, "alerts")
    q = st.start_alerts(stream, thresholds, ckpt, path=out, query_name="alerts_a")
    q.processAllAvailable()
    q.stop()
    first = {(r.s, r.label, r.t) for r in spark.read.parquet(out).collect()}
    for i in range(half, len(chunks)):
        write_chunk(i)
    q = st.start_alerts(st.envelope_file_stream(spark, src, files_per_trigger=1), thresholds, ckpt,
                        path=out, query_name="alerts_b")
    q.processAllAvailable()
    q.stop()
    all_rows = [(r.s, r.label, r.t) for r in spark.read.parquet(out).collect()]
    expected = brute_alerts([r for r in rows if r[1] != "error"])
    assert set(all_rows) == expected
    assert len(all_rows) == len(set(all_rows))      # exactly once across the restart
    assert first and first < set(all_rows)


def test_landing_sink_partitions(spark):
    root = tempfile.mkdtemp(prefix="cw-land-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    msgs = fx.trade_messages(spark, SF_SMALL).limit(300).collect()
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("\n".join(m.value for m in msgs) + "\n")
    out = os.path.join(root, "out")
    q = st.start_landing(st.envelope_file_stream(spark, src), out, os.path.join(root, "ck"), trigger_seconds=1)
    q.processAllAvailable()
    q.stop()
    landed = spark.read.json(out)
    assert set(landed.columns) >= {"s", "date", "p", "t"}
    from candlewick.sources.records import parse_trade_envelopes
    kept = tk.exclude_codes(parse_trade_envelopes(spark.read.text(src)))
    assert landed.count() == kept.count()
    assert landed.filter(F.col("s").isNull()).count() == 0


def test_realtime_runs_its_three_queries_together(spark):
    root = tempfile.mkdtemp(prefix="cw-real-")
    os.makedirs(f"{root}/in")
    msgs = [m.value for m in fx.trade_messages(spark, SF_SMALL).collect()] + ["{broken", '{"type": "ping"}']
    with open(f"{root}/in/a.txt", "w") as fh:
        fh.write("\n".join(msgs) + "\n")
    t = fx.ticks(spark, SF_SMALL)
    queries = st.start_realtime(lambda: st.envelope_file_stream(spark, f"{root}/in"), tk.tick_thresholds(t, LINES), root, 1)
    for q in queries:
        q.processAllAvailable()
    for q in queries:
        q.stop()
    kept = tk.exclude_codes(t.filter("s <> 'error'"))
    assert spark.read.json(f"{root}/landing").count() == spark.table("monitor").count() == kept.count()
    rows = [(r.event_id, r.s, r.p, r.t, r.c) for r in kept.collect()]
    assert {(r.s, r.label, r.t) for r in spark.read.parquet(f"{root}/alerts").collect()} == brute_alerts(rows)


def write_trades(folder, n, rows):
    """One envelope file; later files have later modification times."""
    import json

    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"part-{n:04d}.txt")
    with open(path, "w") as fh:
        for i in range(0, len(rows), 50):
            data = [{"s": s, "p": p, "t": t, "v": 1.0} for s, p, t in rows[i:i + 50]]
            fh.write(json.dumps({"type": "trade", "data": data}) + "\n")
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def test_one_symbol_in_batches_of_any_size(spark, tmp_path):
    """One symbol, mixed order inside a micro-batch, batches of 1 and of 4 files, with a restart."""
    import random

    rng = random.Random(3)
    ticks = [("HOT", round(100 + 10 * rng.random(), 2), 1_000_000 + i * 700) for i in range(1_200)]
    flat = [(i, s, p, t, None) for i, (s, p, t) in enumerate(ticks)]
    th = spark.createDataFrame([("HOT", lab, thr, 60, "x") for lab, thr in
                                (("upperband", 108.0), ("lowerband", 102.0), ("upper_1_7", 106.0), ("lower_1_7", None))],
                               "ticker string, label string, threshold double, cooldown int, level string")
    lines = {"upperband": 108.0, "lowerband": 102.0, "upper_1_7": 106.0}
    want = {(s, lab, t) for s, lab, t in brute_alerts_at(flat, lambda lab, t: lines.get(lab))}
    for size in (1, 4):
        root = f"{tmp_path}/{size}"
        for i in range(12):
            part = ticks[i * 100:(i + 1) * 100]
            rng.shuffle(part)
            write_trades(f"{root}/in", i, part)
            if i == 5:  # first half, then a restart
                q = st.start_alerts(st.envelope_file_stream(spark, f"{root}/in", size), th, f"{root}/ck", path=f"{root}/out")
                q.processAllAvailable()
                q.stop()
        q = st.start_alerts(st.envelope_file_stream(spark, f"{root}/in", size), th, f"{root}/ck", path=f"{root}/out")
        q.processAllAvailable()
        q.stop()
        got = [(r.s, r.label, r.t) for r in spark.read.parquet(f"{root}/out").collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 10


def brute_alerts_at(rows, line_at):
    prev, last, out = {}, {}, set()
    for _, s, p, t, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        if s in prev:
            for lab, (cooldown, _) in tk.ALERT_LINES.items():
                thr = line_at(lab, t)
                q = prev[s]
                if thr is not None and ((q <= thr < p) if "upper" in lab else (q >= thr > p)) \
                        and t - last.get((s, lab), 0) > cooldown * 1000:
                    out.add((s, lab, t))
                    last[(s, lab)] = t
        prev[s] = p
    return out


def test_new_thresholds_reach_a_running_query(spark, tmp_path):
    import random

    rng = random.Random(8)
    ticks = [("N", round(100 + 10 * rng.random(), 2), 1_000_000 + i * 2_000) for i in range(600)]
    flat = [(i, s, p, t, None) for i, (s, p, t) in enumerate(ticks)]
    th = spark.createDataFrame([("N", "upperband", 109.0, 60, "x"), ("Z", "upperband", 1.0, 60, "x")],
                               "ticker string, label string, threshold double, cooldown int, level string")
    change = {0: (1_300_000, 104.0), 1: (1_900_000, 107.5)}
    for i in range(3):
        write_trades(f"{tmp_path}/in", i, ticks[i * 200:(i + 1) * 200])
    schema = "ticker string, label string, threshold double, t long"
    os.makedirs(f"{tmp_path}/news")
    news = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/news")

    def write_news(i):
        at, value = change[i]
        with open(f"{tmp_path}/news/n{i}.json", "w") as fh:
            fh.write('{"ticker": "N", "label": "upperband", "threshold": %s, "t": %d}\n' % (value, at))

    def run():
        q = st.start_alerts(st.envelope_file_stream(spark, f"{tmp_path}/in", 1), th, f"{tmp_path}/ck", path=f"{tmp_path}/out",
                            updates=news())
        q.processAllAvailable()
        q.stop()

    write_news(0)
    run()  # the message comes with the first trades
    write_news(1)
    write_trades(f"{tmp_path}/in", 3, [("N", p, t + 1_200_000) for _, p, t in ticks[:200]])
    run()  # after a restart the changed line still holds, until the next message
    flat += [(10_000 + i, "N", p, t + 1_200_000, None) for i, (_, p, t) in enumerate(ticks[:200])]

    def line_at(lab, t):
        if lab != "upperband":
            return None
        return 109.0 if t < 1_300_000 else 104.0 if t < 1_900_000 or t < 2_200_000 else 107.5

    got = {(r.s, r.label, r.t) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == brute_alerts_at(flat, line_at) and len(got) > 5


def test_alerts_need_their_state_store(spark):
    import pytest

    t = fx.ticks(spark, SF_SMALL)
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(RuntimeError):
            st.cross_alerts(t, tk.tick_thresholds(t, LINES))
    finally:
        spark.conf.set(key, st.STATE_STORE)
