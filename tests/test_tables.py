"""Upserts, screen, windows and fixtures (properties and small cases)."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from candlewick.operators.screen import screen
from candlewick.operators.upsert import (upsert_company_list, upsert_gold_history, upsert_snapshot,
                                         warehouse_merge)
from candlewick.operators.windows import dedupe_priority, drop_latest_n, latest_row
from candlewick.sources import fixtures as fx
from conftest import SF_SMALL


def test_company_list_first_run_and_vanished(spark):
    old = spark.createDataFrame([Row(cik=1, ticker="A", title="a", last_updated=None, is_active=True),
                                 Row(cik=2, ticker="B", title="b", last_updated=None, is_active=True)],
                                "cik bigint, ticker string, title string, last_updated timestamp, is_active boolean")
    new = spark.createDataFrame([(2, "B", "b2"), (3, "C", "c")], "cik bigint, ticker string, title string")
    first = upsert_company_list(None, new, "2024-02-01 00:00:00").collect()
    assert {r.ticker for r in first} == {"B", "C"} and all(r.is_active for r in first)
    out = {r.ticker: r for r in upsert_company_list(old, new, "2024-02-01 00:00:00").collect()}
    assert out["A"].is_active is False and out["B"].title == "b2" and out["C"].is_active


def test_snapshot_upsert_idempotent(spark):
    f = fx.fundamentals(spark, SF_SMALL).select("created_at", "ticker", "market_cap")
    once = upsert_snapshot(f, f)
    twice = upsert_snapshot(once, f)
    assert once.count() == f.count() == twice.count()
    assert once.select("created_at", "ticker").distinct().count() == once.count()


def test_gold_history_keeps_old_and_releases_newest_two(spark):
    old = spark.createDataFrame(
        [("2024-01-0%d" % d, "A", "D", float(d)) for d in range(1, 6)] + [("2024-01-01", "B", "D", 9.0)],
        "Date string, ticker string, period string, Close double").withColumn("Date", F.to_date("Date"))
    new = spark.createDataFrame(
        [("2024-01-0%d" % d, "A", "D", 100.0 + d) for d in range(1, 7)],
        "Date string, ticker string, period string, Close double").withColumn("Date", F.to_date("Date"))
    out = {(str(r.Date), r.ticker): r.Close for r in upsert_gold_history(old, new).collect()}
    assert out[("2024-01-01", "A")] == 1.0          # old wins
    assert out[("2024-01-04", "A")] == 104.0        # newest 2 old rows released
    assert out[("2024-01-06", "A")] == 106.0        # new date inserted
    assert out[("2024-01-01", "B")] == 9.0          # untouched ticker
    key = upsert_gold_history(old, new).groupBy("Date", "ticker", "period").count()
    assert key.filter("count > 1").count() == 0


def test_warehouse_merge_replaces_staged_keys(spark):
    t = spark.createDataFrame([("2024-01-0%d" % d, "A", "W", float(d)) for d in range(1, 5)],
                              "Date string, ticker string, period string, Close double").withColumn("Date", F.to_date("Date"))
    s = spark.createDataFrame([("2024-01-02", "A", "W", 20.0)],
                              "Date string, ticker string, period string, Close double").withColumn("Date", F.to_date("Date"))
    out = {str(r.Date): r.Close for r in warehouse_merge(t, s).collect()}
    # newest two dates of A (03, 04) deleted; 02 replaced by the staged row
    assert out == {"2024-01-01": 1.0, "2024-01-02": 20.0}


def test_screen_tiers_first_match_wins(spark):
    f = fx.fundamentals(spark, SF_SMALL)
    s = screen(f)
    assert s.filter(F.col("is_selected").isNull()).count() == 0
    tiers = {r.is_selected for r in s.select("is_selected").distinct().collect()}
    assert {"HighGrowth", "Magnificent_8", "ETF_1"} <= tiers
    assert s.groupBy("ticker").count().filter("count > 1").count() == 0
    aapl = s.filter(F.col("ticker") == "AAPL").collect()
    assert aapl and aapl[0].is_selected in ("HighGrowth", "SteadyGrowth", "Distressed", "Super", "Magnificent_8")


def test_window_helpers(spark):
    df = spark.createDataFrame([("A", 1, 0), ("A", 2, 0), ("A", 3, 0), ("B", 1, 0)], "ticker string, Date int, _p int")
    assert {(r.ticker, r.Date) for r in latest_row(df).collect()} == {("A", 3), ("B", 1)}
    assert {(r.ticker, r.Date) for r in drop_latest_n(df, 2).collect()} == {("A", 1)}
    assert dedupe_priority(df.unionByName(df), ["ticker", "Date"], "_p").count() == 4


def test_fundamentals_names_round_trip(spark, tmp_path):
    from candlewick.schemas import fundamentals_to_ascii, fundamentals_to_reference
    f = fx.fundamentals(spark, SF_SMALL)
    ref = fundamentals_to_reference(f)
    assert "市值" in ref.columns and "ROE" in ref.columns
    ref.write.parquet(str(tmp_path / "fund"))            # names with CJK, '/', '(' round-trip
    back = fundamentals_to_ascii(spark.read.parquet(str(tmp_path / "fund")))
    assert sorted(back.columns) == sorted(f.columns)
    assert screen(back).count() == screen(f).count()


def test_truncate_survives_nan_infinity_and_large_values(spark):
    from candlewick.functions.scalars import truncate
    values = [1.239, -1.239, 0.0, -0.001, float("nan"), float("inf"), 1e17, -1e300, 123456.785, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(truncate(F.col("v"), 2)).collect()]
    assert got == [1.23, -1.23, 0.0, 0.0, None, float("inf"), 1e17, -1e300, 123456.78, None]


def test_fundamentals_reach_the_screen(spark):
    from candlewick.plans.jobs import job_fundamentals, job_screen
    from candlewick.schemas import FUNDAMENTAL_COLUMNS
    info = fx.fundamentals_info(spark, SF_SMALL)
    table = job_fundamentals(info, fx.part_daily(spark, SF_SMALL), None)
    assert len(table.columns) == 27 and {a for _, a in FUNDAMENTAL_COLUMNS} <= set(table.columns)
    rows = {r["ticker"]: r for r in table.collect()}
    assert rows["P17"]["eps_forward"] is None and rows["P19"]["net_income"] == 1e17
    assert rows["P5"]["all_time_high_ratio"] is not None and rows["P150"]["all_time_high_ratio"] is None
    assert job_screen(table, None).count() > 0
    bad = info.withColumn("ticker", F.when(F.col("ticker") != "P9", F.col("ticker")))
    try:
        job_fundamentals(bad, None, table).collect()
    except Exception as e:  # noqa: BLE001
        assert "NULL in key column ticker" in str(e)
    else:
        raise AssertionError("a NULL key must fail the job")


def test_high_ratios_by_hand(spark):
    from candlewick.sources.records import high_ratios, with_high_ratios
    daily = spark.createDataFrame([("A", "2020-01-01", 50.0), ("A", "2021-06-01", 30.0), ("A", "2022-01-01", 20.0),
                                   ("B", "2022-01-01", 0.0), ("C", "2021-01-01", None), ("C", "2020-12-01", 4.0)],
                                  "ticker string, Date string, Close double").withColumn("Date", F.to_date("Date"))
    rows = spark.createDataFrame([("A", None), ("B", "1"), ("C", "1.0"), ("D", "3")], "ticker string, current_price string")
    rows = rows.select("*", F.lit(None).cast("double").alias("all_time_high_ratio"), F.lit(None).cast("double").alias("high_52w_ratio"))
    got = {r[0]: tuple(r[1:]) for r in with_high_ratios(rows, high_ratios(daily)).collect()}
    assert got == {"A": (20.0, 0.4, 0.66), "B": (1.0, None, None), "C": (1.0, 0.25, 0.25), "D": (3.0, None, None)}


def test_equal_keys_of_one_batch_do_not_depend_on_order(spark):
    rows = [("A", "W", "2024-01-07", float(i)) for i in range(20)]
    schema = "ticker string, period string, Date string, Close double"
    old = spark.createDataFrame([("A", "W", "2023-01-01", 1.0)], schema)
    picked = {tuple(upsert_gold_history(old, spark.createDataFrame(r, schema).repartition(k)).filter("Close <> 1").collect())
              for k, r in ((1, rows), (3, rows[::-1]), (7, rows[5:] + rows[:5]))}
    assert len({p for p in picked}) == 1


def test_set_difference_ignores_repeats(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "ticker string")
    assert [r[0] for r in a.subtract(a.filter("ticker = 'x'").distinct()).collect()] == ["y"]


def test_packed_key_guards_its_widths(spark):
    from candlewick.sources.fixtures import _packed_key
    li = spark.createDataFrame([(1, 7, 10 ** 12)], "l_orderkey long, l_linenumber int, l_partkey long")
    try:
        li.select(_packed_key(F.lit(5).cast("bigint"))).collect()
    except Exception as e:  # noqa: BLE001
        assert "l_partkey has over 12 digits" in str(e)
    else:
        raise AssertionError("an oversized component must fail")
    ok = li.withColumn("l_partkey", F.lit(3).cast("bigint")).select(_packed_key(F.lit(5).cast("bigint"))).first()[0]
    assert int(ok) == 10 ** 22 + 7 * 10 ** 20 + 3 * 10 ** 8 + 5
