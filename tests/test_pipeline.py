"""Written stage boundaries: silver -> gold -> versioned history -> mart."""

import os
import tempfile

from candlewick.plans import pipeline as P
from candlewick.sinks.files import current_version
from candlewick.sources import fixtures as fx
from candlewick.sources.tables import read_table, with_period_from_path, with_ticker_from_path
from conftest import SF_SMALL


def test_pipeline_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="cw-pipe-")
    bronze = fx.bronze(spark, SF_SMALL)
    P.run_silver(bronze, f"{root}/silver")
    P.run_gold(spark, f"{root}/silver", f"{root}/gold")
    v1 = P.run_history(spark, f"{root}/gold", f"{root}/history")
    v2 = P.run_history(spark, f"{root}/gold", f"{root}/history")   # re-run: idempotent
    assert v1 != v2 and current_version(spark, f"{root}/history") == v2
    h1, h2 = spark.read.parquet(v1), spark.read.parquet(v2)
    assert h1.count() == h2.count() == spark.read.parquet(f"{root}/gold").count()
    P.run_conclusion(spark, v2, f"{root}/mart")
    mart = spark.read.parquet(f"{root}/mart")
    assert mart.count() > 0 and "Side_3_3M" in mart.columns
    assert sorted(os.listdir(f"{root}/gold"))[0].startswith("period=") or any(
        d.startswith("period=") for d in os.listdir(f"{root}/gold"))


def test_sources_paths_and_first_run(spark):
    root = tempfile.mkdtemp(prefix="cw-src-")
    assert read_table(spark, f"{root}/missing") is None
    bars = fx.bars_wide(spark, SF_SMALL).limit(50)
    bars.coalesce(1).write.parquet(f"{root}/tmp")
    import glob
    import shutil
    part = glob.glob(f"{root}/tmp/*.parquet")[0]
    os.makedirs(f"{root}/in")
    shutil.copy(part, f"{root}/in/us_2W.parquet")
    df = with_period_from_path(with_ticker_from_path(spark.read.parquet(f"{root}/in"), "stem"))
    rows = df.select("stem", "period").distinct().collect()
    assert [(r.stem, r.period) for r in rows] == [("us_2W", "2W")]


def _days(spark, closes, ticker="A", period="W"):
    from pyspark.sql import functions as F
    rows = [(f"2024-01-{d:02d}", ticker, period, float(c)) for d, c in closes]
    return spark.createDataFrame(rows, "Date string, ticker string, period string, Close double").withColumn("Date", F.to_date("Date"))


def test_history_survives_a_failed_write_and_a_lost_marker(spark):
    from pyspark.sql import functions as F

    from candlewick.sinks.files import write_version
    root = tempfile.mkdtemp(prefix="cw-hist-") + "/history"
    assert current_version(spark, root) is None                    # first run: the root does not exist
    v1 = write_version(_days(spark, [(1, 1), (2, 2)]), root)
    broken = _days(spark, [(3, 3)]).withColumn("Close", F.raise_error(F.lit("midway")).cast("double"))
    try:
        write_version(broken, root)
    except Exception as e:  # noqa: BLE001
        assert "midway" in str(e)
    assert len(os.listdir(root)) >= 1 and current_version(spark, root).endswith(os.path.basename(v1))
    os.remove(f"{v1}/_SUCCESS")                                     # no committed version is left: an error, no first run
    try:
        current_version(spark, root)
    except RuntimeError as e:
        assert "no committed version" in str(e)
    else:
        raise AssertionError("a root without a committed version must not pass for a first run")


def test_history_is_ordered_newest_first(spark):
    rows = _days(spark, [(d, d) for d in range(1, 20)], "B").unionByName(_days(spark, [(d, d) for d in range(1, 20)], "A"))
    got = [(str(r.Date), r.ticker) for r in P.history_order(rows.coalesce(1)).collect()]
    assert got == sorted(sorted(got, key=lambda r: r[1]), key=lambda r: r[0], reverse=True)


def test_staged_merge_leaves_other_periods_alone(spark):
    root = tempfile.mkdtemp(prefix="cw-part-") + "/wh"
    week = P.run_staged_merge(spark, root, _days(spark, [(1, 1), (2, 2)]), "W")
    P.run_staged_merge(spark, root, _days(spark, [(1, 5)], period="ME"), "ME")
    P.run_staged_merge(spark, root, _days(spark, [(1, 6)], period="ME"), "ME")
    assert current_version(spark, f"{root}/period=W").endswith(os.path.basename(week))
    got = sorted((r.period, r.Close) for r in P.read_warehouse(spark, root).collect())
    assert got == [("ME", 6.0), ("W", 1.0), ("W", 2.0)]


def test_silver_of_a_day(spark):
    import time

    from candlewick.plans.jobs import job_silver_of_day
    root = tempfile.mkdtemp(prefix="cw-day-")
    bronze = fx.bronze(spark, SF_SMALL).drop("ticker")
    bronze.coalesce(1).write.parquet(f"{root}/x")
    day = time.strftime("%Y-%m-%dT00:00:00", time.gmtime())
    from pyspark.sql.types import StructType
    schema = StructType(bronze.schema.fields)
    from candlewick.sources.tables import read_modified_between
    got = read_modified_between(spark, root, day, schema=schema, time_zone="UTC")
    assert got.count() == bronze.count()
    silver, audit = job_silver_of_day(spark, root, "2001-01-01T00:00:00", "2001-01-02T00:00:00", schema=schema)
    assert silver.count() == 0 and audit.count() == 0               # a day without files
    silver, audit = job_silver_of_day(spark, root, "2001-01-01T00:00:00", schema=schema)
    assert silver.count() == audit.first()["kept_rows"] > 0


def test_staged_merge_and_layer_path(spark):
    from pyspark.sql import functions as F

    from candlewick.sinks.files import layer_path
    assert layer_path("stock/bronze/AAPL.parquet") == "stock/silver/AAPL.parquet"
    assert layer_path("bronze/x/bronze/y") == "silver/x/bronze/y"
    root = tempfile.mkdtemp(prefix="cw-wh-")
    rows = [("2024-01-0%d" % d, "A", "W", float(d)) for d in range(1, 5)]
    t = spark.createDataFrame(rows, "Date string, ticker string, period string, Close double") \
        .withColumn("Date", F.to_date("Date"))
    v1 = P.run_staged_merge(spark, f"{root}/wh", t, "W")          # first run: staged rows only
    s = t.filter("Date = '2024-01-02'").withColumn("Close", F.lit(20.0))
    v2 = P.run_staged_merge(spark, f"{root}/wh", s, "W")
    assert v1 != v2
    got = {str(r.Date): r.Close for r in spark.read.parquet(v2).collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-02": 20.0}


def test_read_table_with_fixed_schema(spark):
    from candlewick.schemas import SILVER_PRICES
    root = tempfile.mkdtemp(prefix="cw-schema-")
    fx.with_silver_columns(fx.bars_wide(spark, SF_SMALL)).write.parquet(f"{root}/silver")
    df = read_table(spark, f"{root}/silver", SILVER_PRICES)
    assert [f.name for f in df.schema.fields] == [f.name for f in SILVER_PRICES.fields]
    assert df.count() > 0
    assert read_table(spark, f"{root}/nothing", SILVER_PRICES) is None
