"""Input views derived from the driver tables (see FIXTURES.md).

Each view is a lazy DataFrame over the whole source table, so its work grows
with the table.  Every view has an equivalent DuckDB SQL text in
``candlewick.plans.oracles`` for the correctness oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _packed_key(px: Column) -> Column:
    """(l_orderkey, l_linenumber, l_partkey, px) as one DECIMAL(38,0) with the
    same order: 16 + 2 + 12 + 8 digits.  A component outside its width fails
    the job instead of spilling into its neighbour."""
    def d(c: Column, digits: int, name: str) -> Column:
        fits = (c >= 0) & (c < F.lit(10 ** digits))
        return F.when(fits, c).otherwise(F.raise_error(F.lit(f"{name} has over {digits} digits")).cast("bigint")).cast("decimal(38,0)")

    def scale(e: int) -> Column:
        return F.lit("1" + "0" * e).cast("decimal(38,0)")

    return (d(F.col("l_orderkey"), 16, "l_orderkey") * scale(22) + d(F.col("l_linenumber"), 2, "l_linenumber") * scale(20)
            + d(F.col("l_partkey"), 12, "l_partkey") * scale(8) + d(px, 8, "price in cents"))


def _daily_bars(li: DataFrame, ticker: Column, per_supplier: bool = False) -> DataFrame:
    """Daily OHLCV bars from line items: one bar per (ticker, ship date).

    Prices are integer cents so that first/last/max/min/sum are exact.  The
    aggregation is partial per input partition before the shuffle, so a
    ticker holding a large share of the line items does not overload a task.
    Open/Close are the prices at the smallest/largest key (l_orderkey,
    l_linenumber, l_partkey, l_suppkey, price).  When the ticker is the
    supplier, l_suppkey is constant within a bar and the key packs into one
    fixed-width decimal, which keeps the aggregation hash-based; otherwise a
    struct key is used (sort-based aggregation).
    """
    px = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    if per_supplier:
        order_key = _packed_key(px)
    else:
        order_key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", px.alias("px"))
    agg = (
        li.select(ticker.alias("ticker"), F.to_date("l_shipdate").alias("Date"),
                  px.alias("px"), order_key.alias("k"), "l_quantity")
        .groupBy("ticker", "Date")
        .agg(F.min_by("px", "k").alias("o"), F.max("px").alias("h"), F.min("px").alias("l"),
             F.max_by("px", "k").alias("c"), F.sum("l_quantity").cast("bigint").alias("Volume"))
    )
    return agg.select(
        "ticker", "Date",
        (F.col("o") / 100.0).alias("Open"), (F.col("h") / 100.0).alias("High"),
        (F.col("l") / 100.0).alias("Low"), (F.col("c") / 100.0).alias("Close"),
        (F.col("c") / 100.0).alias("Adj Close"), "Volume",
    )


def bars_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_bars_long: six long daily series, ticker = returnflag || linestatus."""
    li = table(spark, sf_dir, "lineitem")
    return _daily_bars(li, F.concat("l_returnflag", "l_linestatus"))


def bars_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_bars_wide: one daily series per supplier, ticker = 'S' || suppkey."""
    li = table(spark, sf_dir, "lineitem")
    return _daily_bars(li, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), per_supplier=True)


FIXED_CREATED_AT = "2024-01-31 00:00:00"


def with_silver_columns(bars: DataFrame) -> DataFrame:
    """Add the remaining silver columns (dividends, splits, batch time)."""
    return bars.select(
        "ticker", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume",
        F.lit(0.0).alias("Dividends"), F.lit(0.0).alias("Stock Splits"),
        F.to_timestamp(F.lit(FIXED_CREATED_AT)).alias("created_at"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_bronze: wide bars with every 17th Close and 23rd Volume missing."""
    bars = with_silver_columns(bars_wide(spark, sf_dir))
    rn = F.row_number().over(Window.partitionBy("ticker").orderBy("Date"))
    b = bars.withColumn("_rn", rn)
    return b.select(
        "ticker", "Date", "Open", "High", "Low",
        F.when(F.col("_rn") % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("Close")).alias("Close"),
        "Adj Close",
        F.when(F.col("_rn") % 23 == 0, F.lit(None).cast("bigint")).otherwise(F.col("Volume")).alias("Volume"),
        "Dividends", "Stock Splits", "created_at",
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_ticks: trades from events.  s = event type, p = value, t = epoch ms,
    v = event_id % 100 + 1, c = [k % 30] with k from the props JSON."""
    from candlewick.operators.ticks import epoch_ms

    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        F.col("event_id"),
        F.col("event_type").alias("s"),
        F.col("value").alias("p"),
        epoch_ms(F.col("ts")).alias("t"),
        (F.col("event_id") % 100 + 1).cast("double").alias("v"),
        F.array((k % 30).cast("string")).alias("c"),
    )


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_fundamentals: one snapshot row per part, ASCII column aliases."""
    return fundamentals_from_part(table(spark, sf_dir, "part")).drop("p_partkey")


def company_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous company list: every customer outside the HOUSEHOLD segment."""
    c = table(spark, sf_dir, "customer")
    return c.filter(F.col("c_mktsegment") != "HOUSEHOLD").select(
        F.col("c_custkey").alias("cik"),
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.col("c_name").alias("title"),
        F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("last_updated"),
        F.lit(True).alias("is_active"),
    )


def company_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New company list batch (cik, ticker, title) before stamping: every
    customer outside the BUILDING segment, titles changed for nations 0-4."""
    c = table(spark, sf_dir, "customer")
    title = F.when(F.col("c_nationkey") < 5, F.concat(F.col("c_name"), F.lit(" (renamed)"))).otherwise(F.col("c_name"))
    return c.filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("cik"),
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
        title.alias("title"),
    )


# --- fixed values: fixture parameters ---------------------------------------
GOLD_CUT = "1998-06-30"          # fx_gold_old holds bars up to this date
GOLD_CHANGE_FROM = "1998-06-01"  # fx_gold_new changes Close from this date on
AS_OF = "1998-12-31"             # as-of date of the daily lookback filter
SNAPSHOT_DATES = ("2024-01-31", "2024-02-29")
TICK_LINES = {"upperband": 100.0, "lowerband": 5.0, "upper_1_7": 60.0, "lower_1_7": 20.0}
SIMPLE_LINE = {"lowerband": 90.0}  # older alert consumer: fixed level 90, downward only
HOLIDAY_ROWS = [("2024-01-01", ""), ("2024-01-15", ""), ("2024-01-26", "09:30-13:00")]
# -----------------------------------------------------------------------------


def gold_old(bars: DataFrame) -> DataFrame:
    """fx_gold_old: every bar up to the cut date."""
    return bars.filter(F.col("Date") <= F.to_date(F.lit(GOLD_CUT)))


def gold_new(spark: SparkSession, sf_dir: str, bars: DataFrame) -> DataFrame:
    """fx_gold_new: full history of the tickers of suppliers in nations 0-12,
    with Close raised by 1.0 from the change date on."""
    sup = table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") < 13).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"))
    changed = F.when(F.col("Date") >= F.to_date(F.lit(GOLD_CHANGE_FROM)), F.col("Close") + 1.0).otherwise(F.col("Close"))
    return bars.join(sup, "ticker", "left_semi").withColumn("Close", changed)


def part_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars under part tickers: supplier k's series stands for part k."""
    return bars_wide(spark, sf_dir).withColumn("ticker", F.regexp_replace("ticker", "^S", "P"))


def fundamentals_info(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    """Vendor-style attribute JSON per part ticker, with dirty values:
    trailingPE is 'Infinity' for k % 11 = 0 and 'n/a' for k % 13 = 0,
    forwardEps is 'NaN' for k % 17 = 0 and netIncomeToCommon 1e17 for
    k % 19 = 0 (else both are missing), currentPrice is missing for
    k % 23 = 0, recommendationKey is the text 'None' for k % 9 = 0."""
    from candlewick.sources.records import VENDOR_KEYS

    part = table(spark, sf_dir, "part") if part is None else part
    kcol = F.col("p_partkey")
    trailing = (F.when(kcol % 11 == 0, F.lit("Infinity")).when(kcol % 13 == 0, F.lit("n/a"))
                .otherwise(((kcol % 50) * 1.25).cast("string")))
    rec_key = F.when(kcol % 9 == 0, F.lit("None")).when(kcol % 7 == 0, F.lit(None)).otherwise(F.lit("buy"))
    joined = fundamentals_from_part(part).select(
        "*", trailing.alias("trailing_pe"), rec_key.alias("analyst_key2"),
        F.when(kcol % 17 == 0, F.lit("NaN")).alias("eps_forward"), F.when(kcol % 19 == 0, F.lit("1e17")).alias("net_income"))
    joined = joined.withColumn("current_price", F.when(kcol % 23 != 0, F.col("current_price")))
    entries = []
    for alias, key in VENDOR_KEYS.items():
        if alias == "trailing_pe":
            val = F.col("trailing_pe")
        elif alias == "analyst_key":
            val = F.col("analyst_key2")
        elif alias in joined.columns:
            val = F.col(alias).cast("string")
        else:
            continue
        entries += [F.lit(key), val]
    return joined.select("created_at", "ticker", F.to_json(F.create_map(*entries)).alias("info"))


def fundamentals_from_part(p: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    ticker = (F.when(k == 1, "AAPL").when(k == 2, "NVDA").when(k == 3, "SPY")
              .otherwise(F.concat(F.lit("P"), k.cast("string"))))
    return p.select(
        "p_partkey",
        F.to_date(F.lit("2024-01-31")).alias("created_at"),
        ticker.alias("ticker"),
        (F.lit(4e8) + (k * 7919 % 1000) * 5e6).alias("market_cap"),
        F.when(k % 5 == 0, 1.0).otherwise(2 + (k * 31 % 60) / 10.0).alias("price_to_sales"),
        ((12 + k * 17 % 16) / 100.0).alias("roe"),
        ((20 + k * 13 % 30) / 10.0).alias("current_ratio"),
        (k * 11 % 14).cast("double").alias("debt_to_equity"),
        ((k * 7 % 20 - 1) / 100.0).alias("roa_ttm"),
        (k * 5 % 20 - 1).cast("double").alias("eps_ttm"),
        ((k * 3 % 10 - 1) * 1e6).alias("operating_cash_flow"),
        F.col("p_retailprice").alias("current_price"),
        ((40 + k * 19 % 200) * 1e6).alias("revenue"),
        ((35 + k * 23 % 65) / 100.0).alias("institutional_share"),
        F.when(k % 5 == 0, 3.0 + (k % 3) / 2.0).otherwise(1 + (k * 29 % 20) / 10.0).alias("analyst_mean"),
        ((20 + k * 37 % 100) * 2000.0).alias("avg_daily_volume"),
        F.when(k % 4 == 1, 4.0).otherwise((k * 41 % 30) / 10.0).alias("change_52w"),
        ((80 + k * 43 % 21) / 100.0).alias("high_52w_ratio"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.lit("buy")).alias("analyst_key"),
    )


def company_json(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None) -> DataFrame:
    """Company-list JSON documents, one per customer: {"<custkey>": {cik_str, ticker, title}}."""
    c = table(spark, sf_dir, "customer") if customers is None else customers
    obj = F.struct(F.col("c_custkey").alias("cik_str"),
                   F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
                   F.col("c_name").alias("title"))
    return c.select(F.to_json(F.create_map(F.col("c_custkey").cast("string"), obj)).alias("value"))


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope messages built from the ticks: 'error' events become 'ping'
    messages, every other event one trade envelope."""
    t = ticks(spark, sf_dir)
    typ = F.when(F.col("s") == "error", "ping").otherwise("trade")
    env = F.struct(typ.alias("type"), F.array(F.struct("s", "p", "t", "v", "c")).alias("data"))
    return t.select(F.to_json(env).alias("value"))
