"""Registered queries for table maintenance, windows, joins, screens,
fundamentals, company lists, trade ticks, the kernel-based patterns and the
composite jobs, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import ticks as tk
from candlewick.operators.screen import screen, screen_summary
from candlewick.operators.upsert import (update_company_list, upsert_company_list, upsert_gold_history,
                                         upsert_snapshot, warehouse_merge)
from candlewick.operators.windows import (dedupe_priority, drop_latest_n, drop_latest_per_key, latest_row)
from candlewick.operators.resample import resample
from candlewick.params import PERIODS
from candlewick.plans import oracles as O
from candlewick.plans.registry import _analysed_daily, register
from candlewick.sources import fixtures as fx
from candlewick.sources.records import (clean_fundamentals, fundamentals_rows, high_ratios, parse_company_json,
                                        parse_trade_envelopes, with_high_ratios)

ALLP = O.all_periods_sql()
DAILY = O.resample_sql("D")
SUPP_LOW = "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier WHERE s_nationkey < 13"
GOLD_OLD = f"SELECT * FROM ({ALLP}) a WHERE \"Date\" <= DATE '{fx.GOLD_CUT}'"
GOLD_NEW = f"""SELECT ticker, period, "Date",
       CASE WHEN "Date" >= DATE '{fx.GOLD_CHANGE_FROM}' THEN "Close" + 1.0::DOUBLE ELSE "Close" END AS "Close"
FROM ({ALLP}) a WHERE ticker IN ({SUPP_LOW})"""
# both tables from one pass over the bars
_GOLD_PAIR = f"""every_bar AS MATERIALIZED ({ALLP}),
held AS MATERIALIZED (SELECT "Date", ticker, period, "Close" FROM every_bar WHERE "Date" <= DATE '{fx.GOLD_CUT}'),
fresh AS MATERIALIZED (SELECT "Date", ticker, period, "Close" + ("Date" >= DATE '{fx.GOLD_CHANGE_FROM}')::INTEGER AS "Close"
                       FROM every_bar SEMI JOIN ({SUPP_LOW}) low USING (ticker))"""
SIDES = ("Side_1", "Side_2", "Side_3")
KEYC = '"Date", ticker, period, "Close"'


def _all_bars(spark, sf):
    return resample(fx.bars_wide(spark, sf), gap_policy="drop")


def _daily(spark, sf):
    return fx.bars_wide(spark, sf)


def _gold_pair(spark, sf):
    bars = _all_bars(spark, sf).select("ticker", "period", "Date", "Close")
    return fx.gold_old(bars), fx.gold_new(spark, sf, bars)


# ----------------------------------------------------------------------------
# Window operators and filters over the period bars
# ----------------------------------------------------------------------------

register("wn_latest_row", f"""
SELECT ticker, "Date", "Close" FROM ({DAILY}) d
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY "Date" DESC) = 1""")(
    lambda spark, sf: latest_row(_daily(spark, sf)).select("ticker", "Date", "Close"))

register("wn_latest_n", f"""
SELECT {KEYC} FROM ({ALLP}) a
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY "Date" DESC, period) > 2""")(
    lambda spark, sf: drop_latest_n(_all_bars(spark, sf), 2, ("ticker",), tiebreak=("period",))
    .select("Date", "ticker", "period", "Close"))

register("wn_latest_n_period", f"""
SELECT {KEYC} FROM ({ALLP}) a
QUALIFY row_number() OVER (PARTITION BY ticker, period ORDER BY "Date" DESC) > 2""")(
    lambda spark, sf: drop_latest_n(_all_bars(spark, sf), 2, ("ticker", "period"))
    .select("Date", "ticker", "period", "Close"))

@register("wn_dedupe_priority", f"""
SELECT {KEYC} FROM (SELECT {KEYC}, 1 AS _p FROM ({GOLD_OLD}) o UNION ALL SELECT {KEYC}, 2 AS _p FROM ({GOLD_NEW}) n) u
QUALIFY row_number() OVER (PARTITION BY "Date", ticker, period ORDER BY _p) = 1""")
def q_dedupe(spark, sf):
    old, new = _gold_pair(spark, sf)
    both = old.withColumn("_p", F.lit(1)).unionByName(new.withColumn("_p", F.lit(2)))
    return dedupe_priority(both, ["Date", "ticker", "period"], "_p").select("Date", "ticker", "period", "Close")

def _sides_sql(period: str, where: str = "true") -> str:
    bars = f"SELECT ticker, \"Date\", \"High\", \"Low\", \"Close\", \"Volume\" FROM ({O.resample_sql(period)}) b"
    return f'SELECT ticker, "Date", "Side_1", "Side_2", "Side_3" FROM ({O.patterns_sql(bars)}) p WHERE {where}'


def _staging_query(period, **options):
    def q(spark, sf):
        from candlewick.plans.jobs import job_gold, staging_view
        gold = job_gold(fx.with_silver_columns(_daily(spark, sf)), periods=(period,), gap_policy="drop", columns=SIDES)
        return staging_view(gold, period, **options)
    return q


register("flt_period", _sides_sql("W"))(_staging_query("W"))
register("flt_daily_lookback", _sides_sql("D", f"\"Date\" >= DATE '{fx.AS_OF}' - INTERVAL 2 YEAR"))(
    _staging_query("D", as_of=fx.AS_OF))

register("flt_drop_latest", f"""
SELECT ticker, "Date", "Close" FROM ({DAILY}) d
QUALIFY "Date" < max("Date") OVER (PARTITION BY ticker)""")(
    lambda spark, sf: drop_latest_per_key(_daily(spark, sf)).select("ticker", "Date", "Close"))


# ----------------------------------------------------------------------------
# Gold history maintenance
# ----------------------------------------------------------------------------

def _gold_history_sql(scope: str) -> str:
    """The two newest held rows per scope of a renewed ticker are given up; of
    what is left, the held row of a key comes before the fresh one."""
    return f"""
WITH {_GOLD_PAIR},
given_up AS (SELECT unnest(arg_min(key, (-epoch("Date"), period), 2)) AS key
             FROM (SELECT {scope}, "Date", period, {{'d': "Date", 't': ticker, 'p': period}} AS key
                   FROM held SEMI JOIN fresh USING (ticker)) z GROUP BY {scope}),
stacked AS (SELECT h.*, 1 AS age FROM held h ANTI JOIN given_up g
              ON h."Date" = g.key.d AND h.ticker = g.key.t AND h.period = g.key.p
            UNION ALL SELECT *, 2 FROM fresh)
SELECT "Date", ticker, period, arg_min("Close", age) AS "Close" FROM stacked GROUP BY "Date", ticker, period"""


def _gold_history_query(scope):
    def q(spark, sf):
        o, n = _gold_pair(spark, sf)
        return upsert_gold_history(o, n, scope=scope).select("Date", "ticker", "period", "Close")
    return q


register("up_gold_history", _gold_history_sql("ticker, period"))(_gold_history_query("ticker_period"))
register("up_gold_history_ticker", _gold_history_sql("ticker"))(_gold_history_query("ticker"))

@register("up_warehouse_merge", f"""
WITH {_GOLD_PAIR},
staged AS MATERIALIZED (SELECT * FROM fresh WHERE period = 'W'),
late AS (SELECT DISTINCT unnest(max("Date", 2)) AS "Date" FROM held SEMI JOIN staged USING (ticker)
         WHERE period = 'W' GROUP BY ticker),
untouched AS (SELECT * FROM held ANTI JOIN staged USING ("Date", ticker, period))
SELECT {KEYC} FROM untouched u
WHERE period <> 'W' OR ticker NOT IN (SELECT ticker FROM staged) OR "Date" NOT IN (SELECT "Date" FROM late)
UNION ALL SELECT {KEYC} FROM staged""")
def q_warehouse_merge(spark, sf):
    """The merge reads and rebuilds one period; the others are passed on."""
    def bars(periods):
        both = resample(fx.bars_wide(spark, sf), periods=periods, gap_policy="drop").select("Date", "ticker", "period", "Close")
        return both
    week = bars(("W",))
    merged = warehouse_merge(fx.gold_old(week), fx.gold_new(spark, sf, week).select(*week.columns))
    return fx.gold_old(bars(tuple(p for p in PERIODS if p != "W"))).unionByName(merged)


# ----------------------------------------------------------------------------
# Company list
# ----------------------------------------------------------------------------

BATCH_TIME = "2024-02-01 00:00:00"
_CO_OLD = """SELECT c_custkey AS cik, 'T' || CAST(c_custkey AS VARCHAR) AS ticker, c_name AS title,
       TIMESTAMP '2024-01-01 00:00:00' AS last_updated, true AS is_active FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'"""
_CO_NEW = f"""SELECT c_custkey AS cik, 'T' || CAST(c_custkey AS VARCHAR) AS ticker,
       CASE WHEN c_nationkey < 5 THEN c_name || ' (renamed)' ELSE c_name END AS title,
       TIMESTAMP '{BATCH_TIME}' AS last_updated, true AS is_active FROM customer WHERE c_mktsegment <> 'BUILDING'"""
_CO_UPSERT = f"""
WITH o AS ({_CO_OLD}), n AS ({_CO_NEW})
SELECT cik, ticker, title, last_updated, false AS is_active FROM o
WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.cik = o.cik AND n.ticker = o.ticker)
UNION ALL SELECT * FROM n"""


def _company_upsert(spark, sf):
    return upsert_company_list(fx.company_old(spark, sf), fx.company_new(spark, sf), BATCH_TIME)


register("up_company_list", f"""SELECT cik, ticker, title, CAST(last_updated AS DATE) AS last_updated, is_active
FROM ({_CO_UPSERT}) u""")(
    lambda spark, sf: _company_upsert(spark, sf).withColumn("last_updated", F.to_date("last_updated")))

register("up_company_list_update", f"""
WITH o AS ({_CO_OLD}), n AS ({_CO_NEW})
SELECT COALESCE(n.cik, o.cik) AS cik, COALESCE(n.ticker, o.ticker) AS ticker, COALESCE(n.title, o.title) AS title,
       CAST(COALESCE(n.last_updated, o.last_updated) AS DATE) AS last_updated,
       COALESCE(n.last_updated, o.last_updated) >= TIMESTAMP '{BATCH_TIME}' AS is_active
FROM o FULL OUTER JOIN n ON o.cik = n.cik AND o.ticker = n.ticker""")(
    lambda spark, sf: update_company_list(fx.company_old(spark, sf), fx.company_new(spark, sf), BATCH_TIME)
    .withColumn("last_updated", F.to_date("last_updated")))

register("flt_active_tickers", f"SELECT DISTINCT ticker FROM ({_CO_UPSERT}) u WHERE is_active")(
    lambda spark, sf: _company_upsert(spark, sf).filter("is_active").select("ticker").distinct())

register("src_company_json", """
SELECT c_custkey AS cik, 'T' || CAST(c_custkey AS VARCHAR) AS ticker, c_name AS title, true AS is_active FROM customer""")(
    lambda spark, sf: parse_company_json(fx.company_json(spark, sf), BATCH_TIME).drop("last_updated"))


# ----------------------------------------------------------------------------
# Fundamentals, screen, snapshots
# ----------------------------------------------------------------------------

def _fund_cols(k: str = "p_partkey") -> dict[str, str]:
    return {
        "market_cap": f"4e8 + ({k} * 7919 % 1000) * 5e6",
        "price_to_sales": f"CASE WHEN {k} % 5 = 0 THEN 1.0::DOUBLE ELSE 2 + ({k} * 31 % 60) / 10.0::DOUBLE END",
        "roe": f"(12 + {k} * 17 % 16) / 100.0::DOUBLE",
        "current_ratio": f"(20 + {k} * 13 % 30) / 10.0::DOUBLE",
        "debt_to_equity": f"CAST({k} * 11 % 14 AS DOUBLE)",
        "roa_ttm": f"({k} * 7 % 20 - 1) / 100.0::DOUBLE",
        "eps_ttm": f"CAST({k} * 5 % 20 - 1 AS DOUBLE)",
        "operating_cash_flow": f"({k} * 3 % 10 - 1) * 1e6",
        "current_price": "p_retailprice",
        "revenue": f"(40 + {k} * 19 % 200) * 1e6",
        "institutional_share": f"(35 + {k} * 23 % 65) / 100.0::DOUBLE",
        "analyst_mean": f"CASE WHEN {k} % 5 = 0 THEN 3.0::DOUBLE + ({k} % 3) / 2.0::DOUBLE ELSE 1 + ({k} * 29 % 20) / 10.0::DOUBLE END",
        "avg_daily_volume": f"(20 + {k} * 37 % 100) * 2000.0::DOUBLE",
        "change_52w": f"CASE WHEN {k} % 4 = 1 THEN 4.0::DOUBLE ELSE ({k} * 41 % 30) / 10.0::DOUBLE END",
        "high_52w_ratio": f"(80 + {k} * 43 % 21) / 100.0::DOUBLE",
        "analyst_key": f"CASE WHEN {k} % 7 = 0 THEN NULL ELSE 'buy' END",
    }


_TICKER = "CASE WHEN p_partkey = 1 THEN 'AAPL' WHEN p_partkey = 2 THEN 'NVDA' WHEN p_partkey = 3 THEN 'SPY' ELSE 'P' || CAST(p_partkey AS VARCHAR) END"
FUND = (f"SELECT DATE '2024-01-31' AS created_at, {_TICKER} AS ticker, "
        + ", ".join(f"{v} AS {a}" for a, v in _fund_cols().items()) + " FROM part")

# --- fixed values, stated again so that a wrong bound shows: tier, column, comparison, bound
SCREEN_RULES = """
1 HighGrowth market_cap >= 1e9; 1 HighGrowth price_to_sales >= 2; 1 HighGrowth price_to_sales <= 10;
1 HighGrowth roe > 0.05; 1 HighGrowth roe <= 0.25; 1 HighGrowth current_ratio >= 2.5; 1 HighGrowth debt_to_equity <= 10;
1 HighGrowth roa_ttm > 0; 1 HighGrowth eps_ttm > 0; 1 HighGrowth operating_cash_flow > 0;
1 HighGrowth institutional_share >= 0.4; 1 HighGrowth institutional_share < 0.95; 1 HighGrowth analyst_mean <= 3;
2 SteadyGrowth market_cap >= 4e8; 2 SteadyGrowth price_to_sales >= 2; 2 SteadyGrowth price_to_sales <= 7;
2 SteadyGrowth roe > 0.15; 2 SteadyGrowth roe <= 0.25; 2 SteadyGrowth current_ratio >= 2; 2 SteadyGrowth debt_to_equity <= 10;
2 SteadyGrowth roa_ttm > 0; 2 SteadyGrowth eps_ttm > 0; 2 SteadyGrowth operating_cash_flow > 0;
2 SteadyGrowth current_price >= 15; 2 SteadyGrowth revenue >= 5e7; 2 SteadyGrowth institutional_share >= 0.4;
2 SteadyGrowth institutional_share < 0.95; 2 SteadyGrowth analyst_mean <= 2;
3 Distressed price_to_sales <= 1.5; 3 Distressed roe > 0.15; 3 Distressed roe <= 0.25; 3 Distressed current_ratio >= 1.1;
3 Distressed debt_to_equity <= 50; 3 Distressed roa_ttm > 0; 3 Distressed eps_ttm > 0; 3 Distressed current_price > 0;
3 Distressed revenue >= 5e7; 3 Distressed avg_daily_volume >= 50000; 3 Distressed institutional_share >= 0.4;
3 Distressed institutional_share < 0.95; 3 Distressed analyst_mean >= 3;
4 Super change_52w >= 3; 4 Super high_52w_ratio >= 0.9; 4 Super current_price >= 15; 4 Super avg_daily_volume >= 50000;
4 Super institutional_share >= 0.4; 4 Super institutional_share < 0.95; 4 Super analyst_mean <= 2; 4 Super has_key >= 1"""
TICKER_TIERS = (("Magnificent_8", "AAPL MSFT GOOGL AMZN NVDA META TSLA NFLX"), ("ETF_1", "QQQ SPY DIA"))
# ------------------------------------------------------------------------------


def _screen_sql(fundamentals: str) -> str:
    """Counts, per row and tier, the rules that a value satisfies; a tier holds
    if all of its rules do (a missing value satisfies none)."""
    rules = [r.split() for r in SCREEN_RULES.split(";")]
    table = ", ".join(f"({rank}, '{tier}', '{col}', '{op}', {bound}::DOUBLE)" for rank, tier, col, op, bound in rules)
    columns = ", ".join(sorted({r[2] for r in rules}))
    listed = ", ".join(f"({5 + i}, '{tier}', '{t}')" for i, (tier, names) in enumerate(TICKER_TIERS) for t in names.split())
    return f"""
  WITH wide AS (SELECT *, CASE WHEN analyst_key IS NOT NULL THEN 1.0::DOUBLE END AS has_key FROM ({fundamentals}) f),
  long AS (SELECT created_at, ticker, col, val FROM (SELECT created_at, ticker, {', '.join(
      f'{c}::DOUBLE AS {c}' for c in sorted({r[2] for r in rules}))} FROM wide) w UNPIVOT (val FOR col IN ({columns}))),
  rules(rank, tier, col, op, bound) AS (VALUES {table}),
  asked AS (SELECT rank, tier, count(*) AS n FROM rules GROUP BY ALL),
  met AS (SELECT created_at, ticker, rank, count(*) AS n FROM long JOIN rules USING (col)
          WHERE CASE op WHEN '>=' THEN val >= bound WHEN '<=' THEN val <= bound WHEN '>' THEN val > bound ELSE val < bound END
          GROUP BY ALL),
  held AS (SELECT created_at, ticker, rank, tier FROM met JOIN asked USING (rank, n)
           UNION ALL SELECT created_at, ticker, rank, tier FROM wide
           JOIN (VALUES {listed}) v(rank, tier, ticker) USING (ticker))
  SELECT created_at, ticker, arg_min(tier, rank) AS is_selected FROM held GROUP BY created_at, ticker"""


register("flt_screen", _screen_sql(FUND))(lambda spark, sf: screen(fx.fundamentals(spark, sf)))
register("ag_screen_summary", f"""SELECT created_at, is_selected, count(*) AS n_rows FROM ({_screen_sql(FUND)}) s
GROUP BY created_at, is_selected""")(lambda spark, sf: screen_summary(screen(fx.fundamentals(spark, sf))))
register("flt_ticker_list", """SELECT ticker FROM (SELECT CASE WHEN p_partkey = 1 THEN 'AAPL' WHEN p_partkey = 2 THEN 'NVDA'
  WHEN p_partkey = 3 THEN 'SPY' ELSE 'P' || CAST(p_partkey AS VARCHAR) END AS ticker FROM part) p
WHERE ticker IN ('AAPL', 'MSFT', 'GOOGL', 'AMZN', 'NVDA', 'META', 'TSLA', 'NFLX', 'QQQ', 'SPY', 'DIA')""")(
    lambda spark, sf: fx.fundamentals(spark, sf).filter(F.col("ticker").isin(
        "AAPL", "MSFT", "GOOGL", "AMZN", "NVDA", "META", "TSLA", "NFLX", "QQQ", "SPY", "DIA")).select("ticker"))

_SNAP_NEW = (f"SELECT DATE '2024-01-31' AS created_at, {_TICKER} AS ticker, ({_fund_cols()['market_cap']}) * 2 AS market_cap "
             "FROM part WHERE p_size >= 25 UNION ALL "
             f"SELECT DATE '2024-02-29', {_TICKER}, {_fund_cols()['market_cap']} FROM part WHERE p_size >= 25")
_SNAP = f"""
WITH o AS (SELECT created_at, ticker, market_cap FROM ({FUND}) f), n AS ({_SNAP_NEW})
SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.created_at = o.created_at AND n.ticker = o.ticker)
UNION ALL SELECT * FROM n"""


def _snapshot(spark, sf):
    old = fx.fundamentals(spark, sf).select("created_at", "ticker", "market_cap")
    new_rows = fx.fundamentals_from_part(fx.table(spark, sf, "part").filter(F.col("p_size") >= 25))
    new = (new_rows.select("created_at", "ticker", (F.col("market_cap") * 2).alias("market_cap"))
           .unionByName(new_rows.select(F.to_date(F.lit("2024-02-29")).alias("created_at"), "ticker", "market_cap")))
    return upsert_snapshot(old, new)


register("up_snapshot", _SNAP)(_snapshot)
register("flt_recent_screened", f"""SELECT DISTINCT ticker FROM ({_SNAP}) s
WHERE created_at >= DATE '2026-02-15' - INTERVAL 2 YEAR""")(
    lambda spark, sf: _snapshot(spark, sf).filter(F.col("created_at") >= F.add_months(F.to_date(F.lit("2026-02-15")), -24))
    .select("ticker").distinct())


def _t3(expr: str) -> str:
    return f"trunc(({expr}) * 1000.0::DOUBLE) / 1000.0::DOUBLE"


_FUND_ROWS_COLS = {
    "market_cap": _t3(_fund_cols()["market_cap"]),
    "trailing_pe": f"CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN NULL ELSE {_t3('(p_partkey % 50) * 1.25::DOUBLE')} END",
    "forward_pe": "CAST(NULL AS DOUBLE)",
    **{a: _t3(_fund_cols()[a]) for a in ("price_to_sales", "current_ratio", "debt_to_equity", "roe", "roa_ttm", "eps_ttm")},
    "eps_growth": "CAST(NULL AS DOUBLE)", "eps_forward": "CAST(NULL AS DOUBLE)",
    "net_income": "CASE WHEN p_partkey % 19 = 0 THEN 1e17::DOUBLE END",
    "operating_cash_flow": _t3(_fund_cols()["operating_cash_flow"]),
    "revenue_growth": "CAST(NULL AS DOUBLE)",
    "revenue": _t3(_fund_cols()["revenue"]),
    "current_price": _t3("price"),
    "low_52w": "CAST(NULL AS DOUBLE)", "high_52w": "CAST(NULL AS DOUBLE)",
    "change_52w": _t3(_fund_cols()["change_52w"]),
    "avg_daily_volume": _t3(_fund_cols()["avg_daily_volume"]),
    "institutional_share": _t3(_fund_cols()["institutional_share"]),
    "analyst_mean": _t3(_fund_cols()["analyst_mean"]),
    "analyst_key": "CASE WHEN p_partkey % 9 = 0 OR p_partkey % 7 = 0 THEN NULL ELSE 'buy' END",
    "all_time_high_ratio": _t3("trunc(price / nullif(hi, 0) * 100.0::DOUBLE) / 100.0::DOUBLE"),
    "high_52w_ratio": _t3("trunc(price / nullif(hi52, 0) * 100.0::DOUBLE) / 100.0::DOUBLE"),
}
_HIGHS = f"""
  SELECT ticker, any_value(cur) AS cur, max("Close") AS hi, max("Close") FILTER ("Date" > final - 365) AS hi52
  FROM (SELECT *, max("Date") OVER t AS final, last("Close") OVER (t ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING
                 AND UNBOUNDED FOLLOWING) AS cur FROM ({DAILY}) d WINDOW t AS (PARTITION BY ticker)) z GROUP BY ticker"""


def _fund_rows_sql(day: str, where: str = "true") -> str:
    return f"""SELECT DATE '{day}' AS created_at, ticker, {', '.join(f'{v} AS {a}' for a, v in _FUND_ROWS_COLS.items())}
    FROM (SELECT p.*, {_TICKER} AS ticker, h.hi, h.hi52, coalesce(CASE WHEN p_partkey % 23 <> 0 THEN p_retailprice END, h.cur) AS price
          FROM part p LEFT JOIN ({_HIGHS}) h ON {_TICKER} = 'P' || substr(h.ticker, 2) WHERE {where}) q"""


@register("src_fundamentals_rows", _fund_rows_sql("2024-01-31"))
def q_fundamentals_rows(spark, sf):
    return clean_fundamentals(fundamentals_rows(fx.fundamentals_info(spark, sf), daily=fx.part_daily(spark, sf)))


@register("ag_high_ratio", f"""
SELECT ticker, cur AS current_price, trunc(cur / nullif(hi, 0) * 100.0::DOUBLE) / 100.0::DOUBLE AS all_time_high_ratio,
       trunc(cur / nullif(hi52, 0) * 100.0::DOUBLE) / 100.0::DOUBLE AS high_52w_ratio FROM ({_HIGHS}) h""")
def q_high_ratio(spark, sf):
    d = _daily(spark, sf)
    blank = d.select("ticker").distinct().select(
        "ticker", *[F.lit(None).cast("double").alias(c) for c in ("current_price", "all_time_high_ratio", "high_52w_ratio")])
    return with_high_ratios(blank, high_ratios(d))


_FUND_SHOWN = ["created_at", "ticker", "market_cap", "current_price", "eps_forward", "net_income", "all_time_high_ratio",
               "high_52w_ratio"]


@register("job_fundamentals", f"""
SELECT {', '.join(_FUND_SHOWN)} FROM ({_fund_rows_sql('2024-01-31')}) a
UNION ALL SELECT {', '.join(_FUND_SHOWN)} FROM ({_fund_rows_sql('2024-02-29', 'p_size >= 25')}) b""")
def q_job_fundamentals(spark, sf):
    from candlewick.plans.jobs import job_fundamentals
    daily, part = fx.part_daily(spark, sf), fx.table(spark, sf, "part")
    old = job_fundamentals(fx.fundamentals_info(spark, sf), daily, None)
    again = fx.fundamentals_info(spark, sf, part.filter("p_size >= 25"))
    batch = again.unionByName(again.withColumn("created_at", F.to_date(F.lit("2024-02-29"))))
    return job_fundamentals(batch, daily, old).select(*_FUND_SHOWN)


# ----------------------------------------------------------------------------
# Joins and sets
# ----------------------------------------------------------------------------

_SUPP_T = "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier"


def _supp(spark, sf, low=False):
    s = fx.table(spark, sf, "supplier")
    if low:
        s = s.filter(F.col("s_nationkey") < 13)
    return s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"))


# requested tickers: every supplier, some of them twice, and some that have no bars
_ASKED = f"""{_SUPP_T} UNION ALL {SUPP_LOW}
  UNION ALL SELECT 'X' || CAST(s_suppkey % 7 AS VARCHAR) FROM supplier"""


def _asked(spark, sf):
    absent = fx.table(spark, sf, "supplier").select(F.concat(F.lit("X"), (F.col("s_suppkey") % 7).cast("string")).alias("ticker"))
    return _supp(spark, sf).unionByName(_supp(spark, sf, True)).unionByName(absent)


register("jn_missing", f"SELECT DISTINCT ticker FROM ({_ASKED}) s WHERE ticker NOT IN (SELECT ticker FROM ({DAILY}) d)")(
    lambda spark, sf: tk.missing_tickers(_asked(spark, sf), _daily(spark, sf)))
register("set_difference", f"SELECT ticker FROM ({_ASKED}) s EXCEPT SELECT ticker FROM ({SUPP_LOW}) d")(
    lambda spark, sf: _asked(spark, sf).subtract(_supp(spark, sf, True)))
register("jn_semi", f"SELECT ticker, \"Date\", \"Close\" FROM ({DAILY}) d WHERE ticker IN ({SUPP_LOW})")(
    lambda spark, sf: _daily(spark, sf).join(_supp(spark, sf, True), "ticker", "left_semi").select("ticker", "Date", "Close"))
register("jn_anti_list", f"SELECT ticker, \"Date\", \"Close\" FROM ({DAILY}) d WHERE ticker NOT IN ({SUPP_LOW})")(
    lambda spark, sf: _daily(spark, sf).join(_supp(spark, sf, True), "ticker", "left_anti").select("ticker", "Date", "Close"))
register("ag_distinct", f"SELECT DISTINCT ticker FROM ({DAILY}) d")(
    lambda spark, sf: _daily(spark, sf).select("ticker").distinct())
register("set_concat", f"""SELECT ticker, period, "Date", "Close", NULL::DOUBLE AS "Dividends" FROM ({ALLP}) a WHERE period <> 'D'
UNION ALL SELECT ticker, 'D', "Date", "Close", 0.0::DOUBLE FROM ({DAILY}) d""")(
    lambda spark, sf: _all_bars(spark, sf).filter(F.col("period") != "D").select("ticker", "period", "Date", "Close")
    .unionByName(fx.with_silver_columns(_daily(spark, sf)).select("ticker", F.lit("D").alias("period"), "Date", "Close", "Dividends"),
                 allowMissingColumns=True))


# ----------------------------------------------------------------------------
# Trade ticks
# ----------------------------------------------------------------------------

TICKS = """SELECT event_id, event_type AS s, value AS p, CAST(epoch_us(ts) // 1000 AS BIGINT) AS t, CAST(event_id % 100 + 1 AS DOUBLE) AS v,
       [CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 30 AS VARCHAR)] AS c FROM events"""
_LOCAL = "timezone('America/New_York', timezone('UTC', make_timestamp(t * 1000)))"
_KEEP = "NOT COALESCE(list_has_any(c, ['24', '25']), false)"

register("flt_condition_codes", f"SELECT event_id, s, p, t FROM ({TICKS}) k WHERE {_KEEP}")(
    lambda spark, sf: tk.exclude_codes(fx.ticks(spark, sf)).select("event_id", "s", "p", "t"))

_HOL = "SELECT * FROM (VALUES " + ", ".join(f"('{d}', '{h}')" for d, h in fx.HOLIDAY_ROWS) + ") v(d, hours)"
register("flt_session", f"""
WITH k AS (SELECT *, {_LOCAL} AS lt FROM ({TICKS}) x),
j AS (SELECT k.*, h.hours FROM k LEFT JOIN ({_HOL}) h ON strftime(k.lt, '%Y-%m-%d') = h.d),
b AS (SELECT *, hour(lt) * 3600 + minute(lt) * 60 + second(lt) + (t % 1000) / 1000.0::DOUBLE AS sod,
             CASE WHEN hours IS NULL THEN 34200 ELSE TRY_CAST(split_part(split_part(hours, '-', 1), ':', 1) AS INTEGER) * 3600
                  + TRY_CAST(split_part(split_part(hours, '-', 1), ':', 2) AS INTEGER) * 60 END AS o,
             CASE WHEN hours IS NULL THEN 57600 ELSE TRY_CAST(split_part(split_part(hours, '-', 2), ':', 1) AS INTEGER) * 3600
                  + TRY_CAST(split_part(split_part(hours, '-', 2), ':', 2) AS INTEGER) * 60 END AS cl
      FROM j WHERE hours IS NULL OR hours <> '')
SELECT event_id, s, t FROM b WHERE dayofweek(lt) NOT IN (0, 6) AND sod >= o AND sod < cl""")(
    lambda spark, sf: tk.in_session(fx.ticks(spark, sf), tk.holiday_table(spark, fx.HOLIDAY_ROWS)).select("event_id", "s", "t"))

register("ag_group_collect", f"""SELECT s, CAST({_LOCAL} AS DATE) AS date, min(t) AS first_t, max(t) AS last_t, count(*) AS n_trades
FROM ({TICKS}) k GROUP BY ALL""")(lambda spark, sf: tk.group_collect(fx.ticks(spark, sf)))

register("st_monitor", f"""SELECT s, t, printf('[%s]  %-6s  %10.3f  vol:%6s', strftime({_LOCAL}, '%H:%M:%S'), s, p,
       CAST(v AS VARCHAR)) AS line FROM ({TICKS}) k WHERE {_KEEP}""")(
    lambda spark, sf: tk.monitor_lines(tk.exclude_codes(fx.ticks(spark, sf))))

register("src_trades_envelope", f"SELECT s, p, t, v, array_to_string(c, ',') AS c FROM ({TICKS}) k WHERE s <> 'error'")(
    lambda spark, sf: parse_trade_envelopes(fx.trade_messages(spark, sf)).withColumn("c", F.array_join("c", ",")).drop("pos"))

def _lines_sql(lines: dict) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(
        f"('{lab}', {v}::DOUBLE, {tk.ALERT_LINES[lab][0]}, '{tk.ALERT_LINES[lab][1]}')"
        for lab, v in lines.items()) + ") v(label, threshold, cooldown, level)"


def _alerts_sql(lines: dict) -> str:
    return f"""
WITH RECURSIVE f AS (SELECT * FROM ({TICKS}) k WHERE {_KEEP}),
pv AS (SELECT *, lag(p) OVER (PARTITION BY s ORDER BY t, event_id) AS prev_p FROM f),
th AS (SELECT s, l.* FROM (SELECT DISTINCT s FROM ({TICKS}) k2) ss, ({_lines_sql(lines)}) l),
x AS (SELECT pv.s, pv.t, pv.event_id, pv.p, pv.prev_p, th.label, th.threshold, th.cooldown
      FROM pv JOIN th ON pv.s = th.s
      WHERE prev_p IS NOT NULL AND ((contains(label, 'upper') AND prev_p <= threshold AND p > threshold)
                                 OR (contains(label, 'lower') AND prev_p >= threshold AND p < threshold))),
o AS (SELECT *, row_number() OVER (PARTITION BY s, label ORDER BY t, event_id) AS k FROM x),
r AS (SELECT s, label, k, CASE WHEN t > cooldown * 1000 THEN t ELSE 0 END AS last_sent, t > cooldown * 1000 AS fired
      FROM o WHERE k = 1
      UNION ALL
      SELECT o.s, o.label, o.k, CASE WHEN o.t - r.last_sent > o.cooldown * 1000 THEN o.t ELSE r.last_sent END,
             o.t - r.last_sent > o.cooldown * 1000
      FROM r JOIN o ON o.s = r.s AND o.label = r.label AND o.k = r.k + 1)
SELECT o.s, o.label, o.t, o.event_id, o.prev_p, o.p FROM o JOIN r USING (s, label, k) WHERE r.fired"""


def _alerts_query(lines: dict):
    def q(spark, sf):
        t = fx.ticks(spark, sf)
        return tk.alerts(t, tk.tick_thresholds(t, lines)).select("s", "label", "t", "event_id", "prev_p", "p")
    return q


register("st_alert_batch", _alerts_sql(fx.TICK_LINES))(_alerts_query(fx.TICK_LINES))
# st_alert_simple (older variant): one fixed downward line per symbol, 60 s cooldown.
register("st_alert_simple", _alerts_sql(fx.SIMPLE_LINE))(_alerts_query(fx.SIMPLE_LINE))

register("st_alert_config", f"""
SELECT ticker, label, {O.rnd('threshold', 4)} AS threshold, cooldown, level FROM (
  SELECT ticker, "EMA13" + std13 * 2.7::DOUBLE AS upperband, "EMA13" - std13 * 2.7::DOUBLE AS lowerband,
         "EMA13" + std13 * 1.7::DOUBLE AS upper_1_7, "EMA13" - std13 * 1.7::DOUBLE AS lower_1_7
  FROM ({O.indicators_sql()}) i QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY "Date" DESC) = 1) z
UNPIVOT (threshold FOR label IN (upperband, lowerband, upper_1_7, lower_1_7)) u
JOIN (VALUES ('upperband', 60, 'critical'), ('lowerband', 60, 'critical'), ('upper_1_7', 30, 'warning'),
             ('lower_1_7', 30, 'warning')) v(label2, cooldown, level) ON u.label = v.label2
WHERE ticker IN ({SUPP_LOW})""")(
    lambda spark, sf: tk.alert_config(latest_row(_analysed_daily(spark, sf, *tk.ALERT_LINES)), _supp(spark, sf, True)).select(
        "ticker", "label", (F.floor(F.col("threshold") * 10000.0 + 0.5) / 10000.0).alias("threshold"), "cooldown", "level"))


# ----------------------------------------------------------------------------
# Kernel-based patterns and composite jobs
# ----------------------------------------------------------------------------

def _pat(cols):
    return lambda spark, sf: _analysed_daily(spark, sf, *cols).select("ticker", "Date", *cols)


_PAT = O.patterns_sql()


def _pat_sql(cols):
    return f"SELECT ticker, \"Date\", {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({_PAT}) p"


for _key, _cols in {
    "pt_local_extrema": ["price_Peak", "price_Trough"],
    "pt_fi2_extrema": ["FI_2_Peak", "FI_2_Trough"],
    "pt_higher_peak": ["Higher_Peak", "price_search"],
    "pt_lower_trough": ["Lower_Trough", "price_search"],
    "pt_divergence": ["MACD_hist_trend", "FI_13_trend", "MACD_hist_trend_pair", "FI_13_trend_pair"],
    "pt_power_top2": ["Bull_Power_trend", "Bear_Power_trend", "Bull_Power_trend_pair", "Bear_Power_trend_pair"],
    "pt_side_1": ["Side_1"],
    "pt_side_2": ["Side_2"],
    "pt_side_3": ["Side_3"],
}.items():
    register(_key, _pat_sql(_cols))(_pat(_cols))


@register("job_gold", O.gold_sql())
def q_job_gold(spark, sf):
    from candlewick.plans.flagship import gold_wide
    return gold_wide(spark, sf).drop("created_at")


@register("job_conclusion", O.conclusion_sql())
def q_job_conclusion(spark, sf):
    from candlewick.plans.flagship import gold_wide
    from candlewick.plans.jobs import job_conclusion
    return job_conclusion(gold_wide(spark, sf, columns=SIDES))


@register("snk_report", O.report_sql())
def q_report(spark, sf):
    from candlewick.plans.flagship import gold_wide
    from candlewick.plans.jobs import job_conclusion
    from candlewick.sinks.files import report_frame
    return report_frame(job_conclusion(gold_wide(spark, sf, columns=SIDES)))



# ----------------------------------------------------------------------------
# Scalars, summaries and the screen job
# ----------------------------------------------------------------------------

@register("sc_trunc2", f"""SELECT ticker, "Date", {', '.join(
    f'CAST(trunc("{c}" * 100.0::DOUBLE) AS BIGINT) / 100.0::DOUBLE AS "{c}"' for c in ("EMA13", "MACD_hist", "ATR", "FI_13"))}
FROM ({O.indicators_sql()}) i""")
def q_trunc2(spark, sf):
    from candlewick.functions.scalars import truncate_numeric
    names = ("EMA13", "MACD_hist", "ATR", "FI_13")
    return truncate_numeric(_analysed_daily(spark, sf, *names).select("ticker", "Date", *names), 2)


@register("sc_time_key", f"""SELECT event_id, strftime({_LOCAL}, '%Y%m%d') AS day_key, strftime({_LOCAL}, '%Y%m') AS month_key,
       strftime({_LOCAL}, '%Y%m%d_%H%M%S') AS second_key FROM ({TICKS}) k""")
def q_time_key(spark, sf):
    from candlewick.functions.scalars import time_key
    t = fx.ticks(spark, sf)
    lt = tk.local_time(F.col("t"))
    return t.select("event_id", time_key(lt, "day").alias("day_key"), time_key(lt, "month").alias("month_key"),
                    time_key(lt, "second").alias("second_key"))


@register("ag_status_summary", f"""
SELECT 'clean' AS stage, 'success' AS status, count(DISTINCT ticker) AS n_items FROM ({O.BRONZE}) b""")
def q_status(spark, sf):
    from candlewick.operators.clean import clean_audit, status_summary
    audit = clean_audit(fx.bronze(spark, sf)).select(F.lit("clean").alias("stage"), F.col("ticker").alias("item"), "status")
    return status_summary(audit).select("stage", "status", "n_items")


_FUND2 = (f"SELECT DATE '2024-02-29' AS created_at, {_TICKER} AS ticker, "
          + ", ".join(f"({v}) * 2 AS {a}" if a == "market_cap" else f"{v} AS {a}" for a, v in _fund_cols().items())
          + " FROM part WHERE p_size >= 25")


@register("job_screen", f"""
WITH o AS ({_screen_sql(FUND)}), n AS ({_screen_sql(_FUND2)})
SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.created_at = o.created_at AND n.ticker = o.ticker)
UNION ALL SELECT * FROM n""")
def q_job_screen(spark, sf):
    from candlewick.plans.jobs import job_screen
    first = fx.fundamentals(spark, sf)
    batch = (fx.fundamentals_from_part(fx.table(spark, sf, "part").filter(F.col("p_size") >= 25))
             .drop("p_partkey")
             .withColumn("created_at", F.to_date(F.lit("2024-02-29")))
             .withColumn("market_cap", F.col("market_cap") * 2))
    return job_screen(first.unionByName(batch), screen(first))


@register("job_company_list", f"""
SELECT cik, ticker, title, CAST(last_updated AS DATE) AS last_updated, is_active FROM (
  SELECT o.cik, o.ticker, o.title, o.last_updated, false AS is_active FROM ({_CO_OLD}) o
  ANTI JOIN (SELECT c_custkey AS cik FROM customer WHERE c_mktsegment <> 'BUILDING') n USING (cik)
  UNION ALL SELECT c_custkey, 'T' || c_custkey, c_name, TIMESTAMP '{BATCH_TIME}', true
  FROM customer WHERE c_mktsegment <> 'BUILDING') u""")
def q_job_company_list(spark, sf):
    from candlewick.plans.jobs import job_company_list
    docs = fx.company_json(spark, sf, fx.table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'"))
    return job_company_list(docs, fx.company_old(spark, sf), BATCH_TIME).withColumn("last_updated", F.to_date("last_updated"))


# ----------------------------------------------------------------------------
# Vendor history normalisation and fetch status
# ----------------------------------------------------------------------------

@register("src_price_normalise", f"""SELECT ticker, "Date", "Close", "Volume" FROM ({DAILY}) d""")
def q_price_normalise(spark, sf):
    from candlewick.sources.records import normalise_prices
    raw = _daily(spark, sf).withColumn("Date", F.timestamp_add("HOUR", F.lit(4), F.col("Date").cast("timestamp_ntz")))
    return normalise_prices(raw, BATCH_TIME).select("ticker", "Date", "Close", "Volume")


@register("ag_fetch_status", f"""
SELECT s.ticker, COALESCE(c.n, 0) AS n_rows, CASE WHEN COALESCE(c.n, 0) > 0 THEN 'success' ELSE 'failed' END AS status
FROM (SELECT DISTINCT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier) s
LEFT JOIN (SELECT ticker, count(*) AS n FROM ({DAILY}) d GROUP BY ticker) c USING (ticker)""")
def q_fetch_status(spark, sf):
    from candlewick.sources.records import fetch_status
    return fetch_status(_supp(spark, sf), _daily(spark, sf))


@register("st_alert_text", f"""
SELECT s, label, t, event_id,
       printf('%s [ %-8s] %-6s %s %-12s(%8.3f)：%8.3f → %8.3f',
              CASE WHEN level = 'critical' THEN '{tk.ALERT_EMOJI["critical"]}' ELSE '{tk.ALERT_EMOJI["warning"]}' END,
              upper(level), s,
              CASE WHEN contains(label, 'upper') THEN '{tk.ALERT_DIRECTION["upper"]}' ELSE '{tk.ALERT_DIRECTION["lower"]}' END,
              label, threshold, prev_p, p) AS text
FROM ({_alerts_sql(fx.TICK_LINES).replace(
    "SELECT o.s, o.label, o.t, o.event_id, o.prev_p, o.p FROM o JOIN r USING (s, label, k) WHERE r.fired",
    "SELECT o.s, o.label, o.t, o.event_id, o.prev_p, o.p, o.threshold, th2.level FROM o JOIN r USING (s, label, k) "
    "JOIN th th2 ON th2.s = o.s AND th2.label = o.label WHERE r.fired")}) a""")
def q_alert_text(spark, sf):
    t = fx.ticks(spark, sf)
    return tk.alert_text(tk.alerts(t, tk.tick_thresholds(t, fx.TICK_LINES))).select("s", "label", "t", "event_id", "text")
