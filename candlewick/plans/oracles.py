"""Independent DuckDB SQL for the correctness oracle.

Each text runs on the driver's pre-registered views (lineitem, events, part,
customer, ...).  The SQL re-derives every fixture and operator from the raw
tables; it shares no code path with the Spark implementation.
"""

from __future__ import annotations

from candlewick.params import period_step

# --- fixed values, stated again so that a wrong constant shows ----------------
ASOF_DAYS = {"W": 8, "2W": 15, "3W": 22, "ME": 32, "2ME": 63, "3ME": 93}
MART_NAMES = {"W": "W", "2W": "2W", "3W": "3W", "ME": "ME", "2ME": "2M", "3ME": "3M"}
# ------------------------------------------------------------------------------

# ----------------------------------------------------------------------------
# Fixture views
# ----------------------------------------------------------------------------


def bars_sql(ticker_expr: str) -> str:
    return f"""
    SELECT ticker, "Date",
           CAST(o AS DOUBLE) / 100.0::DOUBLE AS "Open", CAST(h AS DOUBLE) / 100.0::DOUBLE AS "High",
           CAST(l AS DOUBLE) / 100.0::DOUBLE AS "Low", CAST(c AS DOUBLE) / 100.0::DOUBLE AS "Close",
           CAST(c AS DOUBLE) / 100.0::DOUBLE AS "Adj Close", "Volume"
    FROM (
      SELECT ticker, "Date", arg_min(px, k) AS o, max(px) AS h, min(px) AS l, arg_max(px, k) AS c,
             CAST(sum(l_quantity) AS BIGINT) AS "Volume"
      FROM (
        SELECT {ticker_expr} AS ticker, CAST(l_shipdate AS DATE) AS "Date", l_quantity,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS px,
               struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey, d := l_suppkey,
                           e := CAST(round(l_extendedprice * 100) AS BIGINT)) AS k
        FROM lineitem) t
      GROUP BY ticker, "Date") g"""


BARS_WIDE = bars_sql("'S' || CAST(l_suppkey AS VARCHAR)")
BARS_LONG = bars_sql("l_returnflag || l_linestatus")

BRONZE = f"""
    SELECT ticker, "Date", "Open", "High", "Low",
           CASE WHEN rn % 17 = 0 THEN NULL ELSE "Close" END AS "Close", "Adj Close",
           CASE WHEN rn % 23 = 0 THEN NULL ELSE "Volume" END AS "Volume",
           0.0::DOUBLE AS "Dividends", 0.0::DOUBLE AS "Stock Splits"
    FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY "Date") AS rn FROM ({BARS_WIDE}) b) x"""


def label_sql(period: str, d: str = '"Date"', d0: str = "d0") -> str:
    kind, n = period_step(period)
    if kind == "day":
        return d
    if kind == "week":
        step = 7 * n
        s0 = f"({d0} + CAST((7 - dayofweek({d0})) % 7 AS INTEGER))"
        return f"({s0} + CAST({step} * ((date_diff('day', {s0}, {d}) + {step - 1}) // {step}) AS INTEGER))"
    m = f"(year({d}) * 12 + month({d}) - 1)"
    m0 = f"(year({d0}) * 12 + month({d0}) - 1)"
    lm = f"({m0} + {n} * (({m} - {m0} + {n - 1}) // {n}))"
    return f"last_day(make_date(CAST({lm} // 12 AS INTEGER), CAST({lm} % 12 + 1 AS INTEGER), 1))"


def resample_sql(period: str, bars: str = BARS_WIDE) -> str:
    """Bars of one period (gaps dropped) from a daily bars query."""
    if period == "D":
        return f"""SELECT ticker, 'D' AS period, "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume" FROM ({bars}) b"""
    return f"""
    SELECT ticker, '{period}' AS period, label AS "Date",
           arg_min("Open", "Date") AS "Open", max("High") AS "High", min("Low") AS "Low",
           arg_max("Close", "Date") AS "Close", arg_max("Adj Close", "Date") AS "Adj Close",
           CAST(sum("Volume") AS BIGINT) AS "Volume"
    FROM (SELECT *, {label_sql(period)} AS label
          FROM (SELECT *, min("Date") OVER (PARTITION BY ticker) AS d0 FROM ({bars}) b) x) y
    GROUP BY ticker, label"""


def all_periods_sql(bars: str = BARS_WIDE) -> str:
    """Bars of all periods; the daily bars are computed once."""
    from candlewick.params import PERIODS
    parts = " UNION ALL ".join(f"({resample_sql(p, 'SELECT * FROM daily_bars')})" for p in PERIODS)
    return f"WITH daily_bars AS MATERIALIZED ({bars}) {parts}"


# ----------------------------------------------------------------------------
# Recursive indicators (EMA family, MACD, Wilder) on one series per ticker
# ----------------------------------------------------------------------------

def _k(n: int) -> str:
    return f"(2.0::DOUBLE / {n + 1})"


def recursive_sql(series: str) -> str:
    """Sequential recursion over each ticker's rows of ``series`` (ticker,
    Date, High, Low, Close, Volume): EMA13/26, MACD 12/26/9, FI, FI_2,
    FI_13, ATR 14, DI 13, ADX 14.  Same operation order as the definitions
    (seed = running sum / n, e = (x - e) * k + e, Wilder s - s/n + x)."""
    return f"""
    WITH RECURSIVE s AS (
      SELECT ticker, "Date", "High" AS h, "Low" AS l, "Close" AS x,
             CAST(row_number() OVER w - 1 AS INTEGER) AS rn,
             COALESCE(("Close" - lag("Close") OVER w) * CAST("Volume" AS DOUBLE), 0.0::DOUBLE) AS fi,
             greatest("High" - "Low", abs(lag("Close") OVER w - "High"), abs(lag("Close") OVER w - "Low")) AS tr,
             CASE WHEN "High" - lag("High") OVER w > 0 AND "High" - lag("High") OVER w > lag("Low") OVER w - "Low"
                  THEN "High" - lag("High") OVER w ELSE 0.0::DOUBLE END AS pdm,
             CASE WHEN lag("Low") OVER w - "Low" > 0 AND "High" - lag("High") OVER w < lag("Low") OVER w - "Low"
                  THEN lag("Low") OVER w - "Low" ELSE 0.0::DOUBLE END AS mdm
      FROM ({series}) src
      WINDOW w AS (PARTITION BY ticker ORDER BY "Date")
    ),
    r AS (
      SELECT ticker, rn, "Date", x, fi, h, l,
             x AS c13, CAST(NULL AS DOUBLE) AS e13,
             x AS c26, CAST(NULL AS DOUBLE) AS e26,
             CAST(NULL AS DOUBLE) AS c12, CAST(NULL AS DOUBLE) AS e12,
             CAST(NULL AS DOUBLE) AS cm, CAST(NULL AS DOUBLE) AS sig,
             fi AS cf2, CAST(NULL AS DOUBLE) AS f2,
             fi AS cf13, CAST(NULL AS DOUBLE) AS f13,
             CAST(NULL AS DOUBLE) AS tsum, CAST(NULL AS DOUBLE) AS atr,
             0.0::DOUBLE AS dp, 0.0::DOUBLE AS dm, 0.0::DOUBLE AS dt,
             0.0::DOUBLE AS wp, 0.0::DOUBLE AS wm, 0.0::DOUBLE AS wt,
             0 AS pad
      FROM s WHERE rn = 0
      UNION ALL
      SELECT s.ticker, s.rn, s."Date", s.x, s.fi, s.h, s.l,
             CASE WHEN s.rn < 13 THEN r.c13 + s.x END,
             CASE WHEN s.rn = 12 THEN (r.c13 + s.x) / 13 WHEN s.rn > 12 THEN (s.x - r.e13) * {_k(13)} + r.e13 END,
             CASE WHEN s.rn < 26 THEN r.c26 + s.x END,
             CASE WHEN s.rn = 25 THEN (r.c26 + s.x) / 26 WHEN s.rn > 25 THEN (s.x - r.e26) * {_k(26)} + r.e26 END,
             CASE WHEN s.rn = 14 THEN s.x WHEN s.rn BETWEEN 15 AND 25 THEN r.c12 + s.x END,
             CASE WHEN s.rn = 25 THEN (r.c12 + s.x) / 12 WHEN s.rn > 25 THEN (s.x - r.e12) * {_k(12)} + r.e12 END,
             -- macd line = e12 - e26 of this row; its running sum from row 25 seeds the signal
             CASE WHEN s.rn = 25 THEN ((r.c12 + s.x) / 12) - ((r.c26 + s.x) / 26)
                  WHEN s.rn BETWEEN 26 AND 33 THEN r.cm + (((s.x - r.e12) * {_k(12)} + r.e12) - ((s.x - r.e26) * {_k(26)} + r.e26)) END,
             CASE WHEN s.rn = 33 THEN (r.cm + (((s.x - r.e12) * {_k(12)} + r.e12) - ((s.x - r.e26) * {_k(26)} + r.e26))) / 9
                  WHEN s.rn > 33 THEN ((((s.x - r.e12) * {_k(12)} + r.e12) - ((s.x - r.e26) * {_k(26)} + r.e26)) - r.sig) * {_k(9)} + r.sig END,
             CASE WHEN s.rn < 2 THEN r.cf2 + s.fi END,
             CASE WHEN s.rn = 1 THEN (r.cf2 + s.fi) / 2 WHEN s.rn > 1 THEN (s.fi - r.f2) * {_k(2)} + r.f2 END,
             CASE WHEN s.rn < 13 THEN r.cf13 + s.fi END,
             CASE WHEN s.rn = 12 THEN (r.cf13 + s.fi) / 13 WHEN s.rn > 12 THEN (s.fi - r.f13) * {_k(13)} + r.f13 END,
             CASE WHEN s.rn = 1 THEN s.tr WHEN s.rn <= 14 THEN r.tsum + s.tr END,
             CASE WHEN s.rn = 14 THEN (r.tsum + s.tr) / 14 WHEN s.rn > 14 THEN ((r.atr * 13) + s.tr) / 14 END,
             -- DI 13: plain sums over rows 1..12, Wilder afterwards
             CASE WHEN s.rn < 13 THEN r.dp + s.pdm ELSE r.dp - r.dp / 13 + s.pdm END,
             CASE WHEN s.rn < 13 THEN r.dm + s.mdm ELSE r.dm - r.dm / 13 + s.mdm END,
             CASE WHEN s.rn < 13 THEN r.dt + s.tr ELSE r.dt - r.dt / 13 + s.tr END,
             -- ADX 14: plain sums over rows 1..13, Wilder afterwards
             CASE WHEN s.rn < 14 THEN r.wp + s.pdm ELSE r.wp - r.wp / 14 + s.pdm END,
             CASE WHEN s.rn < 14 THEN r.wm + s.mdm ELSE r.wm - r.wm / 14 + s.mdm END,
             CASE WHEN s.rn < 14 THEN r.wt + s.tr ELSE r.wt - r.wt / 14 + s.tr END,
             0 AS pad
      FROM r JOIN s ON s.ticker = r.ticker AND s.rn = r.rn + 1
    ),
    d AS (
      SELECT *,
             CASE WHEN rn < 14 OR abs(wt) < 0.00000001 THEN NULL
                  WHEN abs(100.0::DOUBLE * (wm / wt) + 100.0::DOUBLE * (wp / wt)) < 0.00000001 THEN NULL
                  ELSE 100.0::DOUBLE * (abs(100.0::DOUBLE * (wm / wt) - 100.0::DOUBLE * (wp / wt))
                                        / (100.0::DOUBLE * (wm / wt) + 100.0::DOUBLE * (wp / wt))) END AS dx
      FROM r
    ),
    a AS (
      SELECT ticker, rn, 0.0::DOUBLE AS sdx, CAST(NULL AS DOUBLE) AS adx FROM d WHERE rn = 13
      UNION ALL
      SELECT d.ticker, d.rn,
             CASE WHEN d.rn <= 27 THEN a.sdx + COALESCE(d.dx, 0.0::DOUBLE) ELSE a.sdx END,
             CASE WHEN d.rn = 27 THEN (a.sdx + COALESCE(d.dx, 0.0::DOUBLE)) / 14
                  WHEN d.rn > 27 THEN CASE WHEN d.dx IS NULL THEN a.adx ELSE (a.adx * 13 + d.dx) / 14 END END
      FROM a JOIN d ON d.ticker = a.ticker AND d.rn = a.rn + 1
    )
    SELECT ticker, "Date", rn, x AS "Close", h AS "High", l AS "Low", fi AS "FI",
           e13 AS "EMA13", e26 AS "EMA26",
           CASE WHEN rn >= 33 THEN e12 - e26 END AS "MACD",
           CASE WHEN rn >= 33 THEN sig END AS "MACD_signal",
           CASE WHEN rn >= 33 THEN (e12 - e26) - sig END AS "MACD_hist",
           f2 AS "FI_2", f13 AS "FI_13", atr AS "ATR",
           CASE WHEN rn >= 13 THEN CASE WHEN abs(dt) < 0.00000001 THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * (dp / dt) END END AS "PLUS_DI",
           CASE WHEN rn >= 13 THEN CASE WHEN abs(dt) < 0.00000001 THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * (dm / dt) END END AS "MINUS_DI",
           a.adx AS "ADX"
    FROM d LEFT JOIN a USING (ticker, rn)"""


DAILY_WIDE = f"SELECT ticker, \"Date\", \"High\", \"Low\", \"Close\", \"Volume\" FROM ({BARS_WIDE}) b"


def indicators_sql(series: str = DAILY_WIDE) -> str:
    """Recursive indicators plus the window ones, per ticker, ordered by Date."""
    return f"""
    SELECT *,
           CASE WHEN count(x) OVER w13 = 13 THEN stddev_pop(x) OVER w13 END AS std13,
           "High" - "EMA13" AS "Bull_Power", "Low" - "EMA13" AS "Bear_Power",
           "EMA13" - "EMA26" AS ema_diff,
           lag("EMA13" - "EMA26") OVER w AS ema_diff_prev,
           "EMA13" - lag("EMA13") OVER w AS "EMA13_slope",
           "FI_13" - lag("FI_13") OVER w AS "FI_13_diff",
           lag("FI_13") OVER w AS fi13_prev
    FROM (SELECT *, "Close" AS x FROM ({recursive_sql(series)}) q) z
    WINDOW w AS (PARTITION BY ticker ORDER BY "Date"),
           w13 AS (PARTITION BY ticker ORDER BY "Date" ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)"""


def rnd(expr: str, digits: int = 6) -> str:
    """Round half up with plain double arithmetic, identical in both engines."""
    scale = f"{10 ** digits}.0::DOUBLE"
    return f"(floor(({expr}) * {scale} + 0.5) / {scale})"


def r(col: str, digits: int = 6) -> str:
    return f'{rnd(chr(34) + col + chr(34), digits)} AS "{col}"'


def _nearest_periods(rows: str, values, names: dict[str, str]) -> tuple[list[str], str]:
    """Per longer period the columns and the chain of ASOF joins that give each
    daily row ``d`` the period's last row up to its date plus the tolerance."""
    columns, joins = [], ""
    for period, days in ASOF_DAYS.items():
        rel = f"near_{names[period]}"
        joins += f"""
      ASOF LEFT JOIN (SELECT * FROM {rows} WHERE period = '{period}') {rel}
        ON d.ticker = {rel}.ticker AND d."Date" + {days} >= {rel}."Date" """
        columns += [f'{rel}."{c}" AS "{c}_{names[period]}"' for c in ("Date", *values)]
    return columns, joins


def asof_sql(values=("Close",)) -> str:
    """As-of lookup of every longer period onto the daily rows."""
    columns, joins = _nearest_periods("every_bar", values, {p: p for p in ASOF_DAYS})
    return f"""WITH every_bar AS MATERIALIZED ({all_periods_sql()})
    SELECT d.ticker, d."Date" AS "Date_D", {', '.join(columns)}
    FROM (SELECT * FROM every_bar WHERE period = 'D') d {joins}"""


def patterns_sql(series: str = DAILY_WIDE) -> str:
    """Extrema, swing points, divergence, power pairs and the three signals in
    SQL: runs of equal values for local maxima, a recursive CTE (per ticker and
    signal, in height order) for the minimum-distance rule, joins with the series
    for prominence, and the rows of [search, i) for the swing searches."""
    ind = indicators_sql(series)
    return f"""
    WITH RECURSIVE base AS MATERIALIZED (SELECT * FROM ({ind}) i),
    sigs AS MATERIALIZED (SELECT ticker, rn, 'pp' AS sig, x AS v FROM base
             UNION ALL SELECT ticker, rn, 'pt', -x FROM base
             UNION ALL SELECT ticker, rn, 'fp', "FI_2" FROM base
             UNION ALL SELECT ticker, rn, 'ft', -"FI_2" FROM base),
    runs AS (SELECT *, sum(newrun) OVER (PARTITION BY ticker, sig ORDER BY rn) AS run_id,
                    count(*) OVER (PARTITION BY ticker, sig) AS n
             FROM (SELECT *, CASE WHEN v = lag(v) OVER w THEN 0 ELSE 1 END AS newrun FROM sigs
                   WINDOW w AS (PARTITION BY ticker, sig ORDER BY rn)) z),
    rr AS (SELECT ticker, sig, run_id, min(rn) AS a, max(rn) AS b, any_value(v) AS v, any_value(n) AS n
           FROM runs GROUP BY ticker, sig, run_id),
    cand AS (SELECT ticker, sig, CAST((a + b) // 2 AS INTEGER) AS pos, v
             FROM (SELECT *, lag(v) OVER w AS pv, lead(v) OVER w AS nv FROM rr
                   WINDOW w AS (PARTITION BY ticker, sig ORDER BY run_id)) q
             WHERE a >= 1 AND b <= n - 2 AND pv < v AND nv < v),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY ticker, sig ORDER BY v DESC, pos DESC) AS k FROM cand),
    g AS (SELECT ticker, sig, k, [pos] AS kept FROM ranked WHERE k = 1
          UNION ALL
          SELECT r.ticker, r.sig, r.k,
                 CASE WHEN len(list_filter(g.kept, lambda y: abs(y - r.pos) < 5)) = 0
                      THEN list_append(g.kept, r.pos) ELSE g.kept END
          FROM g JOIN ranked r ON r.ticker = g.ticker AND r.sig = g.sig AND r.k = g.k + 1),
    kept AS (SELECT ticker, sig, unnest(kept) AS pos FROM g
             QUALIFY k = max(k) OVER (PARTITION BY ticker, sig)),
    -- previous / next strictly higher sample of the kept peaks, counted from the peak (a missing value is a barrier)
    arrs AS MATERIALIZED (SELECT ticker, sig, list(v ORDER BY rn) AS vs FROM sigs GROUP BY ticker, sig),
    prom AS (SELECT ticker, sig, pos, vs, vs[pos + 1] AS h,
                    list_position(list_transform(list_reverse(vs[1:pos]), lambda y: coalesce(y > vs[pos + 1], true)), true) AS lp,
                    list_position(list_transform(vs[pos + 2:], lambda y: coalesce(y > vs[pos + 1], true)), true) AS rp
             FROM kept JOIN arrs USING (ticker, sig)),
    pm AS (SELECT ticker, sig, pos, h, list_min(vs[coalesce(pos - nullif(lp, 0) + 2, 1):pos + 1]) AS lmin,
                  list_min(vs[pos + 1:coalesce(pos + nullif(rp, 0), len(vs))]) AS rmin FROM prom),
    ext AS MATERIALIZED (SELECT ticker, sig, pos FROM pm
            WHERE h - greatest(lmin, rmin) >= CASE WHEN sig IN ('pp', 'pt') THEN 1 ELSE 5 END
              AND (sig IN ('pp', 'pt') OR h > 0)),
    sp AS (SELECT b.ticker, b.rn, b.x, b."ATR" AS atr, e.sig,
                  row_number() OVER (PARTITION BY b.ticker, e.sig ORDER BY b.rn) AS k
           FROM base b JOIN ext e ON e.ticker = b.ticker AND e.pos = b.rn AND e.sig IN ('pp', 'pt')),
    swing AS (SELECT ticker, rn, sig, CASE
                WHEN k > 2 AND abs(x - lag(x, 2) OVER w) <= atr
                     AND CASE WHEN sig = 'pp' THEN x > lag(x, 2) OVER w ELSE x < lag(x, 2) OVER w END THEN lag(rn, 2) OVER w
                WHEN k > 2 AND abs(x - lag(x, 1) OVER w) <= atr
                     AND CASE WHEN sig = 'pp' THEN x > lag(x, 1) OVER w ELSE x < lag(x, 1) OVER w END THEN lag(rn, 1) OVER w
                END AS s
              FROM sp WINDOW w AS (PARTITION BY ticker, sig ORDER BY rn)),
    sw AS MATERIALIZED (SELECT ticker, rn AS i, s, CASE WHEN sig = 'pp' THEN 'Down' ELSE 'Up' END AS dir FROM swing WHERE s IS NOT NULL),
    iv AS MATERIALIZED (SELECT ticker, rn, 'MACD_hist' AS name, 30.0::DOUBLE AS thr, "MACD_hist" AS val FROM base
           UNION ALL SELECT ticker, rn, 'FI_13', 70.0::DOUBLE, "FI_13" FROM base),
    swv AS MATERIALIZED (SELECT sw.*, a.name, a.thr, a.val FROM sw JOIN iv a ON a.ticker = sw.ticker AND a.rn = sw.i),
    -- the rows of every swing's interval, one look-up each
    swj AS MATERIALIZED (SELECT *, unnest(range(s, i)) AS j FROM swv),
    dv AS (SELECT a.ticker, a.i, a.dir, a.name, a.j,
                  CASE WHEN b.val = 0 THEN 'inf'::DOUBLE ELSE abs(a.val - b.val) / abs(b.val) * 100 END AS ch, a.thr
           FROM swj a JOIN iv b ON b.ticker = a.ticker AND b.name = a.name AND b.rn = a.j
           WHERE (a.dir = 'Down' AND a.val < b.val) OR (a.dir = 'Up' AND a.val > b.val)),
    dbest AS (SELECT ticker, i, dir, name, j FROM dv WHERE ch >= thr
              QUALIFY row_number() OVER (PARTITION BY ticker, i, name ORDER BY ch DESC, j) = 1),
    pw AS (SELECT sw.ticker, sw.i, sw.dir, b.rn AS j,
                  abs(CASE WHEN sw.dir = 'Down' THEN b."Bull_Power" ELSE b."Bear_Power" END) AS av
           FROM (SELECT *, unnest(range(s, i)) AS j FROM sw) sw JOIN base b ON b.ticker = sw.ticker AND b.rn = sw.j
           WHERE (sw.dir = 'Down' AND b."Bull_Power" > 0) OR (sw.dir = 'Up' AND b."Bear_Power" < 0)),
    ppair AS (SELECT ticker, i, dir, max(CASE WHEN r = 1 THEN j END) AS j1, max(CASE WHEN r = 2 THEN j END) AS j2
              FROM (SELECT *, row_number() OVER (PARTITION BY ticker, i ORDER BY av DESC, j) AS r FROM pw) q
              WHERE r <= 2 GROUP BY ticker, i, dir),
    out AS (
      SELECT b.*,
             EXISTS (SELECT 1 FROM ext e WHERE e.ticker = b.ticker AND e.pos = b.rn AND e.sig = 'pp') AS "price_Peak",
             EXISTS (SELECT 1 FROM ext e WHERE e.ticker = b.ticker AND e.pos = b.rn AND e.sig = 'pt') AS "price_Trough",
             EXISTS (SELECT 1 FROM ext e WHERE e.ticker = b.ticker AND e.pos = b.rn AND e.sig = 'fp') AS "FI_2_Peak",
             EXISTS (SELECT 1 FROM ext e WHERE e.ticker = b.ticker AND e.pos = b.rn AND e.sig = 'ft') AS "FI_2_Trough",
             hp.i IS NOT NULL AS "Higher_Peak", lt.i IS NOT NULL AS "Lower_Trough",
             COALESCE(hp.s, lt.s) AS price_search,
             dm.dir AS "MACD_hist_trend", df.dir AS "FI_13_trend",
             CAST(dm.j AS VARCHAR) || '_' || CAST(dm.i AS VARCHAR) AS "MACD_hist_trend_pair",
             CAST(df.j AS VARCHAR) || '_' || CAST(df.i AS VARCHAR) AS "FI_13_trend_pair",
             CASE WHEN bu.j2 IS NOT NULL AND bu.j1 < bu.j2 THEN 'Down' END AS "Bull_Power_trend",
             CASE WHEN be.j2 IS NOT NULL AND be.j1 < be.j2 THEN 'Up' END AS "Bear_Power_trend",
             CASE WHEN bu.j2 IS NOT NULL AND bu.j1 < bu.j2 THEN CAST(bu.j1 AS VARCHAR) || '_' || CAST(bu.j2 AS VARCHAR) END AS "Bull_Power_trend_pair",
             CASE WHEN be.j2 IS NOT NULL AND be.j1 < be.j2 THEN CAST(be.j1 AS VARCHAR) || '_' || CAST(be.j2 AS VARCHAR) END AS "Bear_Power_trend_pair",
             CASE WHEN b."EMA13_slope" > 0 THEN 'Up' WHEN b."EMA13_slope" < 0 THEN 'Down' END AS ema_trend
      FROM base b
      LEFT JOIN sw hp ON hp.ticker = b.ticker AND hp.i = b.rn AND hp.dir = 'Down'
      LEFT JOIN sw lt ON lt.ticker = b.ticker AND lt.i = b.rn AND lt.dir = 'Up'
      LEFT JOIN dbest dm ON dm.ticker = b.ticker AND dm.i = b.rn AND dm.name = 'MACD_hist'
      LEFT JOIN dbest df ON df.ticker = b.ticker AND df.i = b.rn AND df.name = 'FI_13'
      LEFT JOIN ppair bu ON bu.ticker = b.ticker AND bu.i = b.rn AND bu.dir = 'Down'
      LEFT JOIN ppair be ON be.ticker = b.ticker AND be.i = b.rn AND be.dir = 'Up')
    SELECT *,
           CASE WHEN "MACD_hist_trend" = 'Up' AND "FI_13_trend" = 'Up' THEN 'Long'
                WHEN "MACD_hist_trend" = 'Down' AND "FI_13_trend" = 'Down' THEN 'Short' END AS "Side_1",
           CASE WHEN ema_trend = 'Up' AND "FI_2_Trough" THEN 'Long'
                WHEN ema_trend = 'Down' AND "FI_2_Peak" THEN 'Short' END AS "Side_2",
           CASE WHEN "Bear_Power_trend" = 'Up' AND "Lower_Trough" THEN 'Long'
                WHEN "Bull_Power_trend" = 'Down' AND "Higher_Peak" THEN 'Short' END AS "Side_3"
    FROM out"""


def gold_sides_sql(bars: str = BARS_WIDE) -> str:
    """Side_1..3 of every (ticker, period) series, gaps dropped."""
    allp = all_periods_sql(bars)
    series = f"""SELECT ticker || '|' || period AS ticker, "Date", "High", "Low", "Close", "Volume" FROM ({allp}) a"""
    return f"""SELECT split_part(ticker, '|', 1) AS ticker, split_part(ticker, '|', 2) AS period, "Date",
                      "Side_1", "Side_2", "Side_3" FROM ({patterns_sql(series)}) p"""


def conclusion_sql(bars: str = BARS_WIDE) -> str:
    """Entry-conclusion mart: the last row of every longer period near each
    daily row; a ticker's last daily row is left out."""
    columns, joins = _nearest_periods("signals", ("Side_1", "Side_2", "Side_3"), MART_NAMES)
    return f"""WITH signals AS MATERIALIZED ({gold_sides_sql(bars)}),
    ends AS (SELECT ticker, max("Date") AS final FROM signals WHERE period = 'D' GROUP BY ticker)
    SELECT d.ticker, d."Date" AS "Date_D", d."Side_1" AS "Side_1_D", d."Side_2" AS "Side_2_D", d."Side_3" AS "Side_3_D",
           {', '.join(columns)}
    FROM (SELECT s.* FROM signals s JOIN ends e ON s.ticker = e.ticker WHERE period = 'D' AND s."Date" <> e.final) d {joins}"""


def report_sql(bars: str = BARS_WIDE) -> str:
    """Report rows: every mart value as text, NULL as 'None', dates ISO."""
    periods = ["D", *MART_NAMES.values()]
    dates = [f"Date_{p}" for p in periods]
    texts = ["ticker", *(f"Side_{k}_{p}" for k in (1, 2, 3) for p in periods)]
    shown = [f"coalesce(strftime(\"{c}\", '%Y-%m-%d'), 'None') AS \"{c}\"" for c in dates]
    shown += [f"coalesce(\"{c}\", 'None') AS \"{c}\"" for c in texts]
    return f"SELECT {', '.join(shown)} FROM ({conclusion_sql(bars)}) c"


def _trunc2(expr: str) -> str:
    return f"CAST(trunc(({expr}) * 100.0::DOUBLE) AS BIGINT) / 100.0::DOUBLE"


def gold_sql(bars: str = BARS_WIDE) -> str:
    """The gold table: every period's bars with the 24 indicators and 24
    pattern columns, numbers truncated to 2 decimals.  Window sums are left
    folds (``list_reduce``), the same summation order as Spark's frames."""
    allp = all_periods_sql(bars)
    series = f"""SELECT ticker || '|' || period AS ticker, "Date", "High", "Low", "Close", "Volume" FROM ({allp}) a"""
    pat = patterns_sql(series)

    def fold(col: str, n: int) -> str:
        return f"list_reduce(list({col}) OVER w{n}, lambda a, b: a + b) / {n}"

    win = f"""
    SELECT ticker || '|' || period AS sid, ticker, period, "Date", "Open", "Adj Close", "Volume" AS vol,
           CASE WHEN period = 'D' THEN 0.0::DOUBLE END AS "Dividends",
           CASE WHEN period = 'D' THEN 0.0::DOUBLE END AS "Stock Splits",
           CASE WHEN count("Close") OVER w50 = 50 THEN {fold('"Close"', 50)} END AS "SMA50",
           CASE WHEN count("Close") OVER w200 = 200 THEN {fold('"Close"', 200)} END AS "SMA200",
           CASE WHEN count(*) OVER w5 = 5 THEN max("High") OVER w5 END AS hh5,
           CASE WHEN count(*) OVER w5 = 5 THEN min("Low") OVER w5 END AS ll5,
           CASE WHEN count(*) OVER w7 = 7 THEN max("High") OVER w7 END AS hh7,
           CASE WHEN count(*) OVER w7 = 7 THEN min("Low") OVER w7 END AS ll7
    FROM ({allp}) a
    WINDOW w50 AS (PARTITION BY ticker, period ORDER BY "Date" ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
           w200 AS (PARTITION BY ticker, period ORDER BY "Date" ROWS BETWEEN 199 PRECEDING AND CURRENT ROW),
           w5 AS (PARTITION BY ticker, period ORDER BY "Date" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
           w7 AS (PARTITION BY ticker, period ORDER BY "Date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
    return f"""
    WITH p AS ({pat}),
    w AS ({win}),
    j AS (SELECT w.*, p.*,
                 CASE WHEN hh5 - ll5 <> 0 THEN (p.x - ll5) / ((hh5 - ll5) / 100.0::DOUBLE)
                      WHEN hh5 IS NOT NULL THEN 0.0::DOUBLE END AS fastk,
                 CASE WHEN hh7 - ll7 <> 0 THEN (hh7 - p.x) / ((hh7 - ll7) / -100.0::DOUBLE)
                      WHEN hh7 IS NOT NULL THEN 0.0::DOUBLE END AS willr
          FROM w JOIN p ON p.ticker = w.sid AND p."Date" = w."Date"),
    k1 AS (SELECT *, CASE WHEN count(fastk) OVER w3 = 3 THEN {fold('fastk', 3).replace('w3', 'w3')} END AS slowk FROM j
           WINDOW w3 AS (PARTITION BY sid ORDER BY "Date" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
    k2 AS (SELECT *, CASE WHEN count(slowk) OVER w3 = 3 THEN {fold('slowk', 3)} END AS slowd FROM k1
           WINDOW w3 AS (PARTITION BY sid ORDER BY "Date" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
    SELECT "Date", {_trunc2('"Open"')} AS "Open", {_trunc2('"High"')} AS "High", {_trunc2('"Low"')} AS "Low",
           {_trunc2('x')} AS "Close", {_trunc2('"Adj Close"')} AS "Adj Close", vol AS "Volume",
           {_trunc2('"Dividends"')} AS "Dividends", {_trunc2('"Stock Splits"')} AS "Stock Splits",
           split_part(sid, '|', 1) AS ticker, split_part(sid, '|', 2) AS period,
           {', '.join(f'{_trunc2(chr(34) + c + chr(34))} AS "{c}"' for c in (
               "ADX", "MACD", "MACD_signal", "MACD_hist", "PLUS_DI", "MINUS_DI"))},
           {_trunc2('CASE WHEN slowd IS NOT NULL THEN slowk END')} AS "STOCH_slowk", {_trunc2('slowd')} AS "STOCH_slowd",
           {_trunc2('willr')} AS "WILLR",
           {_trunc2('"EMA13" + std13 * 2.7::DOUBLE')} AS upperband, {_trunc2('"EMA13"')} AS middleband,
           {_trunc2('"EMA13" - std13 * 2.7::DOUBLE')} AS lowerband,
           {_trunc2('"EMA13" + std13 * 1.7::DOUBLE')} AS upper_1_7, {_trunc2('"EMA13" - std13 * 1.7::DOUBLE')} AS lower_1_7,
           {', '.join(f'{_trunc2(chr(34) + c + chr(34))} AS "{c}"' for c in (
               "EMA13", "EMA26", "SMA50", "SMA200", "ATR", "FI", "FI_2", "FI_13", "Bull_Power", "Bear_Power"))},
           CASE WHEN ema_diff > 0 AND ema_diff_prev < 0 THEN 'Long' WHEN ema_diff < 0 AND ema_diff_prev > 0 THEN 'Short' END
             AS "EMA_bullbear",
           {_trunc2('"EMA13_slope"')} AS "EMA13_slope", ema_trend AS "EMA13_trend",
           "price_Peak", "price_Trough", "Higher_Peak", "Lower_Trough", price_search, "FI_2_Peak", "FI_2_Trough",
           {_trunc2('"FI_13_diff"')} AS "FI_13_diff",
           COALESCE("FI_13" > 0 AND "FI_13_diff" > 0 AND (fi13_prev = 0 OR abs("FI_13_diff" / fi13_prev) * 100 >= 70), false) AS "FI_13_Peak",
           COALESCE("FI_13" < 0 AND "FI_13_diff" < 0 AND (fi13_prev = 0 OR abs("FI_13_diff" / fi13_prev) * 100 >= 70), false) AS "FI_13_Trough",
           "MACD_hist_trend", "FI_13_trend", "MACD_hist_trend_pair", "FI_13_trend_pair",
           "Bull_Power_trend", "Bear_Power_trend", "Bull_Power_trend_pair", "Bear_Power_trend_pair",
           "Side_1", "Side_2", "Side_3"
    FROM k2"""
