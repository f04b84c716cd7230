"""Recursive indicators (EMA, MACD, ATR, DI, ADX, EMA of FI) and previous-row
patterns as DataFrame expressions, without a Python step.

A recursion needs its rows in order, so a series becomes an array of its bars
(bounded: one bar per calendar day of a ticker) and one fold goes over it.  The
fold is nested: the bars of a part, the parts of a block, the blocks of the series,
each handing its last state on, because a step copies what its fold has
collected; so a bar costs a dozen copies of a state, not the series.  Seeds are
sums over one slice of the series.  The states lie beside the bars, so an
indicator is a projection of the state after its bar and a previous-row pattern
one of the states before and after it.

Operation order is the technical-analysis library's (sequential seed sums,
``e = (x - e) * k + e``, Wilder ``s = s - s / n + x``).  A missing bar (NULL or
NaN) makes every later value NULL; leading ones are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.params import IndicatorParams, PatternParams

#: bars of a block and of a part of it: a fold's step copies what it has collected so far
BLOCK, PART = 64, 8
_TINY = 0.00000001


def _zero(c: Column) -> Column:
    return F.abs(c) < _TINY


def let(value: Column, then) -> Column:
    """``then(value)`` with the value made once, not at every place that reads it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def ema_column(period: int, ip: IndicatorParams) -> str:
    """The column of an EMA: an output if its period is chosen, else internal."""
    return f"EMA{period}" if period in ip.ema_periods else f"_ema{period}"


def number(c: Column) -> Column:
    return F.when(~F.isnan(c.cast("double")), c.cast("double"))


class Fold:
    """The fields of the state (name -> next value of (state, bar)) and the seeds they start from.

    A field that is made of other fields reads them from the state before, so that nothing is evaluated twice; it
    comes late, by the bars that ``late`` names for those that columns are made of."""

    def __init__(self):
        self.fields: dict[str, object] = {}
        self.seeds: dict[str, tuple[str, str, int, int, float]] = {}
        self.late: dict[str, int] = {}

    def add(self, name: str, following, late: int = 0) -> str:
        self.fields.setdefault(name, following)
        if late:
            self.late[name] = late
        return name

    def bars(self, read) -> Column:
        """What the fold reads of a series' bars, and empty bars behind them for the fields that are late."""
        given = F.transform("_rows", lambda r: r["x"])
        none = [F.lit(None).cast("double").alias(k) for k in read if k != "n"]
        behind = [F.struct((F.size("_rows") + i).alias("n"), *none) for i in range(max(self.late.values(), default=0))]
        return F.concat(given, F.array(*behind)) if behind else given

    def seeded(self, name: str, value: str, count: str, skip: int, n: int, parts: float, following) -> str:
        """A recursion that starts on row ``skip + n`` of ``count`` with the sum of ``value`` over
        the last ``n`` rows, divided by ``parts``; before that it is NULL."""
        self.seeds[name] = value, count, skip, n, parts
        return self.add(name, lambda a, x: F.when(x["n"] == F.col(f"_at_{name}"), F.col(f"_seed_{name}")).otherwise(following(a, x)))

    def ema(self, name: str, n: int, value: str, count: str, skip: int = 0) -> str:
        k = 2.0 / (n + 1)
        return self.seeded(name, value, count, skip, n, n, lambda a, x: (x[value] - a[name]) * k + a[name])

    def starts(self) -> dict[str, Column]:
        """What a fold reads besides a bar, made once per series: each seed and its row.

        A missing bar among a seed's rows leaves the recursion without a start."""
        def start(value, count, skip, n, parts):
            first = F.col(f"_first_{count}") + skip
            rows = F.slice("_rows", first + 1, n)
            total = F.aggregate(rows, F.lit(0.0), lambda a, r: a + r["x"][value])
            return first + (n - 1), F.when(F.size(rows) == n, total / F.lit(float(parts)))
        made = {}
        for name, seed in self.seeds.items():
            made[f"_at_{name}"], made[f"_seed_{name}"] = start(*seed)
        return made

    @property
    def moves(self) -> bool:
        return any(count == "nb" for _, count, *_ in self.seeds.values())


def row_columns(moves: bool) -> dict[str, Column]:
    """Window columns that a fold's bars are made of: the row's number and, for moves, the bar before."""
    w = Window.partitionBy("ticker", "period").orderBy("Date")
    before = {f"_{c}_before": F.lag(c).over(w) for c in ("High", "Low", "Close")} if moves else {}
    return {"_n": F.row_number().over(w) - 1, **before}


def bar_columns(fold: Fold) -> tuple[dict[str, Column], dict[str, Column]]:
    """What a fold reads of a bar: number ``n``, close ``c`` and FI ``f``, true range and directional
    movements against the bar before; and, for each count (``nc``, ``nf``, ``nb``: the bars since the first one with
    a close, an FI, a whole bar), whether a bar may be its first one."""
    values, counts = {value for value, *_ in fold.seeds.values()}, {count for _, count, *_ in fold.seeds.values()}
    h, l, c = (number(F.col(name)) for name in ("High", "Low", "Close"))
    read, valid = {"n": F.col("_n")}, {}
    if "nc" in counts:
        read["c"], valid["nc"] = c, c.isNotNull()
    if "nf" in counts:
        read["f"] = number(F.col("FI"))
        valid["nf"] = read["f"].isNotNull()
    if fold.moves:
        valid["nb"] = h.isNotNull() & l.isNotNull() & c.isNotNull()
        hb, lb, cb = (number(F.col(f"_{name}_before")) for name in ("High", "Low", "Close"))
        up, down = h - hb, lb - l
        known = up.isNotNull() & down.isNotNull()
        span = F.greatest(h - l, F.abs(cb - h), F.abs(cb - l))
        moves = {"tr": F.when(known & cb.isNotNull(), span),
                 "up": F.when(known, F.when((up > 0) & (up > down), up).otherwise(F.lit(0.0))),
                 "down": F.when(known, F.when((down > 0) & (up < down), down).otherwise(F.lit(0.0)))}
        read |= {k: v for k, v in moves.items() if k in values}
    return read, valid


def fold_plan(ip: IndicatorParams, wanted: set[str]) -> tuple[Fold, dict[str, object], set[str]]:
    """The fold's fields for the ``wanted`` columns, each column as a function of a bar's
    state (``s(field)``, NULL before its seed) and counters (``seen(count)``), and those that need no counter."""
    fold, out, plain = Fold(), {}, set()

    def at(count, x):
        """The bar's number in a count (1: the first one)."""
        return x["n"] - F.col(f"_first_{count}") + 1

    def close_ema(n, skip=0):
        return fold.ema(f"e{n}_{skip}", n, "c", "nc", skip)

    for name in sorted(wanted):
        digits = name.removeprefix("_ema").removeprefix("EMA")
        if digits != name and digits.isdigit():
            out[name] = lambda s, seen, e=close_ema(int(digits)): s(e)
            plain.add(name)
        elif name.startswith("FI_") and name[3:].isdigit():
            n = int(name[3:])
            out[name] = lambda s, seen, e=fold.ema(f"f{n}", n, "f", "nf"): s(e)
            plain.add(name)
    if wanted & {"MACD", "MACD_signal", "MACD_hist"}:
        fast, slow = sorted((ip.macd_fast, ip.macd_slow))
        f_name, s_name = close_ema(fast, slow - fast), close_ema(slow)

        first, length, k = slow, ip.macd_signal, 2.0 / (ip.macd_signal + 1)

        def signal(a, x):
            """The line's running sum, its mean on row ``slow + n - 1``, the EMA after it."""
            row = at("nc", x) - 1
            line = a[f_name] - a[s_name]
            return (F.when(row >= first + length, (line - a["sig"]) * k + a["sig"]).when(row < first, F.lit(0.0))
                    .when(row == first + length - 1, (a["sig"] + line) / length).otherwise(a["sig"] + line))

        g_name = fold.add("sig", signal, late=1)
        shown = slow + ip.macd_signal - 1
        out |= {"MACD": lambda s, seen: F.when(seen("nc") >= shown, s(f_name) - s(s_name)),
                "MACD_signal": lambda s, seen: F.when(seen("nc") >= shown, s(g_name)),
                "MACD_hist": lambda s, seen: F.when(seen("nc") >= shown, s(f_name) - s(s_name) - s(g_name))}
    if "ATR" in wanted:
        of = ip.atr_period
        fold.seeded("atr", "tr", "nb", 1, of, of, lambda a, x: (a["atr"] * (of - 1) + x["tr"]) / of)
        out["ATR"] = lambda s, seen: s("atr")
        plain.add("ATR")

    def wilder(tag, n, value):
        """Plain sums of rows 1 .. n-1, Wilder's sum from row n on (0-based from the first valid bar)."""
        return fold.seeded(tag, value, "nb", 1, n - 1, 1, lambda a, x: a[tag] - a[tag] / n + x[value])

    def sums(prefix, n):
        return wilder(f"{prefix}p", n, "up"), wilder(f"{prefix}m", n, "down"), wilder(f"{prefix}t", n, "tr")

    if wanted & {"PLUS_DI", "MINUS_DI"}:
        of_di = ip.di_period
        p, m, t = sums("d", of_di)
        for name, part in (("PLUS_DI", p), ("MINUS_DI", m)):
            out[name] = lambda s, seen, part=part, t=t: F.when(
                seen("nb") > of_di, F.when(_zero(s(t)), F.lit(0.0)).otherwise(100.0 * (s(part) / s(t))))
    if "ADX" in wanted:
        n = ip.adx_period
        p, m, t = sums("w", n)

        def index(a, x):
            """The directional index from a bar's sums: -1 where it is undefined, NULL without sums."""
            mdi, pdi = 100.0 * (a[m] / a[t]), 100.0 * (a[p] / a[t])
            dx = F.when(~_zero(a[t]), F.when(~_zero(mdi + pdi), 100.0 * (F.abs(mdi - pdi) / (mdi + pdi))))
            return F.when(a[m].isNotNull() & a[p].isNotNull() & a[t].isNotNull(), F.coalesce(dx, F.lit(-1.0)))

        def average(a, x):
            """The index's running sum from row ``n + 1`` on, its mean on row ``2n``, Wilder's mean after it."""
            row, dx = at("nb", x) - 2, a["dx"]
            total = a["adx"] + F.when(dx < 0, F.lit(0.0)).otherwise(dx)
            return (F.when(row > 2 * n, F.when(dx < 0, a["adx"]).otherwise((a["adx"] * (n - 1) + dx) / n))
                    .when(row == 2 * n, total / F.lit(float(n))).when(row <= n, F.lit(0.0)).otherwise(total))

        fold.add("dx", index)
        fold.add("adx", average, late=2)
        out["ADX"] = lambda s, seen: F.when(seen("nb") >= 2 * n, s("adx"))
    return fold, out, plain


#: names that a fold makes for default parameters besides EMA and FI columns
RECURSIVE = ("MACD", "MACD_signal", "MACD_hist", "ADX", "PLUS_DI", "MINUS_DI", "ATR")


def recursive_columns(ip: IndicatorParams, pp: PatternParams) -> list[str]:
    hidden = {ip.bb_period, ip.sd17_period, ip.power_period, pp.ema_short, pp.ema_long} - set(ip.ema_periods)
    return [*RECURSIVE, *(f"EMA{n}" for n in ip.ema_periods), *(f"_ema{n}" for n in sorted(hidden)), *(f"FI_{n}" for n in ip.fi_periods)]


def states(fold: Fold) -> Column:
    """The state before every bar of ``_xs`` and the one after the last."""
    kind = _state_type(fold)
    start = F.struct(*(F.lit(None).cast("double").alias(k) for k in fold.fields))
    empty = F.array().cast(f"array<{kind}>")

    def bar_by_bar(last, bars):
        """The state after some bars and, for each of them, the state before it."""
        return F.aggregate(bars, F.struct(last.alias("last"), empty.alias("out")), lambda a, bar: F.struct(
            F.struct(*(v(a["last"], bar).alias(k) for k, v in fold.fields.items())).alias("last"),
            F.array_append(a["out"], a["last"]).alias("out")))

    def part_by_part(last, bars, size, inner):
        """The same, in parts of ``size`` bars that ``inner`` handles."""
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(bars) - 1) / size).cast("int")),
                            lambda i: F.slice(bars, i * size + 1, size))
        start = F.struct(F.struct(last.alias("last"), empty.alias("out")).alias("part"), empty.alias("done"))
        return F.aggregate(
            parts, start, lambda a, part: F.struct(inner(a["part"]["last"], part).alias("part"),
                                                   F.concat(a["done"], a["part"]["out"]).alias("done")),
            lambda a: F.struct(a["part"]["last"].alias("last"), F.concat(a["done"], a["part"]["out"]).alias("out")))

    folded = part_by_part(start, F.col("_xs"), BLOCK, lambda last, bars: part_by_part(last, bars, PART, bar_by_bar))
    return let(folded, lambda f: F.concat(f["out"], F.array(f["last"])))


def _state_type(fold: Fold) -> str:
    return "struct<" + ",".join(f"{k}:double" for k in fold.fields) + ">"


def previous_row_patterns(ip: IndicatorParams, pp: PatternParams, wanted: set[str], n: Column, now, before) -> dict[str, Column]:
    """The ``wanted`` of EMA cross, EMA slope, FI_13 spikes and the row ordinal ``n``; ``now(name)`` and ``before(name)`` are
    a recursive column of the row and of the previous one."""
    short, long = (f"EMA{n}" if n in ip.ema_periods else f"_ema{n}" for n in (pp.ema_short, pp.ema_long))
    last = f"FI_{ip.fi_periods[-1]}"
    made = {}
    if "rn" in wanted:
        made["rn"] = n
    if "EMA_bullbear" in wanted:
        gap, gap_before = now(short) - now(long), before(short) - before(long)
        made["EMA_bullbear"] = F.when((gap > 0) & (gap_before < 0), "Long").when((gap < 0) & (gap_before > 0), "Short")
    slope = f"EMA{pp.ema_short}_slope"
    if slope in wanted:
        made[slope] = now(short) - before(short)
    if wanted & {"FI_13_diff", "FI_13_Peak", "FI_13_Trough"}:
        fi, fi_before = now(last), before(last)
        step = fi - fi_before
        big = F.when(fi_before == 0, F.lit(True)).otherwise(F.abs(step / fi_before) * 100 >= pp.fi13_spike_pct)
        made |= {"FI_13_diff": step, "FI_13_Peak": F.coalesce((fi > 0) & (step > 0) & big, F.lit(False)),
                 "FI_13_Trough": F.coalesce((fi < 0) & (step < 0) & big, F.lit(False))}
    return {k: c for k, c in made.items() if k in wanted}
