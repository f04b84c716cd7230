"""Extrema, swings and the searches between them as DataFrame expressions, without
a Python step (pt_local_extrema, pt_fi2_extrema, pt_higher_peak, pt_lower_trough,
pt_divergence, pt_power_top2).

1. Local maxima and minima: the middles of runs of equal values that begin with a
   rise and end with a fall, or the other way; runs are found by one pass over the values.
2. A series is one row with arrays of its values and candidates (bounded:
   one bar per calendar day of a ticker).  The minimum distance is a fold over
   the candidates from the highest down.  Prominence is decided by walking away
   from a peak until a sample is low enough or higher; the ``NEAR`` next samples
   decide nearly always, else the whole side is walked.
3. Swings compare a point with the points before it, divergences and power
   pairs fold over the bars between a swing's two points.

Every set of arrays that later expressions read is a generated column first, so
that no lambda holds (and repeats) the expression that makes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.recursions import let, number
from candlewick.params import IndicatorParams, PatternParams

NEAR = 16


def swing_columns(pp: PatternParams) -> list[str]:
    trends = [*(f"{name}_trend" for name, _ in pp.divergence), "Bull_Power_trend", "Bear_Power_trend"]
    return ["price_Peak", "price_Trough", "Higher_Peak", "Lower_Trough", "price_search", "FI_2_Peak", "FI_2_Trough",
            *(c for t in trends for c in (t, f"{t}_pair"))]


def made(df: DataFrame, kept, **columns: Column) -> DataFrame:
    """``kept`` and new columns, made once per row by a generator."""
    row = F.explode(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))).alias("_made")
    return df.select(*kept, row).select(*kept, "_made.*")


def _aligned(places: Column, size: Column, at_place, missing: Column) -> Column:
    """An array of ``size``: ``at_place(k)`` at the k-th of the rising ``places``, ``missing`` elsewhere; linear in its size."""
    def run(k):
        gap = F.coalesce(F.get(places, k), size) - F.coalesce(F.get(places, k - 1), F.lit(-1)) - 1
        rest = F.array_repeat(missing, gap)
        return F.when(k < F.size(places), F.concat(rest, F.array(at_place(k)))).otherwise(rest)
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places)), run))


def _runs(values: Column) -> Column:
    """The places where a run of equal values begins."""
    return F.filter(F.sequence(F.lit(0), F.size(values) - 1), lambda i: ~F.get(values, i).eqNullSafe(F.get(values, i - 1)))


def _turns(values: Column, runs: Column) -> Column:
    """Local maxima and minima, rising: twice the middle of a run that both neighbours are lower (and 1) or higher than."""
    def middle(at, following):
        v = F.get(values, at)
        rises, falls = F.get(values, at - 1) < v, F.get(values, following) < v
        return F.when(rises == falls, F.shiftright(at + following - 1, 1) * 2 + rises.cast("int"))
    return F.filter(F.zip_with(runs, F.slice(runs, 2, F.size(runs)), middle), lambda p: p.isNotNull())


def _places(turns: Column, high: int) -> Column:
    return F.transform(F.filter(turns, lambda p: p % 2 == high), lambda p: F.shiftright(p, 1))


def _apart(candidates: Column, values: Column, sign: int, distance: int) -> Column:
    """Candidates kept by the minimum distance: from the highest down, the later of equal ones first.

    Candidates rise; those parted by the distance or more do not touch each other, so each run of close ones is
    ranked alone and a candidate meets the kept ones of its run, not of the series."""
    if not distance or distance <= 1:
        return candidates

    def kept_of(run):
        ranked = F.sort_array(F.transform(run, lambda p: F.struct((F.get(values, p) * sign).alias("v"), p.alias("p"))), asc=False)
        kept = F.aggregate(ranked, F.array().cast("array<int>"), lambda kept, c: F.when(
            F.exists(kept, lambda y: F.abs(y - c["p"]) < distance), kept).otherwise(F.concat(kept, F.array(c["p"]))))
        return F.when(F.size(run) == 1, run).otherwise(kept)

    first = F.filter(F.sequence(F.lit(0), F.size(candidates) - 1),
                     lambda k: (k == 0) | (F.get(candidates, k) - F.get(candidates, k - 1) >= distance))

    def run(firsts, g):
        start = F.get(firsts, g)
        return F.slice(candidates, start + 1, F.coalesce(F.get(firsts, g + 1), F.size(candidates)) - start)

    runs = let(first, lambda firsts: F.transform(F.sequence(F.lit(0), F.size(firsts) - 1), lambda g: let(run(firsts, g), kept_of)))
    return F.when(F.size(candidates) < 2, candidates).otherwise(F.flatten(runs))


def _prominent(values: Column, place: Column, sign: int, least: float) -> Column:
    """Whether a peak stands ``least`` over the lowest sample of each side, walked until a higher one.  The next
    sample decides most often, so it is asked before any walk."""
    if least <= 0:
        return F.lit(True)
    high = F.get(values, place) * sign

    def walk(samples):
        step = lambda a, y: (F.when(a != 0, a).when(y.isNull() | (y * sign > high), -1)
                             .when(high - y * sign >= least, 1).otherwise(0))
        return F.aggregate(samples, F.lit(0), step, lambda a: F.when(a != 0, a))

    def side(following, near, whole):
        return F.coalesce(F.when(high - F.get(values, following) * sign >= least, 1), walk(near), walk(whole), F.lit(-1)) == 1

    first = F.greatest(place - NEAR, F.lit(0))
    return (side(place - 1, F.reverse(F.slice(values, first + 1, place - first)), F.reverse(F.slice(values, F.lit(1), place)))
            & side(place + 1, F.slice(values, place + 2, F.lit(NEAR)), F.slice(values, place + 2, F.size(values))))


def _swings(points: Column, price: Column, tolerance: Column, back: int, higher: bool) -> Column:
    """``(i, s)``: points beyond one of the ``back`` points before by at most the tolerance, with the earliest such."""
    def found(at):
        i = F.get(points, at)
        v, near = F.get(price, i), F.get(tolerance, i)

        def fits(j):
            u = F.get(price, j)
            return F.when(((v > u) if higher else (v < u)) & (F.abs(v - u) <= near), j)
        return F.struct(i.alias("i"), F.coalesce(*(fits(F.get(points, at - m)) for m in range(back, 0, -1))).alias("s"))
    at = F.when(F.size(points) > back, F.sequence(F.lit(back), F.size(points) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(at, found), lambda e: e["s"].isNotNull())


def _between(swing: Column, values: Column, entry) -> Column:
    """``entry(value)`` of the bars [s, i)."""
    return F.transform(F.slice(values, swing["s"] + 1, swing["i"] - swing["s"]), entry)


def _divergence(swing: Column, values: Column, threshold: float, down: bool) -> Column:
    """The bar of [s, i) with the largest change of ``values`` to i against the price; earliest of equal ones."""
    def search(last):
        def change(v):
            part = F.when(v == 0, F.lit(float("inf"))).otherwise(F.abs(last - v) / F.abs(v) * 100)
            return F.when((last < v) if down else (last > v), part)

        def largest(changes):
            return let(F.array_max(changes), lambda most: F.when(most >= threshold, swing["s"] + F.array_position(changes, most).cast("int") - 1))
        return let(_between(swing, values, change), largest)
    return let(F.get(values, swing["i"]), search)


def _power_pair(swing: Column, values: Column, sign: int) -> Column:
    """``j1_j2`` of the two largest values of a sign in [s, i), if the largest comes first; earliest of equal ones."""
    def pair(powers):
        def behind(j):
            rest = F.slice(powers, j + 1, F.size(powers))
            before, after = F.array_max(F.slice(powers, F.lit(1), j - 1)), F.array_max(rest)
            second = swing["s"] + j + F.array_position(rest, after).cast("int") - 1
            return F.when(after > F.coalesce(before, F.lit(0.0)), F.concat_ws("_", swing["s"] + j - 1, second))
        return let(F.array_position(powers, F.array_max(powers)).cast("int"), behind)
    return let(_between(swing, values, lambda v: F.when(v * sign > 0, v * sign)), pair)


def _asked(ip: IndicatorParams, pp: PatternParams, wanted: set[str]):
    """What the ``wanted`` columns ask for: indicators, bull and bear power, swings, price and force extrema."""
    bull, bear = (bool({f"{p}_Power_trend", f"{p}_Power_trend_pair"} & wanted) for p in ("Bull", "Bear"))
    indicators = [(n, t) for n, t in pp.divergence if {f"{n}_trend", f"{n}_trend_pair"} & wanted]
    swing = bool(bull or bear or indicators or wanted & {"Higher_Peak", "Lower_Trough", "price_search"})
    return indicators, bull, bear, swing, bool(swing or wanted & {"price_Peak", "price_Trough"}), bool(wanted & {"FI_2_Peak", "FI_2_Trough"})


def swing_values(ip: IndicatorParams, pp: PatternParams, wanted: set[str], power_column: str) -> dict[str, tuple[tuple[str, ...], object]]:
    """The values of a bar that the ``wanted`` columns are searched in: the columns each reads and a function of what reads them."""
    indicators, bull, bear, swing, price, force = _asked(ip, pp, wanted)
    values = {}

    def column(name, of=lambda c: c):
        return (name,), lambda bar: of(bar(name))

    if price:
        values["v_p"] = column(pp.price_column, number)
    if force:
        values["v_f"] = column(f"FI_{ip.fi_periods[0]}", number)
    if swing:
        values["v_atr"] = column("ATR")
    values |= {f"v_i{n}": column(name) for n, (name, _) in enumerate(indicators)}
    if bull:
        values["v_bull"] = ("High", power_column), lambda bar: bar("High") - bar(power_column)
    if bear:
        values["v_bear"] = ("Low", power_column), lambda bar: bar("Low") - bar(power_column)
    return values


def with_swings(series: DataFrame, kept, ip: IndicatorParams, pp: PatternParams, wanted: set[str],
                values) -> tuple[DataFrame, list[str], dict[str, Column]]:
    """``series`` (one row per series: ``kept``, among them its bars ``_rows``, and the arrays of ``values``) with arrays
    aligned with the bars; their names, and the ``wanted`` columns made of a bar's entries."""
    indicators, bull, bear, swing, price, force = _asked(ip, pp, wanted)
    turning = [k for k, on in (("p", price), ("f", force)) if on]
    turns = [f"{k}{s}" for k in turning for s in (1, 0)]
    sign = {t: 1 if t[1] == "1" else -1 for t in turns}
    arrays = [*kept, *values]
    rules = {"p": (pp.price_distance, pp.price_prominence), "f": (pp.fi2_distance, pp.fi2_prominence)}
    series = made(series, arrays, **{f"r_{k}": _runs(F.col(f"v_{k}")) for k in turning})
    series = made(series, arrays, **{f"t_{k}": _turns(F.col(f"v_{k}"), F.col(f"r_{k}")) for k in turning})
    series = made(series, arrays, **{f"c_{t}": _places(F.col(f"t_{t[0]}"), int(t[1])) for t in turns})
    series = made(series, arrays, **{f"k_{t}": _apart(F.col(f"c_{t}"), F.col(f"v_{t[0]}"), sign[t], rules[t[0]][0]) for t in turns})

    def points(t):
        v = F.col(f"v_{t[0]}")
        right = F.filter(f"k_{t}", lambda p: _prominent(v, p, sign[t], rules[t[0]][1]))
        return F.sort_array(F.filter(right, lambda p: F.get(v, p) * sign[t] > 0) if t[0] == "f" else right)

    series = made(series, arrays, **{f"e_{t}": points(t) for t in turns})
    marks = {"price_Peak": "e_p1", "price_Trough": "e_p0", "FI_2_Peak": "e_f1", "FI_2_Trough": "e_f0"}
    size = F.size("_rows")
    flags = {c: _aligned(F.col(e), size, lambda k: F.lit(True), F.lit(False)) for c, e in marks.items() if c in wanted}
    if swing:
        found = [f"e_{t}" for t in turns]
        series = made(series, [*arrays, *found], **{
            f"s{s}": _swings(F.col(f"e_p{s}"), F.col("v_p"), F.col("v_atr"), pp.search_quantity, s == 1) for s in (1, 0)})

        def event(s):
            """A swing with what is found in its interval."""
            down, word = s == 1, "Down" if s == 1 else "Up"

            def of(e):
                trends = {}
                for n, (name, threshold) in enumerate(indicators):
                    j = _divergence(e, F.col(f"v_i{n}"), threshold, down)
                    trends[f"{name}_trend_pair"] = F.when(j.isNotNull(), F.concat_ws("_", j, e["i"]))
                if bull:
                    trends["Bull_Power_trend_pair"] = _power_pair(e, F.col("v_bull"), 1) if down else F.lit(None).cast("string")
                if bear:
                    trends["Bear_Power_trend_pair"] = F.lit(None).cast("string") if down else _power_pair(e, F.col("v_bear"), -1)
                return F.struct(e["i"].alias("i"), e["s"].alias("s"), F.lit(word).alias("word"), *(c.alias(k) for k, c in trends.items()))
            return F.transform(f"s{s}", of)

        series = made(series, [*kept, *found], events=F.sort_array(F.concat(event(1), event(0))))
        series = made(series, [*kept, *found, "events"], at=F.transform("events", lambda e: e["i"]))
        flags["_event"] = _aligned(F.col("at"), size, lambda k: F.get("events", k), F.get("events", F.lit(-1)))
    out = {c: F.col(c) for c in flags if c != "_event"}
    if swing:
        word = F.col("_event.word")
        out |= {"Higher_Peak": F.coalesce(word == "Down", F.lit(False)), "Lower_Trough": F.coalesce(word == "Up", F.lit(False)),
                "price_search": F.col("_event.s")}
        for name in [*(n for n, _ in indicators), *(["Bull_Power"] if bull else []), *(["Bear_Power"] if bear else [])]:
            pair = F.col(f"_event.`{name}_trend_pair`")
            out |= {f"{name}_trend": F.when(pair.isNotNull(), word), f"{name}_trend_pair": pair}
    return made(series, kept, **flags), list(flags), {c: out[c] for c in swing_columns(pp) if c in wanted}
