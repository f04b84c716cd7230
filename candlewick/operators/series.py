"""The series step: every bar series becomes one row of arrays, once.

Recursions, previous-row patterns, extrema, swings and the searches between them
are all made on these arrays, which are unfolded into bars at the end; a bar is
sorted, collected and unfolded once, however many of them are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.recursions import bar_columns, fold_plan, let, previous_row_patterns, states
from candlewick.operators.swings import made, swing_values, with_swings
from candlewick.params import IndicatorParams, PatternParams

KEY = ("ticker", "period")


def outside_stage(df: DataFrame, *more: Column) -> DataFrame:
    """All columns of ``df`` and ``more``, projected outside whole-stage code.

    One expression without generated code (here the date) has a projection compiled column by column;
    for gold's columns the one method of a stage passes 8,000 bytes, beyond which the JVM only interprets it."""
    return df.select(*(let(F.col(c), lambda v: v).alias(c) if c == "Date" else F.col(f"`{c}`") for c in df.columns), *more)


def _values(states: Column, field: str) -> Column:
    return F.transform(states, lambda s: s[field])


def with_series(df: DataFrame, ip: IndicatorParams, pp: PatternParams, in_fold: set[str], by_row: set[str],
                in_swings: set[str], power_column: str) -> DataFrame:
    """``df`` (one row per bar, with ``row_columns``) with the recursive columns ``in_fold``, the previous-row columns
    ``by_row`` and the columns ``in_swings``; every other column but ``row_columns`` passes through."""
    hidden = ("_n", "_High_before", "_Low_before", "_Close_before")
    given = [c for c in df.columns if c not in (*KEY, *hidden)]
    if not (in_fold or in_swings):
        return df.select(*KEY, *(F.col(f"`{c}`") for c in given), *(F.col("_n").alias(c) for c in by_row))
    fold, out, plain = fold_plan(ip, in_fold)
    read, valid = bar_columns(fold)
    # a collection evaluates what it collects without generated code, so its fields are columns before it; the
    # optimizer moves them into it unless one that costs is read twice, as the values with a count are
    ready = df.select(*KEY, *(F.col(f"`{c}`") for c in given), *(c.alias(f"_x_{k}") for k, c in read.items()),
                      *(F.when(ok, F.col("_n")).alias(f"_in_{k}") for k, ok in valid.items()))
    counted_from = {k: F.when(F.col(f"_x_{v}").isNotNull(), F.col("_x_n")) for k, v in (("nc", "c"), ("nf", "f"))}
    bar = F.struct(F.struct(*(F.col(f"_x_{k}").alias(k) for k in read)).alias("x"), F.struct(*(F.col(f"`{c}`") for c in given)).alias("row"))
    series = ready.groupBy(*KEY).agg(F.sort_array(F.collect_list(bar)).alias("_rows"),
                                     *(F.min(counted_from.get(k, F.col(f"_in_{k}"))).alias(f"_first_{k}") for k in valid))
    kept = [*KEY, "_rows", *(f"_first_{k}" for k in valid)]
    beside = {}
    if in_fold:
        series = made(series, kept, _xs=fold.bars(read), **fold.starts())
        series = made(series, kept, _states=states(fold))
        n = F.size("_rows")
        beside = {"_now": F.slice("_states", F.lit(2), n)}
        if by_row - {"rn"}:
            beside["_before"] = F.slice("_states", F.lit(1), n)
        beside |= {f"_late_{field}": _values(F.slice("_states", F.lit(2 + late), n), field) for field, late in fold.late.items()}
        series = made(series, kept, **beside)
        kept += beside

    def counted(n, back=0):
        return lambda count: n - F.col(f"_first_{count}") + (1 - back)

    def reads(r, i):
        """A column of the ``i``-th bar from its row ``r`` and the states beside it."""
        state = lambda f: F.get(f"_late_{f}", i) if f in fold.late else F.get("_now", i)[f]
        return lambda name: out[name](state, counted(i)) if name in out else r["row"][name]

    if in_swings:
        def array(names, value):
            if plain.issuperset(names):
                return F.transform("_now", lambda s: value(lambda name: out[name](lambda f: s[f], None)))
            return F.transform("_rows", lambda r, i: value(reads(r, i)))

        values = swing_values(ip, pp, in_swings, power_column)
        arrays = {k: array(*v) for k, v in values.items()}
        series, marks, swung = with_swings(made(series, kept, **arrays), kept, ip, pp, in_swings, list(values))
    else:
        marks, swung = [], {}
    firsts = [c for c in kept if c.startswith("_first_")]
    bars = series.select(*KEY, *firsts, F.inline(F.arrays_zip("_rows", *beside, *marks)))
    n = F.col("_rows.x.n")
    now = {name: c(lambda f: F.col(f"_late_{f}" if f in fold.late else f"_now.{f}"), counted(n)) for name, c in out.items()}
    before = {name: (lambda c=c: c(lambda f: F.col(f"_before.{f}"), counted(n, 1))) for name, c in out.items()}
    own = {c: F.col(f"_rows.row.`{c}`") for c in given}
    own["Date"] = let(own["Date"], lambda v: v)  # as outside_stage does
    patterns = previous_row_patterns(ip, pp, by_row, n, now.__getitem__, lambda name: before[name]())
    made_columns = {**own, **now, **patterns, **swung}
    return bars.select(*KEY, *(c.alias(k) for k, c in made_columns.items()))
