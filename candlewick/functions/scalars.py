"""Scalar functions (sc_*): all built from JVM-side Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.DecimalType, T.LongType, T.IntegerType, T.ShortType)


def truncate(col: Column, digits: int = 2) -> Column:
    """Truncate toward zero to ``digits`` decimals (sc_trunc2 / sc_trunc3).

    Stays in double: NaN gives NULL, and a value whose scaled form is beyond
    2**53 has no such decimals and is returned as it is (so is infinity)."""
    scale = float(10 ** digits)
    value = col.cast("double")
    scaled = value * scale
    return (F.when(F.isnan(value), F.lit(None).cast("double"))
            .when(F.abs(scaled) >= float(1 << 53), value)
            .otherwise((scaled - scaled % 1.0) / scale))


def truncate_numeric(df: DataFrame, digits: int = 2, exclude=()) -> DataFrame:
    """Truncate every floating column; integer columns are already exact."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name not in exclude and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(truncate(c, digits).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def to_numeric(col: Column) -> Column:
    """Text or number to double; unparsable text becomes NULL (sc_to_numeric)."""
    return col.cast("string").try_cast("double")


def inf_to_null(col: Column) -> Column:
    """+-Infinity (text or value) to NULL (sc_inf_to_null)."""
    return F.when(F.abs(col) == F.lit(float("inf")), F.lit(None).cast("double")).otherwise(col)


def nan_to_null(col: Column) -> Column:
    """NaN to NULL (sc_nan_to_null)."""
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def none_text_to_null(col: Column) -> Column:
    """The texts 'None' / 'none' to NULL (sc_none_text)."""
    return F.when(col.isin("None", "none"), F.lit(None).cast("string")).otherwise(col)


def fill_text(col: Column) -> Column:
    """Value as text, NULL as the text 'None' (sc_fill_text)."""
    return F.coalesce(col.cast("string"), F.lit("None"))


def epoch_ms_local(col: Column, tz: str = "America/New_York") -> Column:
    """Epoch milliseconds to a local wall-clock TIMESTAMP_NTZ (sc_epoch_tz)."""
    from candlewick.operators.ticks import local_time
    return local_time(col, tz)


def time_key(col: Column, kind: str) -> Column:
    """Time keys 'YYYYMMDD', 'YYYYMM' or 'YYYYMMDD_HHMMSS' (sc_time_key)."""
    fmt = {"day": "yyyyMMdd", "month": "yyyyMM", "second": "yyyyMMdd_HHmmss"}[kind]
    return F.date_format(col, fmt)


def safe_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """num / den truncated; NULL when den is 0 or NULL (sc_ratio)."""
    return truncate(F.try_divide(num, F.when(den != 0, den)), digits)
