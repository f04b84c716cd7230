"""Per-key window operators (wn_*).  ``row_number() <= k`` filters plan as
a WindowGroupLimit, so only k rows per key survive the sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _newest_first(keys, order="Date", tiebreak=()):
    return Window.partitionBy(*keys).orderBy(F.col(order).desc(), *[F.col(c).asc() for c in tiebreak])


def latest_row(df: DataFrame, keys=("ticker",), order: str = "Date", tiebreak=()) -> DataFrame:
    """wn_latest_row: the newest row per key."""
    rn = F.row_number().over(_newest_first(keys, order, tiebreak))
    return df.withColumn("_rn", rn).filter(F.col("_rn") == 1).drop("_rn")


def drop_latest_n(df: DataFrame, n: int = 2, keys=("ticker",), order: str = "Date", tiebreak=()) -> DataFrame:
    """wn_latest_n / wn_latest_n_period: all rows but the newest n per key."""
    rn = F.row_number().over(_newest_first(keys, order, tiebreak))
    return df.withColumn("_rn", rn).filter(F.col("_rn") > n).drop("_rn")


def latest_n(df: DataFrame, n: int = 2, keys=("ticker",), order: str = "Date", tiebreak=()) -> DataFrame:
    """The newest n rows per key."""
    rn = F.row_number().over(_newest_first(keys, order, tiebreak))
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= n).drop("_rn")


def dedupe_priority(df: DataFrame, key, priority: str = "_p", tiebreak=()) -> DataFrame:
    """wn_dedupe_priority: one row per key, lowest ``priority`` wins."""
    w = Window.partitionBy(*key).orderBy(F.col(priority).asc(), *[F.col(c).asc() for c in tiebreak])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def drop_latest_per_key(df: DataFrame, keys=("ticker",), order: str = "Date") -> DataFrame:
    """flt_drop_latest: drop the rows dated on each key's latest date."""
    latest = F.max(order).over(Window.partitionBy(*keys))
    return df.withColumn("_max", latest).filter(F.col(order) < F.col("_max")).drop("_max")
