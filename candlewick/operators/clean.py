"""Cleaning and audit operators (flt_clean_ohlcv, ag_clean_audit, ag_status_summary)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.schemas import OHLCV

SILVER_COLUMNS = ["ticker", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume",
                  "Dividends", "Stock Splits", "created_at"]


def _present(c: str) -> Column:
    col = F.col(f"`{c}`")
    return col.isNotNull() & ~F.isnan(col) if c != "Volume" else col.isNotNull()


def valid_row() -> Column:
    """All six OHLCV values present (NULL and NaN both count as missing)."""
    cond = F.col("Date").isNotNull()
    for c in OHLCV:
        cond = cond & _present(c)
    return cond


def clean_ohlcv(bronze: DataFrame) -> DataFrame:
    """flt_clean_ohlcv: keep rows with every OHLCV value, project the silver
    columns and cast Date to DATE.  The IS NOT NULL tests reach the Parquet
    scan as pushed filters."""
    return bronze.filter(valid_row()).select(
        "ticker", F.to_date("Date").alias("Date"),
        *[F.col(f"`{c}`") for c in SILVER_COLUMNS[2:]])


def clean_audit(bronze: DataFrame) -> DataFrame:
    """ag_clean_audit: per input ticker raw / kept / dropped row counts and
    status.  A ticker whose rows were read is 'success' even when every row
    was dropped (as in the reference); a read failure fails the Spark job
    itself instead of producing a 'failed' row."""
    return (
        bronze.groupBy("ticker")
        .agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(valid_row()).alias("kept_rows"))
        .select("ticker", "raw_rows", "kept_rows",
                (F.col("raw_rows") - F.col("kept_rows")).alias("dropped_rows"),
                F.lit("success").alias("status"))
    )


def status_summary(items: DataFrame, stage: str = "stage") -> DataFrame:
    """ag_status_summary: the number of items (item, status) per stage and
    status.  The items themselves stay rows of ``items``: a list of all of
    them would be one unbounded value."""
    return items.groupBy(stage, "status").agg(F.count(F.lit(1)).alias("n_items"))
