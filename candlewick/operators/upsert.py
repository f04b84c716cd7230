"""Table maintenance (up_*): upserts and merges as anti-joins, unions and
windows.  Every merge is a shuffle join on its key columns (sort-merge for
two large sides; AQE turns it into a broadcast join only when the measured
side is small).  Keys must be non-NULL, as a NULL key would never match:
``with_known_key`` makes the job fail on one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.windows import dedupe_priority
from candlewick.schemas import GOLD_KEY


def _ts(value) -> Column:
    return value if isinstance(value, Column) else F.to_timestamp(F.lit(value))


def with_known_key(df: DataFrame, key) -> DataFrame:
    """``df``, whose evaluation fails at the first row with a NULL in ``key``."""
    for c in key:
        known = F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in key column {c}")).cast(df.schema[c].dataType))
        df = df.withColumn(c, known.otherwise(F.col(c)))
    return df


def stamp_company_batch(batch: DataFrame, batch_time) -> DataFrame:
    """New list rows stamped with the batch time and marked active."""
    return batch.select(F.col("cik").cast("bigint").alias("cik"), "ticker", "title",
                        _ts(batch_time).alias("last_updated"), F.lit(True).alias("is_active"))


def upsert_company_list(old: DataFrame | None, batch: DataFrame, batch_time) -> DataFrame:
    """up_company_list: rows of the old list missing from the batch stay with
    is_active = false; every batch row is inserted active."""
    new = stamp_company_batch(batch, batch_time)
    if old is None:
        return new
    new = with_known_key(new, ("cik", "ticker"))
    gone = (old.join(new.select("cik", "ticker"), ["cik", "ticker"], "left_anti")
            .select("cik", "ticker", "title", "last_updated", F.lit(False).alias("is_active")))
    return gone.unionByName(new)


def update_company_list(old: DataFrame | None, batch: DataFrame, batch_time) -> DataFrame:
    """up_company_list_update (older variant): update in place, append new
    keys; a NULL in the batch does not overwrite; active = stamped now."""
    new = stamp_company_batch(batch, batch_time).drop("is_active")
    if old is None:
        return new.withColumn("is_active", F.lit(True))
    o, n = old.alias("o"), new.alias("n")
    merged = o.join(n, ["cik", "ticker"], "full_outer").select(
        "cik", "ticker",
        F.coalesce(F.col("n.title"), F.col("o.title")).alias("title"),
        F.coalesce(F.col("n.last_updated"), F.col("o.last_updated")).alias("last_updated"),
    )
    return merged.withColumn("is_active", F.col("last_updated") >= _ts(batch_time))


def upsert_snapshot(old: DataFrame | None, new: DataFrame, key=("created_at", "ticker")) -> DataFrame:
    """up_snapshot: rows with the key of a new row are replaced, the rest
    kept; created_at is a DATE."""
    new = new.withColumn("created_at", F.to_date("created_at"))
    if old is None:
        return new
    old, new = old.withColumn("created_at", F.to_date("created_at")), with_known_key(new, key)
    return old.join(new.select(*key), list(key), "left_anti").unionByName(new, allowMissingColumns=True)


def upsert_gold_history(old: DataFrame | None, new: DataFrame, scope: str = "ticker_period") -> DataFrame:
    """up_gold_history: for tickers present in ``new`` the old newest 2 rows
    (per ticker, or per ticker and period) are released; new rows fill every
    (Date, ticker, period) the kept old rows do not have (old rows win).

    Old and new rows are stacked and every decision is a window over the
    ticker: one shuffle by ticker, no joins.  A ticker's history is bounded by
    its calendar span times the number of periods."""
    if old is None:
        return new
    from pyspark.sql.window import Window

    both = (old.withColumn("_p", F.lit(1))
            .unionByName(new.withColumn("_p", F.lit(2)), allowMissingColumns=True)
            .repartition("ticker"))
    by_ticker = Window.partitionBy("ticker")
    scope_keys = ["ticker"] if scope == "ticker" else ["ticker", "period"]
    newest = Window.partitionBy(*scope_keys, "_p").orderBy(F.col("Date").desc(), F.col("period").asc())
    flagged = both.select(
        "*",
        F.max(F.col("_p") == 2).over(by_ticker).alias("_upd"),
        F.row_number().over(newest).alias("_rn"))
    kept = flagged.filter((F.col("_p") == 2) | ~F.col("_upd") | (F.col("_rn") > 2)).drop("_upd", "_rn")
    # rows of one batch that share a key are told apart by all their values
    values = [c for c in kept.columns if c not in (*GOLD_KEY, "_p")]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in values])
    return dedupe_priority(kept.withColumn("_t", tie), GOLD_KEY, "_p", tiebreak=("_t",)).drop("_p", "_t")


def warehouse_merge(target: DataFrame, staged: DataFrame) -> DataFrame:
    """up_warehouse_merge of one period's partition: delete the target rows of
    the staged tickers dated on any of their newest-2 dates, then MERGE the
    staged rows on (Date, ticker, period): update matched, insert new.

    Both sides hold one period.  They are stacked and marked by windows over
    the ticker (one shuffle); the newest dates are found on key columns alone
    and meet the rows in a join on the date.  Other periods are not touched."""
    from pyspark.sql.window import Window

    rows = (target.withColumn("_src", F.lit(0))
            .unionByName(staged.withColumn("_src", F.lit(1)), allowMissingColumns=True)
            .repartition("ticker"))
    marked = rows.select("*", F.max("_src").over(Window.partitionBy("ticker")).alias("_staged"),
                         F.max("_src").over(Window.partitionBy("ticker", "Date")).alias("_replaced"))
    newest = Window.partitionBy("ticker").orderBy(F.col("Date").desc())
    dates = (rows.select("ticker", "Date", "_src", F.max("_src").over(Window.partitionBy("ticker")).alias("_staged"))
             .filter("_src = 0 AND _staged = 1").withColumn("_rn", F.row_number().over(newest))
             .filter("_rn <= 2").select("Date").distinct())
    new = marked.filter("_src = 1")
    old = marked.filter("_src = 0 AND _replaced = 0")
    kept = old.join(dates.withColumn("_hot", F.lit(1)), "Date", "left").filter("_staged = 0 OR _hot IS NULL")
    return kept.select(*target.columns).unionByName(
        new.select(*[c for c in rows.columns if c != "_src"]), allowMissingColumns=True)
