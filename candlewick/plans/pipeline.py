"""End-to-end batch pipeline with written stage boundaries.

Each stage reads the previous stage's table and writes its own, so a lost
executor only recomputes inside one stage and lineage never spans the whole
chain.  Tables are written to the shared folders given by the caller (on a
cluster: distributed storage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.upsert import upsert_gold_history
from candlewick.params import PERIODS
from candlewick.plans.jobs import job_conclusion, job_gold, job_silver
from candlewick.sinks.files import current_version, write_dated_parquet, write_parquet, write_version


def run_silver(bronze: DataFrame, silver_path: str) -> None:
    write_dated_parquet(job_silver(bronze), silver_path)


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, gap_policy: str = "drop") -> None:
    """job_gold: one table partitioned by period (partition pruning for the
    per-period staging views)."""
    silver = spark.read.parquet(silver_path)
    write_dated_parquet(job_gold(silver, gap_policy=gap_policy), gold_path, partition_by=["period"])


def run_history(spark: SparkSession, gold_path: str, history_root: str, scope: str = "ticker_period") -> str:
    """job_history: merge the new gold into the versioned history table."""
    new = spark.read.parquet(gold_path)
    cur = current_version(spark, history_root)
    old = spark.read.parquet(cur) if cur else None
    merged = upsert_gold_history(old, new, scope=scope)
    return write_version(history_order(merged), history_root, partition_by=["period"])


def history_order(history: DataFrame) -> DataFrame:
    """so_history: newest first, then by ticker.  The files of a period are each
    in that order (the period leads, so the partitioned write keeps it)."""
    return history.sortWithinPartitions("period", F.col("Date").desc(), F.col("ticker").asc())


def run_conclusion(spark: SparkSession, history_path: str, mart_path: str, as_of: str | None = None) -> None:
    """job_conclusion / snk_mart: the mart from the written history table."""
    gold = spark.read.parquet(history_path)
    write_parquet(job_conclusion(gold, as_of=as_of), mart_path)


def run_staged_merge(spark: SparkSession, target_root: str, staged: DataFrame, period: str) -> str:
    """snk_staged_merge: merge one period's staged rows into that period's
    versioned table under ``target_root`` (delete newest-2 dates of the staged
    tickers, then MERGE on (Date, ticker, period)).  Other periods are neither
    read nor written; the new version shows only once its write is committed."""
    from candlewick.operators.upsert import warehouse_merge

    root = f"{target_root}/period={period}"
    cur = current_version(spark, root)
    merged = staged if cur is None else warehouse_merge(spark.read.parquet(cur), staged)
    return write_version(merged, root)


def read_warehouse(spark: SparkSession, target_root: str, periods=PERIODS) -> DataFrame | None:
    """The current versions of the warehouse's periods as one table."""
    out = None
    for period in periods:
        cur = current_version(spark, f"{target_root}/period={period}")
        if cur:
            rows = spark.read.parquet(cur)
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
