"""Sinks (snk_*): Parquet tables, dated Parquet, tick landing JSON and the
CSV report.  Writes are distributed (one file per task); nothing is
collected to the driver."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalars import fill_text


def layer_path(path: str, src: str = "bronze", dst: str = "silver") -> str:
    """snk_silver_path: the same object path one layer up (first occurrence only)."""
    return path.replace(f"{src}/", f"{dst}/", 1)


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    """snk_parquet: overwrite a Parquet table, snappy-compressed."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_dated_parquet(df: DataFrame, path: str, partition_by=None) -> None:
    """snk_parquet_dated: Date forced to DATE and placed first."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != "Date"]
    write_parquet(df.select(F.to_date("Date").alias("Date"), *rest), path, partition_by)


def write_version(df: DataFrame, table_root: str, partition_by=None) -> str:
    """snk_read_modify_write: a table that is read, merged and rewritten is
    written to a fresh version directory, as Spark cannot overwrite a path it
    is reading.  Names sort by time and the commit marker of the write makes a
    version visible, so there is no pointer that could be lost."""
    version = f"{table_root}/v={time.time_ns():020d}-{uuid.uuid4().hex}"
    write_parquet(df, version, partition_by, mode="errorifexists")
    return version


def current_version(spark, table_root: str) -> str | None:
    """Path of the newest committed version; None only if ``table_root`` does
    not exist (first run).  A root without a committed version is an error:
    taking it for a first run would replace the history by the new rows."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(table_root)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return None
    found = files.globStatus(hadoop.Path(root, "v=*/_SUCCESS"))
    if not found:
        raise RuntimeError(f"{table_root} exists but holds no committed version")
    return f"{table_root}/{max(s.getPath().getParent().getName() for s in found)}"


def write_tick_landing(ticks: DataFrame, path: str, tz: str = "America/New_York") -> None:
    """snk_tick_landing: JSON lines per symbol and local trade date."""
    from candlewick.operators.ticks import local_time
    date = F.to_date(local_time(F.col("t"), tz))
    ticks.withColumn("date", date).write.mode("append").partitionBy("s", "date").json(path)


def report_frame(conclusion: DataFrame) -> DataFrame:
    """snk_report / so_report: Date_D desc, ticker asc; Date_* columns as
    'YYYY-MM-DD'; every value as text with NULL shown as 'None'.

    A global sort reads its input twice (bounds of the ranges, then the rows),
    so the rows are shuffled once before it: both reads start at that shuffle
    instead of computing the mart twice."""
    cols = []
    for c in conclusion.columns:
        col = F.col(c)
        if c.startswith("Date_"):
            col = F.date_format(col, "yyyy-MM-dd")
        cols.append(fill_text(col).alias(c))
    tasks = int(conclusion.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = conclusion.repartition(tasks, "ticker", "Date_D")
    return kept.orderBy(F.col("Date_D").desc(), F.col("ticker").asc()).select(*cols)


def write_report(conclusion: DataFrame, path: str) -> None:
    report_frame(conclusion).write.mode("overwrite").option("header", True).csv(path)
