"""Table sources (src_table, src_incremental, src_ticker_from_path,
src_period_from_path, src_exclude_path)."""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """src_table: a Parquet table with a fixed schema; None when the path does
    not exist yet (first run).  Other errors propagate."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        df = reader.parquet(path)
        if schema is None:
            df.schema  # resolve now so a missing path is reported here
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def read_modified_between(spark: SparkSession, root: str, start: str, end: str | None = None, *,
                          schema: StructType, time_zone: str = "Asia/Taipei",
                          glob: str = "*.parquet") -> DataFrame:
    """src_incremental: only the files under ``root`` modified in [start, end)
    local time, ``YYYY-MM-DDTHH:MM:SS`` (pass the day as a parameter, e.g. today).

    The schema is given, so a day without new files is an empty frame.  Spark's
    ``modifiedAfter`` excludes its bound: it is set one second earlier and the
    files of that second are dropped by their modification time."""
    before = (datetime.fromisoformat(start) - timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
    r = (spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
         .option("modifiedAfter", before).option("timeZone", time_zone))
    if end:
        r = r.option("modifiedBefore", end)
    local = datetime.fromisoformat(start).replace(tzinfo=ZoneInfo(time_zone))
    return r.parquet(root).filter(F.unix_micros("_metadata.file_modification_time") >= int(local.timestamp()) * 1_000_000)


def with_ticker_from_path(df: DataFrame, column: str = "ticker") -> DataFrame:
    """src_ticker_from_path: ticker = file stem of the row's source file."""
    return df.withColumn(column, F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.parquet$", 1))


def with_period_from_path(df: DataFrame, column: str = "period") -> DataFrame:
    """src_period_from_path: period = second '_' token of the file stem
    (e.g. us_2W.parquet -> 2W)."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.parquet$", 1)
    return df.withColumn(column, F.split(stem, "_").getItem(1))


def exclude_paths(df: DataFrame, *fragments: str) -> DataFrame:
    """src_exclude_path: drop rows read from files whose path contains a fragment."""
    cond = F.lit(True)
    for frag in fragments:
        cond = cond & ~F.col("_metadata.file_path").contains(frag)
    return df.filter(cond)
