"""The flagship query: the whole history pipeline from line items to the
entry-conclusion mart, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.plans.jobs import job_conclusion, job_gold
from candlewick.sources import fixtures as fx


SIGNALS = ("Side_1", "Side_2", "Side_3")


def gold_wide(spark: SparkSession, sf_dir: str, gap_policy: str = "drop", columns=None) -> DataFrame:
    return job_gold(fx.with_silver_columns(fx.bars_wide(spark, sf_dir)), gap_policy=gap_policy, columns=columns)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry conclusion over one series per supplier; only the signals that the
    mart shows are computed.  Gaps are dropped: at small scale some weekly bins
    of these series are empty."""
    return job_conclusion(gold_wide(spark, sf_dir, columns=SIGNALS))
