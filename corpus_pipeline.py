"""Corpus pipeline: toxicity filter, line dedup, SimHash near-dedup, source
mixing and packing, each over all its predecessor kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import written
from candlewick.llm.line_dedup import dedup_lines
from candlewick.llm.mixing import mix_sources
from candlewick.llm.packing import pack
from candlewick.llm.simhash import one_of_each
from candlewick.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects (score 0.7 or more) go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go, all documents stay; ``n_chars`` follows the text."""
    cleaned = dedup_lines(docs)
    changed = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each(docs, shingle_words=4, radius=4)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at least once, none over twice as often as the least repeated one,
    in the order of the blocks' permutations."""
    mixed = mix_sources(docs, max_epochs=2.0).repartitionByRange("mix_block", "mix_order")
    return mixed.sortWithinPartitions("mix_block", "mix_order").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of 4096 tokens."""
    return pack(docs, sequence_tokens=4096).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("source_mixing", source_mixing), ("packing", packing)]

#: SQL can express neither the toxicity stage nor the tokenizer; tests/llm holds each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
