"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from candlewick.session import ensure_checkpoint_dir, ship_package

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = re.compile(r"\s")


def prepared(spark: SparkSession) -> SparkSession:
    """Make the package importable on the executors and return the session."""
    ship_package(spark)
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that were running,
    because finished results are files that every executor can read."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/candlewick-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(keys: DataFrame) -> DataFrame:
    """A table of ids that grows with the corpus, for a join with its texts: dealt
    out by key at every size, never broadcast, and texts need no sort."""
    return keys.hint("shuffle_hash")


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of ``data`` in blocks of about ``size`` bytes,
    so that a very long text never becomes one long list."""
    start = 0
    while start < len(data):
        end = min(start + size, len(data))
        if end < len(data):
            blank = _BLANK.search(data, end)
            end = blank.start() if blank else len(data)
        words = data[start:end].split()
        if words:
            yield words
        start = end


def text_blocks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut at white space."""
    start = 0
    while start < len(text):
        end = min(start + size, len(text))
        if end < len(text):
            blank = _SPACE.search(text, end)
            end = blank.start() if blank else len(text)
        yield text[start:end]
        start = end


def text_parts(texts: pa.Array, size: int = 2_000_000) -> Iterator[pa.Array]:
    """An Arrow array of texts in slices of about ``size`` bytes; a longer text is a slice of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    part = np.cumsum(sizes) // size
    start = 0
    for end in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]:
        if end > start:
            yield texts.slice(start, end - start)
        start = end


def blank_separated(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of an Arrow array of texts (none NULL), and the number of each word's text."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    ends = np.asarray(lists.offsets).astype(np.int64)
    of = np.searchsorted(ends[1:] - ends[0], np.arange(len(words)), side="right")
    full = np.asarray(pc.binary_length(words)) > 0
    return words.filter(pa.array(full)), of[full]
