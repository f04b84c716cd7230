"""Connected components over an edge table, as joins and minima only.

Alternates the large-star and small-star contractions (Kiveris et al.,
"Connected Components in MapReduce and Beyond", 2014).  Each round moves
every node to the smallest neighbour it knows, so the table turns into stars
around the smallest id of each component in a logarithmic number of rounds.
No adjacency list is gathered: a hub is a join key, which the adaptive skew
join may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
    return (both.join(least, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("_m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                    F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31))).alias("s")).first()
    return row["n"], row["x"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``(node, component_id)`` for every node of ``edges(a long, b long)``;
    ``component_id`` is the smallest node of the component.  Self-loops and
    repeated edges are allowed, rows with a NULL end are ignored, and an empty
    table gives an empty result.  The loop ends when a round changes nothing."""
    known = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna(), "links")
    loops = known.filter("a = b").select(F.col("a").alias("node")).distinct()
    star = written(known.filter("a <> b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(star)
    while before[0]:
        star = written(_small_star(_large_star(star)), "stars")
        after = _state(star)
        if after == before:
            break
        before = after
    found = star.select(F.col("a").alias("node"), F.col("b").alias("component_id")).unionByName(
        star.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct())
    alone = loops.join(found, "node", "left_anti").select("node", F.col("node").alias("component_id"))
    return found.unionByName(alone)
