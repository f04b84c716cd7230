"""Line dedup: lines spread over many sites are boilerplate.

Each line is two 64-bit hashes of its normalised form.  One aggregation gives
every line a HyperLogLog sketch of its sites (sketches merge, so a line that
holds a third of all rows is summed up before the shuffle), its first place
and its words.  Lines whose estimate is near the threshold get exact distinct
counts.  Only places (document key, line number) travel; texts are shuffled
once, to meet their removed line numbers.  DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import shuffled, written

#: (words at least, distinct sites at least): the longer a line, the less likely
#: is it that independent authors wrote it, so the fewer sites prove a copy
SPREAD = ((1, 10), (8, 3), (30, 2))


def _needed(words: Column, spread: Sequence[tuple[int, int]]) -> Column:
    out = F.lit(None).cast("long")
    for least, sites in sorted(spread):
        out = F.when(words >= least, F.lit(sites).cast("long")).otherwise(out)
    return out


def line_places(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                site_col: str = "source") -> DataFrame:
    """``(doc, mark, pos, site, h1, h2, words)`` of every line that is not blank.

    A line is normalised by trimming, one blank between words and lower case;
    ``mark`` is a hash of the text, so rows that repeat a doc_id with another
    text stay apart; a NULL site is a site of its own."""
    flat = F.regexp_replace(F.lower(F.col(text_col)), r"[ \t\x0B\f\r]+", " ")
    lines = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(F.col(text_col)).alias("mark"),
                        F.coalesce(F.concat(F.lit("="), F.col(site_col).cast("string")), F.lit("")).alias("site"),
                        F.posexplode(F.transform(F.split(flat, "\n"), lambda x: F.trim(x))).alias("pos", "line"))
    return lines.filter("line <> ''").select(
        "doc", "mark", "pos", "site", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"),
        (F.length("line") - F.length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1).alias("words"))


def boilerplate(places: DataFrame, *, spread: Sequence[tuple[int, int]] = SPREAD, lg_k: int = 10) -> DataFrame:
    """``(h1, h2, doc, mark, pos)``: the lines to remove, with the first place of each.

    ``lg_k`` sizes the sketches.  An estimate within three standard errors of
    the threshold is replaced by an exact count of distinct sites; if the
    standard error there is under a sixth of a site, only the threshold itself
    is that near."""
    error = 3 * 1.04 / math.sqrt(1 << lg_k)
    need, margin = F.col("need"), F.when(F.col("need") * error >= 0.5, F.ceil(F.col("need") * error)).otherwise(0)
    lines = places.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"),
        F.min(F.struct("doc", "mark", "pos")).alias("first"), F.max("words").alias("words"))
    spread_out = written(lines.withColumn("need", _needed(F.col("words"), spread))
                         .filter(F.col("sites") >= need - margin)
                         .withColumn("near", F.col("sites") <= need + margin), "spread")
    near = spread_out.filter("near").select("h1", "h2", "need")
    exact = (places.join(near, ["h1", "h2"]).groupBy("h1", "h2", "need", "site").agg(F.lit(1).alias("one"))
             .groupBy("h1", "h2", "need").agg(F.count("*").alias("n")).filter("n >= need").select("h1", "h2"))
    sure = spread_out.filter("not near").select("h1", "h2")
    return spread_out.join(sure.unionByName(exact), ["h1", "h2"], "left_semi").select("h1", "h2", "first.*")


def dedup_lines(docs: DataFrame, *, spread: Sequence[tuple[int, int]] = SPREAD, lg_k: int = 10, keep_first: bool = True,
                id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``docs`` without cross-site boilerplate lines, with ``lines_removed`` added.

    Every row stays.  A line is boilerplate if its distinct sites reach the
    number ``spread`` asks for its words; all its places lose it but the first
    in order of (doc_id, text hash, line number), which keeps one copy in the
    corpus (``keep_first=False``: that too).  Other lines and blank lines keep
    their text and order; an untouched text is returned as it was.  NULL texts
    stay NULL, empty ones empty.  A NULL doc_id comes first in the order.
    Equal rows (same id and text) count as one document.  Other columns pass
    through, unless named ``lines_removed``, which is replaced."""
    places = written(line_places(docs, id_col=id_col, text_col=text_col, site_col=site_col), "lines")
    lines = boilerplate(places, spread=spread, lg_k=lg_k).select(
        "h1", "h2", F.struct(F.col("doc"), F.col("mark"), F.col("pos")).alias("first"))
    found = places.join(lines, ["h1", "h2"])
    if keep_first:
        found = found.filter(~F.struct("doc", "mark", "pos").eqNullSafe(F.col("first")))
    gone = (found.groupBy(F.col("doc").alias("_cw_doc"), F.col("mark").alias("_cw_mark"))
            .agg(F.collect_set("pos").alias("_cw_gone")))
    gone = written(gone, "removed")
    rows = docs.drop("lines_removed")
    text = F.col(text_col)
    meets = (rows[id_col].cast("long").eqNullSafe(gone["_cw_doc"])
             & (F.xxhash64(rows[text_col]) == gone["_cw_mark"]))
    joined = rows.join(shuffled(gone), meets, "left")
    split = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_cw_gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("_cw_lines"), i)), "\n")
    # one generated row per document: Spark would put a plain projection's split into the lambda, once per line
    lines = F.explode(F.array(F.when(F.col("_cw_gone").isNotNull(), split))).alias("_cw_lines")
    return (joined.select("*", lines)
            .withColumn(text_col, F.when(F.col("_cw_gone").isNotNull(), kept).otherwise(text))
            .withColumn("lines_removed", F.coalesce(F.size("_cw_gone"), F.lit(0)))
            .drop("_cw_doc", "_cw_mark", "_cw_gone", "_cw_lines"))
