"""Mixing sources to target weights: temperature, bisection, block permutations.

Source shares are raised to an exponent and normalised; the exponent is
bisected until the mix meets a target entropy or a repetition limit.  Each
source is then written out as whole random permutations of its documents
(blocks) and the part of one more that its token budget asks for.  The part
is a cut in the block's order, found from token totals of slices of that
order, so no source is sorted in one task and texts are not shuffled.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm.common import written

#: points per pass over the sources and passes: 6 halvings each, 48 in all
POINTS, PASSES = 63, 8


def word_count(text: Column) -> Column:
    """Blank-separated words of a text; NULL and blank texts have none."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+", " "))
    return F.when(flat == "", F.lit(0)).otherwise(
        F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def _at(sources: DataFrame, points: list[float]) -> dict[float, dict[str, float]]:
    """Entropy and largest relative repetition of the mix at each exponent.

    The repetition of a source is its share of the mix over its share of the
    tokens, relative to the source repeated least."""
    powered = (sources.filter("tokens > 0")
               .withColumn("a", F.explode(F.array(*[F.lit(p) for p in points])))
               .withColumn("q", F.pow(F.col("share"), F.col("a"))))
    sums = powered.groupBy("a").agg(F.sum("q").alias("z"), F.sum(F.col("q") * F.log("q")).alias("qlogq"),
                                    F.max(F.col("q") / F.col("share")).alias("most"),
                                    F.min(F.col("q") / F.col("share")).alias("least"))
    return {r["a"]: {"entropy": math.log(r["z"]) - r["qlogq"] / r["z"], "epochs": r["most"] / r["least"]}
            for r in sums.collect()}


def fit_exponent(sources: DataFrame, *, target_entropy: float | None = None, max_epochs: float | None = None) -> float:
    """The smallest exponent at which the mix is no flatter than asked:
    entropy (nats) at most ``target_entropy`` and no source repeated over
    ``max_epochs`` times as often as the least repeated one.  Entropy and
    repetition fall as the exponent grows to 1, so it is bisected.  A target under
    the sources' own entropy asks for an exponent over 1, where repetition rises
    again: a pair of targets that no exponent meets is an error, as is an entropy
    that none up to 32 reaches.  Without a target it is 1: the sources' own shares."""
    if target_entropy is None and max_epochs is None:
        return 1.0
    def fits(found: dict[str, float]) -> bool:
        return ((target_entropy is None or found["entropy"] <= target_entropy)
                and (max_epochs is None or found["epochs"] <= max_epochs))

    ends = _at(sources, [0.0, 1.0])
    if not ends or fits(ends[0.0]):
        return 0.0
    low, high = 0.0, 1.0  # does not fit, fits
    entropy = ends[1.0]["entropy"]  # if that is met, the shares themselves fit
    while target_entropy is not None and entropy > target_entropy + 1e-12:
        if high >= 32:
            raise ValueError(f"no exponent up to {high} reaches an entropy of {target_entropy}: {entropy}")
        low, high = high, 2 * high
        entropy = _at(sources, [high])[high]["entropy"]
    if high > 1:  # repetition rises here: the smallest exponent that meets the entropy, or none
        limit, max_epochs = max_epochs, None
    for _ in range(PASSES):
        points = [low + (high - low) * i / (POINTS + 1) for i in range(1, POINTS + 1)]
        found = _at(sources, points)
        good = [p for p in points if fits(found[p])]
        bad = [p for p in points if not fits(found[p])]
        low, high = max(bad, default=low), min(good, default=high)
    if high > 1 and limit is not None and _at(sources, [high])[high]["epochs"] > limit:
        raise ValueError(f"no exponent meets an entropy of {target_entropy} and {limit} epochs")
    return high


def _order(block: Column, doc: Column, seed: int) -> Column:
    """A document's place in a block of its source: 32 hexadecimal digits."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), block.cast("string"), F.coalesce(doc.cast("string"), F.lit(""))))


def source_plan(keys: DataFrame, *, budget_tokens: int | None, target_entropy: float | None, max_epochs: float | None,
                seed: int, slice_docs: int) -> DataFrame:
    """``(source, tokens, docs, weight, whole, cut)`` from ``keys(doc_id, source, tokens)``:
    the normalised weight, whole blocks, and the order key up to which the
    next block is taken (NULL: not at all)."""
    sums = written(keys.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    sources = sums.withColumn("share", F.when(F.col("tokens") > 0, F.col("tokens") / F.lit(total)))
    a = fit_exponent(sources, target_entropy=target_entropy, max_epochs=max_epochs)
    power = F.when(F.col("tokens") > 0, F.pow("share", F.lit(a)))
    one = sources.agg(F.sum(power).alias("z"), F.min(power / F.col("share")).alias("least")).first()
    z = one["z"] or 1.0
    # without a budget: as much as gives the least repeated source exactly one whole block
    scale = 1.0 / one["least"] if budget_tokens is None and one["least"] else (budget_tokens or 0) / (z * (total or 1))
    epochs = F.coalesce(power / F.col("share") * scale, F.lit(1.0))
    whole = F.floor(epochs + 1e-9)
    plan = sources.select("source", "tokens", "docs", F.coalesce(power / z, F.lit(0.0)).alias("weight"),
                          whole.alias("whole"),
                          F.greatest(F.lit(0), F.floor((epochs - whole) * F.col("tokens") + 0.5)).alias("rest"))
    plan = plan.withColumn("slices", F.ceil(F.col("docs") / slice_docs))

    # the next block: tokens per slice of its order, then inside the slice that holds the cut
    asked = plan.filter("rest > 0").select(F.col("source").alias("s"), "whole", "rest", "slices")
    placed = keys.join(asked, keys["source"].eqNullSafe(asked["s"])).select(
        "source", "tokens", "rest", "slices", _order(F.col("whole"), F.col("doc_id"), seed).alias("key"))
    head = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    placed = placed.withColumn("slice", F.floor(head * F.col("slices") / F.lit(1 << 32)))
    upto = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = (placed.groupBy("source", "rest", "slice").agg(F.sum("tokens").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
              .filter("before < rest and before + n >= rest")
              .select(F.col("source").alias("s"), F.col("slice").alias("sl"), "before"))
    within = W.partitionBy("source").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    last = (placed.join(slices, placed["source"].eqNullSafe(slices["s"]) & (F.col("slice") == F.col("sl")))
            .withColumn("upto", F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
            .filter("upto < rest").groupBy("source").agg(F.max("key").alias("cut")))
    last = last.withColumnRenamed("source", "s")
    return written(plan.join(last, plan["source"].eqNullSafe(last["s"]), "left")
                   .select("source", "tokens", "docs", "weight", "whole", "cut"), "plan")


def mix_sources(docs: DataFrame, *, budget_tokens: int | None = None, target_entropy: float | None = None,
                max_epochs: float | None = None, seed: int = 1, slice_docs: int = 4096, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` repeated to the mix, with ``mix_tokens``, ``mix_block`` and ``mix_order`` added.

    A row comes once per block that takes it; reading a source by
    (``mix_block``, ``mix_order``) gives whole permutations and then a part of
    one whose tokens just reach the source's share of ``budget_tokens``.
    Without a budget the mix is as large as leaves every source at least one
    whole block, so no document is lost.  Tokens are blank-separated words.

    NULL is a source of its own; documents without tokens (NULL, empty) belong
    to every whole block; a source without any token comes once.  Documents
    with equal ids have equal places, so repeated rows are taken together.
    Columns of ``docs`` with the added names are replaced, all others kept.
    An empty table gives an empty result."""
    rows = docs.drop("mix_tokens", "mix_block", "mix_order").withColumn("mix_tokens", word_count(F.col(text_col)))
    keys = written(rows.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               F.col("mix_tokens").alias("tokens")), "keys")
    plan = source_plan(keys, budget_tokens=budget_tokens, target_entropy=target_entropy, max_epochs=max_epochs,
                       seed=seed, slice_docs=slice_docs)
    plan = plan.select(F.col("source").alias("_cw_source"), F.col("whole").alias("_cw_whole"), F.col("cut").alias("_cw_cut"))
    joined = rows.join(plan, rows[source_col].eqNullSafe(plan["_cw_source"]))
    part = (_order(F.col("_cw_whole"), F.col(id_col), seed) <= F.col("_cw_cut")).cast("long")
    times = F.col("_cw_whole") + F.coalesce(part, F.lit(0))
    return (joined.withColumn("_cw_times", times).filter("_cw_times > 0")
            .withColumn("mix_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cw_times") - 1)))
            .withColumn("mix_order", _order(F.col("mix_block"), F.col(id_col), seed))
            .drop("_cw_source", "_cw_whole", "_cw_cut", "_cw_times"))
