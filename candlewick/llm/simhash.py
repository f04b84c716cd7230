"""SimHash near-dedup: exact comparison of all fingerprints, tile by tile.

1. Each text becomes a 64-bit fingerprint of its word shingles (one Python
   pass over Arrow batches; long texts in blocks).
2. Equal fingerprints form one class, aggregated before anything is compared,
   so thousands of exact copies are one row.
3. Classes are laid into tiles by the bit counts of their two halves.  A tile
   pair is joined only if the bit counts of its halves differ by at most the
   radius in total: the difference of the counts is a lower bound of the
   Hamming distance, so no link is lost.
4. Each tile pair is compared exactly by exclusive-or and bit counts; it
   yields the edges of a spanning forest of its links, never all its pairs.
5. The edges are joined into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import prepared, shuffled, word_blocks, written
from candlewick.llm.components import components

#: Per byte value, its eight bits (lowest first).
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_SLOTS = np.arange(8) * 256


def _bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set (index 0: lowest bit)."""
    slots = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _SLOTS
    return np.einsum("ij,jk->ik", np.bincount(slots.ravel(), minlength=2048).reshape(8, 256), _BITS).ravel()


def fingerprint(text: bytes | None, shingle_words: int = 4, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text.

    A-Z are lower-cased, words are runs of other than blanks, a shingle is
    ``shingle_words`` words joined by one blank (a shorter text is one
    shingle), a bit is 1 if set in over half of the XXH64 hashes of all
    shingles, repeats included.  NULL and texts without words give 0."""
    sums, count, tail = np.zeros(64, dtype=np.int64), 0, []
    for words in word_blocks((text or b"").lower()):
        words = tail + words
        if len(words) < shingle_words:
            tail = words
            continue
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        joined = b" ".join(words)
        last = len(words) - shingle_words + 1
        starts = [0, *ends[:last - 1].tolist()]
        stops = (ends[shingle_words - 1:] - 1).tolist()
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, stops)),
                             dtype=np.uint64, count=last)
        sums += _bit_sums(hashes)
        count += last
        tail = words[last:]
    if not count and tail:
        sums, count = _bit_sums(np.array([xxhash.xxh64_intdigest(b" ".join(tail), seed)], dtype=np.uint64)), 1
    return int(sum(1 << bit for bit in np.flatnonzero(sums * 2 > count).tolist()))


def fingerprints(docs: DataFrame, shingle_words: int = 4, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, fp long)`` for every row; ``fp`` is the fingerprint's bit pattern."""
    prepared(docs.sparkSession)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in batch.column(1)),
                                dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(batches, "doc_id long, fp long")


def _forest(left: np.ndarray, right: np.ndarray, radius: int, block: int = 1 << 21) -> np.ndarray:
    """Edges ``(n, 2)`` of a spanning forest of all links between two arrays."""
    values, where = np.unique(np.concatenate([left, right]), return_inverse=True)
    at_left, at_right = where[:len(left)], where[len(left):]
    root = np.arange(len(values))
    step = max(1, block // max(1, len(right)))
    for k in range(0, len(left), step):
        near = np.bitwise_count(left[k:k + step, None] ^ right[None, :]) <= radius
        i, j = np.nonzero(near)
        a, b = at_left[i + k], at_right[j]
        while True:
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            apart = low != high
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(root, high[apart], low[apart])
            while not np.array_equal(root, root[root]):
                root = root[root]
    moved = np.flatnonzero(root != np.arange(len(values)))
    return np.stack([values[moved], values[root[moved]]], axis=1)


def _offsets(radius: int) -> list[tuple[int, int]]:
    """Differences (upper half, lower half) of bit counts within the radius,
    one of each opposite pair."""
    return [(u, v) for u in range(0, radius + 1) for v in range(-radius, radius + 1)
            if u + abs(v) <= radius and (u, v) >= (0, 0)]


def fingerprint_links(classes: DataFrame, radius: int, tile_rows: int = 4096) -> DataFrame:
    """Edges ``(a, b)`` over distinct fingerprints ``classes(fp long)`` that join
    the same fingerprints as all links of at most ``radius`` bits do.

    ``tile_rows`` sizes the tiles (32 KB each by default); hot bit counts have
    many tiles, whose pairs are dealt out by a salt that grows with them."""
    high, low = F.bit_count(F.shiftrightunsigned("fp", 32)), F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    rows = classes.select("fp", high.alias("u"), low.alias("v"))
    # at most 33 x 33 rows, whatever the input
    sizes = {(r["u"], r["v"]): r["n"] for r in rows.groupBy("u", "v").agg(F.count("*").alias("n")).collect()}
    spark = classes.sparkSession
    parts = {k: -(-n // tile_rows) for k, n in sizes.items()}
    salts = max(1, -(-max(parts.values(), default=1) // 8))
    table = spark.createDataFrame([(u, v, n) for (u, v), n in parts.items()], "u int, v int, parts int")
    tiles = (rows.join(F.broadcast(table), ["u", "v"])
             .groupBy("u", "v", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"))
             .agg(F.collect_list("fp").alias("fps")))
    tiles = written(tiles, "tiles")
    steps = F.array(*[F.struct(F.lit(u).alias("u"), F.lit(v).alias("v")) for u, v in _offsets(radius)])
    left = (tiles.withColumn("step", F.explode(steps))
            .select((F.col("u") + F.col("step.u")).alias("u"), (F.col("v") + F.col("step.v")).alias("v"),
                    ((F.col("step.u") == 0) & (F.col("step.v") == 0)).alias("same"),
                    F.col("part").alias("part_l"), F.pmod("part", F.lit(salts)).cast("int").alias("salt"),
                    F.col("fps").alias("fps_l")))
    right = tiles.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumnRenamed("part", "part_r")
    pairs = (left.join(right, ["u", "v", "salt"])
             .filter(~F.col("same") | (F.col("part_l") <= F.col("part_r"))).select("fps_l", "fps"))

    def compare(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for i in range(batch.num_rows):
                one, two = (np.asarray(batch.column(c)[i].values).view(np.uint64) for c in (0, 1))
                edges = _forest(one, two, radius).view(np.int64)
                if len(edges):
                    yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def simhash_groups(docs: DataFrame, *, shingle_words: int = 4, radius: int = 4, tile_rows: int = 4096,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id, kept)``, one row per input row.

    Documents link if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest doc_id reachable, itself included, and
    ``kept`` marks the document that stays for its group.  NULL, empty and
    blank texts have fingerprint zero and link like any other.  Rows with a
    NULL doc_id link texts but are never a component's id (theirs is NULL only
    if no reachable row has an id).  Repeated rows repeat their result.  Other
    columns of ``docs`` are not read, whatever their names."""
    prints = written(fingerprints(docs, shingle_words, id_col=id_col, text_col=text_col), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    nodes = components(fingerprint_links(classes.select("fp"), radius, tile_rows))
    placed = classes.join(nodes.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("component_id", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    names = placed.join(least, "root").select("fp", "component_id")
    return prints.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, *, shingle_words: int = 4, radius: int = 4, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    All columns are kept as they are.  Of rows that repeat a kept doc_id one
    stays.  A row with a NULL doc_id stays only if its group has no id at all."""
    own = "_cw_kept_id"
    found = simhash_groups(docs, shingle_words=shingle_words, radius=radius, id_col=id_col, text_col=text_col)
    kept = written(found.filter("kept").groupBy(F.col("doc_id").alias(own)).agg(F.count("*").alias("_cw_rows")), "kept")
    # ids that stand for several rows are rare, so they are a table of their own
    once, often = kept.filter("_cw_rows = 1").select(own), written(kept.filter("_cw_rows > 1").select(own), "often")
    match = lambda keys: docs.join(keys, docs[id_col].cast("long").eqNullSafe(F.col(own)), "left_semi")
    return match(shuffled(once)).unionByName(match(often).dropDuplicates([id_col]))
