"""Embedding near-dedup by a forest of random-projection trees.

1. Equal vectors become one class, aggregated before anything is compared.
2. Trees are fitted on a bounded sample: a node projects on a random direction
   and splits at the median; rows in a band around it go to both sides (spill).
   How many trees, how large leaves and how dense a group stays whole is
   calibrated: the links of a bounded set of vectors are found exactly against
   all rows, and the forest widens until it meets the asked share of them.
3. Every class is dropped down every tree; rows meet in (tree, leaf) cells.
   Cells larger than a tile are cut into tile pairs, so no task holds a hot cell.
4. In a cell all pairs are verified by cosine.  A pair that shares several
   cells is counted in the first of them only.  A cell yields link counts per
   class and the edges of a spanning forest, never its pairs.
5. Edges are joined into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import prepared, written
from candlewick.llm.components import components
from candlewick.llm.vectors import by_dimension, keyed, matrix, sample


class Tree:
    """Recursive random splits; leaves are numbered from ``first``.

    A node in which over ``density`` of the pairs are links is not split
    further: its pairs are results, and a split would lose them.  It stays one
    leaf, which is compared tile by tile."""

    def __init__(self, rows: np.ndarray, rng: np.random.Generator, leaf_rows: int, spill: float, threshold: float,
                 first: int, density: float = 0.1):
        self.nodes: list[tuple] = []
        self.leaves = 0
        self.first = first
        self.density = density
        self._split(rows, rng, leaf_rows, spill, threshold)

    def _split(self, rows, rng, leaf_rows, spill, threshold) -> int:
        me = len(self.nodes)
        self.nodes.append(())
        dense = False
        if len(rows) > leaf_rows:
            some = rows if len(rows) <= 200 else rows[rng.choice(len(rows), 200, replace=False)]
            pairs = len(some) * (len(some) - 1)
            dense = np.sum(some @ some.T >= threshold) - len(some) > self.density * pairs
        if len(rows) > leaf_rows and not dense:
            direction = rng.standard_normal(rows.shape[1])
            at = rows @ direction
            low, high = np.quantile(at, [0.5 - spill, 0.5 + spill])
            left, right = at <= high, at >= low
            if max(left.sum(), right.sum()) <= 0.75 * len(rows):  # else it does not part them
                kids = [self._split(rows[side], rng, leaf_rows, spill, threshold) for side in (left, right)]
                self.nodes[me] = (direction, low, high, *kids)
                return me
        self.nodes[me] = (self.first + self.leaves,)
        self.leaves += 1
        return me

    def renumber(self, first: int) -> None:
        """Number the leaves from ``first``."""
        self.nodes = [(n[0] - self.first + first,) if len(n) == 1 else n for n in self.nodes]
        self.first = first

    def cells(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """``(cell, row numbers)`` of all rows."""
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, where = todo.pop()
            if not len(where):
                continue
            if len(self.nodes[node]) == 1:
                yield self.nodes[node][0], where
                continue
            direction, low, high, left, right = self.nodes[node]
            at = rows[where] @ direction
            todo += [(left, where[at <= high]), (right, where[at >= low])]


def fit_forest(rows: np.ndarray, trees: int, leaf_rows: int, spill: float, threshold: float, seed: int,
               first: int, density: float = 0.1) -> list[Tree]:
    """Trees over the unit vectors of ``rows`` with cells numbered from ``first``."""
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    out = []
    for number in range(trees):
        out.append(Tree(unit, np.random.default_rng([seed, number]), leaf_rows, spill, threshold, first, density))
        first += out[-1].leaves
    return out


#: the forests tried in turn: leaves of so many times ``leaf_rows``, so many times ``trees``,
#: and the link density from which a group stays whole; after them all pairs are compared
WIDER = ((1, 1, 0.1), (1, 3, 0.01), (4, 3, 0.01), (16, 3, 0.01), (64, 3, 0.01))
#: a row moved to a cell costs about as much as so many comparisons
MOVED = 500


def first_meeting(forest: list[Tree], asked: np.ndarray, rows: np.ndarray, threshold: float) -> np.ndarray:
    """Of the links between the unit vectors ``asked`` and ``rows``: how many meet first
    in each tree (last column: in none), a row per asked vector."""
    out = np.zeros((len(asked), len(forest) + 1), dtype=np.int64)
    for s in range(0, len(rows), 4_096):
        part = rows[s:s + 4_096]
        a, r = np.nonzero(asked @ part.T >= threshold)
        for number, tree in enumerate(forest):
            if not len(a):
                break
            shared = np.zeros((len(asked), len(part)), dtype=bool)
            ours = dict(tree.cells(asked))
            for cell, members in tree.cells(part):
                if cell in ours:
                    shared[np.ix_(ours[cell], members)] = True
            met = shared[a, r]
            out[:, number] += np.bincount(a[met], minlength=len(asked))
            a, r = a[~met], r[~met]
        out[:, -1] += np.bincount(a, minlength=len(asked))
    return out


def trees_needed(met: np.ndarray, recall: float, least: int) -> int | None:
    """The fewest trees, ``least`` or more, that meet ``recall`` of all links and on average
    of each asked vector's links (a hot group has most links, but few of the groups)."""
    met = met[met.sum(axis=1) > 0]
    if not len(met):
        return least
    upto = np.cumsum(met, axis=1)[:, :-1]
    share = np.minimum(upto.sum(axis=0) / met.sum(), (upto / met.sum(axis=1, keepdims=True)).mean(axis=0))
    enough = np.flatnonzero(share[least - 1:] >= recall)
    return least + int(enough[0]) if len(enough) else None


def work(forest: list[Tree], drawn: np.ndarray, total: int) -> float:
    """Comparisons and moves that the forest makes of ``total`` rows, from a sample of them."""
    scale = total / len(drawn)
    sizes = np.array([len(where) for tree in forest for _, where in tree.cells(drawn)]) * scale
    return float((sizes ** 2 / 2 + MOVED * sizes).sum())


def _first_shared(cell: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether ``cell`` is the first cell that paired rows of cells (-1: none) share."""
    first = np.ones(len(one), dtype=bool)
    for column in range(two.shape[1]):
        other = two[:, column]
        first &= ~(((one == other[:, None]).any(axis=1)) & (other >= 0) & (other < cell))
    return first


def _in_cell(cell: int, one: dict, two: dict, threshold: float, same: bool, block: int = 512):
    """Row numbers of all links that are counted in ``cell``, in blocks.

    A link counts in the first cell that its two rows share.  Where many rows
    share all their cells (a dense group), that is decided per kind of row."""
    kinds, kind = np.unique(np.concatenate([one["cells"], two["cells"]]), axis=0, return_inverse=True)
    of_one, of_two = kind.ravel()[:len(one["rep"])], kind.ravel()[len(one["rep"]):]
    table = None
    if 4 * len(kinds) <= len(one["rep"]):
        i, j = np.divmod(np.arange(len(kinds) ** 2), len(kinds))
        table = _first_shared(cell, kinds[i], kinds[j]).reshape(len(kinds), len(kinds))
    for k in range(0, len(one["rep"]), block):
        part = slice(k, k + block)
        ours = np.arange(len(two["rep"])) if table is None else np.flatnonzero(table[np.unique(of_one[part])].any(axis=0)[of_two])
        i, j = np.nonzero(one["unit"][part] @ two["unit"][ours].T >= threshold)
        i, j = i + k, ours[j]
        if same:
            i, j = i[i < j], j[i < j]
        for s in range(0, len(i), 100_000):
            a, b = i[s:s + 100_000], j[s:s + 100_000]
            first = table[of_one[a], of_two[b]] if table is not None else _first_shared(cell, one["cells"][a], two["cells"][b])
            yield a[first], b[first]


def _spanning(a: np.ndarray, b: np.ndarray, root: np.ndarray) -> None:
    """Join the rows ``a`` and ``b`` in the forest ``root`` (smallest row number wins)."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(root, root[root]):
            root[:] = root[root]


def cell_links(cell: int, left: bool, rep, copies, vectors, cells, side, threshold: float):
    """Link counts and forest edges of one cell (or pair of its tiles).

    ``left`` tells whether the rows are one tile (pairs within) or two, which
    ``side`` (0 or 1) then tells apart."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = {"rep": rep, "unit": unit, "cells": cells}
    pick = lambda m: {k: v[m] for k, v in rows.items()}
    at = (np.arange(len(rep)), np.arange(len(rep))) if left else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    count, root = np.zeros(len(rep), dtype=np.int64), np.arange(len(rep))
    for a, b in _in_cell(cell, pick(at[0]), pick(at[1]), threshold, left):
        a, b = at[0][a], at[1][b]
        for x, y in ((a, b), (b, a)):
            count += np.bincount(x, weights=copies[y], minlength=len(rep)).astype(np.int64)
        _spanning(a, b, root)
    linked, moved = np.flatnonzero(count), np.flatnonzero(root != np.arange(len(rep)))
    return (np.concatenate([rep[linked], rep[moved]]), np.concatenate([rep[linked], rep[root[moved]]]),
            np.concatenate([count[linked], np.zeros(len(moved), dtype=np.int64)]))


def embedding_groups(vectors: DataFrame, *, threshold: float = 0.9, trees: int = 12, leaf_rows: int = 512,
                     spill: float = 0.05, sample_rows: int = 20_000, tile_rows: int = 2_048, seed: int = 7,
                     recall: float = 0.99, calibration: int = 1_024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Two vectors link if they are found in one leaf and their cosine (double
    precision) is at least ``threshold``; equal vectors always link.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest vec_id reachable, itself included, ``kept`` marks it.  Trees are
    fitted on at most ``sample_rows`` vectors (documented bound) so that leaves
    hold about ``leaf_rows`` of all rows; all rows are dropped down them.  The
    links of at most ``calibration`` vectors are found exactly against all rows
    (documented bound); while under ``recall`` of them meet in a leaf, trees
    and leaves grow (``WIDER``), at the last to all pairs.
    Vectors that are NULL, empty, zero or hold NULL or non-finite components,
    and rows with a NULL vec_id, link with nothing.  Vectors of other lengths
    never link; those of a length absent from the sample share one (tiled)
    cell.  Repeated rows are rows of their own.  Other columns are not read."""
    prepared(vectors.sparkSession)
    rows = keyed(vectors, id_col, vector_col)
    classes = written(rows.filter("used").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")), "classes")
    total = classes.count()
    share = {r["d"]: r["n"] for r in classes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect()}
    drawn = dict(sorted(sample(classes, sample_rows).items()))
    # the sample's order is random, so its first rows are a draw of their own
    asked = {d: v[:calibration] / np.linalg.norm(v[:calibration], axis=1, keepdims=True) for d, v in drawn.items()}
    forest: dict[int, list[Tree]] = {}
    for leaves, times, density in WIDER:
        tried = {}
        for dimension in drawn.keys() - forest.keys():
            least = max(24, leaf_rows * len(drawn[dimension]) // max(1, total)) * leaves
            fitted = fit_forest(drawn[dimension], trees * times, least, spill, threshold, seed, 0, density)
            if times == 1 or work(fitted[:1], drawn[dimension], share[dimension]) < share[dimension] ** 2 / 2:
                tried[dimension] = fitted
        if not tried:
            continue

        def meet(stream: Iterator[pa.RecordBatch], tried=tried) -> Iterator[pa.RecordBatch]:
            met = {d: np.zeros((len(asked[d]), len(f) + 1), dtype=np.int64) for d, f in tried.items()}
            for batch in stream:
                for dimension, where in by_dimension(batch.column(0)):
                    if dimension in tried:
                        own = matrix(batch.column(0).take(pa.array(where)))
                        own = own / np.linalg.norm(own, axis=1, keepdims=True)
                        met[dimension] += first_meeting(tried[dimension], asked[dimension], own, threshold)
            at = [(d, int(i), int(t), int(m[i, t])) for d, m in met.items() for i, t in zip(*np.nonzero(m))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*at) if at else [[]] * 4)],
                                             ["d", "i", "t", "n"])

        met = {d: np.zeros((len(asked[d]), len(f) + 1), dtype=np.int64) for d, f in tried.items()}
        found = classes.select("vector").mapInArrow(meet, "d long, i long, t long, n long")
        for r in found.groupBy("d", "i", "t").agg(F.sum("n").alias("n")).collect():  # bounded by calibration and trees
            met[r["d"]][r["i"], r["t"]] = r["n"]
        for dimension, counts in met.items():
            # a vector's link with itself meets in the first tree and tells nothing
            counts[:, 0] = np.maximum(0, counts[:, 0] - 1)
            needed = trees_needed(counts, recall, trees if times == 1 else 1)
            fitted = tried[dimension][:needed]
            if needed and (times == 1 or work(fitted, drawn[dimension], share[dimension]) < share[dimension] ** 2 / 2):
                forest[dimension] = fitted
    first = 0
    for dimension in drawn:
        if dimension not in forest:  # all pairs: one leaf
            forest[dimension] = fit_forest(drawn[dimension], 1, len(drawn[dimension]), spill, threshold, seed, 0)
        for tree in forest[dimension]:
            tree.renumber(first)
            first += tree.leaves

    def place(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for dimension, where in by_dimension(batch.column(2)):
                part = batch.take(pa.array(where))
                own = matrix(part.column(2))
                own = own / np.linalg.norm(own, axis=1, keepdims=True)
                # lengths not in the sample: a cell of their own beyond the trees' (one per length)
                cells: list[list[int]] = [[] for _ in where]
                for tree in forest.get(dimension, ()):
                    for cell, members in tree.cells(own):
                        for m in members.tolist():
                            cells[m].append(cell)
                if dimension not in forest:
                    cells = [[first + dimension] for _ in where]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2),
                                                  pa.array(cells, pa.list_(pa.int32()))],
                                                 ["rep", "copies", "vector", "cells"])

    shape = "rep long, copies long, vector array<double>, cells array<int>"
    placed = written(classes.select("rep", "copies", "vector").mapInArrow(place, shape), "placed")
    parts = (placed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
             .select("cell", F.ceil(F.col("n") / tile_rows).cast("int").alias("parts")))
    cellwise = (placed.withColumn("cell", F.explode("cells")).join(parts, "cell")
                .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                .withColumn("p", F.least("part", "other")).withColumn("q", F.greatest("part", "other"))
                .select("cell", "p", "q", "rep", "copies", "vector", "cells", (F.col("part") == F.col("q")).cast("int").alias("side")))

    def links(key: tuple, table: pa.Table) -> pa.Table:
        cell, p, q = (k.as_py() for k in key)
        table = table.sort_by("rep")
        cells = table.column("cells").combine_chunks()
        size = np.asarray(cells.value_lengths())
        padded = np.full((len(size), int(size.max())), -1, dtype=np.int32)
        padded[np.arange(padded.shape[1]) < size[:, None]] = np.asarray(cells.flatten())
        a, b, n = cell_links(cell, p == q, np.asarray(table.column("rep")), np.asarray(table.column("copies")),
                             matrix(table.column("vector")), padded, np.asarray(table.column("side")), threshold)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    found = written(cellwise.groupBy("cell", "p", "q").applyInArrow(links, "a long, b long, n long"), "links")
    counts = found.filter("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("a <> b").select("a", "b")).withColumnRenamed("node", "rep")
    classes = (classes.select("h1", "h2", "rep", "copies").join(counts, "rep", "left").join(roots, "rep", "left")
               .select("h1", "h2", F.lit(True).alias("used"),
                       (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("component_id", "rep").alias("component_id")))
    joined = rows.select("vec_id", "h1", "h2", "used").join(classes, ["h1", "h2", "used"], "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))
