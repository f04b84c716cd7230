"""Approximate nearest neighbours by inner product: a hierarchical k-means tree
searched best bin first.

1. The tree is fitted on a bounded sample; every row is sent to its leaf.
   Equal vectors are one class that carries only the ids that can be among the
   k nearest (the k + 1 smallest), so a hot vector is a single row.
2. A query walks the tree with a priority queue: the node with the highest
   inner product with its centre first; the leaves come out in that order.
3. How many leaves a query visits is calibrated: a few queries are answered
   exactly over all rows, and visits widen until the visited leaves hold the
   asked share of their true neighbours.
4. Leaves are dealt into bins of bounded size.  A bin's task compares each
   query with the leaves it visits there; large bins are cut in tiles, of rows
   and of queries.  The best of all bins are merged per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm.common import prepared, written
from candlewick.llm.vectors import by_dimension, keyed, matrix, sample


def _k_means(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres and the nearest centre of each row (empty ones are dropped)."""
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        near = np.argmin((centres ** 2).sum(axis=1) - 2 * rows @ centres.T, axis=1)
        kinds, near = np.unique(near, return_inverse=True)
        sums = np.zeros((len(kinds), rows.shape[1]))
        np.add.at(sums, near, rows)
        centres = sums / np.bincount(near)[:, None]
    near = np.argmin((centres ** 2).sum(axis=1) - 2 * rows @ centres.T, axis=1)
    kinds, near = np.unique(near, return_inverse=True)
    return centres[kinds], near


class KMeansTree:
    """Nested k-means; leaves are numbered from ``first`` in tree order."""

    def __init__(self, rows: np.ndarray, branches: int, leaf_rows: int, seed: int, first: int = 0):
        self.first, self.leaves = first, 0
        self.kids: list[tuple | int] = []  # a leaf's number, or (centres, node numbers)
        self._grow(rows, branches, leaf_rows, np.random.default_rng(seed))

    def _grow(self, rows, branches, leaf_rows, rng) -> int:
        me = len(self.kids)
        self.kids.append(0)
        if len(rows) > max(leaf_rows, branches):
            centres, near = _k_means(rows, branches, rng)
            if len(centres) > 1:
                self.kids[me] = (centres, [self._grow(rows[near == c], branches, leaf_rows, rng)
                                           for c in range(len(centres))])
                return me
        self.kids[me] = self.first + self.leaves
        self.leaves += 1
        return me

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), dtype=np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, where = todo.pop()
            if isinstance(self.kids[node], tuple):
                centres, nodes = self.kids[node]
                near = np.argmin((centres ** 2).sum(axis=1) - 2 * rows[where] @ centres.T, axis=1)
                todo += [(n, where[near == c]) for c, n in enumerate(nodes) if (near == c).any()]
            else:
                out[where] = self.kids[node]
        return out

    def best_bins(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in the order of a best-first walk."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if isinstance(self.kids[node], tuple):
                centres, nodes = self.kids[node]
                for likeness, n in zip((centres @ query).tolist(), nodes):
                    heapq.heappush(queue, (-likeness, n))
            else:
                yield self.kids[node]


def _dots(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Row by row inner products, each summed in the same order."""
    return (one * two).sum(axis=1)


def best_rows(queries: np.ndarray, rows: np.ndarray, k: int, visited: np.ndarray | None = None, block: int = 256):
    """``(query number, row number, score)`` of the k best rows per query, all ties
    with the last included; only where ``visited`` holds."""
    out = []
    for s in range(0, len(queries), block):
        about = queries[s:s + block] @ rows.T
        if visited is not None:
            about[~visited[s:s + block]] = -np.inf
        last = np.partition(about, about.shape[1] - k, axis=1)[:, about.shape[1] - k] if about.shape[1] > k else \
            np.full(len(about), -np.inf)
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(last), last, 0)))
        q, r = np.nonzero((about >= (last - slack)[:, None]) & np.isfinite(about))
        out.append((q + s, r, _dots(queries[q + s], rows[r])))
    return tuple(np.concatenate(c) for c in zip(*out))


def _merged(found: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """The k best ``(score, ids)`` rows per query, by score and smallest id."""
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.col("ids")[0])
    return found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def nearest(vectors: DataFrame, queries: Column, *, k: int = 20, recall: float = 0.95, branches: int = 8,
            leaf_rows: int = 256, sample_rows: int = 20_000, calibration: int = 128, bin_rows: int = 8_192,
            bin_queries: int = 4_096, seed: int = 11, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of every row for which
    ``queries`` holds, among all other rows, nearest first, ties to the
    smaller vec_id; ``score`` is the inner product in double precision.

    The tree is fitted on at most ``sample_rows`` vectors and its visits are
    calibrated with at most ``calibration`` queries, answered exactly over all
    rows (documented bounds); every row is indexed.  Visits widen until the
    calibration queries' recall reaches ``recall`` and every query meets at
    least k other rows; a query with fewer candidates gets them all.  Vectors
    that are NULL, empty, zero or hold NULL or non-finite components, and rows
    with a NULL vec_id, take no part.  Vectors of different lengths never
    meet.  Repeated rows are candidates of their own (a query skips only rows
    with its own id).  Other columns are not read."""
    spark = prepared(vectors.sparkSession)
    rows = written(keyed(vectors, id_col, vector_col).filter("used").drop("used"), "vectors")
    asked = keyed(vectors.filter(F.coalesce(queries, F.lit(False))), id_col, vector_col).filter("used")
    asked = written(asked.select("vec_id", "h1", "h2"), "queries")
    # of equal vectors only the k + 1 smallest ids can be among a query's k nearest
    least = rows.withColumn("_n", F.row_number().over(W.partitionBy("h1", "h2").orderBy("vec_id"))).filter(F.col("_n") <= k + 1)
    classes = written(least.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"),
                                                    F.any_value("vector").alias("vector")), "classes")
    total = classes.count()
    trees, first = {}, 0
    for dimension, drawn in sorted(sample(classes, sample_rows).items()):
        trees[dimension] = KMeansTree(drawn, branches, max(16, leaf_rows * len(drawn) // max(1, total)), seed, first)
        first += trees[dimension].leaves

    def place(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for dimension, where in by_dimension(batch.column(3)):
                part = batch.take(pa.array(where))
                leaf = trees[dimension].leaf_of(matrix(part.column(3))) if dimension in trees else \
                    np.full(len(where), first + dimension)  # a length absent from the sample: one leaf
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaf, pa.int64())],
                                                 ["h1", "h2", "ids", "vector", "leaf"])

    shape = "h1 long, h2 long, ids array<long>, vector array<double>"
    placed = written(classes.select("h1", "h2", "ids", "vector").mapInArrow(place, shape + ", leaf long"), "leaves")
    # a row per leaf, bounded by the sample
    leaves = placed.groupBy("leaf").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).orderBy("leaf").collect()
    sizes, bins, held, dimension = {r["leaf"]: r["n"] for r in leaves}, {}, 0, None
    for leaf, n, d in leaves:  # neighbouring leaves share a bin
        fresh = d != dimension or held + n > bin_rows
        bins[leaf], held, dimension = len(set(bins.values())) - (not fresh), n if fresh else held + n, d
    questions = classes.join(asked.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select("h1", "h2", "vector")

    # calibration: a bounded set of queries against all rows
    drawn = questions.orderBy("h2").limit(calibration).collect()
    by = {}
    for r in drawn:
        by.setdefault(len(r["vector"]), []).append((r["h1"], r["h2"], r["vector"]))
    known = {d: ([(a, b) for a, b, _ in v], np.array([x for _, _, x in v])) for d, v in by.items()}

    def exact(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for dimension, where in by_dimension(batch.column(3)):
                if dimension in known:
                    part = batch.take(pa.array(where))
                    names, asked_for = known[dimension]
                    q, r, score = best_rows(asked_for, matrix(part.column(3)), k + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[i][0] for i in q.tolist()], pa.int64()), pa.array([names[i][1] for i in q.tolist()], pa.int64()),
                         part.column(4).take(pa.array(r)), part.column(2).take(pa.array(r)), pa.array(score)],
                        ["h1", "h2", "leaf", "ids", "score"])

    truth: dict[tuple, list[int]] = {}
    if known:
        best = _merged(placed.mapInArrow(exact, "h1 long, h2 long, leaf long, ids array<long>, score double"), k + 1, ["h1", "h2"])
        for r in best.select("h1", "h2", "leaf").collect():  # k + 1 rows per calibration query
            truth.setdefault((r["h1"], r["h2"]), []).append(r["leaf"])
    ranks = []
    for dimension, (names, asked_for) in known.items():
        for name, q in zip(names, asked_for):
            order = {leaf: i for i, leaf in enumerate(trees[dimension].best_bins(q))} if dimension in trees else {}
            ranks += [order.get(leaf, 0) for leaf in truth.get(name, [])]
    ranks = np.sort(np.array(ranks if ranks else [0]))
    visits = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1

    def route(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once per bin it visits, with its leaves there."""
        for batch in stream:
            out = []
            for i, vector in enumerate(batch.column(2).to_pylist()):
                walk = trees[len(vector)].best_bins(np.array(vector)) if len(vector) in trees else [first + len(vector)]
                to, met = {}, 0
                for n, leaf in enumerate(walk):
                    if n >= visits and met > k:
                        break
                    if leaf in sizes:
                        met += sizes[leaf]
                        to.setdefault(bins[leaf], []).append(leaf)
                out += [(i, b, leaves) for b, leaves in to.items()]
            at = pa.array([i for i, _, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(at) for c in batch.columns), pa.array([b for _, b, _ in out], pa.int64()),
                 pa.array([x for _, _, x in out], pa.list_(pa.int64()))], ["h1", "h2", "vector", "bin", "visits"])

    routed = written(questions.mapInArrow(route, "h1 long, h2 long, vector array<double>, bin long, visits array<long>"), "routes")
    per_bin = {}
    for leaf, n in sizes.items():
        per_bin[bins[leaf]] = per_bin.get(bins[leaf], 0) + n
    heavy = {r["bin"]: r["n"] for r in routed.groupBy("bin").agg(F.count("*").alias("n")).collect()}
    tiles = spark.createDataFrame([(leaf, bins[leaf], -(-per_bin[bins[leaf]] // bin_rows), -(-heavy.get(bins[leaf], 0) // bin_queries))
                                   for leaf in sizes], "leaf long, bin long, parts int, slots int")
    cut = tiles.select("bin", "parts", "slots").distinct()
    row_side = (placed.join(F.broadcast(tiles), "leaf").filter("slots > 0")
                .withColumn("part", F.pmod("h1", F.col("parts")).cast("int"))
                .withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
                .select("bin", "part", "slot", "leaf", "ids", "vector"))
    query_side = (routed.join(F.broadcast(cut), "bin").withColumn("slot", F.pmod("h1", F.col("slots")).cast("int"))
                  .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                  .select("bin", "part", "slot", "h1", "h2", "visits", "vector"))

    def search(key: tuple, one: pa.Table, two: pa.Table) -> pa.Table:
        names = ["h1", "h2", "ids", "score"]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64()]
        if not one.num_rows or not two.num_rows:
            return pa.table([pa.array([], t) for t in types], names)
        leaves, at = np.unique(np.asarray(one.column("leaf")), return_inverse=True)
        number = {leaf: i for i, leaf in enumerate(leaves.tolist())}
        visited = np.zeros((two.num_rows, len(leaves)), dtype=bool)
        for i, own in enumerate(two.column("visits").to_pylist()):
            visited[i, [number[leaf] for leaf in own if leaf in number]] = True
        q, r, score = best_rows(matrix(two.column("vector")), matrix(one.column("vector")), k + 1, visited[:, at])
        return pa.table([two.column("h1").take(pa.array(q)), two.column("h2").take(pa.array(q)),
                         one.column("ids").take(pa.array(r)), pa.array(score)], names)

    found = (row_side.groupBy("bin", "part", "slot").cogroup(query_side.groupBy("bin", "part", "slot"))
             .applyInArrow(search, "h1 long, h2 long, ids array<long>, score double"))
    best = _merged(found, k + 1, ["h1", "h2"])
    answers = (asked.withColumnRenamed("vec_id", "query_id").distinct().join(best, ["h1", "h2"])
               .select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
