"""Embedding near-dedup and nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm.kmeans_tree import KMeansTree, nearest
from candlewick.llm.rp_forest import Tree, cell_links, embedding_groups, first_meeting, fit_forest, trees_needed

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15]


def clouds(seed=1, n=400, d=16, groups=12, near=25, copies=10):
    """Random vectors, groups of near copies and of exact copies."""
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, d))
    for g in range(groups):
        rows = np.vstack([rows, rows[g] + 0.08 * rng.standard_normal((near, d))])
    rows = np.vstack([rows, np.repeat(rows[:3], copies, axis=0), 3 * rows[5:8]]).astype(np.float32)
    return rows[rng.permutation(len(rows))]


def brute_links(rows, threshold=0.9):
    x = rows.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    root = np.arange(len(rows))
    while True:
        new = np.array([min([root[i], *root[near[i]]]) for i in range(len(rows))])
        if (new == root).all():
            return near, root
        root = new


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 40, "tile_rows": 30, "trees": 16, "sample_rows": 300}])
def test_groups_match_brute_force(spark, options):
    rows = clouds()
    near, root = brute_links(rows)
    df = spark.createDataFrame([(i * 3 + 1, v.tolist(), 0) for i, v in enumerate(rows)], SCHEMA)
    got = {r["vec_id"]: r for r in embedding_groups(df, **options).collect()}
    assert len(got) == len(rows)
    found = np.array([got[i * 3 + 1]["n_links"] for i in range(len(rows))])
    assert (found <= near.sum(axis=1)).all()  # none below the threshold, none twice
    assert found.sum() >= (0.999 if not options else 0.97) * near.sum()
    place = np.array([(got[i * 3 + 1]["component_id"] - 1) // 3 for i in range(len(rows))])
    assert (place == root).mean() > 0.99 and all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_a_link_is_counted_once_however_many_cells_it_shares(spark):
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((1, 8)) + 0.01 * rng.standard_normal((500, 8))  # one dense group: all pairs link
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rows)], SCHEMA)
    for options in ({"leaf_rows": 40}, {"leaf_rows": 40, "tile_rows": 60}):
        got = embedding_groups(df, **options).collect()
        assert {r["n_links"] for r in got} == {499} and {r["component_id"] for r in got} == {0}


def test_cell_links_kinds_and_pairs_agree():
    rng = np.random.default_rng(9)
    rows = rng.standard_normal((200, 6))
    cells = np.sort(rng.integers(0, 3, (200, 2)), axis=1) * 2  # few kinds: the table is used
    many = np.hstack([cells, np.arange(200)[:, None] + 100])  # as many kinds as rows: pairs are compared
    for cell in (0, 2, 4):
        args = np.arange(200), np.ones(200, dtype=np.int64), rows
        one = cell_links(cell, True, *args, cells, np.zeros(200), 0.5)
        two = cell_links(cell, True, *args, many, np.zeros(200), 0.5)
        count = lambda x: dict(zip(x[0][x[2] > 0].tolist(), x[2][x[2] > 0].tolist()))
        assert count(one) == count(two)


def test_spill_sends_border_rows_both_ways():
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((1000, 8))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    tree = Tree(rows, rng, 100, 0.05, 0.99, 0)
    met = np.zeros(1000, dtype=int)
    for _, where in tree.cells(rows):
        met[where] += 1
    assert (met >= 1).all() and 1.1 < met.mean() < 2.5


def topics(n, d=64, seed=3):
    """A third of the rows is one topic with a few links in a hundred pairs, the rest are small topics."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    hot = unit(rng.standard_normal((1, d))) + 0.45 * rng.gamma(36, 1 / 36, (n // 3, 1)) * unit(rng.standard_normal((n // 3, d)))
    rest = np.repeat(unit(rng.standard_normal(((n - n // 3) // 20 + 1, d))), 20, axis=0)[:n - n // 3]
    rows = np.vstack([hot, rest + 0.4 * unit(rng.standard_normal((len(rest), d)))])
    return unit(rows)[rng.permutation(n)].astype(np.float32)


def links_by_row(rows, threshold=0.9):
    x = rows.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([(x[s:s + 1000] @ x.T >= threshold).sum(axis=1) - 1 for s in range(0, len(x), 1000)])


def test_links_of_a_hot_topic_are_met(spark):
    rows = topics(30_000)
    want = links_by_row(rows)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rows)], SCHEMA)
    got = np.zeros(len(rows), dtype=np.int64)
    for r in embedding_groups(df, sample_rows=5_000, leaf_rows=128, calibration=256).select("vec_id", "n_links").collect():
        got[r["vec_id"]] = r["n_links"]
    assert (got <= want).all() and got.sum() >= 0.98 * want.sum()
    assert (got[want > 0] / want[want > 0]).mean() >= 0.98


def test_meeting_is_counted_by_the_first_tree_that_shares_a_leaf():
    rows = topics(2_000).astype(np.float64)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    forest = fit_forest(rows, 5, 60, 0.05, 0.9, 1, 0, 0.5)
    leaves = [dict(tree.cells(rows)) for tree in forest]
    met = first_meeting(forest, rows[:30], rows, 0.9)
    for i in range(30):
        want = [0] * 6
        for j in np.flatnonzero(rows[i] @ rows.T >= 0.9):
            want[next((t for t, own in enumerate(leaves) if any(i in m and j in m for m in own.values())), 5)] += 1
        assert met[i].tolist() == want
    assert trees_needed(np.array([[1, 8, 1], [5, 5, 0]]), 0.9, 1) == 2
    assert trees_needed(np.array([[1, 7, 2]]), 0.9, 1) is None and trees_needed(np.zeros((2, 4)), 0.9, 3) == 3


def test_odd_vectors_link_with_nothing(spark):
    rows = [(i, v, 0) for i, v in enumerate(ODD)] + [(10, [1.0, 2.0], 0), (11, [2.0, 4.0], 0), (11, [2.0, 4.0], 0),
                                                     (12, [1.0] * 16, 0), (13, [0.0, -0.0, 1.0], 0), (None, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, 1, True) for r in rows], SCHEMA + ", n_links int, used boolean")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_groups(df).collect()), key=repr)
    assert len(got) == len(rows) and all(g[1] == 0 and g[0] == g[2] for g in got if g[0] not in (10, 11))
    assert (10, 2, 10, True) in got and got.count((11, 2, 10, False)) == 2 and (None, 0, None, True) in got
    assert embedding_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def brute_nearest(ids, rows, query, k):
    score = (rows.astype(np.float64) * rows[query].astype(np.float64)).sum(axis=1)
    order = sorted((-s, i) for j, (s, i) in enumerate(zip(score.tolist(), ids.tolist())) if i != ids[query])[:k]
    return [(i, -s) for s, i in order]


def test_nearest_recall_and_order(spark):
    rows = np.vstack([clouds(n=1500), np.repeat(clouds()[:1], 200, axis=0)])
    ids = np.random.default_rng(0).permutation(len(rows) * 2)[:len(rows)]
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, rows)], SCHEMA)
    got = nearest(df, F.col("vec_id") % 20 == 0, k=20, leaf_rows=64, bin_rows=300, bin_queries=16).collect()
    found, hit, total = {}, 0, 0
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 20 == 0)
    for q, answers in found.items():
        assert len(answers) == 20 and answers == sorted(answers, key=lambda a: (-a[1], a[0]))
        want = brute_nearest(ids, rows, int(np.flatnonzero(ids == q)[0]), 20)
        exact = dict(brute_nearest(ids, rows, int(np.flatnonzero(ids == q)[0]), len(rows)))
        assert all(abs(exact[i] - s) < 1e-12 for i, s in answers)
        hit, total = hit + len({i for i, _ in want} & {i for i, _ in answers}), total + 20
    assert hit / total >= 0.9


def test_all_leaves_give_the_exact_answer(spark):
    rows = np.vstack([clouds(n=200), np.repeat(clouds()[:2], 60, axis=0)])
    ids = np.arange(len(rows))
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, rows)], SCHEMA)
    got = nearest(df, F.col("vec_id") % 20 == 0, k=20, recall=1.0, leaf_rows=10_000).collect()
    for q in ids[ids % 20 == 0]:
        mine = [(r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        assert mine == [i for i, _ in brute_nearest(ids, rows, q, 20)]


def test_nearest_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest(empty, F.col("vec_id") % 20 == 0).collect() == []
    rows = [(20 * i, v, 0) for i, v in enumerate(ODD, 1)] + [(0, [1.0, 0.0], 0), (1, [0.5, 0.0], 0), (2, [0.5, 0.0], 0),
                                                             (None, [1.0, 1.0], 0), (200, [1.0, 2.0, 3.0], 0)]
    df = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", score int")
    got = nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]


def test_best_first_walk_meets_every_leaf_once():
    rows = clouds(n=900)
    tree = KMeansTree(rows.astype(np.float64), 8, 32, 1, first=7)
    leaves = list(tree.best_bins(rows[0].astype(np.float64)))
    assert sorted(leaves) == list(range(7, 7 + tree.leaves)) and tree.leaves > 8
    assert set(tree.leaf_of(rows.astype(np.float64)).tolist()) <= set(leaves)
