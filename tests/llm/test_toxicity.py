"""Toxicity: the index against brute force, the score's inputs, held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlewick.llm.toxicity import (BEGINNINGS, BlockMaxIndex, Dictionary, in_training, isotonic, plain_words, score_toxicity,
                                     unit_weights, without_toxic)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def random_vectors(n, terms, seed, kinds=40):
    rng = np.random.default_rng(seed)
    shapes = [{int(t): int(rng.integers(1, 9)) for t in rng.choice(terms, rng.integers(1, 9), replace=False)} for _ in range(kinds)]
    return [shapes[i] for i in rng.integers(0, kinds, n)]  # many ties


def entries(vectors, idf):
    row = np.repeat(np.arange(len(vectors)), [len(v) for v in vectors])
    term = np.array([t for v in vectors for t in sorted(v)])
    count = np.array([v[t] for v in vectors for t in sorted(v)])
    outside = np.arange(len(vectors)) % 3 * 0.5
    return row, term, unit_weights(row, term, count, outside, idf, 2.0)


@pytest.mark.parametrize("block", [1, 7, 64])
def test_block_max_search_is_exact(block):
    terms, idf = 30, np.linspace(1, 5, 30)
    row, term, weight = entries(random_vectors(300, terms, 1) + random_vectors(100, terms, 2, 100), idf)
    index = BlockMaxIndex(row, term, weight, np.arange(400) % 2, np.arange(400), terms, block)
    dense = np.zeros((400, terms))
    dense[row, term] = weight
    asked_row, asked_term, asked_weight = entries(random_vectors(60, terms, 3), idf)
    told = []
    for i in range(60):
        t, w = asked_term[asked_row == i], asked_weight[asked_row == i]
        cosines = dense[:, t] @ w
        for k, skip in ((1, None), (10, None), (25, 17), (1000, None)):
            own = cosines.copy()
            if skip is not None:
                own[skip] = -1
            last = np.sort(own[own > 0])[::-1][:k][-1]
            want = {j for j in range(400) if own[j] > 0 and own[j] >= last - 1e-12}
            place, score = index.top(t, w, k, skip, told)
            assert {index.ids[p] for p in place.tolist()} == want
            assert np.allclose(score, [cosines[index.ids[p]] for p in place.tolist()])
    if block == 1:
        assert sum(a for a, _ in told) < sum(b for _, b in told)  # some are pruned


def test_a_shipped_index_is_the_same():
    import pickle
    row, term, weight = entries(random_vectors(200, 30, 1), np.linspace(1, 5, 30))
    index = BlockMaxIndex(row, term, weight, np.zeros(200), np.arange(200), 30, 7)
    again = pickle.loads(pickle.dumps(index))
    for i in range(20):
        own = term[row == i], weight[row == i]
        assert all(np.array_equal(a, b) for a, b in zip(index.top(*own, 5), again.top(*own, 5)))


def test_isotonic_is_rising_and_calibrated():
    rng = np.random.default_rng(0)
    votes = rng.random(500)
    labels = (rng.random(500) < votes).astype(int)
    knots, levels = isotonic(votes, labels, 0.1)
    assert (np.diff(levels) >= 0).all() and (np.diff(knots) > 0).all()
    assert abs(np.interp(0.2, knots, levels) - 0.2) < 0.15 and abs(np.interp(0.8, knots, levels) - 0.8) < 0.15


def test_terms_and_counts(spark):
    texts = ["A a b1c É_é 42\n", None, "Wort" * 2, "ende wort ende nix", "wort " * 300_000 + "ende"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(plain_words(F.col("t"))).collect()]
    assert [g.split() for g in got[:4]] == [["a", "a", "b", "c", "é", "é"], [], ["wortwort"], ["ende", "wort", "ende", "nix"]]
    row, term, count, outside, size = Dictionary(["ende", "wort"], ["wort"]).counts(pa.array(got))
    assert list(zip(row.tolist(), term.tolist(), count.tolist())) == [(2, 2, 1), (3, 0, 2), (3, 1, 1), (4, 0, 1), (4, 1, 300_000)]
    assert size.tolist() == [6, 0, 1, 4, 300_001]
    two = (1 + math.log(2)) ** 2
    assert np.allclose(outside, [2 * two + 2, 0, 1, 1, 0])


def crafted(n=300):
    """A third holds one of two marked words; ids beyond n have no label."""
    docs, labels = [], []
    for i in range(2 * n):
        words = [f"w{(i * 7 + j) % 50}x" for j in range(30)]
        if i % 3 == 0:
            words[i % 30] = words[(i + 9) % 30] = ("schimpf" if i % 2 else "fluch") + "abcde"[i % 5]
        docs.append((i, " ".join(words), "en", "s", 1))
        if i < n:
            labels.append((i, 1, int(i % 3 == 0)))
    return docs, labels


def test_scores_depend_on_texts_alone(spark):
    docs, labels = crafted()
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    base = {r["doc_id"]: r for r in score_toxicity(df, marks).collect()}
    assert all(r["predicted"] == int(i % 3 == 0) and 0 <= r["score"] <= 1 for i, r in base.items())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in base.items())
    proof = base[3]["evidence"]
    assert len(proof) == 3 and all(e["label"] == 1 and 0 < e["cosine"] <= 1 + 1e-9 for e in proof)
    # labels of held-out rows, lang, source and other columns change nothing
    turned = marks.withColumn("toxic", F.when(in_training(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    other = df.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("z")).withColumn("terms", F.lit(1))
    again = {r["doc_id"]: r["score"] for r in score_toxicity(other, turned).collect()}
    assert again == {i: r["score"] for i, r in base.items()}


def test_texts_without_a_marking_term_meet_their_nearest_examples(spark):
    docs, labels = crafted()
    letters = str.maketrans("0123456789", "abcdefghij")  # words are runs of letters
    docs = [(i, text.translate(letters), *rest) for i, text, *rest in docs]
    plain = [d for d in docs if d[0] % 3]
    got = {r["doc_id"]: r for r in score_toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert all(len(got[d[0]]["evidence"]) == 3 for d in plain)
    words = dict((d[0], set(d[1].split())) for d in docs)
    for d in plain:  # the nearest share its words
        near = got[d[0]]["evidence"][0]
        assert near["cosine"] > 0.5 and len(words[near["doc_id"]] & words[d[0]]) > 20


def brute_scores(docs, labels, k=25, marking=2.0):
    """Every score from dense vectors and plain loops: no index, no Arrow, no Spark."""
    words = {i: re.findall(r"[^\W\d_]+", (t or "").lower()) for i, t, *_ in docs}
    learnt = {i: y for i, _, y in labels if i in words and zlib.crc32(str(i).encode()) % 3 != 1}
    n, bad = len(learnt), sum(learnt.values())
    seen = {0: Counter(), 1: Counter()}
    for i, y in learnt.items():
        seen[y].update({t for w in words[i] for t in (w, *(w[:m] + "*" for m in BEGINNINGS if len(w) > m))})
    marks = set()
    for t, b in seen[1].items():
        g = seen[0][t]
        cross = b * (n - bad - g) - g * (bad - b)
        under = bad * (n - bad) * (b + g) * (n - b - g)
        if b >= 2 and b >= 0.5 * (b + g) and under and n * cross * cross / under >= 10:
            marks.add(t)
    examples = sorted(i for i in learnt if words[i])
    known = {w for i in examples for w in words[i]}
    terms = sorted(known | marks)

    def counts(i):
        own, other = Counter(), Counter()
        for w in words[i]:
            (own if w in known else other)[w] += 1
            own.update(w[:m] + "*" for m in BEGINNINGS if len(w) > m and w[:m] + "*" in marks)
        return own, other

    shapes = {i: counts(i) for i in words}
    df = Counter(t for own, _ in shapes.values() for t in own)
    idf = {t: (math.log((1 + len(docs)) / (1 + df[t])) + 1) * (marking if t in marks else 1) for t in terms}
    rare = math.log((1 + len(docs)) / 2) + 1
    dense = {}
    for i, (own, other) in shapes.items():
        v = np.array([(1 + math.log(own[t])) * idf[t] if own[t] else 0.0 for t in terms])
        size = math.sqrt(v @ v + sum((1 + math.log(c)) ** 2 for c in other.values()) * rare * rare)
        dense[i] = v / size if size else v
    prior = (bad + 1) / (n + 2)

    def vote(i, skip=None):
        near = sorted(((float(dense[i] @ dense[e]), learnt[e]) for e in examples if e != skip), reverse=True)
        near = [(s, y) for s, y in near if s > 0]
        if not near:
            return prior
        last = near[min(k, len(near)) - 1][0]
        sure = [(s, y) for s, y in near if s > last + 1e-12]
        tied = [(s, y) for s, y in near if abs(s - last) <= 1e-12]
        part = min(1.0, (k - len(sure)) / len(tied))
        up = sum(s * y for s, y in sure) + part * sum(s * y for s, y in tied)
        return (up + prior) / (sum(s for s, _ in sure) + part * sum(s for s, _ in tied) + 1)

    knots, levels = isotonic(np.array([vote(i, i) for i in examples]), np.array([learnt[i] for i in examples]), prior)
    blank = [y for i, y in learnt.items() if not words[i]]
    nothing = (sum(blank) + prior) / (len(blank) + 1)
    return {i: float(np.interp(vote(i), knots, levels)) if words[i] else nothing for i in words}


def test_scores_equal_brute_force(spark):
    docs, labels = crafted(120)
    letters = str.maketrans("0123456789", "abcdefghij")
    docs = [(i, t.translate(letters) + (" gar nicht bekannt" if i % 7 == 0 else ""), *rest) for i, t, *rest in docs]
    docs += [(900, None, "en", "s", 0), (901, "ganz andere worte", "en", "s", 0), (2, "", "en", "s", 0)]
    docs = list({d[0]: d for d in docs}.values())
    got = {r["doc_id"]: r["score"] for r in score_toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    want = brute_scores(docs, labels)
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 1e-9
    assert len({round(s, 6) for s in want.values()}) > 3


def test_edges(spark):
    none, marks = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert score_toxicity(none, marks).collect() == []
    docs, labels = crafted(150)
    df = spark.createDataFrame(docs[:2], DOCS)
    assert {r["score"] for r in score_toxicity(df, marks).collect()} == {0.5}
    odd = [(1000, None, None, None, None), (1001, "", "en", "s", 0), (None, "schimpfa " * 5, "en", "s", 1), docs[3], docs[3],
           (1002, "fluchb " * 100_000, "en", "s", 1)]
    marks = spark.createDataFrame([*labels, (7, None, None), (8, 1, 5), (None, 1, 1), (6, 1, 0), (6, 1, 0)], LABELS)
    got = score_toxicity(spark.createDataFrame(docs + odd, DOCS), marks).collect()
    assert len(got) == len(docs) + len(odd)
    by = {r["doc_id"]: r for r in got}
    assert by[1000]["score"] == by[1001]["score"] < 0.4 and by[None]["predicted"] == 1 and by[None]["held_out"] is False
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1 and by[1002]["predicted"] == 1
    kept = without_toxic(spark.createDataFrame(docs + odd, DOCS), marks).collect()
    assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in got if not r["predicted"]}
    assert len(kept) == sum(not r["predicted"] for r in got)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = score_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    scored = {r["doc_id"]: r for r in got.select("doc_id", "held_out", "score", "predicted").collect()}
    truth = duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall()
    held = [(scored[d], y) for d, y in truth if scored[d]["held_out"]]
    caught = np.mean([r["predicted"] for r, y in held if y == 1])
    wrong = np.mean([r["predicted"] for r, y in held if y == 0])
    assert caught >= 0.9 and wrong <= 0.005
    assert np.mean([(r["score"] - y) ** 2 for r, y in held]) < 0.02
    sure = [y for r, y in held if r["score"] >= 0.7]
    assert math.isclose(np.mean(sure), np.mean([r["score"] for r, y in held if r["score"] >= 0.7]), abs_tol=0.1)
