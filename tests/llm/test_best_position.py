"""Best Position search against brute force over all documents, and the query against its SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from candlewick.llm import best_position as B
from fixtures_llm import SCHEMAS, agrees, tables  # noqa: F401

SCHEMAS["benchmark"] = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(i, Counter(t)) for i, t in ((i, plain_terms(t)) for i, t in docs) if t]
    n, words = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        weights = {t: r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t, r in Counter(plain_terms(text)).items()}
        scores = []
        for i, c in held:
            m = 100 - 25 + (25 * c.total() * n) // words
            score = sum(w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, w in weights.items())
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if no_id else i, -s) for rank, (s, no_id, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n=500, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "naïve", "x1", "42"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40)))) for i in range(n)]
    docs += [(10_000 + i, docs[7][1]) for i in range(60)]  # copies: equal scores
    items = [(i, " ".join(rng.choices(vocabulary + ["nowhere"], k=rng.randint(0, 12)))) for i in range(25)]
    return docs, items


def test_term_bytes_equal_the_pattern():
    rng = random.Random(0)
    for _ in range(500):
        text = "".join(rng.choice("aZ09 _-/:@[`{~\x00\x7f\x80é 😀K") for _ in range(30))
        assert B.terms_of(text) == Counter(t.encode() for t in plain_terms(text))
        words, of = B._split(pa.array(["x", text, None, text])[1:])
        assert words.to_pylist() == plain_terms(text) * 2 and set(of.tolist()) <= {0, 2}
    assert B.terms_of(None) == {} and B.terms_of("a " * 2_000_000) == {b"a": 2_000_000}


@pytest.mark.parametrize("shard,k", [(1, 3), (37, 20), (2048, 20), (64, 5000)])
def test_search_equals_brute_force(spark, monkeypatch, shard, k):
    monkeypatch.setattr(B, "SHARD_DOCS", shard)
    docs, items = corpus(shard)
    got = B.best_documents(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame(items, "item_id long, text string"), k=k, max_items=10)
    rows = got.collect()
    assert sorted(map(tuple, rows), key=repr) == brute(docs, items, k)


def test_unseen_documents_are_bounded_by_best_positions():
    """Fewer documents are looked up than there are, and every one that could be among the best is."""
    rng = np.random.default_rng(3)
    texts = [" ".join([f"t{j}" for j in range(30) if rng.random() < 0.3] + ["t0 t1 t2 t3 t4"] * (i % 97 == 0)) for i in range(2_000)]
    vocabulary = sorted({t.encode() for x in texts for t in x.split()})
    part = B._counted(pa.array(range(2_000)), pa.array(texts), pa.array([v.decode() for v in vocabulary]))
    own = B._shard([part])
    shard = B.Shard(own.column(0)[0].values, *(np.asarray(own.column(c)[0].values) for c in (1, 2, 3)),
                    *(np.frombuffer(own.column(c)[0].as_buffer(), dtype=np.int32) for c in (4, 5)), 2_000, part[6], len(vocabulary))
    slot, factor = np.full(len(vocabulary), -1), np.zeros(len(vocabulary), dtype=np.int64)
    terms = np.array([vocabulary.index(f"t{j}".encode()) for j in range(5)])
    weights = np.array([3, 1, 4, 1, 5])
    scores = np.zeros(2_000, dtype=np.int64)
    for t, w in zip(terms, weights):
        at = slice(shard.start[t], shard.start[t + 1])
        scores[shard.doc[at]] += w * shard.impact[at]
    last = np.sort(scores)[-10]
    docs, found, looked_up = B.best_positions(shard, terms, weights, 10, 0, slot, factor)
    assert set(np.flatnonzero(scores >= last)) <= set(docs.tolist()) and np.array_equal(found, scores[docs])
    assert looked_up < 1_000 and (slot == -1).all() and (factor == 0).all()
    assert B.best_positions(shard, terms, weights, 10, int(scores.max()) + 1, slot, factor)[2] <= looked_up
    assert scores.max() in B.best_positions(shard, terms, weights, 10, int(scores.max()), slot, factor)[1]


def test_query_equals_its_sql(agrees, tables):
    docs, items = corpus(11)
    docs += [(20_000, None), (20_001, ""), (20_002, "-- !"), (20_003, "w1 " * 50_000), (-4, "W1 w2"), (20_004, "NAÏVE É é 😀 x1")]
    items += [(100, None), (101, ""), (102, "naïve É X1"), (103, "w1 w1 w1")]
    rows = [(i, t, "en", "s", 1) for i, t in docs]
    got = agrees("op12_ranked_search", tables(documents=rows, benchmark=items), "documents", "benchmark")
    assert sorted(map(tuple, got), key=repr) == brute(docs, items, 20)


def test_edges(spark):
    docs, items = corpus(2, n=80)
    docs += [(None, docs[3][1]), (3, docs[3][1]), (3, docs[3][1])]
    items += [(None, docs[3][1]), (5, "w3 w4"), (5, "w3 w4")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, item_id string")
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    got = [tuple(r) for r in B.best_documents(df, asked, k=7).collect()]
    assert sorted(got, key=repr) == brute(docs, items, 7)
    assert B.best_documents(df.limit(0), asked).collect() == [] and B.best_documents(df, asked.limit(0)).collect() == []
    assert B.best_documents(df, asked.filter("text = ''")).collect() == []
