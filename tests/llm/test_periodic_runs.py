"""Periodic runs against brute force over all periods, and the query against its SQL."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from candlewick.llm import periodic_runs as P
from fixtures_llm import agrees, tables  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(words, min_length=6, min_exponent=4):
    """Every run by trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(min_length, min_exponent * q) and not any(
                    all(words[start + t] == words[start + t + r] for t in range(length - r)) for r in range(1, q)):
                out.append((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng):
    words = [rng.randrange(rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randint(0, 60))]
    if words and rng.random() < 0.7:
        a, p = rng.randrange(len(words)), rng.randint(1, max(1, len(words) // 3))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("min_length,min_exponent", [(6, 4), (2, 2), (3, 3), (12, 2)])
def test_runs_equal_brute_force(min_length, min_exponent):
    rng = random.Random(min_length * 10 + min_exponent)
    found = 0
    for _ in range(700):
        words = some_words(rng)
        got = P.runs_of(np.array(words, dtype=np.int64), min_length, min_exponent)
        assert got == brute(words, min_length, min_exponent), words
        found += len(got)
    assert found > 200


def test_texts_ranked_together_stay_apart():
    rng = random.Random(5)
    texts = [" ".join(map(str, some_words(rng))) for _ in range(400)] + [None, "", " \n", "a"]
    rng.shuffle(texts)
    runs, main, kept = P.analysed(pa.array(texts, pa.string()), 6, 4)
    for text, rs, best, left in zip(texts, runs.to_pylist(), main.to_pylist(), kept.to_pylist()):
        words = (text or "").split()
        want = brute(words)
        assert [tuple(r.values()) for r in rs] == want and left == collapsed(words, want)
        if want:
            top = min(want, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert tuple(best.values()) == top
        else:
            assert best is None


def test_classes_meet_in_order():
    large, small = [1, 5, 9, 20], [0, 6, 7, 25]
    assert P._met(large, small) == [(0, 1), (5, 6), (7, 9), (20, 25)]
    assert large == [0, 1, 5, 6, 7, 9, 20, 25]


def test_very_long_texts():
    assert P.runs_of(np.zeros(200_000, dtype=np.int64)) == [(0, 200_000, 1)]
    unit = np.random.default_rng(0).permutation(30_000)
    words = np.concatenate([[-1], np.tile(unit, 5)[:-7], [-2]])
    assert P.runs_of(words) == [(1, 149_993, 30_000)]


def test_query_equals_its_sql(agrees, tables):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{x}" for x in some_words(rng)), "en", "s", 1) for i in range(300)]
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, " \t\n ", "en", "s", 3), (1003, "eins", "en", "s", 4),
             (1004, "ja " * 3_000, "en", "s", 1), (1005, "é \x1c\x85 a" * 9, "en", "s", 1), rows[3], rows[3], (-7, "x y " * 9, "en", "s", 1)]
    got = {r["doc_id"]: r for r in agrees("op13_periodic_runs", tables(documents=rows), "documents")}
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and r["n_runs"] for i, r in got.items())
    assert got[1000]["n_runs"] == 0 and got[1000]["start"] is None and got[1004]["exponent_milli"] in (1_000_000 * 3, 3_000_000)


def test_edges(spark):
    df = spark.createDataFrame([(None, "a " * 9, 1), (2, None, 2), (2, "b c " * 4 + "d", 3)], "doc_id long, text string, runs int")
    got = P.periodic_runs(df).collect()
    assert [r["doc_id"] for r in got] == [None, 2, 2] and [len(r["runs"]) for r in got] == [1, 0, 1]
    assert [r["collapsed"] for r in got] == ["a", "", "b c d"]
    assert P.periodic_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        P.periodic_runs(df, min_exponent=1)
