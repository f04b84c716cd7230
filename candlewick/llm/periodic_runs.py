"""Periodic run detection: descending-LCP Kruskal over the words of a text.

A run is a stretch of consecutive words with smallest period ``q`` that no
neighbouring word extends, of at least ``min_length`` words and
``min_exponent`` periods.

1. Words become numbers (Arrow kernels); the suffixes of all texts of a part of
   a batch are ranked together by prefix doubling, a word of one text never
   equalling one of another.
2. Neighbours in suffix order are the edges of a path; their weight is the
   length of their common prefix (LCP).  Kruskal's algorithm takes them by
   decreasing LCP and unites classes of suffixes (union-find, the smaller into
   the larger); each class keeps its positions in order.
3. When two classes meet at LCP ``l``, positions ``i < j`` that become
   neighbours, one from each, have exactly ``l`` words in common.  With
   ``d = j - i`` within the LCP they seed the run ``[i, j + l)`` of period
   ``d``; it counts if the words before ``i`` and ``j`` differ (else an earlier
   pair seeds it).  ``d`` is its smallest period: with a smaller one a member of
   the class would lie between ``i`` and ``j``.

Only LCPs that can seed a run of the asked size make edges, so texts in which no
word sequence of that length repeats are put aside before any suffix is
ranked.  A text is handled whole in one task; memory grows with its words times
the logarithm of its longest repeat.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import blank_separated, prepared, text_parts

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _least_lcp(min_length: int, min_exponent: int) -> int:
    """The smallest LCP that can seed a run, over all periods."""
    return min(max((min_exponent - 1) * d, min_length - d, 1) for d in range(1, max(2, min_length + 1)))


def _repetitive(codes: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """The texts in which a sequence of ``size`` words occurs twice (by a 64-bit
    hash of words and text, so a chance collision can only add a text)."""
    n = len(codes) - size + 1
    if n < 2:
        return np.zeros(0, dtype=doc.dtype)
    word = (codes.astype(np.uint64) + np.uint64(1)) * _MIX[0]
    word ^= word >> np.uint64(29)
    word = (word + doc.astype(np.uint64)) * _MIX[1]
    word ^= word >> np.uint64(32)
    grams = np.zeros(n, dtype=np.uint64)
    for t in range(size):
        grams = grams * _MIX[2] + word[t:t + n]
    by = np.sort(grams)
    twice = by[1:][by[1:] == by[:-1]]
    if not len(twice):
        return np.zeros(0, dtype=doc.dtype)
    at = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
    return np.unique(doc[:n][twice[at] == grams])


def _suffix_ranks(symbols: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... symbols, as far as some
    are equal, and the suffix array."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    levels, step = [], 1
    while n and rank.max() < n - 1:
        levels.append(rank.astype(np.int32))
        key = rank * (n + 1)
        key[:max(0, n - step)] += rank[step:] + 1
        rank = np.unique(key, return_inverse=True)[1]
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return levels, order


def _common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    lcp = np.zeros(len(a), dtype=np.int64)
    for t in range(len(levels) - 1, -1, -1):
        at, bt = a + lcp, b + lcp
        inside = (at < n) & (bt < n)
        same = levels[t][np.where(inside, at, 0)] == levels[t][np.where(inside, bt, 0)]
        lcp += np.where(inside & same, 1 << t, 0)
    return lcp


def _met(large: list[int], small: list[int]) -> list[tuple[int, int]]:
    """Neighbours in the union of two ordered position sets, one from each; the
    large set takes the small one in."""
    pairs, last, size = [], None, len(large)
    for k, x in enumerate(small):
        at = bisect_left(large, x)
        left = large[at - 1] if at else None
        right = large[at] if at < size else None
        if left is not None and (last is None or left > last):
            pairs.append((left, x))
        following = small[k + 1] if k + 1 < len(small) else None
        if right is not None and (following is None or right < following):
            pairs.append((x, right))
        last = x
    if len(small) * 8 < size:
        for x in small:
            insort(large, x)
    else:
        large.extend(small)
        large.sort()
    return pairs


def runs_of(symbols: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a sequence of numbers, by start, then period."""
    n, least = len(symbols), _least_lcp(min_length, min_exponent)
    levels, order = _suffix_ranks(symbols)
    a, b = order[:-1], order[1:]
    level = min(least.bit_length() - 1, len(levels) - 1)
    if level < 0:
        return []
    near = levels[level][a] == levels[level][b]  # share the first 2 ** level symbols
    a, b = a[near], b[near]
    lcp = _common_prefixes(levels, a, b, n)
    keep = lcp >= least
    a, b, lcp = a[keep], b[keep], lcp[keep]
    by = np.argsort(-lcp, kind="stable")
    nodes, ends = np.unique(np.concatenate([a[by], b[by]]), return_inverse=True)
    sets = [[x] for x in nodes.tolist()]
    parent = list(range(len(sets)))
    ends = ends.tolist()
    half = len(by)
    found = []
    more = min_exponent - 1
    for k, common in enumerate(lcp[by].tolist()):
        u, v = ends[k], ends[half + k]
        while parent[u] != u:
            parent[u] = parent[parent[u]]
            u = parent[u]
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        if len(sets[u]) < len(sets[v]):
            u, v = v, u
        for i, j in _met(sets[u], sets[v]):
            d = j - i
            if more * d <= common and d <= common and d + common >= min_length and (i == 0 or symbols[i - 1] != symbols[j - 1]):
                found.append((i, d + common, d))
        parent[v], sets[v] = u, None
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of_texts(codes: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """The runs of many texts laid end to end (``doc``: rising number of each word's text)."""
    texts = _repetitive(codes, doc, _least_lcp(min_length, min_exponent))
    if not len(texts):
        return []
    at = np.flatnonzero(np.isin(doc, texts))
    symbols = doc[at].astype(np.int64) * (int(codes.max()) + 1) + codes[at]
    return [(int(at[s]), n, q) for s, n, q in runs_of(symbols, min_length, min_exponent)]


def analysed(texts: pa.Array, min_length: int, min_exponent: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Runs, main run and collapsed text of every text of an Arrow array."""
    words, doc = blank_separated(pc.fill_null(texts, ""))
    begin = np.searchsorted(doc, np.arange(len(texts) + 1))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    change = np.zeros(len(words) + 1, dtype=np.int64)
    if len(words):
        codes = np.asarray(words.dictionary_encode().indices).astype(np.int64)
        for start, length, period in runs_of_texts(codes, doc, min_length, min_exponent):
            own = int(doc[start])
            runs[own].append((start - int(begin[own]), length, period))
            change[start + period] += 1
            change[start + length] -= 1
    stay = np.cumsum(change[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(stay)])[begin].astype(np.int32)
    kept = pa.ListArray.from_arrays(pa.array(left), words.filter(pa.array(stay)))
    best = [max(rs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if rs else None for rs in runs]

    def rows(xs):
        return [{"start": s, "length": n, "period": q} for s, n, q in xs]

    return (pa.array([rows(rs) for rs in runs], pa.list_(RUN)),
            pa.array([None if r is None else rows([r])[0] for r in best], RUN),
            pc.binary_join(kept, " ").cast(pa.string()))


def periodic_runs(docs: DataFrame, *, min_length: int = 6, min_exponent: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(doc_id, runs, main_run, collapsed)`` for every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  ``runs`` holds
    ``(start, length, period)`` by start, then period; ``main_run`` is the one with the
    greatest length by period (ties: smallest start, then period; no run: NULL);
    ``collapsed`` are the words joined by one blank without those that lie in a run
    after its first period.  ``min_exponent`` is a whole number of at least 2.
    NULL and empty texts have no run and an empty ``collapsed``; repeated rows
    repeat their result, NULL ids stay, an empty table gives an empty result
    and other columns are not read.  No shuffle: a text is handled where it is read."""
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")
    prepared(docs.sparkSession)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            at = 0
            for part in text_parts(batch.column(1)):
                found = analysed(part, min_length, min_exponent)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), *found],
                                                 ["doc_id", "runs", "main_run", "collapsed"])
                at += len(part)

    run = "struct<start:bigint,length:bigint,period:bigint>"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(batches, f"doc_id long, runs array<{run}>, main_run {run}, collapsed string")
