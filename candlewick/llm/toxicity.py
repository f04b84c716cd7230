"""Toxicity: nearest labelled examples by exact TF-IDF cosine.

1. Terms are the words of the labelled examples, an exact dictionary, and the
   word beginnings that mark the label (chosen on the labelled sample).  Terms that
   mark the label weigh ``marking`` times their TF-IDF: a stated part of the
   weighting, not a second model.  Words that no example holds count in a text's
   length with the idf of a word seen once.
2. One pass over all texts writes each text's term counts (Arrow kernels);
   document frequencies are counted over all documents.
3. The examples' unit vectors form an inverted index whose postings lie in blocks of
   alike examples, with the largest weight of each term per block.  A query
   scores the blocks of the highest bounds, then those that can still reach the
   k-th best: the neighbours are exact.
4. Neighbours vote with their cosines; isotonic regression on the examples' own
   leave-one-out votes, weighted by what each example stands for, turns the
   vote into a probability.

The index is bounded by ``max_examples`` rows and ``max_example_chars`` of text and
travels with the tasks; texts never leave their tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.llm.common import blank_separated, prepared, shuffled, text_parts, written

#: lengths of word beginnings that can be terms besides the words
BEGINNINGS = (4, 5, 6, 7)


def plain_words(text: Column) -> Column:
    """A text's words (runs of letters, lower case), separated by blanks; NULL is empty."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " ")


class Dictionary:
    """Term numbers: the known words, then the known beginnings (``beginning*``)."""

    def __init__(self, words: list[str], beginnings: list[str]):
        self.words = pa.array(words, pa.string())
        self.size = len(words) + len(beginnings)
        self.beginnings = [(n, pa.array([b for b in beginnings if len(b) == n], pa.string()),
                            np.array([len(words) + i for i, b in enumerate(beginnings) if len(b) == n], dtype=np.int64))
                           for n in sorted({len(b) for b in beginnings})]

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(text, term, count)`` of all pairs, by text and term; per text the squared
        weights of its words outside the dictionary (for an idf of one) and its words."""
        words, of = blank_separated(texts)
        coded = words.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        width = self.size + len(coded.dictionary)
        known = np.asarray(pc.fill_null(pc.index_in(coded.dictionary, self.words), -1)).astype(np.int64)
        term = np.where(known < 0, self.size + np.arange(len(known)), known)
        pairs = [of * width + term[code]] if len(code) else [np.zeros(0, dtype=np.int64)]
        if len(code):
            length = np.asarray(pc.utf8_length(coded.dictionary))
            for n, starts, numbers in self.beginnings:
                at = np.asarray(pc.fill_null(pc.index_in(pc.utf8_slice_codeunits(coded.dictionary, 0, n), starts), -1)).astype(np.int64)
                at = np.where(length > n, at, -1)[code]
                pairs.append(of[at >= 0] * width + numbers[at[at >= 0]])
        pair, count = np.unique(np.concatenate(pairs), return_counts=True)
        text, term = pair // max(1, width), pair % max(1, width)
        outside = term >= self.size
        squares = np.bincount(text[outside], (1 + np.log(count[outside])) ** 2, len(texts)).astype(np.float64)
        inside = ~outside
        return text[inside], term[inside], count[inside], squares, np.bincount(of, minlength=len(texts))


def unit_weights(row: np.ndarray, term: np.ndarray, count: np.ndarray, outside: np.ndarray, idf: np.ndarray,
                 rare: float) -> np.ndarray:
    """Weights ``(1 + ln tf) * idf`` of the entries of many texts (``row``: rising number of
    each entry's text), each text's vector of length one; ``outside`` words weigh in
    the length with the idf ``rare``."""
    weight = (1 + np.log(count)) * idf[term]
    squares = np.bincount(row, weight * weight, len(outside)) + outside * rare * rare
    return weight / np.sqrt(np.maximum(squares, 1e-300))[row]


def _ranges(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after the other, and the range of each."""
    of = np.repeat(np.arange(len(begin)), length)
    return np.arange(len(of)) + (begin - np.cumsum(length) + length)[of], of


def topics(row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, terms: int, frequent: int = 256, kinds: int = 12) -> np.ndarray:
    """A rough cluster of each vector (k-means by cosine over the most frequent terms, seeded by
    the vector least like the seeds before): vectors of one language or subject lie together."""
    if not n:
        return np.zeros(0, dtype=np.int64)
    most = np.argsort(-np.bincount(term, minlength=terms), kind="stable")[:frequent]
    column = np.full(terms, -1)
    column[most] = np.arange(len(most))
    own = column[term] >= 0
    dense = np.zeros((n, len(most)))
    dense[row[own], column[term[own]]] = weight[own]
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-300)
    centres = [dense[int(np.argmax(np.linalg.norm(dense, axis=1)))]]
    nearest = dense @ centres[0]
    while len(centres) < min(kinds, n):
        centres.append(dense[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, dense @ centres[-1])
    centre = np.array(centres)
    for _ in range(8):
        kind = np.argmax(dense @ centre.T, axis=1)
        for c in range(len(centre)):
            mean = dense[kind == c].sum(axis=0)
            if mean.any():
                centre[c] = mean / np.linalg.norm(mean)
    return np.argmax(dense @ centre.T, axis=1)


class BlockMaxIndex:
    """Exact top cosines among unit vectors by block-max pruning.

    Vectors come as entries ``(row, term, weight)`` with rising rows.  They lie by
    rough topic and size, so the largest weights of a block are those of like vectors."""

    def __init__(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, labels: np.ndarray, ids: np.ndarray, terms: int,
                 block: int = 64):
        n = len(ids)
        order = np.lexsort((np.arange(n), np.bincount(row, minlength=n), topics(row, term, weight, n, terms)))
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        self.block, self.blocks = block, -(-n // block)
        self.labels, self.ids = labels[order].astype(np.float64), ids[order]
        self.by_id = np.argsort(self.ids, kind="stable")
        by = np.lexsort((place[row], term))
        self.place, self.weight = place[row][by].astype(np.int32), weight[by]
        # the (term, block) cells that hold postings, by term
        cell = term[by].astype(np.int64) * max(1, self.blocks) + self.place // block
        self.begin = np.flatnonzero(np.diff(cell, prepend=-1))
        self.length = np.diff(np.append(self.begin, len(self.place)))
        self.first = np.searchsorted(cell[self.begin], np.arange(terms + 1) * max(1, self.blocks))
        self.cell_block = (self.place[self.begin] // block).astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, self.begin) if len(self.begin) else np.zeros(0)

    def places(self, name: int) -> np.ndarray:
        lo, hi = np.searchsorted(self.ids, [name, name + 1], sorter=self.by_id)
        return self.by_id[lo:hi]

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, leave_out: int | None = None, told: list | None = None):
        """``(places, cosines)`` of the k nearest examples with a cosine above zero and
        of all that tie with the last of them; ``leave_out`` is an id to skip.
        ``told`` collects ``(blocks scored, blocks with a common term)``.

        The blocks of the highest bounds are scored first; their k-th best cosine
        prunes the others."""
        cells, of = _ranges(self.first[terms], self.first[terms + 1] - self.first[terms])
        if not len(cells):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        block, weight = self.cell_block[cells], weights[of]
        bound = np.bincount(block, weight * self.most[cells], self.blocks)
        scores, last, rest = np.zeros(len(self.ids)), 0.0, bound > 0
        asked = np.count_nonzero(rest)
        first = min(self.blocks - 1, 1 + 2 * k // self.block)
        chosen = bound >= np.partition(bound, self.blocks - 1 - first)[self.blocks - 1 - first]
        scored = 0
        while True:
            chosen &= rest
            scored += np.count_nonzero(chosen)
            take = np.flatnonzero(chosen[block])
            where, own = _ranges(self.begin[cells[take]], self.length[cells[take]])
            scores += np.bincount(self.place[where], weight[take][own] * self.weight[where], len(scores))
            if leave_out is not None:
                scores[self.places(leave_out)] = 0
            if np.count_nonzero(scores) >= k:
                last = np.partition(scores, len(scores) - k)[len(scores) - k]
            rest &= ~chosen & (bound >= last - 1e-9)
            if not rest.any():
                break
            chosen = rest.copy()
        if told is not None:
            told.append((scored, asked))
        near = np.flatnonzero((scores > 0) & (scores >= last - 1e-12))
        near = near[np.lexsort((near, -scores[near]))]
        return near, scores[near]

    def vote(self, terms: np.ndarray, weights: np.ndarray, k: int, prior: float, leave_out: int | None = None) -> tuple[float, list]:
        """Cosine-weighted share of label 1 among the k nearest, drawn to ``prior`` by one
        vote; ties at the k-th share its place.  And the nearest few as evidence."""
        place, score = self.top(terms, weights, k, leave_out)
        if not len(place):
            return prior, []
        share = np.ones(len(place))
        if len(place) > k:
            tied = np.abs(score - score[-1]) <= 1e-12
            share[tied] = (k - (~tied).sum()) / tied.sum()
        w = score * share
        vote = (float(w @ self.labels[place]) + prior) / (float(w.sum()) + 1)
        few = np.lexsort((self.ids[place], -score))[:3]
        return vote, [(int(self.ids[place[i]]), float(score[i]), int(self.labels[place[i]])) for i in few]


def isotonic(votes: np.ndarray, labels: np.ndarray, prior: float, stands_for: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Knots ``(vote, probability)`` of the rising fit of labels to votes, each weighted by
    ``stands_for`` (default 1); each level is drawn to ``prior`` by one observation."""
    weight = np.ones(len(votes)) if stands_for is None else stands_for
    levels: list[list[float]] = []
    for x, y, w in sorted(zip(votes.tolist(), labels.tolist(), weight.tolist())):
        levels.append([x, y * w, w])
        while len(levels) > 1 and levels[-2][1] / levels[-2][2] >= levels[-1][1] / levels[-1][2]:
            x2, y2, n2 = levels.pop()
            x1, y1, n1 = levels.pop()
            levels.append([(x1 * n1 + x2 * n2) / (n1 + n2), y1 + y2, n1 + n2])
    knots = np.array([x for x, _, _ in levels])
    return knots, np.maximum.accumulate(np.array([(y + prior) / (n + 1) for _, y, n in levels]))


def in_training(doc_id: Column) -> Column:
    """Rows whose label may be learnt: crc32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def choose_terms(labelled: DataFrame, *, max_terms: int, least_docs: int, chi_square: float, purity: float) -> list[str]:
    """The terms of ``labelled(text, toxic)`` (texts as ``plain_words``) that mark label 1,
    words and beginnings (``beginning*``): seen in ``least_docs`` such rows, label 1 in at
    least ``purity`` of their rows, and a chi-square statistic of at least
    ``chi_square``; the ``max_terms`` highest."""
    def tally(names: pa.Array, code: np.ndarray, of: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
        pair = np.unique(of * max(1, len(names)) + code)
        label, code = labels[pair // max(1, len(names))], pair % max(1, len(names))
        seen = [np.bincount(code[label == y], minlength=len(names)) for y in (1, 0)]
        return pa.RecordBatch.from_arrays([names, *map(pa.array, seen)], ["term", "bad", "good"])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            at = 0
            for texts in text_parts(batch.column(0)):
                labels = np.asarray(batch.column(1).slice(at, len(texts)))
                at += len(texts)
                words, of = blank_separated(texts)
                coded = words.dictionary_encode()
                code = np.asarray(coded.indices).astype(np.int64)
                yield tally(coded.dictionary, code, of, labels)
                length = np.asarray(pc.utf8_length(coded.dictionary))
                for n in BEGINNINGS:
                    starts = pc.binary_join_element_wise(pc.utf8_slice_codeunits(coded.dictionary, 0, n), "", "*").dictionary_encode()
                    own = (length > n)[code] if len(code) else np.zeros(0, dtype=bool)
                    yield tally(starts.dictionary, np.asarray(starts.indices).astype(np.int64)[code[own]], of[own], labels)

    totals = labelled.groupBy("toxic").count().collect()
    n = {0: 0, 1: 0} | {r["toxic"]: r["count"] for r in totals}
    counts = (labelled.select("text", "toxic").mapInArrow(batches, "term string, bad long, good long")
              .groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    bad, good, every = F.col("bad").cast("double"), F.col("good").cast("double"), float(n[0] + n[1])
    cross = bad * (n[0] - good) - good * (n[1] - bad)
    chi = F.try_divide(every * cross * cross, n[1] * n[0] * (bad + good) * (every - bad - good))
    chosen = (counts.filter((bad >= least_docs) & (bad >= purity * (bad + good)))
              .withColumn("chi", F.coalesce(chi, F.lit(0.0))).filter(F.col("chi") >= chi_square)
              .orderBy(F.desc("chi"), "term").limit(max_terms))
    return [r["term"] for r in chosen.select("term").collect()]


def _lists(row: np.ndarray, n: int, *values: tuple[np.ndarray, pa.DataType]) -> list[pa.Array]:
    offsets = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(v, t)) for v, t in values]


def score_toxicity(docs: DataFrame, labels: DataFrame, *, k: int = 25, max_labelled: int = 20_000, max_examples: int = 2_000,
                   max_example_chars: int = 16_000_000, max_terms: int = 4_096, least_docs: int = 2, chi_square: float = 10.0,
                   purity: float = 0.5, marking: float = 2.0, threshold: float = 0.7, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(doc_id, text_hash, held_out, score, predicted, evidence)`` for every row.

    ``score`` is the calibrated probability of label 1, ``evidence`` the three
    nearest examples ``(doc_id, cosine, label)``.  Documented bounds of what is fitted: the
    marking terms (at most ``max_terms``) come from at most ``max_labelled`` training rows, drawn
    by a hash of the id; the index holds at most ``max_examples`` of these, up to half
    of them of label 1, with at most ``max_example_chars`` characters.  Document frequencies
    and scores cover all rows; only texts enter a score.

    A text's vector has ``(1 + ln tf) * idf`` for each word that an example holds, and for the
    terms that mark the label ``marking`` times that; its other words count in its
    length, with the idf of a word seen once.  A text without words (so NULL and
    empty texts) has the labelled wordless texts' share of label 1, drawn to the
    share among all by one observation.  Without labels every score is 0.5.  Of
    several labels of one id the highest counts; labels other than 0 and 1 or NULL are
    ignored; rows with a NULL id are scored and held in (they are not learnt);
    repeated rows repeat their score; other columns are not read.  The fitting
    jobs run when this is called."""
    spark = prepared(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
                       plain_words(F.col(text_col).cast("string")).alias("text"))
    marks = (labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label_col).cast("int").alias("toxic"))
             .filter(F.col("toxic").isin(0, 1) & in_training(F.col("label_id")))
             .groupBy("label_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled))
    marks = written(marks, "labels")  # at most max_labelled rows
    learnt = rows.join(F.broadcast(marks), F.col("doc_id") == F.col("label_id")).groupBy("doc_id").agg(
        F.min(F.struct("text_hash", "text", "toxic")).alias("x"))
    learnt = written(learnt.select("doc_id", "x.text", "x.toxic", F.length("x.text").alias("chars")), "labelled")
    blank = F.trim("text") == ""
    told = learnt.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("k"),
                      F.count_if(blank).alias("bn"), F.coalesce(F.sum(F.when(blank, F.col("toxic"))), F.lit(0)).alias("bk")).first()
    prior = (told["k"] + 1) / (told["n"] + 2)
    nothing = (told["bk"] + prior) / (told["bn"] + 1)
    terms = choose_terms(learnt, max_terms=max_terms, least_docs=least_docs, chi_square=chi_square, purity=purity)

    # at most max_labelled rows in a window by label
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    share = F.when(F.col("toxic") == 1, max_examples // 2).otherwise(max_examples - min(max_examples // 2, told["k"]))
    chosen = (learnt.filter(~blank).withColumn("at", F.row_number().over(order)).withColumn("upto", F.sum("chars").over(order))
              .filter((F.col("at") <= share) & (F.col("upto") <= max_example_chars // 2)))
    apart = chosen.select("doc_id", "text", "toxic").toArrow().combine_chunks().sort_by("doc_id")
    names, toxic = np.asarray(apart.column("doc_id")), np.asarray(apart.column("toxic")).astype(np.int64)
    texts = pa.concat_arrays(apart.column("text").chunks) if len(apart) else pa.array([], pa.string())
    words = sorted(set(pc.unique(blank_separated(texts)[0]).to_pylist()) | {t for t in terms if not t.endswith("*")})
    starts = [t[:-1] for t in terms if t.endswith("*")]

    def vectors(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Dictionary(words, starts)
        for batch in stream:
            at = 0
            for part in text_parts(batch.column(2)):
                row, term, count, outside, size = known.counts(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)),
                     *_lists(row, len(part), (term, pa.int32()), (count, pa.int32())), pa.array(outside), pa.array(size > 0)],
                    ["doc_id", "text_hash", "terms", "counts", "outside", "has_words"])
                at += len(part)

    counted = written(rows.mapInArrow(vectors, "doc_id long, text_hash long, terms array<int>, counts array<int>, "
                                               "outside double, has_words boolean"), "vectors")
    every = counted.count()
    frequency = np.zeros(len(words) + len(starts))
    seen_in = counted.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # a row per term, bounded
    frequency[np.asarray(seen_in.column("t"))] = np.asarray(seen_in.column("count"))
    idf, rare = np.log((1 + every) / (1 + frequency)) + 1, float(np.log((1 + every) / 2) + 1)
    marked = set(terms)
    idf[[i for i, w in enumerate(words) if w in marked]] *= marking
    idf[len(words):] *= marking
    row, term, count, outside, _ = Dictionary(words, starts).counts(texts)
    weight = unit_weights(row, term, count, outside, idf, rare)
    index = BlockMaxIndex(row, term, weight, toxic, names, len(idf))
    own = np.searchsorted(row, np.arange(len(names) + 1)), term.astype(np.int32), weight
    shipped = spark.sparkContext.broadcast((index, idf, rare, prior, own))

    def votes(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, _, _, base, (start, term, weight) = shipped.value
        for batch in stream:
            out = [index.vote(term[start[i]:start[i + 1]], weight[start[i]:start[i + 1]], k, base, int(names[i]))[0]
                   for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["id", "vote"])

    knots, levels = np.array([0.0]), np.array([prior])
    if len(names):
        left_out = spark.range(0, len(names), 1, 1 + len(names) // 200).mapInArrow(votes, "id long, vote double").collect()
        told_votes = np.array([v for _, v in sorted((r["id"], r["vote"]) for r in left_out)])
        of_label = np.array([told["n"] - told["k"], told["k"]]) / np.maximum(1, np.bincount(toxic, minlength=2))
        knots, levels = isotonic(told_votes, toxic, prior, of_label[toxic])

    def scores(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, idf, rare, base, _ = shipped.value
        kept: dict[tuple, tuple] = {}  # equal vectors vote once
        for whole in stream:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                lists, counts = batch.column(2), batch.column(3)
                ends = np.asarray(lists.offsets).astype(np.int64)
                ends = ends - ends[0]
                term, count = np.asarray(lists.flatten()).astype(np.int64), np.asarray(counts.flatten()).astype(np.int64)
                row = np.repeat(np.arange(len(batch)), np.diff(ends))
                weight = unit_weights(row, term, count, np.asarray(batch.column(4)), idf, rare)
                some = np.asarray(batch.column(5).to_numpy(zero_copy_only=False))
                out = []
                for i in range(len(batch)):
                    t, w = term[ends[i]:ends[i + 1]], weight[ends[i]:ends[i + 1]]
                    if not some[i]:
                        out.append((nothing, []))
                        continue
                    key = t.tobytes(), w.tobytes()
                    if key not in kept:
                        if len(kept) > 2_000:
                            kept.clear()
                        vote, evidence = index.vote(t, w, k, base)
                        kept[key] = float(np.interp(vote, knots, levels)), evidence
                    out.append(kept[key])
                proof = pa.array([[{"doc_id": d, "cosine": s, "label": y} for d, s, y in e] for _, e in out],
                                 pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())])))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s for s, _ in out], pa.float64()),
                                                  proof], ["doc_id", "text_hash", "score", "evidence"])

    scored = counted.mapInArrow(scores, "doc_id long, text_hash long, score double, "
                                        "evidence array<struct<doc_id:bigint,cosine:double,label:int>>")
    return scored.select("doc_id", "text_hash", (~in_training(F.col("doc_id")) & F.col("doc_id").isNotNull()).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` less the rows predicted toxic; all columns stay as they are."""
    found = score_toxicity(docs, labels, **options).filter("predicted = 1") \
        .select(F.col("doc_id").alias("_cw_doc"), F.col("text_hash").alias("_cw_hash")).distinct()
    found = written(found, "toxic")
    own = options.get("id_col", "doc_id"), options.get("text_col", "text")
    return docs.join(shuffled(found), docs[own[0]].cast("long").eqNullSafe(found["_cw_doc"])
                     & (F.xxhash64(docs[own[1]].cast("string")) == found["_cw_hash"]), "left_anti")
