"""Ranked lexical search: Best Position Algorithm over impact lists.

1. One pass over the texts counts, for the terms of the items asked, each
   document's occurrences, and writes them as shards of up to ``SHARD_DOCS``
   documents: an index without a shuffle, however the documents are dealt out.
   The numbers of documents and terms and the document frequencies are sums
   over the shards.
2. Within a shard every term has an impact list: its documents by falling impact.
   An item reads its lists from the top, in blocks; each document met is
   looked up in all of them at once (direct access), which gives its score and
   marks its position in every list.
3. The best position of a list is the last one up to which all have been seen,
   read or looked up.  What is unseen lies beyond it in every list, so the
   impacts right after the best positions bound its score: a tighter bound than
   the last positions read give.  The item stops strictly below its k-th best
   score, so equal scores are all seen.
4. A task keeps the k best of each item over its shards; the k-th bounds the
   next shards from the start.  The tasks' best are ranked by a window.

Items go along with the tasks in blocks of bounded count and size; each block
has its own index.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.llm.common import blank_separated, prepared, text_parts, word_blocks, written

SHARD_DOCS = 2_048
#: positions of each list that are read at first; then twice as many each time
FIRST_READ = 8

#: ASCII letters and digits and all bytes of other characters are terms, A-Z in lower case; the rest separates
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> Counter:
    """Terms of a text with their counts."""
    out: Counter = Counter()
    for block in word_blocks((text or "").encode().translate(TERM_BYTES)):
        out.update(block)
    return out


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of an Arrow array of texts, and the number of each term's text."""
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=texts.offset + len(texts) + 1)[texts.offset:]
    data = texts.buffers()[2]
    data = b"" if data is None else data[int(offsets[0]):int(offsets[-1])].to_pybytes().translate(TERM_BYTES)
    return blank_separated(pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data)))


INDEX = ("doc_ids array<bigint>, sizes array<bigint>, terms array<int>, df array<bigint>, docs binary, tf binary, "
         "with_terms bigint, all_terms bigint")
_ARROW = pa.schema([("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())),
                    ("df", pa.list_(pa.int64())), ("docs", pa.binary()), ("tf", pa.binary()), ("with_terms", pa.int64()),
                    ("all_terms", pa.int64())])


def _counted(ids: pa.Array, texts: pa.Array, vocabulary: pa.Array) -> tuple:
    """Ids and sizes of the texts that hold a known term, ``(text, term, count)`` of each
    such pair, and how many texts hold terms and how many terms they hold."""
    words, of = _split(texts)
    sizes = np.bincount(of, minlength=len(texts))
    term = pc.index_in(words, vocabulary)
    known = np.asarray(term.is_valid())
    pair = of[known] * len(vocabulary) + np.asarray(term.drop_null()).astype(np.int64)
    pair, tf = np.unique(pair, return_counts=True)
    doc, term = pair // max(1, len(vocabulary)), pair % max(1, len(vocabulary))
    held, doc = np.unique(doc, return_inverse=True)
    return ids.take(pa.array(held)), sizes[held], doc, term, tf, int(np.count_nonzero(sizes)), int(sizes.sum())


def _shard(parts: list[tuple]) -> pa.RecordBatch:
    base = np.cumsum([0, *(len(p[0]) for p in parts)])
    doc = np.concatenate([p[2] + b for p, b in zip(parts, base)])
    term, tf = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
    by = np.lexsort((doc, term))
    terms, df = np.unique(term, return_counts=True)
    return pa.RecordBatch.from_pydict({
        "doc_ids": [pa.concat_arrays([p[0] for p in parts]).to_pylist()], "sizes": [np.concatenate([p[1] for p in parts])],
        "terms": [terms], "df": [df], "docs": [doc[by].astype(np.int32).tobytes()], "tf": [tf[by].astype(np.int32).tobytes()],
        "with_terms": [sum(p[5] for p in parts)], "all_terms": [sum(p[6] for p in parts)]}, schema=_ARROW)


def _index(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    words = [w.decode() for w in vocabulary]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, held = pa.array(words, pa.string()), [], 0
        for batch in stream:
            at = 0
            for texts in text_parts(batch.column(1)):
                for start in range(0, len(texts), SHARD_DOCS):
                    piece = texts.slice(start, SHARD_DOCS)
                    if held + len(piece) > SHARD_DOCS:
                        yield _shard(parts)
                        parts, held = [], 0
                    parts.append(_counted(batch.column(0).slice(at, len(piece)), piece, known))
                    at += len(piece)
                    held += len(piece)
        if parts:
            yield _shard(parts)

    return docs.mapInArrow(batches, INDEX)


class Shard:
    """Impact lists of a shard, by term and by document."""

    def __init__(self, doc_ids: pa.Array, sizes: np.ndarray, terms: np.ndarray, df: np.ndarray, docs: np.ndarray,
                 tf: np.ndarray, count: int, total: int, vocabulary: int):
        self.ids = np.asarray(doc_ids.fill_null(0)).astype(np.int64)
        self.no_id = np.asarray(doc_ids.is_null()).astype(bool)
        length = 75 + (25 * count * sizes) // max(1, total)
        tf = tf.astype(np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * length[docs])
        self.start = np.concatenate([[0], np.cumsum(df)])
        own = np.repeat(np.arange(len(terms)), df)
        by = np.lexsort((docs, -impact, own))
        self.doc, self.impact = docs[by], impact[by]
        self.at = np.full(vocabulary, -1, dtype=np.int64)
        self.at[terms] = np.arange(len(terms))
        place = np.arange(len(by)) - self.start[own]
        forward = np.argsort(self.doc, kind="stable")
        self.row = np.searchsorted(self.doc[forward], np.arange(len(self.ids) + 1))
        self.row_term, self.row_impact, self.row_place = terms[own[forward]], self.impact[forward], place[forward]


def _spans(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all spans one after the other, and where each span starts among them."""
    first = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(begin - first, length), first


def best_positions(shard: Shard, terms: np.ndarray, weights: np.ndarray, k: int, floor: int,
                   slot: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``(documents, scores, looked_up)`` of all documents of a shard that can be among the
    item's k best, given that scores under ``floor`` cannot.  ``slot`` (-1 everywhere)
    and ``factor`` (0 everywhere) are working space by term and come back so."""
    lists = shard.at[terms]
    terms, weights, lists = terms[lists >= 0], weights[lists >= 0], lists[lists >= 0]
    begin, size = shard.start[lists], shard.start[lists + 1] - shard.start[lists]
    best = np.zeros(len(lists), dtype=np.int64)
    none = np.zeros(0, dtype=np.int64)
    found, scores, looked_up = none, none, 0
    offset = np.cumsum(size) - size
    seen_place, seen_doc = np.zeros(int(size.sum()), dtype=bool), np.zeros(len(shard.ids), dtype=bool)
    slot[terms], factor[terms] = np.arange(len(terms)), weights
    depth, step, kth = 0, FIRST_READ, max(1, floor)
    while len(lists):
        inside = best < size
        bound = int((weights[inside] * shard.impact[(begin + best)[inside]]).sum())
        if bound < kth:
            break
        # sorted access: the next positions of every list
        read, _ = _spans(begin + np.minimum(depth, size), np.clip(size - depth, 0, step))
        new = np.unique(shard.doc[read])
        new = new[~seen_doc[new]]
        seen_doc[new] = True
        depth, step = depth + step, step * 2
        if len(new):
            # direct access: all entries of the new documents
            row, first = _spans(shard.row[new], shard.row[new + 1] - shard.row[new])
            term = shard.row_term[row]
            score = np.add.reduceat(factor[term] * shard.row_impact[row], first)
            own = slot[term]
            mine = own >= 0
            seen_place[offset[own[mine]] + shard.row_place[row[mine]]] = True
            looked_up += len(new)
            found, scores = np.concatenate([found, new]), np.concatenate([scores, score])
            if len(scores) > k:
                last = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= last
                found, scores = found[keep], scores[keep]
            if len(scores) >= k:
                kth = max(kth, int(scores.min()))
        for i in np.flatnonzero(inside).tolist():
            rest = seen_place[offset[i] + best[i]:offset[i] + size[i]]
            step_to = int(rest.argmin())
            best[i] += step_to if not rest[step_to] else len(rest)
    slot[terms], factor[terms] = -1, 0
    keep = scores >= max(1, floor)
    return found[keep], scores[keep], looked_up


def _blocks(items: DataFrame, max_items: int, max_bytes: int) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in items.toLocalIterator():
        length = len((row["text"] or "").encode())
        if block and (len(block) >= max_items or size + length > max_bytes):
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += length
    if block:
        yield block


def _searched(docs: DataFrame, block: list[tuple], k: int, number: int) -> DataFrame:
    spark = docs.sparkSession
    counts = [terms_of(text) for _, text in block]
    vocabulary = sorted(set().union(*counts))
    index = written(_index(docs, vocabulary), "impacts")
    total = index.agg(F.sum("with_terms").alias("n"), F.sum("all_terms").alias("l")).first()
    n, words = total["n"] or 0, total["l"] or 0
    frequency = dict.fromkeys(range(len(vocabulary)), 0)
    for row in (index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms")
                .agg(F.sum("x.df").alias("df")).collect()):  # a row per term of this block of items
        frequency[row["terms"]] = row["df"]
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * frequency[i] + 1))) for i, t in enumerate(vocabulary)}
    place = {t: i for i, t in enumerate(vocabulary)}
    asked = [(np.array([place[t] for t in c], dtype=np.int64), np.array([weight[t] * r for t, r in c.items()], dtype=np.int64))
             for c in counts]
    shipped = spark.sparkContext.broadcast((asked, [i for i, _ in block], n, words, len(vocabulary)))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, names, n, words, size = shipped.value
        slot, factor = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int64)
        none = np.zeros(0, dtype=np.int64)
        best = [(none, none, none.astype(bool))] * len(asked)
        for batch in stream:
            for r in range(len(batch)):
                own = [batch.column(c)[r] for c in range(6)]
                if not len(own[0]):
                    continue
                shard = Shard(own[0].values, *(np.asarray(x.values) for x in own[1:4]),
                              *(np.frombuffer(x.as_buffer(), dtype=np.int32) for x in own[4:]), n, words, size)
                for i, (terms, weights) in enumerate(asked):
                    scores, ids, no_id = best[i]
                    docs, more, _ = best_positions(shard, terms, weights, k, int(scores[-1]) if len(scores) == k else 0,
                                                   slot, factor)
                    if len(docs):
                        scores, ids = np.concatenate([scores, more]), np.concatenate([ids, shard.ids[docs]])
                        no_id = np.concatenate([no_id, shard.no_id[docs]])
                        by = np.lexsort((ids, no_id, -scores))[:k]
                        best[i] = scores[by], ids[by], no_id[by]
        held = [i for i, b in enumerate(best) if len(b[0])]
        if held:
            of = np.repeat(held, [len(best[i][0]) for i in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in of.tolist()], pa.int64()), pa.array(of.astype(np.int64) + (number << 32)),
                 pa.array(np.concatenate([best[i][1] for i in held]), mask=np.concatenate([best[i][2] for i in held])),
                 pa.array(np.concatenate([best[i][0] for i in held]))], ["item_id", "asked", "doc_id", "score"])

    return index.mapInArrow(batches, "item_id long, asked long, doc_id long, score long")


def best_documents(docs: DataFrame, items: DataFrame, *, k: int = 20, max_items: int = 4_096, max_bytes: int = 4 << 20,
                   id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k highest-scoring documents of each row of ``items``.

    A term's weight is ``floor(1000 * ln((2N + 2) / (2df + 1)))``, a document's length
    factor ``m = 75 + (25 * n * N) div L``, its score the sum over the item's terms
    (repeats included) of ``weight * ((10^9 * tf) div (1000 * tf + 12 * m))``, with N
    documents that hold a term, L terms in them, n in this one.  Only scores above 0
    are listed; equal scores by ascending id (NULL last), equal ids in any order.

    NULL and empty texts and items have no terms: no rows, and they count in
    neither N nor L.  Repeated documents are documents of their own; repeated items
    repeat their ranks.  An empty table gives an empty result; other columns are not
    read.  The index jobs run when this is called.  Items travel in blocks of
    at most ``max_items`` rows and about ``max_bytes`` of text (a longer item is a
    block of its own), each with a pass of its own over the documents."""
    prepared(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    found = None
    for number, block in enumerate(_blocks(asked, max_items, max_bytes)):
        part = _searched(rows, block, k, number)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("asked").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
