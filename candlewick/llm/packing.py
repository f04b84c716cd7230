"""Packing: concatenate all documents and cut the stream into fixed windows.

Pass one tokenizes every document once and writes, per partition, the ids and
a running count.  The totals of the partitions (one number per task of that
pass) give each partition its global offset by a prefix sum.  Pass two is a
projection: global position // window is the sequence, the remainder the
offset, and a document that crosses windows becomes one boundary record per
window.  No shuffle moves the ids and no task sees more than its partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import prepared, written

SEQUENCE_TOKENS = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed tokenizer package keeps a file (asked on each executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Byte-level tokenizers write a byte as a character: printable ones as themselves,
#: the others, in order, from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARACTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_PROBES = ("word", "Word", "étude", "ÉTUDE", "ñandú", "straße", "l'été ab., cd", "x. it's. y,",
           "ab!!! cd?' x's) é#$& y-z_ 'ab'' f' s")
#: A letter and the ASCII stops between it and a blank.  Of letters, those that stay one
#: letter when normalized and lower-cased (not U+0130 and not U+0958, which leave a mark).
_STOPS = (r"([a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{391}-\x{3A1}\x{3A3}-\x{3CE}"
          r"\x{400}-\x{481}\x{48A}-\x{52F}])([!-/:-@\[-`{-~]+) ")
#: Capitals with a mark that only their small letter is composed with.
_UNCOMPOSED = r"[HJTWY]\pM*[\x{308}\x{30A}\x{30C}\x{331}\x{344}]"


class WordEncoder:
    """Ids of texts by a tokenizer that never joins across a blank.

    Such a tokenizer gives a text the ids of its blank-separated words in
    order, so each distinct word is encoded once and kept (at most about
    ``keep_words`` of them; then only words met in several batches stay) and
    rows of ids are put together by array arithmetic.  If the probes show that
    the tokenizer ignores case and parts a word from the stops after it, texts
    are brought to that form first, which leaves fewer distinct words, and
    words of Latin letters go to the tokenizer's model without the steps that
    cannot change them."""

    def __init__(self, path: str, end_id: int, keep_words: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id, self.keep_words = Tokenizer.from_file(path), end_id, keep_words
        self.model = self.tokenizer.model  # asking for it makes a new wrapper each time
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()
        plain = [self.tokenizer.encode(p, add_special_tokens=False).ids for p in _PROBES]
        self.simple = True
        self.simple = all(self.encode(pa.array([p]))[0].tolist() == [*ids, end_id] for p, ids in zip(_PROBES, plain))
        self._clear()

    def _clear(self):
        self.index: dict[str, int] = {}
        self.flat = np.array([self.end_id], dtype=np.uint32)  # entry 0 is the end of a document
        self.first = np.array([0], dtype=np.int64)
        self.size = np.array([1], dtype=np.int64)
        self.uses = np.array([0], dtype=np.int64)  # batches that held the word

    def _forget(self):
        """Make room: only words met in several batches stay, at most half the store."""
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > self.keep_words // 2:
            kept = np.sort(kept[np.argsort(-self.uses[kept], kind="stable")[:self.keep_words // 2]])
        words, rows = list(self.index), np.concatenate([[0], kept])  # a word's entry is its place in the index, from 1
        self.flat, self.size, self.uses = self._ids(rows), self.size[rows], np.minimum(self.uses[rows], 1)
        self.first = np.cumsum(self.size) - self.size
        self.index = {words[k - 1]: n for n, k in enumerate(kept.tolist(), 1)}

    def _ids(self, entry: np.ndarray) -> np.ndarray:
        """The ids of the entries, one after the other."""
        size = self.size[entry]
        return self.flat[np.repeat(self.first[entry] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]

    def _form(self, texts: pa.Array) -> pa.Array:
        """Blanks between words; and, where it cannot matter, lower case and parted stops."""
        texts = pc.replace_substring(texts, "\n", " ")
        if not self.simple or any(pc.any(pc.match_substring(texts, t, ignore_case=True)).as_py() for t in self.special):
            return texts
        if pc.any(pc.match_substring_regex(texts, _UNCOMPOSED)).as_py():
            return texts
        return pc.replace_substring_regex(pc.ascii_lower(texts), _STOPS, r"\1 \2 ")

    def _word(self, word: str) -> list[int] | None:
        """Ids of a word of Latin letters straight from the model, None for others."""
        if not self.simple or not word.isalpha():
            return None
        coded = word.lower()
        if not word.isascii():
            if max(word) > "\u024f" or len(coded) != len(word):
                return None
            coded = coded.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        return [t.id for t in self.model.tokenize(coded)]

    def _known(self, words: list[str]) -> np.ndarray:
        """The store's entry of each word, 0 for those it lacks."""
        return np.fromiter(map(self.index.get, words, repeat(0)), dtype=np.int64, count=len(words))

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The store's entry of each distinct word, adding those it lacks."""
        entry = self._known(words)
        lacking = np.count_nonzero(entry == 0)
        if lacking and len(self.index) + lacking > self.keep_words:
            self._forget()
            entry = self._known(words)
        places = np.flatnonzero(entry == 0)
        missing = [words[i] for i in places.tolist()]
        ids = [self._word(w) for w in missing]
        rest = [i for i, row in enumerate(ids) if row is None]
        for k in range(0, len(rest), 2_000):  # a few at a time: the results are far larger than their ids
            some = rest[k:k + 2_000]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([missing[i] for i in some], add_special_tokens=False)):
                ids[i] = e.ids
        if missing:
            size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(size.sum()))
            entry[places] = np.arange(len(self.size), len(self.size) + len(missing))
            self.index.update(zip(missing, entry[places].tolist()))
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, flat])
            self.uses = np.concatenate([self.uses, np.zeros(len(missing), dtype=np.int64)])
        self.uses[entry] += 1
        return entry

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each closed by the end id, and the count per text."""
        rows = pc.split_pattern(self._form(pc.fill_null(texts.cast(pa.large_string()), "")), " ")
        words = rows.flatten().dictionary_encode()
        # as numpy objects: several times as fast as to_pylist
        entry = self._numbers(words.dictionary.to_numpy(zero_copy_only=False).tolist())[words.indices.to_numpy()]
        ends = np.cumsum(pc.list_value_length(rows).to_numpy().astype(np.int64))
        entry = np.insert(entry, ends, 0)
        upto = np.cumsum(self.size[entry])[ends + np.arange(len(ends))]  # at each text's end among the entries
        return self._ids(entry), np.diff(upto, prepend=0)


_ENCODERS: dict[tuple, WordEncoder] = {}


def _encoder(path: str, end_id: int) -> WordEncoder:
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def _slices(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text (one row at least)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def tokenized(docs: DataFrame, *, path: str | None = None, name: str = TOKENIZER, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, part, start_in_part, tokens, ids)`` per row, written once.

    ``ids`` holds the document's ids and the end id as little-endian unsigned
    32-bit numbers; ``part`` is the task that wrote the row and
    ``start_in_part`` the ids before it there."""
    prepared(docs.sparkSession)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, done = _encoder(path or tokenizer_path(name), end_id), TaskContext.get().partitionId(), 0
        for whole in stream:
            for batch in _slices(whole):
                ids, counts = encoder.encode(batch.column(1))
                ends = np.cumsum(counts)
                bounds = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int64).tobytes())
                data = pa.Array.from_buffers(pa.large_binary(), len(counts),
                                             [None, bounds, pa.py_buffer(ids.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(len(counts), part, dtype=np.int64)),
                     pa.array(done + ends - counts), pa.array(counts), data.cast(pa.binary())],
                    ["doc_id", "part", "start_in_part", "tokens", "ids"])
                done += int(ends[-1])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(batches, "doc_id long, part long, start_in_part long, tokens long, ids binary"),
                   "tokens")


def pack(docs: DataFrame, *, sequence_tokens: int = SEQUENCE_TOKENS, encode: Callable[..., DataFrame] = tokenized,
         **options) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids, doc_tokens,
    sequence_id, offset, opens, closes, sequence_tokens, padded_tokens``.

    Every id of every row of ``docs`` lies in exactly one piece.  All
    sequences but the last are full.  ``ids`` are the piece's ids (binary,
    little-endian unsigned 32-bit); ``opens`` and ``closes`` tell whether the
    piece begins or ends its document (both false or one: a boundary record).
    A sequence is padded to ``sequence_tokens`` unless its length is a power
    of two.  NULL and empty texts are the end id alone.  Repeated rows and
    rows with a NULL doc_id are packed like any other; other columns of
    ``docs`` are not read.  An empty table gives no piece."""
    tokens = encode(docs, **options)
    spark = tokens.sparkSession
    # one row per task of the first pass, whatever the documents are
    totals = tokens.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect()
    upto = list(accumulate((r["n"] for r in totals), initial=0))
    offsets = spark.createDataFrame([(r["part"], n) for r, n in zip(totals, upto)], "part long, before long")
    window, last = F.lit(sequence_tokens), F.lit(upto[-1])
    begin = F.col("before") + F.col("start_in_part")

    def piece(number):
        low = F.greatest(F.lit(0), number * window - F.col("begin"))
        high = F.least(F.col("tokens"), (number + 1) * window - F.col("begin"))
        return F.struct(number.alias("sequence_id"), low.alias("start"), (high - low).alias("length"),
                        F.substring(F.col("ids"), (low * 4 + 1).cast("int"), ((high - low) * 4).cast("int")).alias("ids"))

    first, final = F.floor(F.col("begin") / window), F.floor((F.col("begin") + F.col("tokens") - 1) / window)
    cut = (tokens.join(F.broadcast(offsets), "part").withColumn("begin", begin)
           .withColumn("p", F.explode(F.transform(F.sequence(first, final), piece))))
    filled = F.least(window, last - F.col("p.sequence_id") * window)
    whole_power = F.bit_count(filled) == 1
    return cut.select(
        "doc_id", "p.start", "p.length", "p.ids", F.col("tokens").alias("doc_tokens"), "p.sequence_id",
        (F.col("begin") + F.col("p.start") - F.col("p.sequence_id") * window).alias("offset"),
        (F.col("p.start") == 0).alias("opens"), (F.col("p.start") + F.col("p.length") == F.col("tokens")).alias("closes"),
        filled.alias("sequence_tokens"), F.when(whole_power, filled).otherwise(window).alias("padded_tokens"))


def sequences(pieces: DataFrame, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, ids array<int>)``: the pieces of each sequence in order,
    padded with ``pad_id`` to ``padded_tokens``.  A group is one sequence, so
    it is bounded by the window."""
    def joined(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rows = []
            for parts, size in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), dtype="<u4").astype(np.int32)
                rows.append(np.pad(ids, (0, size - len(ids)), constant_values=pad_id))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))],
                                             ["sequence_id", "ids"])

    grouped = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.first("padded_tokens").alias("size"))
    return grouped.mapInArrow(joined, T.StructType([T.StructField("sequence_id", T.LongType()),
                                                    T.StructField("ids", T.ArrayType(T.IntegerType()))]))
