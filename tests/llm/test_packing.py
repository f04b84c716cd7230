"""Packing against the tokenizer's own ids and a plain concatenation."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlewick.llm.packing import WordEncoder, pack, sequences, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")

TEXTS = ["Hello  World", None, "", "  ", "café café ́x", "a<|endoftext|>b <|startoftext|>", "it's we'll 42 3.14",
         "line\nbreak\r\ntab\tnbsp x y\x1cz", "ΣΑΣ İstanbul ß", "日本語 텍스트", "🙂🙂 !!! ...", "x" * 5000,
         "word " * 3000, "End. END, end., x.y ,z ... é. É, ñ., a's. ABC<|ENDOFTEXT|>", "ªº ŉ İx ẞ Ǆ e\u0301. ﬁ. Ω.",
         "tail.", "tail,\nnext. \n", "straße. STRASSE, Ünï."]


def plain(text):
    tok = tokenizers.Tokenizer.from_file(tokenizer_path())
    return [*tok.encode(text or "", add_special_tokens=False).ids, 2]


def test_word_encoder_equals_the_tokenizer():
    for keep, simple in ((400_000, True), (3, True), (400_000, False)):  # 3: the store starts anew all the time
        enc = WordEncoder(tokenizer_path(), 2, keep)
        assert enc.simple
        enc.simple = simple
        for _ in range(2):
            ids, counts = enc.encode(pa.array(TEXTS))
            parts = np.split(ids, np.cumsum(counts)[:-1])
            assert [p.tolist() for p in parts] == [plain(t) for t in TEXTS]
        for t in TEXTS:  # without the text that holds a special token in capitals
            assert enc.encode(pa.array([t]))[0].tolist() == plain(t)


@pytest.mark.parametrize("text", [
    "ab!!! cd?' x's) (é) #$& y-z_ ab'' f' s ß.\" q' s'' ñ's!", "don't! we'll? 'tis' 's's' x're. x're' . a .", "1st! 2nd. 3' 4's",
    "İ. İ!! x", "\u0958. \u0958!! x", "e\u0301. e\u0301!! x", "ΣΑΣ. Жук!? 日本. が!! か\u3099!! x", "a<\u0338 b.=\u0338 c. \u0301",
    "J\u030c x", "T\u0344 x", "T\u0323\u0308 x", "ªº. µ! ǅ, Ŀ. x"])
def test_stops_and_marks_as_the_tokenizer_has_them(text):
    enc = WordEncoder(tokenizer_path(), 2)
    assert enc.simple
    for t in (text, text + " ", text.upper() + "\n"):
        assert enc.encode(pa.array([t]))[0].tolist() == plain(t)


def test_words_are_encoded_once_while_the_store_has_room():
    enc, sent = WordEncoder(tokenizer_path(), 2, keep_words=100), []
    word = enc._word
    enc._word = lambda w: sent.append(w) or word(w)

    def encode(words):
        del sent[:]
        assert enc.encode(pa.array([" ".join(words)]))[0].tolist() == plain(" ".join(words))
        return set(sent)

    words = ["x" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(300)]
    assert encode(words[:60]) == set(words[:60])
    assert encode(words[:60]) == set()  # known words need no room
    assert encode(words[:20]) == set()
    assert encode(words[100:160]) == set(words[100:160])  # no room: the most used stay
    assert encode(words[:20] + words[100:110]) == set()
    assert encode(words[50:60]) == set(words[50:60])
    assert len(enc.index) <= 120
    assert encode([f"{w}!" for w in words[:20]]) == {"!", f"{words[19]}!"}  # parted from the stops after them, but for the text's last


@pytest.mark.parametrize("window,partitions", [(4096, 3), (16, 5), (7, 1)])
def test_every_id_lies_in_one_piece(spark, window, partitions):
    rows = [(i, t, "s", 1) for i, t in enumerate(TEXTS)] + [(3, "again", None, 2), (None, "no id", None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, part int").repartition(partitions)
    pieces = pack(df, sequence_tokens=window).withColumn("crc", F.crc32("ids")).collect()
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] * 4 == len(p["ids"]) and p["crc"] == zlib.crc32(p["ids"])
        by_seq[p["sequence_id"]].append(p)
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
    total = sum(p["length"] for p in pieces)
    assert sorted(by_seq) == list(range(-(-total // window)))
    for k, ps in by_seq.items():
        ps.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in ps] == list(np.cumsum([0] + [p["length"] for p in ps])[:-1])
        size = sum(p["length"] for p in ps)
        assert size == (window if k < len(by_seq) - 1 else total - window * (len(by_seq) - 1))
        assert {p["sequence_tokens"] for p in ps} == {size}
        assert {p["padded_tokens"] for p in ps} == {size if size & (size - 1) == 0 else window}
    want = sorted(plain(t) for _, t, _, _ in rows)
    got = []
    for ps in by_doc.values():
        ps.sort(key=lambda p: (p["sequence_id"], p["start"]))
        ids = np.frombuffer(b"".join(p["ids"] for p in ps), dtype="<u4").tolist()
        assert ps[0]["opens"] and ps[-1]["closes"]
        got.append(ids)
    assert sorted(got) == want
    full = {r["sequence_id"]: r["ids"] for r in sequences(spark.createDataFrame(pieces)).collect()}
    assert sum(map(len, full.values())) == sum(ps[0]["padded_tokens"] for ps in by_seq.values())


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
