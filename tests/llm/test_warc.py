"""WARC archives: round trips, segment reassembly, damaged input, and the query against its SQL."""

import base64
import glob
import gzip
import hashlib
import os
import random

import pytest

from candlewick.llm import warc as W
from fixtures_llm import agrees, tables  # noqa: F401

PAGES = "page_id long, url string, html string"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def some_pages():
    rng = random.Random(4)
    alphabet = "ab <é😀\r\n\x00WARC/1.1"
    rows = [(i, f"https://h{i % 5}.org/{i}", "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300)))) for i in range(120)]
    rows += [(200 + i, "https://c.org/", rows[3][2]) for i in range(60)] + [(300, None, None), (301, "no url", ""), (302, "x\r\nInjected: 1", "")]
    rows += [(400, "https://long.org", "é\r\n\r\nlong " * 40_000), (401, "https://long.org", "é\r\n\r\nlong " * 40_000), (-5, "u", rows[7][2])]
    rng.shuffle(rows)
    return rows


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= least:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = i is not None and data in first and first[data] < i
        out.append((i, len(data), digest(data), "revisit" if again else "response", first[data] if again else None, "ok"))
    return sorted(out, key=repr)


def found(df):
    rows = df.filter("warc_type <> 'warcinfo'").select("page_id", "payload_bytes", "payload_digest", "warc_type", "refers_to_page", "status")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("segment,chunk,least", [(64 << 10, 16 << 10, 0), (37, 5, 10), (400, 1 << 20, 1 << 30)])
def test_round_trip(spark, tmp_path, segment, chunk, least):
    rows = [r for r in some_pages() if segment > 1_000 or r[0] < 390]
    W.write_warc(spark.createDataFrame(rows, PAGES).repartition(3), f"{tmp_path}/w", segment_bytes=segment, chunk_bytes=chunk,
                 min_revisit_bytes=least)
    back = W.read_warc(spark, f"{tmp_path}/w")
    assert found(back) == expected(rows, least)
    texts = {r["page_id"]: r["payload"] for r in back.filter("warc_type = 'response'").collect()}
    given = {i: (html or "").encode() for i, _, html in rows}
    assert all(bytes(p) == given[i] for i, p in texts.items())
    if segment < 1_000:
        assert back.filter("segments > 1").count() > 20
    assert back.filter("warc_type = 'warcinfo'").count() > 0


def test_query_equals_its_sql(agrees, tables):
    got = agrees("op11_warc", tables(pages=some_pages()), "pages")
    assert sorted((tuple(r) for r in got), key=repr) == expected(some_pages())


def archive(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}.warc.gz", "wb") as f:
        f.write(b"".join(r + W.END for r in records))


def page(key, number, text, segment=30):
    return list(W.page_records(key * 32, number, "u", text, digest(text), None, None, date="d", segment_bytes=segment, chunk_bytes=7))


def test_segments_in_any_order_and_archive(spark, tmp_path):
    text = "Straße\r\n\r\nWARC/1.1 ".encode() * 40
    parts = page("a", 1, text)
    other = page("b", 2, text[::-1])
    rng = random.Random(1)
    mixed = parts + other + [parts[3]]  # a copy of one segment
    rng.shuffle(mixed)
    for i in range(3):
        archive(f"{tmp_path}/w", i, mixed[i::3])
    rows = {r["page_id"]: r for r in W.read_warc(spark, f"{tmp_path}/w").collect()}
    assert {i: bytes(r["payload"]) for i, r in rows.items()} == {1: text, 2: text[::-1]}
    assert all(r["status"] == "ok" and r["segments"] == len(parts) for r in rows.values())


def test_what_is_wrong_is_said(spark, tmp_path):
    text = b"0123456789" * 30
    lost, short, long, flipped, framing, wrong = (page(k, i, text) for i, k in enumerate("abcdef", 1))
    del lost[4]
    short.pop()
    long[-1] = long[-1].replace(b"WARC-Segment-Total-Length: ", b"WARC-Segment-Total-Length: 9")
    flipped[2] = flipped[2][:-1] + b"~"
    framing = W.record([("WARC-Type", "response"), ("WARC-Record-ID", "<e>"), (W.PAGE_FIELD, 5)], W.HTTP_HEAD + b"5\r\nab\r\n0\r\n\r\n")
    wrong = page("f", 6, text, 10_000)[0].replace(digest(text).encode(), digest(b"").encode(), 1)
    revisit = list(W.page_records("9" * 32, 7, "u", b"", digest(text), "8" * 32, None, date="d", segment_bytes=99, chunk_bytes=9))
    good = page("c", 8, b"fine", 10_000)
    cut = page("d", 9, text, 10_000)[0]
    lying = good[0].replace(b"Content-Length: ", b"Content-Length: 1").replace(b"X-Page-Id: 8", b"X-Page-Id: 10")
    archive(f"{tmp_path}/w", "one", [*lost, *short, b"noise", *long, *flipped, framing, b"\r\n\r\nmore noise\r\n", wrong, *revisit, *good])
    archive(f"{tmp_path}/w", "two", [lying, *page("7", 11, b"after", 10_000), cut[:-20]])
    rows = W.read_warc(spark, f"{tmp_path}/w").collect()
    said = {r["page_id"]: r["status"] for r in rows}
    assert said == {1: "missing segment", 2: "missing segment", 3: "wrong total length", 4: "damaged block", 5: "broken framing",
                    6: "wrong digest", 7: "missing original", 8: "ok", 9: "wrong length", 10: "wrong length", 11: "ok"}


def test_records_over_the_limit_are_passed_over(spark, tmp_path):
    archive(f"{tmp_path}/w", "x", [*page("a", 1, b"x" * 5_000, 100_000), *page("b", 2, b"y", 100_000)])
    assert [r["page_id"] for r in W.read_warc(spark, f"{tmp_path}/w", max_record_bytes=2_000).collect()] == [2]


def test_framing():
    for data in (b"", b"x", bytes(range(256)) * 9):
        for n in (1, 7, 10_000):
            assert W.unchunked(W.chunked(data, n)) == data
    assert W.unchunked(b"3;name=v\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc0123456789"
    for broken in (b"", b"3\r\nab\r\n0\r\n\r\n", b"x\r\n", b"3\r\nabc\r\n", b"2\r\nab\r\n0\r\n", b"-1\r\n\r\n0\r\n\r\n"):
        assert W.unchunked(broken) is None


def test_pieces_of_any_size_give_the_same_records():
    rng = random.Random(2)
    stream = b"".join(r + W.END for k in "abc" for r in page(k, 1, b"q\r\n\r\nr\r" * 50, 40))
    whole = [x for x in W.RecordReader(1 << 20).feed(stream)]
    assert len(whole) > 20 and all(ok for *_, ok in whole)
    for _ in range(20):
        reader, got, at = W.RecordReader(1 << 20), [], 0
        while at < len(stream):
            n = rng.randint(1, 90)
            got += reader.feed(stream[at:at + n])
            at += n
        assert got == whole and list(reader.close()) == []


def test_edges(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a", "x"), (1, "u", "a", "y"), (2, "u", "a", "z"), (None, "u", "a", "n"), (None, None, None, "n")],
                               "page_id long, url string, html string, digest string")
    W.write_warc(df, f"{tmp_path}/a")
    assert found(W.read_warc(spark, f"{tmp_path}/a")) == sorted(
        [(1, 1, digest(b"a"), "response", None, "ok")] * 2 + [(2, 1, digest(b"a"), "revisit", 1, "ok"),
         (None, 1, digest(b"a"), "response", None, "ok"), (None, 0, digest(b""), "response", None, "ok")], key=repr)
    W.write_warc(df, f"{tmp_path}/s", segment_bytes=20)  # copies of segmented records are as many as their first segments
    assert found(W.read_warc(spark, f"{tmp_path}/s")) == found(W.read_warc(spark, f"{tmp_path}/a"))
    W.write_warc(df.limit(0), f"{tmp_path}/e")
    assert W.read_warc(spark, f"{tmp_path}/e").collect() == []
    W.write_warc(df.selectExpr("page_id", "url", "CAST(x'00ff0d0a0d0a80' AS BINARY) AS html"), f"{tmp_path}/b", segment_bytes=25)
    got = W.read_warc(spark, f"{tmp_path}/b").filter("page_id = 1 AND warc_type = 'response'").first()
    assert bytes(got["payload"]) == b"\x00\xff\r\n\r\n\x80" and glob.glob(f"{tmp_path}/b/*.gz")
