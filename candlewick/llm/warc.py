"""WARC archives: writing pages, and reading records back with segment reassembly.

Writing: pages with equal payloads become one ``response`` and ``revisit`` records
that refer to it.  Payloads go into HTTP blocks in chunked transfer framing;
a block over ``segment_bytes`` becomes a first segment and ``continuation``
records.  Every task writes one gzip archive through Spark's text writer, whose line
separator is the record's end (two line ends), so any store that Spark can
write holds them.

Reading: every archive is one stream of bytes (gzip files are not split), cut into
records by their lengths.  Whole records are decoded where they are read.
Segments are grouped by the identifier of their origin record, ordered by segment
number, checked for gaps and against the total length, and put together; then
the chunked framing is decoded and the payload's digest compared with the header.
Revisits take length and digest from the record that they refer to.

A payload shared by many pages is a hot key twice: pages meet their payload's first
page, revisits their response.  Keys with at least one in ``HOT_SHARE`` rows are
at most ``HOT_SHARE`` keys; these are broadcast, the others are dealt out by key.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import prepared, shuffled, written

#: A key is hot from one in so many rows on, so there are at most so many hot keys.
HOT_SHARE = 1_000
END = b"\r\n\r\n"
PAGE_FIELD = "X-Page-Id"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END
_BATCH_BYTES = 8 << 20


# --- records as bytes -----------------------------------------------------------

def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(key: str) -> str:
    """A record identifier from 32 hexadecimal digits."""
    return f"<urn:uuid:{uuid.UUID(key)}>"


def chunked(payload: bytes, chunk_bytes: int) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for start in range(0, len(payload), chunk_bytes):
        piece = payload[start:start + chunk_bytes]
        parts += [b"%X\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes | None:
    """The payload of a body in chunked transfer framing, None if the framing is broken.
    Chunk extensions and trailer fields are passed over."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.fullmatch(rb"([0-9A-Fa-f]+)[ \t]*(;.*)?", body[at:end], re.DOTALL) if end >= 0 else None
        if not size:
            return None
        n, at = int(size[1], 16), end + 2
        if not n:
            return b"".join(parts) if body[at:at + 2] == b"\r\n" or body.find(END, at) >= 0 else None
        if body[at + n:at + n + 2] != b"\r\n":
            return None
        parts.append(body[at:at + n])
        at += n + 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line ends that close it."""
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields if value is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def _header_value(text: str | None) -> str | None:
    return None if text is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def page_records(key: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: str | None,
                 refers_uri: str | None, *, date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of a page: a response (in segments if it is long) or a revisit."""
    said = [("WARC-Record-ID", urn(key)), ("WARC-Date", date), ("WARC-Target-URI", _header_value(url)),
            ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"), (PAGE_FIELD, page_id)]
    if refers_to is not None:
        yield record([("WARC-Type", "revisit"), *said, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", urn(refers_to)),
                      ("WARC-Refers-To-Target-URI", _header_value(refers_uri))], HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    pieces = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [("WARC-Segment-Number", 1)] if len(pieces) > 1 else []
    yield record([("WARC-Type", "response"), *said, *first, ("WARC-Block-Digest", f"sha1:{base32_sha1(pieces[0])}")], pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        own = hashlib.md5(f"{key}/{number}".encode()).hexdigest()
        last = [("WARC-Segment-Total-Length", len(block))] if number == len(pieces) else []
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", urn(own)), ("WARC-Date", date),
                      ("WARC-Target-URI", _header_value(url)), ("WARC-Segment-Origin-ID", urn(key)),
                      ("WARC-Segment-Number", number), *last, ("WARC-Block-Digest", f"sha1:{base32_sha1(piece)}")], piece)


class RecordReader:
    """Records of one archive from its bytes, fed in any pieces.

    Yields ``(fields, block, whole)``; field names are in lower case, ``whole`` is
    false if the record does not end where its length says, or the archive
    ends within it.  Bytes that belong to no record are passed over up to the next one."""

    def __init__(self, max_record_bytes: int):
        self.buffer, self.fields, self.need, self.limit = bytearray(), None, 0, max_record_bytes

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
        self.buffer += data
        while True:
            if self.fields is None:
                end = self.buffer.find(END)
                if end < 0:
                    return
                head = bytes(self.buffer[:end])
                del self.buffer[:end + 4]
                self._head(head)
                if self.fields is None:
                    continue
            if len(self.buffer) < self.need + 4:
                return
            fields, self.fields = self.fields, None
            if self.buffer[self.need:self.need + 4] == END:
                block = bytes(self.buffer[:self.need])
                del self.buffer[:self.need + 4]
                yield fields, block, True
            else:  # its length is wrong: go on at the next record
                yield fields, b"", False

    def _head(self, head: bytes) -> None:
        start = head.find(b"WARC/1.")
        if start < 0 or (start and head[start - 1:start] != b"\n"):
            return
        fields = {}
        for line in head[start:].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        length = fields.get("content-length", "")
        if re.fullmatch("[0-9]{1,18}", length) and int(length) <= self.limit:
            self.fields, self.need = fields, int(length)

    def close(self) -> Iterator[tuple[dict[str, str], bytes, bool]]:
        if self.fields is not None:
            yield self.fields, b"", False
        self.buffer, self.fields = bytearray(), None


def http_payload(block: bytes) -> bytes | None:
    """The decoded body of an HTTP response block, None if it cannot be decoded."""
    head, mark, body = block.partition(END)
    if not mark:
        return None
    coded = re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head)
    return unchunked(body) if coded else body


def _bare_digest(value: str | None) -> str | None:
    return None if value is None else value.rpartition(":")[2].upper()


def _decoded(block: bytes, declared: str | None) -> tuple[bytes | None, str]:
    payload = http_payload(block)
    if payload is None:
        return None, "broken framing"
    return payload, "ok" if declared in (None, base32_sha1(payload)) else "wrong digest"


# --- joins with hot keys ----------------------------------------------------------

def share_join(rows: DataFrame, table: DataFrame, hot: DataFrame, key: str, spread: Column) -> DataFrame:
    """``rows`` left joined to ``table`` (one row per ``key``): the at most ``HOT_SHARE`` rows of
    it in ``hot`` by broadcast, the others by key.  Rows of hot keys are spread by
    ``spread``, a string that is no key."""
    values = [c for c in table.columns if c != key]
    first = rows.join(F.broadcast(hot.select(key, F.struct(*values).alias("_hot"))), key, "left")
    first = first.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(spread))
    other = shuffled(table.select(F.col(key).alias("_key"), F.struct(*values).alias("_cold")))
    both = first.join(other, "_key", "left").withColumn("_found", F.coalesce("_hot", "_cold"))
    return both.select(*rows.columns, *(F.col(f"_found.{c}").alias(c) for c in values))


# --- writing ------------------------------------------------------------------------

def write_warc(pages: DataFrame, folder: str, *, min_revisit_bytes: int = 0, segment_bytes: int = 64 << 10,
               chunk_bytes: int = 16 << 10, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html") -> None:
    """Write a record per row of ``pages`` as gzip archives into a new ``folder``.

    The payload is ``payload_col`` in UTF-8 (or its bytes, if binary).  Of rows with equal
    payloads of at least ``min_revisit_bytes`` those with the smallest id are
    responses, the others revisits that refer to it.  NULL payloads are empty;
    rows with a NULL id are responses and nothing refers to them; repeated rows
    are written as often as they occur, under one identifier; control characters and
    blanks of a URL are percent-encoded; other columns are not read.  An
    empty table gives a folder without records.  A page is written by one task, in
    memory of a few times its own length."""
    spark = prepared(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    named = rows.filter(F.col("page_id").isNotNull() & (F.octet_length("payload") >= min_revisit_bytes))
    shared = written(named.groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n"))
                     .filter("n > 1").select("digest", F.col("first.page_id").alias("first_page"),
                                             F.col("first.url").alias("first_url"), "n"), "payloads")
    least = pages.count() / HOT_SHARE
    met = share_join(rows, shared, shared.filter(F.col("n") >= least), "digest", F.hex(F.xxhash64("page_id", "url")))
    again = F.coalesce(F.col("page_id") > F.col("first_page"), F.lit(False))

    def key(page: str, url: str) -> Column:
        return F.md5(F.concat_ws("|", F.coalesce(F.col(page).cast("string"), F.lit("-")),
                                 F.coalesce(F.col(url), F.lit("\x00")), "digest").cast("binary"))

    told = met.select(key("page_id", "url").alias("key"), "page_id", "url", F.when(~again, F.col("payload")).alias("payload"),
                      "digest", F.when(again, key("first_page", "first_url")).alias("refers_to"),
                      F.when(again, F.col("first_url")).alias("refers_uri"))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        about = b"software: candlewick\r\nformat: WARC File Format 1.1\r\n"
        out = [record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", urn(uuid.uuid4().hex)), ("WARC-Date", date),
                       ("Content-Type", "application/warc-fields")], about)]
        size, begun = 0, False
        for batch in stream:
            for row in zip(*batch.columns):
                name, page, url, body, digest, refers, uri = (v.as_py() for v in row)
                begun = True
                for one in page_records(name, page, url, body or b"", base64.b32encode(bytes.fromhex(digest)).decode(), refers, uri,
                                        date=date, segment_bytes=segment_bytes, chunk_bytes=chunk_bytes):
                    out.append(one)
                    size += len(one)
                if size > _BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
        if begun and out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    made = told.mapInArrow(batches, "record binary").select(F.col("record").cast("string").alias("value"))
    made.write.option("lineSep", END.decode()).option("compression", "gzip").text(folder)


# --- reading ------------------------------------------------------------------------

_PARSED = {"record_id": pa.string(), "warc_type": pa.string(), "target_uri": pa.string(), "page_id": pa.int64(),
           "refers_to": pa.string(), "declared": pa.string(), "origin": pa.string(), "number": pa.int32(), "total": pa.int64(),
           "block": pa.binary(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
           "status": pa.string()}
_SPARK = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
_SCHEMA = ", ".join(f"{c} {_SPARK[t]}" for c, t in _PARSED.items())


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch("-?[0-9]{1,18}", text) else None


def _parsed(fields: dict[str, str], block: bytes, whole: bool, payloads: bool) -> dict:
    kind, name = fields.get("warc-type", ""), fields.get("warc-record-id")
    declared, number = _bare_digest(fields.get("warc-payload-digest")), _number(fields.get("warc-segment-number"))
    row = {"record_id": name, "warc_type": kind, "target_uri": fields.get("warc-target-uri"),
           "page_id": _number(fields.get(PAGE_FIELD.lower())), "refers_to": fields.get("warc-refers-to"), "declared": declared}
    proof = _bare_digest(fields.get("warc-block-digest"))
    if not whole:
        row["status"] = "wrong length"
    elif proof is not None and proof != base32_sha1(block):
        row["status"] = "damaged block"
    else:
        row["status"] = "ok"
    if number is not None:
        row |= {"origin": fields.get("warc-segment-origin-id", name), "number": number, "block": block,
                "total": _number(fields.get("warc-segment-total-length"))}
    elif row["status"] == "ok" and kind != "revisit":
        payload = block
        if kind == "response":
            payload, row["status"] = _decoded(block, declared)
        if payload is not None:
            row |= {"payload_bytes": len(payload), "payload_digest": base32_sha1(payload)}
            if payloads:
                row["payload"] = payload
    return row


def _rows(out: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in out], t) for c, t in _PARSED.items()], list(_PARSED))


def _put_together(rows: DataFrame, payloads: bool) -> DataFrame:
    """Segments of one origin as whole records; copies of a segment count once."""
    head = F.struct("block", "total", "warc_type", "target_uri", "page_id", "declared", "status")
    once = rows.groupBy("origin", "number").agg(F.min(head).alias("s"), F.count("*").alias("n"))
    groups = once.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "s.*"))).alias("parts"),
        F.coalesce(F.max(F.when(F.col("number") == 1, F.col("n"))), F.lit(1)).alias("copies"))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for i in range(len(batch)):
                origin, parts, copies = (batch.column(c)[i].as_py() for c in range(3))
                first = parts[0] if parts[0]["number"] == 1 else {}
                out = {"record_id": origin, "warc_type": first.get("warc_type"), "target_uri": first.get("target_uri"),
                       "page_id": first.get("page_id"), "declared": first.get("declared"), "number": len(parts)}
                totals = [p["total"] for p in parts if p["total"] is not None]
                bad = [p["status"] for p in parts if p["status"] != "ok"]
                if [p["number"] for p in parts] != list(range(1, len(parts) + 1)) or not totals:
                    out["status"] = "missing segment"
                elif bad:
                    out["status"] = bad[0]
                elif parts[-1]["total"] is None or any(t != sum(len(p["block"]) for p in parts) for t in totals):
                    out["status"] = "wrong total length"
                else:
                    block = b"".join(p["block"] for p in parts)
                    payload, out["status"] = (_decoded(block, first["declared"]) if first["warc_type"] == "response" else (block, "ok"))
                    if payload is not None:
                        out |= {"payload_bytes": len(payload), "payload_digest": base32_sha1(payload)}
                        if payloads:
                            out["payload"] = payload
                yield _rows([out] * copies)

    return groups.mapInArrow(batches, _SCHEMA)


def read_warc(spark: SparkSession, folder: str, *, payloads: bool = True, max_record_bytes: int = 256 << 20) -> DataFrame:
    """``(record_id, warc_type, target_uri, page_id, refers_to, refers_to_page, payload, payload_bytes, payload_digest,
    segments, status)`` of every record of the gzip archives in ``folder``.

    ``payload`` is the decoded body of a response or the block of other records
    (NULL for revisits, and for all without ``payloads``); length and digest of a
    revisit are those of the record that it refers to.  ``status`` is ``ok`` or what is
    wrong: ``wrong length``, ``damaged block``, ``missing segment``, ``wrong total length``,
    ``broken framing``, ``wrong digest``, ``missing original``.  Of a record that is not ok the
    payload's columns may be NULL.  Records with one identifier are copies of
    each other.  Bytes between records and records over ``max_record_bytes`` are
    passed over.  An empty folder gives an empty result.  One record is decoded in one task,
    in memory of a few times its own length; archives are read when this is called."""
    prepared(spark)
    raw = (spark.read.schema("value string").option("lineSep", END.decode()).option("pathGlobFilter", "*.gz").text(folder)
           .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, last, out, size = RecordReader(max_record_bytes), None, [], 0
        for batch in stream:
            files = batch.column(0).dictionary_encode()
            names = files.dictionary.to_pylist()
            for file, value in zip(files.indices.to_pylist(), batch.column(1)):
                found = []
                if names[file] != last:
                    found += reader.close()
                    last = names[file]
                found += reader.feed(value.as_py() + END)
                for fields, block, whole in found:
                    out.append(_parsed(fields, block, whole, payloads))
                    size += len(block) + 500
                if size > _BATCH_BYTES:
                    yield _rows(out)
                    out, size = [], 0
        out += [_parsed(*found, payloads) for found in reader.close()]
        if out:
            yield _rows(out)

    parsed = written(raw.mapInArrow(batches, _SCHEMA), "records")
    together = written(_put_together(parsed.filter("number IS NOT NULL"), payloads), "joined-segments")
    whole = parsed.filter("number IS NULL AND warc_type <> 'revisit'").unionByName(together)
    revisits = parsed.filter("number IS NULL AND warc_type = 'revisit'")
    known = whole.filter("status = 'ok'").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min(F.struct("page_id", "payload_bytes", "payload_digest")).alias("r"))
    originals = known.select("refers_to", F.col("r.page_id").alias("refers_to_page"), F.col("r.payload_bytes").alias("full_bytes"),
                             F.col("r.payload_digest").alias("full_digest"))
    # one row per identifier that many revisits name: at most HOT_SHARE
    asked = revisits.filter("refers_to IS NOT NULL").groupBy("refers_to").count()
    often = [r["refers_to"] for r in asked.filter(F.col("count") >= max(2.0, revisits.count() / HOT_SHARE))
             .select("refers_to").collect()]
    hot = originals.filter(F.col("refers_to").isin(often)) if often else originals.limit(0)
    met = share_join(revisits, originals, hot, "refers_to", F.col("record_id"))
    right = F.coalesce(F.col("declared") == F.col("full_digest"), F.col("full_digest").isNotNull())
    status = (F.when(F.col("status") != "ok", F.col("status")).when(F.col("full_digest").isNull(), "missing original")
              .when(~right, "wrong digest").otherwise("ok"))
    full = met.withColumn("status", status).withColumn("payload_bytes", F.col("full_bytes")).withColumn(
        "payload_digest", F.col("full_digest"))
    columns = ["record_id", "warc_type", "target_uri", "page_id", "refers_to", "refers_to_page", "payload", "payload_bytes",
               "payload_digest", F.coalesce("number", F.lit(1)).alias("segments"), "status"]
    return whole.withColumn("refers_to_page", F.lit(None).cast("long")).select(*columns).unionByName(full.select(*columns))
