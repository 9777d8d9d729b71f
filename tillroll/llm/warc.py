"""Operator 12: WARC archives, written from pages and read back as captures.

``write`` turns each page into one transaction of three records: a request, a
response (or, where a larger page has the same payload, a revisit that names its
response) and a metadata record.  The request and the metadata name the response by
``WARC-Concurrent-To``.  Files go out through Spark's text sink, gzipped, so a lost
executor's task is written anew and readers never see half a file.

``records`` reads archives of any writer, in any store that Spark reads.  The text
source cuts them at ``WARC/1.``; each piece is held against its Content-Length, and a
piece that a payload's own text has cut too early is joined with the next ones.
Compressed files are read from their start by one task each, piece by piece; pieces
of plain files, which Spark splits, are first sorted back into their files.

``captures`` assembles transactions: requests and metadata are joined to their
response through the concurrent-to identifiers, whichever side names the other,
and one nested row for each capture comes out, with the columns that the records have.

Defined cases: null html is an empty payload; a null or unprintable url is written
percent-encoded or left out; null page ids are kept and smaller than all others; of
repeated rows one is the response, the others revisit it; payloads may be of any
length and hold WARC headers of their own; a record cut off at the end of its file
comes out with what is there and ``intact`` false; records whose response is missing
give a row without one; an empty table gives an empty archive and result; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._stage import kept_path, staged, table

MARK = b"WARC/1."
EOL = b"\r\n"
#: Names of this writer's records are hashes in this namespace.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record")
SAME_PAYLOAD = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
#: Keys that hold a thousandth of the rows or more are joined by broadcast: a thousand at most.
HOT_SHARE = 1000
#: Bytes of payload in one Arrow batch, a longer record alone.
BATCH_BYTES = 4 << 20
RECORD = ("type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
          "profile string, head string, payload binary, payload_bytes long, payload_digest string, intact boolean")


def join_hot(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on ``key``, unique in ``right``, where any key may hold a large share of ``left``."""
    counts = staged(left.groupBy(key).count(), "key-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("count") * HOT_SHARE >= total).select(key))
    few = F.broadcast(right.join(hot, key, "left_semi"))
    return left.join(hot, key, "left_semi").join(few, key, "left").unionByName(
        left.join(hot, key, "left_anti").join(right, key, "left"))


# ------------------------------------------------------------------ writing
def marked(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, a row number ``rid`` and ``refers``: the ``rid`` of the row with the
    same payload of at least ``least_bytes`` and the largest page_id, null for that row itself."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = staged(pages.select("page_id", "url", payload.alias("payload"), F.monotonically_increasing_id().alias("rid")), "warc-pages")
    small = staged(rows.where(F.octet_length("payload") >= least_bytes).select(
        "rid", "page_id", F.concat(F.sha1("payload"), F.octet_length("payload").cast("string")).alias("same")), "warc-payloads")
    best = small.groupBy("same").agg(F.max(F.struct("page_id", "rid"))["rid"].alias("refers"), F.count("*").alias("c"))
    marks = staged(join_hot(small.select("rid", "same"), best.where("c > 1").drop("c"), "same")
                   .where("refers <> rid").select("rid", "refers"), "warc-revisits")
    return rows.join(marks, "rid", "left")


def name_of(kind: str, rid: int) -> bytes:
    return b"<urn:uuid:%s>" % str(uuid.uuid5(NAMESPACE, f"{kind}:{rid}")).encode()


def sha1(data: bytes) -> bytes:
    return base64.b32encode(hashlib.sha1(data).digest())


def record(kind: bytes, name: bytes, date: bytes, fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    """One record without its last line end."""
    fields = [(b"WARC-Type", kind), (b"WARC-Record-ID", name), (b"WARC-Date", date), *fields,
              (b"WARC-Block-Digest", b"sha1:" + sha1(block)), (b"Content-Length", b"%d" % len(block))]
    return MARK + b"1" + EOL + b"".join(k + b": " + v + EOL for k, v in fields) + EOL + block + EOL


def transaction(page_id: int | None, url: str | None, payload: bytes, rid: int, refers: int | None, date: bytes) -> bytes:
    """The three records of a page; a revisit has its response's HTTP head alone."""
    uri = urllib.parse.quote(url or "", safe="!#$%&'()*+,/:;=?@[]~").encode()
    parts = urllib.parse.urlsplit(uri)
    target = [(b"WARC-Target-URI", uri)] if uri else []
    answer, http = name_of("response", rid), b"application/http;msgtype="
    asked = b"GET %s HTTP/1.1\r\nHost: %s\r\n\r\n" % (urllib.parse.urlunsplit((b"", b"", parts.path or b"/", parts.query, b"")), parts.netloc)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    digest = (b"WARC-Payload-Digest", b"sha1:" + sha1(payload))
    known = b"" if page_id is None else b"page-id: %d\r\n" % page_id
    ours = [*target, (b"WARC-Concurrent-To", answer)]
    answered = [*target, (b"Content-Type", http + b"response"), digest]
    if refers is None:
        main = record(b"response", answer, date, answered, head + payload)
    else:
        main = record(b"revisit", answer, date, [*answered, (b"WARC-Profile", SAME_PAYLOAD.encode()),
                                                 (b"WARC-Refers-To", name_of("response", refers))], head)
    return EOL.join([record(b"request", name_of("request", rid), date, [*ours, (b"Content-Type", http + b"request")], asked), main,
                     record(b"metadata", name_of("metadata", rid), date, [*ours, (b"Content-Type", b"application/warc-fields")], known)])


def write(rows: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", pages_a_file: int = 100_000) -> None:
    """Archive ``marked`` rows as gzipped WARC 1.1 files under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for i in range(len(batch)):
                page_id, url, payload, rid, refers = (c[i].as_py() for c in batch.columns)
                out.append(transaction(page_id, url, payload, rid, refers, date.encode()))
                size += len(out[-1])
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.large_binary()).cast(pa.binary())], names=["records"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["records"])

    text = rows.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "payload", "rid", "refers").mapInArrow(run, "records binary")
    # the sink ends each row by the line end that a transaction's last record lacks
    text.select(F.col("records").cast("string").alias("value")).write.option("lineSep", "\r\n").option(
        "compression", "gzip").option("maxRecordsPerFile", pages_a_file).text(path)


# ------------------------------------------------------------------ reading
def measured(piece: bytes) -> tuple[dict[str, list[str]], int, int] | None:
    """(header fields, start of the block, length of the block), None where the header has no end yet."""
    end = piece.find(EOL + EOL)
    if end < 0:
        return None
    fields: dict[str, list[str]] = {}
    last = None
    for line in piece[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and last:  # a folded line goes on with the last field
            fields[last][-1] = f"{fields[last][-1]} {line.strip()}".strip()
        elif colon:
            last = key.strip().lower()
            fields.setdefault(last, []).append(value.strip())
    length = (fields.get("content-length") or ["0"])[0]
    return fields, end + 4, int(length) if length.isdigit() else 0


def parsed(piece: bytes, fields: dict[str, list[str]], start: int, length: int) -> tuple:
    """The columns of ``RECORD``; HTTP blocks are cut into head and payload."""
    one = lambda k: (fields.get(k) or [None])[0]
    block, kind = piece[start:start + length], one("warc-type")
    head, payload = b"", block
    if (one("content-type") or "").startswith("application/http"):
        cut = block.find(EOL + EOL)
        cut = len(block) if cut < 0 else cut + 4
        head, payload = block[:cut], block[cut:]
    elif kind in ("metadata", "warcinfo"):
        head, payload = block, b""
    declared = (one("warc-payload-digest") or "").rpartition(":")[2].upper() or None
    size, digest, intact = len(payload), sha1(payload).decode(), len(block) == length
    if kind == "revisit":  # its payload is elsewhere: size and digest are those stated
        stated = [line.partition(b":")[2].strip() for line in head.split(EOL) if line.lower().startswith(b"content-length:")]
        size, digest = int(stated[0]) if stated and stated[0].isdigit() else None, declared
    elif declared is not None:
        intact &= declared == digest
    return (kind, one("warc-record-id"), fields.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-target-uri"),
            one("warc-date"), one("warc-profile"), head.decode("utf-8", "replace"), payload, size, digest, intact)


def whole_records(pieces: Iterator[tuple[str, bytes]]) -> Iterator[tuple]:
    """Records of (path, piece) in the order of their files."""
    held: list[bytes] = []
    size, need, told, of = 0, None, None, None

    def ended():
        piece = MARK.join(held)
        got = told or measured(piece)
        return parsed(piece, *got) if got else None

    for path, piece in pieces:
        if held and path != of:  # cut off at its file's end
            if last := ended():
                yield last
            held, size, need, told = [], 0, None, None
        of = path
        if not held and piece[:3] not in (b"0\r\n", b"1\r\n"):
            continue  # before the first record, or no record's version line
        held.append(piece)
        size += len(piece) + (len(MARK) if len(held) > 1 else 0)
        if told is None:
            told = measured(piece if len(held) == 1 else MARK.join(held))
            need = told[1] + told[2] if told else None
        if need is not None and size >= need:
            yield parsed(MARK.join(held), *told)
            held, size, need, told = [], 0, None, None
    if held and (last := ended()):
        yield last


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the WARC files under ``path`` (``RECORD``)."""
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 5, pa.binary(), pa.int64(), pa.string(), pa.bool_()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        pieces = ((b.column(0)[i].as_py(), b.column(1)[i].as_py()) for b in batches for i in range(len(b)))
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)
        for row in whole_records(pieces):
            found.append(row)
            size += len(row[8]) + 1000
            if size > BATCH_BYTES:
                yield pack(found)
                found, size = [], 0
        if found:
            yield pack(found)

    source = spark.read.option("lineSep", MARK.decode()).text(path)
    plain = any(not f.endswith(".gz") for f in source.inputFiles())
    place = ["_metadata.file_path", "_metadata.file_block_start"] if plain else ["_metadata.file_path"]
    pieces = source.select(*place, F.col("value").cast("binary").alias("piece"))
    if plain:  # splits of one file go back together, in order
        pieces = pieces.withColumn("at", F.monotonically_increasing_id()).repartition("file_path").sortWithinPartitions(
            "file_path", "file_block_start", "at")
    return pieces.select("file_path", "piece").mapInArrow(run, RECORD)


def captures(found: DataFrame) -> DataFrame:
    """One row for each transaction: ``capture`` (the response, revisit or resource record, null
    if missing), ``requests`` and ``metadata`` (by record id), each with the columns of ``found``,
    which is read several times: give it as a written table."""
    whole = F.struct(*found.columns).alias("one")
    answers = found.where(F.col("type").isin("response", "revisit", "resource")).select(F.col("record_id").alias("key"), whole)
    others = found.where(F.col("type").isin("request", "metadata"))
    named = answers.select(F.explode("one.concurrent_to").alias("record_id"), F.col("key").alias("by")).groupBy("record_id").agg(
        F.min("by").alias("by"))
    asked = others.join(named, "record_id", "left").select(
        F.coalesce("by", F.get("concurrent_to", F.lit(0)), "record_id").alias("to"), whole)
    # metadata may name the request, which names the response
    via = asked.where("one.type = 'request'").select(F.col("one.record_id").alias("to"), F.col("to").alias("on"))
    via = via.where(F.col("to") != F.col("on")).groupBy("to").agg(F.min("on").alias("on"))
    members = asked.join(via, "to", "left").select(F.coalesce("on", "to").alias("key"), "one").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("one.record_id", "one"))).alias("all"))
    of = lambda kind: F.transform(F.filter("all", lambda m: m["one"]["type"] == kind), lambda m: m["one"])
    return answers.join(members, "key", "full").select(F.col("one").alias("capture"), of("request").alias("requests"),
                                                       of("metadata").alias("metadata"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = kept_path(spark, "warc")
    write(marked(table(spark, sf_dir, "pages")), path)
    found = staged(records(spark, path).drop("payload", "date", "profile", "target_uri"), "warc-records")  # read once
    made = staged(captures(found), "warc-captures")
    page_id = F.regexp_extract(F.get("metadata", F.lit(0))["head"], r"(?m)^page-id: (-?\d+)", 1)
    rows = made.select("capture.record_id", F.when(page_id != "", page_id.cast("long")).alias("page_id"), "capture.payload_bytes",
                       "capture.payload_digest", F.col("capture.type").alias("record_type"), "capture.refers_to")
    answers = rows.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("refers"))
    again = join_hot(rows.where("record_type = 'revisit'"), answers, "refers_to")
    plain = rows.where("record_type = 'response'").withColumn("refers", F.lit(None).cast("long"))
    return plain.unionByName(again).select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers").alias("refers_to"))


SQL = r"""
WITH told AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
spelt AS (
    SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
        (CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS INT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
        max(page_id) OVER (PARTITION BY hex, payload_bytes) AS best FROM told)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> best THEN best END AS refers_to FROM spelt
"""

QUERIES = {"op12_warc": op12_warc}
ORACLES = {"op12_warc": SQL}
