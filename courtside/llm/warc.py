"""WARC archives: writing with revisits and segments, and segment reassembly on reading.

A page becomes a `response` record whose block is an HTTP message with a chunked body. Of pages with
equal payloads of at least `revisit_bytes` bytes, the one with the largest id is written so, the others as `revisit`
records that refer to it and have no payload. A block longer than `segment_bytes` is cut: the first segment is the
response record, the rest are `continuation` records with the origin's id and a segment number, the last one with the total
length. A record ends with two line breaks, which is the line separator that Spark's text writer is given; so the archives
(gzip) can go to any store that Spark writes to.

The reader parses archives by Content-Length. Whole records are decoded where they are read; segments are dealt
by origin id, ordered by number and checked against the total length, then the chunked framing is decoded.
Records that lack a segment or contradict their length or digest are returned with `intact` false and no payload size.

Null html is an empty payload. A null page id counts as smaller than any other. Rows that repeat id, url and payload
are records with the same id: their segments are taken once, and as many rows are returned as there
were first segments. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.tables import ship, spread, staged, table
from courtside.session import scratch_folder

REVISIT_BYTES = 1000
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
RECORDS_A_FILE = 20_000
ENDS = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Any time will do, as pages have none; a fixed one keeps the archives the same from run to run.
DATE = "2000-01-01T00:00:00Z"

RECORD = pa.schema(
    [
        ("record", pa.string()), ("kind", pa.string()), ("page_id", pa.int64()), ("origin", pa.string()), ("segment", pa.int64()),
        ("total", pa.int64()), ("digest", pa.string()), ("refers", pa.string()), ("uri", pa.string()), ("block", pa.binary()),
    ]
)
RECORD_DDL = (
    "record string, kind string, page_id long, origin string, segment long, total long, digest string, refers string, "
    "uri string, block binary"
)


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    cuts = (payload[k : k + size] for k in range(0, len(payload), size))
    return b"".join([*(b"%x\r\n%s\r\n" % (len(c), c) for c in cuts), b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of chunked framing; extensions and trailers are skipped, broken framing raises ValueError."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("a chunk has no size")
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        at = line + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than its size")
        out.append(body[line + 2 : at])
        at += 2


def http_payload(block: bytes) -> bytes:
    head, found, body = block.partition(ENDS)
    if not found:
        raise ValueError("an HTTP message has no body")
    fields = dict(line.partition(b":")[::2] for line in head.lower().split(b"\r\n")[1:])
    return unchunked(body) if fields.get(b"transfer-encoding", b"").strip() == b"chunked" else body


def record(fields: dict[str, object], block: bytes) -> bytes:
    """A record without the two line breaks that end it; fields without a value are left out."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + ENDS + block


def segments(fields: dict[str, object], block: bytes, size: int) -> Iterator[bytes]:
    """The record, or its first segment and the continuations."""
    cuts = [block[k : k + size] for k in range(0, len(block), size)] or [b""]
    if len(cuts) == 1:
        yield record(fields, block)
        return
    yield record(fields | {"WARC-Segment-Number": 1}, cuts[0])
    origin = fields["WARC-Record-ID"]
    for number, part in enumerate(cuts[1:], 2):
        more = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"{str(origin)[:-1]}:{number}>",
            "WARC-Date": DATE,
            "WARC-Target-URI": fields["WARC-Target-URI"],
            "WARC-Segment-Origin-ID": origin,
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if number == len(cuts) else None,
        }
        yield record(more, part)


def records(content: bytes) -> Iterator[dict[str, object]]:
    """The records of an archive, with the columns of RECORD."""
    at = 0
    while at < len(content):
        stop = content.index(ENDS, at)
        first, *lines = content[at:stop].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start, size = stop + 4, int(fields["content-length"])
        at = start + size + 4
        page = fields.get("warc-segment-origin-id", fields["warc-record-id"]).strip("<>").split(":")[3]
        yield {
            "record": fields["warc-record-id"],
            "kind": fields["warc-type"],
            "page_id": int(page) if page != "null" else None,
            "origin": fields.get("warc-segment-origin-id", fields["warc-record-id"]),
            "segment": int(fields.get("warc-segment-number", 0)),
            "total": int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None,
            "digest": fields.get("warc-payload-digest"),
            "refers": fields.get("warc-refers-to"),
            "uri": fields.get("warc-target-uri"),
            "block": content[start : start + size],
        }


def _label(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def _hex(label: str | None) -> str | None:
    return base64.b32decode(label.removeprefix("sha1:")).hex() if label else None


def write(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Writes the archives. Only digests and ids are aggregated; payloads move once, to the row of their digest."""
    ship(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "[\\x00-\\x20]+", "%20").alias("url"),
        F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    name = F.concat(
        F.lit("<urn:courtside:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(":"),
        F.sha1(F.concat_ws(" ", "digest", "url")), F.lit(">"),
    )
    rows = rows.withColumn("name", name)
    originals = (
        rows.where(F.octet_length("payload") >= revisit_bytes).groupBy("digest")
        .agg(F.max(F.struct("page_id", "name")).alias("first"), F.count("*").alias("n")).where("n > 1")
        .select("digest", "first")
    )
    rows = rows.join(originals, "digest", "left").select(
        "page_id", "url", "digest", "name", F.when(~F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("first").isNotNull(), F.col("first.name")).alias("refers"), "payload"
    )

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, url, digest, own, refers, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fields = {
                    "WARC-Type": "revisit" if refers else "response",
                    "WARC-Record-ID": own,
                    "WARC-Date": DATE,
                    "WARC-Target-URI": url,
                    "Content-Type": "application/http; msgtype=response",
                    "WARC-Payload-Digest": _label(digest),
                    "WARC-Profile": PROFILE if refers else None,
                    "WARC-Refers-To": refers,
                }
                out += segments(fields, HTTP if refers else HTTP + chunked(payload), segment_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    made = rows.mapInArrow(lines, "record binary").select(F.col("record").cast("string").alias("value"))
    made.write.option("lineSep", ENDS.decode()).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_A_FILE
    ).text(path)


def _resolved(own: dict[str, object], block: bytes | None) -> dict[str, object]:
    """The row of a record whose block is whole (None: it is not)."""
    out = {
        "record": own["record"], "page_id": own["page_id"], "record_type": own["kind"], "payload_digest": _hex(own["digest"]),
        "refers": own["refers"], "uri": own["uri"], "payload": None, "intact": block is not None,
    }
    if block is not None and own["kind"] == "response":
        try:
            payload = http_payload(block)
        except ValueError:
            return out | {"intact": False}
        intact = out["payload_digest"] in (None, hashlib.sha1(payload).hexdigest())
        return out | {"payload": payload if intact else None, "intact": intact}
    return out


PAGE = pa.schema(
    [
        ("record", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()),
        ("refers", pa.string()), ("uri", pa.string()), ("payload", pa.binary()), ("intact", pa.bool_()),
    ]
)
PAGE_DDL = (
    "record string, page_id long, record_type string, payload_digest string, refers string, uri string, "
    "payload binary, intact boolean"
)


def reassembled(parts: list[dict[str, object]]) -> list[dict[str, object]]:
    """The rows of the segments of one origin, in order of their numbers."""
    first = [p for p in parts if p["segment"] == 1]
    by_number = {p["segment"]: p for p in parts}
    total = next((p["total"] for p in parts if p["total"] is not None), None)
    block = b"".join(p["block"] for _, p in sorted(by_number.items()))
    whole = first and total == len(block) and set(by_number) == set(range(1, len(by_number) + 1))
    own = first[0] if first else parts[0] | {"record": parts[0]["origin"], "kind": "response", "digest": None}
    return [_resolved(own, block if whole else None)] * max(1, len(first))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per response or revisit record: record, page_id, record_type, payload_digest, refers, uri, payload, intact."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out, held = [], 0
                for found in records(gzip.decompress(content.as_py())):
                    out.append(found)
                    held += len(found["block"])
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema=RECORD)
                        out, held = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=RECORD)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_resolved(r, r["block"]) for r in batch.to_pylist()], schema=PAGE)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, object]] = []
        for batch in batches:
            out = []
            for part in batch.to_pylist():
                if held and held[0]["origin"] != part["origin"]:
                    out += reassembled(held)
                    held = []
                held.append(part)
            yield pa.RecordBatch.from_pylist(out, schema=PAGE)
        if held:
            yield pa.RecordBatch.from_pylist(reassembled(held), schema=PAGE)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    found = files.mapInArrow(parse, RECORD_DDL)
    single = found.where("segment = 0 and kind <> 'continuation'").mapInArrow(whole, PAGE_DDL)
    cut = spread(found.where("segment > 0"), "origin").sortWithinPartitions("origin", "segment")
    return single.unionByName(cut.mapInArrow(join, PAGE_DDL))


def page_records(found: DataFrame) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    A revisit has the size of the payload of the response that it refers to.
    """
    rows = staged(found.withColumn("size", F.octet_length("payload").cast("long")).drop("payload", "uri"), "records")
    targets = rows.where("record_type = 'response'").groupBy(F.col("record").alias("refers")).agg(
        F.max("size").alias("target_size"), F.max("page_id").alias("refers_to")
    )
    pointing = rows.where("refers is not null").join(targets, "refers", "left")
    none = F.lit(None).cast("long")
    others = rows.where("refers is null").withColumns({"target_size": none, "refers_to": none})
    return pointing.unionByName(others).select(
        "page_id",
        F.coalesce("size", "target_size").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
        (F.col("intact") & ((F.col("record_type") == "response") | F.col("target_size").isNotNull())).alias("intact"),
    )


def op2_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "archives")
    write(table(spark, sf_dir, "pages"), path)
    return page_records(read(spark, path))


ORACLE = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), g AS (
    SELECT t, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY t
)
SELECT page_id, payload_bytes, sha1(p.t) AS payload_digest,
    CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN top <> page_id THEN top END AS refers_to, true AS intact
FROM p LEFT JOIN g ON p.t = g.t
"""
