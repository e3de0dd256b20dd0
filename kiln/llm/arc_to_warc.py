"""Legacy archives to WARC: ARC versions 1 and 2 parsed, equivalent WARC records made, written and read.

An ARC file opens with a ``filedesc:`` record that names its version; each
record after it is a header line (5 fields in version 1, 10 in version 2, the
declared length last), that many bytes and a newline.  The converter gives
each record a WARC identifier (a UUID from its page id and payload digest),
an ISO timestamp from the 14-digit date, a type and SHA-1 digests.

``write_archives`` turns pages into ARC bytes, converts them and lets Spark
write the WARC files to the shared folder; ``read_archives`` reads them back,
record by record as their lengths say.  Of pages with equal payloads of at
least ``min_payload`` bytes, the one with the largest page_id is the response
and the others are revisits that name it and carry headers only.

Edge cases: a null html is an empty payload; a null url becomes ``unknown:``;
white space in a url is percent-encoded; a null page_id is a response and
comes back null; rows that repeat a page_id are each a record; an empty table
gives no records; other columns are ignored.

Scale: equal payloads meet as digests with map-side partial maxima, never as
texts; files hold at most ``RECORDS_A_FILE`` records, so a task reads one
bounded file at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import shared_dir, write_table

__all__ = ["arc_bytes", "parse_arc", "warc_record", "parse_warc", "write_archives", "read_archives", "MIN_PAYLOAD"]

MIN_PAYLOAD = 0
RECORDS_A_FILE = 2000
#: Bytes of pages in one ARC.
ARC_BYTES = 4 << 20
CAPTURED = "20240101000000"
#: What ends a WARC record; Spark's text writer puts it after each row.
END = "\r\n\r\n"
FIELDS = {1: ("url", "ip", "date", "type", "length"),
          2: ("url", "ip", "date", "type", "code", "checksum", "location", "offset", "filename", "length")}
HEADINGS = {1: "URL IP-address Archive-date Content-type Archive-length",
            2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_bytes(records: list[tuple[str, bytes]], version: int, name: str = "pages.arc", date: str = CAPTURED) -> bytes:
    """An ARC file of (url, HTTP message) records."""
    def header(url: str, kind: str, body: bytes, at: int) -> bytes:
        head = [url, "0.0.0.0", date, kind]
        if version == 2:
            head += ["200", hashlib.md5(body).hexdigest(), "-", str(at), name]
        return " ".join([*head, str(len(body))]).encode() + b"\n"

    block = f"{version} 0 kiln\n{HEADINGS[version]}\n".encode()
    out = [header(f"filedesc://{name}", "text/plain", block, 0), block, b"\n"]
    at = sum(map(len, out))
    for url, body in records:
        parts = [header(url, "text/html", body, at), body, b"\n"]
        at += sum(map(len, parts))
        out += parts
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[dict]:
    """The records of an ARC: header fields by the version that the first record declares, and ``body``."""
    at, version = 0, 0
    while at < len(data):
        end = data.index(b"\n", at)
        line = data[at:end].decode()
        if not version:
            length = int(line.rsplit(" ", 1)[1])
            version = int(data[end + 1:end + 1 + length].split(None, 1)[0])
        fields = dict(zip(FIELDS[version], line.split(" "), strict=True))
        start, length = end + 1, int(fields["length"])
        if start + length > len(data):
            raise ValueError("an ARC record is shorter than its header declares")
        yield fields | {"version": version, "body": data[start:start + length]}
        at = start + length + 1


def http_parts(message: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(head with its blank line, headers by lower-case name, body) of an HTTP message."""
    head, _, body = message.partition(b"\r\n\r\n")
    pairs = (x.decode().partition(":") for x in head.split(b"\r\n")[1:])
    return head + b"\r\n\r\n", {k.strip().lower(): v.strip() for k, _, v in pairs}, body


def record_id(page_id: str, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{payload_digest}')}>"


def warc_record(arc: dict, refers_to: str | None = None) -> bytes:
    """The WARC record (without its end) that is equivalent to an ARC record; a revisit if ``refers_to`` names a page."""
    date = arc["date"]
    when = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    block, head = arc["body"], [("WARC-Date", when)]
    if arc["url"].startswith("filedesc:"):
        kind, mime = "warcinfo", "application/warc-fields"
        block = f"software: kiln\r\nformat: WARC File Format 1.1\r\nisPartOf: {arc['url'][11:]}\r\n".encode()
        head.append(("WARC-Record-ID", record_id(arc["url"], digest(arc["body"]))))
    elif not block.startswith(b"HTTP/"):
        kind, mime = "resource", arc["type"]
        head += [("WARC-Record-ID", record_id(arc["url"], digest(block))), ("WARC-Target-URI", arc["url"]),
                 ("WARC-Payload-Digest", "sha1:" + digest(block))]
    else:
        kind, mime = "response", "application/http; msgtype=response"
        http, names, body = http_parts(block)
        own = digest(body)
        head += [("WARC-Record-ID", record_id(names.get("x-page-id", arc["url"]), own)),
                 ("WARC-Target-URI", arc["url"]), ("WARC-IP-Address", arc["ip"]), ("WARC-Payload-Digest", "sha1:" + own)]
        if refers_to is not None:
            kind, block = "revisit", http
            head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                     ("WARC-Refers-To", record_id(refers_to, own))]
    head = [("WARC-Type", kind), *head, ("WARC-Block-Digest", "sha1:" + digest(block)), ("Content-Type", mime),
            ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record, by declared length."""
    at = 0
    while at < len(data):
        if data[at:at + 5] != b"WARC/":
            raise ValueError("a WARC record does not start where the last one ends")
        end = data.index(b"\r\n\r\n", at) + 4
        pairs = (x.decode().partition(":") for x in data[at:end - 4].split(b"\r\n")[1:])
        head = {k.strip().lower(): v.strip() for k, _, v in pairs}
        stop = end + int(head["content-length"])
        yield head, data[end:stop]
        at = stop + len(END)


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    version = 2
    for batch in batches:
        records, refers, size = [], [], 0
        for page_id, url, html, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            body = (html or "").encode()
            head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n"
                    f"X-Page-Id: {'' if page_id is None else page_id}\r\n\r\n").encode()
            records.append((quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url else "unknown:", head + body))
            refers.append(None if last is None else str(last))
            size += len(body)
            if size >= ARC_BYTES:
                version = 3 - version
                yield _warc_rows(records, refers, version)
                records, refers, size = [], [], 0
        if records:
            version = 3 - version
            yield _warc_rows(records, refers, version)


def _warc_rows(records: list[tuple[str, bytes]], refers: list[str | None], version: int) -> pa.RecordBatch:
    arcs = parse_arc(arc_bytes(records, version))
    out = [warc_record(arc, last) for arc, last in zip(arcs, [None, *refers], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["record"])


def write_archives(pages: DataFrame, min_payload: int = MIN_PAYLOAD, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> str:
    """Write the pages' WARC files to a new folder of the shared one and return it."""
    src = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    src = src.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    own = src.where((F.octet_length(F.coalesce("html", F.lit(""))) >= min_payload) & F.col("page_id").isNotNull())
    own = own.select("page_id", "digest")
    last = own.groupBy("digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first")).where("first < last")
    revisits = own.join(last.drop("first"), "digest").where("page_id < last").distinct()
    revisits = write_table(revisits, "revisits")  # of known size, so that few of them need no shuffle of the pages
    path = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    rows = src.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "last")
    (rows.mapInArrow(_convert, "record string").write.option("lineSep", END)
     .option("maxRecordsPerFile", RECORDS_A_FILE).text(path))
    return path


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.column(0):
            rows: list[tuple] = []
            for head, block in parse_warc(file.as_buffer().to_pybytes()):
                if head["warc-type"] not in ("response", "revisit"):
                    continue
                _, names, body = http_parts(block)
                size = int(names["content-length"])
                own = head["warc-payload-digest"].removeprefix("sha1:")
                if head["warc-type"] == "response" and (len(body) != size or digest(body) != own):
                    raise ValueError("a payload does not match its digest")
                rows.append((int(names["x-page-id"]) if names["x-page-id"] else None, head["warc-target-uri"], size, own,
                             head["warc-type"], head["warc-record-id"], head.get("warc-refers-to"), head["warc-date"]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            kinds = [pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=_NAMES)


_NAMES = ["page_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_id", "warc_date"]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each response and revisit record of a folder of WARC files; ``refers_to`` is a page_id."""
    files = spark.read.format("binaryFile").load(path).select("content")
    rows = files.mapInArrow(_read, "page_id bigint, target_uri string, payload_bytes bigint, payload_digest string, "
                                   "record_type string, record_id string, refers_to_id string, warc_date string")
    rows = write_table(rows, "warc-rows")
    responses = rows.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.max("page_id").alias("refers_to"))
    return rows.join(responses, "refers_to_id", "left").select(*_NAMES[:6], "refers_to", "warc_date")
