"""WARC archives: write, index, and read selected records by byte ranges.

Each task writes its pages as gzip members of one archive (rolled by size) and
reports an index row per record: file, offset, length, URL, digest. Readers
start from the index: the selected rows are sorted by file and offset, close
ranges are coalesced into one read, and the members are cut out of it.

Defined cases: a null page body is the empty payload; a null URL gives no URI
header; line breaks in a URL are percent-encoded; a null page id is the id
`none`; of several rows with the greatest page id of a payload all are
responses; an empty table gives an empty index; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import keep, open_store, scratch_path

INDEX = ("file string, offset long, length long, page_id long, url string, digest string, "
         "payload_bytes long, record_type string")
ARCHIVE_BYTES = 256 << 20
#: Payloads of at least so many bytes are stored once.
MIN_REVISIT_BYTES = 0
#: Reads closer than GAP_BYTES become one, of at most READ_BYTES.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without."""
    block = HTTP if revisit else HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; a response's digest and length are taken from
    its payload and must agree with the header."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    page = fields["WARC-Record-ID"][len("<urn:page:"):-1]
    out = {"page_id": None if page == "none" else int(page), "url": fields.get("WARC-Target-URI"),
           "record_type": fields["WARC-Type"], "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
           "payload_bytes": int(fields["X-Payload-Length"]), "refers_to": None, "payload": None}
    if out["record_type"] == "revisit":
        out["refers_to"] = int(fields["WARC-Refers-To"][len("<urn:page:"):-1])
    else:
        out["payload"] = payload = block.partition(b"\r\n\r\n")[2]
        if (digest(payload), len(payload)) != (out["payload_digest"], out["payload_bytes"]):
            raise ValueError(f"page {page}: the payload does not match its header")
    return out


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, refers_to: the page each row revisits (null: a
    response). Only ids and digests are grouped; the bodies meet the decision
    once, by page."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("_key", F.unhex(F.sha1("html")))
    narrow = rows.select("page_id", "_key", F.octet_length("html").alias("_n"))
    latest = narrow.where((F.col("_n") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("_key", "_n").agg(
        F.max("page_id").alias("_last"))
    again = (narrow.join(latest, ["_key", "_n"]).where(~F.col("page_id").eqNullSafe(F.col("_last")))
             .select(F.col("page_id").alias("_page"), F.col("_key").alias("_k"), F.col("_last").alias("refers_to")).distinct())
    return rows.join(again, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("_key") == F.col("_k")), "left").select(
        "page_id", "url", "html", "refers_to")


def write_archives(pages: DataFrame, path: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of `pages` (page_id, url, html) and return the
    index. Archives of lost task attempts are never indexed: names are unique
    and only finished tasks report them."""
    import pyarrow as pa
    path = path or scratch_path(pages.sparkSession, "warc")
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                        ("url", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("record_type", pa.string())])

    def write(batches):
        store, folder = open_store(path)
        out, name, at = None, None, 0
        try:
            for b in batches:
                rows = []
                for page_id, url, html, refers_to in zip(*[c.to_pylist() for c in b.columns], strict=True):
                    if out is None or at >= archive_bytes:
                        if out:
                            out.close()
                        store.create_dir(folder, recursive=True)
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{folder}/{name}", compression=None)
                    payload = html.encode()
                    member = gzip.compress(record(page_id, url, payload, refers_to, refers_to is not None), 4, mtime=0)
                    out.write(member)
                    rows.append((f"{path}/{name}", at, len(member), page_id, url, digest(payload), len(payload),
                                 "response" if refers_to is None else "revisit"))
                    at += len(member)
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema) \
                    if rows else pa.RecordBatch.from_pylist([], schema)
        finally:
            if out:
                out.close()

    planned = plan_records(pages)
    return keep(planned.mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """The records of the index rows (all, or any selection of them): page_id,
    url, record_type, payload_digest, payload_bytes, refers_to, payload. Rows
    of one stretch of an archive go to one task in offset order."""
    import pyarrow as pa
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])

    def ranges(rows):
        """Runs of records close to each other."""
        run = []
        for file, offset, length in rows:
            if run and (file != run[0][0] or offset > run[-1][1] + run[-1][2] + GAP_BYTES
                        or offset + length > run[0][1] + READ_BYTES):
                yield run
                run = []
            run.append((file, offset, length))
        if run:
            yield run

    def read(batches):
        for b in batches:
            for run in ranges(zip(*[c.to_pylist() for c in b.columns[:3]], strict=True)):
                store, at = open_store(run[0][0])
                first, last = run[0][1], max(o + n for _, o, n in run)
                with store.open_input_file(at) as f:
                    data = f.read_at(last - first, first)
                found = [parse(zlib.decompress(data[o - first:o - first + n], 31)) for _, o, n in run]
                yield pa.RecordBatch.from_pylist(found, schema)

    stretch = F.floor(F.col("offset") / READ_BYTES)
    picked = index.select("file", "offset", "length").repartition("file", stretch).sortWithinPartitions("file", "offset")
    return picked.mapInArrow(read, "page_id long, url string, record_type string, payload_digest string, "
                                   "payload_bytes long, refers_to long, payload binary")


def payloads(records: DataFrame) -> DataFrame:
    """Records with every payload: a revisit takes that of the response it refers to."""
    full = records.where("record_type = 'response'").select(
        F.col("page_id").alias("_id"), F.col("payload_digest").alias("_d"), F.col("payload").alias("_p")).dropDuplicates(["_id", "_d"])
    return records.join(full, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_d")), "left").withColumn(
        "payload", F.coalesce("payload", "_p")).drop("_id", "_d", "_p")
