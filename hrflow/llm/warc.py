"""Web archives, index first.

Writing: every task streams its pages into WARC files of its own in the shared folder, one
gzip member per record, and yields an index row (file, offset, length, URL, digest) per record.
The index table is committed by Spark, so it names the files of successful attempts only;
files of lost attempts are never read. Pages with equal payloads: the largest ``page_id`` is
stored as a response, the others as revisits that refer to it.

Reading: the wanted index rows are grouped by file and stretch of it, sorted by offset, and
neighbouring ranges are read at once.

Files are reached through ``pyarrow.fs`` (local or mounted paths, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import materialise

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"

FILE_BYTES = 256 << 20
STRETCH = 4 << 20
#: Archive bytes that a reading task takes.
TASK_BYTES = 8 << 20
GAP = 64 << 10
INDEX = ("file string, offset long, length long, page_id long, url string, payload_digest string, "
         "payload_bytes long, record_type string, refers_to long")
INDEX_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                         ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                         ("record_type", pa.string()), ("refers_to", pa.int64())])


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    text = (urn or "").strip("<>").rpartition(":")[2]
    return int(text) if text.lstrip("-").isdigit() else None


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                revisit: bool, date: str) -> bytes:
    """One WARC record as a gzip member."""
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date),
            ("WARC-Target-URI", (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A")),
            ("WARC-Payload-Digest", "sha1:" + digest), ("WARC-Payload-Length", str(len(payload))),
            ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head.append(("Content-Length", str(len(block))))
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION.decode():
        raise ValueError("not a WARC record")
    fields = dict((k.lower(), v) for k, v in (x.split(": ", 1) for x in lines[1:]))
    return fields, rest[:int(fields["content-length"])]


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))


def _uri(folder: str) -> str:
    """``file:/x`` and plain paths as ``file:///x``; other schemes unchanged."""
    if folder.startswith("file:"):
        return "file:///" + folder[5:].lstrip("/")
    return folder if "://" in folder else "file://" + folder


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write all rows of ``pages`` (``page_id, url, html``) below ``folder``; the index, as a table.

    A NULL page is an empty payload. Rows that repeat the winning id of their payload are responses
    too. A payload whose ids are all NULL has responses only.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    winner = rows.groupBy("digest").agg(F.max("page_id").alias("winner"))
    rows = rows.join(winner, "digest").select("page_id", "url", "html", "digest", "winner")
    target = _uri(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(target)
        fs.create_dir(root, recursive=True)
        out = name = None
        offset = 0
        try:
            for b in batches:
                index = []
                for i, (page, url, digest, win) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 1, 3, 4)))):
                    payload = b.column(2)[i].as_buffer().to_pybytes()
                    revisit = page != win
                    code = base64.b32encode(bytes.fromhex(digest)).decode()
                    record = make_record(page, url, payload, code, win, revisit, date)
                    if out is None or offset > FILE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"pages-{uuid.uuid4().hex}.warc.gz"
                        out, offset = fs.open_output_stream(f"{root}/{name}", compression=None), 0
                    out.write(record)
                    index.append((name, offset, len(record), page, url, code, len(payload),
                                  "revisit" if revisit else "response", win if revisit else None))
                    offset += len(record)
                if index:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*index), INDEX_ARROW.types)], schema=INDEX_ARROW)
        finally:
            if out is not None:
                out.close()

    return materialise(rows.mapInArrow(write, INDEX), "warc-index")


READ = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "stored_digest string, payload binary")


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records named by ``index`` rows, from byte ranges of the archives (columns of ``READ``).

    ``stored_digest`` is recomputed from the stored payload of a response (NULL for revisits).
    """
    target = _uri(folder)
    stretches = (index.select("file", F.expr(f"offset div {STRETCH}").alias("stretch"), "offset", "length")
                 .groupBy("file", "stretch").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("ranges"))
                 .select("file", "ranges"))  # a stretch holds STRETCH bytes of records at most
    # tasks by the bytes of the archives: the index is small whatever it names
    tasks = 1 + (index.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES
    stretches = stretches.repartition(tasks, "file", "stretch")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(target)
        for b in batches:
            for name, ranges in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out = []
                with fs.open_input_file(f"{root}/{name}") as f:
                    i = 0
                    while i < len(ranges):
                        start = end = ranges[i]["offset"]
                        j = i
                        while j < len(ranges) and ranges[j]["offset"] - end <= GAP:
                            end = max(end, ranges[j]["offset"] + ranges[j]["length"])
                            j += 1
                        data = f.read_at(end - start, start)
                        for r in ranges[i:j]:
                            at = r["offset"] - start
                            head, block = parse_record(data[at:at + r["length"]])
                            response = head["warc-type"] == "response"
                            body = block.partition(b"\r\n\r\n")[2] if response else None
                            url = head["warc-target-uri"]
                            out.append((page_of(head["warc-record-id"]), None if url == "urn:none" else url,
                                        int(head["warc-payload-length"]), head["warc-payload-digest"].removeprefix("sha1:"),
                                        head["warc-type"], page_of(head.get("warc-refers-to")),
                                        base64.b32encode(hashlib.sha1(body).digest()).decode() if response else None,
                                        body if payloads else None))
                        i = j
                if out:
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                     names=[x.split()[0] for x in READ.split(", ")])

    return stretches.mapInArrow(read, READ)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder, payloads=False)
