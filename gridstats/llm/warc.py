"""Web archives: a writer, and a reader that splits files at any byte.

Every record is a gzip member of its own. A reading task has a byte range; it
scans the range for the gzip magic, takes a hit as a member only if it inflates to
a WARC header, and owns exactly the records that start inside its range, reading
on past the range's end to finish the last one. Ranges of any size therefore give
every record once.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.llm.files import read_at, write_whole
from gridstats.llm.shared import new_path, ship_package, spread, stored, text_of

LEAST_REVISIT_BYTES = 1000    # smaller payloads are always stored
SPLIT_BYTES = 8 << 20         # of an archive, per reading task
READ_BYTES = 1 << 18
FILE_BYTES = 128 << 20        # compressed size at which a writer starts a new file

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"

_URN = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
RECORD_SCHEMA = ("record_type string, uri string, page_id long, refers_to long,"
                 " payload_bytes long, payload_digest string, payload binary")


# --- one record ------------------------------------------------------------------

def _header(lines: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"


def _one_line(value: str | None) -> str:
    """A URI without what would end a header line or be lost at its ends."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value or "")


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def encode_record(page_id: int | None, uri: str | None, payload: bytes,
                  refers_to: int | None, is_revisit: bool) -> bytes:
    """A response with its payload, or a revisit that names the response's record."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\n" + _header([
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    block = http if is_revisit else http + payload
    lines = [("WARC-Type", "revisit" if is_revisit else "response"),
             ("WARC-Record-ID", _id(page_id)), ("WARC-Date", DATE),
             ("WARC-Target-URI", _one_line(uri)),
             ("Content-Type", "application/http; msgtype=response"),
             ("WARC-Payload-Digest", f"sha1:{digest}")]
    if is_revisit:
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _id(refers_to))]
    lines.append(("Content-Length", str(len(block))))
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + _header(lines) + block + b"\r\n\r\n") + packer.flush()


def _fields(head: bytes) -> dict[str, str]:
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {k.strip().lower().decode(): v.strip().decode() for k, _, v in lines}


def _page(value: str | None) -> int | None:
    number = re.search(r"<urn:page:(-?[0-9]+)>", value or "")
    return int(number[1]) if number else None


def decode_record(data: bytes) -> dict:
    """Fields of an inflated record; digest and size of a stored payload are
    computed from it, those of a revisit are what it states."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    return {
        "record_type": fields["warc-type"], "uri": fields.get("warc-target-uri"),
        "page_id": _page(fields.get("warc-record-id")),
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": int(_fields(http).get("content-length", 0)) if revisit else len(payload),
        "payload_digest": base64.b32decode(stated).hex() if revisit
        else hashlib.sha1(payload).hexdigest(),
        "payload": None if revisit else payload,
    }


# --- scanning a range --------------------------------------------------------------

class _Window:
    """The file from a moving position on, read piece by piece."""

    def __init__(self, stream, start: int):
        self.stream, self.start, self.data, self.ended = stream, start, b"", False
        stream.seek(start)

    def grow(self) -> bool:
        more = b"" if self.ended else self.stream.read(READ_BYTES)
        self.ended = not more
        self.data += more
        return bool(more)

    def drop(self, to: int) -> None:
        self.data, self.start = self.data[to - self.start:], to


def _inflate(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The member at a position and where it ends, or None if none starts there:
    the header is decoded first, before anything is taken for a record."""
    unpacker, out, taken = zlib.decompressobj(31), [], at
    size, checked = 0, False
    try:
        while not unpacker.eof:
            piece = window.data[taken - window.start:]
            if not piece:
                if not window.grow():
                    return None
                continue
            taken += len(piece)
            out.append(unpacker.decompress(piece))
            size += len(out[-1])
            if not checked and size >= len(VERSION):
                if not b"".join(out).startswith(b"WARC/1."):
                    return None
                checked = True
    except zlib.error:
        return None
    return (b"".join(out), taken - len(unpacker.unused_data)) if checked else None


def records_in(uri: str, start: int, end: int) -> Iterator[bytes]:
    """Inflated records whose first byte is in [start, end)."""
    with read_at(uri) as stream:
        window, at = _Window(stream, start), start
        while True:
            hit = window.data.find(MAGIC, at - window.start)
            if hit < 0:
                at = max(at, window.start + len(window.data) - len(MAGIC) + 1)
                window.drop(min(at, window.start + len(window.data)))
                if at >= end or not window.grow():
                    return
                continue
            at = window.start + hit
            if at >= end:
                return
            window.drop(at)
            member = _inflate(window, at)
            if member is None:
                at += 1
            else:
                yield member[0]
                at = member[1]


# --- tables --------------------------------------------------------------------------

def with_revisits(pages: DataFrame, *, key: str = "page_id", payload: Column,
                  least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """All rows with ``_first``: the largest key among rows of an equal payload of
    at least ``least`` bytes, for payloads that occur more than once.

    Equal payloads are counted by a digest, combined in every map task; only
    digests that occur twice come back to the pages, and where one of them is
    frequent, adaptive execution splits the join.
    """
    marked = pages.withColumn("_digest", F.when(F.octet_length(payload) >= least, F.sha2(
        F.encode(payload, "UTF-8"), 256)))
    twice = (marked.where("_digest is not null").groupBy("_digest")
             .agg(F.count("*").alias("n"), F.max(key).alias("_first")).where("n > 1").drop("n"))
    return marked.join(stored(twice, "revisited"), "_digest", "left").drop("_digest")


def write_archives(pages: DataFrame, folder: str, *, key: str = "page_id", uri: str = "url",
                   html: str = "html") -> DataFrame:
    """Archives under ``folder`` and a table of them (path, bytes, records).

    The largest key of equal payloads of at least ``LEAST_REVISIT_BYTES`` bytes is
    the response (all of its rows, if the key repeats), others revisit it. A NULL
    payload is empty; a NULL key is never the response while another is there; a
    NULL or odd URI is written so that it fits a line. Files belong to one attempt
    of a task; the table lists those of attempts that succeeded.
    """
    ship_package()
    chosen = with_revisits(pages, key=key, payload=text_of(html)).select(
        F.col(key).alias("k"), F.col(uri).cast("string").alias("u"),
        text_of(html).alias("p"), F.col("_first").alias("f"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((k, u, p, f) for pdf in batches
                for k, u, p, f in zip(pdf["k"].astype("Int64"), pdf["u"], pdf["p"],
                                      pdf["f"].astype("Int64")))
        row = next(rows, None)
        while row is not None:
            path, size, count = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
            with write_whole(path) as stream:
                while row is not None and size < FILE_BYTES:
                    k, first = (None if pd.isna(x) else int(x) for x in (row[0], row[3]))
                    again = first is not None and k != first
                    data = encode_record(k, row[1], row[2].encode(), first if again else None,
                                         again)
                    stream.write(data)
                    size, count = size + len(data), count + 1
                    row = next(rows, None)
            yield pd.DataFrame({"path": [path], "bytes": [size], "records": [count]})

    files = chosen.mapInPandas(write, "path string, bytes long, records long")
    return stored(files, "archives")


def read_archives(spark: SparkSession, files: DataFrame, *, payloads: bool = True,
                  split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the files (path, bytes), read in ranges of ``split_bytes``."""
    ship_package()
    ranges = files.select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)),
        F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = spread(ranges, ranges.count(), "path", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, start in zip(pdf["path"], pdf["start"]):
                rows, held = [], 0
                for data in records_in(path, start, start + split_bytes):
                    row = decode_record(data)
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += len(data) if payloads else 256
                    if held >= 8 << 20:
                        yield _frame(rows)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows)

    return ranges.mapInPandas(read, RECORD_SCHEMA)


def _frame(rows: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(rows)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def archive_folder(spark: SparkSession) -> str:
    return new_path(spark, "warc")
