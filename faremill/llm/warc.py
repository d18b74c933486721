"""WARC files: a writer that stores equal payloads once, and a reader that splits files.

Every record is a gzip member of its own. The reader cuts files into byte ranges; a task scans
its range for the magic bytes of gzip, takes a place for the start of a record only if the
header of a WARC record comes out of it, and then reads member after member. It owns the
records that start inside its range, and reads on past the end for the last one. A damaged
member is skipped by scanning on.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, written
from faremill.session import scratch_path
from faremill.sources.stores import open_store, write_file

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31

LEAST_REVISIT = 1000
DATE = "1970-01-01T00:00:00Z"
FILE_BYTES = 32 << 20
RANGE_BYTES = 8 << 20
_READ = 1 << 20
_PEEK = 256
_FOUND = "file string, at long, type string, id string, refers_to string, uri string, payload_bytes long, payload_digest string"


def page_urn(page_id) -> str:
    return "urn:x-page:" + ("" if page_id is None else str(page_id))


def header_value(text: str | None) -> str:
    """A value that stays on its line: control characters in percent form."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text or "")


def record(page_id, url, payload: bytes, digest: str, refers_to=None, level: int = 3) -> bytes:
    """One gzip member. With `refers_to` it is a revisit, which keeps the headers of the answer only."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{page_urn(page_id)}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {header_value(url)}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{page_urn(refers_to)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    packer = zlib.compressobj(level, wbits=GZIP)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def with_originals(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html, digest, original: the page a row revisits, or null.

    Of rows with equal payloads of at least `least` bytes, those with the largest page_id are
    kept whole. Only payloads that occur again are joined back.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    repeated = written(
        rows.filter(F.octet_length("html") >= least).groupBy("digest")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND kept IS NOT NULL").drop("n"), "repeated")
    return rows.join(repeated, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(F.col("page_id").eqNullSafe(F.col("kept")), None).otherwise(F.col("kept")).alias("original"))


def write_warc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = 3) -> DataFrame:
    """Write a record per row of (page_id, url, html); returns file, bytes, records of every file.

    A null html is an empty payload, a null page_id stays null, repeated rows are records of
    their own. Files of attempts that were lost are not in the result.
    """
    spark = pages.sparkSession
    bounded_batches(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        held, size, number = [], 0, 0

        def flush():
            nonlocal held, size, number
            name = f"{folder}/part-{context.partitionId():06d}-{number:04d}-{context.taskAttemptId()}.warc.gz"
            write_file(name, b"".join(held))
            row = pa.RecordBatch.from_pylist([{"file": name, "bytes": size, "records": len(held)}])
            held, size, number = [], 0, number + 1
            return row

        for batch in batches:
            for page_id, url, html, digest, original in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(record(page_id, url, html.encode(), digest, original, level))
                size += len(held[-1])
                if size >= file_bytes:
                    yield flush()
        if held:
            yield flush()

    return written(with_originals(pages).mapInArrow(write, "file string, bytes long, records long"), "archives")


class Window:
    """A part of a file that is read on as more is asked for."""

    def __init__(self, stream, start: int):
        self.stream, self.start, self.data, self.ended = stream, start, b"", False
        stream.seek(start)

    def upto(self, end: int) -> bool:
        """Hold the bytes before `end` (a place in the file); whether they are all there."""
        missing = end - self.start - len(self.data)
        if missing > 0 and not self.ended:
            more = self.stream.read(max(missing, _READ))
            self.ended = len(more) < missing
            self.data += more
        return len(self.data) >= end - self.start

    def forget(self, at: int) -> None:
        if at - self.start > 2 * _READ:
            self.data, self.start = self.data[at - self.start:], at

    def find_magic(self, at: int, end: int) -> int:
        """The first place in [at, end) where the magic bytes stand, or -1."""
        while at < end:
            self.upto(min(at + _READ, end) + len(MAGIC) - 1)
            found = self.data.find(MAGIC, at - self.start, min(at + _READ, end) - self.start + len(MAGIC) - 1)
            if found >= 0:
                return found + self.start
            at += _READ
            self.forget(min(at, end))
        return -1


def member(window: Window, at: int):
    """(content, end) of the gzip member at a place, or None if it is not a whole WARC record."""
    unpacker, parts, checked = zlib.decompressobj(GZIP), [], False
    place, step = at, _PEEK
    try:
        while not unpacker.eof:
            window.upto(place + step)
            piece = window.data[place - window.start:place - window.start + step]
            if not piece:
                return None
            parts.append(unpacker.decompress(piece))
            place += len(piece)
            if not checked and (head := b"".join(parts))[:len(VERSION)]:
                if len(head) >= len(VERSION):
                    if not head.startswith(VERSION):
                        return None
                    checked = True
            step = 1 << 16
    except zlib.error:
        return None
    return (b"".join(parts), place - len(unpacker.unused_data)) if checked else None


def parsed(content: bytes):
    """(headers, HTTP headers, payload) of a record; None if its lengths do not fit."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    if not gap:
        return None
    headers = _headers(head)
    length = headers.get("content-length", "")
    if not length.isdigit() or int(length) > len(rest):
        return None
    http, gap, payload = rest[:int(length)].partition(b"\r\n\r\n")
    return headers, _headers(http) if gap else {}, payload


def _headers(head: bytes) -> dict[str, str]:
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def records_in(stream, start: int, end: int):
    """(place, headers, HTTP headers, payload) of the records that start in [start, end)."""
    window = Window(stream, start)
    at = start
    while (at := window.find_magic(at, end)) >= 0:
        found = member(window, at)
        whole = parsed(found[0]) if found else None
        if whole is None:
            at += 1
            continue
        yield at, *whole
        at = found[1]
        window.forget(at)


def read_warc(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = False) -> DataFrame:
    """file, at, type, id, refers_to, uri, payload_bytes, payload_digest of every record.

    `files` has file and bytes. Length and digest of a response are taken from the payload that
    was read, those of a revisit from its headers. With `payloads`, the payload comes as binary.
    """
    bounded_batches(spark)
    names = [f.split(" ")[0] for f in _FOUND.split(", ")] + ["payload"] * payloads

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                system, name = open_store(path)
                with system.open_input_file(name) as stream:
                    yield from _batched(path, stream, start, end)

    def _batched(path, stream, start, end):
        rows, size = [], 0
        for at, headers, http, payload in records_in(stream, start, end):
            kind = headers.get("warc-type")
            digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
            length = http.get("content-length", "")
            if kind != "revisit":
                digest, length = hashlib.sha1(payload).hexdigest(), str(len(payload))
            row = (path, at, kind, _bare(headers.get("warc-record-id")), _bare(headers.get("warc-refers-to")),
                   headers.get("warc-target-uri"), int(length) if length.isdigit() else None, digest)
            rows.append(row + (payload,) * payloads)
            size += len(payload) * payloads + 300
            if size > 4 << 20:
                yield _table(rows)
                rows, size = [], 0
        if rows:
            yield _table(rows)

    def _table(rows):
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * payloads
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    starts = F.explode(F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {range_bytes}L)"))
    ranges = files.select("file", "bytes", starts.alias("start")).select(
        "file", "start", F.least(F.col("start") + range_bytes, "bytes").alias("end"))
    # The list of files is small; its ranges are dealt out evenly to all tasks.
    return ranges.repartition(_tasks(spark), "file", "start").mapInArrow(read, _FOUND + ", payload binary" * payloads)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def page_records(pages: DataFrame, file_bytes: int = FILE_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of pages written and read back."""
    spark = pages.sparkSession
    files = write_warc(pages, scratch_path(spark, "warc"), file_bytes)
    page = lambda name: F.expr(f"try_cast(nullif(substring_index({name}, ':', -1), '') AS bigint)")
    return read_warc(spark, files, range_bytes).select(
        page("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        page("refers_to").alias("refers_to"))
