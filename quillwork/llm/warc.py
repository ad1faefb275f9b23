"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding some whole WARC records, and a seek table in a skippable
frame at its end: the compressed and the plain size of each frame, then the number of frames. An index maps a record to
its bundle, its frame and its place in the plain frame, so one record costs one seek and one frame.

Bundles go to a folder that all executors share. A task names its bundles afresh at each attempt and returns their names
in the index, so what a lost or repeated attempt has left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.llm.shared import shared_dir, stash

#: Fixed values of the seekable format: magic numbers of its skippable frame and of its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, BUNDLE_BYTES, LEAST_REVISIT, LEVEL = 256 * 1024, 64 * 1024 * 1024, 1000, 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, page_id long, bundle string, frame int, start int, length int"


class BundleWriter:
    """Writes records to a stream; add() tells (frame, start, length) of the record."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.out, self.most, self.frames, self.buffer = out, frame_bytes, [], bytearray()
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.size = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        if self.buffer and len(self.buffer) + len(record) > self.most:
            self.flush()
        place = (len(self.frames), len(self.buffer), len(record))
        self.buffer += record
        return place

    def flush(self) -> None:
        if self.buffer:
            data = self.press.compress(bytes(self.buffer))
            self.out.write(data)
            self.frames.append((len(data), len(self.buffer)))
            self.size += len(data)
            self.buffer = bytearray()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Reads a seekable bundle from a random-access file."""

    def __init__(self, file):
        import zstandard

        self.file, self.unpress = file, zstandard.ZstdDecompressor()
        size = file.size()
        file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end of the bundle")
        width = 12 if flags & 0x80 else 8
        file.seek(size - 9 - width * count)
        table = file.read(width * count)
        self.frames, at = [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", table, k * width)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        self.file.seek(at)
        return self.unpress.decompress(self.file.read(packed), max_output_size=plain)


def opened(folder: str, name: str, write: bool):
    """A file in a folder given as a URI or path, through the file systems of pyarrow; a read file seeks."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    if write:
        system.create_dir(path, recursive=True)
        return system.open_output_stream(f"{path}/{name}", compression=None)
    return system.open_input_file(f"{path}/{name}")


def record_urn(page_id: int | None, url: str | None, row: int) -> str:
    """The id of a record: that of its page and of its row's number, so that repeated rows have ids of their own."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {row}").urn


def plain(value: str) -> str:
    """A header's value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, urn: str, to_urn: str | None) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if to_urn else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if to_urn else 'response'}", f"WARC-Record-ID: <{urn}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {plain(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if to_urn:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{to_urn}>", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """Headers and payload of the record at a place, and the place after it; a response's digest is checked."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines[1:])
    start, n = end + 4, int(head["Content-Length"])
    http = data.index(b"\r\n\r\n", start) + 4
    size = int(re.search(rb"Content-Length: (\d+)", data[start:http])[1])
    payload = data[http : start + n]
    digest = base64.b32decode(head["WARC-Payload-Digest"][5:])
    if head["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} doesn't match its digest")
    number = lambda k: int(head[k]) if k in head else None
    row = {"record_id": head["WARC-Record-ID"][1:-1], "page_id": number("X-Page-Id"), "payload_bytes": size, "payload_digest": digest.hex(), "record_type": head["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"), "payload": payload}
    return row, start + n + 4


def mark_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, html, row, refers_to, refers_url, refers_row): among equal payloads of `least` bytes or more the largest
    page_id is kept in full; row numbers the rows of pages. A smaller payload meets nothing: its key is its row's own."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.monotonically_increasing_id().alias("row"))
    same = F.when(F.octet_length("html") >= least, F.sha2(F.col("html").cast("binary"), 256))
    rows = rows.withColumn("same", F.coalesce(same, F.col("row").cast("string")))
    first = F.max(F.struct("page_id", "url", "row"))
    kept = rows.where(F.length("same") == 64).groupBy("same").agg(first.alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(kept, "same", "left")
    other = F.col("kept.page_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept.page_id"))
    return joined.select("page_id", "url", "html", "row", *(F.when(other, F.col(f"kept.{c}")).alias(n) for c, n in (("page_id", "refers_to"), ("url", "refers_url"), ("row", "refers_row"))))


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record for every row of pages(page_id, url, html); returns the index, read from a table in the shared folder.

    A null html is an empty payload, a null url has no target header, a null page_id no page header and is never referred
    to. Repeated rows get a record each, with an id of its own; those with the largest page_id are all kept in full. An empty table writes no bundle.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, writer, name, rows = TaskContext.get().partitionId(), None, "", []
        for batch in batches:
            for page_id, url, html, row, to, to_url, to_row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    name = f"part-{part:05d}-{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(opened(folder, name, True), frame_bytes)
                urn = record_urn(page_id, url, row)
                place = writer.add(make_record(page_id, url, html.encode("utf-8", "surrogatepass"), to, urn, None if to is None else record_urn(to, to_url, to_row)))
                rows.append((urn, page_id, name, *place))
                if writer.size >= bundle_bytes:
                    writer.close()
                    writer = None
            yield table(rows)
            rows = []
        if writer:
            writer.close()

    def table(rows):
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["record_id", "page_id", "bundle", "frame", "start", "length"])

    return stash(mark_revisits(pages).mapInArrow(write, INDEX), "warc-index")


RECORDS = "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_bundles(index: DataFrame, folder: str, keep_payload: bool = False) -> DataFrame:
    """All records of the bundles that the index names, read from the archives frame by frame."""
    schema = RECORDS + (", payload binary" if keep_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bundle in batch["bundle"]:
                with opened(folder, bundle, False) as file:
                    reader = BundleReader(file)
                    for k in range(len(reader.frames)):
                        data, at, rows = reader.frame(k), 0, []
                        while at < len(data):
                            row, at = parse_record(data, at)
                            rows.append([row[n] for n in names])
                        out = pd.DataFrame(rows, columns=names)
                        for c in ("page_id", "refers_to"):
                            out[c] = pd.array(out[c], "Int64")
                        yield out

    bundles = index.select("bundle").distinct()
    # By range: a hash exchange of as many partitions as that of distinct() would be left out, and that one coalesced to one task.
    return bundles.repartitionByRange(max(1, bundles.count()), "bundle").mapInPandas(read, schema)


def fetch_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of these index rows alone, payloads included: one seek and one frame each run of rows of a frame."""
    schema = RECORDS + ", payload binary"
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (bundle, frame), part in batch.groupby(["bundle", "frame"]):
                with opened(folder, bundle, False) as file:
                    data = BundleReader(file).frame(frame)
                out = pd.DataFrame([[parse_record(data, a)[0][n] for n in names] for a in part["start"]], columns=names)
                for c in ("page_id", "refers_to"):
                    out[c] = pd.array(out[c], "Int64")
                yield out

    return index.select("bundle", "frame", "start").mapInPandas(read, schema)


def fresh_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/quillwork/warc-{uuid.uuid4().hex}"
