"""WARC archives in seekable Zstandard bundles.

A bundle is the content of one ``.warc.zst`` file: records grouped into
independent Zstandard frames, then a seek table in a skippable frame (the
format of the Zstandard project's seekable files). With it goes the index: for
every record its identifier, frame and offset inside that frame, so one record
is read by decompressing one frame.

Bundles are rows of a Parquet table, one per file, written by Spark: a retried
or speculative task cannot leave half a file behind, any store that Spark
writes to will do, and a reader that wants the index reads that column alone.
``export_files`` writes them out as files.

Records with equal payloads are written once: the one of the smallest id is a
``response``, the others are ``revisit`` records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches
from wardflow.session import materialize

#: Fixed values of the file formats.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122

_INDEX = "array<struct<record_id:string,frame:int,offset:bigint,length:bigint>>"
BUNDLES = f"bundle long, content binary, frames int, records {_INDEX}"


# --- records -----------------------------------------------------------------

def record_id(page: str | None, row: int) -> str:
    return f"urn:uuid:{uuid.uuid5(_NAMESPACE, f'page/{page}/{row}')}"


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(page, row, url, payload: bytes, digest: str, n_bytes: int, refers, date: str) -> tuple[str, bytes]:
    """(identifier, bytes) of one record; ``refers`` is (page, row, url) of the response."""
    rid = record_id(page, row)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: <{rid}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    head += [f"WARC-Target-URI: {_clean(url)}"] if url else []
    head += [f"X-Page-Id: {page}"] if page is not None else []
    if refers:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(refers[0], refers[1])}>"]
        head += [f"WARC-Refers-To-Target-URI: {_clean(refers[2])}"] if refers[2] else []
        head += [f"X-Refers-To-Page-Id: {refers[0]}"] if refers[0] is not None else []
        payload = b""
    block = http + payload
    head.append(f"Content-Length: {len(block)}")
    return rid, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, bytes, int]:
    """(headers, HTTP head, payload, end) of the record that begins at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    http = data.index(b"\r\n\r\n", begin) + 4
    return headers, data[begin:http], data[http:end], end + 4


# --- bundles -----------------------------------------------------------------

class Bundler:
    """Groups records into frames and frames into bundles of bounded size."""

    def __init__(self, frame_bytes: int, bundle_bytes: int, level: int):
        import zstandard

        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self._clear()

    def _clear(self):
        self.body, self.entries, self.index = bytearray(), [], []
        self.open, self.waiting = bytearray(), []

    def add(self, rid: str, record: bytes):
        """A finished bundle, if the record before filled one."""
        done = None
        if self.open and len(self.open) + len(record) > self.frame_bytes:
            self._frame()
            if len(self.body) >= self.bundle_bytes:
                done = self.finish()
        self.waiting.append((rid, len(self.open), len(record)))
        self.open += record
        return done

    def _frame(self):
        packed = self.zip.compress(bytes(self.open))
        self.index += [(rid, len(self.entries), at, n) for rid, at, n in self.waiting]
        self.entries.append((len(packed), len(self.open)))
        self.body += packed
        self.open, self.waiting = bytearray(), []

    def finish(self):
        """(content, frames, index) or None if there is no record."""
        if self.open:
            self._frame()
        if not self.entries:
            return None
        table = b"".join(struct.pack("<II", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), 0, SEEKABLE)
        out = bytes(self.body) + struct.pack("<II", SKIPPABLE, len(table)) + table, len(self.entries), self.index
        self._clear()
        return out


def seek_table(content) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from the footer alone."""
    count, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    begin = len(content) - 9 - width * count
    out, at = [], 0
    for k in range(count):
        packed, size = struct.unpack("<II", content[begin + width * k:begin + width * k + 8])
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(content, frame: tuple[int, int, int]) -> bytes:
    import zstandard

    at, packed, size = frame
    return zstandard.ZstdDecompressor().decompress(bytes(content[at:at + packed]), max_output_size=size)


# --- Spark jobs --------------------------------------------------------------

def write_bundles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit_bytes: int = 0, frame_bytes: int = 256 << 10, bundle_bytes: int = 8 << 20, level: int = 3,
                  date: str = "1970-01-01T00:00:00Z", path: str | None = None) -> DataFrame:
    """Archive every row of ``pages``; returns the stored bundle table (``BUNDLES``).

    A null payload is empty; null ids and urls have no header. Payloads are equal
    if SHA-1, a second hash and length are. Of equal ones of at least
    ``min_revisit_bytes`` the smallest id (null last; of repeated ids the first
    row stored) is the response. Other columns are not read. An empty table gives
    an empty archive.

    The rows are stored once with a number each, so that equal rows can be told
    apart. Finding the responses is a grouped minimum (partial per task), stored; the
    rows that revisit one are found by a join of keys and numbers alone, whose hot
    side Spark can split, and payloads meet them by the row's number, which no two
    share, so no task gets the copies of one payload. A very long payload is in
    memory once per task.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    staged = materialize(pages.select(
        F.col(id_col).cast("string").alias("page"), F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"), F.sha1(F.encode(payload, "UTF-8")).alias("sha1"), F.xxhash64(payload).alias("second"),
        F.octet_length(payload).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row")), "warc-rows")
    keys = ["sha1", "second", "n_bytes"]
    first = (staged.where(F.col("n_bytes") >= min_revisit_bytes).groupBy(*keys)
             .agg(F.min(F.struct(F.col("id").isNull(), "id", "row", "page", "url")).alias("first"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1").drop("copies"))
    first = materialize(first, "warc-responses")
    again = staged.select("row", *keys).join(first, keys).where(F.col("first.row") != F.col("row"))
    again = materialize(again.select(F.col("row").alias("of"), *[F.col(f"first.{c}").alias(f"to_{c}") for c in ("page", "row", "url")]), "warc-revisits")
    rows = staged.join(again, staged["row"] == again["of"], "left").select(
        "page", "row", "url", F.when(F.col("of").isNotNull(), F.lit("")).otherwise(F.col("payload")).alias("payload"), "sha1", "n_bytes",
        "to_page", "to_row", "to_url")

    def run(batches):
        task = TaskContext.get().partitionId() << 32
        bundler, count = Bundler(frame_bytes, bundle_bytes, level), 0

        def out(done):
            nonlocal count
            content, frames, index = done
            count += 1
            records = [dict(zip(("record_id", "frame", "offset", "length"), x)) for x in index]
            kind = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([task + count - 1], pa.int64()), pa.array([content], pa.binary()), pa.array([frames], pa.int32()),
                 pa.array([records], kind)], ["bundle", "content", "frames", "records"])

        for b in batches:
            for page, row, url, body, sha1, n, to_page, to_row, to_url in zip(*[c.to_pylist() for c in b.columns]):
                refers = (to_page, to_row, to_url) if to_row is not None else None
                done = bundler.add(*build_record(page, row, url, body.encode(), base64.b32encode(bytes.fromhex(sha1)).decode(), n, refers, date))
                if done:
                    yield out(done)
        done = bundler.finish()
        if done:
            yield out(done)

    return materialize(rows.mapInArrow(run, BUNDLES), "warc-bundles", path)


RECORDS = ("record_id string, page string, url string, record_type string, payload_bytes long, payload_digest string, "
           "refers_to_id string, refers_to_page string, payload binary")


def _row(data: bytes, at: int) -> tuple[tuple, int]:
    head, http, payload, end = parse_record(data, at)
    revisit = head["WARC-Type"] == "revisit"
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode()
    n = int(re.search(rb"Content-Length: (\d+)", http)[1]) if revisit else len(payload)
    return (head["WARC-Record-ID"][1:-1], head.get("X-Page-Id"), head.get("WARC-Target-URI"), head["WARC-Type"], n, digest,
            head["WARC-Refers-To"][1:-1] if revisit else None, head.get("X-Refers-To-Page-Id"), payload), end


def _record_batch(rows, with_payload: bool):
    cols = list(zip(*rows))
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    n = 9 if with_payload else 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols[:n], kinds)], names[:n])


def read_records(bundles: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the bundles, read frame by frame through the seek tables. A
    response's length and digest are those of the payload read; a revisit has its
    record's."""
    bounded_batches(bundles.sparkSession)

    def run(batches):
        for b in batches:
            for content in b.column(0):
                view = content.as_buffer()
                view = memoryview(view)
                for frame in seek_table(view):
                    data, at, rows = read_frame(view, frame), 0, []
                    while at < len(data):
                        row, at = _row(data, at)
                        rows.append(row)
                    yield _record_batch(rows, with_payload)

    return bundles.select("content").mapInArrow(run, RECORDS if with_payload else RECORDS.rsplit(",", 1)[0])


def fetch(bundles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records whose ``record_id`` is in ``wanted``: the index column says
    which frame of which bundle to decompress, and where in it the record is.
    Ids not in the archive give no row; repeated ones give one."""
    bounded_batches(bundles.sparkSession)
    places = (bundles.select("bundle", F.explode("records").alias("r")).select("bundle", "r.*")
              .join(wanted.select("record_id").distinct(), "record_id", "left_semi")
              .groupBy("bundle").agg(F.collect_list(F.struct("frame", "offset")).alias("places")))  # a bundle's records at most

    def run(batches):
        for b in batches:
            for content, at in zip(b.column(0), b.column(1).to_pylist()):
                view = memoryview(content.as_buffer())
                table, rows = seek_table(view), []
                for frame in sorted({p["frame"] for p in at}):
                    data = read_frame(view, table[frame])
                    rows += [_row(data, p["offset"])[0] for p in at if p["frame"] == frame]
                yield _record_batch(rows, True)

    return bundles.select("bundle", "content").join(places, "bundle").select("content", "places").mapInArrow(run, RECORDS)


def export_files(bundles: DataFrame, folder: str) -> DataFrame:
    """Write each bundle as ``<folder>/<bundle>.warc.zst``; returns the paths.
    ``folder`` is any location that ``pyarrow.fs`` opens on the executors. A file
    appears under its name only when whole, so a retried task does no harm."""
    bounded_batches(bundles.sparkSession)

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root)
        for b in batches:
            names = []
            for bundle, content in zip(b.column(0).to_pylist(), b.column(1)):
                name = f"{root}/{bundle:016x}.warc.zst"
                part = f"{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as f:
                    f.write(content.as_buffer())
                store.move(part, name)
                names.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["path"])

    return bundles.select("bundle", "content").mapInArrow(run, "path string")
