"""WARC archives as seekable Zstandard bundles.

Method. Records are grouped into frames that are compressed each on its own, and
frames follow each other in a bundle file. A bundle ends with a seek table, a
skippable frame that gives every frame's size before and after, so any frame can
be found and read alone, and any Zstandard reader still sees a plain stream. An
index maps every record to its bundle, its frame and its offset within the
frame's text. Of records with equal payloads the one with the smallest id is a
response; the others are revisits that refer to it and carry its headers only.

On Spark. Payloads count as equal by their SHA-256, as different ones with the
SHA-1 that the format asks for are public. These keys are grouped in the JVM with
partial sums; only groups of two and more meet the pages again, in a join by key
whose hot keys adaptive execution splits. Tasks stream their rows into bundles in the shared folder and
hold one frame at a time. A bundle's name has its task attempt's number: what a
lost attempt leaves is in no index, so it is never read. The shared folder must
be one that Arrow's file systems open (a mounted path, HDFS, S3, GCS).

Defined results. A null html is an empty payload; a null url leaves out its
header. Null ids never name a group; a null id in a group that another row names
is a revisit. Rows that repeat the smallest id of a group are all responses. A
very long payload ends its frame, which its task holds whole. An empty table makes
no bundles.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import map_rows, stored, utf8
from opinara.session import work_folder

#: Bytes of records in a frame, and of frames in a bundle.
FRAME = 1 << 18
BUNDLE = 1 << 26
LEVEL = 3
#: Payloads of fewer bytes are always stored as responses.
LEAST_PAYLOAD = 0
#: Tasks that read bundles back, at most.
READERS = 20_000
#: Records carry no time of their own in the given tables.
DATE = "1970-01-01T00:00:00Z"

#: Fixed values of the seekable format and of revisits.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC record; a revisit holds the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else _escaped(c) for c in url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _escaped(char: str) -> str:
    return "".join(f"%{b:02X}" for b in char.encode("utf-8", "replace"))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def parse(text: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``at``, and where the next one begins."""
    end = text.index(b"\r\n\r\n", at)
    lines = text[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record begins here")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, text[start:stop], stop + 4


class Bundle:
    """A bundle that is being written."""

    def __init__(self, path: str, level: int = LEVEL) -> None:
        self.path = path
        files, place = fs.FileSystem.from_uri(path)
        files.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(place, compression=None)  # frames come compressed
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames: list[tuple[int, int]] = []
        self.size = 0

    def write(self, text: bytes) -> int:
        """Append a frame; its number."""
        packed = self.compressor.compress(text)
        self.out.write(packed)
        self.frames.append((len(packed), len(text)))
        self.size += len(packed)
        return len(self.frames) - 1

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class Reader:
    """Reads frames of a bundle in any order."""

    def __init__(self, path: str) -> None:
        files, place = fs.FileSystem.from_uri(path)
        self.file = files.open_input_file(place)
        end = self.file.size()
        count, _, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        sizes = list(struct.iter_unpack("<II", self._read(end - 9 - 8 * count, 8 * count)))
        self.frames, at = [], 0
        for packed, plain in sizes:
            self.frames.append((at, packed, plain))
            at += packed

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self._read(at, packed), max_output_size=plain)

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


INDEX = pa.schema(
    [("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int64()), ("offset", pa.int64())]
    + [("length", pa.int64()), ("record_type", pa.string())]
)
INDEX_DDL = "page_id long, bundle string, frame long, offset long, length long, record_type string"


def _writer(folder: str, frame_size: int, bundle_size: int):
    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        bundle, made, waiting, places, size = None, 0, [], [], 0

        def flush() -> Iterator[tuple]:
            nonlocal bundle, made, waiting, places, size
            if not waiting:
                return
            if bundle is None:
                bundle, made = Bundle(f"{name}-{made:04d}.warc.zst"), made + 1
            number, path = bundle.write(b"".join(waiting)), bundle.path
            for page_id, offset, length, kind in places:
                yield page_id, path, number, offset, length, kind
            waiting, places, size = [], [], 0
            if bundle.size >= bundle_size:
                bundle.close()
                bundle = None

        for page_id, url, payload, refers_to, revisit in rows:
            text = record(page_id, url, payload, refers_to, revisit)
            places.append((page_id, size, len(text), "revisit" if revisit else "response"))
            waiting.append(text)
            size += len(text)
            if size >= frame_size:
                yield from flush()
        yield from flush()
        if bundle is not None:
            bundle.close()

    return run


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST_PAYLOAD,
    frame_size: int = FRAME,
    bundle_size: int = BUNDLE,
) -> DataFrame:
    """Write a record per row into bundles below ``folder``; the index of records, as a written table."""
    folder = folder or work_folder(pages.sparkSession, "warc")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), utf8(html).alias("payload"))
    rows = rows.withColumn("content", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least
    groups = rows.filter(large).groupBy("content").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    several = stored(groups.filter("n > 1 and first_id is not null").select("content", "first_id"), "payloads")
    judged = rows.join(several, "content", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    judged = judged.select("page_id", "url", "payload", "first_id", revisit)
    return stored(map_rows(judged, _writer(folder, frame_size, bundle_size), INDEX, INDEX_DDL), "record-index")


RECORDS = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
)
RECORDS_DDL = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
    "payload binary"
)


def _page(value: str | None) -> int | None:
    """The id in ``<urn:page:7>``."""
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "None") else int(number)


def _described(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A record as a row; a response's digest is that of the bytes read."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest(payload) != stated):
        raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
    refers_to = _page(headers.get("WARC-Refers-To"))
    own = payload if with_payload and kind == "response" else None
    return _page(headers["WARC-Record-ID"]), size, stated, kind, refers_to, headers.get("WARC-Target-URI"), own


def read_archives(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the bundles in ``index``, read frame by frame from the files."""
    bundles = stored(index.select("bundle").distinct(), "bundles")
    tasks = max(1, min(READERS, bundles.count()))

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for (path,) in rows:
            with Reader(path) as reader:
                for number in range(len(reader.frames)):
                    text, at = reader.frame(number), 0
                    while at < len(text):
                        headers, block, at = parse(text, at)
                        yield _described(headers, block, with_payload)

    return map_rows(bundles.repartition(tasks), run, RECORDS, RECORDS_DDL)


def fetch(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of some ``page_id``, each read from its own frame only."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for path, number, offset in rows:
            with Reader(path) as reader:
                headers, block, _ = parse(reader.frame(number), offset)
                yield _described(headers, block, True)

    wanted = index.join(ids.select("page_id").distinct(), "page_id", "left_semi")
    return map_rows(wanted.select("bundle", "frame", "offset"), run, RECORDS, RECORDS_DDL)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages``, read the archives back, and describe every record."""
    found = read_archives(write_archives(pages))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# SHA-1 in base 32: 40 hex digits are 8 groups of 20 bits, and each is 4 letters.
WARC_SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
b as (
  select *, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (5 * (3 - i % 4))) & 31) + 1)::int, 1)
    for i in range(32)], '') as payload_digest,
    min(page_id) over (partition by hex, html) as first_id
  from p)
select page_id, strlen(html) as payload_bytes, payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id = first_id then null else first_id end as refers_to
from b
"""
