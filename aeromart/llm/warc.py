"""WARC archives with a two-level capture index.

Archives: every task writes gzip members, one record each, into new files under the shared folder; the rows that a task
returns (key, id, file, offset, length) are the only list of what counts, so files of failed attempts are never read.
Payloads of ``LEAST_BYTES`` or more that are equal are stored once: the smallest page id is the response, the
others are revisits that refer to it.

Index: captures are sorted by key (reversed host, then path) over range partitions and cut into compressed blocks of
``BLOCK_LINES`` lines, one index file per partition. The first and last key of each block, with its place, make the sparse
directory, which ends the file. A lookup finds the index file from the first and last keys of all files (one row per
partition), binary-searches its directory, range-reads a block, searches it, and range-reads the record.

Null html counts as empty, null urls as the empty url. Rows with a null page id are written too: such a row is the response only if no
row with the same payload has an id. Rows that repeat the smallest id are all responses. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import bounded_batches, checked_bytes, shared_dir, written

LEAST_BYTES = 100
BLOCK_LINES = 1000
FILE_BYTES = 1 << 30
#: Bytes of an archive that are read in one go, about, and the most tasks that such stretches are dealt to.
STRETCH = 8 << 20
#: First and last keys of all index files, of which there is one per partition, on every executor.
FILES_BYTES = 64 << 20
MOST_TASKS = 20_000
DATE = "2024-01-01T00:00:00Z"
# Fixed value of the WARC standard: the profile of a revisit with an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def capture_key(url: str | None) -> str:
    """Host labels reversed and comma-joined, then ')' and the rest of the address, without scheme, port, fragment and 'www'."""
    rest = (url or "").strip().partition("#")[0]
    rest = rest.partition("://")[2] if "://" in rest else rest
    cut = next((i for i, c in enumerate(rest) if c in "/?"), len(rest))
    host, path = rest[:cut].rpartition("@")[2].partition(":")[0].lower(), rest[cut:]
    return ",".join(reversed(host.removeprefix("www.").split("."))) + ")" + (path or "/")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _uri(folder: str) -> str:
    """pyarrow wants two slashes after the scheme of a local file."""
    return "file:///" + folder.removeprefix("file:").lstrip("/") if folder.startswith("file:") else folder


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member. A revisit keeps the HTTP header and leaves the payload out."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 3, mtime=0)


def parse(member: bytes) -> dict:
    """A record read back, checked against its own digest."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.partition(b": ")[2]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    number = lambda field: int(x) if (x := fields.get(field, "").removeprefix("<urn:page:")[:-1]) else None
    if fields["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't match its digest")
    return {
        "page_id": number("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "payload_bytes": length,
        "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"), "payload": payload,
    }


def revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to): the response's id where the row is a revisit. Only payloads that repeat are joined to."""
    html = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"), F.sha2(html, 256).alias("digest")
    )
    long = pages.where(F.octet_length("html") >= least_bytes)
    first = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1 and first is not null").select("digest", "first")
    joined = pages.join(first, "digest", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes (page_id, url, html, refers_to) as archives below ``folder``; returns the captures (key, page_id, file, offset, length)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(_uri(folder))
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                made = []
                for page_id, url, html, refers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    member = record(page_id, url, html.encode(), refers)
                    out.write(member)
                    made.append((capture_key(url), page_id, name, at, len(member)))
                    at += len(member)
                if made:
                    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                    names = ["key", "page_id", "file", "offset", "length"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)
        finally:
            if out is not None:
                out.close()

    bounded_batches(rows.sparkSession)
    return rows.select("page_id", "url", "html", "refers_to").mapInArrow(
        write, "key string, page_id bigint, file string, offset bigint, length bigint"
    )


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sorted, compressed blocks below ``folder``; returns the sparse directory (first_key, last_key, file, offset, length, lines)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(_uri(folder))
        fs.create_dir(root, recursive=True)
        name, at, held, out = f"{uuid.uuid4().hex}.cdx", 0, [], None
        made: list[tuple] = []

        def flush(lines: list[list]) -> None:
            nonlocal at, out
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            block = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), 3)
            out.write(block)
            made.append((lines[0][0], lines[-1][0], name, at, len(block), len(lines)))
            at += len(block)

        try:
            for batch in batches:
                held += map(list, zip(*(batch.column(i).to_pylist() for i in range(5))))
                while len(held) >= block_lines:
                    flush(held[:block_lines])
                    held = held[block_lines:]
            if held:
                flush(held)
            if out is not None:
                foot = zlib.compress(json.dumps([m[:2] + m[3:5] for m in made]).encode(), 3)
                out.write(foot + struct.pack(">q", len(foot)))
        finally:
            if out is not None:
                out.close()
        if made:
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["first_key", "last_key", "file", "offset", "length", "lines"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)

    order = ["key", "page_id", "file", "offset"]
    columns = captures.select("key", "page_id", "file", "offset", "length")
    return columns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        write, "first_key string, last_key string, file string, offset bigint, length bigint, lines bigint"
    )


class Archive:
    """What :func:`build` made: folders, and the directory as a table. ``read_tasks``: among how many tasks reads are dealt."""

    def __init__(self, records: str, index: str, directory: DataFrame, read_tasks: int = 1):
        self.records, self.index, self.directory, self.read_tasks = records, index, directory, max(1, read_tasks)

    def captures(self) -> DataFrame:
        """All captures, from the index blocks: the directory is dealt out and every block is one range read."""
        folder = _uri(self.index)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for place in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    lines = _block(folder, *place)
                    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                    names = ["key", "page_id", "file", "offset", "length"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines), types)], names=names)

        dealt = self.directory.select("file", "offset", "length").repartition(self.read_tasks, "file", "offset")
        return dealt.mapInArrow(read, "key string, page_id bigint, file string, offset bigint, length bigint")

    def read_all(self, payload: bool = False) -> DataFrame:
        """Every record, by range reads at the places the index gives, in file order."""
        return _records(self.captures().select("file", "offset", "length"), _uri(self.records), payload, self.read_tasks)

    def lookup(self, urls: DataFrame, payload: bool = True) -> DataFrame:
        """Records of the captures of ``urls`` (column url)."""
        folder = _uri(self.index)
        ends = self.directory.groupBy("file").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))
        files = [tuple(r) for r in ends.select("low", "high", "file").orderBy("low", "high", "file").collect()]
        checked_bytes(sum(len(a) + len(b) + len(c) for a, b, c in files), FILES_BYTES, "the list of index files")
        held = urls.sparkSession.sparkContext.broadcast(files)

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lows, highs = [f[0] for f in held.value], [f[1] for f in held.value]
            for batch in batches:
                found = [
                    (f[2], key) for key in {capture_key(u) for u in batch.column(0).to_pylist()}
                    for f in held.value[bisect_left(highs, key) : bisect_right(lows, key)]
                ]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["file", "key"])

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = []
                for file, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    entries = _directory(folder, file)
                    first = bisect_left(entries, key, key=lambda e: e[1])
                    for entry in entries[first : bisect_right(entries, key, key=lambda e: e[0])]:
                        lines = _block(folder, file, *entry[2:])
                        own = lines[bisect_left(lines, key, key=lambda x: x[0]) : bisect_right(lines, key, key=lambda x: x[0])]
                        made += [line[2:] for line in own]
                if made:
                    types = [pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*made), types)], names=["file", "offset", "length"]
                    )

        routed = urls.select("url").distinct().mapInArrow(route, "file string, key string").distinct()
        dealt = routed.repartition(self.read_tasks, "file", F.pmod(F.xxhash64("key"), F.lit(16))).sortWithinPartitions("file", "key")
        places = dealt.mapInArrow(search, "file string, offset bigint, length bigint")
        return _records(places.distinct(), _uri(self.records), payload, self.read_tasks)


@lru_cache(maxsize=8)
def _directory(folder: str, file: str) -> list[list]:
    """The sparse directory at the end of an index file: first key, last key, offset, length of each block."""
    fs, root = _open(folder)
    with fs.open_input_file(f"{root}/{file}") as source:
        end = source.size() - 8
        (size,) = struct.unpack(">q", source.read_at(8, end))
        return json.loads(zlib.decompress(source.read_at(size, end - size)))


@lru_cache(maxsize=64)
def _block(folder: str, file: str, offset: int, length: int) -> list[list]:
    fs, root = _open(folder)
    with fs.open_input_file(f"{root}/{file}") as source:
        return [json.loads(x) for x in zlib.decompress(source.read_at(length, offset)).decode().split("\n")]


def _records(places: DataFrame, folder: str, payload: bool, tasks: int) -> DataFrame:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payload
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        name, source = None, None
        try:
            for batch in batches:
                rows = []
                for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if file != name:
                        if source is not None:
                            source.close()
                        name, source = file, fs.open_input_file(f"{root}/{file}")
                    found = parse(source.read_at(length, offset))
                    rows.append([found[n] for n in names])
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        finally:
            if source is not None:
                source.close()

    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    # A task reads stretches of files in order. The number of tasks is set from the bytes of the archives: places
    # are so small that AQE would hand all of them to one task.
    dealt = places.repartition(tasks, "file", F.floor(F.col("offset") / STRETCH)).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, schema + ", payload binary" * payload)


def build(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> Archive:
    """Archives and index of ``pages`` (page_id, url, html) in the shared folder."""
    base = shared_dir(pages.sparkSession, "warc")
    captures = written(write_archives(revisits(pages, least_bytes), f"{base}/records"), "captures")
    directory = written(write_index(captures, f"{base}/index"), "directory")
    size = captures.agg(F.sum("length")).first()[0] or 0
    return Archive(f"{base}/records", f"{base}/index", directory, min(MOST_TASKS, -(-size // STRETCH)))
