"""Web archives: WARC files of records, and a two-level index of what they capture.

Records are gzip members of their own, so one record is a range of bytes. The index sorts captures by
their URL with the host reversed and cuts the sorted lines into compressed blocks; a directory keeps
the first key of every block. A look-up searches the list of index files, then a file's directory,
and reads the one block and then the one record it needs.

Archives and index lie in a folder that all executors reach (any store that pyarrow and Hadoop both
know). A file's name is new with every attempt of a task, and only files that the written list of
captures names are ever read, so tasks may fail and run again.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlane.llm.common import join_unique, kept_table, partitions

RECORD_END = b"\r\n\r\n"
ARCHIVE_BYTES = 1 << 30
BLOCK_LINES = 300
DATE = "2025-01-01T00:00:00Z"
CAPTURES = (
    "page_id long, url string, key string, file string, offset long, length long, digest string"
)
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base-32 SHA-1: five hexadecimal digits are four of base 32."""
    digits = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), CONV_DIGITS, BASE32)


def reversed_key(url: str | None, page_id: int | None) -> str:
    """Sort key of a capture: host labels from the last to the first, port, path and query, then the
    page. Scheme, user and fragment do not count; a URL without a host keeps its text. What separates
    fields or lines of the index is escaped."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        host = ""
    if host:
        query = f"?{parts.query}" if parts.query else ""
        site = ",".join(reversed(host.split(".")))
        place = f"{site}{port}){parts.path or '/'}{query}"
    else:
        place = text
    for character in "% \t\n\r":
        place = place.replace(character, f"%{ord(character):02X}")
    number = "-" if page_id is None else f"{page_id + (1 << 63):020d}"
    return f"{place} {number}"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def record(page: dict) -> bytes:
    """A WARC record; a revisit carries the HTTP head only."""
    payload = page["payload"].encode()
    revisit = page["refers_to"] is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http if revisit else http + payload
    number = "none" if page["page_id"] is None else page["page_id"]
    target = (page["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.0",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{number}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{page['digest']}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{page['refers_to']}>",
        ]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + RECORD_END


def squeezed(data: bytes) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def warcinfo() -> bytes:
    body = b"format: WARC File Format 1.0\r\n"
    head = (
        f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <{uuid.uuid4().urn}>\r\n"
        f"WARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\n"
        f"Content-Length: {len(body)}\r\n\r\n"
    )
    return head.encode() + body + RECORD_END


def parsed(data: bytes) -> dict:
    """The fields of one record (unpacked), its HTTP head and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    inner = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return {"fields": fields, "http": inner, "payload": payload}


def page_number(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").rpartition(":")[2]
    return int(number) if number.lstrip("-").isdigit() else None


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): of equal payloads of at least ``min_bytes`` bytes
    the largest page_id is kept in full, the others refer to it. A null payload counts as empty.

    Rows of equal payload and the same, largest id all stay in full. A page without an id refers to
    one that has an id. Only digests and ids meet to find copies; those that hold over 1/HEAVY of
    the pages are joined by broadcast.
    """
    payload = F.coalesce("html", F.lit(""))
    full = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", base32_sha1(F.col("payload"))
    )
    large = full.select("page_id", "digest").where(F.octet_length("payload") >= min_bytes)
    copies = (
        large.groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("key_rows"))
        .where("key_rows > 1 and response_id is not null")
    )
    joined = join_unique(full, copies, "digest", pages.count())
    later = F.coalesce(F.col("page_id") < F.col("response_id"), F.col("response_id").isNotNull())
    return joined.select(
        "page_id", "url", "payload", "digest", F.when(later, F.col("response_id")).alias("refers_to")
    )


def write_archives(records: DataFrame, folder: str, max_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records as WARC files below ``folder``; where each lies comes back as a table."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)
        stream, name, at = None, "", 0
        for batch in batches:
            out = []
            for page in batch.to_pylist():
                if stream is None or at >= max_bytes:
                    if stream is not None:
                        stream.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    store.create_dir(path, recursive=True)
                    stream = store.open_output_stream(f"{path}/{name}", compression=None)
                    at += stream.write(squeezed(warcinfo()))
                data = squeezed(record(page))
                key = reversed_key(page["url"], page["page_id"])
                out.append((page["page_id"], page["url"], key, name, at, len(data), page["digest"]))
                at += stream.write(data)
            columns = list(zip(*out, strict=True)) or [[]] * 7
            types = [pa.int64(), *[pa.string()] * 3, pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["page_id", "url", "key", "file", "offset", "length", "digest"],
            )
        if stream is not None:
            stream.close()

    return kept_table(records.mapInArrow(write, CAPTURES), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write captures as sorted index files of compressed blocks, each with its block directory.

    Returns (first, last, file), a row per index file. Keys end in the page, so even captures of one
    URL are spread over files.
    """
    spark = captures.sparkSession
    dealt = captures.repartitionByRange(
        partitions(spark), "key", "file", "offset"
    ).sortWithinPartitions("key", "file", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)
        directory: list[list] = []
        lines: list[str] = []
        stream, name, at, last = None, "", 0, ""

        def flush() -> int:
            data = squeezed("\n".join(lines).encode())
            directory.append([lines[0].split("\t", 1)[0], at, len(data)])
            lines.clear()
            return stream.write(data)

        for batch in batches:
            for row in batch.to_pylist():
                if stream is None:
                    name = f"{uuid.uuid4().hex}.cdx.gz"
                    store.create_dir(path, recursive=True)
                    stream = store.open_output_stream(f"{path}/{name}", compression=None)
                last = row["key"]
                lines.append("\t".join([last, row["file"], str(row["offset"]), str(row["length"])]))
                if len(lines) >= block_lines:
                    at += flush()
        if stream is not None:
            if lines:
                at += flush()
            stream.close()
            with store.open_output_stream(f"{path}/{name}.directory", compression=None) as out:
                out.write(json.dumps(directory).encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (directory[0][0], last, name)], ["first", "last", "file"]
            )

    return kept_table(dealt.mapInArrow(write, "first string, last string, file string"), "index")


class Index:
    """Look-ups in index files. ``files``: (first key, last key, name), sorted."""

    def __init__(self, folder: str, files: list[tuple[str, str, str]]):
        self.store, self.path = opened(folder)
        self.files = files
        self.lasts = [last for _, last, _ in files]
        self.name = self.block = None

    def lines(self, number: int, key: str) -> Iterator[list[str]]:
        """Lines of a file from the block that may hold ``key`` on."""
        name = self.files[number][2]
        if name != self.name:
            with self.store.open_input_stream(
                f"{self.path}/{name}.directory", compression=None
            ) as source:
                self.directory = json.loads(source.read())
            self.firsts = [first for first, _, _ in self.directory]
            self.input = self.store.open_input_file(f"{self.path}/{name}")
            self.name, self.block = name, None
        # The first block whose successor starts at the key or beyond.
        place = max(0, bisect.bisect_left(self.firsts, key) - 1)
        for block in range(place, len(self.directory)):
            if self.firsts[block] > key:
                return
            if block != self.block:
                _, offset, length = self.directory[block]
                data = zlib.decompress(self.input.read_at(length, offset), 31)
                self.rows = [line.split("\t") for line in data.decode().split("\n")]
                self.keys = [row[0] for row in self.rows]
                self.block = block
            start = bisect.bisect_left(self.keys, key)
            yield from self.rows[start : bisect.bisect_right(self.keys, key)]

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of every capture of the key."""
        number = bisect.bisect_left(self.lasts, key)
        while number < len(self.files) and self.files[number][0] <= key:
            for _, file, offset, length in self.lines(number, key):
                yield file, int(offset), int(length)
            number += 1


def find_captures(wanted: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """(file, offset, length) of all captures of the index keys (column key) that ``wanted`` holds; for a
    page's key see ``reversed_key``.

    Look-ups are dealt and sorted by the key that the index is sorted by, so a task opens few index
    files and reads each block once. ``index`` has one row per index file and is the only thing each
    task gets whole.
    """
    spark = wanted.sparkSession
    files = sorted((r.first, r.last, r.file) for r in index.toLocalIterator())
    by_key = wanted.select("key").distinct()
    dealt = by_key.repartitionByRange(partitions(spark), "key").sortWithinPartitions("key")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = Index(folder, files)
        for batch in batches:
            rows = [capture for key in batch["key"].to_pylist() for capture in where.find(key)]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)],
                ["file", "offset", "length"],
            )

    found = dealt.mapInArrow(find, "file string, offset long, length long")
    # Different URLs may share a key (scheme, fragment), and each then finds the captures of all.
    return found.distinct()


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """Range-read records: (page_id, url, record_type, refers_to, payload_bytes, payload_digest,
    payload). A payload that does not have the digest its record names is an error.

    Reads go through each file from front to back.
    """
    spark = captures.sparkSession
    dealt = captures.repartitionByRange(
        partitions(spark), "file", "offset"
    ).sortWithinPartitions("file", "offset")
    schema = (
        "page_id long, url string, record_type string, refers_to long, payload_bytes long,"
        " payload_digest string, payload binary"
    )
    types = [
        pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()
    ]
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)
        name, source = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                rows = []
                for place in batch.slice(start, 500).to_pylist():
                    if place["file"] != name:
                        name = place["file"]
                        source = store.open_input_file(f"{path}/{name}")
                    found = parsed(zlib.decompress(source.read_at(place["length"], place["offset"]), 31))
                    fields, payload = found["fields"], found["payload"]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{name} at {place['offset']}: payload and digest differ")
                    rows.append((
                        page_number(fields["WARC-Record-ID"]),
                        fields["WARC-Target-URI"],
                        kind,
                        page_number(fields.get("WARC-Refers-To")),
                        len(payload) if kind == "response" else int(found["http"]["Content-Length"]),
                        digest,
                        payload if kind == "response" else None,
                    ))
                columns = list(zip(*rows, strict=True)) or [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
                )

    return dealt.mapInArrow(read, schema)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI that names its store."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    text = store.makeQualified(path).toString()
    return f"file://{text[5:]}" if text.startswith("file:/") and text[6:7] != "/" else text


def archived(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) below ``folder``, index the archives, and read every
    page's records back through the index: the rows of ``read_records``.

    Null URLs and payloads count as empty, repeated rows are archived as often as they occur, and an
    empty table writes no file and gives no row. Other columns are left out. A record that the index
    does not find again is an error.
    """
    folder = qualified(pages.sparkSession, folder)
    captures = write_archives(with_revisits(pages, min_bytes), f"{folder}/archives")
    index = write_index(captures, f"{folder}/index")
    found = kept_table(find_captures(captures.select("page_id", "key"), index, f"{folder}/index"), "found")
    n_written, n_found = captures.count(), found.count()
    if n_found != n_written:
        raise ValueError(f"{n_written} records archived, but {n_found} found by the index")
    return read_records(found, f"{folder}/archives")
