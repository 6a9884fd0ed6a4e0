"""Web pages as WARC records in ZIP packages, and a reader that never unpacks them.

**Writing.** Records of equal payload of at least ``least`` bytes are one response, that with the
largest page id, and revisits that refer to it; all others are responses. Every task writes packages
of bounded size to the shared folder: a stored member with the records, each a gzip member of its
own, and a stored CDXJ index of where they stand. A package counts only once its row is in the manifest
table, which Spark commits, so what a lost task left behind is never read.

**Reading.** A package is opened at its end: the end record, the ZIP64 end record if there is one, the
central directory, and the local header of the member wanted. Stored members are plain byte ranges of
the package, so the indexes and then the records are read by range, neighbours together, a few megabytes
at a time. Nothing is extracted. Packages of others are read alike: archives and indexes are located in
the directory by their folders, records by the CDXJ lines of all indexes, and archives that no index
names are walked from record to record.

Packages are read and written with Arrow's file systems (file, s3, gs, hdfs and so on), by the URI of
the folder that all executors share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.sources.scratch import Scratch

RECORDS, INDEX = "archive/records.warc.gz", "indexes/index.cdxj"
# Where packages keep archives and indexes, and what these end in.
ARCHIVES, ARCHIVE_ENDS = "archive/", (".warc", ".warc.gz")
INDEXES, INDEX_ENDS = "indexes/", (".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz")
# Fixed values of the ZIP format: signatures, and the numbers that say "see the ZIP64 field".
LOCAL, CENTRAL, END, END64, LOCATOR = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
# Fixed values of the WARC format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_AT_ONCE = 4 << 20


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a Hadoop path or URI."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# ---- ZIP packages


def zip_package(members: list[tuple[str, list[bytes]]], limit: int = FULL32) -> Iterator[bytes]:
    """The bytes of a ZIP file with stored members; sizes and places from ``limit`` on as ZIP64."""
    directory, at = [], 0
    for name, parts in members:
        raw = name.encode()
        crc, size = 0, 0
        for part in parts:
            crc, size = zlib.crc32(part, crc), size + len(part)
        big, far = size >= limit, at >= limit
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
        shown = FULL32 if big else size
        version = 45 if big or far else 20
        yield struct.pack(
            "<IHHHHHIIIHH", LOCAL, version, 0x800, 0, 0, 33, crc, shown, shown, len(raw), len(extra)
        ) + raw + extra
        yield from parts
        wide = (struct.pack("<QQ", size, size) if big else b"") + (struct.pack("<Q", at) if far else b"")
        more = struct.pack("<HH", 1, len(wide)) + wide if wide else b""
        directory.append(
            struct.pack(
                "<IHHHHHHIIIHHHHHII", CENTRAL, version, version, 0x800, 0, 0, 33, crc, shown, shown,
                len(raw), len(more), 0, 0, 0, 0, FULL32 if far else at,
            ) + raw + more
        )
        at += 30 + len(raw) + len(extra) + size
    central = b"".join(directory)
    yield central
    count, size = len(directory), len(central)
    if at >= limit or size >= limit or count >= FULL16:
        yield struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, count, count, size, at)
        yield struct.pack("<IIQI", LOCATOR, 0, at + size, 1)
        count, size, at = min(count, FULL16), FULL32, FULL32
    yield struct.pack("<IHHHHIIH", END, 0, 0, count, count, size, at, 0)


class ZipReader:
    """Byte ranges of the stored members of a ZIP file, from its directory."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.members = {name: place for name, place in self._directory()}

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def _directory(self) -> Iterator[tuple[str, tuple[int, int, int]]]:
        tail_at = max(0, self.size - 22 - FULL16)
        tail = self._read(tail_at, self.size - tail_at)
        end = tail.rfind(struct.pack("<I", END))
        if end < 0:
            raise ValueError("no end record: not a ZIP file")
        count, size, at = struct.unpack_from("<HII", tail, end + 10)
        locator_at = tail_at + end - 20
        if locator_at >= 0:
            signature, _, end64, _ = struct.unpack("<IIQI", self._read(locator_at, 20))
            if signature == LOCATOR:
                fields = struct.unpack("<IQHHIIQQQQ", self._read(end64, 56))
                if fields[0] != END64:
                    raise ValueError("the locator does not lead to a ZIP64 end record")
                count, size, at = fields[7:]
        central, p = self._read(at, size), 0
        for _ in range(count):
            fields = struct.unpack_from("<IHHHHHHIIIHHHHHII", central, p)
            if fields[0] != CENTRAL:
                raise ValueError("damaged central directory")
            method, packed, size, n, m, k, header = (fields[i] for i in (4, 8, 9, 10, 11, 12, 16))
            name = central[p + 46 : p + 46 + n].decode()
            extra = central[p + 46 + n : p + 46 + n + m]
            packed, size, header = self._wide(extra, packed, size, header)
            yield name, (method, header, packed)
            p += 46 + n + m + k

    @staticmethod
    def _wide(extra: bytes, packed: int, size: int, header: int) -> tuple[int, int, int]:
        """The ZIP64 field holds, in this order, those of the values that did not fit."""
        p = 0
        while p + 4 <= len(extra):
            tag, length = struct.unpack_from("<HH", extra, p)
            if tag == 1:
                values = iter(struct.unpack_from(f"<{length // 8}Q", extra, p + 4))
                size = next(values) if size == FULL32 else size
                packed = next(values) if packed == FULL32 else packed
                header = next(values) if header == FULL32 else header
            p += 4 + length
        return packed, size, header

    def range(self, name: str) -> tuple[int, int]:
        """(place, size) of a stored member's bytes in the file."""
        method, header, size = self.members[name]
        if method:
            raise ValueError(f"{name} is compressed in its package; only stored members have ranges")
        fields = struct.unpack("<IHHHHHIIIHH", self._read(header, 30))
        if fields[0] != LOCAL:
            raise ValueError("damaged local header")
        return header + 30 + fields[9] + fields[10], size

    def read(self, name: str) -> bytes:
        return self._read(*self.range(name))

    def text(self, name: str) -> bytes:
        """A small member whole, whether its package or itself is compressed."""
        method, header, size = self.members[name]
        if method == zipfile.ZIP_DEFLATED:
            n, m = struct.unpack_from("<HH", self._read(header, 30), 26)
            data = zlib.decompress(self._read(header + 30 + n + m, size), -zlib.MAX_WBITS)
        else:
            data = self.read(name)
        return gzip.decompress(data) if name.endswith(".gz") else data

    def archives(self) -> list[str]:
        return [n for n in self.members if n.startswith(ARCHIVES) and n.endswith(ARCHIVE_ENDS)]

    def indexes(self) -> list[str]:
        return [n for n in self.members if n.startswith(INDEXES) and n.endswith(INDEX_ENDS)]

    def records(self) -> Iterator[bytes]:
        """Every record of every archive, as it is stored: by the indexes, or else one after another."""
        places: dict[str, dict[int, int]] = {n: {} for n in self.archives()}
        short = {n.rsplit("/", 1)[1]: n for n in places}
        for index in self.indexes():
            for line in self.text(index).splitlines():
                brace = line.find(b"{")
                if brace < 0:
                    continue
                entry = json.loads(line[brace:])
                archive = short.get(entry["filename"].rsplit("/", 1)[-1])
                if archive is None:
                    raise ValueError(f"{index} names an archive that is not there: {entry['filename']}")
                places[archive][int(entry["offset"])] = int(entry["length"])
        for archive, found in places.items():
            yield from self.pieces(archive, sorted(found.items())) if found else self.walk(archive)

    def walk(self, name: str) -> Iterator[bytes]:
        """The records of an archive without an index, read a few megabytes at a time."""
        base, size = self.range(name)
        chunks = (
            self._read(base + at, min(READ_AT_ONCE, size - at)) for at in range(0, size, READ_AT_ONCE)
        )
        yield from gzip_members(chunks) if name.endswith(".gz") else plain_records(chunks)

    def pieces(self, name: str, ranges: list[tuple[int, int]]) -> Iterator[bytes]:
        """The bytes of ranges of a member, in order; close ones are read together."""
        base, _ = self.range(name)
        i = 0
        while i < len(ranges):
            j = i
            start, stop = ranges[i][0], ranges[i][0] + ranges[i][1]
            while j + 1 < len(ranges) and 0 <= ranges[j + 1][0] - stop <= 4096 and (
                ranges[j + 1][0] + ranges[j + 1][1] - start <= READ_AT_ONCE
            ):
                j += 1
                stop = ranges[j][0] + ranges[j][1]
            data = self._read(base + start, stop - start)
            for at, size in ranges[i : j + 1]:
                yield data[at - start : at - start + size]
            i = j + 1


# ---- WARC records


def gzip_members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The contents of each gzip member of a stream."""
    unpack, out = None, []
    for chunk in chunks:
        while chunk:
            unpack = unpack or zlib.decompressobj(16 + zlib.MAX_WBITS)
            out.append(unpack.decompress(chunk))
            if not unpack.eof:
                break
            yield b"".join(out)
            chunk, unpack, out = unpack.unused_data, None, []
    if unpack:
        raise ValueError("an archive ends within a record")


def plain_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream that is not compressed."""
    held = b""
    for chunk in chunks:
        held += chunk
        while (head := held.find(b"\r\n\r\n")) >= 0:
            length = re.search(rb"(?im)^content-length:\s*([0-9]+)", held[:head])
            if not length:
                raise ValueError("a WARC record without a length")
            end = head + 4 + int(length[1]) + 4
            if len(held) < end:
                break
            yield held[:end]
            held = held[end:]
    if held.strip():
        raise ValueError("an archive ends within a record")


def sort_key(url: str) -> str:
    """The key of a URL in a CDXJ index: its host from the top, then the rest."""
    parts = urlsplit(url)
    return ",".join(reversed((parts.hostname or "").split("."))) + ")" + (parts.path or "/") + (
        f"?{parts.query}" if parts.query else ""
    )


def index_line(url: str, sha1: str, place: int, length: int) -> bytes:
    """One line of a CDXJ index."""
    entry = {
        "url": url,
        "digest": f"sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
        "length": str(length),
        "offset": str(place),
        "filename": RECORDS.removeprefix(ARCHIVES),
    }
    return f"{sort_key(url)} 20240101000000 {json.dumps(entry)}\n".encode()


def quoted(url: str | None) -> str:
    return quote(url or "", safe=":/?#@!$&()*+,;=~")


def record(page, url: str | None, payload: bytes, sha1: str, refers_to, revisit: bool) -> bytes:
    """One WARC record, as a gzip member."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    )
    block = http.encode() + (b"" if revisit else payload)
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {quoted(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return gzip.compress("\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n", 3, mtime=0)


def _id_of(value: str | None) -> str | None:
    """A record id without its brackets and, if it is of a page here, without its prefix."""
    return (value or "").strip("<>").removeprefix("urn:page:") or None


def parse_record(data: bytes) -> dict:
    """Fields of a record, gzipped or not; a payload is checked against its length and digest.

    The payload is what follows the HTTP head, in records without one the whole block. Lengths and
    digests that the record does not give, or not as SHA-1, are taken from the payload.
    """
    raw = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {n.lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    kind, payload, length = fields["warc-type"], block, None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        given = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", http)
        length = int(given[1]) if given else None
    revisit = kind == "revisit"
    digest = fields.get("warc-payload-digest", "")
    sha1 = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
    if not revisit:
        found = hashlib.sha1(payload).hexdigest()
        wrong = length is not None and kind == "response" and len(payload) != length
        if wrong or (sha1 is not None and found != sha1):
            raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
        length, sha1 = len(payload), found
    return {
        "page": _id_of(fields["warc-record-id"]),
        "url": unquote(fields.get("warc-target-uri", "").strip("<>")),
        "bytes": length,
        "sha1": sha1,
        "type": kind,
        "refers_to": _id_of(fields.get("warc-refers-to")) if revisit else None,
        "payload": None if revisit else payload,
    }


# ---- jobs


@dataclass(frozen=True)
class WarcStore:
    """``least``: bytes from which equal payloads are revisits; ``package_bytes``: of one package."""

    least: int = 1000
    package_bytes: int = 64 << 20

    def decided(self, pages: DataFrame) -> DataFrame:
        """(page_id, url, payload, sha1, response): ``response`` is null unless the row revisits it.

        A null html is empty. Rows that repeat the largest page id are all responses. Null page ids
        revisit like others, and are responses where no equal payload has an id.
        """
        payload = F.coalesce("html", F.lit("")).cast("binary")
        rows = pages.select("page_id", "url", payload.alias("payload"))
        rows = rows.withColumn("sha1", F.sha1("payload"))
        long = F.octet_length("payload") >= self.least
        # stored, so that the join can be split where very many pages have one body
        best = Scratch.create(pages.sparkSession).keep(
            rows.filter(long)
            .groupBy("sha1")
            .agg(F.max("page_id").alias("best"), F.count("*").alias("n"))
            .filter("n > 1 AND best IS NOT NULL")
            .select(F.col("sha1").alias("sha1_"), "best"),
            "best",
        )
        return rows.join(best, long & (F.col("sha1") == F.col("sha1_")), "left").select(
            "page_id",
            "url",
            "payload",
            "sha1",
            F.when(~F.col("page_id").eqNullSafe(F.col("best")), F.col("best")).alias("response"),
        )

    def write(self, pages: DataFrame, scratch: Scratch) -> DataFrame:
        """Write the packages; the manifest (path, size, records)."""
        folder, most = f"{scratch.folder}/packages", self.package_bytes
        scratch.make("packages")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, root = file_system(folder)
            held: list[bytes] = []
            index: list[bytes] = []
            size = 0

            def close() -> pa.RecordBatch:
                path = f"{root}/{uuid.uuid4().hex}.wacz"
                total = 0
                with files.open_output_stream(path) as out:
                    for part in zip_package([(RECORDS, held), (INDEX, sorted(index))]):
                        out.write(part)
                        total += len(part)
                row = [[path], [total], [len(held)]]
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(row, (pa.string(), pa.int64(), pa.int64()))],
                    ["path", "size", "records"],
                )

            for batch in batches:
                for page, url, payload, sha1, response in zip(*batch.columns):
                    page, response = page.as_py(), response.as_py()
                    data = record(
                        page, url.as_py(), payload.as_py(), sha1.as_py(), response, response is not None
                    )
                    index.append(index_line(quoted(url.as_py()), sha1.as_py(), size, len(data)))
                    held.append(data)
                    size += len(data)
                    if size >= most:
                        yield close()
                        held, index, size = [], [], 0
            if held:
                yield close()

        rows = self.decided(pages).mapInArrow(run, "path string, size bigint, records bigint")
        return scratch.keep(rows, "manifest")

    def packages(self, spark: SparkSession, path: str) -> DataFrame:
        """The manifest (path, size) of packages of others, by a path or pattern; lists them only."""
        found = spark.read.format("binaryFile").load(path)
        return found.select("path", F.col("length").alias("size"))

    def read(self, manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
        """Every record of the packages: (page, url, bytes, sha1, type, refers_to[, payload]).

        Paths are URIs, or places in the file system of ``folder``. ``page`` is the id of the record.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, _ = file_system(folder)
            for batch in batches:
                for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    files, place = file_system(path) if ":/" in path else (own, path)
                    with files.open_input_file(place) as file:
                        found = map(parse_record, ZipReader(file, size).records())
                        yield from _rows(found, payloads)

        schema = "page string, url string, bytes bigint, sha1 string, type string, refers_to string"
        schema += ", payload binary" * payloads
        tasks = min(max(manifest.count(), 1), 20_000)
        return manifest.select("path", "size").repartition(tasks, "path").mapInArrow(run, schema)


def _rows(found: Iterator[dict], payloads: bool, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    kinds = dict.fromkeys(("page", "url", "bytes", "sha1", "type", "refers_to"), pa.string())
    kinds["bytes"] = pa.int64()
    if payloads:
        kinds["payload"] = pa.binary()
    while held := list(islice(found, rows)):
        columns = [pa.array([one[name] for one in held], kind) for name, kind in kinds.items()]
        yield pa.RecordBatch.from_arrays(columns, list(kinds))


def round_trip(pages: DataFrame, store: WarcStore | None = None) -> DataFrame:
    """Write all pages, read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    One row per page row, repeated ids included. An empty table gives an empty result; columns other
    than page_id, url and html are not read. A page is one record however long, held whole by its
    task. Page ids are numbers, or texts without line breaks and angle brackets; an empty text comes
    back as null.
    """
    store, scratch = store or WarcStore(), Scratch.create(pages.sparkSession)
    kind = pages.schema["page_id"].dataType
    manifest = store.write(pages, scratch)
    return store.read(manifest, f"{scratch.folder}/packages").select(
        F.col("page").cast(kind).alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("sha1").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
