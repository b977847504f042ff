"""Web archives packed in ZIP files: written one per task, read back by byte ranges.

An archive is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz`` (one
gzip member per record), ``indexes/index.cdxj`` (a line per record with its place and length) and
``datapackage.json``. So a record is a range of the ZIP file: the reader takes the file's end, its
central directory (of 64-bit form where needed), the local header of each member wanted and the index, and
then only the ranges of records. Nothing is unpacked. Spark deals out the records, by
archives when writing and by ranges of the index when reading.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardline.llm.text import map_batches, materialise, scratch_dir

RECORDS = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
#: Fixed values of the WARC and ZIP formats.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_DATE = "2024-01-01T00:00:00Z"
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF
#: Records beside each other in an archive that are fetched in one go, and their bytes; bytes of an archive.
RUN_RECORDS = 256
ARCHIVE_BYTES = 64 << 20
RUN_BYTES = 4 << 20


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system that a URI or an absolute path names, and the path in it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:/", "file:///", 1))


class ZipWriter:
    """Stored members, written in one pass; sizes follow in 64-bit fields where they need them."""

    def __init__(self, sink: io.RawIOBase):
        self._sink, self._at, self._members = sink, 0, []

    def _put(self, data: bytes) -> None:
        self._sink.write(data)
        self._at += len(data)

    def add(self, name: str, chunks: Iterator[bytes], size: int, crc: int) -> None:
        raw, at = name.encode(), self._at
        extra = struct.pack("<HHQQ", 1, 16, size, size) if size >= _MAX32 else b""
        shown = _MAX32 if extra else size
        self._put(struct.pack("<4sHHHHHIIIHH", _LOCAL, 45, 0x800, 0, 0, 0x21, crc, shown, shown, len(raw), len(extra)) + raw + extra)
        for chunk in chunks:
            self._put(chunk)
        self._members.append((raw, size, crc, at))

    def close(self) -> None:
        begin = self._at
        for raw, size, crc, at in self._members:
            wide = struct.pack("<QQ", size, size) * (size >= _MAX32) + struct.pack("<Q", at) * (at >= _MAX32)
            extra = struct.pack("<HH", 1, len(wide)) + wide if wide else b""
            shown, place = min(size, _MAX32), min(at, _MAX32)
            self._put(
                struct.pack("<4sHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 0x800, 0, 0, 0x21, crc, shown, shown, len(raw), len(extra), 0, 0, 0, 0, place)
                + raw + extra
            )
        size, count, end = self._at - begin, len(self._members), self._at
        if begin >= _MAX32 or size >= _MAX32 or count >= _MAX16:
            self._put(struct.pack("<4sQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, count, count, size, begin))
            self._put(struct.pack("<4sIQI", _LOCATOR, 0, end, 1))
        self._put(struct.pack("<4sHHHHIIH", _END, 0, 0, min(count, _MAX16), min(count, _MAX16), min(size, _MAX32), min(begin, _MAX32), 0))


def zip_members(read: Callable[[int, int], bytes], length: int) -> dict[str, tuple[int, int]]:
    """Place and size of the stored members of a ZIP file, from its directory.

    ``read(offset, size)`` gives bytes of the file. Members that are deflated or encrypted are not listed.
    """
    tail_at = max(0, length - 22 - _MAX16)
    tail = read(tail_at, length - tail_at)
    # A comment may hold the mark: the true record is the last whose comment ends with the file.
    at = tail.rfind(_END)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    count, size, begin = struct.unpack_from("<HII", tail, at + 10)
    if count == _MAX16 or size == _MAX32 or begin == _MAX32:
        locator = read(tail_at + at - 20, 20)
        if locator[:4] == _LOCATOR:
            (place,) = struct.unpack_from("<Q", locator, 8)
            record = read(place, 56)
            if record[:4] != _END64:
                raise ValueError("no 64-bit end of the ZIP directory")
            count, size, begin = struct.unpack_from("<QQQ", record, 32)
    directory, members, at = read(begin, size), {}, 0
    for _ in range(count):
        if directory[at : at + 4] != _CENTRAL:
            raise ValueError("broken ZIP directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, names, extras, notes = struct.unpack_from("<IIHHH", directory, at + 20)
        (place,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + names].decode()
        extra, k = directory[at + 46 + names : at + 46 + names + extras], 0
        while k + 4 <= len(extra):
            kind, width = struct.unpack_from("<HH", extra, k)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, k + 4))
                plain = next(wide) if plain == _MAX32 else plain
                packed = next(wide) if packed == _MAX32 else packed
                place = next(wide) if place == _MAX32 else place
            k += 4 + width
        if method == 0 and not flags & 1:
            local = read(place, 30)
            if local[:4] != _LOCAL:
                raise ValueError("broken local header")
            members[name] = place + 30 + sum(struct.unpack_from("<HH", local, 26)), packed
        at += 46 + names + extras + notes
    return members


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page))}>"


def record(page: object, url: str | None, payload: bytes, digest: str, refers_to: object | None, stated: int) -> bytes:
    """One WARC record: a response, or a revisit that keeps the response's header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % stated
    body = http + (b"" if refers_to is not None else payload)
    address = "".join((url or "about:blank").split()) or "about:blank"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {ARCHIVE_DATE}",
        f"WARC-Target-URI: {address}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([] if page is None else [f"WARC-Page-ID: {page}"]),
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Named fields, HTTP header and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def with_originals(pages: DataFrame, *, key: str, source: str, min_bytes: int) -> DataFrame:
    """Pages with ``__digest`` and ``__refers_to``: the largest key of equal payloads, null for that page itself."""
    body = F.encode(F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")), "UTF-8")
    marked = pages.withColumn("__digest", F.sha1(body)).withColumn("__long", F.octet_length(body) >= min_bytes)
    originals = marked.filter("__long").groupBy("__digest").agg(F.max(F.col(f"`{key}`")).alias("__original"), F.count("*").alias("__n"))
    # Written first: its size tells Spark whether pages have to be shuffled to meet it.
    originals = materialise(originals.filter("__n > 1").select("__digest", "__original"), "originals")
    refers = F.when(F.col("__long") & ~F.col(f"`{key}`").eqNullSafe(F.col("__original")), F.col("__original"))
    return marked.join(originals, "__digest", "left").withColumn("__refers_to", refers)


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    key: str = "page_id",
    url: str = "url",
    source: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write ZIP-packed archives below ``folder``; returns file and records, evaluated once by the caller.

    A task writes an archive whenever it holds ``archive_bytes`` bytes of records, which bounds its memory.

    Of equal payloads of at least ``min_bytes`` bytes the page with the largest key is the response
    and the others revisit it; all rows of that key are responses. A null page is an empty payload, a null
    key comes before all others. Each task writes under a name of its own attempt and is
    listed by its result row only, so what a lost task leaves behind is never read.
    """
    rows = with_originals(pages, key=key, source=source, min_bytes=min_bytes).select(
        F.col(f"`{key}`").cast("string"), F.col(f"`{url}`").cast("string"), F.col(f"`{source}`").cast("string"),
        F.col("__refers_to").cast("string"),
    )

    def archive(packed: list[bytes], index: list[str]) -> pa.RecordBatch:
        lines = "\n".join(index).encode() + b"\n"
        package = json.dumps({"profile": "data-package", "resources": [{"path": RECORDS}, {"path": INDEX}]}).encode()
        crc = 0
        for part in packed:
            crc = zlib.crc32(part, crc)
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.wacz"
        with system.open_output_stream(f"{base}/{name}") as sink:
            out = ZipWriter(sink)
            out.add(RECORDS, iter(packed), sum(map(len, packed)), crc)
            out.add(INDEX, iter([lines]), len(lines), zlib.crc32(lines))
            out.add("datapackage.json", iter([package]), len(package), zlib.crc32(package))
            out.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([len(index)], pa.int64())], names=["file", "records"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed: list[bytes] = []
        index: list[str] = []
        at = 0
        for batch in batches:
            for page, address, text, original in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                payload = (text or "").encode()
                digest = payload_digest(payload)
                packed.append(gzip.compress(record(page, address, payload, digest, original, len(payload)), 1, mtime=0))
                index.append(json.dumps({"page": page, "offset": at, "length": len(packed[-1])}))
                at += len(packed[-1])
                if at >= archive_bytes:
                    yield archive(packed, index)
                    packed, index, at = [], [], 0
        if index:
            yield archive(packed, index)

    return map_batches(rows, run, "file string, records bigint")


def _ranges(handle: pa.NativeFile) -> Callable[[int, int], bytes]:
    def read(offset: int, size: int) -> bytes:
        handle.seek(offset)
        return handle.read(size)

    return read


def read_index(files: DataFrame) -> DataFrame:
    """Runs of neighbouring records (file, start, size, places) from the index members of archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = file_system(uri)
                with system.open_input_file(path) as handle:
                    read = _ranges(handle)
                    members = zip_members(read, handle.size())
                    base, _ = members[RECORDS]
                    entries = [json.loads(line) for line in read(*members[INDEX]).splitlines()]
                out: list[tuple[int, int, list]] = []
                run_of: list[dict] = []
                for k, entry in enumerate(entries):
                    run_of.append(entry)
                    size = entry["offset"] + entry["length"] - run_of[0]["offset"]
                    if size >= RUN_BYTES or len(run_of) >= RUN_RECORDS or k + 1 == len(entries):
                        first = run_of[0]["offset"]
                        out.append((base + first, size, [{"at": e["offset"] - first, "size": e["length"]} for e in run_of]))
                        run_of = []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uri] * len(out)), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                        pa.array([o[2] for o in out], pa.list_(pa.struct([("at", pa.int64()), ("size", pa.int64())]))),
                    ],
                    names=["file", "start", "size", "places"],
                )

    return map_batches(files.select("file"), run, "file string, start bigint, size bigint, places array<struct<at:bigint,size:bigint>>")


def read_records(spark: SparkSession, files: DataFrame, *, key_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to and, as asked for, payload.

    Runs of records are dealt out anew before they are fetched, so a large archive is read by many
    tasks. The digest of a response is counted again and must agree with the one it tells; a revisit
    tells the size and the digest of the full payload.
    """
    schema = "page string, url string, record_type string, payload_bytes bigint, payload_digest string, refers string"
    schema += ", payload binary" * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri, start, size, places in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                system, path = file_system(uri)
                with system.open_input_file(path) as handle:
                    data = _ranges(handle)(start, size)
                for place in places:
                    fields, http, payload = parse_record(gzip.decompress(data[place["at"] : place["at"] + place["size"]]))
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "response":
                        if payload_digest(payload) != digest:
                            raise ValueError(f"payload of {fields['warc-record-id']} does not agree with its digest")
                        stated = len(payload)
                    else:
                        stated = int(next(x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")))
                    row = (fields.get("warc-page-id"), fields["warc-target-uri"], fields["warc-type"], stated, digest, fields.get("warc-refers-to-page-id"))
                    rows.append((*row, payload) if with_payload else row)
            names = ["page", "url", "record_type", "payload_bytes", "payload_digest", "refers", "payload"][: 6 + with_payload]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(names))], names=names)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = read_index(files.repartition(parts, "file")).repartition(parts, "file", "start")
    found = map_batches(dealt, run, schema)
    rest = ["payload"] * with_payload
    return found.select(
        F.col("page").cast(key_type).alias("page_id"), "url", "record_type", "payload_bytes", "payload_digest",
        F.col("refers").cast(key_type).alias("refers_to"), *rest,
    )


def write_and_read(pages: DataFrame, *, key: str = "page_id", url: str = "url", source: str = "html", min_bytes: int = 0) -> DataFrame:
    """Archives written below the shared scratch folder and read back."""
    spark = pages.sparkSession
    folder = scratch_dir(spark, "archives")
    listed = scratch_dir(spark, "archive-list")
    write_archives(pages, folder, key=key, url=url, source=source, min_bytes=min_bytes).write.parquet(listed)
    files = spark.read.schema("file string, records bigint").parquet(listed)
    return read_records(spark, files, key_type=pages.schema[key].dataType.simpleString())
