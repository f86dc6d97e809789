"""WARC archives compressed with zstandard.

An archive starts with a skippable frame that holds a dictionary; then follows one frame for each record, so
that records can be read one by one. Tasks write archives of bounded size into a shared folder and report what
they wrote; reading goes through Spark's binary files, archive by archive.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import pieces, shared_folder

#: Magic number of the skippable frame that holds the dictionary.
SKIPPABLE = 0x184D2A5D
MAGIC = b"\x28\xb5\x2f\xfd"
#: Payload bytes after which a task begins a new archive.
ROLL = 16 << 20
#: Records of an archive that its dictionary is trained on, and their bytes at most.
TRAIN_RECORDS = 200
TRAIN_BYTES = 2 << 20
DICTIONARY = 16 << 10
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
SMALLEST = 100
TYPES = ("response", "revisit")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Damaged(ValueError):
    """An archive or record that is not valid."""


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """One WARC record. A revisit has the HTTP headers but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {TYPES[revisit]}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        plain = url.isprintable() and url.isascii() and url == url.strip() and url
        head.append(f"WARC-Target-URI: {url}" if plain else f"X-Target-URI-JSON: {json.dumps(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Fields of a record, after its headers, lengths and digest have been checked."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise Damaged("no WARC header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip() or name.lower() in fields:
            raise Damaged(f"header line {line!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise Damaged(f"no {name}")
    if fields["warc-type"] not in TYPES:
        raise Damaged(f"type {fields['warc-type']}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise Damaged("length of the block")
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    if not found or not http.startswith(b"HTTP/1."):
        raise Damaged("no HTTP header")
    sizes = [x.split(b":", 1)[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if len(sizes) != 1 or not sizes[0].isdigit():
        raise Damaged("length of the payload")
    size, revisit = int(sizes[0]), fields["warc-type"] == "revisit"
    name, _, digest = fields["warc-payload-digest"].partition(":")
    if name != "sha256" or len(digest) != 64:
        raise Damaged("digest")
    if revisit and (payload or "warc-profile" not in fields or "x-refers-to-page-id" not in fields):
        raise Damaged("revisit")
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise Damaged("payload does not have its length or digest")
    url = json.loads(fields["x-target-uri-json"]) if "x-target-uri-json" in fields else fields.get("warc-target-uri")
    return {
        "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None,
        "url": url,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": int(fields["x-refers-to-page-id"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def _trained(records: list[bytes]) -> bytes:
    samples, room = [], TRAIN_BYTES
    for r in records[:TRAIN_RECORDS]:
        room -= len(r)
        if room < 0:
            break
        samples.append(r)
    if len(samples) > 20 and sum(map(len, samples)) > 10 * DICTIONARY:
        return zstd.train_dictionary(DICTIONARY, samples, k=200, d=8).as_bytes()
    return b"".join(samples)[-DICTIONARY:]


def packed(records: list[bytes]) -> bytes:
    """An archive: the dictionary in a skippable frame, then a frame for each record."""
    content = _trained(records)
    coder = zstd.ZstdCompressor(level=LEVEL, dict_data=zstd.ZstdCompressionDict(content) if content else None, write_checksum=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(content)), content, *map(coder.compress, records)])


def unpacked(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame each."""
    if len(archive) < 8:
        raise Damaged("no leading frame")
    magic, size = struct.unpack_from("<II", archive)
    if magic != SKIPPABLE or 8 + size > len(archive):
        raise Damaged("no dictionary frame")
    content = archive[8 : 8 + size]
    if content[:4] == MAGIC:  # the format lets the dictionary itself be compressed
        content = zstd.ZstdDecompressor().decompress(content)
    known = zstd.ZstdCompressionDict(content) if content else None
    view, at = memoryview(archive), 8 + size
    while at < len(archive):
        if archive[at : at + 4] != MAGIC:
            raise Damaged(f"no frame at {at}")
        reader = zstd.ZstdDecompressor(dict_data=known).decompressobj()
        try:
            data = reader.decompress(view[at:])
        except zstd.ZstdError as error:
            raise Damaged(str(error)) from error
        if not reader.eof:
            raise Damaged("the last frame is cut off")
        yield data
        at = len(archive) - len(reader.unused_data)


def with_revisits(pages: DataFrame) -> DataFrame:
    """Adds digest and refers_to: of equal payloads of at least SMALLEST bytes, the smallest page_id stays.

    Only digests and ids are grouped; a payload held by many pages is one row before the join. Rows with a null page_id
    are responses and are not referred to; repeated rows of the response's own id are responses too.
    """
    at = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    at = at.withColumn("digest", F.sha2("payload", 256))
    first = (
        at.filter(F.length("payload") >= SMALLEST).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return at.join(first, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes archives below `folder` and returns their names and numbers of records, computed once.

    Each attempt of a task writes under names of its own, so that a repeated task harms nothing; what counts is
    the list returned, which is stored before anything is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(base, recursive=True)
        held: list[bytes] = []
        size = 0

        def put() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(packed(held))
            out = pa.RecordBatch.from_pydict({"name": [name], "records": pa.array([len(held)], pa.int64())})
            held.clear()
            return out

        for batch in batches:
            for part in pieces(batch):
                for row in part.to_pylist():
                    held.append(record(row["page_id"], row["url"], row["payload"], row["refers_to"], row["digest"]))
                    size += len(row["payload"])
                    if size >= ROLL:
                        yield put()
                        size = 0
        if held:
            yield put()

    return with_revisits(pages).mapInArrow(run, "name string, records long").checkpoint()


def read(spark: SparkSession, folder: str, written: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """The records of all archives below `folder`; with `written`, of those listed there only.

    Every header, length, digest and frame is checked; a damaged archive raises Damaged.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    if written is not None:
        files = files.join(written.select("name"), "name", "left_semi")
    kind = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    kind += ", payload binary" if payloads else ""
    names = [c.split()[0] for c in kind.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(batch.schema.get_field_index("content")):
                rows: list[dict] = []
                size = 0
                for data in unpacked(content.as_py()):
                    rows.append(parsed(data))
                    size += len(data)
                    if size > 4 << 20 or len(rows) >= 2000:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    return files.mapInArrow(run, kind)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"url": pa.string(), "payload_digest": pa.string(), "record_type": pa.string(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names=names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives of all pages, written to the shared folder and read back."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    written = write(pages, folder)
    if written.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read(spark, folder, written, payloads=False).drop("url")
