"""WARC archives in Zstandard: a dictionary in a leading skippable frame, one frame per record.

Executors write archives of a bounded size straight to shared storage and read them back whole with
Spark's binary reader, so no archive passes through the driver.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.llm.common import new_folder

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 16 << 20
LEAST_REVISIT = 1000
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20
SUFFIX = ".warc.zst"


class Invalid(ValueError):
    """An archive or record that breaks the format."""


def record(kind: str, record_id: str, uri: str, date: str, payload: bytes, digest: str,
           refers_to: str | None = None) -> bytes:
    """One WARC record; a revisit has the HTTP head of its payload and not the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http + (payload if kind == "response" else b"")
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date),
        ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers[4:4] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the archive's first records; of those it is made of if they are too few."""
    samples, size = [], 0
    for r in records:
        if samples and size + len(r) > SAMPLE_BYTES:
            break
        samples.append(r)
        size += len(r)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        raw = b"".join(samples)[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], level: int = 3) -> bytes:
    known = _dictionary(records)
    stored = zstandard.ZstdCompressor(level=level).compress(known.as_bytes())
    packer = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(stored)), stored,
                     *map(packer.compress, records)])


def _frame_size(data: memoryview, at: int) -> int:
    """Length of the frame at ``at``, from its block headers, without decoding it."""
    head = bytes(data[at:at + 18])
    if head[:4] != ZSTD_MAGIC:
        raise Invalid(f"no frame at byte {at}")
    try:
        checksum = zstandard.get_frame_parameters(head).has_checksum
        end = at + zstandard.frame_header_size(head)
    except zstandard.ZstdError as broken:
        raise Invalid(f"broken frame header at byte {at}") from broken
    last = 0
    while not last:
        if end + 3 > len(data):
            raise Invalid(f"frame at byte {at} is cut short")
        header = int.from_bytes(data[end:end + 3], "little")
        last, kind, size = header & 1, header >> 1 & 3, header >> 3
        end += 3 + (1 if kind == 1 else size)
    end += 4 * checksum
    if end > len(data):
        raise Invalid(f"frame at byte {at} is cut short")
    return end - at


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each record frame of an archive; skippable frames are passed over."""
    view = memoryview(data)
    at, known = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise Invalid("dictionary frame is cut short")
        stored = data[8:8 + size]
        try:
            if stored[:4] == ZSTD_MAGIC:
                stored = zstandard.ZstdDecompressor().decompressobj().decompress(stored)
            known = zstandard.ZstdCompressionDict(stored)
            zstandard.ZstdDecompressor(dict_data=known).decompressobj()  # loads the dictionary
        except (zstandard.ZstdError, ValueError) as broken:
            raise Invalid("the dictionary cannot be loaded") from broken
        at = 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=known)
    while at < len(data):
        if data[at + 1:at + 4] == b"\x2a\x4d\x18" and data[at] & 0xF0 == 0x50:
            if at + 8 > len(data):
                raise Invalid(f"skippable frame at byte {at} is cut short")
            after = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
            if after > len(data):
                raise Invalid(f"skippable frame at byte {at} is cut short")
            at = after
            continue
        size = _frame_size(view, at)
        try:
            yield at, reader.decompressobj().decompress(view[at:at + size])
        except zstandard.ZstdError as broken:
            raise Invalid(f"frame at byte {at} cannot be decoded") from broken
        at += size


class Record(NamedTuple):
    record_type: str
    record_id: str
    target_uri: str
    payload: bytes | None
    payload_bytes: int
    payload_digest: str
    refers_to: str | None


def _fields(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip():
            raise Invalid(f"broken header line {name!r}")
        out.setdefault(name.strip().lower(), value.strip())
    return out


def parse(data: bytes) -> Record:
    """Check version, mandatory headers, lengths and digest of one record and take it apart."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", VERSION):
        raise Invalid("no WARC version line")
    fields = _fields(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise Invalid(f"{name} is missing")
    length = fields["content-length"]
    if not (length.isascii() and length.isdigit()) or len(rest) != int(length) + 4:
        raise Invalid("Content-Length is not the length of the block")
    if rest[-4:] != b"\r\n\r\n":
        raise Invalid("record does not end in two line ends")
    block = rest[:-4]
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return Record(kind, fields["warc-record-id"][1:-1], fields.get("warc-target-uri", ""),
                      block, len(block), hashlib.sha1(block).hexdigest(), None)
    http, gap, payload = block.partition(b"\r\n\r\n")
    size = _fields(http.partition(b"\r\n")[2]).get("content-length", "")
    digest = fields.get("warc-payload-digest", "").partition(":")[2]
    if not gap or not size.isdigit() or not digest:
        raise Invalid("no HTTP head, payload length or payload digest")
    refers_to = fields.get("warc-refers-to")
    if kind == "response":
        if len(payload) != int(size) or hashlib.sha1(payload).hexdigest() != digest:
            raise Invalid("payload differs from its length or digest")
    elif payload or refers_to is None or "warc-profile" not in fields:
        raise Invalid("revisit with a payload, or without a profile or the record it refers to")
    return Record(kind, fields["warc-record-id"][1:-1], fields.get("warc-target-uri", ""),
                  payload if kind == "response" else None, int(size), digest,
                  refers_to and refers_to[1:-1])


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a shared folder, whatever store it is in."""
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def _page_urn(page_id) -> str:
    return "urn:page:" + ("" if page_id is None else quote(str(page_id), safe=""))


def page_of(urn: str):
    """The page id in a record id as a column of text, null where there was none."""
    return F.nullif(F.regexp_extract(urn, "^urn:page:(.*)$", 1), F.lit(""))


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, payload, digest, response``: which page a page's payload is kept under.

    Of equal payloads of at least ``least`` bytes the greatest page id is the response. Payloads are
    equal if their SHA-256 and length are. Only digests are grouped, so a payload that a third of
    all pages share moves no more than any other; the join back is on repeated digests alone.
    """
    base = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8").alias("payload"),
    ).withColumn("sha256", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    repeated = base.where(F.col("size") >= least).groupBy("sha256", "size").agg(
        F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    return base.join(repeated, ["sha256", "size"], "left").select(
        "page_id", "url", "payload", F.sha1("payload").alias("digest"), "response")


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", date: str = "1970-01-01T00:00:00Z",
          archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Write a record per row of ``pages`` into archives under ``folder``; the number of records.

    Rows are sorted within a task, so a task that runs again writes the same archives under the
    same names. A null page is an empty payload; a null url gives the page's own name.
    """
    rows = with_revisits(pages, id_col, url_col, html_col).sortWithinPartitions(
        "page_id", "url", "digest")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, path = _open(folder)
        store.create_dir(path, recursive=True)
        waiting: list[bytes] = []
        size = number = total = 0

        def flush() -> None:
            name = posixpath.join(path, f"part-{part:06d}-{number:05d}{SUFFIX}")
            attempt = f"{name}.{TaskContext.get().taskAttemptId()}.tmp"
            with store.open_output_stream(attempt, compression=None) as out:
                out.write(archive(waiting))
            store.move(attempt, name)

        for batch in batches:
            for row in zip(*(batch[c] for c in ("page_id", "url", "payload", "digest", "response"))):
                page_id, url, payload, digest, response = (v.as_py() for v in row)
                again = response is not None and page_id != response
                urn = _page_urn(page_id)
                waiting.append(record(
                    "revisit" if again else "response", urn,
                    quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else urn, date, payload, digest,
                    _page_urn(response) if again else None))
                size += len(waiting[-1])
                total += 1
                if size >= archive_bytes:
                    flush()
                    waiting, size, number = [], 0, number + 1
        if waiting:
            flush()
        yield pa.RecordBatch.from_pydict({"records": pa.array([total], pa.int64())})

    return rows.mapInArrow(save, "records bigint").agg(F.sum("records")).first()[0] or 0


READ_SCHEMA = ("archive string, frame_offset bigint, record_type string, record_id string, "
               "target_uri string, payload binary, payload_bytes bigint, payload_digest string, "
               "refers_to string, error string")


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``folder``.

    A record that breaks the format has its ``error`` and offset and nothing else; where a frame is
    broken the rest of that archive is one such row, as nothing after it can be found.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(
        folder).select("path", "content")

    def rows(path: str, content: bytes) -> Iterator[tuple]:
        at = 0
        try:
            for at, data in frames(content):
                try:
                    r = parse(data)
                except (Invalid, UnicodeDecodeError) as broken:
                    yield path, at, *[None] * 7, str(broken)
                    continue
                yield (path, at, *(r if with_payload else r._replace(payload=None)), None)
        except Invalid as broken:
            yield path, at, *[None] * 7, str(broken)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in READ_SCHEMA.split(","))])
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                found = list(rows(path.as_py(), content.as_py()))
                columns = zip(*found) if found else [()] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return files.mapInArrow(decode, READ_SCHEMA)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """Archive ``pages`` in a fresh shared folder and read the records back, without payloads.

    One row per input row: ``page_id, payload_bytes, payload_digest, record_type, refers_to``; a
    null page id stays null, an empty table gives no rows, and repeated rows give a record each.
    A record that cannot be read back fails the job.
    """
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType
    folder = new_folder(spark, "warc")
    if not write(pages, folder, id_col, url_col, html_col):
        return spark.createDataFrame([], f"page_id {kind.simpleString()}, payload_bytes bigint, "
                                     "payload_digest string, record_type string, "
                                     f"refers_to {kind.simpleString()}")
    found = read(spark, folder, with_payload=False)
    broken = F.col("error").isNotNull()
    kept = found.where(F.when(broken, F.raise_error(F.concat_ws(
        " ", "archive", "archive", "frame_offset", "error"))).otherwise(F.lit(True)))
    return kept.select(
        page_of("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", page_of("refers_to").cast(kind).alias("refers_to"))
