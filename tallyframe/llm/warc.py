"""WARC archives of web pages: each record a Zstandard frame of its own, the dictionary they share in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.base import among_first, saved, spread_join
from tallyframe.sources.scratch import scratch_dir

MIN_BYTES = 0  # equal payloads of fewer bytes are all written as responses
CHUNK_BYTES = 1 << 20  # compressed bytes after which the writer ends a chunk; a longer record is a chunk alone
CHUNKS = 16  # chunks of one archive file, besides its head
LEVEL = 6
DICTIONARY_BYTES = 112 << 10  # largest dictionary
SAMPLE_RECORDS = 1000  # records that the dictionary is built from: those of least hash
SAMPLE_BYTES = 16 << 10  # of each, so many bytes at most
DICTIONARY_FRAME, EMPTY_FRAME, ZSTD_FRAME = 0x184D2A5D, 0x184D2A50, 0xFD2FB528  # fixed values of the two formats
BREAK = struct.pack("<II", EMPTY_FRAME, 0).decode()  # an empty skippable frame, which readers pass over; it is also plain text
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_KEY = ["digest", "payload_bytes", "check"]


def payloads(pages: DataFrame) -> DataFrame:
    """(uid, page_id, url, payload, payload_bytes, digest, check) of each row, written once so that ``uid`` stays: a number of the row.

    ``check`` is a second hash, as different payloads with one SHA-1 can be made.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.unhex(F.sha1("payload")), "check": F.xxhash64("payload")})
    return saved(rows.withColumn("uid", F.monotonically_increasing_id()), "payloads")


def decided(rows: DataFrame, min_bytes: int = MIN_BYTES, **options) -> DataFrame:
    """``rows`` of ``payloads`` with ``top``, for revisits only: page_id and uid of the response they refer to.

    Of equal payloads that with the largest ``page_id`` is the response (null is least); of rows that tie, any one. A payload that very many
    pages share meets its response by broadcast, so it does not gather in one task.
    """
    top = F.max(F.struct("page_id", "uid")).alias("top")
    groups = rows.where(F.col("payload_bytes") >= min_bytes).groupBy(*_KEY).agg(top, F.count("*").alias("n")).where("n > 1")
    both = spread_join(rows, saved(groups, "repeats"), _KEY, "n", rows.count(), **options).drop("n")
    return both.withColumn("top", F.when(F.col("top.uid") != F.col("uid"), F.col("top")))


def record_id(page_id: str | None, uid: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{uid}')}>"


def _written(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in headers if value is not None]
    return b"".join([b"WARC/1.1\r\n", "".join(lines).encode(errors="replace"), f"Content-Length: {len(block)}\r\n\r\n".encode(), block, b"\r\n\r\n"])


def record(date: str, uid: int, page_id: str | None, url: str | None, payload: bytes, size: int, digest: bytes, top: tuple[str | None, int] | None) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP header alone. Control characters of the address are escaped."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    escaped = lambda x, safe: None if x is None else quote(x, safe=safe)
    target = None if url is None else "".join(quote(c) if ord(c) < 33 or ord(c) == 127 else c for c in url)
    headers = [
        ("WARC-Type", "revisit" if top else "response"),
        ("WARC-Record-ID", record_id(page_id, uid)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", escaped(page_id, "-")),
    ]
    if top:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*top)), ("X-Refers-To-Page-ID", escaped(top[0], "-"))]
    return _written(headers, http if top else http + payload)


def _records(batch: pa.RecordBatch, date: str) -> Iterator[bytes]:
    names = ("uid", "page_id", "url", "payload", "payload_bytes", "digest", "top_page", "top_uid")
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for uid, page_id, url, payload, size, digest, top_page, top_uid in zip(*columns):
        top = None if not top_uid.is_valid else (top_page.as_py(), top_uid.as_py())
        yield record(date, uid.as_py(), page_id.as_py(), url.as_py(), payload.as_py(), size.as_py(), digest.as_py(), top)


def trained(records: list[bytes], most: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary built from ``records``; empty if they are too few or too small to build one."""
    size = min(most, sum(map(len, records)) // 8)
    if size < 1024 or len(records) < 16:
        return b""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:  # samples without anything in common
        return b""


def _row_for_writing(rows: DataFrame) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    revisit = F.col("top").isNotNull()
    return rows.select(
        "uid", text("page_id").alias("page_id"), text("url").alias("url"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        "payload_bytes", "digest", text("top.page_id").alias("top_page"), F.col("top.uid").alias("top_uid"),
    )


def archived(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, chunks: int = CHUNKS, chunk_bytes: int = CHUNK_BYTES, **options) -> None:
    """Write a WARC record for each row of ``pages`` (page_id, url, html) into archives below ``folder``, which must not exist.

    Spark's text writer makes the files, with its commit: rows are runs of compressed records, and the line separator is an empty skippable
    frame, so a file is a plain sequence of Zstandard frames in any file system that Spark knows, and a task that is repeated
    leaves nothing twice. The first row of each file holds the dictionary in a skippable frame, then a warcinfo record; ``maxRecordsPerFile``
    begins the next file where the writer begins the next head. Files hold up to ``chunks`` runs of about ``chunk_bytes``.

    The dictionary is built on the driver from up to ``SAMPLE_BYTES`` of each of ``SAMPLE_RECORDS`` responses of least hash, 16 MB at most; tables
    with less than 16 such records or 8 kB get archives without one. Null html is empty; null page_id and url leave out their header. Repeated rows are
    records each, one of them the response. A very long page is a run alone. Other columns are not archived. An empty table gives no record.
    """
    rows = _row_for_writing(decided(payloads(pages), min_bytes, **options))
    spark = pages.sparkSession
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    responses = rows.where("top_uid IS NULL AND payload_bytes > 0")
    draw = F.xxhash64("digest", "uid")
    likely = responses.where(among_first(draw, SAMPLE_RECORDS, F.lit(max(responses.count(), 1))))
    cut = likely.withColumn("payload", F.substring("payload", 1, SAMPLE_BYTES))
    sample = cut.orderBy(draw, "uid").limit(SAMPLE_RECORDS).toArrow()
    dictionary = trained([r for batch in sample.to_batches() for r in _records(batch, date)])
    held = spark.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(held.value) if held.value else None
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True, write_checksum=True).compress
        lead = struct.pack("<II", DICTIONARY_FRAME, len(held.value)) + held.value if held.value else b""
        run_ = bytearray()
        done = 0

        def rows_of(data: bytes) -> Iterator[pa.RecordBatch]:
            nonlocal done
            out = [data]
            if done % chunks == 0:
                about = _written([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(f"info/{TaskContext.get().partitionId()}", done)), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                out = [lead + compress(about), data]
            done += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

        for batch in batches:
            for one in _records(batch, date):
                run_ += compress(one)
                if len(run_) >= chunk_bytes:
                    yield from rows_of(bytes(run_))
                    run_.clear()
        if run_:
            yield from rows_of(bytes(run_))

    lines = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", BREAK).option("maxRecordsPerFile", chunks + 1).text(folder)


def frames(data: memoryview) -> Iterator[tuple[int, int, int]]:
    """(magic, begin, end) of each Zstandard or skippable frame; of skippable frames, the place of the content."""
    at = 0
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at) if at + 8 <= len(data) else (0, 0)
        if magic == ZSTD_FRAME:
            end = at + zstandard.frame_header_size(data[at : at + 18])
            checksum = zstandard.get_frame_parameters(data[at : at + 18]).has_checksum
            last = False
            while not last:
                block = int.from_bytes(data[end : end + 3], "little")
                last, kind, size = block & 1, block >> 1 & 3, block >> 3
                end += 3 + (1 if kind == 1 else size)
            end += 4 * checksum
            yield magic, at, end
            at = end
        elif magic & 0xFFFFFFF0 == EMPTY_FRAME:
            yield magic, at + 8, at + 8 + size
            at += 8 + size
        else:
            raise ValueError(f"no frame at byte {at}")


def _parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode(errors="replace").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if not lines[0].startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("malformed record")
    return fields, rest[:size]


def opened(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, block) of each record of one archive; the dictionary comes from the leading frame, if it holds one."""
    view = memoryview(data)
    decompressor = zstandard.ZstdDecompressor()
    for magic, begin, end in frames(view):
        if magic == DICTIONARY_FRAME:
            shared = bytes(view[begin:end])
            if shared[:4] == struct.pack("<I", ZSTD_FRAME):
                shared = zstandard.ZstdDecompressor().decompress(shared)
            decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared))
        elif magic == ZSTD_FRAME:
            yield begin, end - begin, *_parsed(decompressor.decompress(view[begin:end]))


def restored(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload, archive, offset, length) of each record below ``folder``.

    ``payload`` is null for revisits, whose length and digest are those of the payload they stand for. ``archive``, ``offset`` and ``length`` say
    where the record's frame is, so that it can be read alone. A payload that does not match its digest is an error. An empty folder
    gives no row. A task holds one archive at a time.
    """
    schema = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary, archive string, offset bigint, length bigint"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]

    def rows_of(path: str, data: bytes) -> Iterator[tuple]:
        for offset, length, fields, block in opened(data):
            if fields["WARC-Type"] not in ("response", "revisit"):
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            size = next(int(line[15:]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            full = fields["WARC-Type"] == "response"
            if full and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                raise ValueError(f"{path}: the payload at byte {offset} does not match its digest")
            own, other = (None if x is None else unquote(x) for x in map(fields.get, ("X-Page-ID", "X-Refers-To-Page-ID")))
            yield own, fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], other, payload if full else None, path, offset, length

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for row in rows_of(path.as_py(), data.as_py()):
                    rows.append(row)
                    held += row[2]
                    if held >= 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    typed = {c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")}
    return files.mapInArrow(run, schema).withColumns(typed)


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES, **options) -> DataFrame:
    """What ``restored`` reads after ``archived`` wrote ``pages`` to the shared scratch folder."""
    folder = scratch_dir(pages.sparkSession, "warc")
    archived(pages, folder, min_bytes, **options)
    return restored(pages.sparkSession, folder, pages.schema["page_id"].dataType.simpleString())
