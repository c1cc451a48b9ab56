"""WARC archives with Zstandard: writing and reading.

An archive begins with a skippable frame that holds the dictionary (empty if there was too little to train one);
every record is a frame of its own. Archives are written by Spark's text sink, whose rows end with a line break: each
row ends with the head of a skippable frame of one byte, and the line break is that byte. So any store that Spark
writes to will do, and a lost executor's files are made anew by the sink's own commit.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.session import Scratch

# Numbers of the frame format.
FRAME, DICTIONARY_FRAME, FILLER_FRAME = 0xFD2FB528, 0x184D2A5D, 0x184D2A50
FIRST_SKIPPABLE, LAST_SKIPPABLE = 0x184D2A50, 0x184D2A5F
# Names of the record format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

FILLER = struct.pack("<II", FILLER_FRAME, 1)
ARCHIVE_BYTES = 32 << 20
LEAST_REVISIT_BYTES = 1000
DICTIONARY_BYTES = 16 << 10
TRAINING_BYTES = 1 << 20
URN = "urn:page:"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: int | None,
            date: str) -> bytes:
    """One record: WARC head, HTTP head, and the payload unless another record has it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        target = re.sub(r"[\x00-\x20\x7f]", lambda match: f"%{ord(match[0]):02X}", url)
        head.append(f"WARC-Target-URI: {target}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on the samples, or nothing if they are too few for one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_archives(
    pages: DataFrame, path: str, id: str = "page_id", html: str = "html", url: str = "url",
    archive_bytes: int = ARCHIVE_BYTES, least_revisit: int = LEAST_REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record per row into archives below ``path``, each of about ``archive_bytes`` of payload.

    Payloads are the UTF-8 bytes of ``html``, null as none. Of records with equal payloads of at least
    ``least_revisit`` bytes, that with the largest id is a response, the others are revisits that refer to it; rows
    with that same largest id, and those without id, are responses too. Every archive has its own dictionary, trained
    on its first records. ``url`` may be missing or null. Repeated rows are repeated records, no row is no archive.
    """
    rows = pages.select(
        F.col(id).cast("bigint").alias("id"),
        F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "utf-8").alias("payload"),
        (F.col(url).cast("string") if url in pages.columns else F.lit(None).cast("string")).alias("url"),
    ).withColumns({"digest": F.sha1("payload"), "length": F.octet_length("payload").cast("bigint")})
    scratch = Scratch(pages.sparkSession)
    kept = scratch.stage(
        rows.filter(F.col("length") >= least_revisit).groupBy("digest").agg(
            F.max("id").alias("kept"), F.count("*").alias("n")).filter("n > 1 AND kept IS NOT NULL").drop("n"), "kept")
    total = rows.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-total // archive_bytes))
    spread = rows.join(kept, "digest", "left").withColumn(
        "refers_to", F.when(F.col("id") < F.col("kept"), F.col("kept"))).drop("kept").repartition(
        parts, F.xxhash64("id", "digest"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*(batch.column(name) for name in (
                        "id", "url", "payload", "digest", "length", "refers_to"))):
                    yield _record(*(value.as_py() for value in row), date)

        waiting, size, rest = [], 0, records()
        for record in rest:
            waiting.append(record)
            size += len(record)
            if size >= TRAINING_BYTES:
                break
        if not waiting:
            return
        dictionary = _dictionary(waiting)
        learnt = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=3, dict_data=learnt, write_checksum=True)
        frames, size = [struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary + FILLER], 0
        for source in (waiting, rest):
            for record in source:
                frames.append(compressor.compress(record) + FILLER)
                size += len(frames[-1])
                if size > TRAINING_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])
                    frames, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    frames = spread.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", 0).text(path)
    scratch.release()


def frames_of(data: memoryview) -> Iterator[tuple[int, int, memoryview]]:
    """(place, magic number, content) of each frame: the inside of skippable frames, the whole of others."""
    place, end = 0, len(data)
    while place < end:
        if end - place < 8:
            raise ValueError(f"cut off at byte {place}")
        magic, size = struct.unpack_from("<II", data, place)
        if FIRST_SKIPPABLE <= magic <= LAST_SKIPPABLE:
            after = place + 8 + size
            if after > end:
                raise ValueError(f"skippable frame at byte {place} is cut off")
            yield place, magic, data[place + 8: after]
        elif magic == FRAME:
            head = data[place: place + 18]
            after = place + zstandard.frame_header_size(head)
            last = False
            while not last:  # the heads of the blocks say where the frame ends
                if after + 3 > end:
                    raise ValueError(f"frame at byte {place} is cut off")
                block = int.from_bytes(data[after: after + 3], "little")
                last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
                after += 3 + (1 if kind == 1 else size)
            after += 4 * zstandard.get_frame_parameters(head).has_checksum
            if after > end:
                raise ValueError(f"frame at byte {place} is cut off")
            yield place, magic, data[place:after]
        else:
            raise ValueError(f"no frame at byte {place}")
        place = after


def _fields(head: bytes) -> dict[str, str]:
    fields: dict[str, str] = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        key = name.decode("ascii").lower()
        if not colon or not re.fullmatch(r"[a-z0-9-]+", key) or key in fields:
            raise ValueError(f"bad header line {line[:80]!r}")
        fields[key] = value.strip().decode()
    return fields


def _whole(fields: dict[str, str], name: str) -> int:
    if not re.fullmatch("[0-9]+", fields.get(name, "")):
        raise ValueError(f"bad {name}")
    return int(fields[name])


def parsed(record: bytes) -> dict:
    """The parts of a record, once its headers, lengths and digest are found right."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version != VERSION or not gap:
        raise ValueError("no record head")
    fields = _fields(lines)
    if missing := [name for name in REQUIRED if name not in fields]:
        raise ValueError(f"headers missing: {missing}")
    if len(rest) != _whole(fields, "content-length") + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("the block is not as long as its head says")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"unknown record type {kind!r}")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not status.startswith(b"HTTP/1.") or not gap:
        raise ValueError("no HTTP head")
    length = _whole(_fields(lines), "content-length")
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha1":
        raise ValueError("no SHA-1 payload digest")
    digest = base64.b32decode(digest).hex()
    refers = fields.get("warc-refers-to")
    if kind == "response":
        if len(payload) != length or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("the payload is not what its head says")
    elif payload or refers is None:
        raise ValueError("a revisit has no payload and refers to a record")

    def number(value: str | None) -> int | None:
        if value is None:
            return None
        match = re.fullmatch(rf"<{URN}(-?[0-9]*)>", value)
        if not match:
            raise ValueError(f"unknown record id {value[:80]!r}")
        return int(match[1]) if match[1] else None

    return {
        "id": number(fields["warc-record-id"]), "record_type": kind, "url": fields.get("warc-target-uri"),
        "payload_bytes": length, "payload_digest": digest, "refers_to": number(refers),
        "payload": payload if kind == "response" else None,
    }


COLUMNS = ("page_id bigint, record_type string, url string, payload_bytes bigint, payload_digest string, "
           "refers_to bigint, payload binary")


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``: page_id, record_type, url, payload_bytes, payload_digest, refers_to
    and payload (null for revisits, and everywhere without ``payload``); bytes and digest are of the full payload.

    A frame that is cut off, a record that breaks the format, or a length or digest that does not fit stops the job
    with the archive's name and the place in it. No archive gives no rows.
    """
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])

    def table(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                decoder, rows, size = None, [], 0
                for place, magic, frame in frames_of(memoryview(content.as_buffer())):
                    if place == 0:
                        if magic != DICTIONARY_FRAME:
                            raise ValueError(f"{name}: no dictionary frame at the start")
                        known = zstandard.ZstdCompressionDict(bytes(frame)) if len(frame) else None
                        decoder = zstandard.ZstdDecompressor(dict_data=known)
                    elif magic == FRAME:
                        try:
                            found = parsed(decoder.decompress(frame))
                        except (ValueError, zstandard.ZstdError) as error:
                            raise ValueError(f"{name}, byte {place}: {error}") from error
                        found["page_id"] = found.pop("id")
                        if not payload:
                            found["payload"] = None
                        rows.append(found)
                        size += found["payload_bytes"] if payload else 100
                        if size > TRAINING_BYTES:
                            yield table(rows)
                            rows, size = [], 0
                yield table(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, COLUMNS)
