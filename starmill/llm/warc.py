"""WARC archives in Zstandard: one frame a record, and the dictionary in a leading skippable frame.

An archive file is an optional skippable frame (magic 0x184D2A5D) that holds a dictionary, itself plain or
compressed, followed by frames of one record each. The reader walks a frame's block headers to find its end,
so each record is decoded alone, whatever the size of the file, and checks what it decodes: the version
line, the mandatory fields, the block's length, the closing line ends and the payload's digest.

Writing, the first record of each distinct payload (by SHA-256) is a response with the whole payload and
later ones are revisits that name it. Which one that is comes from an aggregation of ids by digest, joined
back by id, so a payload that many pages share makes no task large, and payloads are shuffled once. Archives
are written by the tasks to the shared folder under names that a repeated task writes again, each file put in place
when complete and closed at a bounded size.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.text import ship, whole
from starmill.session import fresh_path

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END_OF_RECORD = b"\r\n\r\n"

ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 16 << 10
DICTIONARY_RECORDS = 200
LEAST_REVISIT_BYTES = 100
LEVEL = 3


class WarcError(ValueError):
    """An archive or a record that breaks the format."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]

    @property
    def payload(self) -> bytes:
        """The body of the HTTP message in the block; the whole block of other records."""
        if not self.headers.get("content-type", "").startswith("application/http"):
            return self.block
        head, separator, body = self.block.partition(END_OF_RECORD)
        if not separator:
            raise WarcError("an HTTP block without end of its headers")
        return body


def written_record(headers: dict[str, str], block: bytes) -> bytes:
    """One record as bytes; line ends and control characters in values are percent-encoded."""
    lines = [VERSION.decode()]
    for name, value in {**headers, "Content-Length": str(len(block))}.items():
        clean = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)
        lines.append(f"{name}: {clean}")
    return "\r\n".join(lines).encode() + END_OF_RECORD + block + END_OF_RECORD


def parsed_record(data: bytes) -> Record:
    """A record, checked: version, mandatory fields, length, end and payload digest."""
    head, separator, rest = data.partition(END_OF_RECORD)
    if not separator:
        raise WarcError("a record without end of its headers")
    version, *lines = head.split(b"\r\n")
    if version not in (b"WARC/1.0", VERSION):
        raise WarcError(f"not a WARC version line: {version[:40]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name.strip():
            raise WarcError(f"not a header field: {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    absent = [name for name in MANDATORY if name not in headers]
    if absent:
        raise WarcError(f"fields are missing: {', '.join(absent)}")
    if not headers["content-length"].isdecimal():
        raise WarcError(f"not a length: {headers['content-length']!r}")
    length = int(headers["content-length"])
    if len(rest) != length + len(END_OF_RECORD) or rest[length:] != END_OF_RECORD:
        raise WarcError(f"a block of {max(len(rest) - len(END_OF_RECORD), 0)} bytes, announced {length}")
    record = Record(headers, rest[:length])
    digest = headers.get("warc-payload-digest", "")
    if record.kind == "response" and digest.startswith("sha256:"):
        if hashlib.sha256(record.payload).hexdigest() != digest.removeprefix("sha256:"):
            raise WarcError("the payload has another digest than announced")
    return record


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends, by its headers alone."""
    if bytes(data[at : at + 4]) != FRAME_MAGIC:
        raise WarcError(f"no frame at byte {at}")
    if at + 5 > len(data):
        raise WarcError("a frame that is cut off")
    descriptor = data[at + 4]
    single = descriptor >> 5 & 1
    here = at + 5 + (0 if single else 1) + (0, 1, 2, 4)[descriptor & 3]
    here += (single, 2, 4, 8)[descriptor >> 6]
    while True:
        if here + 3 > len(data):
            raise WarcError("a frame that is cut off")
        block = int.from_bytes(data[here : here + 3], "little")
        here += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            break
    here += 4 if descriptor >> 2 & 1 else 0
    if here > len(data):
        raise WarcError("a frame that is cut off")
    return here


def leading_dictionary(data: memoryview) -> tuple[bytes | None, int]:
    """The dictionary of an archive, if it has one, and where its records begin."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_MAGIC:
        return None, 0
    size = struct.unpack_from("<I", data, 4)[0]
    if 8 + size > len(data):
        raise WarcError("a dictionary that is cut off")
    held = bytes(data[8 : 8 + size])
    if held.startswith(FRAME_MAGIC):
        held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
    return held, 8 + size


def archive_records(data: bytes) -> Iterator[Record]:
    """The records of one archive, one frame after the other. An empty archive has none."""
    view = memoryview(data)
    dictionary, at = leading_dictionary(view)
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decoder = zstandard.ZstdDecompressor(dict_data=known)
    while at < len(view):
        if len(view) - at >= 8 and struct.unpack_from("<I", view, at)[0] & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", view, at + 4)[0]
            continue
        end = frame_end(view, at)
        try:
            frame = decoder.decompressobj()
            body = frame.decompress(view[at:end])
        except zstandard.ZstdError as error:
            raise WarcError(f"a frame that does not decode: {error}") from error
        if not frame.eof:
            raise WarcError("a frame that does not end")
        yield parsed_record(body)
        at = end


def archive_bytes(records: list[bytes]) -> bytes:
    """An archive of records, with a dictionary made of the first ones if they are enough for one."""
    dictionary = None
    if len(records) >= 16:
        try:
            dictionary = zstandard.train_dictionary(
                DICTIONARY_BYTES, [r[:16384] for r in records[:DICTIONARY_RECORDS]], k=256, d=8
            )
        except zstandard.ZstdError:
            # Too little in common to make one: an archive without.
            dictionary = None
    out = io.BytesIO()
    if dictionary is not None:
        held = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held)
    coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    for record in records:
        out.write(coder.compress(record))
    return out.getvalue()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """The response of a page, or its revisit if ``first`` names the page with the same payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": url or "",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if first is None:
        return written_record(headers, http.encode() + payload)
    headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{first}>"}
    return written_record(headers, http.encode())


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, first) of pages that repeat the payload of a page with a smaller id."""
    payload = whole("html").cast("binary")
    known = pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"))
    long_enough = known.where(F.col("size") >= LEAST_REVISIT_BYTES).drop("size")
    first = long_enough.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    several = first.where("n > 1 AND first IS NOT NULL").drop("n")
    again = long_enough.join(several, "digest").where(~F.col("page_id").eqNullSafe(F.col("first")))
    return again.distinct()


def write_archives(pages: DataFrame, folder: str, date: datetime = datetime(2026, 1, 1)) -> int:
    """Archives of all ``pages`` (page_id, url, html) under ``folder``; returns how many records.

    Null html is an empty payload, a null url an empty target. Payloads under 100 bytes are always responses. Rows
    that repeat the least id of a payload are responses too. A page without id revisits the first that has one. No
    file is written for an empty table.
    """
    spark = pages.sparkSession
    ship(spark)
    stamp = date.strftime("%Y-%m-%dT%H:%M:%SZ")
    again = revisits(pages).select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "first")
    body = pages.select("page_id", "url", whole("html").alias("html"))
    body = body.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    decided = body.join(
        again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left"
    ).select("page_id", "url", "html", "digest", "first")
    # The order within a task is part of the files' content, so a repeated task writes the same.
    ordered = decided.sortWithinPartitions("page_id", "digest", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        held, size, n, number = [], 0, 0, 0

        def close() -> None:
            nonlocal held, size, number
            name = f"{base}/part-{part:06d}-{number:05d}.warc.zst"
            hidden = f"{base}/_{part:06d}-{number:05d}-{TaskContext.get().taskAttemptId()}"
            with files.open_output_stream(hidden) as out:
                out.write(archive_bytes(held))
            files.move(hidden, name)
            held, size, number = [], 0, number + 1

        for batch in batches:
            for row in batch.to_pylist():
                record = page_record(
                    row["page_id"], row["url"], row["html"].encode(), row["digest"], row["first"], stamp
                )
                held.append(record)
                size += len(record)
                n += 1
                if size >= ARCHIVE_BYTES:
                    close()
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return ordered.mapInArrow(write, "n bigint").agg(F.sum("n")).first()[0] or 0


RECORD_SQL = (
    "record_id string, record_type string, target_uri string, payload_bytes bigint, "
    "payload_digest string, refers_to string, payload binary"
)


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row for each record of the archives under ``folder``, checked; a broken one is an error.

    ``payload`` is null unless asked for. Of a revisit, ``payload_bytes`` is null: the payload is that of the record it
    refers to.
    """
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string())
             for n in (part.split()[0] for part in RECORD_SQL.split(", "))]
        )
        for batch in batches:
            for content in batch.column("content"):
                rows: list[dict] = []
                held = 0
                for record in archive_records(content.as_py()):
                    body = record.payload
                    revisit = record.kind == "revisit"
                    rows.append(
                        {
                            "record_id": record.headers["warc-record-id"],
                            "record_type": record.kind,
                            "target_uri": record.headers.get("warc-target-uri"),
                            "payload_bytes": None if revisit else len(body),
                            "payload_digest": record.headers["warc-payload-digest"].removeprefix("sha256:")
                            if revisit
                            else hashlib.sha256(body).hexdigest(),
                            "refers_to": record.headers.get("warc-refers-to"),
                            "payload": body if payloads and not revisit else None,
                        }
                    )
                    held += len(body) if payloads else 200
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(read, RECORD_SQL)


def archived_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages written to archives and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Other columns are not returned; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    if not write_archives(pages.select("page_id", "url", "html"), folder):
        return spark.createDataFrame(
            [], "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
        )
    records = read_archives(spark, folder)

    def page(column: str):
        return F.expr(f"try_cast(nullif(regexp_extract({column}, '<urn:page:(-?[0-9]*)>', 1), '') AS bigint)")

    rows = records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )
    # A revisit's length is that of the response it refers to, which must have the same digest.
    first = (
        rows.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("first_id"), F.col("payload_digest").alias("first_digest"))
        .agg(F.first("payload_bytes").alias("first_bytes"))
    )
    visited = rows.where("record_type = 'revisit'").join(
        first, (F.col("refers_to") == F.col("first_id")) & (F.col("payload_digest") == F.col("first_digest")), "left"
    )
    length = F.coalesce("first_bytes", F.raise_error("a revisit of no response").cast("bigint"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        rows.where("record_type = 'response'")
        .select(*names)
        .unionByName(visited.withColumn("payload_bytes", length).select(*names))
    )
