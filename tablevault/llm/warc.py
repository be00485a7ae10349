"""WARC archives in dictionary-compressed Zstandard frames, written and read by Spark tasks."""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import python_tasks, text_or_empty

# Skippable frame that holds a dictionary, at the start of a file.
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
# Payload bytes that a file's dictionary is built from, at most.
SAMPLE_BYTES = 4 << 20
LEVEL = 6
ROWS = (
    "id long, url string, record_type string, record_id string, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary"
)
_DATE = "2000-01-01T00:00:00Z"  # pages carry no date of their own


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, for use inside tasks: local, HDFS, S3 or GCS."""
    if re.match(r"[a-z0-9+.-]+:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^s3a:", "s3:", re.sub(r"^file:/+", "file:///", path)))
    return pafs.LocalFileSystem(), path


def _dictionary(payloads: list[bytes]) -> bytes:
    """A Zstandard dictionary built from payloads; empty if they are too few for one."""
    size = min(DICTIONARY_BYTES, max(1 << 10, sum(map(len, payloads)) // 8))
    try:
        return zstandard.train_dictionary(size, payloads).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _record(row: dict) -> bytes:
    """One record of WARC 1.1, uncompressed."""
    revisit = row["record_type"] == "revisit"
    payload = b"" if revisit else row["payload"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {_record_id(row['id'])}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {quote(row['url'] or 'about:blank', safe=_URI)}",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(row['refers_to'])}",
        ]
    lines += ["Content-Type: application/http; msgtype=response"]
    lines += [f"Content-Length: {len(http) + len(payload)}", "", ""]
    return "\r\n".join(lines).encode() + http + payload + b"\r\n\r\n"


_URI = "!#$%&'()*+,/:;=?@[]~-._"


def _record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page_of(record_id: str) -> int | None:
    page = record_id.strip("<>").rpartition(":")[2]
    return None if page == "none" else int(page)


def with_record_types(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Tell responses from revisits.

    Of equal payloads of `least_bytes` or more, the least id is the response and all others
    revisit it. Ids are reduced to one per digest and task before they are shuffled, and a
    payload that very many pages share is a join that adaptive execution may split. Rows
    that repeat the least id are all responses; NULL ids are revisits unless all of a
    payload's ids are NULL.
    """
    rows = pages.select(
        column(id_col).cast("long").alias("id"),
        column(url_col).cast("string").alias("url"),
        text_or_empty(payload_col).cast("binary").alias("payload"),
    ).withColumn("hex", F.sha1("payload"))
    large = F.octet_length("payload") >= least_bytes
    least = (
        rows.where(large)
        .groupBy(F.col("hex").alias("of_hex"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    joined = rows.join(least, F.col("hex") == F.col("of_hex"), "left")
    revisit = large & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select(
        "id",
        "url",
        "payload",
        "hex",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write_archives(records: DataFrame, path: str) -> DataFrame:
    """Write one archive per partition below `path`; returns (file, records, bytes).

    Each file starts with a skippable frame that holds the dictionary, built from the file's
    first `SAMPLE_BYTES` of payloads; each record is a frame of its own that uses it. A file
    is written under another name and moved when complete, and its name is its partition's,
    so a task that runs again replaces its own file.
    """
    python_tasks(records.sparkSession)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, folder = _file_system(path)
        name = f"part-{context.partitionId():06d}.warc.zst"
        part = f"{folder}/_{context.taskAttemptId()}-{name}"
        held, size, frame, count, out = [], 0, None, 0, None

        def started():
            dictionary = _dictionary([r["payload"] for r in held if r["payload"]])
            # The name ends in .zst, which must not make a second compression of it.
            stream = system.open_output_stream(part, compression=None)
            stream.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
            used = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
            return stream, zstandard.ZstdCompressor(
                level=LEVEL, dict_data=used, write_checksum=True, write_content_size=True
            )

        for batch in batches:
            for row in batch.to_pylist():
                row["digest"] = base64.b32encode(bytes.fromhex(row["hex"])).decode()
                row["payload_bytes"] = len(row["payload"])
                count += 1
                if out is None:
                    held.append(row)
                    size += len(row["payload"])
                    if size < SAMPLE_BYTES:
                        continue
                    out, frame = started()
                    for kept in held:
                        out.write(frame.compress(_record(kept)))
                    held = []
                else:
                    out.write(frame.compress(_record(row)))
        if out is None and held:
            out, frame = started()
            for kept in held:
                out.write(frame.compress(_record(kept)))
        if out is not None:
            length = out.tell()
            out.close()
            system.move(part, f"{folder}/{name}")
            yield pa.record_batch(
                [pa.array([f"{path}/{name}"]), pa.array([count]), pa.array([length])],
                ["file", "records", "bytes"],
            )

    _make_folder(records.sparkSession, path)
    return records.mapInArrow(written, "file string, records long, bytes long")


def _make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def _frames(stream) -> Iterator[bytes]:
    """The records of an archive one by one, each a frame behind the dictionary's frame."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start of the archive")
    dictionary = stream.read(size)
    used = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompressor = zstandard.ZstdDecompressor(dict_data=used)
    pending = b""
    while True:
        if not pending:
            pending = stream.read(1 << 20)
            if not pending:
                return
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(pending))
            if frame.eof:
                pending = frame.unused_data
                break
            pending = stream.read(1 << 20)
            if not pending:
                raise ValueError("the archive ends inside a record")
        yield b"".join(parts)


def _parsed(record: bytes) -> dict:
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?i)content-length: (\d+)", http)
    refers = fields.get("WARC-Refers-To")
    return {
        "id": _page_of(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "record_id": fields["WARC-Record-ID"],
        "refers_to": _page_of(refers) if refers else None,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": int(length[1]),
        "payload": payload,
    }


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives named in column `file`, as in `ROWS`.

    Files are streamed record by record. A response's payload is checked against its digest.
    Revisits have an empty payload, but the digest and size of the full one.
    """
    python_tasks(files.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for file in batch.column("file").to_pylist():
                system, name = _file_system(file)
                rows, size = [], 0
                with system.open_input_stream(name, compression=None) as stream:
                    for record in _frames(stream):
                        row = _parsed(record)
                        if row["record_type"] == "response":
                            digest = hashlib.sha1(row["payload"]).digest()
                            if base64.b32encode(digest).decode() != row["payload_digest"]:
                                raise ValueError(f"{row['record_id']} in {file} is damaged")
                        size += len(row["payload"])
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _ARROW)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    # A task for each file, which adaptive execution does not join.
    each = files.select("file").repartition(max(1, files.count()))
    return each.mapInArrow(read, ROWS)


_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)
