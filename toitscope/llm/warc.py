"""Web pages written to WARC archives of independent Zstandard frames, and read back by place.

An archive is a run of frames, each holding some records whole, and ends in a skippable frame with the seek table of
the public seekable format: the packed and plain size of every frame. An index row says, for a record, the archive,
the frame and where in the unpacked frame the record lies, so one record costs one frame to read. A task writes its
archives under names of its own try, and the index that Spark commits names only those of tries that counted: a task
that is run again leaves files nobody reads, never a record twice.

Pages with equal payloads are stored once: the page with the least id is the response, the others are revisits that
carry the response's header and name it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toitscope.llm.shared import small_batches, staged, text_of
from toitscope.session import shared_folder

FRAME_BYTES = 1 << 18
ARCHIVE_BYTES = 1 << 28
READ_BYTES = 1 << 25
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the seekable Zstandard format and of the WARC standard.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder named by URI or path, and the path in it."""
    if re.match(r"file:/(?!/)|/", uri):
        return pyarrow.fs.LocalFileSystem(), uri.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(uri)


def response_head(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def record(page_id, url: str | None, digest: str, payload_bytes: int, refers_to, payload: bytes | None) -> bytes:
    """One WARC record; without ``payload`` a revisit of page ``refers_to``."""
    block = response_head(payload_bytes) + (payload or b"")
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if payload is None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>")]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """What a record says about its page; the digest of a response is taken from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?mi)^Content-Length: (\d+)", http)[1])
    kind = fields["WARC-Type"]
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != stated or len(payload) != size:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    named = lambda name: fields.get(name, "")[len("<urn:page:") : -1]
    return {
        "page_id": named("WARC-Record-ID") or None,
        "url": fields.get("WARC-Target-URI"),
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": stated,
        "refers_to": named("WARC-Refers-To") or None,
        "payload": payload if kind == "response" else None,
    }


class Archive:
    """One archive being written."""

    def __init__(self, files: pyarrow.fs.FileSystem, path: str):
        self.out, self.sizes, self.size = files.open_output_stream(path, compression=None), [], 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def frame(self, records: list[bytes]) -> None:
        plain = b"".join(records)
        packed = self.packer.compress(plain)
        self.out.write(packed)
        self.sizes.append((len(packed), len(plain)))
        self.size += len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.sizes)
        foot = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(foot)) + table + foot)
        self.out.close()


class Reader:
    """One archive opened for reading by frame."""

    def __init__(self, files: pyarrow.fs.FileSystem, path: str):
        self.file = files.open_input_file(path)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.places, at = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.places.append((at, packed, plain))
            at += packed
        self.last: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        if self.last[0] != number:
            at, packed, plain = self.places[number]
            data = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain)
            self.last = (number, data)
        return self.last[1]


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least_revisit_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Write a record for each row of ``pages``; the index ``page_id, file, frame, start, length``, already stored.

    Archives in a named ``folder`` stay, with their index beside them (``read_index``), and so does all else in it;
    without a name the archives and the index go when the driver's session ends.
    A null payload is empty. Of records with equal payloads of at least ``least_revisit_bytes`` bytes the one with
    the least id is the response, a null id after all others; rows that repeat its id are responses too. A null url
    has no header line. Other columns are not read. An empty table gives an empty index.
    """
    spark = pages.sparkSession
    small_batches(spark)
    named = folder is not None
    if not named:
        folder = f"{shared_folder(spark)}/llm/archives-{uuid.uuid4().hex}"
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(place)  # a folder that is not there yet cannot be marked
        files.deleteOnExit(place)
    kind = pages.schema[id_column].dataType
    read = pages.select(
        F.col(id_column).alias("page_id"),
        F.col(url_column).alias("url"),
        text_of(html_column).alias("html"),
    ).withColumns({"bytes": F.octet_length("html").cast("bigint"), "digest": F.sha1(F.encode("html", "utf-8"))})
    shared = staged(
        read.where(F.col("bytes") >= least_revisit_bytes)
        .groupBy("digest", F.col("bytes").alias("same_bytes"))
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
        .where("n > 1")
        .select("digest", "same_bytes", "first"),
        "payloads",
    )
    revisit = F.col("same_bytes").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    records = (
        read.join(shared, (read["digest"] == shared["digest"]) & (F.col("bytes") == F.col("same_bytes")), "left")
        .select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "bytes", read["digest"], F.when(revisit, F.col("first")).alias("refers_to"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = file_system(folder)
        files.create_dir(path, recursive=True)
        archive, name, waiting, held, rows = None, "", [], 0, []
        for batch in batches:
            for page_id, url, html, size, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    archive = Archive(files, f"{path}/{name}")
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                data = record(page_id, url, digest, size, refers_to, None if html is None else html.encode("utf-8", "surrogatepass"))
                rows.append((page_id, name, len(archive.sizes), held, len(data)))
                waiting.append(data)
                held += len(data)
                if held >= frame_bytes:
                    archive.frame(waiting)
                    waiting, held = [], 0
                    if archive.size >= archive_bytes:
                        archive.close()
                        archive = None
                        yield index(rows)
                        rows = []
        if archive is not None:
            if waiting:
                archive.frame(waiting)
            archive.close()
            yield index(rows)

    def index(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [id_kind, pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = ["page_id", "file", "frame", "start", "length"]
    id_kind = {"string": pa.string(), "int": pa.int32()}.get(kind.simpleString(), pa.int64())
    schema = T.StructType(
        [T.StructField("page_id", kind), T.StructField("file", T.StringType())]
        + [T.StructField(x, T.LongType()) for x in ("frame", "start", "length")]
    )
    written = records.mapInArrow(write, schema)
    if not named:
        return _placed(staged(written, "archive-index"), folder)
    path = f"{folder}/index-{uuid.uuid4().hex}"
    written.write.option("compression", "zstd").parquet(path)
    return _placed(spark.read.schema(schema).parquet(path), folder)


def _placed(index: DataFrame, folder: str) -> DataFrame:
    return index.withColumn("file", F.concat(F.lit(f"{folder}/"), "file"))


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of all archives that were written to a named folder, wherever the folder lies now."""
    return _placed(spark.read.parquet(f"{folder}/index-*"), folder)


def read_records(index: DataFrame, read_bytes: int = READ_BYTES, with_payload: bool = True) -> DataFrame:
    """The records an index names: ``page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload``.

    Ids are text, as the archives hold them. A revisit has no payload of its own. Tasks get whole frames and open an
    archive once for all of theirs. A response whose payload disagrees with its digest is an error.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // read_bytes))
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload
    schema = "page_id string, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, Reader] = {}
        for batch in batches:
            rows = []
            for file, frame, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file not in opened:
                    files, path = file_system(file)
                    opened = {file: Reader(files, path)}
                rows.append(parsed(opened[file].frame(frame)[start : start + length]))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[n] for row in rows], k) for n, k in zip(names, kinds, strict=False)], names=names
            )

    dealt = index.select("file", "frame", "start", "length").repartition(tasks, "file", "frame")
    ordered = dealt.sortWithinPartitions("file", "frame", "start")
    return ordered.mapInArrow(read, schema + (", payload binary" if with_payload else ""))
