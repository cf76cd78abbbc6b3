"""WARC archives as a PySpark data source, and page archives with revisit records."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

#: Columns and the named fields they are read from and written to; ``payload`` is the block.
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "WARC-Payload-Length",
}
SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c == "payload_length" else T.StringType()) for c in FIELDS]
    + [T.StructField("payload", T.BinaryType())]
)
#: Bytes after which a writer begins a new file, and of files that one read task gets.
FILE_BYTES, TASK_BYTES = 64 << 20, 128 << 20
_BATCH_BYTES = 4 << 20
_GZIP = struct.Struct("<4sIBBH2sHII")  # head with one extra field: lengths of the member, packed and unpacked


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path (local, hdfs, s3, gs, ...) and the path in it."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path.removeprefix("file:")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _one_line(value: str) -> str:
    """A field's value without line breaks, which would end it."""
    return " ".join(value.split("\r")).replace("\n", " ").strip()


def record_bytes(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {_one_line(v)}" for k, v in fields.items() if v is not None]]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode()
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """A gzip member of one record; its extra field tells both lengths, so that it can be skipped."""
    pack = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = pack.compress(record) + pack.flush()
    size = _GZIP.size + len(body) + 8
    head = _GZIP.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, size, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _head(text: bytes) -> dict[str, str]:
    """Named fields in lower case; a line that begins with a blank continues the one before."""
    fields: dict[str, str] = {}
    last = None
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields


@dataclass
class Wanted:
    """Which records are wanted, by what their heads say: column -> allowed values or prefixes."""

    values: dict[str, set]
    prefixes: dict[str, str]

    def takes(self, row: dict) -> bool:
        return all(row[c] in allowed for c, allowed in self.values.items()) and all(
            (row[c] or "").startswith(p) for c, p in self.prefixes.items()
        )


def _row(fields: dict[str, str]) -> dict:
    row = {column: fields.get(name.lower()) for column, name in FIELDS.items()}
    length = row["payload_length"]
    row["payload_length"] = int(length) if length and length.isdigit() else None
    return row


def read_records(stream, wanted: Wanted, payloads: bool) -> Iterator[tuple[dict, bytes | None]]:
    """(columns, block) of the wanted records of a file, packed by record or plain.

    Heads are parsed first. The block of a record that is not wanted is skipped: by the
    member's length where it is told, and by the content length in a plain file.
    """
    start = stream.read(2)
    stream.seek(0)
    if start == b"\x1f\x8b":
        yield from _read_packed(stream, wanted, payloads)
    else:
        yield from _read_plain(stream, wanted, payloads)


def _read_plain(stream, wanted: Wanted, payloads: bool) -> Iterator[tuple[dict, bytes | None]]:
    at, size = 0, stream.size()
    while at < size:
        stream.seek(at)
        head = b""
        while (end := head.find(b"\r\n\r\n")) < 0:
            more = stream.read(4096)
            if not more:
                if head.strip():
                    raise ValueError("the archive ends within a record's head")
                return
            head = (head + more).lstrip(b"\r\n") if not head else head + more
            at = stream.tell() - len(head)
        fields = _head(head[:end])
        length = int(fields["content-length"])
        row = _row(fields)
        if wanted.takes(row):
            block = None
            if payloads:
                stream.seek(at + end + 4)
                block = stream.read(length)
                if len(block) < length:
                    raise ValueError("the archive ends within a record")
            yield row, block
        at += end + 4 + length


def _read_packed(stream, wanted: Wanted, payloads: bool) -> Iterator[tuple[dict, bytes | None]]:
    at, size = 0, stream.size()
    while at < size:
        stream.seek(at)
        unpack, text, used, end = zlib.decompressobj(31), b"", b"", -1
        told = _told_size(stream.read(_GZIP.size))
        stream.seek(at)
        # only as much is unpacked as the head needs
        while end < 0 and not unpack.eof:
            used = unpack.unconsumed_tail or stream.read(4096)
            if not used:
                raise ValueError("the archive ends within a record")
            text += unpack.decompress(used, 1024)
            end = text.find(b"\r\n\r\n")
        if end < 0:
            raise ValueError("a record without a head")
        fields = _head(text[:end])
        row, length = _row(fields), int(fields["content-length"])
        takes = wanted.takes(row)
        if not (takes and payloads) and told:
            at += told
        else:
            parts = [text]
            while not unpack.eof:
                more = unpack.unconsumed_tail or stream.read(1 << 18)
                if not more:
                    raise ValueError("the archive ends within a record")
                parts.append(unpack.decompress(more))
            text = b"".join(parts)
            at = stream.tell() - len(unpack.unused_data)
        if takes:
            block = text[end + 4 : end + 4 + length] if payloads else None
            if payloads and len(block) < length:
                raise ValueError("a record is shorter than its content length")
            yield row, block


def _told_size(head: bytes) -> int:
    """The packed length that a member's extra field tells; 0 if it has none."""
    if len(head) < _GZIP.size:
        return 0
    flags, _, _, _, extra, name, length, size, _ = _GZIP.unpack(head)
    return size if flags[3] & 4 and extra == 12 and name == b"sl" and length == 8 else 0


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, options: dict[str, str]) -> None:
        self.path = path
        self.payloads = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.wanted = Wanted({}, {})
        if kinds := options.get("recordTypes"):
            self.wanted.values["record_type"] = {k.strip() for k in kinds.split(",")}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality, membership and prefixes of named fields are decided by the heads; the rest goes back."""
        for one in filters:
            column = ".".join(one.attribute) if hasattr(one, "attribute") else None
            if column not in FIELDS:
                yield one
            elif isinstance(one, EqualTo):
                self._allow(column, {one.value})
            elif isinstance(one, In):
                self._allow(column, set(one.value))
            elif isinstance(one, StringStartsWith) and column not in self.wanted.prefixes:
                self.wanted.prefixes[column] = one.value
            elif not (isinstance(one, IsNotNull) and column in self.wanted.values):
                yield one

    def _allow(self, column: str, values: set) -> None:
        values = values - {None}
        self.wanted.values[column] = self.wanted.values.get(column, values) & values

    def partitions(self) -> list[Files]:
        """Files by name, as many together as make a task's share."""
        system, root = filesystem(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((i.path, i.size) for i in found if i.is_file and i.path.endswith((".warc", ".warc.gz")))
        shares: list[list[str]] = []
        held = TASK_BYTES
        for path, size in files:
            if held + size > TASK_BYTES:
                shares.append([])
                held = 0
            shares[-1].append(path)
            held += size
        return [Files(tuple(s)) for s in shares] or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as stream:
                for row, block in read_records(stream, self.wanted, self.payloads or self.verify):
                    if self.verify and row["record_type"] == "response":
                        told = (row["payload_digest"] or "").removeprefix("sha1:")
                        if told != digest_of(block) or row["payload_length"] not in (None, len(block)):
                            raise ValueError(f"the payload of {row['record_id']} is not what its head says")
                    row["payload"] = block if self.payloads else None
                    rows.append(row)
                    held += len(block or b"") + 256
                    if held >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(SCHEMA))
                        rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(SCHEMA))


class WarcWriter(DataSourceArrowWriter):
    """Each attempt of a task writes files of its own; only those of successful tasks become visible.

    Files are written below ``_attempts`` and moved beside it when the job commits, so
    a task that ran twice or was lost leaves nothing that a reader would see.
    """

    def __init__(self, path: str) -> None:
        self.path, self.job = path, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = filesystem(self.path)
        folder = f"{root}/_attempts/{self.job}"
        system.create_dir(folder, recursive=True)
        paths: list[str] = []
        out = None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or out.tell() >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    paths.append(f"{folder}/part-{uuid.uuid4().hex}.warc.gz")
                    out = system.open_output_stream(paths[-1], compression=None)
                    out.write(member(record_bytes({"WARC-Type": "warcinfo", "WARC-Date": row["date"]}, b"")))
                fields = {name: None if row[c] is None else str(row[c]) for c, name in FIELDS.items()}
                out.write(member(record_bytes(fields, row["payload"] or b"")))
        if out is not None:
            out.close()
        return Written(tuple(paths))

    def commit(self, messages: list[Written | None]) -> None:
        system, root = filesystem(self.path)
        for message in messages:
            for path in message.paths if message else ():
                system.move(path, f"{root}/{path.rsplit('/', 1)[1]}")
        self._clear(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*filesystem(self.path))

    def _clear(self, system: fs.FileSystem, root: str) -> None:
        folder = f"{root}/_attempts/{self.job}"
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").save(folder)``.

    Options of a read: ``recordTypes`` (comma-separated), ``payload`` (false: null
    payloads, blocks are skipped), ``verify`` (true: the payloads of responses must have
    the length and digest that their heads tell).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if [f.name for f in schema] != [f.name for f in SCHEMA]:
            raise ValueError(f"WARC records have the columns {[f.name for f in SCHEMA]}")
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known and let Spark hand filters to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_pages(
    pages: DataFrame,
    path: str,
    least: int = 0,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record for each page below ``path``.

    Of pages with equal payloads of ``least`` bytes or more, the one with the largest
    key is a response and the others are revisits of it without a payload; smaller
    payloads are all responses. Only keys and digests are compared, by a partial
    aggregate and a join that Spark can split, so a payload that a third of all pages
    have lands in no single task; pages are joined by key.

    Null pages are empty payloads; a page without a key is a revisit if another page
    with a key has its payload; several rows with the largest key are all responses;
    null addresses are left out; other columns are not written.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    small = rows.where(F.col("size") >= least).select("key", "sha1")
    best = small.groupBy("sha1").agg(F.max("key").alias("best"), F.count("*").alias("n")).where("n > 1 and best is not null")
    again = small.distinct().join(best, "sha1").where(~F.col("key").eqNullSafe(F.col("best")))
    again = again.select(F.col("key").alias("k"), F.col("sha1").alias("s"), "best")
    joined = rows.join(again, rows["key"].eqNullSafe(again["k"]) & (rows["sha1"] == again["s"]), "left")
    revisits = F.col("best").isNotNull()

    def record(k):
        return F.concat(F.lit("<urn:record:"), F.coalesce(k.cast("string"), F.lit("none")), F.lit(">"))

    made = joined.select(
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        record(F.col("key")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(revisits, record(F.col("best"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), base32(F.col("sha1"))).alias("payload_digest"),
        F.col("size").alias("payload_length"),
        F.when(~revisits, F.col("payload")).alias("payload"),
    )
    made.write.format("warc").mode("append").save(path)


def base32(hexadecimal):
    """Upper-case base32 of 40 hexadecimal digits, five digits at a time."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    pieces = []
    for i in range(0, 40, 5):  # 5 digits are 20 bits: four signs
        number = F.conv(F.substring(hexadecimal, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            pieces.append(F.substring(F.lit(alphabet), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*pieces)
