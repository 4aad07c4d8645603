"""WARC archives as a PySpark data source.

Writing: every task writes its own uniquely named files, one gzip member per record; only
files of tasks that Spark committed get into the manifest, so retried and speculative
tasks leave nothing that is read. Reading: one partition per file. Predicates on
``record_type``, ``record_id``, ``target_uri`` and ``payload_digest`` are taken over by the
reader and tested on the record's headers, before its block is looked at: the block of an
unwanted record is passed over in pieces, without being kept, split or decoded. Option
``payload=false`` does so for all records.

Defined results. Null payload: empty. Null record id, address or reference: the header is
left out and read as null. Archives of other writers: a block of type ``application/http``
loses its HTTP head, up to the first empty line; any other block is the payload as it is. Line breaks in a header value become ``%0D`` and ``%0A``. No
rows: an archive without records. Extra columns of the input are not written.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
    StringStartsWith, WriterCommitMessage,
)

from . import files
from .storage import new_folder

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_length bigint, payload binary"
)
HEADERS = {
    "record_type": b"WARC-Type", "record_id": b"WARC-Record-ID", "target_uri": b"WARC-Target-URI",
    "refers_to": b"WARC-Refers-To", "payload_digest": b"WARC-Payload-Digest",
}
_OF_HEADER = {v.lower(): k for k, v in HEADERS.items()}
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 18
_FILE_BYTES = 1 << 28


def _value(text: str) -> bytes:
    return text.replace("\r", "%0D").replace("\n", "%0A").encode()


def record(row: dict) -> bytes:
    """The bytes of one record. A revisit keeps the HTTP head and leaves out the payload."""
    payload = row["payload"] or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    lines = [b"WARC/1.1"]
    for name, header in HEADERS.items():
        if row[name] is not None:
            value = _value(row[name])
            if name in ("record_id", "refers_to"):
                value = b"<" + value + b">"
            elif name == "payload_digest":
                value = b"sha256:" + value
            lines.append(header + b": " + value)
    if revisit:
        lines.append(b"WARC-Profile: " + _PROFILE)
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Committed(WriterCommitMessage):
    def __init__(self, names: list[str], records: int):
        self.names, self.records = names, records


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, codec: str, overwrite: bool):
        self.path, self.codec, self.overwrite = path, codec, overwrite
        files.make_folder(path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, folder = files.opened(self.path)
        names, records, out, size = [], 0, None, 0
        ending = ".warc.gz" if self.codec == "gzip" else ".warc"
        try:
            for batch in iterator:
                for row in _rows(batch):
                    if out is None or size >= _FILE_BYTES:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}{ending}")
                        out, size = fs.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                    data = record(row)
                    if self.codec == "gzip":
                        z = zlib.compressobj(4, zlib.DEFLATED, 31)
                        data = z.compress(data) + z.flush()
                    out.write(data)
                    size += len(data)
                    records += 1
        finally:
            if out is not None:
                out.close()
        return _Committed(names, records)

    def commit(self, messages: list) -> None:
        done = [m for m in messages if m is not None]
        old = None if self.overwrite else files.read_manifest(self.path)
        before = (old or {}).get("files", [])
        files.write_manifest(self.path, {"files": before + sorted(n for m in done for n in m.names)})

    def abort(self, messages: list) -> None:
        files.remove_files(self.path, [n for m in messages if m is not None for n in m.names])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Row by row, so that only one payload at a time is a Python object."""
    columns = {n: batch.column(n) for n in (*HEADERS, "payload")}
    for i in range(batch.num_rows):
        yield {n: c[i].as_py() for n, c in columns.items()}


class _File(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)


class _Bytes:
    """A file, unpacked if it is gzip, from which lines and blocks are read or skipped."""

    def __init__(self, file, packed: bool):
        self.file, self.packed, self.held, self.z = file, packed, b"", None

    def _more(self) -> bool:
        data = self.file.read(_CHUNK)
        if not self.packed:
            self.held += data
            return bool(data)
        while data:
            self.z = self.z or zlib.decompressobj(31)
            self.held += self.z.decompress(data)
            data = self.z.unused_data
            if self.z.eof:
                self.z = None
            else:
                return True
        return bool(self.held) or self.file.tell() < self.file.size()

    def head(self) -> bytes | None:
        """Up to the next empty line; None at the end of the file."""
        at = 0
        while (end := self.held.find(b"\r\n\r\n", max(0, at - 3))) < 0:
            at = len(self.held)
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends within a record")
                return None
        head, self.held = self.held[:end], self.held[end + 4:]
        return head

    def block(self, n: int) -> bytes:
        got = []
        while n > len(self.held):
            got.append(self.held)
            n -= len(self.held)
            self.held = b""
            if not self._more():
                raise ValueError("the archive ends within a record")
        got.append(self.held[:n])
        self.held = self.held[n:]
        return b"".join(got)

    def fields(self, n: int) -> tuple[bytes, int]:
        """The head of a block of ``n`` bytes up to its empty line, and the bytes left to skip."""
        got = b""
        while n and b"\r\n\r\n" not in got[-1027:]:
            size = min(n, 1024)
            got += self.block(size)
            n -= size
        return got.partition(b"\r\n\r\n")[0], n

    def skip(self, n: int) -> None:
        if not self.packed and n > len(self.held):
            self.file.seek(self.file.tell() + n - len(self.held))
            self.held = b""
            return
        while n > len(self.held):
            n -= len(self.held)
            self.held = b""
            if not self._more():
                raise ValueError("the archive ends within a record")
        self.held = self.held[n:]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS and f.attribute[0] != "refers_to":
                self.tests.append((f.attribute[0], type(f).__name__, f.value))
            else:
                yield f

    def partitions(self):
        held = files.read_manifest(self.path)
        names = files.listed(self.path, (".warc", ".warc.gz")) if held is None else held["files"]
        return [_File(n) for n in names]

    def _wanted(self, row: dict) -> bool:
        for name, kind, value in self.tests:
            own = row[name]
            if own is None or not (own == value if kind == "EqualTo" else own in value if kind == "In" else own.startswith(value)):
                return False
        return True

    def read(self, partition):
        if partition is None:  # an archive without files
            return
        fs, folder = files.opened(self.path)
        rows, size = [], 0
        with fs.open_input_file(f"{folder}/{partition.value}") as file:
            source = _Bytes(file, partition.value.endswith(".gz"))
            while (head := source.head()) is not None:
                row, length, http = _parsed(head)
                if not self._wanted(row):
                    source.skip(length + 4)
                    continue
                if self.payload:
                    payload = source.block(length)
                    source.skip(4)
                    fields, _, payload = payload.partition(b"\r\n\r\n") if http else (b"", b"", payload)
                    if row["record_type"] != "revisit":
                        row["payload"] = payload
                        size += len(payload)
                else:
                    fields, left = source.fields(length) if http else (b"", length)
                    source.skip(left + 4)
                if http:
                    row["payload_length"] = next((int(x[15:]) for x in fields.split(b"\r\n") if x[:15].lower() == b"content-length:"), None)
                elif row["record_type"] != "revisit":
                    row["payload_length"] = length
                rows.append(row)
                if size > 1 << 22 or len(rows) >= 4096:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _parsed(head: bytes) -> tuple[dict, int, bool]:
    """The record's headers, the length of its block, and whether that begins with an HTTP head."""
    row, length, http = dict.fromkeys(x.split()[0] for x in SCHEMA.split(", ")), 0, False
    for line in head.lstrip(b"\r\n").split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        name, value = name.strip().lower(), value.strip()
        if name == b"content-length":
            length = int(value)
        elif name == b"content-type":
            http = value.split(b";")[0].strip().lower() == b"application/http"
        elif name in _OF_HEADER:
            key, text = _OF_HEADER[name], value.decode("utf-8", "replace")
            row[key] = text[1:-1] if text[:1] == "<" else text.removeprefix("sha256:") if key == "payload_digest" else text
    return row, length, http


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"payload_length": pa.int64(), "payload": pa.binary()}
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``; options ``payload`` and, to write, ``codec``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true")

    def writer(self, schema, overwrite: bool):
        return WarcWriter(self.options["path"], self.options.get("codec", "gzip"), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def archive_records(pages: DataFrame, key: str, uri: str, payload: str, least: int = 100) -> DataFrame:
    """Rows for the archive: of equal payloads of ``least`` bytes or more, that with the
    smallest key is a response and the others revisit it; all else are responses.

    The smallest key per digest is combined before it is shuffled; rows of one frequent
    payload meet their one-row partner in a join whose large partitions Spark splits. Rows
    that repeat the smallest key of their payload are responses too.
    """
    rows = pages.select(
        F.col(key).cast("string").alias("record_id"), F.col(uri).cast("string").alias("target_uri"),
        F.col(key).alias("k"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= least)
    first = (
        large.groupBy(F.col("payload_digest").alias("d"))
        .agg(F.min("k").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    joined = rows.join(first, (rows.payload_digest == first.d) & (F.octet_length("payload") >= least), "left")
    revisit = F.coalesce(F.col("k") != F.col("first"), F.col("first").isNotNull())
    return joined.select(
        "record_id", F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(revisit, F.col("first").cast("string")).alias("refers_to"), "payload_digest",
        F.octet_length("payload").cast("bigint").alias("payload_length"), "payload")


def write_archive(records: DataFrame, path: str | None = None, codec: str = "gzip") -> str:
    """Write records (columns of ``SCHEMA``); returns the folder."""
    spark = records.sparkSession
    register(spark)
    path = path or new_folder(spark, "warc")
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    records.select(*names).write.format("warc").option("path", path).option("codec", codec).mode("append").save()
    return path


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
