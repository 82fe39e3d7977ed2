"""WARC archives as a PySpark Python data source.

``WarcDataSource`` (format name ``warc``) writes a record per row and reads
records back. The reader plans partitions by file (small files are packed
together, by size), takes over filters on the record type and other header
columns, parses a record's headers first and seeks past the payload unless
the record passes and the requested schema has the payload or its digest.

Files are reached through ``pyarrow.fs`` by URI, so any store that Spark's
workers can reach that way serves; the path must be one that driver and
executors share. A task writes under a name of its own attempt, and the
driver's commit gives the files of successful attempts their final names, so
a lost or repeated task leaves nothing that a reader sees.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from entiscore.session import scratch_path, stored

VERSION = b"WARC/1.1"
# Column -> header field that holds it.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
}
READ_SCHEMA = T.StructType([*(T.StructField(c, T.StringType()) for c in HEADERS), T.StructField("payload_bytes", T.LongType()),
                            T.StructField("payload", T.BinaryType()), T.StructField("actual_digest", T.StringType())])
WRITE_COLUMNS = ("record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _clean(value: str) -> str:
    """A header value holds no control characters: they are percent-coded."""
    return quote(value, safe="".join(chr(c) for c in range(0x20, 0x7F) if chr(c) != "%")) if any(
        ord(c) < 0x20 or ord(c) > 0x7E or c == "%" for c in value) else value


def record(row: dict) -> bytes:
    """One WARC record. A revisit holds the HTTP head alone, which states the
    payload's length; a response holds head and payload."""
    payload = row["payload"] if row["record_type"] == "response" else None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{_clean(row['record_id'])}>"),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", row["target_uri"]),
              ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"), ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", str(len(head) + len(payload or b"")))]
    if row["refers_to"] is not None:
        fields += [("WARC-Refers-To", f"<{_clean(row['refers_to'])}>"), ("WARC-Profile", REVISIT_PROFILE)]
    lines = b"".join(f"{k}: {v if k in ('WARC-Refers-To', 'WARC-Record-ID') else _clean(v)}\r\n".encode() for k, v in fields if v is not None)
    return VERSION + b"\r\n" + lines + b"\r\n" + head + (payload or b"") + b"\r\n\r\n"


@dataclass
class _Files(WriterCommitMessage):
    names: list[tuple[str, str]]


class WarcWriter(DataSourceArrowWriter):
    """Rows of ``WRITE_COLUMNS`` as ``*.warc`` files, a new one every ``rollBytes``."""

    def __init__(self, options: dict):
        self.path, self.roll = options["path"].rstrip("/"), int(options.get("rollBytes", 64 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        fs, base = _fs(self.path)
        fs.create_dir(base, recursive=True)
        part, attempt, names, out, size = TaskContext.get().partitionId(), uuid.uuid4().hex, [], None, 0
        try:
            for batch in iterator:
                columns = [batch.column(batch.schema.get_field_index(c)) for c in WRITE_COLUMNS]
                for i in range(batch.num_rows):
                    if out is None or size >= self.roll:
                        if out is not None:
                            out.close()
                        name = f"part-{part:05d}-{len(names):04d}-{attempt}.warc"
                        names.append((f".{name}.tmp", name))
                        out, size = fs.open_output_stream(f"{base}/.{name}.tmp"), 0
                    data = record({c: v[i].as_py() for c, v in zip(WRITE_COLUMNS, columns, strict=True)})
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return _Files(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, base = _fs(self.path)
        fs.create_dir(base, recursive=True)
        for m in messages:
            for temporary, name in m.names if m else []:
                fs.move(f"{base}/{temporary}", f"{base}/{name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, base = _fs(self.path)
        for m in messages:
            for temporary, _ in m.names if m else []:
                if fs.get_file_info(f"{base}/{temporary}").type == pafs.FileType.File:
                    fs.delete_file(f"{base}/{temporary}")


@dataclass
class _Group(InputPartition):
    files: list[str]


def _header_test(f: Filter):
    """The filter as a test of a record's header columns, or None."""
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in HEADERS:
        return None
    c = f.attribute[0]
    if isinstance(f, EqualTo):
        return lambda h: h.get(c) is not None and h[c] == f.value
    if isinstance(f, EqualNullSafe):
        return lambda h: h.get(c) == f.value
    if isinstance(f, In):
        return lambda h: h.get(c) is not None and h[c] in f.value
    if isinstance(f, StringStartsWith):
        return lambda h: h.get(c) is not None and h[c].startswith(f.value)
    if isinstance(f, IsNotNull):
        return lambda h: h.get(c) is not None
    if isinstance(f, IsNull):
        return lambda h: h.get(c) is None
    return None


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.names = options["path"].rstrip("/"), [f.name for f in schema.fields]
        self.pack = int(options.get("packBytes", 64 << 20))
        self.schema = pa.schema([(f.name, {"long": pa.int64(), "binary": pa.binary()}.get(f.dataType.simpleString().replace("bigint", "long"), pa.string()))
                                 for f in schema.fields])
        self.tests: list = []
        self.skipped = 0

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            test = _header_test(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[InputPartition]:
        fs, base = _fs(self.path)
        found = [i for i in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if i.is_file and i.base_name.endswith(".warc")
                 and i.base_name[0] not in "._"]
        groups, size = [], 0
        for i in sorted(found, key=lambda i: i.path):
            if not groups or size + i.size > self.pack:
                groups.append(_Group([]))
                size = 0
            groups[-1].files.append(i.path)
            size += i.size
        return groups or [_Group([])]

    def read(self, partition: _Group) -> Iterator[pa.RecordBatch]:
        fs, _ = _fs(self.path)
        rows, size = [], 0
        for path in partition.files:
            with fs.open_input_file(path) as raw:
                for row in self._records(raw):
                    rows.append(row)
                    size += 200 + len(row.get("payload") or b"")
                    if size > 4 << 20:
                        yield self._batch(rows)
                        rows, size = [], 0
        yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=self.schema)

    def _records(self, raw) -> Iterator[dict]:
        at, end, wants = 0, raw.size(), {"payload", "actual_digest"} & set(self.names)
        while at < end:
            head, body = _head(raw, at, VERSION)
            length = int(head["content-length"])
            row = {c: _unhead(c, head.get(field.lower())) for c, field in HEADERS.items()}
            if all(test(row) for test in self.tests):
                http, start = _head(raw, body, b"HTTP/")
                row["payload_bytes"] = int(http["content-length"])
                if wants:  # the payload is read only when a row of it is asked for
                    raw.seek(start)
                    data = raw.read(body + length - start)
                    if row["record_type"] == "response":
                        if len(data) != row["payload_bytes"]:
                            raise ValueError(f"record {row['record_id']}: {len(data)} bytes of {row['payload_bytes']}")
                        row["payload"], row["actual_digest"] = data, hashlib.sha256(data).hexdigest()
                yield {c: row.get(c) for c in self.names}
            at = body + length + 4


def _unhead(column: str, value: str | None) -> str | None:
    if value is None:
        return None
    if column in ("record_id", "refers_to"):
        value = value.strip("<>")
    elif column == "payload_digest":
        value = value.partition(":")[2]
    return unquote(value)


def _head(raw, at: int, first: bytes, step: int = 1024) -> tuple[dict[str, str], int]:
    """Header fields that begin at ``at``, and where they end."""
    raw.seek(at)
    data = b""
    while (stop := data.find(b"\r\n\r\n")) < 0:
        more = raw.read(step)
        if not more:
            raise ValueError(f"a record's header at byte {at} has no end")
        data += more
    lines = data[:stop].split(b"\r\n")
    if not lines[0].startswith(first):
        raise ValueError(f"no record at byte {at}: {lines[0][:40]!r}")
    return {k.decode().lower(): v.decode() for k, _, v in (x.partition(b": ") for x in lines[1:])}, at + stop + 4


class WarcDataSource(DataSource):
    """``spark.read.format("warc").schema(...).load(path)`` and
    ``df.write.format("warc").mode("append").save(path)``. A schema without
    ``payload`` and ``actual_digest`` reads headers only."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return READ_SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Register the format and let Spark hand filters to Python data sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 100) -> DataFrame:
    """A record per page: the first of equal payloads of at least
    ``least_bytes`` bytes is the response, the others revisit it.

    First is the smallest id; rows that repeat that id with that payload are
    responses too. Null ids come last (if all are null, all are responses) and
    a null text is an empty payload. An empty table gives no records; other
    columns are not read. Only digests are grouped, and only those of repeated
    payloads are joined back.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    firsts = (rows.filter(F.col("bytes") >= least_bytes).groupBy(F.col("digest").alias("d"))
              .agg(F.min("id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies"))
    # Stored, so that Spark knows its size: payloads are shuffled only if many payloads repeat.
    firsts = stored(firsts, "warc-firsts")
    rows = rows.join(firsts, F.col("digest") == F.col("d"), "left")
    again = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    return rows.select(name(F.col("id")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"),
                       F.col("url").alias("target_uri"), F.when(again, name(F.col("first"))).alias("refers_to"),
                       F.col("digest").alias("payload_digest"), F.col("bytes").alias("payload_bytes"), F.when(~again, F.col("payload")).alias("payload"))


def archive(pages: DataFrame, path: str | None = None, **columns) -> str:
    """Write the pages' records below ``path`` (a fresh shared folder if none is given)."""
    register(pages.sparkSession)
    path = path or scratch_path(pages.sparkSession, "warc")
    records(pages, **columns).write.format("warc").mode("append").save(path)
    return path


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of an archive; without payloads only headers are parsed."""
    register(spark)
    schema = T.StructType([f for f in READ_SCHEMA.fields if payload or f.name not in ("payload", "actual_digest")])
    return spark.read.format("warc").schema(schema).load(path)
