"""WARC archives: written by Spark's text writer, read by a Python data source.

**Writing.** Each row becomes one record. Records with equal payloads of at least ``REVISIT_BYTES``
are revisits of the one with the smallest id, told by SHA-256. Files are plain WARC/1.1 and bounded by
``RECORDS_PER_FILE``; the text writer works on every store Spark writes to and commits by task, so a
lost executor leaves no half archive.

**Reading.** The driver lists the files and plans partitions of about ``PARTITION_BYTES`` from
their sizes. A task reads headers first; predicates on the record type and on header fields that
Spark pushes down are tested on them, and the payload of a record that fails, or any payload if
``payload`` is ``false``, is skipped without being read or decoded.

Null payloads are empty; empty and small ones are never revisits. A null id writes no id header
and reads back as null; it refers to the smallest id, or is a response if its payload has none.
Rows that repeat an id with the same payload are records of the same kind. Line breaks and other
control characters of a URL are percent-encoded; a null URL has no header. Columns other than the
id, the URL and the payload are not written. An empty table makes an archive without records.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull

from lodestone.llm.common import stored
from lodestone.operators.topk import join_counted

REVISIT_BYTES = 100
RECORDS_PER_FILE = 50_000
PARTITION_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
SCHEMA = """record_type string, record_id string, page_id long, target_uri string, payload_digest string,
payload_bytes long, refers_to long, payload binary"""
#: Header field of each column a predicate may be pushed down on.
FIELDS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "page_id": "x-page-id",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "payload_bytes": "x-payload-length",
    "refers_to": "x-refers-to-page",
}
NUMBERS = {"page_id", "payload_bytes", "refers_to"}


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``record``: the whole record of each page as text, without the empty lines that end it."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), payload.alias("html"))
    size = F.octet_length("html").cast("long")
    rows = rows.withColumns({"digest": F.sha2("html", 256), "size": size})
    groups = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    groups = stored(groups.where("n > 1 AND least IS NOT NULL").drop("n"), "copies")
    rows = join_counted(rows, groups, "digest", "left")
    revisit = F.col("least").isNotNull() & ~F.col("id").eqNullSafe(F.col("least"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    block = F.concat(F.lit(HTTP), body)

    def field(name: str, value) -> F.Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))

    safe = F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    name = F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("null")), "digest"), 256), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", name),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", safe),
        field("X-Page-ID", F.col("id").cast("string")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("X-Payload-Length", F.col("size").cast("string")),
        field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        field("X-Refers-To-Page", F.when(revisit, F.col("least").cast("string"))),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, block).alias("record"))


def write_warc(pages: DataFrame, path: str, **columns: str) -> None:
    """Write the pages as ``.txt`` part files of WARC records below ``path``."""
    out = records(pages, **columns).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE)
    out.text(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below ``path``; filters on the columns of ``FIELDS`` are pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("lodestone_warc").option("payload", str(payload).lower()).load(path)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lodestone_warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


class FilePart(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true") == "true"
        self.tests: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters) -> Iterator:
        """Take over equality tests on header columns; Spark evaluates the others."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in FIELDS and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.tests.append((FIELDS[name], frozenset([str(f.value)])))
            elif name in FIELDS and isinstance(f, In) and None not in f.value:
                self.tests.append((FIELDS[name], frozenset(map(str, f.value))))
            elif name in FIELDS and isinstance(f, IsNotNull):
                self.tests.append((FIELDS[name], frozenset()))
            else:
                yield f

    def partitions(self) -> list[FilePart]:
        from pyarrow.fs import FileSelector, FileSystem, FileType

        store, root = FileSystem.from_uri(_uri(self.path))
        info = store.get_file_info(root)
        found = [info] if info.type == FileType.File else store.get_file_info(FileSelector(root, recursive=True))
        files = sorted((f for f in found if f.type == FileType.File and f.size and f.base_name[0] not in "._"), key=lambda f: f.path)
        out, size = [], PARTITION_BYTES
        for f in files:
            if size + f.size > PARTITION_BYTES:
                out.append([])
                size = 0
            out[-1].append(f.path)
            size += f.size
        return [FilePart(p) for p in out] or [FilePart([])]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        store, _ = FileSystem.from_uri(_uri(self.path))
        kinds = pa.schema(
            [(c, pa.int64() if c in NUMBERS else pa.string()) for c in FIELDS] + [("payload", pa.binary())]
        )
        rows, size = [], 0
        for path in partition.files:
            with store.open_input_file(path) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else _Buffered(raw)
                for row in read_records(stream, self.tests, self.payload):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)


def _uri(path: str) -> str:
    return path if "://" in path else "file://" + path.removeprefix("file:")


class _Buffered:
    """Lines and blocks of a file that can be sought in, read a megabyte at a time."""

    def __init__(self, raw, size: int = 1 << 20):
        self.raw, self.size, self.data, self.at = raw, size, b"", 0

    def _more(self) -> bool:
        data = self.raw.read(self.size)
        self.data, self.at = self.data[self.at :] + data, 0
        return bool(data)

    def readline(self) -> bytes:
        while (end := self.data.find(b"\n", self.at)) < 0:
            if not self._more():
                end = len(self.data) - 1
                break
        line, self.at = self.data[self.at : end + 1], end + 1
        return line

    def read(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        self.at += len(out)
        return out + self.raw.read(n - len(out)) if len(out) < n else out

    def skip(self, n: int) -> None:
        held = min(n, len(self.data) - self.at)
        self.at += held
        if n > held:
            self.raw.seek(n - held, 1)


def read_records(stream, tests: list[tuple[str, frozenset]], payload: bool) -> Iterator[dict]:
    """The records that pass the tests on their headers; the bytes of others are passed over."""
    skip = getattr(stream, "skip", stream.read)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"no WARC record begins with {line[:40]!r}")
            continue
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        length = int(head.get("content-length", 0))
        if "warc-payload-digest" in head:
            head["warc-payload-digest"] = head["warc-payload-digest"].partition(":")[2]
        if any(field not in head or (values and head[field] not in values) for field, values in tests):
            skip(length)
            continue
        row = {c: head.get(f) for c, f in FIELDS.items()}
        row |= {c: int(row[c]) for c in NUMBERS if row[c] is not None}
        row["payload"] = None
        if payload and head.get("warc-type") != "revisit":
            block = stream.read(length)
            row["payload"] = block.partition(b"\r\n\r\n")[2] if "application/http" in head.get("content-type", "") else block
        else:
            skip(length)
        yield row


def archive(pages: DataFrame, path: str) -> DataFrame:
    """Write the pages to ``path`` and read them back: one row per page.

    The digest and size of a response are taken from the payload that was read; a revisit has its
    own headers' values.
    """
    write_warc(pages, path)
    rows = read_warc(pages.sparkSession, path)
    response = F.col("record_type") == "response"
    return rows.select(
        "page_id",
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
