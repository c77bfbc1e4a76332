"""Files below a bucket or folder: listed, filtered, read and written as rows.

The files are a data source of their own, because Spark's file scans leave out empty files and
names that start with a dot or an underscore.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringEndsWith,
    StringStartsWith,
)

from lodestone.functions.scalars import CONTENT_TYPES, UNKNOWN_CONTENT_TYPE

FORMAT = "lodestone_files"
COLUMNS = "path string, name string, size_bytes bigint, content_type string, modified timestamp"
PARTITION_BYTES = 128 << 20  # contents of one task
OPEN_BYTES = 1 << 20  # what a file costs beside its contents
BATCH_BYTES = 8 << 20
LARGEST = (1 << 31) - 1024  # Spark holds no larger binary value

COMPARISONS: dict[type, Callable] = {
    EqualTo: lambda a, b: a == b,
    EqualNullSafe: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    In: lambda a, b: a in b,
    StringEndsWith: lambda a, b: a.endswith(b),
    StringStartsWith: lambda a, b: a.startswith(b),
}


def content_type_of(name: str) -> str:
    _, dot, extension = name.rpartition(".")
    return CONTENT_TYPES.get(extension.lower(), UNKNOWN_CONTENT_TYPE) if dot else UNKNOWN_CONTENT_TYPE


def open_store(path: str):
    """The file system of a path or URI, the path within it, and what stands before that path."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if path.startswith("file:"):
        return LocalFileSystem(), "/" + path[5:].lstrip("/"), "file://"
    if "://" not in path:
        return LocalFileSystem(), path, ""
    scheme, rest = path.split("://", 1)
    store, inner = FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + "://" + rest)
    return store, inner, path[: len(path) - len(inner)] if path.endswith(inner) else f"{scheme}://"


class FileSource(DataSource):
    """Options: ``path``; ``patterns``, globs on the name, one a line; ``content``, whether to read the files."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COLUMNS + (", content binary" if self.options.get("content") == "true" else "")

    def reader(self, schema) -> FileReader:
        return FileReader(self.options)


class Files(InputPartition):
    def __init__(self, files: list[tuple]):
        self.files = files


class FileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.patterns = [p for p in options.get("patterns", "").split("\n") if p]
        self.content = options.get("content") == "true"
        self.part_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.tests: list[tuple[int, Callable, object]] = []

    def pushFilters(self, filters) -> Iterator:
        """Take over comparisons of listed columns with values; Spark evaluates the others."""
        places = {c.split()[0]: i for i, c in enumerate(COLUMNS.split(", "))}
        for f in filters:
            place = places.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if place is not None and isinstance(f, IsNotNull):
                continue  # no listed column is ever null
            test = COMPARISONS.get(type(f))
            value = getattr(f, "value", None)
            zoned = isinstance(value, datetime.datetime) and value.tzinfo is None
            unfit = value is None or zoned or isinstance(f, In) and (None in value or place == 4)
            if place is None or test is None or unfit:
                yield f
            else:
                self.tests.append((place, test, value))

    def listed(self) -> Iterator[tuple]:
        from pyarrow.fs import FileSelector, FileType

        store, inner, before = open_store(self.root)
        info = store.get_file_info(inner)
        found = [info] if info.type == FileType.File else store.get_file_info(FileSelector(inner, recursive=True))
        for f in found:
            if f.type != FileType.File or self.patterns and not any(fnmatchcase(f.base_name, p) for p in self.patterns):
                continue
            row = (before + f.path, f.base_name, f.size, content_type_of(f.base_name), f.mtime)
            if all(test(row[place], value) for place, test, value in self.tests):
                yield row

    def partitions(self) -> list[Files]:
        """Files in the order of their paths, packed by bytes when their contents are read, else by number."""
        out, size = [], self.part_bytes
        for row in sorted(self.listed()):
            cost = OPEN_BYTES + row[2] if self.content else 1 << 10
            if out and size + cost <= self.part_bytes:
                out[-1].append(row)
                size += cost
            else:
                out.append([row])
                size = cost
        return [Files(p) for p in out] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.timestamp("us", "UTC")]
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        store = open_store(self.root)[0]
        skip = len(open_store(self.root)[2])
        held, contents, size = [], [], 0

        def batch() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*held), kinds)]
            extra = [pa.array(contents, pa.binary())] if self.content else []
            return pa.RecordBatch.from_arrays(arrays + extra, names + ["content"] * len(extra))

        for row in partition.files:
            if self.content:
                if row[2] > LARGEST:
                    raise ValueError(f"{row[0]} has {row[2]} bytes; bound the size or read it without content")
                with store.open_input_stream(row[0][skip:]) as stream:
                    contents.append(stream.read())
            held.append(row)
            size += 500 + (row[2] if self.content else 0)
            if size > BATCH_BYTES:
                yield batch()
                held, contents, size = [], [], 0
        if held:
            yield batch()


def scan_object_files(
    spark: SparkSession,
    root: str,
    file_patterns: list[str] | None = None,
    max_file_size_mb: int = 0,
    allowed_content_types: list[str] | None = None,
    max_files_per_job: int = 0,
    with_content: bool = False,
) -> DataFrame:
    """``path, name, size_bytes, content_type, modified [, content]`` of the files to ingest.

    Patterns are globs on the file name, any of which may match. Zero or empty bounds are
    unset. Every file counts, empty and hidden ones too. Patterns, sizes and types are tested on
    the listing, as are further comparisons of these columns; only what is left is packed into
    tasks and, if asked for, read. A bound on the number of files keeps the first by path. An
    allowed type without parameters allows any parameters.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FileSource)

    def load(content: bool) -> DataFrame:
        reader = spark.read.format(FORMAT).option("content", str(content).lower())
        files = reader.option("patterns", "\n".join(file_patterns or [])).load(root)
        if max_file_size_mb > 0:
            files = files.where(F.col("size_bytes") <= max_file_size_mb * 1024 * 1024)
        if allowed_content_types:
            asked = {t.strip() for t in allowed_content_types}
            kinds = {*CONTENT_TYPES.values(), UNKNOWN_CONTENT_TYPE}
            allowed = sorted(k for k in kinds if k in asked or k.split(";")[0].strip() in asked)
            files = files.where(F.col("content_type").isin(allowed))
        return files

    if max_files_per_job <= 0:
        return load(with_content)
    chosen = load(False).orderBy("path").limit(max_files_per_job)
    if not with_content:
        return chosen
    # The sort carries no content; the last path chosen then bounds what is read.
    last = chosen.agg(F.max("path")).first()[0]
    return load(True).where(F.col("path") <= F.lit(last or ""))


def write_object_files(rows: DataFrame, root: str, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """Write each row as a file ``root/path``; ``path`` and ``size_bytes`` of what was written.

    Contents are text or bytes, null is empty. A row without a path, or one whose path leaves
    ``root``, is an error. Each file appears whole: it is written beside its place and moved there,
    so that a repeated task overwrites what it wrote. Of rows of one path the longest content stays,
    then the largest.
    """
    content = F.coalesce(F.col(content_col).cast("binary"), F.lit(b""))
    table = rows.select(F.col(path_col).alias("path"), content.alias("content"))
    keys = table.select("path", F.length("content").alias("n"), F.sha2("content", 256).alias("digest"))
    repeated = keys.groupBy("path").agg(F.count("*").alias("__n"), F.max(F.struct("n", "digest")).alias("__best"))
    repeated = repeated.where("__n > 1").drop("__n")
    mine = F.struct(F.length("content").alias("n"), F.sha2("content", 256).alias("digest"))
    table = table.join(repeated, "path", "left").where(F.col("__best").isNull() | (F.col("__best") == mine))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        store, inner, _ = open_store(root)
        for batch in batches:
            paths, sizes, made = batch.column(0).to_pylist(), [], set()
            for path, content in zip(paths, batch.column(1)):
                if not path or path.startswith("/") or ".." in path.split("/"):
                    raise ValueError(f"no path below the folder: {path!r}")
                target = f"{inner.rstrip('/')}/{path}"
                parent, _, name = target.rpartition("/")
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                aside = f"{inner.rstrip('/')}.part-{uuid.uuid4().hex}-{name}"
                with store.open_output_stream(aside) as out:
                    out.write(content.as_buffer())
                store.move(aside, target)
                sizes.append(len(content.as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(sizes, pa.int64())], ["path", "size_bytes"])

    return table.select("path", "content").mapInArrow(write, "path string, size_bytes bigint")
