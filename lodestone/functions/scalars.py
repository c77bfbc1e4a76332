"""Names, ids and content types of sources and files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content type by file extension.
CONTENT_TYPES = {
    "avif": "image/avif",
    "bmp": "image/bmp",
    "css": "text/css; charset=utf-8",
    "csv": "text/csv; charset=utf-8",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "gif": "image/gif",
    "gz": "application/gzip",
    "htm": "text/html; charset=utf-8",
    "html": "text/html; charset=utf-8",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "js": "text/javascript; charset=utf-8",
    "json": "application/json",
    "md": "text/markdown; charset=utf-8",
    "mp3": "audio/mpeg",
    "mp4": "video/mp4",
    "parquet": "application/vnd.apache.parquet",
    "pdf": "application/pdf",
    "png": "image/png",
    "ppt": "application/vnd.ms-powerpoint",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "svg": "image/svg+xml",
    "tsv": "text/tab-separated-values; charset=utf-8",
    "txt": "text/plain; charset=utf-8",
    "wasm": "application/wasm",
    "webp": "image/webp",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xml": "text/xml; charset=utf-8",
    "yaml": "application/yaml",
    "zip": "application/zip",
}
UNKNOWN_CONTENT_TYPE = "application/octet-stream"


def filled(col: Column) -> Column:
    """Null where the string is empty."""
    return F.nullif(col, F.lit(""))


def slug(text: Column) -> Column:
    """Lower case, runs outside a-z and 0-9 as one dash, no outer dashes, ``source`` if empty."""
    dashed = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-")
    return F.coalesce(filled(F.btrim(dashed, F.lit("-"))), F.lit("source"))


def host_of(url: Column) -> Column:
    """Host of a url without its port; null where there is none."""
    return F.try_parse_url(url, F.lit("HOST"))


def default_source_name(
    source_type: Column,
    name: Column,
    *,
    url: Column | None = None,
    bucket: Column | None = None,
    project: Column | None = None,
    cloud: Column | None = None,
    space: Column | None = None,
    drive: Column | None = None,
    folder: Column | None = None,
) -> Column:
    """Name of a source: the explicit one, else its type and a slug of what it reads.

    With nothing to read from, trackers are named by their type alone and the others
    ``<type>-source``.
    """
    none = F.lit(None).cast("string")
    url, bucket, project, cloud, space, drive, folder = (
        none if c is None else filled(c) for c in (url, bucket, project, cloud, space, drive, folder)
    )
    hint = (
        F.when(source_type == "web", F.coalesce(filled(host_of(url)), url))
        .when(source_type.isin("s3", "gcs"), bucket)
        .when(source_type == "gdrive", F.coalesce(drive, folder))
        .when(source_type == "jira", F.coalesce(project, cloud))
        .when(source_type == "confluence", F.coalesce(cloud, space, url))
    )
    fallback = F.when(source_type.isin("jira", "confluence"), source_type).otherwise(
        F.concat(F.regexp_replace(source_type, "_", "-"), F.lit("-source"))
    )
    derived = F.when(hint.isNotNull(), F.concat(source_type, F.lit("-"), slug(hint)))
    return F.coalesce(filled(name), derived, fallback)


def first_nonempty_id(*ids: Column) -> Column:
    """First id that is neither null nor empty; null marks an error row."""
    return F.coalesce(*[filled(c) for c in ids])


def extension_of(file_name: Column) -> Column:
    """Lower-case extension after the last dot of the base name, or empty."""
    return F.lower(F.regexp_extract(file_name, r"\.([^./\\]*)$", 1))


def mime_from_extension(file_name: Column) -> Column:
    """Content type of a file name by its extension."""
    table = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, extension_of(file_name)), F.lit(UNKNOWN_CONTENT_TYPE))
