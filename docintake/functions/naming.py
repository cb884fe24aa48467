"""File names and remote paths derived from a URI and its response headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docintake.functions.binding import bind
from docintake.functions.headers import disposition_filename, location_value
from docintake.functions.uris import decode_part, host_of, path_of, query_of, scheme_of

# File extension by content type.
CONTENT_TYPE_EXTENSIONS = {
    "application/gzip": ".gz",
    "application/json": ".json",
    "application/msword": ".doc",
    "application/pdf": ".pdf",
    "application/rtf": ".rtf",
    "application/vnd.ms-excel": ".xls",
    "application/vnd.ms-powerpoint": ".ppt",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": ".pptx",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/xhtml+xml": ".xhtml",
    "application/xml": ".xml",
    "application/zip": ".zip",
    "image/gif": ".gif",
    "image/jpeg": ".jpg",
    "image/png": ".png",
    "image/svg+xml": ".svg",
    "image/tiff": ".tiff",
    "image/webp": ".webp",
    "text/css": ".css",
    "text/csv": ".csv",
    "text/html": ".html",
    "text/plain": ".txt",
    "text/tab-separated-values": ".tsv",
    "application/epub+zip": ".epub",
    "application/javascript": ".js",
    "application/postscript": ".ps",
    "application/vnd.oasis.opendocument.text": ".odt",
    "application/x-bzip2": ".bz2",
    "application/x-7z-compressed": ".7z",
    "audio/mpeg": ".mp3",
    "text/markdown": ".md",
    "video/mp4": ".mp4",
}

DEFAULT_EXTENSION = ".html"
LONGEST_NAME = 255


def _or(c: Column, default: str) -> Column:
    return F.coalesce(c, F.lit(default))


def content_type_extension(
    content_type: Column, extensions: dict[str, str] | None = None
) -> Column:
    """Extension of a content type without its parameters.

    No type at all means HTML; a type that is not known has no extension. ``extensions``
    adds types to the known ones.
    """
    bare = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    known = {**CONTENT_TYPE_EXTENSIONS, **(extensions or {})}
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.when(F.coalesce(bare, F.lit("")) == "", F.lit(DEFAULT_EXTENSION)).otherwise(
        _or(F.try_element_at(table, bare), "")
    )


def tidy_path(path: Column) -> Column:
    """Collapse repeated slashes and drop a trailing one."""
    return F.regexp_replace(F.regexp_replace(path, "/+", "/"), "(?<=.)/$", "")


def insert_query_hash(name: Column, query: Column, content_type: Column) -> Column:
    """Put the MD5 of the query before the extension, which is added if missing."""
    mark = F.when(
        query.isNotNull(), F.concat(F.lit("."), F.md5(F.concat(F.lit("?"), query)))
    ).otherwise(F.lit(""))

    def marked(v: Column) -> Column:
        extension = content_type_extension(content_type)
        stem = F.regexp_extract(v["name"], r"^(.*)\.(.*)$", 1)
        own = F.substring_index(v["name"], ".", -1)
        return (
            F.when(v["name"] == "", F.concat(F.lit("index"), v["mark"], extension))
            .when(
                F.contains(v["name"], F.lit(".")),
                F.concat(stem, v["mark"], F.lit("."), own),
            )
            .otherwise(F.concat(v["name"], v["mark"], extension))
        )

    return bind(marked, name=name, mark=mark)


def _path_parts(uri: Column, file_name: Column) -> Column:
    """Decoded parts of the path, an empty path as ``/index.html``, then the given name."""

    def parts(v: Column) -> Column:
        split = F.transform(F.split(F.regexp_replace(v["path"], "^/", ""), "/"), decode_part)
        return F.concat(
            F.when(v["path"] == "", F.array(F.lit("index.html"))).otherwise(split),
            F.when(file_name.isNotNull(), F.array(file_name)).otherwise(
                F.array().cast("array<string>")
            ),
        )

    return bind(parts, path=path_of(uri))


def _basename(
    parts: Column, disposition: Column, query: Column, file_name: Column, content_type: Column
) -> Column:
    def joined(v: Column) -> Column:
        last = v["last"]
        final = (
            F.when(disposition.isNotNull() & last.isin("", "index.html"), disposition)
            .when(
                disposition.isNotNull() & file_name.isNull(),
                F.concat_ws("/", F.regexp_replace(last, "/$", ""), disposition),
            )
            .otherwise(insert_query_hash(last, query, content_type))
        )
        folders = F.filter(v["folders"], lambda p: p != "")
        return tidy_path(
            F.concat(F.lit("/"), F.concat_ws("/", F.concat(folders, F.array(final))))
        )

    return bind(
        joined,
        last=F.try_element_at(parts, F.lit(-1)),
        folders=F.slice(parts, F.lit(1), F.size(parts) - 1),
    )


def basename(
    uri: Column, headers: Column, file_name: Column, content_type: Column
) -> Column:
    """Path below the host: directories of the URI and the final file name."""
    return bind(
        lambda v: _basename(v["parts"], v["disposition"], v["query"], file_name, content_type),
        parts=_path_parts(uri, file_name),
        disposition=disposition_filename(headers),
        query=query_of(uri),
    )


def _location_part(host: Column, disposition: Column, location: Column) -> Column:
    own = F.concat(F.lit("/"), _or(host, ""))
    return (
        F.when(disposition.isNotNull() | location.isNull() | location.isin("", "/"), own)
        .when(
            location.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"),
            F.concat(F.lit("/"), _or(host_of(location), "")),
        )
        .when(location.rlike(r"^//|^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(""))
        .otherwise(F.concat(own, F.lit("/"), F.regexp_replace(location, "^/", "")))
    )


def location_part(uri: Column, headers: Column) -> Column:
    """Host section of the path: own host, or what the Location header makes of it."""
    return bind(
        lambda v: _location_part(v["host"], v["disposition"], v["location"]),
        host=host_of(uri),
        disposition=disposition_filename(headers),
        location=location_value(headers),
    )


def remote_file_path(
    uri: Column,
    headers: Column,
    root: str,
    file_name: Column | None = None,
    content_type: Column | None = None,
) -> Column:
    """Where a document fetched from ``uri`` lives below ``root``."""
    none = F.lit(None).cast("string")
    file_name = none if file_name is None else file_name
    content_type = none if content_type is None else content_type
    prefix = root.rstrip("/") + "/"

    def path(v: Column) -> Column:
        return F.concat(
            F.lit(prefix),
            v["scheme"],
            _location_part(v["host"], v["disposition"], v["location"]),
            _basename(v["parts"], v["disposition"], v["query"], file_name, content_type),
        )

    bound = bind(
        path,
        scheme=_or(scheme_of(uri), ""),
        host=host_of(uri),
        disposition=disposition_filename(headers),
        location=location_value(headers),
        parts=_path_parts(uri, file_name),
        query=query_of(uri),
    )
    return F.when(uri.isNotNull(), bound)


def shorten_name(uri_path: Column, name: Column) -> Column:
    """Replace names of 256 and more characters by hash, query hash and extension."""

    def short(v: Column) -> Column:
        rest = v["name"]
        for piece in (v["stem"], v["extension"], F.lit(".")):
            rest = F.replace(rest, piece, F.lit(""))
        return F.concat_ws(
            ".",
            F.md5(v["stem"]),
            F.nullif(rest, F.lit("")),
            F.nullif(v["extension"], F.lit("")),
        )

    def parted(v: Column) -> Column:
        has_dot = F.contains(v["original"], F.lit("."))
        stem = F.when(has_dot, F.substring_index(v["original"], ".", 1)).otherwise(v["original"])
        extension = F.when(
            has_dot, F.lower(F.substring_index(v["original"], ".", -1))
        ).otherwise("")
        return F.when(
            F.length(v["name"]) > LONGEST_NAME,
            bind(short, stem=stem, extension=extension, name=v["name"]),
        ).otherwise(v["name"])

    original = F.regexp_extract(F.regexp_replace(uri_path, "/+$", ""), r"([^/]*)$", 1)
    return bind(parted, original=original, name=name)


def shorten_path(uri: Column, path: Column) -> Column:
    """Apply :func:`shorten_name` to the last part of a path."""

    def shortened(v: Column) -> Column:
        return F.when(
            F.length(v["name"]) > LONGEST_NAME,
            F.replace(v["path"], v["name"], shorten_name(v["uri_path"], v["name"])),
        ).otherwise(v["path"])

    def named(v: Column) -> Column:
        return bind(
            shortened,
            path=v["path"],
            uri_path=v["uri_path"],
            name=F.substring_index(v["path"], "/", -1),
        )

    return bind(named, path=path, uri_path=F.regexp_replace(path_of(uri), "%20", " "))
