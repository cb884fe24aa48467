"""Content types from the contents of a file and its name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docintake.functions.binding import bind

# Leading bytes (hex) and the type they stand for.
MAGIC = (
    ("25504446", "application/pdf"),
    ("D0CF11E0A1B11AE1", "application/x-tika-msoffice"),
    ("1F8B", "application/gzip"),
    ("425A68", "application/x-bzip2"),
    ("377ABCAF271C", "application/x-7z-compressed"),
    ("89504E470D0A1A0A", "image/png"),
    ("FFD8FF", "image/jpeg"),
    ("47494638", "image/gif"),
    ("49492A00", "image/tiff"),
    ("4D4D002A", "image/tiff"),
    ("7B5C727466", "application/rtf"),
    ("25215053", "application/postscript"),
    ("3C3F786D6C", "application/xml"),
)
ZIP_MAGIC = "504B0304"

# Content types by file extension.
BY_EXTENSION = {
    "css": "text/css",
    "csv": "text/csv",
    "gif": "image/gif",
    "gz": "application/gzip",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "pdf": "application/pdf",
    "png": "image/png",
    "rtf": "application/rtf",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "htm": "text/html",
    "html": "text/html",
    "js": "application/javascript",
    "json": "application/json",
    "md": "text/x-web-markdown",
    "ppt": "application/vnd.ms-powerpoint",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "svg": "image/svg+xml",
    "tsv": "text/tab-separated-values",
    "txt": "text/plain",
    "xhtml": "application/xhtml+xml",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xml": "application/xml",
    "zip": "application/zip",
}
# Types that are refined by the extension, as they are containers.
ZIP_KINDS = ("docx", "pptx", "xlsx")
OLE_KINDS = ("doc", "ppt", "xls")


# Beginning of an HTML document, after white space and comments.
HTML_BEGIN = r"(?is)^\s*+(?:<!--.*?-->\s*+)*+<(?:!doctype\s+html|html)\b"
CONTROL = r"[\x00-\x08\x0E-\x1A\x1C-\x1F]"


def _begins(content: Column, digits: str) -> Column:
    return F.startswith(content, F.unhex(F.lit(digits)))


def sniff(content: Column) -> Column:
    """What the whole content shows by itself: a type, or zip, ole, html, xml, empty, binary, text."""
    result = F.when(F.length(content) == 0, F.lit("empty")).when(
        _begins(content, ZIP_MAGIC), F.lit("zip")
    )
    for digits, kind in MAGIC[:-1]:
        kind = "ole" if digits == "D0CF11E0A1B11AE1" else kind
        result = result.when(_begins(content, digits), F.lit(kind))

    def by_text(v: Column) -> Column:
        return (
            F.when(v["text"].rlike(HTML_BEGIN), F.lit("html"))
            .when(v["text"].startswith("<?xml"), F.lit("xml"))
            .when(v["text"].rlike(CONTROL), F.lit("binary"))
            .otherwise(F.lit("text"))
        )

    by_content = result.otherwise(bind(by_text, text=F.decode(content, "ISO-8859-1")))
    return F.when(content.isNotNull(), by_content)


def _decide(kind: Column, extension: Column, named: Column) -> Column:
    ole = dict(MAGIC)["D0CF11E0A1B11AE1"]
    return (
        F.when(
            kind == "zip",
            F.when(extension.isin(*ZIP_KINDS), named).otherwise(F.lit("application/zip")),
        )
        .when(kind == "ole", F.when(extension.isin(*OLE_KINDS), named).otherwise(F.lit(ole)))
        .when(F.contains(kind, F.lit("/")), kind)
        .when(kind == "html", F.lit("text/html"))
        .when(
            kind == "xml",
            F.when(extension.isin("svg", "xhtml"), named).otherwise(F.lit("application/xml")),
        )
        .when(named.isNotNull() & ~extension.isin("zip", *ZIP_KINDS, *OLE_KINDS), named)
        .when(kind == "text", F.lit("text/plain"))
        .otherwise(F.lit("application/octet-stream"))
    )


def detect_mimetype(kind: Column, name: Column) -> Column:
    """Type by what :func:`sniff` found, made finer by the extension of the name."""
    table = F.create_map(*[F.lit(x) for pair in BY_EXTENSION.items() for x in pair])

    def by_extension(v: Column) -> Column:
        extension = F.when(
            F.contains(v["last"], F.lit(".")), F.lower(F.substring_index(v["last"], ".", -1))
        )
        return bind(
            lambda x: _decide(x["kind"], x["extension"], x["named"]),
            kind=v["kind"],
            extension=extension,
            named=F.try_element_at(table, extension),
        )

    return bind(by_extension, kind=kind, last=F.substring_index(name, "/", -1))
