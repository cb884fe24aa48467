"""Splitting and classifying sources.

A source is split with the generic-syntax pattern of RFC 3986 (appendix B), which
accepts what a lenient URI reader accepts (spaces, underscores in hosts). A broken
percent escape makes it no URI at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docintake.config import FTP_SCHEMES, HTTP_SCHEMES, REMOTE_SCHEMES

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_NO_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"
_AUTHORITY = _NO_SCHEME + r"//([^/?#]*)"
_PATH = _NO_SCHEME + r"(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def _or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_parseable(src: Column) -> Column:
    return ~src.rlike(r"%(?![0-9A-Fa-f]{2})")


def scheme_of(uri: Column) -> Column:
    return _or_null(F.regexp_extract(uri, _SCHEME, 1))


def authority_of(uri: Column) -> Column:
    return _or_null(F.regexp_extract(uri, _AUTHORITY, 1))


def userinfo_of(uri: Column) -> Column:
    return _or_null(F.regexp_extract(authority_of(uri), r"^(.*)@", 1))


def host_of(uri: Column) -> Column:
    bare = F.regexp_replace(authority_of(uri), r"^.*@", "")
    return _or_null(F.regexp_extract(bare, r"^(\[[^\]]*\]|[^:]*)", 1))


def port_of(uri: Column) -> Column:
    bare = F.regexp_replace(authority_of(uri), r"^.*@", "")
    return _or_null(F.regexp_extract(bare, r":([0-9]+)$", 1)).cast("int")


def path_of(uri: Column) -> Column:
    return F.regexp_extract(uri, _PATH, 1)


def query_of(uri: Column) -> Column:
    return _or_null(F.regexp_extract(uri, _QUERY, 1))


def classify_source(src: Column) -> Column:
    """Struct of the parsed source; a parseable source without scheme is a file."""
    ok = is_parseable(src)

    def part(c: Column) -> Column:
        return F.when(ok, c)

    return F.struct(
        src.alias("raw"),
        ok.alias("is_uri"),
        part(F.coalesce(scheme_of(src), F.lit("file"))).alias("scheme"),
        part(host_of(src)).alias("host"),
        part(path_of(src)).alias("path"),
        part(query_of(src)).alias("query"),
        part(userinfo_of(src)).alias("userinfo"),
    )


def route(parsed: Column) -> Column:
    """``local``, ``remote`` or ``undefined_scheme`` for a classified source."""
    return (
        F.when(~parsed["is_uri"], F.lit("local"))
        .when(parsed["scheme"].isNull(), F.lit("undefined_scheme"))
        .when(parsed["scheme"] == "file", F.lit("local"))
        .otherwise(F.lit("remote"))
    )


def is_remote_scheme(scheme: Column) -> Column:
    return F.coalesce(scheme.isin(*REMOTE_SCHEMES), F.lit(False))


def scheme_status(uri: Column) -> Column:
    scheme = scheme_of(uri)
    return (
        F.when(scheme.isNull(), F.lit("undefined_scheme"))
        .when(scheme.isin(*REMOTE_SCHEMES), F.lit("supported"))
        .otherwise(F.lit("unsupported_scheme"))
    )


def scheme_label(scheme: Column) -> Column:
    """Metric label: all http kinds count as ``http``, all ftp kinds as ``ftp``."""
    return (
        F.when(scheme.isin(*HTTP_SCHEMES), F.lit("http"))
        .when(scheme.isin(*FTP_SCHEMES), F.lit("ftp"))
        .otherwise(scheme)
    )


def default_port(scheme: Column) -> Column:
    return F.when(scheme.isin("ftp", "ftps"), F.lit(21)).when(scheme == "sftp", F.lit(22))


def decode_part(part: Column) -> Column:
    """Undo percent escapes in one path part; a plus sign stays a plus sign."""
    return F.coalesce(F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))), part)
