"""Merging the list-valued fields of documents and choosing among origins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docintake.functions.headers import headers_from_map
from docintake.functions.uris import is_remote_scheme
from docintake.schema import META, ORIGIN


def _list(c: Column, element: str) -> Column:
    return F.coalesce(c, F.array().cast(f"array<{element}>"))


def merge_tags(message: Column, stored: Column) -> Column:
    return F.array_union(_list(message, "string"), _list(stored, "string"))


def merge_metadata(message: Column, stored: Column) -> Column:
    """One key with two values, or with two value types, keeps both entries."""
    return F.array_union(_list(message, META), _list(stored, META))


def consolidate_origins(stored: Column, found: Column, message: Column) -> Column:
    return F.array_distinct(
        F.concat(_list(stored, ORIGIN), _list(found, ORIGIN), _list(message, ORIGIN))
    )


def remote_origins(origins: Column) -> Column:
    return F.filter(origins, lambda o: is_remote_scheme(o["scheme"]))


def first_remote_origin(origins: Column) -> Column:
    return F.try_element_at(remote_origins(origins), F.lit(1))


def canonical_origin(chain: Column) -> Column:
    return F.try_element_at(chain, F.lit(1))


def normalise_origin(origin: Column) -> Column:
    """Origin with its header map replaced by comparable entries."""
    return F.struct(
        origin["scheme"].alias("scheme"),
        origin["hostname"].alias("hostname"),
        origin["uri"].alias("uri"),
        headers_from_map(origin["headers"]).alias("headers"),
        origin["metadata"].alias("metadata"),
    ).cast(ORIGIN)
