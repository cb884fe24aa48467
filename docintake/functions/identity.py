"""Identifiers that come out the same on every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def new_doc_id(as_of: Column, seq: Column) -> Column:
    """24 hex digits, seconds then arrival order, so ids sort by creation."""
    seconds = F.lower(F.hex(F.floor(F.unix_micros(as_of.cast("timestamp")) / 1_000_000)))
    return F.concat(
        F.lpad(seconds, 8, "0"), F.lpad(F.lower(F.hex(seq.cast("bigint"))), 16, "0")
    )


def uuid_for(doc_id: Column) -> Column:
    digest = F.md5(F.concat(F.lit("uuid:"), doc_id))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )


def fill_uuid(uuid: Column, doc_id: Column) -> Column:
    return F.coalesce(uuid, uuid_for(doc_id))
