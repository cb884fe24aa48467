"""Checks that decide whether a message may touch a document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docintake.functions.uris import is_remote_scheme, scheme_of


def seconds_apart(created: Column, as_of: Column) -> Column:
    """Whole seconds between two times, floored before the sign is dropped."""
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(created.cast("timestamp"))
    return F.abs(F.floor(micros / F.lit(1_000_000)))


def origin_error(origins: Column) -> Column:
    """What is wrong with the first bad origin, NULL if all are good."""

    def error(o: Column) -> Column:
        return F.when(
            is_remote_scheme(o["scheme"]),
            F.when(o["uri"].isNull(), F.lit("missing_origin_uri")).when(
                scheme_of(o["uri"]).isNull(), F.lit("invalid_origin_scheme")
            ),
        )

    errors = F.filter(F.transform(origins, error), lambda e: e.isNotNull())
    return F.try_element_at(errors, F.lit(1))


def validation_error(
    verify: Column,
    created: Column,
    rogue: Column,
    origins_error: Column,
    as_of: Column,
    timeout: int = 10,
) -> Column:
    """First failing check, in order: age of a verified document, rogue file, origins."""
    too_old = F.coalesce(verify, F.lit(False)) & (seconds_apart(created, as_of) > timeout)
    return (
        F.when(too_old, F.lit("silent_validation"))
        .when(F.coalesce(rogue, F.lit(False)), F.lit("rogue_file"))
        .otherwise(origins_error)
    )
