"""Reading response headers, given as an array of (name, values)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the two ways a file name is read from a header.
DISPOSITION_PATTERN = r"""(filename|FILENAME)[^;=\n]*=((['"]).*?\3|[^;\n]*)"""


def headers_from_map(headers: Column) -> Column:
    """Comparable form of a header map: sorted (name, values) entries."""
    entries = F.transform(
        F.map_entries(headers),
        lambda e: F.struct(e["key"].alias("name"), e["value"].alias("values")),
    )
    return F.array_sort(entries)


def exact_header(headers: Column, name: str) -> Column:
    """Values of the header of exactly this name, NULL if absent."""
    found = F.filter(headers, lambda h: h["name"] == name)
    return F.try_element_at(found, F.lit(1))["values"]


def any_case_header(headers: Column, name: str) -> Column:
    """First value of the first header of this name in any case."""
    found = F.filter(headers, lambda h: F.lower(h["name"]) == name)
    return F.try_element_at(F.try_element_at(found, F.lit(1))["values"], F.lit(1))


def disposition_filename(headers: Column) -> Column:
    """File name in the disposition header, cleaned; NULL if there is none."""
    values = F.coalesce(
        exact_header(headers, "Content-Disposition"),
        exact_header(headers, "content-disposition"),
    )
    value = F.try_element_at(
        F.filter(values, lambda v: v.rlike(DISPOSITION_PATTERN)), F.lit(1)
    )
    name = F.regexp_extract(value, DISPOSITION_PATTERN, 2)
    name = F.regexp_replace(name, r"""^(?:UTF-8'')?(?:utf-8'')?"?|"$""", "")
    return F.replace(name, F.lit(" "), F.lit("-"))


def header_filename(headers: Column) -> Column:
    """File name by assignments of the disposition header, ``filename*`` first."""
    value = any_case_header(headers, "content-disposition")
    assignments = F.transform(
        F.filter(F.split(value, ";"), lambda a: F.contains(a, F.lit("="))),
        lambda a: F.struct(
            F.trim(F.substring_index(a, "=", 1)).alias("name"),
            F.trim(F.regexp_replace(a, r"^[^=]*=", "")).alias("value"),
        ),
    )

    def last(name: str) -> Column:
        return F.try_element_at(F.filter(assignments, lambda a: a["name"] == name), F.lit(-1))[
            "value"
        ]

    chosen = F.coalesce(last("filename*"), last("filename"))
    return F.regexp_replace(chosen, r'^"|"$', "")


def header_content_type(headers: Column) -> Column:
    return any_case_header(headers, "content-type")


def location_value(headers: Column) -> Column:
    """First ``Location`` value: NULL without the header, '' for an empty one."""
    values = exact_header(headers, "Location")
    return F.when(values.isNotNull(), F.coalesce(F.try_element_at(values, F.lit(1)), F.lit("")))
