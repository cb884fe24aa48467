"""Zones of the store and the paths documents get in them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from docintake.config import DEFAULT, IntakeConfig
from docintake.functions.binding import bind
from docintake.functions.naming import remote_file_path, tidy_path


def strip_root(src: Column, root: str) -> Column:
    """Drop the leading root, taken literally, with exactly one slash."""
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(src, F.lit(prefix)), F.substring(src, len(prefix) + 1, 2**31 - 1)
                  ).otherwise(src)


def in_zone(src: Column, zone: str) -> Column:
    return F.startswith(src, F.lit(f"{zone}/"))


def lookup_target(raw: Column, cfg: IntakeConfig = DEFAULT) -> Column:
    """Path a landing file may already be stored under. Prefixes need no slash."""
    to_remote = f"{cfg.ingress}/{cfg.remote}"
    return (
        F.when(F.startswith(raw, F.lit(to_remote)),
               F.regexp_replace(raw, "^" + re.escape(to_remote), cfg.remote))
        .otherwise(F.regexp_replace(raw, "^" + re.escape(cfg.ingress), cfg.local))
    )


def _derivatives_once(path: Column, folder: str) -> Column:
    """Runs of the folder as one, by parts: a pattern with a repeated group recurses in Java."""

    def once(v: Column) -> Column:
        parts = v["parts"]

        def stays(part: Column, i: Column) -> Column:
            again = (part == folder) & (F.get(parts, i - 1) == folder)
            return (i == 0) | (i == F.size(parts) - 1) | ~F.coalesce(again, F.lit(False))

        return F.array_join(F.filter(parts, stays), "/")

    tidy = F.regexp_replace(path, "/+", "/")
    split = bind(once, parts=F.split(tidy, "/"))
    return F.when(F.contains(tidy, F.lit(f"{folder}/{folder}/")), split).otherwise(path)


def zone_target_path(src: Column, base: str, cfg: IntakeConfig = DEFAULT) -> Column:
    """Path of a source below a zone: landing prefix off, repeats of derivatives off."""
    bare = _derivatives_once(
        F.regexp_replace(src, f"^{re.escape(cfg.ingress)}/+", ""), cfg.derivatives
    )
    placed = bind(
        lambda v: F.when(in_zone(v["bare"], base), v["bare"]).otherwise(
            F.concat(F.lit(f"{base}/"), v["bare"])
        ),
        bare=bare,
    )
    return tidy_path(placed)


def local_target_path(doc_source: Column, cfg: IntakeConfig = DEFAULT) -> Column:
    bare = F.regexp_replace(strip_root(doc_source, cfg.root), "^/+", "")
    return F.when(in_zone(doc_source, cfg.local), tidy_path(doc_source)).otherwise(
        zone_target_path(bare, cfg.local, cfg)
    )


def remote_target_path(
    doc_source: Column, download_target: Column, cfg: IntakeConfig = DEFAULT
) -> Column:
    stripped = F.regexp_replace(strip_root(tidy_path(download_target), cfg.root), "^/+", "")
    return F.when(in_zone(doc_source, cfg.remote), tidy_path(doc_source)).otherwise(stripped)


def local_to_remote_target_path(
    doc_source: Column, origin_uri: Column, origin_headers: Column, cfg: IntakeConfig = DEFAULT
) -> Column:
    """A landing file that was fetched elsewhere goes where its origin says."""
    return F.when(in_zone(doc_source, cfg.remote), tidy_path(doc_source)).otherwise(
        tidy_path(remote_file_path(origin_uri, origin_headers, cfg.remote))
    )


def archive_path(target: Column, hash_: Column, cfg: IntakeConfig = DEFAULT) -> Column:
    """Archive place of one version of a target; NULL if no file name can be found."""
    plain = r"^(.+)/([^/.]+)$"
    dotted = r"^(.+)/([^/]+)\.(.+)$"

    def archived(pattern: str) -> Column:
        return zone_target_path(F.regexp_extract(target, pattern, 1), cfg.archive, cfg)

    extension = F.regexp_extract(target, dotted, 3)
    named = F.concat(F.regexp_extract(target, dotted, 2), F.lit("."), extension)
    return F.when(
        target.rlike(plain),
        F.concat_ws("/", archived(plain), F.regexp_extract(target, plain, 2), hash_),
    ).when(
        target.rlike(dotted),
        F.concat_ws("/", archived(dotted), named, F.concat(hash_, F.lit("."), extension)),
    )


def catalog_source(new: Column, old: Column, root: str) -> Column:
    return F.coalesce(strip_root(new, root), old)


def is_zero_length(length: Column) -> Column:
    return length == 0


def file_attrs(path: Column, length: Column, mtime: Column, root: str) -> Column:
    """Attributes of a stored file; Spark does not show creation and access times."""
    absolute = F.concat(F.lit(root.rstrip("/") + "/"), path)
    none = F.lit(None).cast("timestamp_ntz")
    return F.struct(
        F.regexp_replace(absolute, "/[^/]*$", "").alias("path"),
        F.substring_index(path, "/", -1).alias("name"),
        mtime.cast("timestamp_ntz").alias("mtime"),
        none.alias("ctime"),
        none.alias("atime"),
        length.cast("bigint").alias("size"),
    )
