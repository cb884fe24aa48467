"""Where a document goes and what has to be done to its files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docintake.config import DEFAULT, IntakeConfig
from docintake.functions.merging import consolidate_origins, first_remote_origin
from docintake.functions.paths import (
    in_zone,
    is_zero_length,
    local_target_path,
    local_to_remote_target_path,
    remote_target_path,
)
from docintake.session import cut
from docintake.operators.skew import HOT_ROWS, lookup
from docintake.schema import ORIGIN


def target_columns(cfg: IntakeConfig = DEFAULT) -> list[dict[str, Column]]:
    """Columns :func:`document_targets` adds, in the order they build on each other."""
    consolidated = consolidate_origins(
        F.col("doc_origin"), F.col("chain"), F.col("msg_origins")
    )
    downloaded = F.col("chain").isNotNull()
    chain = F.col("chain").cast(f"array<{ORIGIN}>")
    download_origins = chain
    if cfg.keep_prior_origins:
        uris = F.transform(chain, lambda o: o["uri"])
        prior = F.filter(
            F.col("consolidated"), lambda o: F.array_contains(uris, o["uri"])
        )
        download_origins = F.array_distinct(F.concat(chain, prior))

    first = F.col("first_remote")
    source = F.col("doc_source")
    target = (
        F.when(downloaded, remote_target_path(source, F.col("download_target"), cfg))
        .when(
            first.isNotNull(),
            local_to_remote_target_path(source, first["uri"], first["headers"], cfg),
        )
        .otherwise(local_target_path(source, cfg))
    )
    in_place = F.when(downloaded | first.isNotNull(), in_zone(source, cfg.remote)).otherwise(
        in_zone(source, cfg.local)
    )
    new_origin = F.when(downloaded, download_origins).otherwise(F.col("consolidated"))
    return [
        {"consolidated": consolidated},
        {"first_remote": first_remote_origin(F.col("consolidated"))},
        {"target_path": target, "in_place": in_place, "new_origin": new_origin},
    ]


def document_targets(found: DataFrame, cfg: IntakeConfig = DEFAULT) -> DataFrame:
    """Target path, whether the document is in its zone, and its new origins.

    ``found`` has doc_source, doc_origin, msg_origins, chain (NULL for a landing file)
    and download_target. A download takes over the resolved chain alone unless
    ``keep_prior_origins`` is set.
    """
    for columns in target_columns(cfg):
        found = found.withColumns(columns)
    return found.drop("consolidated", "first_remote")


def target_occupancy(
    targets: DataFrame,
    files: DataFrame,
    hot_rows: int | None = HOT_ROWS,
    vacant: str | None = None,
) -> DataFrame:
    """Add the hash now stored at the target path; a free place counts as the own hash.

    ``vacant`` names a column that says whether the place is free.
    """
    stored = files.select(F.col("path").alias("target_path"), F.col("md5").alias("stored_hash"))
    if hot_rows is not None:
        targets = cut(targets)  # looked at for hot paths first, so not to be made twice
    found = lookup(targets, stored, "target_path", hot_rows=hot_rows).withColumn(
        "occupant", F.coalesce("stored_hash", "doc_hash")
    )
    if vacant is not None:
        found = found.withColumn(vacant, F.col("stored_hash").isNull())
    return found.drop("stored_hash")


def file_action() -> Column:
    """Decision over length, target_path, doc_hash, occupant, in_place and temp paths."""
    return (
        F.when(is_zero_length(F.col("length")), F.lit("ZERO_LENGTH"))
        .when(F.col("target_path").isNull(), F.lit("MISSING_TARGET"))
        .when(F.col("doc_hash") != F.col("occupant"), F.lit("REPLACE"))
        .when(~F.col("in_place"), F.lit("MOVE"))
        .when(F.col("temp_path") == F.col("doc_source"), F.lit("NOOP"))
        .otherwise(F.lit("DISCARD"))
    )


def plan_file_actions(
    targets: DataFrame, files: DataFrame, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Add the occupant of the target and the action that follows from it."""
    return target_occupancy(targets, files, hot_rows).withColumn("action", file_action())


def path_actions(plan: DataFrame, cfg: IntakeConfig = DEFAULT) -> DataFrame:
    """File operations of a plan as rows (seq, op, from_path, to_path).

    A move onto itself is no operation. A stored copy that is left behind when its
    document moves to another zone is listed as ``orphan``.
    """
    moved = F.col("action").isin("MOVE", "REPLACE")
    temp, target, source = F.col("temp_path"), F.col("target_path"), F.col("doc_source")
    none = F.lit(None).cast("string")

    def operation(when, op, from_path, to_path):
        return F.when(
            when,
            F.struct(
                F.lit(op).alias("op"), from_path.alias("from_path"), to_path.alias("to_path")
            ),
        )

    left_behind = moved & in_zone(source, cfg.local) & (source != target) & (source != temp)
    operations = F.array(
        operation(moved & (temp != target), "move", temp, target),
        operation(F.col("action") == "DISCARD", "remove", temp, none),
        operation(left_behind, "orphan", source, none),
    )
    return plan.select(
        "seq", F.explode(F.filter(operations, lambda o: o.isNotNull())).alias("o")
    ).select("seq", "o.*")


def file_changes(actions: DataFrame, payloads: DataFrame) -> DataFrame:
    """Paths that operations touched, with ``content`` (a struct), or NULL where none is left.

    ``payloads`` gives (seq, md5, length, mtime, kind) of what was moved. The last operation
    on a path decides.
    """
    facts = [c for c in ("length", "md5", "mtime", "kind") if c in payloads.columns]
    moves = actions.where("op = 'move'").join(payloads, "seq")
    written = moves.select(
        F.col("to_path").alias("path"), "seq", F.struct(*facts).alias("content")
    )
    gone = actions.where("op IN ('move', 'remove')").select(
        F.col("from_path").alias("path"), "seq", F.lit(None).alias("content")
    )
    return (
        written.union(gone)
        .groupBy("path")
        .agg(F.max(F.struct("seq", "content"))["content"].alias("content"))
    )


def apply_actions(files: DataFrame, actions: DataFrame, payloads: DataFrame) -> DataFrame:
    """File table after the operations (see :func:`file_changes`)."""
    last = file_changes(actions, payloads)
    left = last.where("content IS NOT NULL").select("path", "content.*")
    kept = files.select(left.columns).join(last, "path", "left_anti")
    return kept.unionByName(left)
