"""Edges from parents to derived documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.config import DEFAULT, IntakeConfig
from docintake.functions.paths import zone_target_path


def update_lineage(
    mappings: DataFrame, processed: DataFrame, cfg: IntakeConfig = DEFAULT
) -> DataFrame:
    """Point edges at the stored child; ``processed`` has seq, source and doc_id.

    An edge whose child path is the source of a derivative gets its place in the local
    zone and its id. The first message of a source moves the edge away from it; a later
    message that names the stored place itself can only change the id. No edge is made.
    """
    sources = processed.groupBy("source").agg(
        F.min(F.struct("seq", "doc_id")).alias("first"),
        F.max(F.struct("seq", "doc_id")).alias("last"),
    )
    landing = sources.select(
        F.col("source").alias("child_path"),
        zone_target_path(F.col("source"), cfg.local, cfg).alias("placed"),
        F.col("first").alias("moved_by"),
    ).where(F.col("child_path") != F.col("placed"))
    stored = sources.select(F.col("source").alias("placed"), F.col("last").alias("named_by")).where(
        F.col("placed") == zone_target_path(F.col("placed"), cfg.local, cfg)
    )
    moved = mappings.join(landing, "child_path", "left").withColumn(
        "placed", F.coalesce("placed", "child_path")
    )
    named = moved.join(stored, "placed", "left")
    later = F.col("named_by.seq") > F.coalesce(F.col("moved_by.seq"), F.lit(-1))
    return named.select(
        "mapping_id",
        "parent",
        F.coalesce(
            F.when(later, F.col("named_by.doc_id")), F.col("moved_by.doc_id"), F.col("child")
        ).alias("child"),
        F.col("placed").alias("child_path"),
        "metadata",
        "consumer",
    )


def delete_lineage(mappings: DataFrame, deleted: DataFrame) -> DataFrame:
    """Drop edges whose parent is among the deleted documents (doc_id)."""
    return mappings.join(
        deleted.select(F.col("doc_id").alias("parent")), "parent", "left_anti"
    ).select(mappings.columns)
