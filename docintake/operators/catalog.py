"""Changes to the catalog table, as new tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docintake.functions.identity import fill_uuid, new_doc_id, uuid_for
from docintake.functions.merging import merge_metadata, merge_tags
from docintake.schema import ATTRS, CATALOG, META, ORIGIN

COLUMNS = [
    "doc_id", "source", "hash", "mimetype", "created", "updated", "derivative",
    "derivatives", "attrs", "tags", "metadata", "origin", "uuid", "rogue_file",
]


def new_catalog_rows(unmatched: DataFrame, as_of: Column) -> DataFrame:
    """Default rows of unseen documents, from seq, match_source, hash and derivative."""
    time = as_of.cast("timestamp_ntz")
    doc_id = new_doc_id(as_of, F.col("seq"))
    return unmatched.select(
        doc_id.alias("doc_id"),
        F.col("match_source").alias("source"),
        "hash",
        F.lit("").alias("mimetype"),
        time.alias("created"),
        time.alias("updated"),
        F.coalesce("derivative", F.lit(False)).alias("derivative"),
        F.lit(None).cast("array<string>").alias("derivatives"),
        F.lit(None).cast(ATTRS).alias("attrs"),
        F.array().cast("array<string>").alias("tags"),
        F.lit(None).cast(f"array<{META}>").alias("metadata"),
        F.lit(None).cast(f"array<{ORIGIN}>").alias("origin"),
        uuid_for(doc_id).alias("uuid"),
        F.lit(None).cast("boolean").alias("rogue_file"),
    )


def append_new(catalog: DataFrame, new_rows: DataFrame) -> DataFrame:
    return catalog.unionByName(new_rows)


def upsert_catalog(catalog: DataFrame, changes: DataFrame, as_of: Column) -> DataFrame:
    """Set the changed fields on the rows with those ids, in one join by id.

    ``changes`` has one row per doc_id with source, origin, tags, metadata, derivative,
    and attrs and mimetype, which are NULL unless the file moved. Tags and metadata are
    put before the stored ones, the origin list replaces the stored one.
    """
    prefixed = changes.select(
        "doc_id",
        F.lit(True).alias("n_hit"),
        *[
            F.col(c).alias(f"n_{c}")
            for c in ("source", "origin", "tags", "metadata", "derivative", "attrs", "mimetype")
        ],
    )
    joined = catalog.join(prefixed, "doc_id", "left")
    hit = F.coalesce(F.col("n_hit"), F.lit(False))

    def changed(new: Column, old: str) -> Column:
        return F.when(hit, new).otherwise(F.col(old)).alias(old)

    return joined.select(
        "doc_id",
        changed(F.col("n_source"), "source"),
        "hash",
        changed(F.coalesce("n_mimetype", "mimetype"), "mimetype"),
        "created",
        changed(as_of.cast("timestamp_ntz"), "updated"),
        changed(F.coalesce("n_derivative", F.lit(False)), "derivative"),
        changed(F.coalesce("derivatives", F.array().cast("array<string>")), "derivatives"),
        changed(F.coalesce("n_attrs", "attrs"), "attrs"),
        changed(merge_tags(F.col("n_tags"), F.col("tags")), "tags"),
        changed(merge_metadata(F.col("n_metadata"), F.col("metadata")), "metadata"),
        changed(F.col("n_origin"), "origin"),
        changed(fill_uuid(F.col("uuid"), F.col("doc_id")), "uuid"),
        "rogue_file",
    )


def delete_rows(catalog: DataFrame, deleted: DataFrame) -> DataFrame:
    """Drop the rows of superseded or zero-length documents (doc_id)."""
    return catalog.join(deleted.select("doc_id"), "doc_id", "left_anti").select(catalog.columns)


def confirm_updates(processed: DataFrame, catalog: DataFrame) -> DataFrame:
    """Flag processed documents that are not in the catalog after the update."""
    present = catalog.select("doc_id", F.lit(True).alias("_present"))
    return (
        processed.join(present, "doc_id", "left")
        .withColumn("confirmed", F.coalesce("_present", F.lit(False)))
        .drop("_present")
    )


def empty_catalog(spark) -> DataFrame:
    return spark.createDataFrame([], CATALOG)
