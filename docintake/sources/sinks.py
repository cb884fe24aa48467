"""What a batch sends on: notifications, dead letters and file contents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.operators.skew import broadcast_if_small

# Texts of failed outcomes.
ERROR_TEXT = {
    "decode_error": "Unable to decode message received",
    "file_not_found": "file not found",
    "no_document": "no document found for URI",
    "run_too_recently": "run too recently",
    "silent_validation": "Suppressed exception for Validation",
    "rogue_file": "cannot process rogue file",
    "missing_origin_uri": "origin has no uri",
    "invalid_origin_scheme": "contains invalid origin scheme",
    "missing_target": "This file really should exist",
    "update_failed": "Failed to find document after update",
}


def emit_notifications(outcomes: DataFrame) -> DataFrame:
    """One JSON message per processed document, in the column ``value``."""
    return outcomes.where("outcome = 'ok'").select(
        F.to_json(
            F.struct("seq", "doc_id", F.col("new_source").alias("source"), "hash", "consumer")
        ).alias("value")
    )


def emit_errors(outcomes: DataFrame) -> DataFrame:
    """Failed messages with class and text; an empty file counts as dealt with.

    ``cause``, where there is such a column, says why a document could not be fetched.
    """
    texts = F.create_map(*[F.lit(x) for pair in ERROR_TEXT.items() for x in pair])
    failed = outcomes.where("outcome NOT IN ('ok', 'zero_length')")
    text = F.concat_ws(": ", texts[F.col("outcome")], F.col("raw"))
    if "cause" in outcomes.columns:
        because = F.when(F.col("outcome") == "no_document", F.col("cause"))
        text = F.concat_ws(". ", text, because)
    return failed.select(
        "seq",
        F.col("raw").alias("source"),
        "outcome",
        text.alias("error_text"),
    )


def write_content(placed: DataFrame, store: str, batch: int) -> None:
    """Land payloads (path, seq, md5, length, content) of a batch in their zones.

    Contents are written where they are read, without a shuffle, into a folder of the
    batch; a batch that is repeated replaces what it wrote before.
    """
    zoned = placed.withColumn("zone", F.substring_index("path", "/", 1))
    zoned.write.partitionBy("zone").mode("overwrite").parquet(f"{store}/batch={batch}")


def read_content(stored: DataFrame) -> DataFrame:
    """Latest write of each path. The writes are compared by number alone; their join
    moves contents only if the list of paths is too long to be broadcast."""
    latest = stored.groupBy("path").agg(F.max("seq").alias("seq"))
    return stored.join(broadcast_if_small(latest), ["path", "seq"], "left_semi")
