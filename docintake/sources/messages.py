"""Intake messages from JSON text, in batches and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.functions.merging import normalise_origin
from docintake.schema import MESSAGE_JSON, ORIGIN

# more than a topic may have; offsets up to 2**43 still fit a number
MOST_PARTITIONS = 1 << 20
DECODE_ERROR = "Unable to decode message received"


def parse_messages(raw: DataFrame) -> DataFrame:
    """Decode (seq, value) to message columns and ``error``, NULL for a good message.

    A message without a source parses as JSON but is no message either.
    """
    parsed = raw.select(
        "seq",
        "value",
        F.from_json(
            "value",
            MESSAGE_JSON,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
        ).alias("m"),
    )
    m = F.col("m")
    origins = F.transform(F.coalesce(m["origins"], m["origin"]), normalise_origin)
    bad = m.isNull() | m["_corrupt"].isNotNull() | m["source"].isNull()
    return parsed.select(
        "seq",
        "value",
        m["source"].alias("source"),
        origins.cast(f"array<{ORIGIN}>").alias("origins"),
        m["tags"].alias("tags"),
        m["metadata"].alias("metadata"),
        m["derivative"].alias("derivative"),
        m["verify"].alias("verify"),
        F.when(bad, F.concat_ws(". ", F.lit(DECODE_ERROR), "value")).alias("error"),
    )


def decode_messages(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good messages, and undecodable ones with their text and an error."""
    parsed = parse_messages(raw)
    good = parsed.where("error IS NULL").drop("value", "error")
    bad = parsed.where("error IS NOT NULL").select(
        "seq", F.col("value"), F.lit("decode_error").alias("outcome"), "error"
    )
    return good, bad


def message_stream(
    spark: SparkSession,
    source: str,
    options: dict[str, str],
    path: str | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Stream of raw messages. Its partitions set the concurrency; options limit intake.

    ``source`` is a streaming source such as ``kafka``, ``text``, ``json`` or ``parquet``;
    it must give ``value`` and a growing ``seq`` (or Kafka's ``offset``).
    """
    reader = spark.readStream.format(source).options(**options)
    if schema:
        reader = reader.schema(schema)
    stream = reader.load(path) if path else reader.load()
    if "offset" in stream.columns and "seq" not in stream.columns:
        # offsets count per partition; together they number the messages of one topic
        if "," in options.get("subscribe", "") or "subscribePattern" in options:
            raise ValueError("offsets of several topics collide; take in one topic per stream")
        stream = stream.withColumn("seq", F.col("offset") * MOST_PARTITIONS + F.col("partition"))
    return stream.withColumn("value", F.col("value").cast("string"))
