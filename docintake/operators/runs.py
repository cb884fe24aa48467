"""Run flags, retries and arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docintake.config import DEFAULT, IntakeConfig
from docintake.operators.skew import numbered


def run_recently(started: Column, as_of: Column, tolerance: int | None) -> Column:
    """Was the document started by this consumer less than ``tolerance`` seconds ago?"""
    if tolerance is None:
        return F.lit(False)
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(started.cast("timestamp"))
    return F.coalesce(F.abs(micros) < F.lit(tolerance * 1_000_000), F.lit(False))


def _own_flags(flags: DataFrame, cfg: IntakeConfig) -> DataFrame:
    own = flags.where((F.col("consumer") == cfg.consumer))
    return own.groupBy("doc_id").agg(F.max("started").alias("started"))


def suppress_recent(
    matched: DataFrame, flags: DataFrame, as_of: Column, cfg: IntakeConfig = DEFAULT
) -> DataFrame:
    """Add too_recent to matched documents (doc_id)."""
    joined = matched.join(_own_flags(flags, cfg), "doc_id", "left")
    return joined.withColumn(
        "too_recent", run_recently(F.col("started"), as_of, cfg.recent_tolerance)
    )


def mark_run_state(
    flags: DataFrame, processed: DataFrame, as_of: Column, cfg: IntakeConfig = DEFAULT
) -> DataFrame:
    """Flags after a run; ``processed`` has doc_id and finished, one row per document.

    A document that failed after its start has a start but no end.
    """
    time = as_of.cast("timestamp_ntz")
    fresh = processed.select(
        "doc_id",
        F.lit(cfg.consumer).alias("consumer"),
        F.lit(cfg.version).alias("version"),
        time.alias("started"),
        F.when(F.col("finished"), time).alias("ended"),
    )
    kept = flags.join(fresh.select("doc_id", "consumer"), ["doc_id", "consumer"], "left_anti")
    return kept.select(fresh.columns).unionByName(fresh)


def retry_candidates(errors: DataFrame, max_retries: int = DEFAULT.max_retries) -> DataFrame:
    """Failed messages that may be tried again, with the next attempt number."""
    return errors.where(F.col("attempt") < max_retries).withColumn(
        "attempt", F.col("attempt") + 1
    )


def batch_sequence(messages: DataFrame, key: str, width: int = 100_000) -> DataFrame:
    """Arrival order of the messages of each key, from their global ``seq``."""
    return numbered(messages, key, "seq", width)
