"""Summaries of the operation log and of message outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.functions.uris import scheme_label

# Reported quantiles. The sketch accuracy keeps the rank error of both
# far below their allowed errors (0.05 and 0.01) and exact for small groups.
QUANTILES = (0.5, 0.9)
ACCURACY = 100_000


def _summary(df: DataFrame, labels: list[str], value: str) -> DataFrame:
    quantiles = F.percentile_approx(value, list(QUANTILES), ACCURACY)
    return (
        df.groupBy(*labels)
        .agg(
            F.count(value).alias("n"),
            F.sum(value).alias("total"),
            quantiles.alias("q"),
        )
        .select(*labels, "n", "total", F.col("q")[0].alias("q50"), F.col("q")[1].alias("q90"))
    )


def document_size_summary(docs: DataFrame) -> DataFrame:
    """Size quantiles, count and sum by scheme label and content type."""
    labelled = docs.withColumn("scheme", scheme_label(F.col("scheme")))
    return _summary(labelled, ["scheme", "mimetype"], "bytes")


def latency_summary(log: DataFrame, labels: list[str]) -> DataFrame:
    """Latency quantiles, count and sum by any labels of the operation log."""
    if "scheme" in labels:
        log = log.withColumn("scheme", scheme_label(F.col("scheme")))
    return _summary(log, labels, "seconds")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("consumer", "result").agg(F.count(F.lit(1)).alias("n"))


# Allowed rank errors of the reported quantiles.
RANK_ERRORS = (0.05, 0.01)
SKETCH_K = 800  # a rank error of a third of a percent


def summary_sketches(df: DataFrame, labels: list[str], value: str) -> DataFrame:
    """Count, sum and a mergeable quantile sketch of ``value`` by label, for one batch.

    The rows of several batches are put together by :func:`merged_summary`, so that a running
    summary reads a row a label and batch and never the values again.
    """
    return df.groupBy(*labels).agg(
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), SKETCH_K).alias("sketch"),
    )


def merged_summary(batches: DataFrame, labels: list[str]) -> DataFrame:
    """Labels, n, total and the quantiles q50 and q90 over all batches' sketches."""
    merged = batches.groupBy(*labels).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"),
    )
    quantiles = [
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(name)
        for q, name in zip(QUANTILES, ("q50", "q90"))
    ]
    return merged.select(*labels, "n", "total", *quantiles)
