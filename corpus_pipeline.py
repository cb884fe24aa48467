"""From raw documents to packed sequences: five of the operators, one after the other.

Each stage is written and read again, so that a lost executor costs at most one stage's tasks,
and each works on all that the stage before it kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.llm import decontaminate, packing, pii, quality, simhash
from docintake.llm.columns import fresh
from docintake.llm.queries import quality_weights, table, vocabulary
from docintake.session import cut, ensure_checkpoint_dir, prepare_python


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (a score of at least a half)."""
    prepare_python(spark)
    (score,) = fresh(docs, "score")
    weights = quality_weights(spark, sf_dir, docs)
    return quality.score(docs, weights, name=score).where(F.col(score) >= 0.5).drop(score)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the row with the smallest id (null ids come last).

    Rows are told apart by a number of their own, so repeated and null ids are rows like others:
    of rows that share the smallest id, or that have none, the smallest hash and number stays.
    """
    prepare_python(spark)
    (row,) = fresh(docs, "row")
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    place = F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id",
        F.xxhash64("text").alias("tie"), F.col(row).alias("row"),
    )
    marked = cut(simhash.fingerprints(numbered.select(place.alias("doc_id"), "text")))
    keep = simhash.classes(marked).select(F.col("component_id.row").alias(row)).distinct()
    return numbered.join(keep, row, "left_semi").select(docs.columns)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    prepare_python(spark)
    names = fresh(docs, "n_words", "hits", "items")
    scanned = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), names=tuple(names))
    return scanned.where(F.size(names[1]) == 0).drop(*names)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the kind of personal data in its place, and their new lengths."""
    prepare_python(spark)
    (spans,) = fresh(docs, "spans")
    found = pii.spans(docs, name=spans).drop(spans)
    if "n_chars" not in docs.columns:
        return found
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    prepare_python(spark)
    return packing.pack(cut(packing.pieces(docs, vocabulary())))


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_one_of_each),
    ("benchmark decontamination", keep_clean),
    ("personal data", redact),
    ("best-fit packing", pack),
]

#: Fingerprints, a fitted model and a tokenizer are beyond SQL; tests/llm has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        done = stage(spark, docs, sf_dir)
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
