"""Quality classifier: logistic regression over hashed word n-grams, fitted by FTRL.

Tokens are words (letters, digits, bytes beyond ASCII) and runs of punctuation. A text's
features are the hashes of its tokens, of its pairs of neighbouring tokens, and of its pairs
of token shapes (lower case, capitalised, upper case, with digits, or the punctuation
itself); a token that repeats its neighbour counts as one common pair. Each feature's value
is its share of the text's tokens. Scores are a sparse dot product of these shares with the
weights, so they add up block by block and no text is cut short.

Weights come from per-coordinate follow-the-regularised-leader updates. Labelled rows are
dealt by hash over ``shards`` tasks; each runs its updates and the shards' weights are
averaged. At most about ``max_rows`` labelled rows are fitted: beyond that the rows with the
smallest hashes are taken. Scoring covers all rows.

Nulls and texts without tokens have no features; their score comes from the bias alone.
Repeated rows are scored as often as they occur, and fitted once. Without labelled rows, or with
labels of one kind only, the score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from docintake.llm import bytewords
from docintake.session import cut

BITS = 18
SCALE = 20.0  # shares are small; this brings the weights to a usual size


@dataclass(frozen=True)
class Ftrl:
    """Parameters of the fit; it sees about ``max_rows`` labelled rows or ``max_bytes`` of
    text at most, so that what one task holds is bounded."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.05
    epochs: int = 3
    shards: int = 4
    max_rows: int = 24_000
    max_bytes: int = 160_000_000


def _kinds() -> np.ndarray:
    kinds = np.full(256, 2, np.uint8)
    for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kinds[a:b] = 1
    kinds[[9, 10, 11, 12, 13, 32]] = 0
    return kinds


_KINDS = _kinds()
_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int32)
_DIGIT[48:58] = 1


def _sums(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[end] - total[start]


def _features(words: bytewords.Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of every token, pair and pair of shapes that begins in the block."""
    start, end, doc = words.start, words.end, words.doc
    h = bytewords.hash_spans(words.data, start, end)
    upper = _sums(_UPPER[words.data], start, end)
    digits = _sums(_DIGIT[words.data], start, end)
    length = end - start
    # two bytes in upper case suffice beside letters beyond ASCII, whose case is not looked at
    shape = np.where(digits > 0, 4, np.where((upper > 1) & (2 * upper >= length), 3,
                     np.where(_UPPER[words.data[start]] > 0, 2, 1))).astype(np.uint64)
    shape = np.where(_KINDS[words.data[start]] == 2, h, shape)
    shift = np.uint64(64 - BITS)
    own = words.own
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    pair = pair[pair < own]
    a, b = h[pair], h[pair + 1]
    pairs = np.where(a == b, np.uint64(1), bytewords.mix(a * np.uint64(3) + b))
    shapes = bytewords.mix(shape[pair] * np.uint64(0x9E3779B97F4A7C15) + shape[pair + 1])
    return (
        np.concatenate([doc[:own], doc[pair], doc[pair]]),
        np.concatenate([h[:own] >> shift, pairs >> shift, shapes >> shift]).astype(np.int64),
    )


def _examples(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and their values, for each text."""
    data, offsets = bytewords.text_buffers(texts)
    n = len(texts)
    rows, features, tokens = [], [], np.zeros(n, np.int64)
    for words in bytewords.word_blocks(data, offsets, _KINDS, overlap=1):
        row, feature = _features(words)
        key, count = np.unique((row << BITS) | feature, return_counts=True)
        rows.append(key)
        features.append(count)
        tokens += np.bincount(words.doc[: words.own], minlength=n)
    if not rows:
        return [(np.zeros(0, np.int64), np.zeros(0))] * n
    keys, counts = np.concatenate(rows), np.concatenate(features)
    key, at = np.unique(keys, return_inverse=True)
    count = np.bincount(at, weights=counts)
    row = key >> BITS
    cut = np.searchsorted(row, np.arange(n + 1))
    index = key & ((1 << BITS) - 1)
    return [
        (index[i:j], SCALE * count[i:j] / max(1, tokens[k]))
        for k, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True))
    ]


def ftrl_fit(examples, labels, config: Ftrl) -> np.ndarray:
    """Weights of all features, and the bias last, after ``epochs`` passes in a fixed order."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - config.l1, 0)
        return -shrunk / ((config.beta + np.sqrt(n[i])) / config.alpha + config.l2)

    for epoch in range(config.epochs):
        for k in np.random.RandomState(epoch).permutation(len(labels)):
            index, value = examples[k]
            i, x = np.append(index, size - 1), np.append(value, 1.0)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - labels[k]) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / config.alpha * w
            n[i] += g * g
    return weights(np.arange(size))


def _fit_shard(config: Ftrl):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("_order", "_label", "_text")])
        texts = table.column("_text").combine_chunks()
        examples = []
        for at in range(0, len(texts), 256):
            examples += _examples(texts.slice(at, 256))
        w = ftrl_fit(examples, table.column("_label").to_numpy(), config)
        return pa.table({"rows": [len(texts)], "weights": [w.astype("<f4").tobytes()]})

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    config: Ftrl = Ftrl(),
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> np.ndarray:
    """Weights (bias last) from the rows of ``docs`` whose id ``labels`` gives a label of 0 or 1.

    Rows with the same id and text teach once. The rows to fit are chosen by a hash of id and
    text, from ids, hashes and lengths alone; only their texts are then moved. A repeated id has
    no more than its share of them, and each shard is a task of its own.
    """
    given = labels.where(F.col(label).isin(0, 1)).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_label")
    ).distinct()
    content = F.coalesce(text, F.lit(""))
    known = docs.select(F.col(doc_id).alias("_id"), content.alias("_text")).where("_id IS NOT NULL")
    known = known.withColumn("_hash", F.xxhash64("_text"))
    sizes = known.groupBy("_id", "_hash").agg(F.max(F.octet_length("_text")).alias("_size"))
    order = F.xxhash64(F.col("_id").cast("string"), F.col("_hash"))
    labelled = cut(sizes.join(given, "_id").withColumn("_order", order))
    total, ones, size = labelled.agg(F.count("*"), F.sum("_label"), F.sum("_size")).first()
    if not total or ones in (0, total):
        w = np.zeros((1 << BITS) + 1, np.float32)
        share = (ones / total) if total else 0.5
        w[-1] = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return w
    part = min(config.max_rows / total, config.max_bytes / max(1, size))
    if part < 1:  # the rows with the smallest hashes, by share of all hashes
        labelled = labelled.where(F.col("_order") < F.lit(int(part * 2**64) - 2**63))
    chosen = cut(labelled.select("_id", "_hash", "_label", "_order"))
    if chosen.count() <= 2 * config.max_rows:  # as expected, so it may be broadcast
        chosen = F.broadcast(chosen)
    shard = F.pmod(F.hash("_order"), F.lit(config.shards))
    rows = cut(
        known.join(chosen, ["_id", "_hash"])
        .dropDuplicates(["_id", "_hash", "_label"])
        .select("_text", "_label", "_order", shard.alias("_shard"))
    )
    fitted = (
        rows.repartitionByRange(config.shards, "_shard")
        .groupBy("_shard")
        .applyInArrow(_fit_shard(config), "rows long, weights binary")
        .collect()  # one row for each of a few shards, 1 MB each
    )
    share = np.array([r["rows"] for r in fitted], float)
    stacked = np.array([np.frombuffer(r["weights"], "<f4") for r in fitted])
    return (share @ stacked / share.sum()).astype(np.float32)


def _score_batches(weights: np.ndarray, text: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytewords.text_buffers(batch.column(text))
            n = batch.num_rows
            total, tokens = np.zeros(n), np.zeros(n)
            for words in bytewords.word_blocks(data, offsets, _KINDS, overlap=1):
                row, feature = _features(words)
                total += np.bincount(row, weights=weights[feature], minlength=n)
                tokens += np.bincount(words.doc[: words.own], minlength=n)
            logit = SCALE * total / np.maximum(tokens, 1) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(logit, -35, 35)))
            yield batch.append_column(name, pa.array(score))

    return run


def score(df: DataFrame, weights: np.ndarray, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with column ``name``: how likely label 1 is. ``name`` must be a new column."""
    schema = StructType([*df.schema.fields, StructField(name, DoubleType())])
    return df.mapInArrow(_score_batches(weights, text, name), schema)
