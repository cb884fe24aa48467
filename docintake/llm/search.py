"""Ranked lexical search without an index: one automaton scans every text for all items' terms.

Terms are runs of ASCII digits, letters (A-Z in lower case) and characters beyond ASCII. Every
distinct term of the items, with a blank on either side, is a word of one Aho-Corasick
automaton; in texts whose other characters are blanks it so matches whole terms only, and its
matches are the terms' occurrences. The scan keeps per text its number of terms and the
occurrences of item terms. From these come the corpus counts and then the scores, in which
each term's contribution goes to the items that have the term. Every task keeps the best
texts of each item it saw; those meet in two steps.

With N texts that have a term, L terms in all, n terms in the text, df texts with the term and
tf occurrences in the text, a term weighs ``floor(1000 * ln((2N + 2) / (2 df + 1)))``, and
adds ``weight * ((1000000000 * tf) div (1000 * tf + 8 * m))`` where ``m = 10 + (90 * n * N) div L``.

Items are taken in blocks of at most ``BLOCK`` characters of distinct terms (or one item), so
what goes to the tasks is bounded; each block is one pass over the texts. Texts are scanned in
pieces of ``PIECE`` bytes, scores are summed for a bounded number of texts at a time.

Rows of the items with the same id, also those without one, are one item with the terms of all.
Null and empty texts have no terms: they are no text of N, and never found; items without terms
find nothing. Rows of the texts are texts of their own, whatever repeats; of equal scores the
smaller id comes first and rows without an id come last. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docintake.session import cut

BEST = 10
BLOCK = 1_000_000  # characters of distinct terms, PER_ITEM more for each item
PER_ITEM = 50
PIECE = 1 << 20  # bytes
CELLS = 1 << 22  # scores held at once
MEETINGS = 256  # first step of bringing the tasks' best texts together

# Bytes of terms with A-Z in lower case; all others become blanks.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct ``item, term`` of the items' texts."""
    lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.split(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " ")
    return (
        items.select(F.col(item_id).alias("item"), F.explode(F.array_distinct(words)).alias("term"))
        .where("term <> ''")
        .distinct()
    )


def item_blocks(terms: DataFrame, most: int) -> Iterator[dict]:
    """Terms of each item, for as many items at a time as have ``most`` characters.

    Items are sized in Spark, and dealt out in the order of their names by a running sum over
    ranges of sizes; only one block's terms are on the driver at a time.
    """
    key = F.struct(F.col("item").isNotNull().alias("known"), "item").alias("key")
    sized = cut(
        terms.groupBy("item").agg((F.sum(F.length("term") + 2) + PER_ITEM).alias("size")).select(key, "size")
    )
    terms = terms.select(key, "term")
    rest = sized
    while head := rest.orderBy("key").limit(max(1, most // PER_ITEM)).collect():
        total, last = 0, None
        for key, size in head:
            if last is not None and total + size > most:
                break
            total, last = total + size, key
        low, high = head[0][0], last
        known, item = F.col("key.known"), F.col("key.item")

        def after(at, inclusive):
            if at["known"]:
                return known & (item >= at["item"] if inclusive else item > at["item"])
            return F.lit(True) if inclusive else known

        wanted = terms.where(after(low, True) & ~after(high, False))
        found: dict = {}
        for (is_known, name), term in wanted.collect():
            found.setdefault((is_known, name), []).append(term)
        yield found
        rest = sized.where(after(last, False))


class _Automaton:
    """Counts of the given terms in UTF-8 texts."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        for k, term in enumerate(terms):
            self.found.add_word(f" {term} ", k)
        self.found.make_automaton()

    def count(self, raw: memoryview) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of terms of a text; numbers of the given terms in it, and their occurrences."""
        n, at, hits = 0, 0, []
        while at < len(raw):
            to = min(len(raw), at + PIECE)
            plain = bytes(raw[at:to]).translate(_PLAIN)
            while to < len(raw) and plain[-1] != 32:  # not inside a term
                more = bytes(raw[to : to + PIECE]).translate(_PLAIN)
                gap = more.find(b" ")
                more = more if gap < 0 else more[: gap + 1]
                plain, to = plain + more, to + len(more)
            blank = np.frombuffer(plain, np.uint8) == 32
            n += int(np.count_nonzero(~blank[1:] & blank[:-1])) + (not blank[0])
            text = f" {plain.decode('utf-8')} "
            hits.append(np.fromiter((k for _, k in self.found.iter(text)), np.int32))
            at = to
        if not hits:
            return 0, np.zeros(0, np.int32), np.zeros(0, np.int64)
        found, counts = np.unique(np.concatenate(hits), return_counts=True)
        return n, found, counts


def scan(docs: DataFrame, terms: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, n, found, tf`` of every text with a term: its id, its number of terms, and the
    numbers of the given terms that occur in it with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _Automaton(terms)
        for batch in batches:
            column = batch.column(1).cast(pa.large_string())
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset :]
            data = memoryview(column.buffers()[2] or b"")
            rows = [automaton.count(data[ends[i] : ends[i + 1]]) for i in range(batch.num_rows)]
            sizes = pa.array(np.cumsum([0, *(len(found) for _, found, _ in rows)]), pa.int32())
            none = [np.zeros(0, np.int64)]
            found = np.concatenate([r[1] for r in rows] + none).astype(np.int32)
            tf = np.concatenate([r[2] for r in rows] + none)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.ListArray.from_arrays(sizes, pa.array(found)),
                    pa.ListArray.from_arrays(sizes, pa.array(tf)),
                ],
                names=["doc", "n", "found", "tf"],
            )

    given = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
    return given.mapInArrow(run, "doc long, n long, found array<int>, tf array<long>").where("n > 0")


class _Scorer:
    """The best texts of each item among those that were added."""

    def __init__(self, postings: list[list[int]], weights: np.ndarray, n_items: int, corpus, best: int):
        self.sizes = np.array([len(p) for p in postings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.items = np.array([i for p in postings for i in p], np.int64)
        self.weights, self.n_items, self.best = weights, n_items, best
        self.texts, self.terms = corpus
        self.least = np.ones(n_items, np.int64)  # the score from which a text counts
        self.pool = [np.zeros((4, 0), np.int64)]  # item, score, 1 for no id, id
        self.pooled = 0

    def add(self, ids: np.ndarray, missing: np.ndarray, n: np.ndarray, row, found, tf) -> None:
        if len(n) and 90 * int(n.max()) * self.texts >= 1 << 63:
            m = np.array([10 + 90 * k * self.texts // self.terms for k in n.tolist()], np.int64)
        else:
            m = 10 + (90 * n * self.texts) // self.terms
        part = self.weights[found] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        sizes = self.sizes[found]
        ends = np.cumsum(sizes)
        step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        items = self.items[np.repeat(self.starts[found], sizes) + step]
        score = np.zeros(len(ids) * self.n_items, np.int64)
        np.add.at(score, np.repeat(row, sizes) * self.n_items + items, np.repeat(part, sizes))
        high = np.flatnonzero(score.reshape(-1, self.n_items) >= self.least)
        texts, items = high // self.n_items, high % self.n_items
        self.pool.append(np.stack([items, score[high], missing[texts], ids[texts]]))
        self.pooled += len(high)
        if self.pooled > 4 * self.best * self.n_items + 10_000:
            self.shrink()

    def shrink(self) -> np.ndarray:
        pool = np.concatenate(self.pool, axis=1)
        pool = pool[:, np.lexsort((pool[3], pool[2], -pool[1], pool[0]))]
        first = np.searchsorted(pool[0], pool[0], "left")
        place = np.arange(pool.shape[1]) - first
        last = pool[:, place == self.best - 1]
        self.least[last[0]] = last[1]
        pool = pool[:, place < self.best]
        self.pool, self.pooled = [pool], pool.shape[1]
        return pool


def _best_of(scanned: DataFrame, postings, weights, n_items: int, corpus, best: int) -> DataFrame:
    """``item, score, doc``: the best texts of each item in each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(postings, weights, n_items, corpus, best)
        step = max(1, CELLS // n_items)
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                doc = part.column("doc")
                found, tf = part.column("found"), part.column("tf")
                row = np.repeat(np.arange(part.num_rows), found.value_lengths().to_numpy())
                scorer.add(
                    doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                    part.column("n").to_numpy(), row, found.flatten().to_numpy(), tf.flatten().to_numpy(),
                )
        item, score, missing, ids = scorer.shrink()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(score), pa.array(ids, mask=missing.astype(bool))],
            names=["item", "score", "doc"],
        )

    found = scanned.where(F.size("found") > 0)
    return found.mapInArrow(run, "item long, score long, doc long")


def search(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most: int = BLOCK,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` texts of each item with a score above 0."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    terms = cut(item_terms(items, item_id, item_text))
    result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in item_blocks(terms, most):
        names = sorted(block, key=repr)
        numbers = {t: k for k, t in enumerate(sorted({t for ts in block.values() for t in ts}))}
        postings: list[list[int]] = [[] for _ in numbers]
        for i, name in enumerate(names):
            for term in block[name]:
                postings[numbers[term]].append(i)
        scanned = cut(scan(docs, list(numbers), doc_id, text))
        texts, total = scanned.agg(F.count("*"), F.sum("n")).first()
        if not texts:
            return result
        df = np.zeros(len(numbers), np.int64)
        for term, count in scanned.select(F.explode("found").alias("term")).groupBy("term").count().collect():
            df[term] = count
        weights = np.floor(1000 * np.log((2 * texts + 2) / (2 * df + 1))).astype(np.int64)
        near = _best_of(scanned, postings, weights, len(names), (texts, total), best)
        order = [F.desc("score"), F.asc_nulls_last("doc")]
        meeting = F.pmod(F.spark_partition_id(), F.lit(MEETINGS))
        once = Window.partitionBy("item", "meeting").orderBy(*order)
        some = near.withColumn("meeting", meeting).withColumn("rank", F.row_number().over(once))
        some = some.where(F.col("rank") <= best).drop("meeting", "rank")
        ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        ids = spark.createDataFrame([(i, name[1]) for i, name in enumerate(names)], f"item long, item_id {kind}")
        result = result.unionByName(
            ranked.where(F.col("rank") <= best)
            .join(F.broadcast(ids), "item")
            .select("item_id", "rank", F.col("doc").alias("doc_id"), "score")
        )
    return result
