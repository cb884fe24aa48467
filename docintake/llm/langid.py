"""Language identification by rank-order profiles.

A text is read as its letters in lower case, with one gap for each run of other characters and
one at either end. Its n-grams are 1 to 3 of these signs in a row, without the gap by itself
and without a gap in the middle. A profile is the ``SIZE`` most frequent n-grams of a text, or
of all texts of a language, in order (ties by code points, the gap first). An n-gram of a
text's profile is as far out of place as its two ranks differ, or ``SIZE`` if the language's
profile does not have it; the sum over the text's profile is its distance to the language. The
nearest language is taken, of equally near ones the first by name. The score is one minus the
distance as a share of the largest possible one.

N-grams are counted for all texts with a language, in Spark; only profiles reach the driver, in
blocks of ``LANGUAGES`` languages, each of which is one more step over the texts in the same
pass. Texts are taken in pieces of ``PIECE`` characters, so memory does not grow with them.

Null texts and texts without letters are ``und`` with score 0, and so is every text if no
language was learned. A text that shares no n-gram with any profile has score 0 and the first
language. Rows are judged one by one, whatever repeats; equal texts get equal results. Rows to
learn from that have no text, no letter or no language teach nothing. Empty tables give empty
results. Other columns stay as they are.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from docintake.session import cut

SIZE = 400
LANGUAGES = 500
PIECE = 1 << 20  # characters
ROWS = 1 << 10  # rows taken together; their numbers share 64 bits with the n-gram
_BITS = 18  # of one sign
_GAP = 1
UNKNOWN = "und"


@functools.cache
def _signs() -> np.ndarray:
    """Sign of every code point: letters by their lower-case form, in order; the rest is the gap."""
    lower = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            lower[point] = ord(c.lower()[0])
    letters = np.unique(lower[lower > 0])
    return np.where(lower > 0, np.searchsorted(letters, lower) + _GAP + 1, _GAP).astype(np.uint64)


def _packed(before2: np.ndarray, before: np.ndarray, last: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Sorted (group, n-gram) numbers of the n-grams that end with ``last``."""
    one, two, top = np.uint64(_BITS), np.uint64(2 * _BITS), np.uint64(3 * _BITS)
    high = group << top
    letter, inner = last > _GAP, before > _GAP
    return np.sort(
        np.concatenate(
            [
                (high | last << two)[letter],
                high | before << two | last << one,
                (high | before2 << two | before << one | last)[inner],
            ]
        )
    )


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sum of their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first)


def _grams_of(texts: list[str], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (group, n-gram) numbers of some texts, and how often each occurs."""
    signs = _signs()
    found, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined = "\n".join([*texts, ""])
    owner = np.repeat(groups.astype(np.uint64), [len(t) + 1 for t in texts])
    tail, tail_owner = np.array([_GAP], np.uint64), owner[:1]
    for at in range(0, len(joined), PIECE):
        points = np.frombuffer(joined[at : at + PIECE].encode("utf-32-le"), np.uint32)
        sign = signs[points]
        before = np.concatenate([tail[-1:], sign[:-1]])
        kept = (sign > _GAP) | (before > _GAP)
        stream = np.concatenate([tail, sign[kept]])
        owners = np.concatenate([tail_owner, owner[at : at + PIECE][kept]])
        own = len(tail)
        padded = np.concatenate([np.zeros(2, np.uint64), stream])
        keys, n = _summed(
            _packed(padded[own : -2], padded[own + 1 : -1], padded[own + 2 :], owners[own:])
        )
        if len(found):
            order = np.argsort(np.concatenate([found, keys]), kind="stable")
            found, counts = _summed(
                np.concatenate([found, keys])[order], np.concatenate([counts, n])[order]
            )
        else:
            found, counts = keys, n
        tail, tail_owner = stream[-2:], owners[-2:]
    return found, counts


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ROWS rows and about PIECE characters, or one longer text."""
    first, size = 0, 0
    for row, text in enumerate(texts):
        n = len(text or "") + 1
        if row > first and (size + n > PIECE or row - first == ROWS):
            yield first, row
            first, size = row, 0
        size += n
    if first < len(texts):
        yield first, len(texts)


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = SIZE) -> DataFrame:
    """``lang, gram, rank`` (from 0): the ``size`` most frequent n-grams of each language.

    Counted over every row that has a language. Counts of a block of rows are added up before
    they are shuffled, and each task keeps ``size`` n-grams a language before these meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, end in _blocks(texts):
                names = sorted(set(langs[first:end]))
                number = {name: k for k, name in enumerate(names)}
                groups = np.array([number[name] for name in langs[first:end]])
                keys, counts = _grams_of([t or "" for t in texts[first:end]], groups)
                which = (keys >> np.uint64(3 * _BITS)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.string()).take(pa.array(which)),
                        pa.array((keys & np.uint64((1 << 3 * _BITS) - 1)).astype(np.int64)),
                        pa.array(counts.astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )

    known = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counted = known.where("text <> '' AND lang IS NOT NULL").mapInArrow(
        run, "lang string, gram long, n long"
    )
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        total.withColumn("rank", F.row_number().over(place) - 1)
        .where(F.col("rank") < size)
        .select("lang", "gram", "rank")
    )


class _Profiles:
    """The profiles of some languages as one table of ranks."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.names = sorted({name for name, _, _ in rows})
        number = {name: k for k, name in enumerate(self.names)}
        grams = np.array([gram for _, gram, _ in rows], np.uint64)
        self.grams = np.unique(grams)
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int32)
        where = np.searchsorted(self.grams, grams)
        self.ranks[where, [number[name] for name, _, _ in rows]] = [rank for *_, rank in rows]

    def nearest(self, keys: np.ndarray, counts: np.ndarray, n: int):
        """Number of the nearest language and the score of each of ``n`` texts; -1 without letters."""
        best, score = np.full(n, -1), np.zeros(n)
        if not len(keys):
            return best, score
        row = (keys >> np.uint64(3 * _BITS)).astype(np.int64)
        gram = keys & np.uint64((1 << 3 * _BITS) - 1)
        order = np.lexsort((-counts, row))  # keys are sorted, so ties stay in order
        row, gram = row[order], gram[order]
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
        top = rank < self.size
        row, gram, rank = row[top], gram[top], rank[top]
        place = np.searchsorted(self.grams, gram)
        place[place == len(self.grams)] = 0
        place[self.grams[place] != gram] = len(self.grams)  # the row of no language
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        ends = np.append(starts[1:], len(row))
        step = max(1, (4 << 20) // (self.size * len(self.names)))
        for k in range(0, len(starts), step):
            a, b = starts[k], ends[min(k + step, len(starts)) - 1]
            ranks = self.ranks[place[a:b]]
            away = np.where(ranks < 0, self.size, np.abs(ranks - rank[a:b, None]))
            total = np.add.reduceat(away, starts[k : k + step] - a, axis=0, dtype=np.int64)
            near = total.argmin(axis=1)
            rows = row[starts[k : k + step]]
            best[rows] = near
            most = self.size * (ends[k : k + step] - starts[k : k + step])
            score[rows] = 1 - total[np.arange(len(near)), near] / most
        return best, score


def _step(docs: DataFrame, rows: list, size: int, text: str, names: tuple[str, str]) -> DataFrame:
    """Take the nearest of some more languages where it is nearer than what is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Profiles(rows, size)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            names_at = [batch.schema.get_field_index(name) for name in names]
            lang, score = (batch.column(at).to_pylist() for at in names_at)
            for first, end in _blocks(texts):
                keys, counts = _grams_of([t or "" for t in texts[first:end]], np.arange(end - first))
                best, near = known.nearest(keys, counts, end - first)
                for row in np.flatnonzero(best >= 0):
                    at = first + int(row)
                    if lang[at] is None or near[row] > score[at]:
                        lang[at], score[at] = known.names[best[row]], float(near[row])
            for at, values, kind in zip(names_at, (lang, score), (pa.string(), pa.float64())):
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, kind))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def identify(
    docs: DataFrame,
    learned: DataFrame,
    text: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"),
    size: int = SIZE,
    languages: int = LANGUAGES,
) -> DataFrame:
    """``docs`` with the nearest language and its score, by profiles as :func:`profiles` gives them.

    ``names`` are the two new columns; they must not be columns of ``docs``.
    """
    known = cut(learned)
    schema = StructType(
        [*docs.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())]
    )
    found = docs.withColumn(names[0], F.lit(None).cast("string")).withColumn(
        names[1], F.lit(None).cast("double")
    ).to(schema)
    rest = known
    while block := [r[0] for r in rest.select("lang").distinct().orderBy("lang").limit(languages).collect()]:
        part = rest.where(F.col("lang") <= block[-1])
        rows = [tuple(r) for r in part.select("lang", "gram", "rank").collect()]
        found = _step(found, rows, size, text, names)
        rest = known.where(F.col("lang") > block[-1])
    return found.withColumn(names[0], F.coalesce(names[0], F.lit(UNKNOWN))).withColumn(
        names[1], F.coalesce(names[1], F.lit(0.0))
    )
