"""Benchmark decontamination: windows of benchmark words looked up in every text.

Words are runs of ASCII digits, letters (A-Z in lower case) and characters beyond ASCII. A
window is ``WINDOW`` consecutive words of a benchmark item, or all words of a shorter item.
The distinct windows are sorted arrays of hashes, places and items that go to the tasks; a
text's windows are hashed as they pass, looked up, and compared word by word before they count
as hits. Every word inside a hit is hit.

The benchmark is taken in blocks of at most ``BLOCK_CHARS`` characters, so what is broadcast is
bounded however large it is: each block is one pass over the texts, and the passes' hits are
put together per row. One block is the usual case and needs no shuffle. Repeated items count
once, and longer ones are taken in pieces that share ``WINDOW - 1`` words, so that every window
is in one of them; only a window that is longer by itself makes a block longer.

Null and empty texts have no words and no hits; null or empty items have no windows. Items
with the same id are one item. Items whose id is null hit words but are not listed. Rows of
the texts are judged one by one, whatever repeats.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from docintake.llm import bytewords
from docintake.llm.columns import fresh
from docintake.session import cut

WINDOW = 10
BLOCK_CHARS = 8_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, np.uint8)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = 1
_FILTER_BITS = 22


def _window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive words from each word on that has as many after it."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    return bytewords.mix(out)


def _words_of(texts: pa.Array, overlap: int):
    data, offsets = bytewords.text_buffers(texts)
    for words in bytewords.word_blocks(data, offsets, _WORD, overlap):
        words.data = _LOWER[words.data]
        yield words, bytewords.hash_spans(words.data, words.start, words.end)


class Windows:
    """Distinct windows of some benchmark items, by their number of words."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        numbers: dict[str | None, int] = {}
        texts, found, base = [], {}, 0
        for item, text in items:
            number = numbers.setdefault(item, len(numbers))
            words, hashes = [], []
            for part, h in _words_of(pa.array([text], pa.large_string()), 0):
                raw = part.data.tobytes()
                words += [raw[a:b] for a, b in zip(part.start, part.end)]
                hashes.append(h)
            if not words:
                continue
            size = min(window, len(words))
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = ends - np.array([len(w) for w in words])
            texts.append(b" ".join(words))
            h = _window_hashes(np.concatenate(hashes), size)
            first, last = starts[: len(h)] + base, ends[size - 1 :] + base
            found.setdefault(size, []).append((h, first, last, np.full(len(h), number)))
            base += len(texts[-1])
        self.names = list(numbers)
        self.text = b"".join(texts)
        self.longest = max(found, default=0)
        self.by_size = {size: self._distinct(parts) for size, parts in found.items()}
        self.filters = {}
        for size, (hashes, *_) in self.by_size.items():
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            self.filters[size] = seen

    def _distinct(self, parts):
        """Sorted hashes of the distinct windows, their places, and from where on their items are."""
        h, first, last, item = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((item, h))
        h, first, last, item = h[order], first[order], last[order], item[order]
        kind = np.cumsum(np.concatenate([[False], h[1:] != h[:-1]]))  # windows of one text
        leader = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))[kind]
        others: dict[tuple[int, bytes], int] = {}  # texts with the hash of another one
        for k in np.flatnonzero(leader != np.arange(len(h))).tolist():
            text = self.text[first[k] : last[k]]
            if text != self.text[first[leader[k]] : last[leader[k]]]:
                kind[k] = others.setdefault((int(h[k]), text), len(h) + len(others))
        order = np.lexsort((item, kind, h))
        kind, item = kind[order], item[order]
        new = np.concatenate([[True], (kind[1:] != kind[:-1])])
        again = ~new & np.concatenate([[False], item[1:] == item[:-1]])
        items = item[~again].astype(np.int32)
        starts = np.flatnonzero(new[~again])
        at = order[np.flatnonzero(new)]
        return (
            h[at], first[at].astype(np.int64), last[at].astype(np.int64),
            np.append(starts, len(items)).astype(np.int64), items,
        )

    def hits(self, words: bytewords.Words, h: np.ndarray):
        """(first word, number of words, number of the window) of every verified window."""
        doc = words.doc
        for size, (hashes, first, last, *_) in self.by_size.items():
            w = _window_hashes(h, size)[: words.own]
            at = np.flatnonzero(self.filters[size][w >> np.uint64(64 - _FILTER_BITS)])
            at = at[doc[at] == doc[at + size - 1]]
            place = np.searchsorted(hashes, w[at])
            same = hashes[np.minimum(place, len(hashes) - 1)] == w[at]
            for k, p in zip(at[same].tolist(), place[same].tolist()):
                text = b" ".join(
                    words.data[words.start[i] : words.end[i]].tobytes() for i in range(k, k + size)
                )
                while p < len(hashes) and hashes[p] == w[k]:
                    if self.text[first[p] : last[p]] == text:
                        yield k, size, p
                        break
                    p += 1

    def items(self, found: set[tuple[int, int]]) -> list[str]:
        """Names of the items that have any of the windows (number of words, number)."""
        numbers = set()
        for size, p in found:
            *_, starts, items = self.by_size[size]
            numbers.update(items[starts[p] : starts[p + 1]].tolist())
        return sorted(name for name in (self.names[k] for k in numbers) if name is not None)


def _scan_batches(windows: Windows, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            n_words = np.zeros(n, np.int64)
            hit: list[list] = [[] for _ in range(n)]
            found: list[set] = [set() for _ in range(n)]
            for words, h in _words_of(batch.column(text), max(0, windows.longest - 1)):
                n_words += np.bincount(words.doc[: words.own], minlength=n)
                for k, size, window in windows.hits(words, h):
                    row, first = int(words.doc[k]), int(words.index[k])
                    hit[row].append((first, first + size))
                    found[row].add((size, window))
            spans = [_merged(sorted(s)) for s in hit]
            ids = [windows.items(s) for s in found]
            flat = [{"first": a, "end": b} for s in spans for a, b in s]
            ends = pa.array(np.cumsum([0, *map(len, spans)]), pa.int32())
            kind = pa.struct([("first", pa.int64()), ("end", pa.int64())])
            for name, column in zip(
                names,
                (
                    pa.array(n_words),
                    pa.ListArray.from_arrays(ends, pa.array(flat, kind)),
                    pa.array(ids, pa.list_(pa.string())),
                ),
            ):
                batch = batch.append_column(name, column)
            yield batch

    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(s) for s in out]


def in_pieces(text: str, window: int, most: int) -> Iterator[str]:
    """A text in pieces of about ``most`` characters that share ``window - 1`` words."""
    begin, recent = 0, deque(maxlen=max(1, window - 1))
    own = 0  # words of the piece that the one before did not have
    for word in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text):
        recent.append(word.start())
        own += 1
        if word.end() - begin > most and own > window:
            yield text[begin : word.end()]
            begin, own = (recent[0] if window > 1 else word.end()), 0
    if own:
        yield text[begin:]


def benchmark_blocks(
    benchmark: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    most: int = BLOCK_CHARS,
    window: int = WINDOW,
) -> Iterator[list[tuple[str | None, str]]]:
    """The distinct items, at most ``most`` characters at a time, read block by block."""

    def cut_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pieces = list(in_pieces(words, window, most // 4)) if len(words) > most // 2 else [words]
                for piece in pieces:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item], pa.string()), pa.array([piece], pa.string())], ["item", "text"]
                    )

    items = (
        benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
        .where(F.length("text") > 0)
        .mapInArrow(cut_long, "item string, text string")
    )
    yield from _dealt(cut(items.distinct()), most, 0)


def _dealt(items: DataFrame, most: int, level: int) -> Iterator[list[tuple[str | None, str]]]:
    """Deal items by a hash until every part is small enough; parts without items do not arise."""
    n, size = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    if n < 2 or size <= most:
        if n or not level:
            yield [tuple(r) for r in items.collect()]
        return
    part = F.pmod(F.xxhash64(F.lit(level), "item", "text"), F.lit(-(-2 * size // most)))
    dealt = items.withColumn("part", part)
    for (number,) in dealt.select("part").distinct().orderBy("part").collect():
        yield from _dealt(dealt.where(F.col("part") == number).drop("part"), most, level + 1)


SPANS = ArrayType(StructType([StructField("first", LongType()), StructField("end", LongType())]))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    names: tuple[str, str, str] = ("n_words", "hits", "items"),
    most: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with its number of words, hit spans of words, and ids of items that occur.

    ``names`` are the three new columns; they must not be columns of ``docs``.
    """
    result = None
    kinds = (LongType(), SPANS, ArrayType(StringType()))
    fields = [StructField(c, kind) for c, kind in zip(names, kinds)]
    blocks = (Windows(b, window) for b in benchmark_blocks(benchmark, most=most, window=window))
    block, later = next(blocks), next(blocks, None)
    if later is None:
        schema = StructType([*docs.schema.fields, *fields])
        return docs.mapInArrow(_scan_batches(block, text, list(names)), schema)

    # more than one pass: rows are numbered once, and each pass returns what it hit
    (row,) = fresh(docs, "row")
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    thin = numbered.select(row, text)
    while True:
        schema = StructType([*thin.schema.fields, *fields])
        part = thin.mapInArrow(_scan_batches(block, text, list(names)), schema).drop(text)
        part = cut(part if result is None else part.where(F.size(names[1]) > 0))
        result = part if result is None else result.unionByName(part)
        if later is None:
            break
        block, later = later, next(blocks, None)
    words, hits, items = names
    merged = result.groupBy(row).agg(
        F.max(words).alias(words),
        F.flatten(F.collect_list(hits)).alias(hits),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(items)))).alias(items),
    )
    merged = merged.withColumn(hits, _merge_spans(F.col(hits)))
    return numbered.join(merged, row).drop(row)


def _merge_spans(spans):
    """Overlapping and adjacent spans of an array as one, in order."""

    def add(out, s):
        last = F.try_element_at(out, F.lit(-1))
        joined = F.struct(
            last["first"].alias("first"), F.greatest(last["end"], s["end"]).alias("end")
        )
        before = F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0)))
        touches = F.coalesce(last["end"] >= s["first"], F.lit(False))
        return F.when(touches, F.concat(before, F.array(joined))).otherwise(
            F.concat(out, F.array(s))
        )

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def n_hit(hits):
    """Number of words in the spans of ``hits``."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])


def remove_spans(scanned: DataFrame, text: str, hits: str) -> DataFrame:
    """``scanned`` with the hit words, and what stands between them, taken out of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(text).to_pylist()
            for i, spans in enumerate(batch.column(hits).to_pylist()):
                if spans:
                    texts[i] = _without(texts[i], spans)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return scanned.mapInArrow(run, scanned.schema)


def _without(text: str, spans: list[dict]) -> str:
    raw, out, at = text.encode("utf-8"), [], 0
    starts, ends = {s["first"]: None for s in spans}, {s["end"] - 1: None for s in spans}
    for words in bytewords.word_blocks(
        np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), _WORD
    ):
        base = words.data.ctypes.data - np.frombuffer(raw, np.uint8).ctypes.data
        low = int(words.index[0]) if len(words.index) else 0
        for table, edge in ((starts, words.start), (ends, words.end)):
            for k in table:
                if low <= k < low + len(edge):
                    table[k] = base + int(edge[k - low])
    for s in spans:
        out.append(raw[at : starts[s["first"]]])
        at = ends[s["end"] - 1]
    out.append(raw[at:])
    return b"".join(out).decode("utf-8")
