"""SimHash near-duplicates: fingerprints, a binary trie self-join, and components.

A fingerprint has 64 bits; bit k is 1 if it is set in over half of the XXH64 hashes (seed 42)
of the text's shingles, repeats included. Words are runs of bytes other than ASCII white
space, A-Z in lower case. Fewer words than a shingle make one shingle of them all; a text
without words (or null) has fingerprint zero, which links like any other.

Fingerprints that differ in at most two bits are found by traversing pairs of nodes of a
binary trie. Differing bits add up on the way down and a pair is dropped when they exceed the
budget. With two errors over three blocks of bits one block is free of them, so the trie is
kept in three rotations, one for each block in front; under a shared block the traversal
starts with no error. The subtries below the blocks are what Spark deals out: they are
sorted into partitions and traversed there in slices of bounded size. A subtrie of over
``SPLIT`` fingerprints is dealt out by pairs of its own subtries, eight bits further down.

Only distinct fingerprints are joined, and each subtrie returns a spanning forest of its
links instead of all pairs: the components are the same, and groups of copies cost no pairs.
Classes are then the components over these forests. Documents with the same fingerprint
share a class. A null doc_id belongs to its fingerprint's class but never names it, unless
all of the class's ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docintake.llm.components import components
from docintake.session import cut

BITS = 64
BUDGET = 2
BLOCKS = ((0, 22), (22, 21), (43, 21))  # first bit from the top, number of bits
SPLIT = 1_000_000
SPLIT_BITS = 8
FRONTIER = 1 << 18  # pairs of nodes that are expanded at once
PART = 1 << 15  # hashes whose bits are counted at once

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, size: int = 3) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words) - size + 1
    if not words:
        return 0
    if n <= 1:
        return _hash(b" ".join(words))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, PART):
        to = min(n, at + PART)
        parts = [words[at + i : to + i] for i in range(size)]
        hashes = np.fromiter(map(_hash, map(b" ".join, zip(*parts))), ">u8", to - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64
        )
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprint_batches(text: str, name: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), size) for t in batch.column(text)),
                np.uint64,
                batch.num_rows,
            )
            yield batch.drop_columns([text]).append_column(name, pa.array(found.view(np.int64)))

    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3):
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number, of every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("fp", LongType())])
    return rows.mapInArrow(_fingerprint_batches("text", "fp", size), schema)


def _rotated(fp: np.ndarray, first: int) -> np.ndarray:
    """Bits from ``first`` on in front."""
    if not first:
        return fp
    return (fp << np.uint64(first)) | (fp >> np.uint64(BITS - first))


def trie_links(keys: np.ndarray, lo, hi, lo2, hi2, depth, errors, budget: int = BUDGET):
    """Pairs of positions in the sorted ``keys`` that differ in at most ``budget`` bits.

    Each entry is a pair of trie nodes: ranges lo:hi and lo2:hi2 of ``keys``, alike in their
    first ``depth`` bits but for ``errors`` of them; equal ranges are one node with itself.
    Yields arrays (i, j). Pairs wait on a stack in slices, so that memory stays bounded.
    """
    stack = [(lo, hi, lo2, hi2, depth, errors)]
    while stack:
        lo, hi, lo2, hi2, depth, errors = stack.pop()
        if len(lo) > FRONTIER:
            cuts = range(0, len(lo), FRONTIER)
            columns = (lo, hi, lo2, hi2, depth, errors)
            stack += [tuple(c[at : at + FRONTIER] for c in columns) for at in cuts]
            continue
        leaf = (hi - lo == 1) & (hi2 - lo2 == 1)
        i, j = lo[leaf], lo2[leaf]
        near = (i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
        if near.any():
            yield i[near], j[near]
        inner = ~leaf
        if not inner.any():
            continue
        lo, hi, lo2, hi2, depth, errors = (
            c[inner] for c in (lo, hi, lo2, hi2, depth, errors)
        )
        bit = np.uint64(1) << (np.uint64(BITS - 1) - depth.astype(np.uint64))
        mid, mid2 = _split(keys, lo, hi, bit), _split(keys, lo2, hi2, bit)
        same = (lo == lo2) & (hi == hi2)
        pairs = (
            (lo, mid, lo2, mid2, errors, lo < hi),
            (mid, hi, mid2, hi2, errors, lo < hi),
            (lo, mid, mid2, hi2, errors + 1, lo < hi),
            (mid, hi, lo2, mid2, errors + 1, ~same),  # a node with itself: this pair is the last
        )
        new = []
        for a, b, c, d, e, take in pairs:
            keep = take & (a < b) & (c < d) & (e <= budget)
            keep &= ~((a == c) & (b == d) & (b - a == 1))
            new.append((a[keep], b[keep], c[keep], d[keep], depth[keep] + 1, e[keep]))
        stack.append(tuple(np.concatenate(c) for c in zip(*new)))


def _split(keys, lo, hi, bit):
    """First position in lo:hi whose ``bit`` is set, by bisection of all ranges at once."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        one = (keys[np.minimum(mid, len(keys) - 1)] & bit) != 0
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)


class _Forest:
    """Union-find over positions; ``join`` returns the links that joined two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def _roots(self, at: np.ndarray) -> np.ndarray:
        parent = self.parent
        while True:
            up = parent[at]
            if (up == at).all():
                return at
            parent[at] = parent[up]
            at = up

    def join(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kept_i, kept_j = [], []
        while len(i):
            a, b = self._roots(i), self._roots(j)
            low, high = np.minimum(a, b), np.maximum(a, b)
            open_ = low < high
            low, high, i, j = low[open_], high[open_], i[open_], j[open_]
            if not len(i):
                break
            _, first = np.unique(high, return_index=True)  # each tree is hung up once a round
            self.parent[high[first]] = low[first]
            kept_i.append(i[first])
            kept_j.append(j[first])
        if not kept_i:
            return i, j
        return np.concatenate(kept_i), np.concatenate(kept_j)


def _group_links(key, block, cell, pair, rep, split_depth):
    """Forest links of whole groups, given sorted by (block, key prefix, pair, key)."""
    n = len(key)
    front = np.array([b[1] for b in BLOCKS])[block]
    prefix = key >> (np.uint64(BITS) - front.astype(np.uint64))
    new = np.ones(n, bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (block[1:] != block[:-1]) | (pair[1:] != pair[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], n)
    whole = pair[lo] < 0
    parts = []
    at = whole & (hi - lo > 1)
    parts.append((lo[at], hi[at], lo[at], hi[at], front[lo[at]], np.zeros(at.sum(), np.int64)))
    for a, b in zip(lo[~whole], hi[~whole]):  # pairs of subtries: one after the other in the sort
        first, second = divmod(int(pair[a]), 1 << SPLIT_BITS)
        mid = a + int(np.searchsorted(cell[a:b], second, "left")) if first != second else b
        depth, errors = front[a] + split_depth, (first ^ second).bit_count()
        ranges = (a, mid, a, mid) if first == second else (a, mid, mid, b)
        if ranges[0] < ranges[1] and ranges[2] < ranges[3]:
            parts.append(tuple(np.array([x]) for x in (*ranges, depth, errors)))
    start = tuple(np.concatenate(c) for c in zip(*parts))
    forest = _Forest(n)
    for i, j in trie_links(key, *start):
        i, j = forest.join(i, j)
        yield rep[i], rep[j]


def _subtries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within whole groups; a group that is still open waits for the next batch."""
    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rows = {c: table[c].to_numpy() for c in table.column_names}
        if waiting is not None:
            rows = {c: np.concatenate([waiting[c], rows[c]]) for c in rows}
        n = len(rows["key"])
        if not n:
            continue
        same = np.ones(n, bool)
        for c in ("block", "prefix", "pair"):
            same &= rows[c] == rows[c][-1]
        last = n - int(np.argmin(same[::-1])) if not same.all() else 0
        waiting = {c: v[last:] for c, v in rows.items()}
        if last:
            yield from _links_of({c: v[:last] for c, v in rows.items()})
    if waiting is not None:
        yield from _links_of(waiting)


def _links_of(rows) -> Iterator[pa.RecordBatch]:
    key = rows["key"].view(np.uint64)
    found = _group_links(
        key, rows["block"], rows["cell"], rows["pair"], rows["rep"], SPLIT_BITS
    )
    for a, b in found:
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def trie_self_join(distinct: DataFrame, split: int = SPLIT) -> DataFrame:
    """Links ``a``, ``b`` that connect what is within the budget; rows ``fp``, ``rep``, unique.

    ``fp`` is the 64-bit fingerprint and ``rep`` the number that stands for it.
    """
    def bits(first, n):  # n bits from the first-th on, cyclically, as a number
        rotated = F.shiftleft("fp", first) if first else F.col("fp")
        if first:
            rotated = rotated.bitwiseOR(F.shiftrightunsigned("fp", BITS - first))
        return rotated, F.shiftrightunsigned(rotated, BITS - n)

    rotations = []
    for block, (first, n) in enumerate(BLOCKS):
        key, prefix = bits(first, n)
        cell = F.shiftrightunsigned(key, BITS - n - SPLIT_BITS).bitwiseAND(
            F.lit((1 << SPLIT_BITS) - 1)
        )
        rotations.append(
            F.struct(
                F.lit(block).alias("block"), key.alias("key"), prefix.alias("prefix"),
                cell.cast("int").alias("cell"),
            )
        )
    rows = distinct.select("rep", F.inline(F.array(*rotations)))
    sizes = rows.groupBy("block", "prefix").agg(F.count("*").alias("size")).where("size > 1")
    rows = rows.join(sizes, ["block", "prefix"])
    near = [m for m in range(1 << SPLIT_BITS) if m.bit_count() <= BUDGET]
    partners = F.transform(
        F.lit(near).cast("array<int>"),
        lambda m: F.least("cell", F.col("cell").bitwiseXOR(m)) * (1 << SPLIT_BITS)
        + F.greatest("cell", F.col("cell").bitwiseXOR(m)),
    )
    whole = F.array(F.lit(-1))
    rows = rows.withColumn(
        "pair", F.explode(F.when(F.col("size") > split, partners).otherwise(whole))
    ).drop("size")
    return (
        rows.repartition("block", "prefix", "pair")
        .sortWithinPartitions("block", "prefix", "pair", F.col("key").bitwiseXOR(F.lit(-(2**63))))
        .mapInArrow(_subtries, "a long, b long")
    )


def classes(marked: DataFrame, split: int = SPLIT) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row of ``fingerprints`` (materialised).

    ``component_id`` is the smallest doc_id that can be reached over links.
    """
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    # fingerprints stand for themselves in the join, and classes are named by doc_id after it
    links = cut(trie_self_join(distinct.select("fp", F.col("fp").alias("rep")), split))
    member = components(links)
    named = distinct.join(member, distinct["fp"] == member["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = cut(named)
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(names, "component").select("fp", "component_id")
    return marked.join(named, "fp", "left").select("doc_id", "fp", "component_id")
