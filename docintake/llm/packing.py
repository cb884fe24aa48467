"""Best-fit packing of token sequences.

A document is its token ids and an end id. One that is longer than the capacity is cut into
pieces of exactly the capacity, but for the first, which takes the remainder. Full pieces are
sequences of their own. The others are packed best-fit decreasing: longest first, each into
the open sequence with the least room that still holds it, found by a segment tree over the
remaining capacities in as many steps as the capacity has binary digits.

Pieces are dealt by hash over shards of about ``SHARD`` pieces, which pack on their own; what
a shard loses is a few sequences. The pieces of sequences left emptier than ``FULL`` are then
packed once more, over shards of the same size. Only lengths and checksums are shuffled.

Null counts as an empty text, one end id long. Repeated rows are pieces of their own; rows
with the same doc_id and piece are dealt by their row numbers and share no place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from docintake.llm.tokens import encode_long, fast_encoder, load
from docintake.session import cut

CAPACITY = 2048
SHARD = 20_000
FULL = 0.98
LONG = 1 << 20  # characters; longer texts are encoded in chunks, so that memory is bounded


def _encode(fast, tokenizer, text: str) -> np.ndarray:
    if fast is not None and len(text) <= LONG:
        try:
            return np.array(fast.encode(text, allowed_special="all"), "<u4")
        except ValueError:  # its regex engine gives up on white space of 10^6 characters
            pass
    return np.concatenate([np.array(ids, "<u4") for ids in encode_long(tokenizer, text)])


def _piece_batches(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast, tokenizer = fast_encoder(path), load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, piece, start, length, crc, kept = [], [], [], [], [], []
                for row, text in enumerate(part.column("text")):
                    ids = np.append(_encode(fast, tokenizer, text.as_py()), np.uint32(end_id))
                    ids = ids.astype("<u4")
                    first = len(ids) % capacity or capacity
                    bounds = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        rows.append(row)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        raw = ids[a:b].tobytes()
                        crc.append(zlib.crc32(raw))
                        if keep_ids:
                            kept.append(raw)
                columns = [
                    part.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    keep_ids: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of every row: doc_id, piece, start, length, ids_crc32 and, if asked for, ids
    (little-endian unsigned 32-bit numbers)."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    fields = [rows.schema["doc_id"], StructField("piece", IntegerType())]
    fields += [StructField(c, LongType()) for c in ("start", "length", "ids_crc32")]
    fields += [StructField("ids", BinaryType())] * keep_ids
    return rows.mapInArrow(_piece_batches(path, capacity, end_id, keep_ids), StructType(fields))


class OpenBins:
    """Open bins by room left, with a segment tree that knows which rooms occur."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)  # 1: a bin lies below
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        node, tree = room + self.leaves, self.tree
        while node and not tree[node]:
            tree[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, bin) of the bin with the least room of at least ``length``; it is taken out."""
        tree, node = self.tree, length + self.leaves
        while not tree[node]:  # up, to the first subtree on the right that has a bin
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node <<= 1
            node += not tree[node]
        room = node - self.leaves
        bin_ = self.bins[room].pop()
        if not self.bins[room]:
            while node and not (node < self.leaves and (tree[2 * node] or tree[2 * node + 1])):
                tree[node] = 0
                node >>= 1
        return room, bin_


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, given in descending order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, opened = OpenBins(capacity), 0
    for k, length in enumerate(lengths.tolist()):
        found = open_.take(length)
        if found is None:
            room, bin_ = capacity, opened
            opened += 1
        else:
            room, bin_ = found
        bins[k], offsets[k] = bin_, capacity - room
        if room > length:
            open_.put(room - length, bin_)
    return bins, offsets


def _pack_shard(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                 ("ids_crc32", "ascending")]
        table = table.sort_by(order)
        lengths = table.column("length").to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        for name, column in (("bin", bins), ("offset", offsets), ("filled", filled)):
            table = table.append_column(name, pa.array(column, pa.int64()))
        return table

    return run


def _sharded(rows: DataFrame, capacity: int, shard: int, kind: int) -> DataFrame:
    """``rows`` with bin, offset, filled; bins are numbered within their shard."""
    total = rows.count()
    shards = max(1, -(-total // shard))
    key = F.xxhash64("doc_id", "piece", F.monotonically_increasing_id())  # rows are materialised
    dealt = rows.withColumn("shard", F.pmod(key, F.lit(shards)).cast("long") * 4 + kind)
    fields = [*dealt.schema.fields, *(StructField(c, LongType()) for c in ("bin", "offset", "filled"))]
    return dealt.groupBy("shard").applyInArrow(_pack_shard(capacity), StructType(fields))


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``cut_pieces`` (materialised, none longer than the capacity) with sequence_id, offset."""
    narrow = cut_pieces.select("doc_id", "piece", "start", "length", "ids_crc32")
    full = narrow.where(F.col("length") == capacity).select(
        "*",
        (F.monotonically_increasing_id() * 4).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    first = cut(_sharded(narrow.where(F.col("length") < capacity), capacity, shard, 1))
    loose = F.col("filled") < int(FULL * capacity)
    again = _sharded(first.where(loose).select(*narrow.columns), capacity, shard, 2)
    numbered = [
        part.select(
            *narrow.columns,
            ((F.col("bin") * F.lit(1 << 32) + F.col("shard")).alias("sequence_id")),
            "offset",
        )
        for part in (first.where(~loose), again)
    ]
    return full.unionByName(numbered[0]).unionByName(numbered[1])


def sequences(packed: DataFrame, pieces_with_ids: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids``, the pieces' ids one after the other, for unique pieces."""
    part = F.struct("offset", "ids")
    joined = packed.select("doc_id", "piece", "sequence_id", "offset").join(
        pieces_with_ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"]
    )
    ordered = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda out, p: F.concat(out, p["ids"]))
    return ordered.select("sequence_id", ids.alias("ids"))
