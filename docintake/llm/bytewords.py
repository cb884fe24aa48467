"""Words of Arrow text columns, found and hashed with numpy over the UTF-8 bytes.

Texts are taken in blocks of about ``BLOCK`` bytes. A longer text is cut at word
boundaries; each cut repeats the next ``overlap`` words, so that an n-gram that begins in
a block is complete there, and memory does not grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
_ODD = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (xor-shift and multiply)."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class _Powers:
    """Powers of the base and of its inverse, as far as some block needed them."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * BLOCK)
            factors = np.full(n, _ODD, np.uint64)
            factors[0] = 1
            self.up = np.cumprod(factors)
            factors[1:] = pow(_ODD, -1, 1 << 64)
            self.down = np.cumprod(factors)


_POWERS = _Powers()


def hash_spans(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[start:end]`` for every span; equal spans, equal hashes."""
    _POWERS.reach(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(values)], out=total[1:])
    length = (end - start).astype(np.uint64)
    return mix((total[end] - total[start]) * _POWERS.down[start] + length)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data, offsets


@dataclass
class Words:
    """Words of one block; positions are relative to ``data``, the block's bytes."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # row of the column
    index: np.ndarray  # number of the word in its text
    own: int  # so many words belong to the block; the rest repeat the next block's


def _ranges(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
) -> Iterator[tuple[int, int, int, int, bool]]:
    """(first row, row after the last, from, to, whether the text goes on after ``to``)."""
    n, row = len(offsets) - 1, 0
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1
        if last > row:
            yield row, last, int(offsets[row]), int(offsets[last]), False
            row = last
            continue
        at, end = int(offsets[row]), int(offsets[row + 1])
        while at < end:
            to = min(end, at + BLOCK)
            while to < end:  # not inside a word
                gap = np.flatnonzero(~is_word[data[to : min(end, to + BLOCK)]])
                if len(gap):
                    to += int(gap[0])
                    break
                to = min(end, to + BLOCK)
            yield row, row + 1, at, to, to < end
            at = to
        row += 1


def _after(data, to, end, is_word, overlap) -> int:
    """Where the ``overlap`` words that follow ``to`` end."""
    reach, size = to, 64 * (overlap + 1)
    while reach < end and overlap:
        reach = min(end, to + size)
        word = is_word[data[to:reach]]
        stops = np.flatnonzero(word[:-1] & ~word[1:])
        if len(stops) >= overlap:
            return to + int(stops[overlap - 1]) + 1
        size *= 4
    return reach


def word_blocks(
    data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray, overlap: int = 0
) -> Iterator[Words]:
    """Maximal runs of bytes of one kind, block by block.

    ``kinds`` has the kind of each of the 256 bytes; bytes of kind 0 are in no word.
    """
    kinds = kinds.astype(np.uint8)
    is_word = kinds > 0
    counted, counted_row = 0, -1
    for row, stop, at, to, goes_on in _ranges(data, offsets, is_word):
        reach = _after(data, to, int(offsets[stop]), is_word, overlap) if goes_on else to
        part = data[at:reach]
        kind = np.zeros(len(part) + 2, np.uint8)
        kind[1:-1] = kinds[part]
        turns = kind[1:] != kind[:-1]
        edges = offsets[row + 1 : stop] - at  # texts follow without a gap
        turns[edges] = True
        start = np.flatnonzero(turns[:-1] & (kind[1:-1] > 0))
        end = np.flatnonzero(turns[1:] & (kind[1:-1] > 0)) + 1
        doc = np.searchsorted(offsets[row : stop + 1] - at, start, "right") - 1 + row
        number = np.arange(len(start))
        first = np.searchsorted(doc, doc, "left") if stop - row > 1 else np.zeros(len(doc), int)
        index = number - first
        own = int(np.searchsorted(start, to - at, "left"))
        if stop - row == 1:
            counted, counted_row = (counted if counted_row == row else 0), row
            index = index + counted
            counted += own
        yield Words(part, start, end, doc, index, own)
