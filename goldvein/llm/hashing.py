"""Words, word hashes and shingles of a column of texts, in numpy inside a task.

Texts are taken in blocks of a few megabytes, so the arrays of a block stay small
whatever the size of a partition.  A single text is never cut: one longer than the
target is a block of its own.  Null texts are empty texts here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column and the len + 1 offsets of its texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def blocks(column: pa.Array, target: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields (first row, bytes, offsets from 0) for runs of rows of about target bytes."""
    if not len(column):
        return
    data, at = text_buffer(column)
    row, last = 0, len(at) - 1
    while row < last:
        stop = max(row + 1, min(last, int(np.searchsorted(at, at[row] + target, side="right")) - 1))
        yield row, data[at[row] : at[stop]], at[row : stop + 1] - at[row]
        row = stop


@dataclass
class Words:
    """Words of a block: maximal runs of bytes other than space and 0x09-0x0D."""

    buffer: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words last

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The text (row of the block) of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of whole words, eight bytes at a time."""
        size = self.end - self.start
        padded = np.concatenate([self.buffer, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
        out = mix(size.astype(np.uint64) * _STEP)
        left, who = size, np.arange(len(size))
        at = self.start
        while len(who):
            chunk = eight[at]
            short = left < 8
            chunk[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            out[who] = mix(out[who] + chunk * _STEP)
            more = left > 8
            left, at, who = left[more] - 8, at[more] + 8, who[more]
        return out


def words(buffer: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    if lower:
        buffer = _LOWER[buffer]
    solid = ~_SPACE[buffer]
    inner = offsets[(offsets > 0) & (offsets < len(buffer))]
    before = np.zeros(len(buffer), dtype=bool)
    before[1:] = solid[:-1]
    before[inner] = False
    start = np.flatnonzero(solid & ~before)
    after = np.zeros(len(buffer), dtype=bool)
    after[:-1] = solid[1:]
    after[inner - 1] = False
    end = np.flatnonzero(solid & ~after) + 1
    return Words(buffer, start, end, np.searchsorted(start, offsets))


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n values in a row; entry i covers h[i : i + n]."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    m = len(h) - n + 1
    out = h[:m].copy()
    for j in range(1, n):
        out *= _STEP
        out += h[j : j + m]
    return mix(out)


def run_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Word indexes at which n words of one text begin."""
    whole = np.maximum(np.diff(first) - n + 1, 0)
    total = int(whole.sum())
    ahead = np.cumsum(whole) - whole
    return np.arange(total) + np.repeat(first[:-1] - ahead, whole)


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's n-word runs in order, and len + 1 offsets.

    A text of fewer words has one shingle, its whole sequence; one without words
    has none.
    """
    h, counts = w.hashes(), w.counts
    starts = run_starts(w.first, n)
    size = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(at[-1], np.uint64)
    long = np.repeat(counts >= n, size)
    out[long] = runs(h, n)[starts]
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        if len(short):
            acc = h[w.first[short]].copy()
            for j in range(1, k):
                acc = acc * _STEP + h[w.first[short] + j]
            out[at[short]] = mix(mix(acc) ^ mix(np.full(1, k, np.uint64)))
    return out, at
