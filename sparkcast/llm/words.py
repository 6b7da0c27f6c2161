"""Vectorised text helpers used inside Arrow tasks.

A *word* is a maximal run of characters outside space and U+0009..U+000D.
Those separators are single ASCII bytes, so words are cut on the UTF-8 bytes
of a whole Arrow batch at once, without a per-row loop.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

_U64 = np.uint64

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    return _mixed(x.astype(_U64, copy=True))


def _mixed(x: np.ndarray) -> np.ndarray:
    """``mix64`` in place."""
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row offsets) of a string column; NULL counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    n = len(arr)
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64)[arr.offset : arr.offset + n + 1]
    data = (
        np.frombuffer(bufs[2], dtype=np.uint8)[off[0] : off[-1]]
        if n and bufs[2] is not None
        else np.empty(0, np.uint8)
    )
    return data, off - off[0]


@dataclass
class Words:
    """Words of a batch: byte ranges plus the first word index of each row."""

    data: np.ndarray
    rows: np.ndarray  # byte offset of each row, one more than rows
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # word index of each row's first word, one more than rows

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def split_words(data: np.ndarray, rows: np.ndarray) -> Words:
    """Cut every row of the batch into words."""
    ink = ~IS_SPACE[data]
    begin = ink.copy()
    begin[1:] &= ~ink[:-1]
    stop = ink.copy()
    stop[:-1] &= ~ink[1:]
    inner = rows[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begin[inner] = ink[inner]  # a row start begins a word of its own
    stop[inner - 1] = ink[inner - 1]
    start = np.flatnonzero(begin)
    end = np.flatnonzero(stop) + 1
    return Words(data, rows, start, end, np.searchsorted(start, rows))


def split_lines(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every line: one begins with each row and after each break."""
    breaks = np.flatnonzero(data == 0x0A)
    start = np.concatenate((rows[:-1], breaks + 1))
    row = np.concatenate(
        (np.arange(len(rows) - 1), np.searchsorted(rows, breaks, side="right") - 1)
    )
    order = np.lexsort((row, start))
    start, row = start[order], row[order]
    end = rows[row + 1].copy()
    same = row[1:] == row[:-1]
    end[:-1][same] = start[1:][same] - 1
    return start, end, row


#: Ranges of more bytes than this are hashed one by one with XXH3.
_LANES = 64
#: Masks that keep the first k bytes of a little-endian 64-bit load.
_HEAD = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: What a chain starts from, by the range's size.
_SIZE = mix64(np.arange(1, _LANES + 2, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15))


class Hasher:
    """64-bit hashes of byte ranges, equal for equal bytes everywhere.

    Short ranges chain the mixer over their 8-byte lanes, long ones take XXH3.
    Neither is a sum over positions, so no pattern of the bytes (such as
    Thue-Morse order) makes different ranges meet.
    """

    def __init__(self, data: np.ndarray):
        self.bytes = np.zeros(len(data) + 8, dtype=np.uint8)
        self.bytes[: len(data)] = data
        # the eight bytes from every position
        self.lanes = np.ndarray((len(data) + 1,), "<u8", buffer=self.bytes, strides=(1,))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(start):
            return np.empty(0, np.uint64)
        size = end - start
        h = combine(_SIZE[np.minimum(size, _LANES)], self.lanes[start] & _HEAD[np.minimum(size, 8)])
        at = np.flatnonzero((size > 8) & (size <= _LANES))
        done = 8
        while len(at):
            lane = self.lanes[start[at] + done] & _HEAD[np.minimum(size[at] - done, 8)]
            h[at] = combine(h[at], lane)
            done += 8
            at = at[size[at] > done]
        whole = memoryview(self.bytes)
        for i in np.flatnonzero(size > _LANES).tolist():
            h[i] = xxhash.xxh3_64_intdigest(whole[start[i] : end[i]])
        return h


def word_hashes(w: Words) -> np.ndarray:
    return Hasher(w.data)(w.start, w.end)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two hash columns."""
    x = a >> _U64(29)
    x ^= a
    x *= _U64(0xD1342543DE82EF95)
    x += b
    return _mixed(x)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n values from each position (len(h) - n + 1 of them).

    Runs of 1, 2, 4, ... values are combined from halves, and a window from
    the runs of n's binary digits. The caller drops windows that cross a row
    border.
    """
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    run, width, at, out = h, 1, 0, None
    while True:
        if n & width:
            part = run[at : at + m]
            out = part if out is None else combine(out, part)
            at += width
        if at == n:
            return out
        run = combine(run[:-width], run[width:])
        width *= 2


def gram_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Word indexes at which a window of n words fits inside its row."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    total = int(counts.sum())
    base = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return base + np.arange(total)


def blocks(arr: pa.Array, limit: int = 1 << 20):
    """Row ranges (i, j) holding about ``limit`` bytes of text, one row at least.

    Work on a block at a time: its arrays stay in the CPU's caches, and memory
    is bounded by the limit or the longest text.
    """
    lengths = pa.compute.binary_length(arr).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    i, n = 0, len(lengths)
    while i < n:
        base = ends[i] - lengths[i]
        j = max(i + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield i, j
        i = j
