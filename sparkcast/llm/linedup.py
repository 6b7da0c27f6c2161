"""Line dedup by an exact set-similarity join on word sets.

Lines with equal texts are one class. Words are ordered by rarity, and two
classes of sizes n and m with Jaccard >= t share a word among each one's
rarest n - ceil(t n) + 1 (the prefix), have sizes within a factor t, enough
words left after the shared one (position), and parity bitmaps that differ in
no more bits than their sets may. Prefix entries are dealt out by word and
filtered in groups; the classes left get their whole sets, and every pair is
verified once, in the group of its first common word.

Nothing is emitted per pair: groups return each class's number of links and
whether an earlier class is among them. Word counts come from a table of
fixed size (hashed, so rarer words may share a cell, which changes only the
order). A word of very many lines is dealt out by line instead of by word, and
its group is verified as pairs of bounded blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.llm.queries import register
from sparkcast.llm.shared import read_table, saved
from sparkcast.llm.sparse import SCHEMA, marked, sparse_rows, summed
from sparkcast.llm.words import (
    Hasher,
    Words,
    blocks,
    mix64,
    split_lines,
    split_words,
    text_bytes,
    word_hashes,
)

THRESHOLD = 0.8
#: Cells of the word-count table and of the table of lines to fetch, in bits.
COUNT_BITS, FETCH_BITS = 23, 25
#: Words of the corpus for each bucket of prefix entries.
WORDS_PER_BUCKET = 2_500_000


@dataclass(frozen=True)
class Sizes:
    """What tasks hold at once; results do not depend on it."""

    #: Count from which a word's entries are dealt out by line.
    hot: int = 1 << 20
    #: Members of a verified block.
    block: int = 2048
    #: Members of a group up to which its pairs are verified in bulk.
    bulk: int = 48


SIZES = Sizes()

_U64 = np.uint64


def _need(n, m, t):
    """Least overlap of sets of sizes n and m with Jaccard >= t."""
    return np.ceil((n + m) * t / (1 + t) - 1e-9).astype(np.int64)


def _code(count: np.ndarray) -> np.ndarray:
    """Counts in one byte: exact up to 127, then eight steps an octave."""
    big = 128 + np.floor(8 * np.log2(np.maximum(count, 128) / 128))
    return np.where(count < 128, count, np.minimum(big, 255)).astype(np.uint8)


def word_counts(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """(count codes by hashed word, words in all)."""

    def run(batches):
        total = np.zeros(1 << COUNT_BITS, np.uint32)
        for b in batches:
            for i, j in blocks(b.column(0), 1 << 19):
                data, rows = text_bytes(b.column(0).slice(i, j - i))
                h = word_hashes(split_words(data, rows)) >> _U64(64 - COUNT_BITS)
                np.add.at(total, h.astype(np.int64), np.uint32(1))
        cells = np.flatnonzero(total)
        yield from sparse_rows(cells, total[cells], COUNT_BITS)

    table = summed(
        docs.select(F.col(f"`{text_col}`")).mapInArrow(run, SCHEMA),
        COUNT_BITS,
        lambda at: np.concatenate((_code(at), np.array([at.sum()], "<i8").view(np.uint8))),
    )
    n_words = int(np.ascontiguousarray(table[:, -8:]).view("<i8").sum())
    return np.ascontiguousarray(table[:, :-8]).ravel(), n_words


@dataclass
class Lines:
    """The lines with a word of a block of texts, and the block's words."""

    words: Words
    hashes: Hasher
    row: np.ndarray
    number: np.ndarray  # within the row
    key: np.ndarray  # hash of the line
    first: np.ndarray  # words of the line: first and end
    stop: np.ndarray

    def sets(self, lines: np.ndarray, codes: np.ndarray | None = None):
        """Distinct words of some lines: (hashes, offsets).

        Within a line by (code, hash), or by hash without codes.
        """
        size = (self.stop - self.first)[lines]
        ends = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(self.first[lines] - ends[:-1], size) + np.arange(ends[-1])
        h = self.hashes(self.words.start[at], self.words.end[at])
        line = np.repeat(np.arange(len(lines), dtype=np.uint64), size)
        code = np.zeros(len(h), np.uint8) if codes is None else codes[h >> _U64(64 - COUNT_BITS)]
        # line (20 bits), code (8) and the hash's upper 36 bits in one key
        rough = line << _U64(44) | code.astype(np.uint64) << _U64(36) | h >> _U64(28)
        order = np.argsort(rough)
        rough, h2 = rough[order], h[order]
        if len(lines) >= 1 << 20 or ((rough[1:] == rough[:-1]) & (h2[1:] != h2[:-1])).any():
            order = np.lexsort((h, code, line))
            h2 = h[order]
        h, line = h2, line[order].astype(np.int64)
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
        h, line = h[new], line[new]
        return h, np.concatenate(([0], np.cumsum(np.bincount(line, minlength=len(lines)))))


def _lines(text: pa.Array) -> Lines:
    data, rows = text_bytes(text)
    start, end, row = split_lines(data, rows)
    number = np.arange(len(start)) - np.searchsorted(row, row)
    w = split_words(data, rows)
    first, stop = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    real = stop > first
    hashes = Hasher(data)
    return Lines(
        w, hashes, row[real], number[real], hashes(start[real], end[real]), first[real], stop[real]
    )


#: Words of parity bits of a long line's set; short lines send them folded to one.
_BITS, _LONG = 4, 100
_ENTRY = np.dtype(
    [
        ("word", "<u8"),
        ("line", "<u8"),
        ("prev", "<u8"),
        ("size", "<i4"),
        ("pos", "<u2"),
        ("fold", "<u8"),
        ("bits", "<u8", (_BITS,)),
    ]
)
_SHORT = np.dtype(_ENTRY.descr[:-1])


def _dealt(e: np.ndarray, deal: np.ndarray, buckets: int):
    """(entries of short lines without their bits, of long ones) by bucket, as bytes."""
    long = e["size"] > _LONG
    both = []
    for part, kind in ((~long, _SHORT), (long, _ENTRY)):
        at = np.flatnonzero(part)
        at = at[np.argsort(deal[at], kind="stable")]
        out = np.empty(len(at), kind)
        for name in kind.names:
            out[name] = e[name][at]
        both.append((out, np.searchsorted(deal[at], np.arange(buckets + 1))))
    (short, s), (long_, z) = both
    for k in range(buckets):
        if s[k + 1] > s[k] or z[k + 1] > z[k]:
            yield k, short[s[k] : s[k + 1]].tobytes(), long_[z[k] : z[k + 1]].tobytes()


class _Entries:
    """Prefix entries as columns; ``bits`` only of the long lines' ones."""

    def __init__(self, shorts: list[bytes], longs: list[bytes]):
        parts = [np.frombuffer(x, _SHORT) for x in shorts]
        long = np.concatenate([np.frombuffer(x, _ENTRY) for x in longs] or [np.empty(0, _ENTRY)])
        for name in _SHORT.names:
            setattr(self, name, np.concatenate([*[p[name] for p in parts], long[name]]))
        self.bits = long["bits"]
        n = len(self.word)
        self.bits_at = np.arange(n) - (n - len(long))

    def __len__(self) -> int:
        return len(self.word)

    def take(self, at: np.ndarray) -> _Entries:
        for name in (*_SHORT.names, "bits_at"):
            setattr(self, name, getattr(self, name)[at])
        return self


def _prefix_entries(text: pa.Array, codes: np.ndarray, t: float) -> np.ndarray:
    lines = _lines(text)
    key = lines.key
    _, one = np.unique(key, return_index=True)
    h, off = lines.sets(one, codes)
    size = np.diff(off)
    line = np.repeat(np.arange(len(one)), size)
    code = codes[h >> _U64(64 - COUNT_BITS)]
    bit = _U64(1) << (h & _U64(63))
    fold = np.bitwise_xor.reduceat(bit, off[:-1]) if len(h) else bit
    parity = np.zeros((len(one), _BITS), np.uint64)
    of_long = np.flatnonzero((size > _LONG)[line])
    cell = line[of_long] * _BITS + ((h[of_long] >> _U64(6)) & _U64(_BITS - 1)).astype(np.int64)
    np.bitwise_xor.at(parity.reshape(-1), cell, bit[of_long])
    pos = np.arange(len(h)) - off[:-1][line]
    take = pos <= (size - np.ceil(size * t - 1e-9).astype(np.int64))[line]
    take &= code > 1  # a word seen once has no partner
    prev = np.concatenate(([0], h[:-1])).astype(np.uint64)
    out = np.empty(int(take.sum()), _ENTRY)
    out["word"], out["line"] = h[take], key[one][line[take]]
    out["bits"], out["size"] = parity[line[take]], size[line[take]]
    out["fold"] = fold[line[take]]
    out["pos"] = np.minimum(pos[take], 65535)
    # the word before this one in the line's order, 0 for none
    out["prev"] = np.where(pos[take] > 0, prev[take], 0)
    return out


def prefix_entries(
    docs: DataFrame, text_col: str, codes, t: float, buckets: int, sizes: Sizes = SIZES
) -> DataFrame:
    hot_code = int(_code(np.array([sizes.hot]))[0])

    def run(batches):
        table = codes.value
        for b in batches:
            for i, j in blocks(b.column(0), 8 << 20):
                text = b.column(0).slice(i, j - i)
                parts = [
                    _prefix_entries(text.slice(p, q - p), table, t) for p, q in blocks(text)
                ]
                e = np.concatenate([*parts, np.empty(0, _ENTRY)])
                hot = table[e["word"] >> _U64(64 - COUNT_BITS)] >= hot_code
                deal = np.where(hot, mix64(e["line"]), mix64(e["word"])) % _U64(buckets)
                for k, short, long in _dealt(e, deal.astype(np.int64), buckets):
                    yield pa.RecordBatch.from_pydict(
                        {"bucket": pa.array([k], pa.int32()), "short": [short], "long": [long]}
                    )

    return docs.select(F.col(f"`{text_col}`")).mapInArrow(run, "bucket int, short binary, long binary")


def _may_link(e: _Entries, i: np.ndarray, j: np.ndarray, t: float):
    """The pairs that pass the length, position and bitmap filters.

    Entries i and j are of one word, and j's lines are no smaller.
    """
    # sharing the word before too, the pair belongs to an earlier group
    ok = (e.prev[i] != e.prev[j]) | (e.prev[i] == 0)
    ok &= e.size[i] >= t * e.size[j] - 1e-9
    i, j = i[ok], j[ok]
    n, m = e.size[i].astype(np.int64), e.size[j].astype(np.int64)
    need = _need(n, m, t)
    most = n + m - 2 * need
    ok = np.minimum(n - e.pos[i], m - e.pos[j]) >= need
    ok &= np.bitwise_count(e.fold[i] ^ e.fold[j]) <= most
    long = np.flatnonzero(ok & (n > _LONG))
    if len(long):
        apart = e.bits[e.bits_at[i[long]]] ^ e.bits[e.bits_at[j[long]]]
        ok[long] = np.bitwise_count(apart).sum(axis=1) <= most[long]
    return i[ok], j[ok]


def _alive(e: _Entries, t: float, sizes: Sizes) -> tuple[_Entries, np.ndarray]:
    """Entries with a possible partner, and their groups' sizes."""
    order = np.argsort(e.word)
    word = e.word[order]
    shared = np.zeros(len(e), dtype=bool)
    shared[1:] = word[1:] == word[:-1]
    shared[:-1] |= shared[1:]
    e = e.take(order[shared])  # words of one line alone end here
    e = e.take(np.lexsort((e.line, e.size, e.word)))
    new = np.ones(len(e), dtype=bool)
    new[1:] = (e.word[1:] != e.word[:-1]) | (e.line[1:] != e.line[:-1])
    e = e.take(np.flatnonzero(new))
    cut = np.append(np.flatnonzero(np.append(True, e.word[1:] != e.word[:-1])[: len(e)]), len(e))
    size = np.diff(cut)
    alive = np.zeros(len(e), dtype=bool)
    end = np.repeat(cut[1:], size)
    of = np.repeat(size, size)
    i = np.flatnonzero((of <= sizes.bulk) & (of > 1))
    for s in range(1, sizes.bulk):
        i = i[i + s < end[i]]
        if not len(i):
            break
        for hit in _may_link(e, i, i + s, t):
            alive[hit] = True
    for a, z in zip(cut[:-1][size > sizes.bulk], cut[1:][size > sizes.bulk]):
        if z - a > 8 * sizes.block:
            alive[a:z] = True
            continue
        for i in range(a, z, 256):  # sizes ascend: later, not much larger members
            top = min(i + 256, z)
            last = a + int(np.searchsorted(e.size[a:z], e.size[top - 1] / t + 1e-6, "right"))
            x, y = np.arange(i, top), np.arange(i, last)
            ok = (e.prev[x, None] != e.prev[y]) | (e.prev[x, None] == 0)
            ok &= e.size[x, None] >= t * e.size[y] - 1e-9
            p, q = np.nonzero(ok & (x[:, None] < y))
            for hit in _may_link(e, x[p], y[q], t):
                alive[hit] = True
    return e.take(np.flatnonzero(alive)), of[alive]


def candidates(entries: DataFrame, codes, t: float, buckets: int, sizes: Sizes = SIZES) -> DataFrame:
    """(word, line, parts): classes that may have a partner through a word."""
    hot_code = int(_code(np.array([sizes.hot]))[0])

    def out(word, line, n):
        return pa.RecordBatch.from_pydict(
            {
                "word": pa.array(word.view(np.int64)),
                "line": pa.array(line.view(np.int64)),
                "parts": pa.array(((n + sizes.block - 1) // sizes.block).astype(np.int32)),
            }
        )

    def run(batches):
        table, shorts, longs = codes.value, [], []
        for b in batches:
            shorts += [x.as_py() for x in b.column(1)]
            longs += [x.as_py() for x in b.column(2)]
        e = _Entries(shorts, longs)
        code = table[e.word >> _U64(64 - COUNT_BITS)]
        hot = code >= hot_code
        if hot.any():  # spread by line: the count bounds the group
            n = 128 * 2 ** ((code[hot].astype(np.float64) - 127) / 8)
            yield out(e.word[hot], e.line[hot], n.astype(np.int64))
            e = e.take(np.flatnonzero(~hot))
        if len(e):
            e, n = _alive(e, t, sizes)
            yield out(e.word, e.line, n)

    return (
        entries.repartition(buckets, "bucket").mapInArrow(run, "word long, line long, parts int")
    )


def fetch_sets(docs: DataFrame, text_col: str, wanted) -> DataFrame:
    """(line, words): word sets of the lines marked in the table ``wanted``."""

    def run(batches):
        marks = wanted.value
        for b in batches:
            for i, j in blocks(b.column(0)):
                lines = _lines(b.column(0).slice(i, j - i))
                key = lines.key
                _, one = np.unique(key, return_index=True)
                one = one[marked(marks, key[one] >> _U64(64 - FETCH_BITS))]
                h, off = lines.sets(one)
                if len(one):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key[one].view(np.int64)),
                            pa.LargeBinaryArray.from_buffers(
                                pa.large_binary(),
                                len(one),
                                [None, pa.py_buffer(off * 8), pa.py_buffer(h)],
                            ).cast(pa.binary()),
                        ],
                        names=["line", "words"],
                    )

    return docs.select(F.col(f"`{text_col}`")).mapInArrow(run, "line long, words binary")


def _marks(lines: DataFrame) -> np.ndarray:
    def run(batches):
        for b in batches:
            cells = np.unique(b.column(0).to_numpy().view(np.uint64) >> _U64(64 - FETCH_BITS))
            cells = cells.astype(np.int64)
            yield from sparse_rows(cells, np.ones(len(cells)), FETCH_BITS)

    return summed(
        lines.mapInArrow(run, SCHEMA), FETCH_BITS, lambda at: np.packbits(at > 0, bitorder="little")
    ).ravel()


def _order(words: np.ndarray, table: np.ndarray):
    return table[words >> _U64(64 - COUNT_BITS)], words


def _bulk_pairs(i, j, off, words, tau, table, t) -> np.ndarray:
    """Which pairs (i, j) of members link, with ``tau`` as their first common word."""
    ok = np.zeros(len(i), dtype=bool)
    size = np.diff(off)
    step = 8192
    for k in range(0, len(i), step):
        a, b, own = i[k : k + step], j[k : k + step], tau[k : k + step]
        n = np.arange(len(a))
        both, of = [], []
        for side in (a, b):
            c = size[side]
            at = np.repeat(off[:-1][side] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
            both.append(words[at])
            of.append(np.repeat(n, c))
        h, of = np.concatenate(both), np.concatenate(of)
        # pair (13 bits) and the hash's upper 51 bits in one key
        rough = of.astype(np.uint64) << _U64(51) | h >> _U64(13)
        order = np.argsort(rough)
        rough, h2 = rough[order], h[order]
        if ((rough[1:] == rough[:-1]) & (h2[1:] != h2[:-1])).any():
            order = np.lexsort((h, of))
            h2 = h[order]
        h, of = h2, of[order]
        twice = np.flatnonzero((h[1:] == h[:-1]) & (of[1:] == of[:-1]))
        h, of = h[twice], of[twice]
        overlap = np.bincount(of, minlength=len(a))
        (c, w), (c0, w0) = _order(h, table), _order(own, table)
        sooner = (c < c0[of]) | ((c == c0[of]) & (w < w0[of]))
        earlier = np.bincount(of[sooner], minlength=len(a))
        ok[k : k + step] = (overlap >= _need(size[a], size[b], t)) & (earlier == 0)
    return ok


def _matrix_pairs(off, words, tau, cut: int | None, table, t):
    """Linked pairs (i < j) of one group's members; with ``cut``, only pairs
    of one of the first ``cut`` with one of the others."""
    n, size = len(off) - 1, np.diff(off)
    line = np.repeat(np.arange(n), size)
    u, inv, count = np.unique(words, return_inverse=True, return_counts=True)
    keep = np.flatnonzero(count > 1)
    (c, w), (c0, w0) = _order(u[keep], table), _order(np.array([tau], np.uint64), table)
    sooner = (c < c0[0]) | ((c == c0[0]) & (w < w0[0]))
    overlap, earlier = np.zeros((n, n), np.int32), np.zeros((n, n), bool)
    number = np.full(len(u), -1)
    number[keep] = np.arange(len(keep))
    col = number[inv]
    strips = [slice(i, i + 256) for i in range(0, n, 256)]
    for k in range(0, len(keep), 1024):
        inside = (col >= k) & (col < k + 1024)
        m = np.zeros((n, min(1024, len(keep) - k)), np.float32)
        m[line[inside], col[inside] - k] = 1
        first = m[:, sooner[k : k + 1024]]
        for s in strips:
            overlap[s] += (m[s] @ m.T).astype(np.int32)
            if first.shape[1]:
                earlier[s] |= first[s] @ first.T > 0
    found = []
    for s in strips:
        ok = (overlap[s] >= _need(size[s, None], size[None, :], t)) & ~earlier[s]
        i, j = np.nonzero(ok)
        i = i + s.start
        ok = (i < j) & ((i < cut) & (j >= cut) if cut is not None else True)
        found.append((i[ok], j[ok]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _verify(codes, t: float, sizes: Sizes):
    """Groups (word, a, b) of members, in order: links and earlier matches by line."""

    def settle(g):
        table = codes.value
        word, a, b, line, block, first, words, off = g
        n = len(word)
        rank = np.empty(n, np.int64)  # by first occurrence
        rank[np.lexsort(first[::-1])] = np.arange(n)
        links, before = np.zeros(n, np.int64), np.zeros(n, bool)
        new = np.ones(n, dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        cut = np.append(np.flatnonzero(new), n)
        size = np.diff(cut)
        place = np.arange(n) - np.repeat(cut[:-1], size)
        of = np.repeat(size, size)

        def found(i, j):
            np.add.at(links, i, 1)
            np.add.at(links, j, 1)
            before[j[rank[i] < rank[j]]] = True
            before[i[rank[j] < rank[i]]] = True

        for s in range(1, min(int(size.max(initial=0)), sizes.bulk)):
            i = np.flatnonzero((of <= sizes.bulk) & (place + s < of))
            i = i[(line[i] != line[i + s]) & ((a[i] == b[i]) | (block[i] != block[i + s]))]
            ok = _bulk_pairs(i, i + s, off, words, word[i], table, t)
            found(i[ok], i[ok] + s)
        for p, q in zip(cut[:-1][size > sizes.bulk], cut[1:][size > sizes.bulk]):
            own = slice(off[p], off[q])
            left = int((block[p:q] == a[p]).sum()) if a[p] != b[p] else None
            i, j = _matrix_pairs(off[p : q + 1] - off[p], words[own], word[p], left, table, t)
            found(i + p, j + p)
        hit = links > 0
        key, at = np.unique(line[hit], return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(key.view(np.int64)),
                pa.array(np.bincount(at, links[hit], minlength=len(key)).astype(np.int64)),
                pa.array(np.bincount(at, before[hit], minlength=len(key)) > 0),
            ],
            names=["line", "links", "earlier"],
        )

    def run(batches):
        held = None
        for b in batches:
            held = b if held is None else pa.concat_batches([held, b])
            key = [held.column(k).to_numpy() for k in range(3)]
            edge = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]) | (key[2][1:] != key[2][:-1])
            last = np.flatnonzero(edge)
            if len(last):  # the last group may go on in the next batch
                n = int(last[-1]) + 1
                yield settle(_members(held.slice(0, n)))
                held = held.slice(n)
        if held is not None and held.num_rows:
            yield settle(_members(held))

    return run


def _members(b: pa.RecordBatch):
    word, x, y, line, block, *first = (b.column(k).to_numpy() for k in range(8))
    w = b.column(8).cast(pa.large_binary())
    off = np.frombuffer(w.buffers()[1], np.int64)[w.offset : w.offset + len(w) + 1]
    words = np.frombuffer(w.buffers()[2], np.uint8)[off[0] : off[-1]].copy().view(np.uint64)
    off = (off - off[0]) // 8
    return word.view(np.uint64), x, y, line.view(np.uint64), block, first, words, off


def _line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, line_no, line) of every line with a word; key is the text's hash."""

    def run(batches):
        for b in batches:
            for i, j in blocks(b.column(2)):
                part = b.slice(i, j - i)
                lines = _lines(part.column(2))
                row = pa.array(lines.row)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(row),
                        part.column(1).take(row),
                        pa.array(lines.number.astype(np.int32)),
                        pa.array(lines.key.view(np.int64)),
                    ],
                    names=["doc", "key", "line_no", "line"],
                )

    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc"),
        F.xxhash64(f"`{text_col}`").alias("key"),
        F.col(f"`{text_col}`"),
    ).mapInArrow(run, "doc long, key long, line_no int, line long")


def line_links(
    docs: DataFrame, text_col: str, classes: DataFrame, threshold: float, sizes: Sizes = SIZES
) -> DataFrame:
    """(line, n_links, earlier) of the classes that have links."""
    spark = docs.sparkSession
    table, n_words = word_counts(docs, text_col)
    codes = spark.sparkContext.broadcast(table)  # 2^COUNT_BITS bytes, always
    buckets = max(8, -(-n_words // WORDS_PER_BUCKET))
    entries = prefix_entries(docs, text_col, codes, threshold, buckets, sizes)
    found = saved(candidates(entries, codes, threshold, buckets, sizes).distinct(), "line-candidates")
    wanted = spark.sparkContext.broadcast(_marks(found.select("line")))  # 2^FETCH_BITS bits
    sets = (
        fetch_sets(docs, text_col, wanted)
        .groupBy("line")
        .agg(F.first("words").alias("words"))
        .join(
            classes.select(
                "line",
                F.coalesce("first.doc", F.lit(-(1 << 63))).alias("doc"),
                "first.key",
                F.col("first.line_no").cast("long").alias("line_no"),
            ),
            "line",
        )
    )
    block = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("line"), F.col("parts"))).otherwise(F.lit(0).cast("long"))
    pairs = F.when(
        F.col("parts") > 1,
        F.transform(
            F.sequence(F.lit(0).cast("long"), (F.col("parts") - 1).cast("long")),
            lambda o: F.struct(F.least(F.col("block"), o).alias("a"), F.greatest(F.col("block"), o).alias("b")),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))))
    members = (
        found.join(sets, "line")
        .withColumn("block", block)
        .select("word", "line", "block", "doc", "key", "line_no", "words", F.inline(pairs))
        .select("word", "a", "b", "line", "block", "doc", "key", "line_no", "words")
    )
    verified = (
        members.repartition(buckets, "word", "a", "b")
        .sortWithinPartitions("word", "a", "b", "block")
        .mapInArrow(_verify(codes, threshold, sizes), "line long, links long, earlier boolean")
    )
    return verified.groupBy("line").agg(
        F.sum("links").alias("n_links"), F.max("earlier").alias("earlier")
    )


def similar_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    sizes: Sizes = SIZES,
) -> DataFrame:
    """One row per line with a word: doc, key, line_no, class, links, kept.

    ``class_doc`` and ``class_line`` name the class's first line (by id, text
    hash, line number; NULL ids first); ``n_links`` is the number of other
    classes with Jaccard >= threshold on their word sets. A line is kept if no
    earlier line has its text and no earlier class links to its class.

    Lines end at ``\\n``; those without a word are no rows and always stay.
    NULL and empty texts have none. Rows equal in id and text share their
    lines' fate. An empty table gives an empty table. Other columns are not
    read.
    """
    lines = saved(_line_rows(docs, id_col, text_col), "line-rows")  # read twice below
    first = lines.groupBy("line").agg(F.min(F.struct("doc", "key", "line_no")).alias("first"))
    classes = saved(first, "line-classes")
    links = saved(line_links(docs, text_col, classes, threshold, sizes), "line-links")
    known = classes.join(links, "line", "left").select(
        "line", "first", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("earlier", F.lit(False)).alias("earlier")
    )
    here = F.struct("doc", "key", "line_no").eqNullSafe(F.col("first"))
    return lines.join(known, "line").select(
        "doc",
        "key",
        "line_no",
        F.col("first.doc").alias("class_doc"),
        F.col("first.line_no").alias("class_line"),
        "n_links",
        (here & ~F.col("earlier")).alias("kept"),
    )


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, gone: pd.Series) -> pd.Series:
    """The texts without the lines of the given numbers, in one walk each."""

    def cut(x, numbers):
        if x is None:
            return None
        numbers = set(numbers.tolist())
        return "\n".join(line for i, line in enumerate(x.split("\n")) if i not in numbers)

    return pd.Series([cut(x, n) for x, n in zip(text, gone)], dtype=object)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    sizes: Sizes = SIZES,
) -> DataFrame:
    """``docs`` without the lines that ``similar_lines`` does not keep.

    Columns are unchanged (``n_chars``, if there, is counted anew). NULL texts
    stay NULL; a text of which no line is left is empty.
    """
    gone = (
        similar_lines(docs, id_col, text_col, threshold, sizes)
        .where(~F.col("kept"))
        .groupBy("doc", "key")
        .agg(F.collect_set("line_no").alias("_gone"))
    )
    text = F.col(f"d.`{text_col}`")
    # only texts that lose lines go to Python
    left = _without(F.when(F.col("_gone").isNotNull(), text), F.col("_gone"))
    out = (
        docs.withColumn("_doc", F.col(f"`{id_col}`").cast("long"))
        .withColumn("_key", F.xxhash64(f"`{text_col}`"))
        .alias("d")
        .join(
            gone.alias("g"),
            F.col("d._doc").eqNullSafe(F.col("g.doc")) & (F.col("d._key") == F.col("g.key")),
            "left",
        )
        .withColumn("_left", F.when(F.col("_gone").isNull(), text).otherwise(left))
    )
    cols = [
        F.col("_left").alias(c)
        if c == text_col
        else F.length("_left").cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars"
        else F.col(f"d.`{c}`")
        for c in docs.columns
    ]
    return out.select(*cols)


@register("op4_line_dedup")
def op4_line_dedup(spark, sf_dir):
    rows = similar_lines(read_table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("doc").alias("doc_id"), "line_no", "class_doc", "class_line", "n_links", "kept"
    )
