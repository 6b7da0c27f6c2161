"""Passages that repeat across documents, by sparse suffix arrays over words.

A suffix is retained where an 8-word gram has the least hash of the 25 that
start in some window (leftmost on ties), so equal passages retain the same
places: each stretch of 50 words picks one suffix by its own content alone,
and that suffix's first 26 words lie inside the stretch.

Suffixes are dealt out by the hash of those words, sorted, and compared with
their neighbours. Those without an equal neighbour end there (on most text,
nearly all). The others are extended left by 0..24 words and right to 50 words
in all: two places belong to a repeated passage exactly if they agree on such
a stretch, so its hash is compared within the suffix's group. Matched
stretches that overlap are joined to whole passages.

Groups are settled inside tasks; a suffix with very many places (one passage
in a third of all documents) goes through a partial aggregate and a join that
Spark splits instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.llm.queries import register
from sparkcast.llm.shared import partitions, read_table, saved
from sparkcast.llm.sparse import SCHEMA, marked, sparse_rows, summed
from sparkcast.llm.words import (
    blocks,
    gram_hashes,
    gram_starts,
    split_words,
    text_bytes,
    word_hashes,
)

#: Least words of a passage, of the gram that selects, and of its window.
LEAST, GRAM, WINDOW = 50, 8, 25
#: Words of a suffix that are compared first: inside every 50-word stretch.
KEY = LEAST - WINDOW + 1
MARK_BITS = 26
#: Places of one suffix from which its group is not settled in one task.
HOT = 1 << 16

_U64 = np.uint64


def _window_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    out, have = v, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    more = width - have
    return np.minimum(out[:-more], out[more:]) if more else out


def _suffixes(text: pa.Array):
    """Retained suffixes of each row with the stretches that pick them.

    Returns (row, first stretch, place, key, offsets into stretch hashes,
    stretch hashes); places are word numbers within the row.
    """
    data, rows = text_bytes(text)
    w = split_words(data, rows)
    s = gram_starts(w.first, LEAST)
    if not len(s):
        none = np.empty(0, np.int64)
        return none, none, none, none.view(np.uint64), np.zeros(1, np.int64), none.view(np.uint64)
    h = word_hashes(w)
    grams = gram_hashes(h, GRAM)
    # the place in the low bits: least gram, then leftmost
    low = _U64((1 << 24) - 1)
    v = (grams & ~low) | (np.arange(len(grams), dtype=np.uint64) & low)
    place = (_window_min(v, WINDOW)[s] & low).astype(np.int64)
    place += (s - place) >> 24 << 24  # blocks of over 2^24 words
    place += np.where(place < s, 1 << 24, 0)
    new = np.flatnonzero(np.diff(place, prepend=-1))
    row = np.searchsorted(w.first, s[new], side="right") - 1
    base = w.first[row]
    return (
        row,
        s[new] - base,
        place[new] - base,
        gram_hashes(h, KEY)[place[new]],
        np.append(new, len(s)),
        gram_hashes(h, LEAST)[s],
    )


def suffix_marks(docs: DataFrame, text_col: str, hot: int) -> np.ndarray:
    """Bit tables of the suffix keys met twice or more, and ``hot`` times or more."""
    parts = partitions(docs)

    def scan(batches):
        for b in batches:
            keys = [
                _suffixes(b.column(0).slice(i, j - i))[3] for i, j in blocks(b.column(0))
            ]
            keys, n = np.unique(np.concatenate([*keys, np.empty(0, np.uint64)]), return_counts=True)
            deal = keys % _U64(parts)
            order = np.argsort(deal, kind="stable")
            cut = np.searchsorted(deal[order], np.arange(parts + 1))
            for p in range(parts):
                at = order[cut[p] : cut[p + 1]]
                if len(at):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array([p], pa.int32()),
                            "keys": [keys[at].tobytes()],
                            "n": [np.minimum(n[at], hot).astype("<u4").tobytes()],
                        }
                    )

    def compare(batches):
        keys, n = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for b in batches:
            for k, c in zip(b.column(1), b.column(2)):
                keys.append(np.frombuffer(k.as_py(), np.uint64))
                n.append(np.frombuffer(c.as_py(), "<u4").astype(np.int64))
        keys, n = np.concatenate(keys), np.concatenate(n)
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        total = np.add.reduceat(n, head) if len(head) else n
        again = total > 1
        cells = (keys[head][again] >> _U64(64 - MARK_BITS)).astype(np.int64)
        # a count of 2^20 marks a hot cell, once a cell: rows need unique cells
        marks = np.where(total[again] >= hot, 1 << 20, 1)
        first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])[: len(cells)])
        most = np.maximum.reduceat(marks, first) if len(first) else marks
        yield from sparse_rows(cells[first], most, MARK_BITS)

    found = (
        docs.select(F.col(f"`{text_col}`"))
        .mapInArrow(scan, "part int, keys binary, n binary")
        .repartition(parts, "part")
        .mapInArrow(compare, SCHEMA)
    )

    def finish(at):
        bits = (np.packbits(x, bitorder="little") for x in (at > 0, at >= 1 << 20))
        return np.stack(list(bits))

    width = (1 << MARK_BITS) // 8
    table = summed(found, MARK_BITS, lambda at: finish(at).ravel())
    return table.reshape(len(table), 2, -1).transpose(1, 0, 2).reshape(2, width)


_PLACES = "key long, doc long, text_key long, start int, place int, hot boolean, stretches binary"


def marked_places(docs: DataFrame, id_col: str, text_col: str, marks) -> DataFrame:
    """Places of the marked suffixes with the hashes of their stretches."""

    def run(batches):
        table = marks.value
        for b in batches:
            for i, j in blocks(b.column(2)):
                part = b.slice(i, j - i)
                row, start, place, key, off, stretch = _suffixes(part.column(2))
                cell = key >> _U64(64 - MARK_BITS)
                take = np.flatnonzero(marked(table[0], cell)) if len(key) else row
                if not len(take):
                    continue
                size = np.diff(off)[take]
                ends = np.concatenate(([0], np.cumsum(size)))
                at = np.repeat(off[take] - ends[:-1], size) + np.arange(ends[-1])
                rows = pa.array(row[take])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[take].view(np.int64)),
                        part.column(0).take(rows),
                        part.column(1).take(rows),
                        pa.array(start[take].astype(np.int32)),
                        pa.array(place[take].astype(np.int32)),
                        pa.array(marked(table[1], cell[take])),
                        pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(),
                            len(take),
                            [None, pa.py_buffer(ends * 8), pa.py_buffer(stretch[at])],
                        ).cast(pa.binary()),
                    ],
                    names=["key", "doc", "text_key", "start", "place", "hot", "stretches"],
                )

    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64(f"`{text_col}`").alias("text_key"),
        F.col(f"`{text_col}`"),
    ).mapInArrow(run, _PLACES)


_STRETCHES = "doc long, text_key long, start int, stop int, first_doc long, first boolean"


def _stretch_arrays(b: pa.RecordBatch):
    doc, text, start = (b.column(k).to_numpy() for k in (1, 2, 3))
    w = b.column(6).cast(pa.large_binary())
    off = np.frombuffer(w.buffers()[1], np.int64)[w.offset : w.offset + len(w) + 1]
    h = np.frombuffer(w.buffers()[2], np.uint8)[off[0] : off[-1]].copy().view(np.uint64)
    size = np.diff(off) // 8
    of = np.repeat(np.arange(len(size)), size)
    at = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    return doc[of], text[of], at.astype(np.int64), h


def _settled(doc, text, at, h):
    """Repeated stretches of whole groups, joined where they follow one another."""
    order = np.lexsort((at, text, doc, h))
    h, doc, text, at = h[order], doc[order], text[order], at[order]
    head = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
    size = np.diff(np.append(head, len(h)))
    last = head + size - 1
    # two documents at least: rows that differ in id or text
    across = np.repeat((doc[head] != doc[last]) | (text[head] != text[last]), size)
    first = np.zeros(len(h), dtype=bool)
    first[head] = True
    # rows equal in id and text are one place
    twin = np.zeros(len(h), dtype=bool)
    twin[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]) & (text[1:] == text[:-1]) & (at[1:] == at[:-1])
    source = np.repeat(doc[head], size)
    keep = across & ~twin
    doc, text, at, source, first = doc[keep], text[keep], at[keep], source[keep], first[keep]
    order = np.lexsort((at, first, text, doc))
    doc, text, at, source, first = (x[order] for x in (doc, text, at, source, first))
    new = np.ones(len(doc), dtype=bool)
    for x in (doc, text, first, source):
        new[1:] &= x[1:] == x[:-1]
    new[1:] &= at[1:] - at[:-1] <= LEAST
    new[1:] = ~new[1:]
    i = np.flatnonzero(new)
    z = np.append(i[1:], len(doc)) - 1 if len(i) else i
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[i]),
            pa.array(text[i]),
            pa.array(at[i].astype(np.int32)),
            pa.array((at[z] + LEAST).astype(np.int32)),
            pa.array(source[i]),
            pa.array(first[i]),
        ],
        names=["doc", "text_key", "start", "stop", "first_doc", "first"],
    )


def _settle_groups(batches):
    held = None
    for b in batches:
        held = b if held is None else pa.concat_batches([held, b])
        key = held.column(0).to_numpy()
        edge = np.flatnonzero(key[1:] != key[:-1])
        if len(edge):
            yield _settled(*_stretch_arrays(held.slice(0, int(edge[-1]) + 1)))
            held = held.slice(int(edge[-1]) + 1)
    if held is not None and held.num_rows:
        yield _settled(*_stretch_arrays(held))


def _explode(batches):
    for b in batches:
        for i in range(0, b.num_rows, 2000):
            doc, text, at, h = _stretch_arrays(b.slice(i, 2000))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(text), pa.array(at.astype(np.int32)), pa.array(h.view(np.int64))],
                names=["doc", "text_key", "start", "h"],
            )


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT
) -> DataFrame:
    """One row per passage of 50 or more words that another document has too.

    ``doc``, ``text_key`` (the text's hash, which tells rows of one id apart),
    ``start`` and ``stop`` (word numbers), ``first_doc`` (the least id that has
    part of it) and ``first``: whether this is its first place. Passages that
    are first places and later ones are kept apart, so dropping those with
    ``first`` false leaves one copy of everything.

    A document that repeats only itself has no rows, nor have shorter, empty
    or NULL texts. Different texts are different documents, also under one id
    or NULL ids, which come before all others. Rows equal in id and text are
    one. An empty table gives an empty table. Other columns
    are not read.
    """
    marks = docs.sparkSession.sparkContext.broadcast(suffix_marks(docs, text_col, hot))
    places = saved(marked_places(docs, id_col, text_col, marks), "suffix-places")
    cold = (
        places.where("not hot")
        .repartition(partitions(docs), "key")
        .sortWithinPartitions("key")
        .mapInArrow(_settle_groups, _STRETCHES)
    )
    each = places.where("hot").mapInArrow(_explode, "doc long, text_key long, start int, h long")
    place = F.struct("doc", "text_key", "start")
    shared = (
        each.groupBy("h")
        .agg(F.min(place).alias("at"), F.max(F.struct("doc", "text_key")).alias("last"))
        .where("last.doc <> at.doc OR last.text_key <> at.text_key")
    )
    warm = each.distinct().join(shared, "h").select(
        "doc",
        "text_key",
        "start",
        (F.col("start") + LEAST).alias("stop"),
        F.col("at.doc").alias("first_doc"),
        (place == F.col("at")).alias("first"),
    )
    # Join overlapping stretches: one document's rows, bounded by its length.
    by = Window.partitionBy("doc", "text_key", "first").orderBy("start", "stop")
    before = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = (
        cold.unionByName(warm)
        .withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1))
        .withColumn("n", F.sum("new").over(by))
    )
    return rows.groupBy("doc", "text_key", "first", "n").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("first_doc").alias("first_doc")
    ).select(
        F.nullif("doc", F.lit(-(1 << 63))).alias("doc"),
        "text_key",
        "start",
        "stop",
        F.nullif("first_doc", F.lit(-(1 << 63))).alias("first_doc"),
        "first",
    )


@register("op5_sparse_suffix_dedup")
def op5_sparse_suffix_dedup(spark, sf_dir):
    rows = repeated_passages(read_table(spark, sf_dir, "documents"))
    return rows.select(F.col("doc").alias("doc_id"), "start", "stop", "first_doc", "first")
