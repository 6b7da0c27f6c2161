"""Harmonic packing of tokenized documents into fixed-length sequences.

Lengths fall into reciprocal-capacity classes C/1, C/2, C/4, ... C/C. A
document of n tokens is cut into n // C full pieces and, for the rest, one
piece for each 1 in the binary form of n % C, so that every piece is exactly
its class's size. A class's bins take a fixed number of pieces (C divided by
the class size) and are then exactly full. Each task fills its own bins from
its own rows: no shuffle, and no state beyond one open bin a class. What is
left in the open bins at the end is cut into groups of 2^i pieces, whose
lengths are powers of two, which need no padding either.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.llm.queries import register
from sparkcast.llm.shared import read_table
from sparkcast.llm.words import Hasher, Words, blocks, split_words, text_bytes

CAPACITY = 2048
#: Id after each document's own ids.
END_ID = 1
#: Words whose ids a worker remembers at once (about 60 bytes each).
REMEMBERED = 1_000_000
#: Sequences one task may number.
TASK_BITS = 36

_tokenizers: dict[str, WordTokenizer] = {}


def _plain_words(data: np.ndarray, rows: np.ndarray) -> Words:
    """Words, cut and lowered further where that changes no id.

    The tokenizer lowers letters and keeps a run of letters apart from the
    marks after it, so a final stop or comma after an ASCII letter is a word
    of its own and ASCII capitals are lowered, which leaves fewer distinct
    words to encode. A capital before a byte of a longer character stays: the
    two may compose. So do all of a block that may hold special tokens.
    """
    w = split_words(data, rows)
    if data.tobytes().find(b"<|") < 0:
        after = np.append(data[1:], np.uint8(0))
        data = data + np.uint8(32) * ((data >= 65) & (data <= 90) & (after < 0x80))
    last, prev = data[w.end - 1], data[np.maximum(w.end - 2, 0)] | np.uint8(32)
    cut_off = ((last == ord(".")) | (last == ord(","))) & (w.end - w.start > 1)
    cut_off &= (prev >= ord("a")) & (prev <= ord("z"))
    start, end = np.repeat(w.start, 1 + cut_off), np.repeat(w.end, 1 + cut_off)
    mark = (np.cumsum(1 + cut_off) - 1)[cut_off]
    start[mark] = end[mark - 1] = w.end[cut_off] - 1
    first = w.first + np.concatenate(([0], np.cumsum(cut_off)))[w.first]
    return Words(data, rows, start, end, first)


class WordTokenizer:
    """Ids of whole texts from a tokenizer that never joins across white space.

    ``word_bpe_49k`` normalises, splits and merges within runs of ink, so a
    text's ids are the ids of its words in order. Each distinct word of a
    block is encoded once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.forget()

    def forget(self):
        # known words: hashes in order with the words' numbers; by number, the
        # words' bytes and their ids
        self.hash, self.number = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.text, self.text_first = np.empty(0, np.uint8), np.zeros(1, np.int64)
        self.flat, self.first = np.empty(0, np.uint32), np.zeros(1, np.int64)

    @classmethod
    def load(cls, path: str) -> WordTokenizer:
        if path not in _tokenizers:
            _tokenizers[path] = cls(path)
        return _tokenizers[path]

    def _find(self, data, rows, h) -> np.ndarray:
        """Numbers of the words whose bytes are known, -1 for the others."""
        if not len(self.hash):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        number = np.where(self.hash[at] == h, self.number[at], -1)
        i = np.flatnonzero(number >= 0)
        size, start = (rows[1:] - rows[:-1])[i], self.text_first[number[i]]
        same = self.text_first[number[i] + 1] - start == size
        number[i[~same]] = -1
        i, size, start = i[same], size[same], start[same]
        head = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(head, size)
        apart = data[np.repeat(rows[i], size) + step] != self.text[np.repeat(start, size) + step]
        if len(i):
            number[i[np.add.reduceat(apart, head, dtype=np.int64) > 0]] = -1
        return number

    def lookup(self, words: pa.Array) -> np.ndarray:
        """Each word's number; word k has the ids ``flat[first[k]:first[k + 1]]``."""
        if len(self.first) > REMEMBERED:
            self.forget()
        data, rows = text_bytes(words)
        h = Hasher(data)(rows[:-1], rows[1:])
        number = self._find(data, rows, h)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new = words.take(pa.array(missing))
            found = [
                e.ids
                for e in self.encoder.encode_batch_fast(new.to_pylist(), add_special_tokens=False)
            ]
            number[missing] = own = len(self.first) - 1 + np.arange(len(missing))
            order = np.argsort(h[missing])
            at = np.searchsorted(self.hash, h[missing][order])
            self.hash = np.insert(self.hash, at, h[missing][order])
            self.number = np.insert(self.number, at, own[order])
            text, ends = text_bytes(new)
            self.text = np.concatenate((self.text, text))
            self.text_first = np.concatenate((self.text_first, self.text_first[-1] + ends[1:]))
            size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            ids = np.array(list(chain.from_iterable(found)), dtype=np.uint32)
            self.flat = np.concatenate((self.flat, ids))
            self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(size)))
        return number

    def encode(self, text: pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, first id of each row and the total); rows end in ``end_id``."""
        data, rows = text_bytes(text)
        w = _plain_words(data, rows)
        data, size = w.data, w.end - w.start
        ends = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(w.start - ends[:-1], size) + np.arange(ends[-1])
        coded = pa.LargeStringArray.from_buffers(
            len(w), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[at])
        ).dictionary_encode()
        word = self.lookup(coded.dictionary)
        n_ids = np.append(np.diff(self.first)[word], 1)
        first = np.append(self.first[:-1][word], 0)
        code = np.insert(coded.indices.to_numpy(), w.first[1:], len(word))
        count = n_ids[code]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        got = self.flat[
            np.minimum(
                np.repeat(first[code] - (ends - count), count) + np.arange(total),
                max(len(self.flat) - 1, 0),
            )
        ] if len(self.flat) else np.zeros(total, dtype=np.uint32)
        got[ends[code == len(word)] - 1] = end_id
        last = w.first[1:] + np.arange(1, len(rows))  # codes up to each row's end
        return got, np.concatenate(([0], ends[last - 1])) if len(rows) > 1 else np.zeros(1, np.int64)


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces, documents in order, largest first."""
    full, rest = np.divmod(lengths, capacity)
    sizes = [capacity >> i for i in range(1, capacity.bit_length())]
    has = np.stack([full > 0, *[(rest & s) > 0 for s in sizes]], axis=1)
    reps = np.where(has, 1, 0)
    reps[:, 0] = full
    size = np.broadcast_to(np.array([capacity, *sizes]), reps.shape)
    doc = np.repeat(np.arange(len(lengths)), reps.sum(axis=1))
    length = np.repeat(size.ravel(), reps.ravel())
    start = np.cumsum(length) - length
    base = np.cumsum(lengths) - lengths
    return doc, start - base[doc], length


class _Bins:
    """One task's open bin of each class."""

    def __init__(self, capacity: int, task: int):
        self.capacity, self.open = capacity, {}
        self.next = task << TASK_BITS

    def _place(self, t: pa.Table, size: int, each: int) -> pa.Table:
        """Number the rows of ``t``, ``each`` to a sequence."""
        i = np.arange(len(t))
        seq = self.next + i // each
        self.next += len(t) // each
        return t.append_column("sequence_id", pa.array(seq)).append_column(
            "offset", pa.array(i % each * size)
        )

    def add(self, pieces: pa.Table, length: np.ndarray):
        for size in np.unique(length).tolist():
            t = pieces.filter(pa.array(length == size))
            if size in self.open:
                t = pa.concat_tables([self.open[size], t])
            each = self.capacity // size
            done = len(t) // each * each
            if done:
                yield self._place(t.slice(0, done), size, each)
            # a copy, so that the block's ids are not kept alive by a few rows
            self.open[size] = t.slice(done).take(pa.array(np.arange(len(t) - done)))

    def close(self):
        for size, t in sorted(self.open.items()):
            while len(t):
                each = 1 << (len(t).bit_length() - 1)
                yield self._place(t.slice(0, each), size, each)
                t = t.slice(each)


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Returns ``id_col``, ``start`` (the document's ids before the piece),
    ``length``, ``ids`` (little-endian unsigned 32-bit ids), ``doc_tokens``
    (the closing id included), ``sequence_id`` and ``offset``. ``capacity`` is
    a power of two.

    NULL or empty text is the closing id alone. Repeated rows are packed each.
    An empty table gives an empty table. Other columns are not read. Sequence
    numbers carry the task's number, so they are unique, and a task that runs
    again makes the same rows.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    id_field = docs.schema[id_col]
    schema = T.StructType(
        [
            id_field,
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches):
        tokenizer = WordTokenizer.load(tokenizer_file)
        bins = _Bins(capacity, TaskContext.get().partitionId())
        for b in batches:
            for i, j in blocks(b.column(1), 2 << 20):
                rows = b.slice(i, j - i)
                ids, first = tokenizer.encode(rows.column(1), end_id)
                tokens = np.diff(first)
                doc, start, length = cut(tokens, capacity)
                ends = np.concatenate(([0], np.cumsum(length))) * 4
                piece_ids = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(),
                    len(doc),
                    [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))],
                )
                pieces = pa.table(
                    {
                        id_col: rows.column(0).take(pa.array(doc)),
                        "start": start,
                        "length": length,
                        "ids": piece_ids.cast(pa.binary()),
                        "doc_tokens": tokens[doc],
                    }
                )
                for t in bins.add(pieces, length):
                    yield from t.combine_chunks().to_batches()
        for t in bins.close():
            yield from t.combine_chunks().to_batches()

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def with_checksum(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@register("op7_harmonic_packing")
def op7_harmonic_packing(spark, sf_dir):
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return with_checksum(pack(docs, public_tokenizers.path("word_bpe_49k.json")))
