"""Alignment of two tokenizers' tokens over a corpus, each distinct text once.

Documents are shuffled by their full text, with map-side counts, so a text that
a third of all documents have is one row with its multiplicity. Each distinct
text is tokenized by a byte-level BPE (A) and a sentencepiece model (B) and the
two are aligned on bytes: where both end a token they cut the text into groups,
and every A-B pair of tokens that share a byte is a link.

Links of an id pair are counted over the corpus: per text, then per task, then
by a shuffle of the pairs, each weighted by the text's multiplicity. The counts
return to the texts in two ways: pairs with at least one in ``FREQUENT`` of all
links, which are at most ``FREQUENT`` pairs, are broadcast; the others are
joined, and none of them is hot. Measures then join the documents by the
text's SHA-256, those of texts that many documents have by broadcast.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcast.llm.packing import WordTokenizer
from sparkcast.llm.queries import register
from sparkcast.llm.shared import numbered, read_table, saved
from sparkcast.llm.words import blocks, text_bytes

#: Pairs (texts) with one in so many links (documents), or more, are broadcast.
FREQUENT = 1 << 18
FREQUENT_TEXTS = 1 << 12
#: Bytes of text worked on at once.
BLOCK = 1 << 20
#: Distinct pairs a task counts before it sends what it has.
HELD_PAIRS = 1 << 20
#: Texts one task may number.
TASK_BITS = 36


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's printable stand-ins: bytes without a glyph follow U+0100 in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Table:
    """Rows of bytes, one for each id."""

    def __init__(self, rows: list[bytes]):
        self.size = np.array([len(r) for r in rows], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.size)))
        self.data = np.frombuffer(b"".join(rows), dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the ids' bytes end to end, the end of each)."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.first[ids] - (ends - size), size) + np.arange(total)
        return self.data[at], ends


class _Chunks:
    """Texts cut where no token of either tokenizer can cross.

    A space between two ASCII characters that are not white space begins a
    token in both: A's pattern lets a space only lead a match, and B has no
    piece with the space mark after another character. Each distinct chunk of
    a worker is encoded once; a chunk is kept without its leading space.
    """

    def __init__(self, data: np.ndarray, rows: np.ndarray, cut: bool):
        begin = rows[:-1]
        if cut:
            ink = (data > 0x20) & (data < 0x7F)
            at = np.flatnonzero((data[1:-1] == 0x20) & ink[:-2] & ink[2:]) + 1
            # a row's own first and last bytes have their neighbours in other rows
            row = np.searchsorted(rows, at, side="right") - 1
            at = at[(at > rows[row]) & (at + 1 < rows[row + 1])]
            start = np.sort(np.concatenate((begin, at + 1)), kind="stable")
            end = np.append(start[1:] - 1, len(data))
            ends = np.searchsorted(start, rows[1:], side="left")
            # rows are never empty here, so each row's first chunk starts with it
            end[ends - 1] = rows[1:]
        else:
            start, end = begin, rows[1:]
            ends = np.arange(1, len(rows))
        self.first = np.concatenate(([0], ends))
        size = end - start
        offset = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(start - offset[:-1], size) + np.arange(offset[-1])
        self.text = pa.LargeStringArray.from_buffers(
            len(start), pa.py_buffer(offset.astype(np.int64)), pa.py_buffer(data[at])
        ).dictionary_encode()


class _Encoder(WordTokenizer):
    """Ids of chunks, remembered by a worker; ``encode_all`` gives id lists."""

    def __init__(self, encode_all):
        self.encoder, self.encode_all = self, encode_all
        self.forget()

    def encode_batch_fast(self, texts, add_special_tokens=False):
        return [_Ids(ids) for ids in self.encode_all(texts)]

    def tokens(self, chunks: _Chunks) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, first id of each row and the total)."""
        word = self.lookup(chunks.text.dictionary)
        code = word[chunks.text.indices.to_numpy()]
        count = np.diff(self.first)[code]
        ends = np.concatenate(([0], np.cumsum(count)))
        at = np.repeat(self.first[:-1][code] - ends[:-1], count) + np.arange(ends[-1])
        ids = self.flat[at] if len(at) else np.empty(0, np.uint32)
        return ids, ends[chunks.first]


class _Ids:
    __slots__ = ("ids",)

    def __init__(self, ids):
        self.ids = ids


class Tokenizers:
    """Both tokenizers of a worker, with the bytes and decimals of their ids."""

    _loaded: dict = {}

    def __init__(self, byte_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(byte_file)
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        alphabet = _byte_alphabet()
        entries = {i: t for t, i in a.get_vocab(True).items()}
        self.a_bytes = Table(
            [
                bytes(map(alphabet.__getitem__, t)) if set(t) <= alphabet.keys() else t.encode()
                for t in (entries.get(i, "") for i in range(max(entries) + 1))
            ]
        )
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b_bytes = Table(
            [
                bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        self.size_b = len(pieces)
        self.pair_bits = (len(self.a_bytes.size) * self.size_b).bit_length()
        n = max(len(entries), len(pieces)) + 1
        self.decimals = Table([b"%d," % i for i in range(n)])
        with open(byte_file, encoding="utf-8") as f:
            model = json.load(f)
        step = model.get("pre_tokenizer") or {}
        self.cut = (
            model.get("normalizer") is None
            and step.get("type") == "ByteLevel"
            and step.get("use_regex", True)
            and not step.get("add_prefix_space")
            and not any("▁" in p.lstrip("▁") for p in pieces)
        )
        self.a = _Encoder(
            lambda texts: [
                e.ids for e in a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
            ]
        )
        self.b = _Encoder(lambda texts: b.encode(list(texts), num_threads=1))

    @classmethod
    def load(cls, *files: str) -> Tokenizers:
        if files not in cls._loaded:
            cls._loaded[files] = cls(*files)
        return cls._loaded[files]


def _same_rows(data, rows, got, ends, first) -> np.ndarray:
    """Rows whose tokens' bytes are a space and the text."""
    got_first = np.concatenate(([0], ends))[first]
    size = np.diff(rows)
    same = np.diff(got_first) == size + 1
    row = np.flatnonzero(same)
    n = size[row]
    head = np.cumsum(n) - n
    step = np.arange(int(n.sum())) - np.repeat(head, n)
    apart = data[np.repeat(rows[row], n) + step] != got[np.repeat(got_first[row] + 1, n) + step]
    if len(row):
        apart = np.add.reduceat(apart, head, dtype=np.int64) > 0  # n is never 0
        same[row[apart | (got[got_first[row]] != 0x20)]] = False
    return same


def _only(ids, first, keep) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the kept rows."""
    n = np.diff(first)
    return ids[np.repeat(keep, n)], np.concatenate(([0], np.cumsum(n[keep])))


class Aligned:
    """Alignment of the rows of a block; arrays are by row unless named otherwise."""

    def __init__(self, t: Tokenizers, text: pa.Array):
        data, rows = text_bytes(text)
        chunks = _Chunks(data, rows, t.cut)
        (a, a_first), (b, b_first) = t.a.tokens(chunks), t.b.tokens(chunks)
        whole = np.ones(len(rows) - 1, dtype=bool)
        for ids, first, table in ((a, a_first, t.a_bytes), (b, b_first, t.b_bytes)):
            whole &= _same_rows(data, rows, *table(ids), first)
        self.whole = whole
        a, a_first = _only(a, a_first, whole)
        b, b_first = _only(b, b_first, whole)
        a_end, b_end = np.cumsum(t.a_bytes.size[a]), np.cumsum(t.b_bytes.size[b])
        # every end of a token ends one link; where both end, a group ends
        n = int(a_end[-1]) + 1 if len(a_end) else 0
        ends_a, ends_b = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        ends_a[a_end] = ends_b[b_end] = True
        ends = np.flatnonzero(ends_a | ends_b)
        ends_a, ends_b = ends_a[ends], ends_b[ends]
        common = ends_a & ends_b
        link_a, link_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        group_a, group_b = link_a[common], link_b[common]  # last tokens of each group
        self.n_a, self.n_b = np.diff(a_first), np.diff(b_first)
        # links and groups up to each row's last byte, which ends one of each
        last = np.concatenate(([0], np.flatnonzero(ends_a) + 1))[a_first]
        self.n_links = np.diff(last)
        self.n_groups = np.diff(np.concatenate(([0], np.cumsum(common)))[last])
        self.groups = self._digests(t, a, b, group_a, group_b, a_first, b_first)
        row = np.repeat(np.arange(len(self.n_links)), self.n_links)
        self._pairs(a[link_a].astype(np.int64) * t.size_b + b[link_b], row, t.pair_bits)

    def _pairs(self, pair, row, bits: int):
        """Distinct pairs of each row in order, and their links."""
        key = np.sort(row << bits | pair)
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        self.pair = key[at] & ((1 << bits) - 1)
        self.links = np.diff(np.append(at, len(key)))
        self.pair_first = np.searchsorted(key[at], np.arange(len(self.n_a) + 1) << bits)

    @staticmethod
    def _digests(t, a, b, group_a, group_b, a_first, b_first) -> list[str]:
        """SHA-256 of each row's groups as ``a1,a2|b1;a3|b2,b3``."""
        n = len(a) + len(b)
        # each token's group, and the tokens of the other side before it
        step_a, step_b = (np.repeat(np.arange(len(g)), np.diff(g, prepend=-1)) for g in (group_a, group_b))
        b_until = np.concatenate(([0], group_b + 1))
        at_a = np.arange(len(a)) + b_until[step_a]
        at_b = np.arange(len(b)) + group_a[step_b] + 1
        ids = np.empty(n, dtype=np.int64)
        ids[at_a], ids[at_b] = a, b
        text, ends = t.decimals(ids)
        text = text.copy()
        text[ends[at_a[group_a]] - 1] = ord("|")
        text[ends[at_b[group_b]] - 1] = ord(";")
        ends = np.concatenate(([0], ends))[a_first + b_first].tolist()
        raw = text.tobytes()
        return [hashlib.sha256(raw[i : j - 1]).hexdigest() for i, j in zip(ends, ends[1:])]


TEXTS = (
    "digest binary, copies long, text_no long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs binary, links binary"
)


def aligned_texts(texts: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """One row a distinct text that both tokenizers keep whole.

    ``pairs`` holds a * (size of B) + b as little-endian 64-bit numbers in
    order, ``links`` their links in the text as 32-bit ones.
    """

    def run(batches):
        t = Tokenizers.load(byte_file, piece_file)
        number = TaskContext.get().partitionId() << TASK_BITS
        for batch in batches:
            for i, j in blocks(batch.column(0), BLOCK):
                part = batch.slice(i, j - i)
                x = Aligned(t, part.column(0))
                kept = part.filter(pa.array(x.whole))
                n = len(kept)
                yield pa.record_batch(
                    [
                        kept.column(1),
                        kept.column(2),
                        pa.array(np.arange(number, number + n)),
                        *(pa.array(v) for v in (x.n_a, x.n_b, x.n_groups, x.n_links)),
                        pa.array(x.groups, pa.string()),
                        _binary(x.pair.astype("<i8"), x.pair_first),
                        _binary(x.links.astype("<u4"), x.pair_first),
                    ],
                    names=[c.split()[0] for c in TEXTS.split(", ")],
                )
                number += n

    return texts.mapInArrow(run, TEXTS)


def _binary(values: np.ndarray, first: np.ndarray) -> pa.Array:
    offsets = (first * values.dtype.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]
    ).cast(pa.binary())


def _values(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, first of each row and the total) of packed rows."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data else np.empty(0, np.uint8)
    return raw.view(dtype), (off - off[0]) // np.dtype(dtype).itemsize


def _row_slices(batch: pa.RecordBatch, column: int):
    for i, j in blocks(batch.column(column), 4 * BLOCK):
        yield batch.slice(i, j - i)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, links over all documents), pre-aggregated in each task."""

    def run(batches):
        held, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for part in _row_slices(batch, 1):
                pair, first = _values(part.column(1), "<i8")
                links, _ = _values(part.column(2), "<u4")
                copies = part.column(0).to_numpy()
                links = links * np.repeat(copies, np.diff(first))
                held, at = np.unique(np.concatenate((held, pair)), return_inverse=True)
                total = np.zeros(len(held), dtype=np.int64)
                np.add.at(total, at, np.concatenate((sums, links)))
                sums = total
                if len(held) > HELD_PAIRS:
                    yield pa.record_batch([held, sums], names=["pair", "links"])
                    held, sums = held[:0], sums[:0]
        if len(held):
            yield pa.record_batch([held, sums], names=["pair", "links"])

    sent = texts.select("copies", "pairs", "links").mapInArrow(run, "pair long, links long")
    return sent.groupBy("pair").agg(F.sum("links").alias("links"))


def _text_measures(texts: DataFrame, counts: DataFrame, frequent: int) -> DataFrame:
    """(text_no, n_best, count_sum) from the corpus's pair counts."""
    spark = texts.sparkSession
    least = counts.agg(F.sum("links").alias("n")).first()["n"] or 0
    # at most ``frequent`` pairs can have one in ``frequent`` of all links
    common = F.col("links") * frequent >= F.lit(least)
    known = counts.where(common).select("pair", "links", "best").orderBy("pair").toArrow()
    known = [known.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in range(3)]
    table = spark.sparkContext.broadcast(known)

    def run(batches):
        pair_, links_, best_ = table.value
        for batch in batches:
            for part in _row_slices(batch, 1):
                pair, first = _values(part.column(1), "<i8")
                links, _ = _values(part.column(2), "<u4")
                links = links.astype(np.int64)
                row = np.repeat(np.arange(len(part)), np.diff(first))
                at = np.minimum(np.searchsorted(pair_, pair), max(len(pair_) - 1, 0))
                met = pair_[at] == pair if len(pair_) else np.zeros(len(pair), dtype=bool)
                text = part.column(0).to_numpy()
                i = at[met]
                best, count = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                np.add.at(best, row[met], links[met] * best_[i])
                np.add.at(count, row[met], links[met] * links_[i])
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate((text, text[row[~met]]))),
                        pa.array(
                            np.concatenate((np.zeros(len(part), np.int64), pair[~met])),
                            mask=np.arange(len(part) + int((~met).sum())) < len(part),
                        ),
                        pa.array(np.concatenate((best, links[~met]))),
                        pa.array(np.concatenate((count, np.zeros(int((~met).sum()), np.int64)))),
                    ],
                    names=["text_no", "pair", "best", "count"],
                )

    sent = saved(
        texts.select("text_no", "pairs", "links").mapInArrow(
            run, "text_no long, pair long, best long, count long"
        ),
        "pair-scores",
    )
    done = sent.where("pair is null").select("text_no", "best", "count")
    rest = (
        sent.where("pair is not null")
        .select("text_no", "pair", F.col("best").alias("held"))
        .join(counts.where(~common).withColumnRenamed("best", "is_best"), "pair")
        .select(
            "text_no",
            F.when(F.col("is_best"), F.col("held")).otherwise(0).alias("best"),
            (F.col("held") * F.col("links")).alias("count"),
        )
    )
    return (
        done.unionByName(rest)
        .groupBy("text_no")
        .agg(F.sum("best").alias("n_best"), F.sum("count").alias("count_sum"))
    )


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align(
    docs: DataFrame,
    byte_file: str,
    piece_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    frequent_texts: int = FREQUENT_TEXTS,
) -> tuple[DataFrame, DataFrame]:
    """(measures of every row, link counts of every id pair).

    Measures: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best`` (links whose count is their B id's highest, ties included),
    ``count_sum`` (over links) and ``groups_sha256``. Pair counts: ``a``,
    ``b``, ``links``, ``best``.

    Texts that are NULL or empty, or that one of the tokenizers does not give
    back byte for byte behind a space, have no tokens: zeros and ''. Every row
    has one row, rows equal in id or text included; each counts. Other columns
    are not read. An empty table gives empty tables.
    """
    renamed, names = numbered(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    key, text = F.col(names[id_col]), F.col(names[text_col])
    digest = F.unhex(F.sha2(text, 256))
    distinct = (
        renamed.where(text != "")
        .groupBy(text.alias("text"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("text", F.unhex(F.sha2("text", 256)).alias("digest"), "copies")
    )
    texts = saved(aligned_texts(distinct, byte_file, piece_file), "aligned-texts")
    counts = pair_counts(texts)
    size_b = Tokenizers.load(byte_file, piece_file).size_b
    b = F.col("pair") % size_b
    # a row a B id, at most the size of its vocabulary
    top = saved(counts, "pair-sums")
    highest = top.groupBy(b.alias("b")).agg(F.max("links").alias("highest"))
    counts = saved(
        top.withColumn("b", b)
        .join(F.broadcast(highest), "b")
        .select("pair", "links", (F.col("links") == F.col("highest")).alias("best")),
        "pair-counts",
    )
    measures = saved(
        texts.drop("pairs", "links").join(_text_measures(texts, counts, frequent), "text_no"),
        "text-measures",
    ).select("digest", "copies", *MEASURES, "groups_sha256")

    n = renamed.count()
    hot = measures.where(F.col("copies") * frequent_texts >= n)  # at most ``frequent_texts`` rows
    rest = measures.where(F.col("copies") * frequent_texts < n)
    rows = renamed.select(key.alias("id"), digest.alias("digest"))
    met = rows.join(F.broadcast(hot), "digest", "left")
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in MEASURES]
    filled.append(F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    settled = F.col("copies").isNotNull() | F.col("digest").isNull()
    found = met.where(settled).unionByName(
        met.where(~settled).select("id", "digest").join(rest, "digest", "left"),
        allowMissingColumns=True,
    )
    pairs = counts.select(
        F.expr(f"pair div {size_b}").alias("a"),
        b.alias("b"),
        "links",
        "best",
    )
    return found.select(F.col("id").alias(id_col), *filled), pairs


@register("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark, sf_dir):
    import public_tokenizers

    files = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align(read_table(spark, sf_dir, "documents"), *files)[0]
