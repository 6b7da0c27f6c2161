"""Stupid-backoff scores of documents under a model of the whole corpus.

Count tables of words and of word pairs are partitioned by hash and joined to
the documents' exploded pairs; the log scores are summed per document:

    score(w | v) = c(v w) / c(v)      if two or more documents have "v w"
                   alpha * c(w) / N   otherwise

and c(w) / N for a first word. Counts are over all documents.

An exploded pair travels to its second word's bucket, where both counts are
known once the bucket's rows are sorted: no pair is looked up in a table it
does not share a task with. The count of a pair's first word comes from the
word table through a join, which only pairs that need it take part in. Tasks
send pairs in packed rows, words as numbers (8 bytes a word only once a row, and
none for a frequent one) and their columns compressed byte by byte.

Words and pairs so common that they would crowd one bucket are counted ahead:
each batch names those above 1 / FREQUENT of its words, at most FREQUENT
survive (a Misra-Gries bound), and their exact counts are broadcast, a table of
bounded size. Pairs in it are scored where they stand and never travel.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcast.llm.queries import register
from sparkcast.llm.shared import read_table, saved
from sparkcast.llm.words import blocks, combine, mix64, split_words, text_bytes, word_hashes

ALPHA = 0.4
#: Most words, and most pairs, that are counted ahead and broadcast.
FREQUENT = 1 << 18
#: Words of the corpus for each task of exploded pairs, and buckets a task
#: works through one after another.
WORDS_PER_TASK, BUCKETS = 4_500_000, 12

_U64 = np.uint64
#: First word of a pair that has none.
_START = _U64(0)


def _tokens(text: pa.Array):
    """(word hashes, hash of the word before or 0, pair hashes, row) of a batch."""
    data, rows = text_bytes(text)
    w = split_words(data, rows)
    h = word_hashes(w)
    before = np.concatenate(([_START], h[:-1])).astype(np.uint64)[: len(h)]
    before[w.first[:-1][w.counts > 0]] = _START
    return h, before, combine(before, h), w.row_of()


def _cuts(batches, megabytes: int = 4):
    """The batches again, in slices of about so much text."""
    for b in batches:
        for i, j in blocks(b.column(1), megabytes << 20):
            yield b.slice(i, j - i)


def _batch_tokens(text: pa.Array):
    """``_tokens`` of a whole slice, worked out block by block."""
    parts, base = [], 0
    for i, j in blocks(text):
        *x, row = _tokens(text.slice(i, j - i))
        parts.append((*x, row + i))
    if not parts:
        none = np.empty(0, np.uint64)
        return none, none, none, np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Position of each key in a sorted table, -1 if absent."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


@dataclass
class Frequent:
    """The broadcast table: sorted words and pairs with their counts."""

    total: int
    words: np.ndarray
    word_n: np.ndarray
    pairs: np.ndarray
    pair_n: np.ndarray
    pair_shared: np.ndarray  # two or more documents have it


def frequent_items(docs: DataFrame, limit: int = FREQUENT) -> Frequent:
    """Words and pairs above 1 / ``limit`` of the corpus, with exact counts.

    ``docs`` has ``key`` (a document's hash) and ``text``. Each batch names
    its items above 1 / ``limit`` of its words; what a batch leaves out of an
    item's count is at most that, so every item above 2 / ``limit`` of the
    corpus is named by batches that hold 1 / ``limit`` of it, and no more than
    ``limit`` items can be.
    """
    spark = docs.sparkSession

    def name(batches):
        for b in _cuts(batches, 8):
            h, before, pair, _ = _batch_tokens(b.column(1))
            rows = [(2, np.zeros(1, np.uint64), np.array([len(h)]))]
            for kind, items in ((0, h), (1, pair[before != _START])):
                u, n = np.unique(items, return_counts=True)
                often = n * limit > len(h)
                rows.append((kind, u[often], n[often]))
            yield pa.RecordBatch.from_pydict(
                {
                    "kind": pa.array(np.repeat([r[0] for r in rows], [len(r[1]) for r in rows]).astype(np.int32)),
                    "item": pa.array(np.concatenate([r[1] for r in rows]).view(np.int64)),
                    "n": pa.array(np.concatenate([r[2] for r in rows]).astype(np.int64)),
                }
            )

    named = (
        docs.mapInArrow(name, "kind int, item long, n long")
        .groupBy("kind", "item")
        .agg(F.sum("n").alias("n"))
        .checkpoint()
    )
    total = named.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    often = named.where((F.col("kind") < 2) & (F.col("n") * limit > total)).select("kind", "item").toArrow()
    kind, item = often["kind"].to_numpy(), often["item"].to_numpy().astype(np.int64).view(np.uint64)
    words, pairs = np.sort(item[kind == 0]), np.sort(item[kind == 1])
    shared = spark.sparkContext.broadcast((words, pairs))

    def count(batches):
        tables = shared.value
        size = sum(map(len, tables))
        n = np.zeros(size, np.int64)
        low = np.full(size, np.iinfo(np.int64).max)
        high = np.full(size, np.iinfo(np.int64).min)
        for b in _cuts(batches):
            h, before, pair, row = _batch_tokens(b.column(1))
            key = b.column(0).to_numpy()
            for base, items, table in ((0, h, tables[0]), (len(tables[0]), pair, tables[1])):
                at = _find(table, items)
                if base or items is pair:
                    at[before == _START] = -1
                hit = np.flatnonzero(at >= 0)
                order = hit[np.argsort(at[hit], kind="stable")]
                at, doc = at[order] + base, key[row[order]]
                head = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
                if len(head):
                    own = at[head]
                    n[own] += np.diff(np.append(head, len(at)))
                    low[own] = np.minimum(low[own], np.minimum.reduceat(doc, head))
                    high[own] = np.maximum(high[own], np.maximum.reduceat(doc, head))
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (met, n[met], low[met], high[met])],
            names=["at", "n", "low", "high"],
        )

    exact = (
        docs.mapInArrow(count, "at long, n long, low long, high long")
        .groupBy("at")
        .agg(F.sum("n").alias("n"), (F.min("low") != F.max("high")).alias("shared"))
        .toArrow()
    )
    at = exact["at"].to_numpy()
    n, two = np.ones(len(words) + len(pairs)), np.zeros(len(words) + len(pairs), bool)
    n[at], two[at] = exact["n"].to_numpy(), exact["shared"].to_numpy().astype(bool)
    word_n, pair_n, pair_two = n[: len(words)], n[len(words) :], two[len(words) :]
    return Frequent(int(total), words, word_n, pairs, pair_n, pair_two)


def _sums(doc: np.ndarray, score: np.ndarray, seen: np.ndarray):
    """Per document: (key, log score, words, words scored by a pair)."""
    key, at = np.unique(doc, return_inverse=True)
    return (
        key,
        np.bincount(at, score, len(key)),
        np.bincount(at, minlength=len(key)),
        np.bincount(at, seen, len(key)).astype(np.int64),
    )


def _dense(a: np.ndarray) -> bytes:
    """The array's size and its bytes by significance, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _array(packed: pa.Buffer, dtype: str) -> np.ndarray:
    """The array that ``_dense`` packed."""
    size, dtype = int.from_bytes(packed[:8], "little"), np.dtype(dtype)
    planes = pa.decompress(packed[8:], size, codec="zstd")
    planes = np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


_PACKED = "task int, words binary, counts binary, cuts binary, befores binary, others binary, docs binary, doc binary, sums binary"
_SUM = np.dtype([("doc", "<i8"), ("score", "<f8"), ("words", "<i8"), ("seen", "<i8")])
_NO_SUMS = np.empty(0, _SUM)


def exploded_pairs(docs: DataFrame, frequent, alpha: float, tasks: int, buckets: int = BUCKETS) -> DataFrame:
    """Packed (second word, first word, document) rows by task.

    A row's entries are in order of bucket and second word: each second word
    once with its count, ``cuts`` giving the first word of each bucket. Words
    are numbers: of a frequent word, or (after those) of one in the row's
    ``others``. Second words ascend in a bucket and go as differences.
    """

    def pack(task, bucket, w, v, d, key, sums, words):
        both = np.concatenate((w, v))
        number = _find(words, both)
        others, at = np.unique(both[number < 0], return_inverse=True)
        number[number < 0] = len(words) + at
        w, v = np.split(number.astype("<u4"), 2)
        order = np.lexsort((w, bucket))
        bucket, w, v, d = bucket[order], w[order], v[order], d[order]
        new = np.ones(len(w), dtype=bool)
        new[1:] = (w[1:] != w[:-1]) | (bucket[1:] != bucket[:-1])
        head = np.flatnonzero(new)
        used, d = np.unique(d, return_inverse=True)
        return {
            "task": pa.array([task], pa.int32()),
            "words": [_dense(np.diff(w[head], prepend=np.uint32(0)))],
            "counts": [_dense(np.diff(np.append(head, len(w))).astype("<u4"))],
            "cuts": [_dense(np.searchsorted(bucket[head], np.arange(buckets + 1)).astype("<u4"))],
            "befores": [_dense(v)],
            "others": [_dense(others)],
            "docs": [key[used].tobytes()],
            "doc": [_dense(d.astype("<u2" if len(used) <= 1 << 16 else "<u4"))],
            "sums": [sums.tobytes()],
        }

    def run(batches):
        f: Frequent = frequent.value
        log_w, log_p, log_n = np.log(f.word_n), np.log(f.pair_n), np.log(max(f.total, 1))
        for b in _cuts(batches, 8):
            key = b.column(0).to_numpy()
            w, v, pair, row = _batch_tokens(b.column(1))
            w_at, p_at = _find(f.words, w), _find(f.pairs, pair)
            p_at[v == _START] = -1
            # a frequent pair's words are frequent: it is scored right here
            i = np.flatnonzero(p_at >= 0)
            seen = f.pair_shared[p_at[i]]
            score = np.where(
                seen,
                log_p[p_at[i]] - log_w[_find(f.words, v[i])],
                np.log(alpha) + log_w[w_at[i]] - log_n,
            )
            sums = np.empty(0, _SUM)
            if len(i):
                k, s, n, m = _sums(key[row[i]], score, seen)
                sums = np.empty(len(k), _SUM)
                sums["doc"], sums["score"], sums["words"], sums["seen"] = k, s, n, m
            i = np.flatnonzero(p_at < 0)
            deal = np.where(w_at[i] >= 0, mix64(pair[i]), mix64(w[i])) % _U64(tasks * buckets)
            deal = deal.astype(np.int64)
            order = np.argsort(deal // buckets, kind="stable")
            cut = np.searchsorted(deal[order] // buckets, np.arange(tasks + 1))
            for p in range(tasks):
                o = order[cut[p] : cut[p + 1]]
                at = i[o]
                if len(at) or len(sums):
                    row_ = pack(p, deal[o] % buckets, w[at], v[at], row[at], key, sums, f.words)
                    yield pa.RecordBatch.from_pydict(row_)
                    sums = _NO_SUMS

    return docs.mapInArrow(run, _PACKED)


_SCORED = "kind int, a long, b long, score double, n long, seen long"


def _scored(kind, a, b, score, n, seen):
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(a), kind, np.int32)),
            pa.array(a.view(np.int64)),
            pa.array(b.view(np.int64)),
            pa.array(score.astype(np.float64)),
            pa.array(n.astype(np.int64)),
            pa.array(seen.astype(np.int64)),
        ],
        names=["kind", "a", "b", "score", "n", "seen"],
    )


def _merged(sums: list) -> list:
    """The sums as one set, a row a document."""
    if not sums:
        return []
    doc, *parts = (np.concatenate(x) for x in zip(*sums))
    key, at = np.unique(doc, return_inverse=True)
    return [(key, *(np.bincount(at, x, len(key)) for x in parts))]


def score_buckets(packed: DataFrame, frequent, alpha: float, tasks: int, buckets: int = BUCKETS) -> DataFrame:
    """Scores of a task's buckets, in three kinds of rows.

    0: (document) sums; 1: (first word, document, n) whose count is still to
    be taken off; 2: (word, n), the count table of the other words.
    """

    def settle(rows, f: Frequent, log_n, sums):
        w_head = np.concatenate([r[0] for r in rows])
        n_head = np.concatenate([r[1] for r in rows]).astype(np.int64)
        v = np.concatenate([r[2] for r in rows])
        d = np.concatenate([r[3] for r in rows])
        word, at = np.unique(w_head, return_inverse=True)
        n_word = np.bincount(at, n_head, len(word))
        known = _find(f.words, word)
        n_word = np.where(known >= 0, f.word_n[known] if len(f.words) else 0, n_word)
        own = np.repeat(at, n_head)
        pair = combine(v, word[own])
        order = np.argsort(pair, kind="stable")
        head = np.flatnonzero(np.append(True, np.diff(pair[order]) != 0)[: len(pair)])
        size = np.diff(np.append(head, len(pair)))
        if len(head):
            two = np.minimum.reduceat(d[order], head) != np.maximum.reduceat(d[order], head)
        else:
            two = np.empty(0, bool)
        seen, n_pair = np.empty(len(pair), bool), np.empty(len(pair))
        seen[order], n_pair[order] = np.repeat(two, size), np.repeat(size, size)
        seen &= v != _START
        v_at = _find(f.words, v)
        log_v = np.where(v_at >= 0, np.log(f.word_n)[v_at] if len(f.words) else 0.0, 0.0)
        back = np.log(n_word)[own] - log_n + np.where(v == _START, 0.0, np.log(alpha))
        score = np.where(seen, np.log(n_pair) - log_v, back)
        sums.append(_sums(d, score, seen))
        ask = np.flatnonzero(seen & (v_at < 0))
        if len(ask):
            order = ask[np.lexsort((d[ask], v[ask]))]
            a, b = v[order], d[order]
            head = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            n = np.diff(np.append(head, len(a)))
            yield _scored(1, a[head], b[head], np.zeros(len(head)), n, np.zeros(len(head)))
        tell = np.flatnonzero((known < 0) & (n_word > 1))
        zero = np.zeros(len(tell))
        yield _scored(2, word[tell], zero.astype(np.int64), zero, n_word[tell], zero)

    def named(number, f: Frequent, others):
        other = number >= len(f.words)
        word = np.empty(len(number), np.uint64)
        word[~other] = f.words[number[~other]]
        word[other] = others[number[other] - len(f.words)]
        return word

    def run(batches):
        f: Frequent = frequent.value
        log_n = np.log(max(f.total, 1))
        rows, sums = [], []
        for b in batches:
            for c in range(b.num_rows):
                w, n, cuts, v, others, keys, d, ready = (
                    b.column(k)[c].as_buffer() for k in range(1, 9)  # no copies
                )
                keys, n = np.frombuffer(keys, "<i8"), _array(n, "<u4")
                d = _array(d, "<u2" if len(keys) <= 1 << 16 else "<u4")
                w, v, others = _array(w, "<u4").cumsum(dtype="<u4"), _array(v, "<u4"), _array(others, "<u8")
                cuts, ends = _array(cuts, "<u4"), np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
                rows.append((w, n, v, others, keys, d, cuts, ends))
                if ready.size:
                    x = np.frombuffer(ready, _SUM)
                    sums.append((x["doc"], x["score"], x["words"], x["seen"]))
        for k in range(buckets if rows else 0):
            parts = []
            for w, n, v, others, keys, d, cuts, ends in rows:
                a, z = cuts[k], cuts[k + 1]
                own = slice(ends[a], ends[z])
                parts.append((named(w[a:z], f, others), n[a:z], named(v[own], f, others), keys[d[own]]))
            yield from settle(parts, f, log_n, sums)
            sums[:] = _merged(sums)
        for key, score, n, seen in _merged(sums):
            yield _scored(0, key, np.zeros(len(key), np.int64), score, n, seen)

    return packed.repartitionById(tasks, "task").mapInArrow(run, _SCORED)


def backoff_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    alpha: float = ALPHA,
    frequent: int = FREQUENT,
    words_per_task: int = WORDS_PER_TASK,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_seen``, ``log_score``, ``mean_log_score``.

    ``n_seen`` words were scored by their pair, the others by the word alone.
    NULL and empty texts have no words, score 0 and a NULL mean. Rows equal in
    id and text are one document with that many times its words; each gets
    its share. Other columns are not read. An empty table gives an empty
    table.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col(f"`{id_col}`"), F.xxhash64(f"`{id_col}`", f"`{text_col}`").alias("key"), F.col(f"`{text_col}`").alias("text")
    )
    texts = keyed.select("key", "text")
    found = frequent_items(texts, frequent)
    table = spark.sparkContext.broadcast(found)
    tasks = max(12, -(-found.total // words_per_task))
    rows = saved(
        score_buckets(exploded_pairs(texts, table, alpha, tasks), table, alpha, tasks),
        "backoff-scores",
        "kind",
    )
    asked = rows.where("kind = 1").select("a", "b", "n")
    counts = rows.where("kind = 2").select("a", F.col("n").alias("count"))
    less = asked.join(counts, "a").select(
        F.col("b").alias("key"), (-F.col("n") * F.ln("count")).alias("score"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("seen")
    )
    sums = (
        rows.where("kind = 0")
        .select(F.col("a").alias("key"), "score", "n", "seen")
        .unionByName(less)
        .groupBy("key")
        .agg(F.sum("score").alias("score"), F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    )
    copies = keyed.groupBy("key", F.col(f"`{id_col}`").alias("_id")).agg(F.count(F.lit(1)).alias("copies"))
    each = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    share = lambda c: (F.coalesce(F.col(c), F.lit(0)) / F.col("copies"))
    return (
        copies.join(sums, "key", "left")
        .withColumn("_each", each)
        .select(
            F.col("_id").alias(id_col),
            share("n").cast("long").alias("n_words"),
            share("seen").cast("long").alias("n_seen"),
            share("score").alias("log_score"),
            F.try_divide(F.col("score"), F.col("n")).alias("mean_log_score"),
        )
    )


SQL = r"""
WITH w AS (
  SELECT doc_id, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS v
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents) a) b),
cw AS (SELECT w, count(*) AS n FROM w GROUP BY w),
cp AS (SELECT v, w, count(*) AS n, count(DISTINCT doc_id) AS docs FROM w WHERE v IS NOT NULL GROUP BY v, w),
t AS (SELECT ln(count(*)) AS log_n FROM w),
s AS (
  SELECT w.doc_id, coalesce(cp.docs > 1, false) AS seen,
         CASE WHEN cp.docs > 1 THEN ln(cp.n) - ln(cv.n)
              ELSE ln(cw.n) - t.log_n + CASE WHEN w.v IS NULL THEN 0 ELSE ln(0.4) END END AS score
  FROM w JOIN cw USING (w) CROSS JOIN t
  LEFT JOIN cp ON cp.v = w.v AND cp.w = w.w LEFT JOIN cw AS cv ON cv.w = w.v),
g AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (seen) AS n_seen, sum(score) AS score FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_seen, 0) AS n_seen,
       round(coalesce(score, 0::DOUBLE), 2) + 0.0::DOUBLE AS log_score
FROM documents d LEFT JOIN g USING (doc_id)
"""


@register("op10_backoff_scores", SQL)
def op10_backoff_scores(spark, sf_dir):
    scores = backoff_scores(read_table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "n_words", "n_seen", (F.round("log_score", 2) + F.lit(0.0)).alias("log_score"))
