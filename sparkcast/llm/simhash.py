"""SimHash near-duplicates through a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank, in which neighbours differ in
few bits, and cut into blocks. A block, and every node above it, keeps the
bits all its members share (a mask and a pattern). Two groups whose shared
patterns already differ in more than d places hold no link, so the index is
searched from the root down: pairs of nodes are joined to their children and
pruned by the differences accumulated so far; the surviving pairs of blocks
are joined to their fingerprints and the same pruning goes on inside, over
nodes of 32 neighbours, before single fingerprints are compared.

Exact copies share a fingerprint and are one entry of the index. Links inside
a block, and between the local groups of two blocks, are emitted as spanning
edges only, so a large group never makes all its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.llm.components import connected_components
from sparkcast.llm.queries import register
from sparkcast.llm.shared import numbered, read_table, restored, saved
from sparkcast.llm.words import blocks, split_words, text_bytes

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints in a block, in a node inside it, and children of upper nodes.
BLOCK, NODE, FANOUT = 16384, 32, 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def fingerprints_of(text: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """64-bit SimHash of each text; zero without words."""
    from xxhash import xxh64_intdigest

    data, rows = text_bytes(text)
    data = _LOWER[data]
    w = split_words(data, rows)
    n_rows = len(rows) - 1
    # words joined by one space each
    size = w.end - w.start
    at = np.cumsum(size + 1) - size - 1
    joined = np.full(int(size.sum()) + len(size), 0x20, dtype=np.uint8)
    step = np.arange(int(size.sum()))
    skip = np.repeat(np.cumsum(size) - size, size)
    joined[np.repeat(at, size) + step - skip] = data[np.repeat(w.start, size) + step - skip]
    joined = joined.tobytes()

    count = np.where(w.counts > 0, np.maximum(w.counts - shingle + 1, 1), 0)
    ends = np.cumsum(count)
    first = np.repeat(w.first[:-1] - (ends - count), count) + np.arange(int(count.sum()))
    last = np.minimum(first + shingle, np.repeat(w.first[1:], count)) - 1
    hashes = np.fromiter(
        (
            xxh64_intdigest(joined[a:b], seed)
            for a, b in zip(at[first].tolist(), (at[last] + size[last]).tolist())
        ),
        dtype=np.uint64,
        count=len(first),
    )
    out = np.zeros(n_rows, dtype=np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, (ends - count)[full], axis=0, dtype=np.int32)
        major = ones * 2 > count[full, None]
        out[full] = np.packbits(major, axis=1).view(">u8").ravel()
    return out


def with_fingerprint(
    docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE
) -> DataFrame:
    """The columns ``keep`` and ``_fp``, the text's SimHash as a signed long."""
    keep = docs.columns if keep is None else keep
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("_fp", T.LongType())])
    width, at = len(keep), keep.index(text_col) if text_col in keep else len(keep)

    def run(batches):
        for b in batches:
            text = b.column(at)
            found = [fingerprints_of(text.slice(i, j - i), shingle) for i, j in blocks(text)]
            fp = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(fp)], names=[*keep, "_fp"])

    cols = [F.col(f"`{c}`") for c in keep]
    if at == width:
        cols.append(F.col(f"`{text_col}`").alias("_text"))
    return docs.select(*cols).mapInArrow(run, schema)


def gray_rank(fp):
    """Position in Gray order, as a long whose signed order is that order."""
    r = fp
    for s in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, s))
    return r.bitwiseXOR(F.lit(-(1 << 63)))


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (least member) after linking i[k] with j[k]."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _nodes(fp: np.ndarray, label: np.ndarray):
    at = np.arange(0, len(fp), NODE)
    low, high = np.bitwise_and.reduceat(fp, at), np.bitwise_or.reduceat(fp, at)
    return at, low, ~(low ^ high)


def link_blocks(
    a: np.ndarray, b: np.ndarray | None, label: np.ndarray, max_bits: int, at_once: int = 512
) -> np.ndarray:
    """Labels over the members of a (then b) once all links between them are in.

    ``b`` None: links inside ``a``. Node pairs are pruned by their shared
    patterns, nearest first; a pair whose members are all one group already
    can add nothing and is skipped.
    """
    both = a if b is None else np.concatenate((a, b))
    base = 0 if b is None else len(a)
    at_a, pat_a, mask_a = _nodes(a, label)
    at_b, pat_b, mask_b = (at_a, pat_a, mask_a) if b is None else _nodes(b, label)
    apart = np.bitwise_count((pat_a[:, None] ^ pat_b) & mask_a[:, None] & mask_b)
    x, y = np.nonzero(apart <= max_bits)
    if b is None:
        x, y = x[x <= y], y[x <= y]
    order = np.argsort(apart[x, y], kind="stable")
    x, y = x[order], y[order]
    step = np.arange(NODE)
    i0, j0 = np.minimum(at_a[:, None] + step, len(a) - 1), np.minimum(
        at_b[:, None] + step, (len(a) if b is None else len(b)) - 1
    ) + base
    for k in range(0, len(x), at_once):
        i, j = i0[x[k : k + at_once]], j0[y[k : k + at_once]]
        lo = np.minimum(label[i].min(axis=1), label[j].min(axis=1))
        hi = np.maximum(label[i].max(axis=1), label[j].max(axis=1))
        i, j = i[lo != hi], j[lo != hi]
        if len(i):
            near = np.bitwise_count(both[i][:, :, None] ^ both[j][:, None, :]) <= max_bits
            p, q, r = np.nonzero(near)
            label = _merge(label, i[p, q], j[p, r])
    return label


_BLOCK_SCHEMA = "part long, idx long, low long, high long, n long, fps binary, labels binary"


def _pack(max_bits: int, block: int):
    def rows(part, idx, fp):
        label = link_blocks(fp, None, np.arange(len(fp)), max_bits)
        return pa.RecordBatch.from_pydict(
            {
                "part": [part],
                "idx": [idx],
                "low": [int(np.bitwise_and.reduce(fp).view(np.int64))],
                "high": [int(np.bitwise_or.reduce(fp).view(np.int64))],
                "n": [len(fp)],
                "fps": [fp.tobytes()],
                "labels": [label.astype("<i4").tobytes()],
            }
        )

    def run(batches):
        part, idx = TaskContext.get().partitionId(), 0
        held = np.empty(0, np.uint64)
        for b in batches:
            held = np.concatenate((held, b.column(0).to_numpy().view(np.uint64)))
            while len(held) >= block:
                yield rows(part, idx, held[:block])
                held, idx = held[block:], idx + 1
        if len(held):
            yield rows(part, idx, held)

    return run


def gray_blocks(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Blocks of distinct ``_fp`` in Gray order, numbered by ``node`` from 0."""
    n = distinct.count()
    parts = max(1, math.ceil(n / (2 * block)))
    sorted_ = (
        distinct.select("_fp", gray_rank(F.col("_fp")).alias("_rank"))
        .repartitionByRange(parts, "_rank")
        .sortWithinPartitions("_rank")
        .select("_fp")
    )
    packed = saved(sorted_.mapInArrow(_pack(max_bits, block), _BLOCK_SCHEMA), "gray-blocks")
    # one row a partition
    sizes = packed.groupBy("part").agg(F.count(F.lit(1)).alias("k"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))
    return packed.join(offsets, "part").withColumn("node", F.col("base") + F.col("idx"))


def block_pairs(blocks_: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: blocks that may hold links, by descending the index."""
    nodes = [
        blocks_.select(
            "node",
            F.floor(F.col("node") / FANOUT).alias("parent"),
            "low",
            "high",
        ).checkpoint()
    ]
    count = nodes[0].count()
    while count > 1:
        up = nodes[-1].groupBy(F.col("parent").alias("node")).agg(
            F.bit_and("low").alias("low"), F.bit_or("high").alias("high")
        )
        nodes.append(up.withColumn("parent", F.floor(F.col("node") / FANOUT)).checkpoint())
        count = math.ceil(count / FANOUT)
    pairs = nodes[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(nodes[:-1]):
        x = level.select(*[F.col(c).alias(f"x_{c}") for c in level.columns])
        y = level.select(*[F.col(c).alias(f"y_{c}") for c in level.columns])
        # bits in which all of one node differ from all of the other
        differ = (
            F.col("x_low").bitwiseXOR(F.col("y_low"))
            .bitwiseAND(F.bitwise_not(F.col("x_low").bitwiseXOR(F.col("x_high"))))
            .bitwiseAND(F.bitwise_not(F.col("y_low").bitwiseXOR(F.col("y_high"))))
        )
        pairs = (
            pairs.join(x, F.col("a") == F.col("x_parent"))
            .join(y, F.col("b") == F.col("y_parent"))
            .where((F.col("x_node") <= F.col("y_node")) & (F.bit_count(differ) <= max_bits))
            .select(F.col("x_node").alias("a"), F.col("y_node").alias("b"))
        )
    return pairs.where("a < b")


def _edges(fp: np.ndarray, label: np.ndarray, old: np.ndarray | None = None) -> pa.RecordBatch:
    k = np.flatnonzero(label != (np.arange(len(label)) if old is None else old))
    if old is not None:  # one edge for each old group
        k = np.unique(old[k])
    return pa.RecordBatch.from_arrays(
        [pa.array(fp[k].view(np.int64)), pa.array(fp[label[k]].view(np.int64))], names=["u", "v"]
    )


def _inner_edges(batches):
    for b in batches:
        for f, g in zip(b.column(0), b.column(1)):
            yield _edges(
                np.frombuffer(f.as_py(), np.uint64), np.frombuffer(g.as_py(), "<i4").astype(np.int64)
            )


def _cross_edges(max_bits: int):
    def run(batches):
        for b in batches:
            for fa, ga, fb, gb in zip(*b.columns):
                x, y = (np.frombuffer(f.as_py(), np.uint64) for f in (fa, fb))
                gx, gy = (np.frombuffer(g.as_py(), "<i4").astype(np.int64) for g in (ga, gb))
                old = np.concatenate((gx, gy + len(x)))
                yield _edges(np.concatenate((x, y)), link_blocks(x, y, old.copy(), max_bits), old)

    return run


def hamming_components(
    distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """(node, root) over distinct ``_fp``, linked at ``max_bits`` or fewer."""
    found = gray_blocks(distinct, max_bits, block)
    pairs = block_pairs(found, max_bits)
    side = lambda s: found.select(F.col("node").alias(s), F.col("fps").alias(f"f{s}"), F.col("labels").alias(f"g{s}"))
    cross = (
        pairs.join(side("a"), "a").join(side("b"), "b").select("fa", "ga", "fb", "gb")
        .mapInArrow(_cross_edges(max_bits), "u long, v long")
    )
    inner = found.select("fps", "labels").mapInArrow(_inner_edges, "u long, v long")
    return connected_components(inner.unionByName(cross))


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: id, ``fingerprint``, ``component_id``.

    NULL, empty and blank texts have fingerprint zero and link like any other.
    ``component_id`` is the least id reachable (NULL ids count for nothing, so
    a group of NULL ids alone has NULL). Repeated rows each keep their row.
    An empty table gives an empty table. Other columns are not read.
    """
    fps = with_fingerprint(docs, text_col, [id_col], shingle).checkpoint()
    return fps.join(fingerprint_groups(fps, id_col, max_bits, block), "_fp").select(
        f"`{id_col}`",
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def fingerprint_groups(
    fps: DataFrame, id_col: str, max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """(_fp, _root, component_id) of every distinct fingerprint."""
    distinct = fps.groupBy("_fp").agg(F.min(id_col).alias("_least")).checkpoint()
    roots = hamming_components(distinct.select("_fp"), max_bits, block)
    rooted = distinct.join(roots, F.col("_fp") == F.col("node"), "left").select(
        "_fp", F.coalesce("root", "_fp").alias("_root"), "_least"
    )
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return rooted.join(least, "_root").select("_fp", "_root", "component_id")


def simhash_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """``docs`` with one row of each group left: the one of the least id.

    Of repeated rows with that id one stays, the first by text. Columns are
    unchanged; texts are shuffled once.
    """
    narrow = with_fingerprint(docs, text_col, [id_col], shingle)
    groups = fingerprint_groups(narrow.checkpoint(), id_col, max_bits, block).checkpoint()
    whole, names = numbered(docs)
    rows = with_fingerprint(whole, names[text_col], None, shingle).alias("r")
    first = Window.partitionBy("_root").orderBy(names[text_col])
    # rows of the least id only, so that a large group is not ranked whole
    least = rows.join(
        groups.alias("g"),
        (F.col("r._fp") == F.col("g._fp"))
        & F.col(f"r.{names[id_col]}").eqNullSafe(F.col("g.component_id")),
    )
    return restored(least.withColumn("_n", F.row_number().over(first)).where("_n = 1"), names)


@register("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark, sf_dir):
    return simhash_components(read_table(spark, sf_dir, "documents"))
