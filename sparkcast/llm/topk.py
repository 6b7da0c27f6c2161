"""Exact top-k search by inner product with a pivot-distance index.

Inner products become distances by one more component: with M the largest
norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the nearest are the highest scores.

Index: pivots are chosen on a bounded sample; every vector is keyed by its
nearest pivot and its distance to it, in rings (annuli) of one width, and each
ring is cut by hash into parts of bounded size, whatever its share of the
rows. Search: queries, in blocks by nearest pivot, take rings in rounds of
growing radius. By the triangle inequality a ring at distance gap g from a
query (in distance to the ring's pivot) holds nothing nearer than g, so a
query block is finished once all its k-th distances are below the radius
reached. Rings and query blocks meet in equi-joins on (pivot, ring).

Vectors are searched by length and size class (powers of 2^10 of the largest
component, so that M fits its rows): an index for each group of many rows, and
plain blocks for all groups of few. A query longer than M is shortened to M in
the distances, which keeps its order of candidates.

Scores are whole numbers, computed exactly; the float bounds have a margin.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.llm.queries import register
from sparkcast.llm.shared import read_table, saved

SAMPLE = 2048
PIVOTS = 16
#: Rings between a pivot and the sample's farthest vector.
RINGS = 8
#: Rows aimed at in a part of a ring and in a block of queries.
PART, QUERY_BLOCK = 512, 256
#: Relative margin on distances.
SLACK = 1e-9
#: Components below it are of the first size class; each next is 2^10 times as wide.
LARGEST = 1 << 20
#: Rows of a group that is indexed, groups looked at for that, and the size
#: class up to which squares fit a double.
FEW, GROUPS, TOP_LEVEL = 4096, 256, 40
#: Scores at or beyond it have no long and raise an error if they are returned.
LIMIT = (1 << 63) - 1


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """(id, v): floor(scale * x) of each component, x and result as double.

    Rows with a NULL id, a NULL or empty vector, or a component that is NULL or
    not finite take no part.
    """

    def whole(c):
        y = c.cast("double") * scale  # from 2^53 on, every double is whole
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)

    x = F.transform(F.col(f"`{vector_col}`"), whole)
    ok = F.forall(
        F.col(f"`{vector_col}`"),
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")),
    )
    return (
        vectors.where(F.col(f"`{id_col}`").isNotNull() & (F.size(f"`{vector_col}`") > 0))
        .where(ok)
        .select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("v"))
    )


def _level():
    """Size class of a row, by its largest component."""
    top = F.array_max(F.transform("v", lambda c: F.abs(c)))
    more = F.floor((F.log2(F.greatest(top, F.lit(1.0))) - math.log2(LARGEST)) / 10).cast("int")
    return F.greatest(more + 1, F.lit(0))


def _matrix(col) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    return col.flatten().to_numpy().astype(np.float64).reshape(n, -1) if n else np.empty((0, 0))


class PivotKeys:
    """Nearest pivot, distances and rings under the extra component."""

    def __init__(self, sample: np.ndarray, top_norm2: float, pivots: int, rings: int):
        self.top = float(top_norm2)
        x = self.lift(sample)
        # farthest-first choice, starting at the vector nearest the mean
        at = [int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())]
        gap = ((x - x[at[0]]) ** 2).sum(axis=1)
        while len(at) < min(pivots, len(x)) and gap.max() > 0:
            at.append(int(gap.argmax()))
            gap = np.minimum(gap, ((x - x[at[-1]]) ** 2).sum(axis=1))
        self.pivots = x[at]
        far = self.distances(x).min(axis=1).max()
        norm = math.sqrt(self.top)
        self.width = max(float(far), 1.0, 1e-4 * norm) / rings
        # of two distances and a bound, each with a rounded square
        self.slack = 24 * math.sqrt(np.finfo(float).eps * x.shape[1]) * norm

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))
        return np.concatenate((x, more[:, None]), axis=1)

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        d2 = (
            (lifted * lifted).sum(axis=1)[:, None]
            + (self.pivots * self.pivots).sum(axis=1)
            - 2 * lifted @ self.pivots.T
        )
        return np.sqrt(np.maximum(d2, 0))

    def keyed(self, query: bool):
        def run(batches):
            for b in batches:
                x = _matrix(b.column(1))
                if not len(x):
                    continue
                if query:
                    norm2 = (x * x).sum(axis=1)
                    by = np.sqrt(np.minimum(1, self.top / np.maximum(norm2, 1)))
                    x = x * by[:, None]
                d = self.distances(self.lift(x, query))
                near = d.argmin(axis=1)
                cols = [b.column(0), b.column(1), pa.array(near.astype(np.int32))]
                ring = np.floor(d[np.arange(len(x)), near] / self.width).astype(np.int32)
                cols.append(pa.array(ring))
                if query:
                    cols.append(pa.array(d.tolist(), type=pa.list_(pa.float64())))
                    cols += [pa.array((x * x).sum(axis=1)), pa.array(by)]
                yield pa.RecordBatch.from_arrays(
                    cols, names=["id", "v", "pivot", "ring", "d", "norm2", "by"][: len(cols)]
                )

        more = ", d array<double>, norm2 double, by double" if query else ""
        return run, f"id long, v array<double>, pivot int, ring int{more}"


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, held within +-``LIMIT``."""
    most = np.outer(np.abs(q).max(axis=1), np.abs(x).max(axis=1)) * q.shape[1]
    if most.max() < 1 << 52:
        return (q @ x.T).astype(np.int64)
    s = np.empty(most.shape, np.int64)
    rows = np.flatnonzero(np.abs(x).max(axis=1) * np.abs(q).max() * q.shape[1] < 1 << 52)
    s[:, rows] = (q @ x[rows].T).astype(np.int64)
    done = np.zeros(len(x), dtype=bool)
    done[rows] = True
    i, j = np.nonzero(~done & (most < 1 << 62))
    for a in range(0, len(i), 1 << 14):
        p, r = i[a : a + (1 << 14)], j[a : a + (1 << 14)]
        # a factor beyond long meets only zero rows here
        u, w = (np.where(np.abs(m) < 1 << 62, m, 0).astype(np.int64) for m in (q[p], x[r]))
        s[p, r] = (u * w).sum(axis=1)
    for p, r in zip(*np.nonzero(~done & (most >= 1 << 62))):
        t = sum(int(c) * int(e) for c, e in zip(q[p].tolist(), x[r].tolist()))
        s[p, r] = max(-LIMIT, min(LIMIT, t))
    return s


def _score_blocks(k: int):
    """Best k of each query over the rows of one task, merged as they come."""
    none, last = np.iinfo(np.int64).min, np.iinfo(np.int64).max

    def flush(held):
        for ids, score, found in held.values():
            q, j = np.nonzero(score > none)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[q]), pa.array(found[q, j]), pa.array(score[q, j])],
                names=["query_id", "vec_id", "score"],
            )

    def run(batches):
        held: dict = {}
        for b in batches:
            for qb, q_ids, q_v, x_ids, x_v in zip(*b.columns):
                ids = q_ids.values.to_numpy()
                x = x_ids.values.to_numpy()
                dim = len(q_v.values) // len(ids)
                qm = q_v.values.to_numpy().astype(np.float64).reshape(-1, dim)
                xm = x_v.values.to_numpy().astype(np.float64).reshape(-1, dim)
                s = _products(qm, xm)
                s[ids[:, None] == x] = none
                top = np.argsort(~s, axis=1, kind="stable")[:, :k]  # x is ascending
                s = np.take_along_axis(s, top, axis=1)
                found = np.where(s > none, x[top], last)
                key = qb.as_py()
                if key in held:
                    s = np.concatenate((held[key][1], s), axis=1)
                    found = np.concatenate((held[key][2], found), axis=1)
                    order = np.lexsort((found, ~s), axis=1)[:, :k]
                    s = np.take_along_axis(s, order, axis=1)
                    found = np.take_along_axis(found, order, axis=1)
                elif len(held) >= 256:
                    yield from flush(held)
                    held = {}
                held[key] = (ids, s, found)
        yield from flush(held)

    return run


def _counts(keyed: DataFrame, cols: list[str], each: int) -> DataFrame:
    """Parts each group is cut into; one row a (pivot, ring)."""
    return keyed.groupBy(*cols).agg(F.ceil(F.count(F.lit(1)) / each).alias("parts"))


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
    rings: int = RINGS,
    part: int = PART,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other vectors.

    Both tables have the same columns; see ``quantized`` for the rows that
    take no part. A query's candidates are the vectors of its length. Ties go
    to the smaller id. A repeated row is a candidate of its own; of repeated
    query ids the least vector asks. Rows with the query's id are no
    candidates. A returned score that no long holds is an error. Empty tables
    give an empty table.
    """
    spark = vectors.sparkSession
    x = quantized(vectors, id_col, vector_col)
    schema = "query_id long, rank int, vec_id long, score long"
    kind = [F.size("v").alias("dim"), _level().alias("level")]
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    groups = (
        x.groupBy(*kind)
        .agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("top"))
        .orderBy(F.desc("n"), "dim", "level")
        .limit(GROUPS + 1)
        .collect()
    )
    if not groups:
        return spark.createDataFrame([], schema)
    asked = quantized(queries, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    many = [
        g for i, g in enumerate(groups[:GROUPS]) if g["level"] <= TOP_LEVEL and (i == 0 or g["n"] > FEW)
    ]
    found = []
    for g in many:
        own = (F.size("v") == g["dim"]) & (_level() == g["level"])
        same = asked.where(F.size("v") == g["dim"])
        found.append(_indexed(x.where(own), same, g["top"], k, pivots, rings, part, query_block))
    if len(many) < len(groups):
        for g in many:
            x = x.where((F.size("v") != g["dim"]) | (_level() != g["level"]))
        found.append(_in_blocks(x, asked, k, part, query_block))
    best = found[0]
    if len(found) > 1:
        for f in found[1:]:
            best = best.unionByName(f)
        best = best.drop("rank").withColumn("rank", _rank()).where(F.col("rank") <= k)
    score = F.when(F.abs("score") < LIMIT, F.col("score")).otherwise(
        F.raise_error(F.lit("a score is too large for a long")).cast("long")
    )
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))


def _rank():
    return F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))


def _in_blocks(x: DataFrame, asked: DataFrame, k: int, part: int, query_block: int) -> DataFrame:
    """Best k by comparing all pairs of one length: for groups of few rows."""

    def dealt(rows, each, names):
        rows = rows.withColumn("dim", F.size("v")).checkpoint()
        cells = _counts(rows, ["dim"], each)
        block = F.pmod(F.xxhash64("id"), F.col("parts"))
        ids, v, at = names
        blocks = (
            rows.join(cells, "dim")
            .groupBy("dim", block.alias(at))
            .agg(F.array_sort(F.collect_list(F.struct("id", "v"))).alias("rows"))
            .select("dim", at, F.col("rows.id").alias(ids), F.flatten("rows.v").alias(v))
        )
        return blocks, cells.select(
            "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias(at)
        )

    q, q_cells = dealt(asked, query_block, ("q_ids", "q_v", "q_at"))
    p, p_cells = dealt(x, part, ("x_ids", "x_v", "x_at"))
    found = (
        q_cells.join(p_cells, "dim")
        .join(q, ["dim", "q_at"])
        .join(p, ["dim", "x_at"])
        .select(F.concat_ws("-", "dim", "q_at").alias("qb"), "q_ids", "q_v", "x_ids", "x_v")
        .mapInArrow(_score_blocks(k), "query_id long, vec_id long, score long")
    )
    return found.withColumn("rank", _rank()).where(F.col("rank") <= k)


def _indexed(
    x: DataFrame,
    asked: DataFrame,
    top_norm2: float,
    k: int,
    pivots: int,
    rings: int,
    part: int,
    query_block: int,
) -> DataFrame:
    """Best k among the vectors of one length and size class, by the index."""
    spark = x.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    # A bounded sample, the same whenever the table is the same.
    sample = x.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    keys = PivotKeys(np.array([r["v"] for r in sample]), top_norm2, pivots, rings)
    run, keyed_schema = keys.keyed(False)
    index = saved(x.mapInArrow(run, keyed_schema), "pivot-keys")
    cells = _counts(index, ["pivot", "ring"], part).checkpoint()
    parts = (
        # at most pivots x rings of any vector: a few hundred rows
        index.join(F.broadcast(cells), ["pivot", "ring"])
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        .groupBy("pivot", "ring", "part")
        .agg(F.array_sort(F.collect_list(F.struct("id", "v"))).alias("rows"))
        .select("pivot", "ring", "part", F.col("rows.id").alias("x_ids"), F.flatten("rows.v").alias("x_v"))
    )
    parts = saved(parts, "pivot-parts")

    run, keyed_schema = keys.keyed(True)
    asked = asked.mapInArrow(run, keyed_schema).checkpoint()
    q_cells = _counts(asked, ["pivot"], query_block)  # a row a pivot
    asked = (
        asked.join(F.broadcast(q_cells), "pivot")
        .withColumn("qb", F.col("pivot") * (1 << 40) + F.pmod(F.xxhash64("id"), F.col("parts")))
        .select("qb", "id", "v", "d", "norm2", "by")
        .checkpoint()
    )
    n_pivots = len(keys.pivots)
    q_blocks = saved(
        asked.groupBy("qb").agg(
            F.array_sort(F.collect_list(F.struct("id", "v"))).alias("rows"),
            F.array(*[F.struct(F.lit(p).alias("pivot"), F.min(F.col("d")[p]).alias("low"), F.max(F.col("d")[p]).alias("high")) for p in range(n_pivots)]).alias("span"),
        ).select("qb", F.col("rows.id").alias("q_ids"), F.flatten("rows.v").alias("q_v"), "span"),
        "pivot-queries",
    )
    ring_top = cells.agg(F.max("ring")).first()[0]
    reach = q_blocks.select(F.explode("span").alias("s")).agg(F.max("s.high")).first()[0]
    if reach is None:
        return spark.createDataFrame([], schema)

    width, slack = keys.width, keys.slack
    radius, before = width, -1.0
    end = max(float(reach), (ring_top + 1) * width) + 2 * width
    best = spark.createDataFrame([], "query_id long, vec_id long, score long")
    active = q_blocks.select("qb", F.lit(math.inf).alias("need"))
    spans = q_blocks.select("qb", F.inline("span"))
    while True:
        low = (F.col("low") - radius - slack) / width - 1
        high = (F.col("high") + radius + slack) / width + 1
        low, high = (F.floor(F.least(F.greatest(r, F.lit(0.0)), F.lit(float(ring_top)))) for r in (low, high))
        ring = F.col("ring") * F.lit(width)
        gap = F.greatest(ring - F.col("high") - slack, F.col("low") - ring - width - slack, F.lit(0.0))
        visits = (
            spans.join(active, "qb")
            .withColumn(
                "ring",
                F.explode(F.sequence(low, high).cast("array<int>")),
            )
            .where((gap >= before) & (gap < radius) & (gap <= F.col("need") * (1 + SLACK) + SLACK))
            .select("qb", "pivot", "ring")
            .join(cells, ["pivot", "ring"])
            .select("qb", "pivot", "ring", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        )
        found = (
            visits.join(q_blocks.select("qb", "q_ids", "q_v"), "qb")
            .join(parts, ["pivot", "ring", "part"])
            .select("qb", "q_ids", "q_v", "x_ids", "x_v")
            .mapInArrow(_score_blocks(k), "query_id long, vec_id long, score long")
        )
        best = (
            best.unionByName(found)
            .withColumn("rank", _rank())
            .where(F.col("rank") <= k)
            .checkpoint()
        )
        if radius >= end:
            break
        kth = best.groupBy("query_id").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
        far = F.when(
            F.col("n") == k,
            F.sqrt(F.greatest(F.col("norm2") + top_norm2 - 2 * F.col("score") * F.col("by"), F.lit(0.0))),
        ).otherwise(F.lit(math.inf))
        active = (
            asked.join(kth, asked["id"] == kth["query_id"], "left")
            .groupBy("qb")
            .agg(F.max(far).alias("need"))
            .where(F.col("need") * (1 + SLACK) + SLACK >= radius)
            .checkpoint()
        )
        if active.isEmpty():
            break
        best = best.drop("rank")
        before, radius = radius, radius * 3 if radius * 3 < end else end
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = """
WITH x AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM x AS q JOIN x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@register("op1_pivot_top_k", SQL)
def op1_pivot_top_k(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)
