"""Pairwise-complete second moments of many columns in one pass.

Every Arrow batch adds to a task's co-moment matrices with matrix products, so
the plan has no expression per pair and no count of NULLs beforehand. A task
emits one row per pair (k (k + 1) / 2, whatever it read): the number of rows
where both values are present, their means, squared deviations and co-deviation.
Rows of tasks are merged per pair by map-side combined aggregates.

Batches are shifted by a value of the column before they are multiplied, and
tasks are merged around the smallest task mean, so large offsets do not cancel
and a column that is constant has exactly no deviation.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcast.session import checkpoint_dir

MOMENTS = "i int, j int, n bigint, mx double, my double, cxx double, cyy double, cxy double"


def _matrices(x: np.ndarray):
    """(n, mx, my, cxx, cyy, cxy), k x k each, of rows x columns with NaN as NULL."""
    here = ~np.isnan(x)
    at = np.where(here.any(axis=0), x[here.argmax(axis=0), np.arange(x.shape[1])], 0.0)
    z = np.where(here, x - at, 0.0)
    m = here.astype(np.float64)
    n = m.T @ m
    some = np.maximum(n, 1.0)
    sx = z.T @ m  # [i, j]: sum of column i over rows where j is present too
    sxx = (z * z).T @ m
    cxx = np.maximum(sxx - sx * sx / some, 0.0)
    cxy = z.T @ z - sx * sx.T / some
    mean = sx / some + at[:, None]
    return n, mean, mean.T, cxx, cxx.T, cxy


def _merge(a, b):
    n = a[0] + b[0]
    some = np.maximum(n, 1.0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    # a side without rows has no mean
    both = a[0] * b[0] / some
    wb = b[0] / some
    mx = np.where(a[0] == 0, b[1], np.where(b[0] == 0, a[1], a[1] + dx * wb))
    my = np.where(a[0] == 0, b[2], np.where(b[0] == 0, a[2], a[2] + dy * wb))
    return n, mx, my, a[3] + b[3] + dx * dx * both, a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both


def _moments_of(last_only: bool):
    def task(batches):
        total = None
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns])
                part = _matrices(x)
                total = part if total is None else _merge(total, part)
        if total is None:
            return
        k = total[0].shape[0]
        i, j = (np.arange(k - 1), np.full(k - 1, k - 1)) if last_only else np.triu_indices(k)
        n, *rest = (m[i, j] for m in total)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(n.astype(np.int64))]
        names = [f.split()[0] for f in MOMENTS.split(", ")]
        yield pa.RecordBatch.from_arrays(columns + [pa.array(c) for c in rest], names=names)

    return task


def _pair_moments(df: DataFrame, columns: Sequence[str], last_only: bool) -> DataFrame:
    """(i, j, r) of the pairs that have rows; ``i`` <= ``j`` are places in ``columns``."""
    checkpoint_dir(df.sparkSession)
    cells = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    # a few numbers a task and pair, written once: the pivots below read them too
    parts = cells.mapInArrow(_moments_of(last_only), MOMENTS).where(F.col("n") > 0).checkpoint(eager=True)
    pivots = parts.groupBy("i", "j").agg(F.min("mx").alias("px"), F.min("my").alias("py"))
    n, dx, dy = F.col("n"), F.col("mx") - F.col("px"), F.col("my") - F.col("py")
    s = (
        parts.join(F.broadcast(pivots), ["i", "j"])  # a row per pair of columns
        .groupBy("i", "j")
        .agg(
            F.sum(n).alias("n"),
            F.sum(n * dx).alias("sx"),
            F.sum(n * dy).alias("sy"),
            F.sum(F.col("cxx") + n * dx * dx).alias("sxx"),
            F.sum(F.col("cyy") + n * dy * dy).alias("syy"),
            F.sum(F.col("cxy") + n * dx * dy).alias("sxy"),
        )
    )
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    vy = F.col("syy") - F.col("sy") * F.col("sy") / n
    cxy = F.col("sxy") - F.col("sx") * F.col("sy") / n
    r = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(cxy / (F.sqrt(vx) * F.sqrt(vy)))
    return s.select("i", "j", F.when((vx > 0) & (vy > 0), r).alias("r"))


def _name(columns: Sequence[str], place: str):
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col(place).cast("int") + 1)


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, col1, col2, r) for every ordered pair of ``columns`` and the diagonal;
    ``a`` and ``b`` are places. Pearson r over the rows where both are present,
    NULL where there are none or a side does not vary. NaN counts as missing."""
    k = len(columns)
    grid = df.sparkSession.range(k * k).select(
        F.floor(F.col("id") / k).cast("int").alias("a"), (F.col("id") % k).cast("int").alias("b")
    )
    grid = grid.withColumns({"i": F.least("a", "b"), "j": F.greatest("a", "b")})
    return grid.join(F.broadcast(_pair_moments(df, columns, False)), ["i", "j"], "left").select(
        "a", "b", _name(columns, "a").alias("col1"), _name(columns, "b").alias("col2"), "r"
    )


def correlations_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, r) of each column with ``target``, as ``pair_correlations``."""
    names = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("i"))
    return names.join(F.broadcast(_pair_moments(df, [*columns, target], True)), "i", "left").select(
        _name(columns, "i").alias("column"), "r"
    )
