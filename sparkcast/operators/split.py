"""Train/test and cross-validation splits.

The temporal split keeps the first ``int(n * (1 - test_size))`` rows of an
order in which NULL keys come last, as pandas sorts them. Instead of numbering
every row (one task) or sorting the table, the key of the boundary row is
found with ``ordered.rank_boundaries`` (a few small count aggregates) and the
split is a lexicographic filter; only rows that share the boundary row's
whole key are numbered, and only if the cut falls among them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcast.operators import ordered
from sparkcast.sources.tables import KEY


def train_size(n: int, test_size: float) -> int:
    return int(n * (1 - test_size))


def _cut(df: DataFrame, test_size: float, order_cols: Sequence[str]):
    """(rows to keep, (key, place, size) of the last of them or None)."""

    def ranks(n):
        k = train_size(n, test_size)
        return [k] if 0 < k < n else []

    n, found = ordered.rank_boundaries(df, order_cols, ranks)
    return n, train_size(n, test_size), found[0] if found else None


def temporal_train_mask(df: DataFrame, test_size: float = 0.2, order_cols: Sequence[str] = KEY) -> Column:
    """Boolean column: true on the first ``int(n * (1 - test_size))`` rows.

    Never NULL. Rows that share the boundary row's key are all true; use
    ``label_split`` where keys repeat and the sizes must be exact.
    """
    n, k, edge = _cut(df, test_size, order_cols)
    if edge is None:
        return F.lit(k >= n and n > 0)
    return ordered.lex_less_equal(order_cols, edge[0])


def _with_train(df: DataFrame, test_size: float, order_cols: Sequence[str], name: str) -> DataFrame:
    n, k, edge = _cut(df, test_size, order_cols)
    if edge is None:
        return df.withColumn(name, F.lit(k >= n and n > 0))
    key, place, size = edge
    if place == size:
        return df.withColumn(name, ordered.lex_less_equal(order_cols, key))
    # the cut falls among rows of one key: order those by a hash of the row
    tied = ordered.lex_equal(order_cols, key)
    rest = df.where(~tied).withColumn(name, ordered.lex_less(order_cols, key))
    hashed = df.where(tied).withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    numbered = ordered.with_ordinal(hashed, ["_tie"]).withColumn(name, F.col(ordered.ORD) < place)
    return rest.unionByName(numbered.select(*rest.columns))


def temporal_split(
    df: DataFrame, test_size: float = 0.2, order_cols: Sequence[str] = KEY
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by position in the order ``order_cols``; every row is
    in exactly one of them, NULL keys (last) and repeated keys included."""
    labelled = _with_train(df, test_size, order_cols, "_train")
    return labelled.where("_train").drop("_train"), labelled.where("not _train").drop("_train")


def label_split(df: DataFrame, test_size: float = 0.2, order_cols: Sequence[str] = KEY) -> DataFrame:
    """W9 as one frame with ``split`` in {'train', 'test'}."""
    labelled = _with_train(df, test_size, order_cols, "_train")
    return labelled.withColumn("split", F.when(F.col("_train"), "train").otherwise("test")).drop("_train")


def random_split(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Each row's side comes from a hash of its values and the seed, so
    the parts are complements however the table is partitioned (sizes are
    approximate; rows equal in every column fall on one side)."""
    draw = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]), F.lit(1 << 20))
    train = draw >= int(test_size * (1 << 20))
    return df.where(train), df.where(~train)


def exact_random_split(
    df: DataFrame, test_size: float = 0.2, seed: int = 42, key_cols: Sequence[str] = KEY
) -> tuple[DataFrame, DataFrame]:
    """W10, exact sizes: order rows by a seeded hash of the key and cut there."""
    hashed = df.withColumn("_h", F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]))
    train, test = temporal_split(hashed, test_size, ["_h", *key_cols])
    return train.drop("_h"), test.drop("_h")


def fold_starts(n: int, n_splits: int = 5) -> tuple[int, list[int]]:
    """Block size and 0-based validation start of each fold (expanding window)."""
    block = n // (n_splits + 1)
    return block, [n - (n_splits - i) * block for i in range(n_splits)]


def time_series_folds(df: DataFrame, n_splits: int = 5, order_cols: Sequence[str] = KEY) -> DataFrame:
    """Add ``val_fold`` (1..n_splits, NULL for rows that only ever train).

    Fold i trains on every row before its block and validates on the block.
    A row with val_fold = j is in the training set of every fold > j.
    """
    def ranks(n):
        block, starts = fold_starts(n, n_splits)
        return [s + 1 for s in starts] if block > 0 else []

    n, bounds = ordered.keys_at_ranks(df, order_cols, ranks)
    if not bounds:
        return df.withColumn("val_fold", F.lit(None).cast("bigint"))
    fold = sum(
        (F.when(ordered.lex_greater_equal(order_cols, b), 1).otherwise(0) for b in bounds),
        F.lit(0),
    )
    return df.withColumn("val_fold", F.when(fold > 0, fold).cast("bigint"))
