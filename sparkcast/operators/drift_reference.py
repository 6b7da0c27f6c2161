"""Drift and quality against a stored reference.

``fit_reference`` counts the values of a reference part once: one row per
(column, distinct value), NULLs included. That table is all the drift tests and
the quality figures need of it, so it is stored with the feature version and the
reference rows are not read again: ``drift_against`` adds the cells of a current
frame to the stored counts in one aggregate, and ``monitoring_against`` is D6 with
both sides' quality from counts. Counts of two parts add up (``merge``), so a
reference grows by a new day without its old days.

Quartiles come from running counts over the sorted count table (chunks, as in
``drift``), so no task holds a column. A column without values has NULL figures
and no drift, an empty current or reference part likewise; a reference that lacks
a column asked for raises ``ValueError``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcast.functions.stats import int_float_columns
from sparkcast.operators import drift as D
from sparkcast.session import checkpoint_dir
from sparkcast.sources.store import FeatureStore

KEYS = ("kind", "column", "value", "label")


@dataclass(frozen=True)
class DriftReference:
    counts: DataFrame  # KEYS and cr; cc is 0
    numeric: list[str]
    categorical: list[str]
    quality: list[str]

    def merge(self, other: DriftReference) -> DriftReference:
        """The reference over the rows of both; their columns must be the same."""
        if (self.numeric, self.categorical, self.quality) != (other.numeric, other.categorical, other.quality):
            raise ValueError("references count different columns")
        counts = D.sum_counts(self.counts, other.counts).checkpoint(eager=True)
        return DriftReference(counts, self.numeric, self.categorical, self.quality)

    def save(self, store: FeatureStore, name: str, version: str | None = None) -> str:
        columns = {"numeric": self.numeric, "categorical": self.categorical, "quality": self.quality}
        return store.save_features(self.counts, f"{name}.reference", version, columns)


def load_reference(store: FeatureStore, name: str, version: str | None = None) -> DriftReference:
    row = store.get_feature_metadata(f"{name}.reference", version).select("metadata", "path").first()
    kept = json.loads(row["metadata"])
    return DriftReference(store.spark.read.parquet(row["path"]), kept["numeric"], kept["categorical"], kept["quality"])


def _counted(numeric: Sequence[str], quality: Sequence[str]) -> list[str]:
    return [*numeric, *[c for c in quality if c not in numeric]]


def fit_reference(
    df: DataFrame,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    quality: Sequence[str] | None = None,
) -> DriftReference:
    """Count the reference rows once. Defaults: the column roles of ``drift``,
    quality over all whole and floating columns."""
    roles = D.column_roles(df)
    numeric = list(roles[0] if numeric is None else numeric)
    categorical = list(roles[1] if categorical is None else categorical)
    quality = list(int_float_columns(df.schema) if quality is None else quality)
    checkpoint_dir(df.sparkSession)
    cells = D.value_rows(df, _counted(numeric, quality), categorical, "reference")
    return DriftReference(D.sum_counts(cells).checkpoint(eager=True), numeric, categorical, quality)


def _with_current(reference: DriftReference, current: DataFrame) -> DataFrame:
    missing = [
        c for c in _counted(reference.numeric, reference.quality) + reference.categorical if c not in current.columns
    ]
    if missing:
        raise ValueError(f"current rows lack columns of the reference: {', '.join(missing)}")
    checkpoint_dir(current.sparkSession)
    cells = D.value_rows(
        current, _counted(reference.numeric, reference.quality), reference.categorical, "current"
    )
    return D.sum_counts(reference.counts, cells).checkpoint(eager=True)


def drift_against(reference: DriftReference, current: DataFrame, threshold: float = D.DEFAULT_THRESHOLD) -> DataFrame:
    """D2 of ``current`` against the stored counts."""
    return D.column_drift_of(_with_current(reference, current), reference.numeric, reference.categorical, threshold)


def quality_from_counts(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A20 per side and column, from the counts of both sides alone."""
    of = counts.where((F.col("kind") == "numeric") & F.col("column").isin(list(columns)))
    run = D.running_counts(of.where(F.col("value").isNotNull()).select("column", "value", "cr", "cc"))
    tables = []
    for side, n, upto in (("reference", "cr", "ccr"), ("current", "cc", "ccc")):
        x, k = F.col("value"), F.col(n)
        plain = of.groupBy("column").agg(
            F.sum(k).alias("rows"),
            F.sum(F.when(x.isNull(), k).otherwise(0)).alias("missing"),
            F.sum(F.when(x.isNotNull(), k).otherwise(0)).alias("_n"),
            F.count_if(x.isNotNull() & (k > 0)).cast("bigint").alias("distinct"),
            F.sum(F.when(x == 0, k).otherwise(0)).alias("zeros"),
            F.min(F.when(k > 0, x)).alias("min"),
            F.max(F.when(k > 0, x)).alias("max"),
            F.try_divide(F.sum(k * x), F.sum(F.when(x.isNotNull(), k))).alias("mean"),
            F.min(F.when(x.isNotNull() & (k > 0), F.struct((-k).alias("k"), x.alias("v")))).alias("_top"),
        )
        # a value's rows have the places from upto - n to upto - 1
        places, picks = {}, []
        for q in (25, 50, 75):
            at = (F.col("_n") - 1) * (q / 100)
            for end, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
                picks.append(F.min(F.when((k > 0) & (F.col(upto) > place), x)).alias(f"_{end}{q}"))
            places[f"q{q}"] = F.col(f"_lo{q}") + (F.col(f"_hi{q}") - F.col(f"_lo{q}")) * (at - F.floor(at))
        spread = F.col(n) * (x - F.col("mean")) * (x - F.col("mean"))
        ranked = (
            run.join(F.broadcast(plain.select("column", "_n", "mean")), "column")  # one row per column
            .groupBy("column")
            .agg(*picks, F.sum(spread).alias("_ss"))
        )
        std = F.sqrt(F.try_divide(F.col("_ss"), F.when(F.col("_n") > 1, F.col("_n") - 1)))
        tables.append(
            plain.join(ranked, "column", "left").select(
                F.lit(side).alias("side"), "column", "rows", "missing", "distinct", "zeros", "min",
                *[v.alias(c) for c, v in places.items()], "max", "mean", std.alias("std"),
                F.col("_top.v").alias("top"), (-F.col("_top.k")).cast("bigint").alias("top_count"),
            )
        )
    return tables[0].unionByName(tables[1])


def monitoring_against(
    reference: DriftReference, current: DataFrame, threshold: float = D.DEFAULT_THRESHOLD
) -> dict:
    """D6 against the stored reference: one pass over ``current``, none over the
    reference rows. ``drift.write_monitoring_run`` writes the result."""
    counts = _with_current(reference, current)
    columns = D.column_drift_of(counts, reference.numeric, reference.categorical, threshold)
    return {
        "columns": columns,
        "dataset": D.dataset_drift(columns),
        "quality": quality_from_counts(counts, reference.quality),
    }
