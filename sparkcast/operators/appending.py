"""Features of new days from a fitted state, without the old panel (C3 on new data).

``fit_features`` builds the features of a train part and keeps what later rows
need of it:

* ``tail``: the last rows of each series, as many as the longest lag or window
  reads (30), base columns only. A series of any length gives at most that many,
  cut in each task before the shuffle (``row_number <= k``).
* ``series``: one row per series with the price statistics and the last known
  price, which is carried over NULLs.
* ``fitted``: medians for the NULL fills and global extremes, a few numbers.

``state.transform(new)`` unions the tail with the new rows, runs the same window
pass and keeps the new rows: the result equals the features of old and new rows
together, with fills, price statistics and extremes of the train part (so nothing
of later days reaches them). ``state.advance(new)`` is the state after those rows;
what was fitted stays. ``save`` and ``load`` keep a state in the feature store.

NULL prices carry across the cut, a series the state does not know has no look
back and NULL price statistics, rows with a NULL key have neither. New rows must
be later than their series' last row (without series: than the last row at all);
others raise ``ValueError``, because rows already delivered would change.
An empty new part gives no rows; an empty train part gives a state that knows
no series.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.operators import features as fe
from sparkcast.session import checkpoint_dir
from sparkcast.sources.store import FeatureStore

CARRY = "_carry"
IS_NEW = "_new"


def _is_last(tail: DataFrame, date_col: str, g: Sequence[str], base: Sequence[str]) -> DataFrame:
    """``_last`` marks the newest row of each series of the (short) tail."""
    return _numbered(tail, date_col, g, base).withColumn("_last", F.col("_rn") == 1).drop("_rn")


def _numbered(df: DataFrame, date_col: str, g: Sequence[str], base: Sequence[str]) -> DataFrame:
    order = [F.desc(c) for c in fe._order_cols(date_col, list(g), df.select(*base))]
    w = (Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w))


def last_rows(df: DataFrame, rows: int, date_col: str, g: Sequence[str]) -> DataFrame:
    """The last ``rows`` rows of each series (of everything without series)."""
    if not g:
        order = [F.desc(c) for c in fe._order_cols(date_col, [], df)]
        return df.orderBy(*order).limit(rows)
    keyed = df.where(fe._keys_present(g))
    return _numbered(keyed, date_col, g, df.columns).where(F.col("_rn") <= rows).drop("_rn")


def last_price(df: DataFrame, date_col: str, g: Sequence[str]) -> DataFrame:
    """The newest price that is not NULL, one row per series."""
    place = F.struct(*fe._order_cols(date_col, list(g), df))
    newest = F.max_by("price", F.when(F.col("price").isNotNull(), place)).cast("double").alias(CARRY)
    return (df.where(fe._keys_present(g)) if g else df).groupBy(*g).agg(newest)


@dataclass(frozen=True)
class FeatureState:
    tail: DataFrame
    series: DataFrame
    fitted: dict

    @property
    def _g(self) -> list[str]:
        return list(self.fitted["group_cols"])

    def late_rows(self, new: DataFrame) -> DataFrame:
        """New rows that are not later than the last row the state holds for them."""
        g, date = self._g, self.fitted["date_col"]
        if g:
            ends = self.tail.groupBy(*g).agg(F.max(date).alias("_end"))
            known = new.join(ends, g)
        else:
            known = new.withColumn("_end", self.tail.agg(F.max(date)).scalar()).where("_end is not null")
        return known.where(F.col(date).isNull() | (F.col(date) <= F.col("_end"))).drop("_end")

    def _check(self, new: DataFrame) -> None:
        late = self.late_rows(new).count()
        if late:
            raise ValueError(f"{late} new rows are not later than their series' last row; fit again with them")

    def transform(self, new: DataFrame) -> DataFrame:
        """C3 of the new rows: columns and order of ``create_features``."""
        self._check(new)
        f, g = self.fitted, self._g
        base = list(f["columns"])
        new = new.select(*base)
        filled = F.lit(None).cast("double")
        old = _is_last(self.tail, f["date_col"], g, base)
        if f["include_price"]:
            # the last row of a series brings the price carried over NULLs
            if g:
                old = old.join(self.series.select(*g, CARRY), g, "left")
            else:
                old = old.withColumn(CARRY, self.series.select(CARRY).scalar())
            filled = F.when(F.col("_last"), F.col(CARRY))
        parts = old.select(*base, F.lit(False).alias(IS_NEW), filled.alias(fe.FILLED_PRICE)).unionByName(
            new.select("*", F.lit(True).alias(IS_NEW), F.lit(None).cast("double").alias(fe.FILLED_PRICE))
        )
        if not f["include_price"]:
            parts = parts.drop(fe.FILLED_PRICE)
        out = fe.window_features(
            parts, f["target_col"], f["date_col"], g, f["include_lags"], f["include_rolling"],
            f["include_price"], f["lags"], f["windows"], f["stats"],
        )
        out = out.where(F.col(IS_NEW)).drop(IS_NEW)
        lit = {k: F.lit(v).cast("double") for k, v in f["scalars"].items()}
        extremes = [lit[k].alias(k) for k in lit if k.endswith(("_lo", "_hi"))]
        return fe.complete_features(
            out, new, f["date_col"], g, f["medians"], self.series, lit,
            F.struct(*extremes) if extremes else None,
            f["include_time"], f["include_price"], f["include_interactions"],
        )

    def advance(self, new: DataFrame) -> FeatureState:
        """The state after ``new``: new tail and carried prices, the fit unchanged."""
        self._check(new)
        f, g = self.fitted, self._g
        new = new.select(*f["columns"])
        checkpoint_dir(new.sparkSession)
        tail = last_rows(self.tail.unionByName(new), f["look_back"], f["date_col"], g).checkpoint(eager=True)
        series = self.series
        if f["include_price"]:
            fresh = last_price(new, f["date_col"], g).withColumnRenamed(CARRY, "_fresh")
            if g:
                series = series.join(fresh, g, "full")
            else:
                series = series.withColumn("_fresh", fresh.scalar())
            series = series.withColumn(CARRY, F.coalesce("_fresh", CARRY)).drop("_fresh").checkpoint(eager=True)
        return FeatureState(tail, series, f)

    def save(self, store: FeatureStore, name: str, version: str | None = None) -> str:
        """Two saves; the second commit names the first, so a reader that finds
        a state finds both parts of it. Returns the path of the tail."""
        path = store.save_features(self.series, f"{name}.series", version)
        return store.save_features(self.tail, f"{name}.state", version, {"fitted": self.fitted, "series": path})


def load_state(store: FeatureStore, name: str, version: str | None = None) -> FeatureState:
    """A saved state, or the newest one; a missing one raises FileNotFoundError."""
    row = store.get_feature_metadata(f"{name}.state", version).select("metadata", "path").first()
    kept = json.loads(row["metadata"])
    read = store.spark.read
    return FeatureState(read.parquet(row["path"]), read.parquet(kept["series"]), kept["fitted"])


def fit_features(
    train: DataFrame,
    target_col: str = "target_demand",
    date_col: str = "date",
    group_cols: Sequence[str] | None = fe.SERIES,
    include_lags: bool = True,
    include_rolling: bool = True,
    include_time: bool = True,
    include_price: bool = True,
    include_interactions: bool = True,
    lags: Sequence[int] = fe.DEFAULT_LAGS,
    windows: Sequence[int] = fe.DEFAULT_WINDOWS,
    stats: Sequence[str] = fe.DEFAULT_STATS,
) -> tuple[DataFrame, FeatureState]:
    """C3 of the train part and the state for later rows, from one window pass."""
    g = list(group_cols or [])
    checkpoint_dir(train.sparkSession)
    out = fe.window_features(
        train, target_col, date_col, g, include_lags, include_rolling, include_price, lags, windows, stats
    ).checkpoint(eager=True)
    base = out.select(*train.columns)
    roll = [c for c in out.columns if c not in train.columns and c.startswith("rolling_")]
    medians = fe.rolling_medians(out, roll) if roll else {}

    extremes = [c for c in fe.EXTREMES_OF if c in train.columns] if include_interactions else []
    wanted = [x for c in extremes for x in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))]
    if include_price and not g:
        wanted += [F.avg("price").alias("price_mean"), F.stddev_samp("price").alias("price_std")]
    scalars = {}
    if wanted:
        row = base.agg(*wanted).first()
        scalars = {k: None if v is None else float(v) for k, v in row.asDict().items()}

    if include_price:
        carry = last_price(base, date_col, g)
        series = fe.series_table(base, g).join(carry, g, "left") if g else carry
    else:
        series = base.groupBy(*g).agg(F.count(F.lit(1)).alias("_group_rows"))
    look_back = fe.look_back_rows(include_lags, include_rolling, include_price, lags, windows)
    fitted = {
        "columns": list(train.columns), "target_col": target_col, "date_col": date_col, "group_cols": g,
        "include_lags": include_lags, "include_rolling": include_rolling, "include_time": include_time,
        "include_price": include_price, "include_interactions": include_interactions,
        "lags": list(lags), "windows": list(windows), "stats": list(stats),
        "look_back": look_back, "medians": medians, "scalars": scalars,
    }
    state = FeatureState(
        last_rows(base, look_back, date_col, g).checkpoint(eager=True), series.checkpoint(eager=True), fitted
    )
    lit = {k: F.lit(v).cast("double") for k, v in scalars.items()}
    bounds = [lit[k].alias(k) for k in lit if k.endswith(("_lo", "_hi"))]
    done = fe.complete_features(
        out, train, date_col, g, medians, series, lit, F.struct(*bounds) if bounds else None,
        include_time, include_price, include_interactions,
    )
    return done, state
