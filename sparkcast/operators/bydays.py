"""Lags and rolling statistics that count days, not rows (W1-W4 with gaps in the dates).

Rows are first summed up by series and day (partial sums before the shuffle, so
a day or a series with a third of the rows arrives as one row per day). The
table of days is cut into intervals of ``span`` days; the last ``halo`` days of
an interval are copied into the next, so a RANGE frame that looks back at most
``halo`` days is exact inside (interval, series), and no task holds more than
``span + halo`` days of a series. The columns are joined back to the rows by
series and day.

Defined results, also for repeated keys:

* ``lag_{k}d`` is the mean of the series' values exactly ``k`` days before;
  NULL if that day has no value (a row lag would take an older day).
* ``rolling_{w}d_{stat}`` is over every value of the ``w`` days before the
  row's day; the day itself takes no part. Without values: NULL, count 0.
* NULL values are not counted. A row with a NULL date or series key keeps NULL
  columns. An empty table gives an empty table with the columns. Times of day
  are cut. Input columns of the new names are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.operators.features import (
    DEFAULT_LAGS,
    DEFAULT_STATS,
    DEFAULT_WINDOWS,
    SERIES,
    _keys_present,
)

#: Days of an interval for each day of halo: one day in nine is a copy.
SPAN_HALOS = 8


def _day(date_col: str) -> Column:
    return F.unix_date(F.to_date(F.col(date_col)))


def day_table(df: DataFrame, value_col: str, group_cols: Sequence[str], date_col: str) -> DataFrame:
    """One row per series and day: ``_day``, count, sum, mean, squares about it, extremes."""
    v = F.col(value_col)
    return (
        df.where(F.col(date_col).isNotNull() & _keys_present(group_cols))
        .groupBy(*group_cols, _day(date_col).alias("_day"))
        .agg(
            F.count(v).alias("_n"),
            F.sum(v).alias("_sum"),
            F.avg(v).alias("_mean"),
            (F.var_pop(v) * F.count(v)).alias("_m2"),
            F.min(v).alias("_min"),
            F.max(v).alias("_max"),
        )
    )


def _variance(frame) -> Column:
    """Sample variance of a frame of days: squares within days plus between them.

    Deviations are taken from the frame's own mean, so large values with a
    small spread lose no digits as a sum of squares would.
    """
    parts = F.filter(
        F.collect_list(F.struct("_n", "_mean", "_m2")).over(frame), lambda p: p["_n"] > 0
    )
    n = F.sum("_n").over(frame)
    mean = F.try_divide(F.sum("_sum").over(frame), n)
    squares = F.aggregate(
        parts,
        F.lit(0.0),
        lambda acc, p: acc + p["_m2"] + p["_n"] * (p["_mean"] - mean) * (p["_mean"] - mean),
    )
    return F.when(n > 1, squares / (n - 1))


#: Rolling statistics by name, from the columns of the table of days.
DAY_STATS = {
    "mean": lambda f: F.try_divide(F.sum("_sum").over(f), F.sum("_n").over(f)),
    "std": lambda f: F.sqrt(_variance(f)),
    "var": _variance,
    "min": lambda f: F.min("_min").over(f),
    "max": lambda f: F.max("_max").over(f),
    "sum": lambda f: F.sum("_sum").over(f),
    "count": lambda f: F.coalesce(F.sum("_n").over(f), F.lit(0).cast("long")),
}


def day_features(
    df: DataFrame,
    value_col: str,
    lags: Sequence[int] = (),
    windows: Sequence[int] = (),
    stats: Sequence[str] = DEFAULT_STATS,
    group_cols: Sequence[str] | None = SERIES,
    date_col: str = "date",
    span: int | None = None,
) -> DataFrame:
    """Lags and rolling statistics by days in one pass over the table of days.

    ``span``: days of an interval, at least the longest look-back; by default
    ``SPAN_HALOS`` times that. The result does not depend on it.
    """
    g = list(group_cols or [])
    unknown = [s for s in stats if s not in DAY_STATS]
    if unknown:
        raise ValueError(f"unknown rolling statistics {unknown}")
    if any(int(k) < 1 for k in (*lags, *windows)):
        raise ValueError("lags and windows are positive numbers of days")
    halo = max([int(k) for k in (*lags, *windows)], default=0)
    if not halo:
        return df
    span = SPAN_HALOS * halo if span is None else int(span)
    if span < halo:
        raise ValueError(f"an interval of {span} days is shorter than the look-back of {halo}")

    own = F.floor(F.col("_day") / F.lit(span)).cast("long")
    copied = F.pmod(F.col("_day"), F.lit(span)) >= span - halo
    days = (
        day_table(df, value_col, g, date_col)
        .withColumn("_own", own)
        .withColumn("_part", F.explode(F.when(copied, F.array(own, own + 1)).otherwise(F.array(own))))
    )
    w = Window.partitionBy("_part", *g).orderBy("_day")
    made = {f"lag_{k}d": F.first("_mean").over(w.rangeBetween(-int(k), -int(k))) for k in lags}
    for win in windows:
        frame = w.rangeBetween(-int(win), -1)
        for stat in stats:
            made[f"rolling_{win}d_{stat}"] = DAY_STATS[stat](frame)
    made_rows = days.withColumns(made).where(F.col("_part") == F.col("_own")).select(*g, "_day", *made)
    same = F.unix_date(F.to_date(F.col(f"r.`{date_col}`"))) == F.col("m._day")
    for c in g:
        same = same & (F.col(f"r.`{c}`") == F.col(f"m.`{c}`"))
    kept = [F.col(f"r.`{c}`") for c in df.columns if c not in made]
    return (
        df.alias("r").join(made_rows.alias("m"), same, "left").select(*kept, *[F.col(f"m.{c}") for c in made])
    )


def create_day_lag_features(
    df: DataFrame,
    target_col: str = "target_demand",
    lags: Sequence[int] = DEFAULT_LAGS,
    group_cols: Sequence[str] | None = SERIES,
    date_col: str = "date",
    span: int | None = None,
) -> DataFrame:
    """``lag_{k}d`` for every ``k``, per series or (without ``group_cols``) over all rows."""
    return day_features(df, target_col, lags=lags, group_cols=group_cols, date_col=date_col, span=span)


def create_day_rolling_features(
    df: DataFrame,
    target_col: str = "target_demand",
    windows: Sequence[int] = DEFAULT_WINDOWS,
    stats: Sequence[str] = DEFAULT_STATS,
    group_cols: Sequence[str] | None = SERIES,
    date_col: str = "date",
    span: int | None = None,
) -> DataFrame:
    """``rolling_{w}d_{stat}`` for every window and statistic, per series or over all rows."""
    return day_features(
        df, target_col, windows=windows, stats=stats, group_cols=group_cols, date_col=date_col, span=span
    )
