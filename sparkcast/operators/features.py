"""Feature operators: lags, rolling stats, price, interactions.

Lags and rolling frames count rows, not days (Q4). Rolling statistics are
taken over the ``w`` rows *before* the current one (``shift(1)`` then
``rolling(w, min_periods=1)``), i.e. ``rowsBetween(-w, -1)``.

Everything that is ordered goes through ``ordered.ordered_window_columns``:
per series it is a plain partitioned window unless a series is large enough
to be a straggler, and without series it is the chunk + halo form, never an
unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.functions.calendar import time_features
from sparkcast.functions.stats import safe_div
from sparkcast.operators import ordered

DEFAULT_LAGS = (1, 3, 7, 14, 30)
DEFAULT_WINDOWS = (7, 14, 30)
DEFAULT_STATS = ("mean", "std", "min", "max")
SERIES = ("product_id", "store_id")
# halo for the price-change columns (they look back one row)
PRICE_CARRY_ROWS = 1

def _median_over(col: Column, frame) -> Column:
    """Spark has no median over a frame: sort the frame's few values."""
    x = F.array_sort(F.collect_list(col).over(frame))
    n = F.size(x)
    low, high = F.floor((n + 1) / 2).cast("int"), F.floor((n + 2) / 2).cast("int")
    return F.when(n > 0, (F.try_element_at(x, low) + F.try_element_at(x, high)) / 2)


# Rolling statistic given by name (pandas aggregate names)
ROLLING_AGGS = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
    "var": F.var_samp,
}


def _keys_present(group_cols: Sequence[str]) -> Column:
    """pandas groupby drops rows with a NULL key; their features stay NULL."""
    acc = F.lit(True)
    for g in group_cols:
        acc = acc & F.col(g).isNotNull()
    return acc


def _guard(expr: Column, group_cols: Sequence[str]) -> Column:
    if not group_cols:
        return expr
    return F.when(_keys_present(group_cols), expr)


def lag_columns(w, target_col: str, lags: Sequence[int], group_cols: Sequence[str]) -> dict:
    return {f"lag_{k}": _guard(F.lag(F.col(target_col), k).over(w), group_cols) for k in lags}


def rolling_columns(
    w, target_col: str, windows: Sequence[int], stats: Sequence[str], group_cols: Sequence[str]
) -> dict:
    out = {}
    for win in windows:
        frame = w.rowsBetween(-int(win), -1)
        for stat in stats:
            if stat == "median":
                value = _median_over(F.col(target_col), frame)
            elif stat in ROLLING_AGGS:
                value = ROLLING_AGGS[stat](F.col(target_col)).over(frame)
            else:
                raise ValueError(f"unknown rolling statistic {stat!r}")
            out[f"rolling_{win}_{stat}"] = _guard(value, group_cols)
    return out


_SORTABLE = (
    T.NumericType,
    T.StringType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.BooleanType,
)


def _order_cols(date_col: str, group_cols: Sequence[str], df: DataFrame) -> list[str]:
    """Total order inside a series (T2, Q3): date, the remaining key columns,
    then every other plain column, so rows that repeat a key still get one
    fixed order. Later keys are only compared on ties, so they cost little."""
    skip = set(group_cols) | {date_col}
    ties = [c for c in ("product_id", "store_id") if c in df.columns and c not in skip]
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in skip and f.name not in ties and not f.name.startswith("_")
        and isinstance(f.dataType, _SORTABLE)
    ]
    return [date_col, *ties, *rest]


def create_lag_features(
    df: DataFrame,
    target_col: str = "target_demand",
    lags: Sequence[int] = DEFAULT_LAGS,
    group_cols: Sequence[str] | None = SERIES,
    date_col: str = "date",
    strategy: str = "chunked",
    chunk_rows: int | None = None,
) -> DataFrame:
    """W1 (per group) / W2 (global when ``group_cols`` is empty or None)."""
    g = list(group_cols or [])
    return ordered.ordered_window_columns(
        df,
        _order_cols(date_col, g, df),
        g,
        halo=max(lags),
        make_columns=lambda w, _lb: lag_columns(w, target_col, lags, g),
        strategy=strategy,
        chunk_rows=chunk_rows,
    )


def create_rolling_features(
    df: DataFrame,
    target_col: str = "target_demand",
    windows: Sequence[int] = DEFAULT_WINDOWS,
    stats: Sequence[str] = DEFAULT_STATS,
    group_cols: Sequence[str] | None = SERIES,
    date_col: str = "date",
    strategy: str = "chunked",
    chunk_rows: int | None = None,
) -> DataFrame:
    """W3 (per group) / W4 (global)."""
    g = list(group_cols or [])
    return ordered.ordered_window_columns(
        df,
        _order_cols(date_col, g, df),
        g,
        halo=max(windows),
        make_columns=lambda w, _lb: rolling_columns(w, target_col, windows, stats, g),
        strategy=strategy,
        chunk_rows=chunk_rows,
    )


def group_stats_table(
    df: DataFrame,
    value_col: str,
    group_cols: Sequence[str],
    prefix: str | None = None,
    extremes_of: Sequence[str] = (),
) -> DataFrame:
    """One row per group: row count and mean/std/min/max of ``value_col``;
    ``extremes_of`` adds ``_lo_<c>`` / ``_hi_<c>`` per group, from which
    global extremes are a min/max over the (small) group table."""
    p = prefix or value_col
    g = list(group_cols)
    extra = []
    for c in extremes_of:
        extra += [F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}")]
    # No row filter: a group with a NULL key gets a row too, which no
    # equi-join matches (those rows keep NULL statistics, as pandas' groupby
    # drops NULL keys), while the extremes still cover every row.
    return df.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_group_rows"),
        F.avg(value_col).alias(f"{p}_mean"),
        F.stddev_samp(value_col).alias(f"{p}_std"),
        F.min(value_col).alias(f"{p}_min"),
        F.max(value_col).alias(f"{p}_max"),
        *extra,
    )


def group_statistics(
    df: DataFrame, value_col: str, group_cols: Sequence[str], prefix: str | None = None
) -> DataFrame:
    """Mean, sample std, min, max of ``value_col`` per group, on every row.

    An aggregate (partial + final, so a hot group is pre-aggregated map-side)
    joined back on the keys; AQE broadcasts the group table when its runtime
    size is small and splits skewed partitions otherwise.
    """
    p = prefix or value_col
    g = list(group_cols)
    stats = df.where(_keys_present(g)).groupBy(*g).agg(
        F.avg(value_col).alias(f"{p}_mean"),
        F.stddev_samp(value_col).alias(f"{p}_std"),
        F.min(value_col).alias(f"{p}_min"),
        F.max(value_col).alias(f"{p}_max"),
    )
    return df.join(stats, g, "left")


def price_change_columns(
    w, price_col: str, group_cols: Sequence[str], look_back: int | None, filled_col: str | None = None
) -> dict:
    """W6 diff and W7 pct change (nulls carried forward first, as pandas 2 does).

    With ``filled_col`` (the price already forward-filled per series) the
    pct change only needs the previous row. Without it the fill is a running
    frame, which is exact on partitioned windows (``look_back`` None).
    """
    p = F.col(price_col)
    if filled_col is not None:
        filled = F.col(filled_col)
        prev_filled = F.lag(filled, 1).over(w)
    else:
        lower = Window.unboundedPreceding if look_back is None else -int(look_back)
        filled = F.last(p, ignorenulls=True).over(w.rowsBetween(lower, 0))
        prev_filled = F.last(p, ignorenulls=True).over(w.rowsBetween(lower, -1))
    change = p - F.lag(p, 1).over(w)
    pct = safe_div(filled, prev_filled) - F.lit(1.0)
    return {
        "price_change": F.coalesce(_guard(change, group_cols), F.lit(0.0)),
        "price_change_pct": F.coalesce(_guard(pct, group_cols), F.lit(0.0)),
    }


FILLED_PRICE = "_price_ffill"


def _with_filled_price(df: DataFrame, price_col: str, g: list[str], date_col: str, strategy: str):
    """For the chunked form: the price forward-filled per series, exactly
    (chunked fill with a carry per chunk and series), so pct change needs
    no unbounded frame. Returns (frame, rows); in the chunked form the frame
    keeps the ordinal so the window pass need not sort again."""
    if strategy != "chunked":
        return df, None
    order = _order_cols(date_col, g, df)
    price = F.col(price_col)
    # a frame that brings the column has values for some NULL prices already
    seed = F.coalesce(price, F.col(FILLED_PRICE)) if FILLED_PRICE in df.columns else price
    return ordered.fill_nulls_ordered(
        df.withColumn(FILLED_PRICE, seed),
        [FILLED_PRICE],
        order,
        group_cols=g,
        return_rows=True,
    )


def create_price_features(
    df: DataFrame,
    price_col: str = "price",
    group_cols: Sequence[str] | None = SERIES,
    date_col: str = "date",
    strategy: str = "chunked",
    chunk_rows: int | None = None,
) -> DataFrame:
    """7 columns per group, 5 globally."""
    g = list(group_cols or [])
    if g:
        out = group_statistics(df, price_col, g, prefix="price")
        out = out.withColumn("price_vs_mean", safe_div(F.col(price_col), F.col("price_mean")))
    else:
        # Global scalars as scalar subqueries, no cross join
        agg = df.agg(F.avg(price_col).alias("m"), F.stddev_samp(price_col).alias("s"))
        out = df.withColumns(
            {
                "price_mean": agg.select("m").scalar(),
                "price_std": agg.select("s").scalar(),
            }
        ).withColumn("price_vs_mean", safe_div(F.col(price_col), F.col("price_mean")))
    return _with_price_changes(out, price_col, g, date_col, strategy, chunk_rows)


def _with_price_changes(df, price_col, g, date_col, strategy, chunk_rows):
    if not g:
        strategy = "chunked"
    src, rows = _with_filled_price(df, price_col, g, date_col, strategy)
    filled = FILLED_PRICE if strategy == "chunked" else None
    out = ordered.ordered_window_columns(
        src,
        _order_cols(date_col, g, df),
        g,
        halo=PRICE_CARRY_ROWS,
        make_columns=lambda w, look_back: price_change_columns(w, price_col, g, look_back, filled),
        strategy=strategy,
        chunk_rows=chunk_rows,
        ordinal_rows=rows,
    )
    return out.drop(FILLED_PRICE, ordered.ORD)


def _minmax(src: DataFrame, cols: Sequence[str]) -> Column:
    """Global min/max of several columns as ONE scalar subquery (a struct)."""
    fields = []
    for c in cols:
        fields += [F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi")]
    return src.agg(F.struct(*fields)).scalar()


def _norm(mm: Column, c: str) -> Column:
    """(x - min) / (max - min); NULL when max = min."""
    return safe_div(F.col(c) - mm[f"{c}_lo"], mm[f"{c}_hi"] - mm[f"{c}_lo"])


def create_interaction_features(
    df: DataFrame, stats_source: DataFrame | None = None, minmax: Column | None = None
) -> DataFrame:
    """C2 = F6-F9, each only if its inputs exist.

    Global min/max come from ``minmax`` (a struct with ``<c>_lo``/``<c>_hi``)
    when given, else from ``stats_source`` (default ``df``): pass the
    un-windowed input so the scalar subquery does not re-plan window work.
    """
    src = stats_source if stats_source is not None else df
    cols = set(df.columns)
    scaled = [c for c in ("price", "economic_index") if c in cols]
    mm = minmax if minmax is not None else (_minmax(src, scaled) if scaled else None)
    new: dict[str, Column] = {}
    if "promotion_flag" in cols:
        promo = F.col("promotion_flag")
        if "is_weekend" in cols:
            new["promo_weekend"] = promo * F.col("is_weekend")
        if "holiday_flag" in cols:
            new["promo_holiday"] = promo * F.col("holiday_flag")
        if "price" in cols:
            new["promo_discount_effect"] = promo * (F.lit(1.0) - _norm(mm, "price"))
    if "economic_index" in cols and "price" in cols:
        new["price_economy_ratio"] = safe_div(
            _norm(mm, "price"), _norm(mm, "economic_index") + F.lit(0.01)
        )
    if "historical_sales" in cols and "target_demand" in cols:
        new["demand_vs_historical"] = safe_div(
            F.col("target_demand"), F.col("historical_sales") + F.lit(1)
        )
    return df.withColumns(new) if new else df


def create_features(
    df: DataFrame,
    target_col: str = "target_demand",
    date_col: str = "date",
    group_cols: Sequence[str] | None = SERIES,
    include_lags: bool = True,
    include_rolling: bool = True,
    include_time: bool = True,
    include_price: bool = True,
    include_interactions: bool = True,
    lags: Sequence[int] = DEFAULT_LAGS,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    stats: Sequence[str] = DEFAULT_STATS,
    strategy: str = "chunked",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Time, lag, rolling, price and interaction features, then NULL fills.

    Lags and rolling stats share one window pass (same partition and order).
    Afterwards lag columns get 0 and rolling columns their column median
    (exact), found from the windowed table written to the checkpoint folder
    so the window stage runs once.
    """
    g = list(group_cols or [])
    price_stats = None
    if include_price and g:
        price_stats = series_table(df, g)
    out = window_features(
        df, target_col, date_col, g, include_lags, include_rolling, include_price,
        lags, windows, stats, strategy, chunk_rows,
    )
    med = None
    roll_cols = [c for c in out.columns if c not in df.columns and c.startswith("rolling_")]
    if roll_cols:
        # Materialise only the base and window columns (the row-local
        # features below are cheap to derive again) in the shared checkpoint
        # folder, so the window stage runs once for the medians and the output.
        from sparkcast.session import checkpoint_dir

        checkpoint_dir(out.sparkSession)
        out = out.checkpoint(eager=True)
        med = rolling_medians(out, roll_cols)
    price_scalars = None
    if include_price and not g:
        # global scalars from the input (price is untouched by the windows)
        agg = df.agg(F.struct(F.avg("price").alias("m"), F.stddev_samp("price").alias("s"))).scalar()
        price_scalars = {"price_mean": agg["m"], "price_std": agg["s"]}
    minmax = None
    if include_interactions and price_stats is not None:
        # global extremes from the per-series table (one row per series,
        # NULL-key group included) instead of another pass over the data
        fields = _extreme_fields(price_stats)
        minmax = price_stats.agg(F.struct(*fields)).scalar() if fields else None
    return complete_features(
        out, df, date_col, g, med, price_stats, price_scalars, minmax,
        include_time, include_price, include_interactions,
    )


EXTREMES_OF = ("price", "economic_index")


def series_table(df: DataFrame, g: Sequence[str]) -> DataFrame:
    """One row per series (price statistics, extremes), written once to the
    checkpoint folder for the join and the global extremes."""
    from sparkcast.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    extremes = [c for c in EXTREMES_OF if c in df.columns]
    return group_stats_table(df, "price", g, prefix="price", extremes_of=extremes).checkpoint(eager=True)


def _extreme_fields(price_stats: DataFrame) -> list[Column]:
    fields = []
    for c in EXTREMES_OF:
        if f"_lo_{c}" in price_stats.columns:
            fields += [F.min(f"_lo_{c}").alias(f"{c}_lo"), F.max(f"_hi_{c}").alias(f"{c}_hi")]
    return fields


def rolling_medians(out: DataFrame, roll_cols: Sequence[str]) -> dict:
    """Exact median of each rolling column: the fill of its NULLs."""
    row = ordered.quantile_columns(out, list(roll_cols), [0.5], name=lambda c, q: c).first()
    return {c: row[c] for c in roll_cols} if row is not None else {}


def window_features(
    df: DataFrame,
    target_col: str,
    date_col: str,
    g: list[str],
    include_lags: bool,
    include_rolling: bool,
    include_price: bool,
    lags: Sequence[int],
    windows: Sequence[int],
    stats: Sequence[str],
    strategy: str = "chunked",
    chunk_rows: int | None = None,
) -> DataFrame:
    """The ordered half of C3: lags, rolling stats and price changes in one
    window pass, NULLs of short histories not filled."""
    if not g:
        strategy = "chunked"
    out, ord_rows = df, None
    if include_price:
        out, ord_rows = _with_filled_price(out, "price", g, date_col, strategy)
    filled = FILLED_PRICE if include_price and strategy == "chunked" else None
    if not (include_lags or include_rolling or include_price):
        return out

    def make(w, look_back):
        cols = {}
        if include_lags:
            cols.update(lag_columns(w, target_col, lags, g))
        if include_rolling:
            cols.update(rolling_columns(w, target_col, windows, stats, g))
        if include_price:
            cols.update(price_change_columns(w, "price", g, look_back, filled))
        return cols

    out = ordered.ordered_window_columns(
        out,
        _order_cols(date_col, g, df),
        g,
        halo=look_back_rows(include_lags, include_rolling, include_price, lags, windows),
        make_columns=make,
        strategy=strategy,
        chunk_rows=chunk_rows,
        ordinal_rows=ord_rows,
    )
    return out.drop(FILLED_PRICE, ordered.ORD)


def look_back_rows(include_lags, include_rolling, include_price, lags, windows) -> int:
    """Rows before the current one that the window columns read."""
    return max(
        [*(lags if include_lags else [0]), *(windows if include_rolling else [0])]
        + ([PRICE_CARRY_ROWS] if include_price else [])
    )


def complete_features(
    out: DataFrame,
    df: DataFrame,
    date_col: str,
    g: list[str],
    medians: dict | None,
    price_stats: DataFrame | None,
    price_scalars: dict | None,
    minmax: Column | None,
    include_time: bool,
    include_price: bool,
    include_interactions: bool,
) -> DataFrame:
    """The row-local half of C3 over ``window_features`` of ``df``: NULL fills
    (lags 0, rolling columns their median), calendar, price statistics by join
    or as scalars, interactions."""
    window_cols = [c for c in out.columns if c not in df.columns]
    lag_cols = [c for c in window_cols if c.startswith("lag_")]
    roll_cols = [c for c in window_cols if c.startswith("rolling_")]
    fills = {c: F.coalesce(F.col(c), F.lit(0).cast(out.schema[c].dataType)) for c in lag_cols}
    for c in roll_cols:
        m = (medians or {}).get(c)
        fills[c] = F.coalesce(F.col(c), F.lit(m).cast("double")) if m is not None else F.col(c)
    if fills:
        out = out.withColumns(fills)
    time_cols: list[str] = []
    if include_time:
        tf = time_features(date_col)
        time_cols = list(tf)
        out = out.withColumns(tf)
    price_cols: list[str] = []
    if include_price:
        if g:
            stat_cols = ["price_mean", "price_std", "price_min", "price_max"]
            out = out.join(price_stats.select(*g, *stat_cols), g, "left")
        else:
            stat_cols = ["price_mean", "price_std"]
            out = out.withColumns({c: price_scalars[c] for c in stat_cols})
        out = out.withColumn("price_vs_mean", safe_div(F.col("price"), F.col("price_mean")))
        price_cols = [*stat_cols, "price_vs_mean", "price_change", "price_change_pct"]
    out = out.select(*df.columns, *time_cols, *lag_cols, *roll_cols, *price_cols)
    if include_interactions:
        out = create_interaction_features(out, stats_source=df, minmax=minmax)
    return out


# --------------------------------------------------------------------------
# Column lists
# --------------------------------------------------------------------------

DEFAULT_EXCLUDE = ["date", "target_demand", "product_id", "category_id", "store_id", "year"]


def get_feature_names(df: DataFrame, exclude_cols: Sequence[str] | None = None) -> list[str]:
    """Every column but date, target, ids, year and extras."""
    ex = set(DEFAULT_EXCLUDE) | set(exclude_cols or [])
    return [c for c in df.columns if c not in ex]


def training_columns(df: DataFrame, leak_free: bool = True) -> list[str]:
    """All but date and target (ids and year stay); F9 left out by default (Q5)."""
    ex = {"date", "target_demand"} | ({"demand_vs_historical"} if leak_free else set())
    return [c for c in df.columns if c not in ex]


def align_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P10: add missing columns as 0, then order exactly as given."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(0).alias(c) for c in columns])


# --------------------------------------------------------------------------
# serving features for a request table
# --------------------------------------------------------------------------

SERVING_LAGS = (1, 3, 7, 14, 30)
SERVING_WINDOWS = (7, 14, 30)


def serving_features(requests: DataFrame, date_col: str = "prediction_date") -> DataFrame:
    """the model inputs the scoring service derives from one request row.

    Row-local (no order, no aggregate), so it also runs on a stream.
    """
    d = F.col(date_col)
    hs = F.col("historical_sales").cast("double")
    price = F.col("price").cast("double")
    cols: dict[str, Column] = {
        "product_id": F.col("product_id"),
        "category_id": F.col("category_id"),
        "store_id": F.col("store_id"),
        "historical_sales": hs,
        "price": price,
        "promotion_flag": F.col("promotion_flag"),
        "holiday_flag": F.col("holiday_flag"),
        "economic_index": F.col("economic_index").cast("double"),
        "day_of_week": F.weekday(d).cast("bigint"),
        "day_of_month": F.dayofmonth(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "quarter": F.quarter(d).cast("bigint"),
        "year": F.year(d).cast("bigint"),
        "week_of_year": F.weekofyear(d).cast("bigint"),
        "is_weekend": (F.weekday(d) >= 5).cast("bigint"),
        "is_month_start": (F.dayofmonth(d) == 1).cast("bigint"),
        "is_month_end": (d == F.last_day(d)).cast("bigint"),
        "price_per_category": price / F.greatest(F.col("category_id"), F.lit(1)).cast("double"),
        "price_times_promo": price * F.col("promotion_flag"),
        "sales_price_ratio": safe_div(hs, price + F.lit(1.0)),
        "promo_holiday": F.col("promotion_flag") * F.col("holiday_flag"),
        "store_category": F.col("store_id") * 100 + F.col("category_id"),
        "economic_sales": F.col("economic_index").cast("double") * hs,
    }
    for k in SERVING_LAGS:
        cols[f"sales_lag_{k}"] = hs
    for win in SERVING_WINDOWS:
        cols[f"sales_rolling_mean_{win}"] = hs
        cols[f"sales_rolling_std_{win}"] = F.lit(0.0)
        cols[f"sales_rolling_min_{win}"] = hs
        cols[f"sales_rolling_max_{win}"] = hs
    keep = [c for c in requests.columns if c not in cols]
    return requests.select(*keep, *[v.alias(k) for k, v in cols.items()])
