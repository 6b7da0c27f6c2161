"""Catalogue: calendar, price, interaction and ordered feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcast.functions import calendar
from sparkcast.operators import appending, bydays
from sparkcast.operators import features as fe
from sparkcast.plans.catalog import register
from sparkcast.plans.common import r, round_doubles
from sparkcast.session import scratch_dir
from sparkcast.sources.store import FeatureStore
from sparkcast.sources.tables import DEMAND_SQL, demand_view, read_table

BASE = [
    "date",
    "product_id",
    "category_id",
    "store_id",
    "historical_sales",
    "price",
    "promotion_flag",
    "holiday_flag",
    "economic_index",
    "target_demand",
]
SERIES_SQL = "PARTITION BY product_id, store_id ORDER BY date"
GLOBAL_SQL = "ORDER BY date, product_id, store_id"

# --------------------------------------------------------------------------
# SQL fragments (DuckDB)
# --------------------------------------------------------------------------


def _sql_calendar_basic() -> list[str]:
    return [
        "CAST(year(date) AS BIGINT) AS year",
        "CAST(month(date) AS BIGINT) AS month",
        "CAST(day(date) AS BIGINT) AS day",
        "CAST(isodow(date) - 1 AS BIGINT) AS day_of_week",
        "CAST(CASE WHEN isodow(date) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend",
        "CAST(weekofyear(date) AS BIGINT) AS week_of_year",
        "CAST(quarter(date) AS BIGINT) AS quarter",
    ]


def _sql_calendar_full() -> list[str]:
    qs = "CAST(date_trunc('quarter', date) AS DATE)"
    return [
        "CAST(year(date) AS BIGINT) AS year",
        "CAST(month(date) AS BIGINT) AS month",
        "CAST(day(date) AS BIGINT) AS day",
        "CAST(isodow(date) - 1 AS BIGINT) AS day_of_week",
        "CAST(dayofyear(date) AS BIGINT) AS day_of_year",
        "CAST(weekofyear(date) AS BIGINT) AS week_of_year",
        "CAST(quarter(date) AS BIGINT) AS quarter",
        "CAST(CASE WHEN isodow(date) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend",
        "CAST(CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_month_start",
        "CAST(CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS BIGINT) AS is_month_end",
        f"CAST(CASE WHEN date = {qs} THEN 1 ELSE 0 END AS BIGINT) AS is_quarter_start",
        f"CAST(CASE WHEN date = last_day(CAST({qs} + INTERVAL 2 MONTH AS DATE)) THEN 1 ELSE 0 END AS BIGINT) AS is_quarter_end",
    ]


def _sql_cyclic(rounded: bool = True) -> list[str]:
    exprs = {
        "day_of_week_sin": "sin(2 * pi() * CAST(isodow(date) - 1 AS DOUBLE) / 7)",
        "day_of_week_cos": "cos(2 * pi() * CAST(isodow(date) - 1 AS DOUBLE) / 7)",
        "month_sin": "sin(2 * pi() * CAST(month(date) AS DOUBLE) / 12)",
        "month_cos": "cos(2 * pi() * CAST(month(date) AS DOUBLE) / 12)",
    }
    return [f"{r(e) if rounded else e} AS {k}" for k, e in exprs.items()]


def _sql_lags(over: str, lags=fe.DEFAULT_LAGS) -> list[str]:
    return [f"lag(target_demand, {k}) OVER ({over}) AS lag_{k}" for k in lags]


SQL_AGG = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _sql_rolling(over: str, windows=fe.DEFAULT_WINDOWS, stats=fe.DEFAULT_STATS) -> list[str]:
    out = []
    for w in windows:
        for s in stats:
            out.append(
                f"{SQL_AGG[s]}(target_demand) OVER ({over} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
                f" AS rolling_{w}_{s}"
            )
    return out


def _sql_price_change(over: str) -> list[str]:
    return [
        f"COALESCE(price - lag(price, 1) OVER ({over}), 0.0) AS price_change",
        f"COALESCE(price / lag(price, 1) OVER ({over}) - 1, 0.0) AS price_change_pct",
    ]


ROLL_COLS = [f"rolling_{w}_{s}" for w in fe.DEFAULT_WINDOWS for s in fe.DEFAULT_STATS]
LAG_COLS = [f"lag_{k}" for k in fe.DEFAULT_LAGS]
DOUBLE_ROLL = [c for c in ROLL_COLS if c.endswith(("_mean", "_std"))]
TIME_COLS = [
    "year",
    "month",
    "day",
    "day_of_week",
    "day_of_year",
    "week_of_year",
    "quarter",
    "is_weekend",
    "is_month_start",
    "is_month_end",
    "is_quarter_start",
    "is_quarter_end",
]
CYCLIC_COLS = ["day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos"]

MINMAX = (
    "(SELECT min(price) AS pmin, max(price) AS pmax, min(economic_index) AS emin, "
    "max(economic_index) AS emax FROM demand)"
)


def _c3_sql(over: str, grouped: bool, until: str = "true") -> str:
    """``until``: the rows that medians, price statistics and extremes are
    fitted on; with a condition, only the other rows are returned."""
    time_sel = ", ".join(_sql_calendar_full() + _sql_cyclic(rounded=False))
    win_sel = ", ".join(_sql_lags(over) + _sql_rolling(over) + _sql_price_change(over))
    if grouped:
        stats = (
            "g AS (SELECT product_id, store_id, avg(price) AS price_mean, "
            "stddev_samp(price) AS price_std, min(price) AS price_min, max(price) AS price_max "
            "FROM fitted GROUP BY product_id, store_id),"
        )
        join = ("" if until == "true" else "LEFT ") + "JOIN g USING (product_id, store_id)"
        stat_cols = ["price_mean", "price_std", "price_min", "price_max"]
    else:
        stats = (
            "g AS (SELECT avg(price) AS price_mean, stddev_samp(price) AS price_std FROM fitted),"
        )
        join = ", g"
        stat_cols = ["price_mean", "price_std"]
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in ROLL_COLS)
    out_cols = (
        BASE
        + [c for c in TIME_COLS]
        + [r(c) + f" AS {c}" for c in CYCLIC_COLS]
        + [f"COALESCE({c}, 0) AS {c}" for c in LAG_COLS]
        + [
            (r(f"COALESCE({c}, m_{c})") if True else c) + f" AS {c}"
            for c in ROLL_COLS
        ]
        + [r(c) + f" AS {c}" for c in stat_cols]
        + [
            r("price / price_mean") + " AS price_vs_mean",
            r("price_change") + " AS price_change",
            r("price_change_pct") + " AS price_change_pct",
            "promotion_flag * is_weekend AS promo_weekend",
            "promotion_flag * holiday_flag AS promo_holiday",
            r("promotion_flag * (1 - (price - pmin) / (pmax - pmin))") + " AS promo_discount_effect",
            r("((price - pmin) / (pmax - pmin)) / ((economic_index - emin) / (emax - emin) + 0.01)")
            + " AS price_economy_ratio",
            r("target_demand / (historical_sales + 1)") + " AS demand_vs_historical",
        ]
    )
    return f"""
WITH demand AS ({DEMAND_SQL}),
fitted AS (SELECT * FROM demand WHERE {until}),
t AS (SELECT *, {time_sel} FROM demand),
w AS (SELECT *, {win_sel} FROM t),
{stats}
m AS (SELECT {med} FROM w WHERE {until}),
mm AS {MINMAX.replace("FROM demand", "FROM fitted")}
SELECT {", ".join(out_cols)}
FROM w {join}, m, mm
{"" if until == "true" else f"WHERE NOT ({until})"}
"""


C3_SERIES_SQL = _c3_sql(SERIES_SQL, grouped=True)
C3_GLOBAL_SQL = _c3_sql(GLOBAL_SQL, grouped=False)


@register("c3_features_per_series", C3_SERIES_SQL)
def c3_features_per_series(spark, sf):
    return round_doubles(fe.create_features(demand_view(spark, sf), group_cols=fe.SERIES))


@register("c3_features_global", C3_GLOBAL_SQL)
def c3_features_global(spark, sf):
    """The reference's default: no groups, one global date order (Q2)."""
    return round_doubles(fe.create_features(demand_view(spark, sf), group_cols=None))


# C3 on new data: a state fitted before a day, kept in the store, meets the days
# after it in two parts
NEW_FROM, NEW_THEN = "1998-01-01", "1998-05-01"


def _new_days(spark, sf, groups):
    d = demand_view(spark, sf)
    store = FeatureStore(spark, scratch_dir(spark, "feature-state"))
    date = F.col("date")
    old, first, then = (
        d.where(date < NEW_FROM),
        d.where((date >= NEW_FROM) & (date < NEW_THEN)),
        d.where(date >= NEW_THEN),
    )
    _, state = appending.fit_features(old, group_cols=groups)
    state.save(store, "demand", "v1")
    state = appending.load_state(store, "demand")
    state.advance(first).save(store, "demand", "v2")
    later = appending.load_state(store, "demand")
    return round_doubles(state.transform(first).unionByName(later.transform(then)))


@register("c3_new_days", _c3_sql(SERIES_SQL, True, f"date < DATE '{NEW_FROM}'"))
def c3_new_days(spark, sf):
    return _new_days(spark, sf, fe.SERIES)


@register("c3_new_days_global", _c3_sql(GLOBAL_SQL, False, f"date < DATE '{NEW_FROM}'"))
def c3_new_days_global(spark, sf):
    return _new_days(spark, sf, None)


KEY_SEL = "date, product_id, store_id"


@register(
    "f1_calendar",
    f"WITH demand AS ({DEMAND_SQL}) SELECT {KEY_SEL}, {', '.join(_sql_calendar_basic())} FROM demand",
)
def f1_calendar(spark, sf):
    d = demand_view(spark, sf)
    return d.select("date", "product_id", "store_id", *[v.alias(k) for k, v in calendar.basic_calendar().items()])


@register(
    "f2_calendar_full",
    f"WITH demand AS ({DEMAND_SQL}) SELECT {KEY_SEL}, {', '.join(_sql_calendar_full())} FROM demand",
)
def f2_calendar_full(spark, sf):
    d = demand_view(spark, sf)
    return d.select("date", "product_id", "store_id", *[v.alias(k) for k, v in calendar.full_calendar().items()])


@register(
    "f3_cyclic",
    f"WITH demand AS ({DEMAND_SQL}) SELECT {KEY_SEL}, {', '.join(_sql_cyclic())} FROM demand",
)
def f3_cyclic(spark, sf):
    d = demand_view(spark, sf)
    return round_doubles(
        d.select("date", "product_id", "store_id", *[v.alias(k) for k, v in calendar.cyclic().items()])
    )


def _window_sql(cols: list[str]) -> str:
    return f"WITH demand AS ({DEMAND_SQL}) SELECT {KEY_SEL}, target_demand, {', '.join(cols)} FROM demand"


@register("w1_lag", _window_sql(_sql_lags(SERIES_SQL)))
def w1_lag(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id", "target_demand")
    return fe.create_lag_features(d, group_cols=fe.SERIES)


@register("w2_lag_global", _window_sql(_sql_lags(GLOBAL_SQL)))
def w2_lag_global(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id", "target_demand")
    return fe.create_lag_features(d, group_cols=None)


def _rolling_sql(over: str) -> str:
    inner = _window_sql(_sql_rolling(over))
    outs = [f"{r(c)} AS {c}" if c in DOUBLE_ROLL else c for c in ROLL_COLS]
    return f"SELECT {KEY_SEL}, target_demand, {', '.join(outs)} FROM ({inner})"


@register("w3_rolling", _rolling_sql(SERIES_SQL))
def w3_rolling(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id", "target_demand")
    return round_doubles(fe.create_rolling_features(d, group_cols=fe.SERIES))


@register("w4_rolling_global", _rolling_sql(GLOBAL_SQL))
def w4_rolling_global(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id", "target_demand")
    return round_doubles(fe.create_rolling_features(d, group_cols=None))


@register(
    "w5_group_stats",
    f"""WITH demand AS ({DEMAND_SQL})
SELECT {KEY_SEL}, price,
  {r("avg(price) OVER (PARTITION BY product_id, store_id)")} AS price_mean,
  {r("stddev_samp(price) OVER (PARTITION BY product_id, store_id)")} AS price_std,
  min(price) OVER (PARTITION BY product_id, store_id) AS price_min,
  max(price) OVER (PARTITION BY product_id, store_id) AS price_max
FROM demand""",
)
def w5_group_stats(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id", "price")
    return round_doubles(fe.group_statistics(d, "price", fe.SERIES, prefix="price"))


def _price_change_sql(over: str, which: str) -> str:
    expr = {
        "price_change": f"COALESCE(price - lag(price, 1) OVER ({over}), 0.0)",
        "price_change_pct": f"COALESCE(price / lag(price, 1) OVER ({over}) - 1, 0.0)",
    }[which]
    return f"""WITH demand AS ({DEMAND_SQL})
SELECT {KEY_SEL}, price, {r(expr)} AS {which}
FROM demand"""


def _price_change_query(spark, sf, groups):
    d = demand_view(spark, sf).select("date", "product_id", "store_id", "price")
    out = fe._with_price_changes(d, "price", list(groups), "date", "chunked", None)
    return round_doubles(out)


@register("w6_diff", _price_change_sql(SERIES_SQL, "price_change"))
def w6_diff(spark, sf):
    return _price_change_query(spark, sf, fe.SERIES).drop("price_change_pct")


@register("w7_pct_change", _price_change_sql(SERIES_SQL, "price_change_pct"))
def w7_pct_change(spark, sf):
    return _price_change_query(spark, sf, fe.SERIES).drop("price_change")


@register(
    "f4_price_vs_mean",
    f"""WITH demand AS ({DEMAND_SQL})
SELECT {KEY_SEL}, price,
  {r("price / avg(price) OVER (PARTITION BY product_id, store_id)")} AS price_vs_mean
FROM demand""",
)
def f4_price_vs_mean(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id", "price")
    out = fe.group_statistics(d, "price", fe.SERIES, prefix="price")
    return round_doubles(
        out.select("date", "product_id", "store_id", "price", fe.safe_div(F.col("price"), F.col("price_mean")).alias("price_vs_mean"))
    )


@register(
    "f5_price_global",
    f"""WITH demand AS ({DEMAND_SQL}),
g AS (SELECT avg(price) AS price_mean, stddev_samp(price) AS price_std FROM demand)
SELECT {KEY_SEL}, price, {r("price_mean")} AS price_mean, {r("price_std")} AS price_std,
  {r("price / price_mean")} AS price_vs_mean,
  {r(f"COALESCE(price - lag(price, 1) OVER ({GLOBAL_SQL}), 0.0)")} AS price_change,
  {r(f"COALESCE(price / lag(price, 1) OVER ({GLOBAL_SQL}) - 1, 0.0)")} AS price_change_pct
FROM demand, g""",
)
def f5_price_global(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id", "price")
    return round_doubles(fe.create_price_features(d, group_cols=None))


@register(
    "c2_interactions",
    f"""WITH demand AS ({DEMAND_SQL}), mm AS {MINMAX}
SELECT {KEY_SEL},
  promotion_flag * (CASE WHEN isodow(date) - 1 >= 5 THEN 1 ELSE 0 END) AS promo_weekend,
  promotion_flag * holiday_flag AS promo_holiday,
  {r("promotion_flag * (1 - (price - pmin) / (pmax - pmin))")} AS promo_discount_effect,
  {r("((price - pmin) / (pmax - pmin)) / ((economic_index - emin) / (emax - emin) + 0.01)")} AS price_economy_ratio,
  {r("target_demand / (historical_sales + 1)")} AS demand_vs_historical
FROM demand, mm""",
)
def c2_interactions(spark, sf):
    d = demand_view(spark, sf).withColumn("is_weekend", calendar.basic_calendar()["is_weekend"])
    out = fe.create_interaction_features(d)
    return round_doubles(
        out.select(
            "date",
            "product_id",
            "store_id",
            "promo_weekend",
            "promo_holiday",
            "promo_discount_effect",
            "price_economy_ratio",
            "demand_vs_historical",
        )
    )


#: Events with one key that holds a third of all rows.
HOT_EVENTS_SQL = "SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS key, ts, event_id, value FROM events"


def hot_events(spark, sf):
    key = F.when(F.col("event_id") % 3 == 0, F.lit(-1).cast("bigint")).otherwise(F.col("user_id"))
    return read_table(spark, sf, "events").select(key.alias("key"), "ts", "event_id", "value")


@register(
    "w3_hot_series",
    f"""SELECT event_id, key,
  {r("lag(value, 1) OVER w")} AS lag_1, {r("lag(value, 7) OVER w")} AS lag_7,
  {r("min(value) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS rolling_7_min,
  {r("max(value) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS rolling_7_max,
  {r("median(value) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS rolling_7_median
FROM ({HOT_EVENTS_SQL}) WINDOW w AS (PARTITION BY key ORDER BY ts, event_id)""",
)
def w3_hot_series(spark, sf):
    """Lags and rolling statistics where one series is a third of the table."""
    ev = hot_events(spark, sf)
    out = fe.create_lag_features(ev, "value", lags=(1, 7), group_cols=("key",), date_col="ts")
    roll = fe.create_rolling_features(
        out, "value", windows=(7,), stats=("min", "max", "median"), group_cols=("key",), date_col="ts"
    )
    return round_doubles(
        roll.select("event_id", "key", "lag_1", "lag_7", "rolling_7_min", "rolling_7_max", "rolling_7_median")
    )


# --------------------------------------------------------------------------
# By days instead of rows
# --------------------------------------------------------------------------


def _back(days: int, until: int = 1) -> str:
    return f"RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND INTERVAL {until} DAYS PRECEDING"


def _sql_days(value: str, over: str, lags=(), windows=(), rounded=("mean", "std")) -> list[str]:
    out = [f"{r(f'avg({value}) OVER ({over} {_back(k, k)})')} AS lag_{k}d" for k in lags]
    for w in windows:
        for s in fe.DEFAULT_STATS:
            cell = f"{SQL_AGG[s]}({value}) OVER ({over} {_back(w)})"
            out.append(f"{r(cell) if s in rounded else cell} AS rolling_{w}d_{s}")
    return out


def _demand_days_sql(over: str, lags=(), windows=()) -> str:
    outs = _sql_days("target_demand", over, lags, windows)
    return f"SELECT {KEY_SEL}, target_demand, {', '.join(outs)} FROM ({DEMAND_SQL})"


def _target(spark, sf):
    return demand_view(spark, sf).select("date", "product_id", "store_id", "target_demand")


@register("w1_lag_by_days", _demand_days_sql(SERIES_SQL, lags=fe.DEFAULT_LAGS))
def w1_lag_by_days(spark, sf):
    return round_doubles(bydays.create_day_lag_features(_target(spark, sf)))


@register("w2_lag_by_days_global", _demand_days_sql("ORDER BY date", lags=fe.DEFAULT_LAGS))
def w2_lag_by_days_global(spark, sf):
    return round_doubles(bydays.create_day_lag_features(_target(spark, sf), group_cols=None))


@register("w3_rolling_by_days", _demand_days_sql(SERIES_SQL, windows=fe.DEFAULT_WINDOWS))
def w3_rolling_by_days(spark, sf):
    return round_doubles(bydays.create_day_rolling_features(_target(spark, sf)))


@register("w4_rolling_by_days_global", _demand_days_sql("ORDER BY date", windows=fe.DEFAULT_WINDOWS))
def w4_rolling_by_days_global(spark, sf):
    return round_doubles(bydays.create_day_rolling_features(_target(spark, sf), group_cols=None))


HOT_DAYS_OVER = "PARTITION BY key ORDER BY CAST(ts AS DATE)"


@register(
    "w3_hot_series_by_days",
    f"""SELECT event_id, key,
  {", ".join(_sql_days("value", HOT_DAYS_OVER, (1, 7), (7,), fe.DEFAULT_STATS))},
  count(value) OVER ({HOT_DAYS_OVER} {_back(7)}) AS rolling_7d_count
FROM ({HOT_EVENTS_SQL})""",
)
def w3_hot_series_by_days(spark, sf):
    """Many rows a day, and one series with a third of the table."""
    out = bydays.day_features(
        hot_events(spark, sf),
        "value",
        lags=(1, 7),
        windows=(7,),
        stats=(*fe.DEFAULT_STATS, "count"),
        group_cols=("key",),
        date_col="ts",
    )
    made = ["lag_1d", "lag_7d", *[f"rolling_7d_{s}" for s in (*fe.DEFAULT_STATS, "count")]]
    return round_doubles(out.select("event_id", "key", *made))
