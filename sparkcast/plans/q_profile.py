"""Catalogue: profiling and exploration."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F


from sparkcast.operators import explore as X
from sparkcast.operators import profile as P
from sparkcast.plans.catalog import register
from sparkcast.plans.common import r, round_doubles
from sparkcast.sources.tables import (
    DEMAND_SQL,
    NULLS_SQL,
    RAW_COLUMNS,
    RAW_DEFECTS_SQL,
    demand_view,
    raw_with_defects,
    read_table,
    with_nulls,
)

NUMERIC = [c for c in RAW_COLUMNS if c != "date"]
DTYPE = {"date": "date", "price": "double", "economic_index": "double"}


def _u(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@register(
    "s6_info",
    _u(
        [
            f"""SELECT '{c}' AS column, '{DTYPE.get(c, "bigint")}' AS dtype,
  CAST(count(*) AS BIGINT) AS rows, CAST({len(RAW_COLUMNS)} AS BIGINT) AS columns,
  CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing,
  {r(f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)")} AS missing_pct
FROM ({NULLS_SQL})"""
            for c in RAW_COLUMNS
        ]
    ),
)
def s6_info(spark, sf):
    return round_doubles(P.table_info(with_nulls(demand_view(spark, sf))))


@register(
    "a1_overview",
    f"""WITH t AS ({RAW_DEFECTS_SQL})
SELECT CAST(count(*) AS BIGINT) AS rows, CAST({len(RAW_COLUMNS)} AS BIGINT) AS columns,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS BIGINT) AS duplicate_rows,
  CAST({" + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in RAW_COLUMNS)} AS BIGINT) AS total_missing
FROM t""",
)
def a1_overview(spark, sf):
    return P.overview(raw_with_defects(demand_view(spark, sf)))


@register(
    "a2_counts",
    _u(
        [
            f"""SELECT '{c}' AS column,
  CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing,
  {r(f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2)")} AS missing_pct,
  CAST(count(DISTINCT {c}) AS BIGINT) AS unique,
  {r(f"round(count(DISTINCT {c}) * 100.0 / count(*), 2)")} AS unique_pct
FROM ({RAW_DEFECTS_SQL})"""
            for c in RAW_COLUMNS
        ]
    ),
)
def a2_counts(spark, sf):
    return round_doubles(P.column_counts(raw_with_defects(demand_view(spark, sf))))


@register(
    "a3_numeric",
    _u(
        [
            f"""SELECT '{c}' AS column, {r(f"min({c})")} AS min, {r(f"max({c})")} AS max,
  {r(f"round(avg({c}), 2)")} AS mean, {r(f"quantile_cont({c}, 0.5)")} AS median,
  {r(f"round(stddev_samp({c}), 2)")} AS std,
  CAST(count(*) FILTER (WHERE {c} = 0) AS BIGINT) AS zeros,
  {r(f"round(count(*) FILTER (WHERE {c} = 0) * 100.0 / count(*), 2)")} AS zeros_pct,
  {r(f"quantile_cont({c}, 0.25)")} AS q1, {r(f"quantile_cont({c}, 0.75)")} AS q3,
  {r(f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")} AS iqr
FROM ({DEMAND_SQL})"""
            for c in NUMERIC
        ]
    ),
)
def a3_numeric(spark, sf):
    return round_doubles(P.numeric_summary(demand_view(spark, sf)))


@register(
    "a4_datetime",
    f"""SELECT 'date' AS column, CAST(min(date) AS TIMESTAMP) AS min, CAST(max(date) AS TIMESTAMP) AS max,
  CAST(date_diff('day', min(date), max(date)) AS BIGINT) AS range_days FROM ({DEMAND_SQL})
UNION ALL
SELECT 'l_shipdate', min(l_shipdate), max(l_shipdate),
  CAST(floor(epoch_us(max(l_shipdate)) / 86400000000.0 - epoch_us(min(l_shipdate)) / 86400000000.0) AS BIGINT)
FROM lineitem""",
)
def a4_datetime(spark, sf):
    d = P.datetime_summary(demand_view(spark, sf), ["date"])
    li = P.datetime_summary(read_table(spark, sf, "lineitem").select("l_shipdate"), ["l_shipdate"])
    return d.unionByName(li)


@register(
    "a5_top5",
    """SELECT "column", CAST(rank AS BIGINT) AS rank, value, CAST(count AS BIGINT) AS count FROM (
  SELECT "column", value, count,
         row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS rank
  FROM (SELECT 'event_type' AS column, event_type AS value, count(*) AS count FROM events
        WHERE event_type IS NOT NULL GROUP BY event_type
        UNION ALL
        SELECT 'props', props, count(*) FROM events WHERE props IS NOT NULL GROUP BY props))
WHERE rank <= 5""",
)
def a5_top5(spark, sf):
    ev = read_table(spark, sf, "events")
    return P.top_values(ev, ["event_type", "props"], k=5)


def _corr_sql(a: str, b: str) -> str:
    return f"covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))"


@register(
    "a6_corr",
    f"WITH d AS ({DEMAND_SQL}) "
    + _u(
        [
            f"SELECT '{a}' AS col1, '{b}' AS col2, {r(f'round({_corr_sql(a, b)}, 3)')} AS correlation FROM d"
            for a in NUMERIC
            for b in NUMERIC
        ]
    ),
)
def a6_corr(spark, sf):
    return round_doubles(P.correlation_matrix(demand_view(spark, sf), NUMERIC))


#: Columns that move together with others, so that some pairs are reported.
CORRELATED_SQL = (
    f"SELECT *, target_demand * 3 + promotion_flag AS scaled_demand, 500 - price AS price_gap FROM ({DEMAND_SQL})"
)
CORRELATED = [*NUMERIC, "scaled_demand", "price_gap"]


@register(
    "a7_high_corr",
    f"WITH d AS ({CORRELATED_SQL}) SELECT col1, col2, {r('round(c, 3)')} AS correlation FROM ("
    + _u([f"SELECT '{a}' AS col1, '{b}' AS col2, {_corr_sql(a, b)} AS c FROM d" for a, b in combinations(CORRELATED, 2)])
    + ") WHERE abs(c) > 0.7",
)
def a7_high_corr(spark, sf):
    d = demand_view(spark, sf).withColumns(
        {
            "scaled_demand": F.col("target_demand") * 3 + F.col("promotion_flag"),
            "price_gap": F.lit(500) - F.col("price"),
        }
    )
    return round_doubles(P.high_correlations(d, CORRELATED))


@register(
    "a8_target",
    f"""SELECT {r("round(avg(target_demand), 2)")} AS mean, {r("quantile_cont(target_demand, 0.5)")} AS median,
  {r("round(stddev_samp(target_demand), 2)")} AS std, {r("min(target_demand)")} AS min,
  {r("max(target_demand)")} AS max, {r("round(skewness(target_demand), 2)")} AS skewness,
  {r("round(kurtosis(target_demand), 2)")} AS kurtosis,
  {r("quantile_cont(target_demand, 0.1)")} AS q10, {r("quantile_cont(target_demand, 0.25)")} AS q25,
  {r("quantile_cont(target_demand, 0.5)")} AS q50, {r("quantile_cont(target_demand, 0.75)")} AS q75,
  {r("quantile_cont(target_demand, 0.9)")} AS q90
FROM ({DEMAND_SQL})""",
)
def a8_target(spark, sf):
    return round_doubles(P.target_statistics(demand_view(spark, sf)))


@register(
    "a9_quantiles",
    f"""SELECT {r("quantile_cont(target_demand, 0.1)")} AS q10, {r("quantile_cont(target_demand, 0.25)")} AS q25,
  {r("quantile_cont(target_demand, 0.5)")} AS q50, {r("quantile_cont(target_demand, 0.75)")} AS q75,
  {r("quantile_cont(target_demand, 0.9)")} AS q90, {r("quantile_cont(target_demand, 0.5)")} AS median
FROM ({DEMAND_SQL})""",
)
def a9_quantiles(spark, sf):
    return round_doubles(P.target_quantiles(demand_view(spark, sf)))


@register(
    "p12_value_ranges",
    f"""WITH d AS ({DEMAND_SQL})
SELECT '0-10' AS bucket, CAST(count(*) FILTER (WHERE target_demand <= 10) AS BIGINT) AS count FROM d
UNION ALL SELECT '11-20', CAST(count(*) FILTER (WHERE target_demand > 10 AND target_demand <= 20) AS BIGINT) FROM d
UNION ALL SELECT '21-30', CAST(count(*) FILTER (WHERE target_demand > 20 AND target_demand <= 30) AS BIGINT) FROM d
UNION ALL SELECT '31-40', CAST(count(*) FILTER (WHERE target_demand > 30 AND target_demand <= 40) AS BIGINT) FROM d
UNION ALL SELECT '40+', CAST(count(*) FILTER (WHERE target_demand > 40) AS BIGINT) FROM d""",
)
def p12_value_ranges(spark, sf):
    return P.value_ranges(demand_view(spark, sf))


def _profile_sql() -> str:
    """A10 as one long table over the defect panel (same parts as A1-A9)."""
    src = "t"
    nums = NUMERIC

    def row(section, column, metric, value, text="CAST(NULL AS VARCHAR)"):
        col = f"'{column}'" if column is not None else "CAST(NULL AS VARCHAR)"
        return (
            f"SELECT '{section}' AS section, {col} AS \"column\", '{metric}' AS metric, "
            f"{r(value)} AS value, {text} AS text FROM {src}"
        )

    parts = [
        row("overview", None, "rows", "count(*)"),
        row("overview", None, "columns", f"max({len(RAW_COLUMNS)})"),
        row("overview", None, "duplicate_rows", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t))"),
        row("overview", None, "total_missing", " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in RAW_COLUMNS)),
    ]
    for c in RAW_COLUMNS:
        parts += [
            row("columns", c, "missing", f"count(*) FILTER (WHERE {c} IS NULL)"),
            row("columns", c, "missing_pct", f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2)"),
            row("columns", c, "unique", f"count(DISTINCT {c})"),
            row("columns", c, "unique_pct", f"round(count(DISTINCT {c}) * 100.0 / count(*), 2)"),
        ]
    for c in nums:
        parts += [
            row("numeric", c, "min", f"min({c})"),
            row("numeric", c, "max", f"max({c})"),
            row("numeric", c, "mean", f"round(avg({c}), 2)"),
            row("numeric", c, "median", f"quantile_cont({c}, 0.5)"),
            row("numeric", c, "std", f"round(stddev_samp({c}), 2)"),
            row("numeric", c, "zeros", f"count(*) FILTER (WHERE {c} = 0)"),
            row("numeric", c, "zeros_pct", f"round(count(*) FILTER (WHERE {c} = 0) * 100.0 / count(*), 2)"),
            row("numeric", c, "q1", f"quantile_cont({c}, 0.25)"),
            row("numeric", c, "q3", f"quantile_cont({c}, 0.75)"),
            row("numeric", c, "iqr", f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
        ]
    parts += [
        row("datetime", "date", "range_days", "date_diff('day', min(date), max(date))"),
        row("datetime", "date", "min", "NULL", "CAST(CAST(min(date) AS TIMESTAMP) AS VARCHAR)"),
        row("datetime", "date", "max", "NULL", "CAST(CAST(max(date) AS TIMESTAMP) AS VARCHAR)"),
    ]
    for a in nums:
        for b in nums:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            corr = (
                f"covar_pop({a}, {b}) / (stddev_pop(CASE WHEN {both} THEN {a} END)"
                f" * stddev_pop(CASE WHEN {both} THEN {b} END))"
            )
            if a == b:
                corr = f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END"
            parts.append(row("correlation", a, b, f"round({corr}, 3)"))
            if nums.index(a) < nums.index(b):
                parts.append(row("high_correlation", a, b, f"round({corr}, 3)") + f" HAVING abs({corr}) > 0.7")
    for c in RAW_COLUMNS:
        kind = "replace(replace(lower(any_value(typeof(" + c + "))), 'integer', 'int'), 'varchar', 'string')"
        parts.append(row("columns", c, "dtype", "NULL", kind))
    tgt = "target_demand"
    for m, e in [
        ("mean", f"round(avg({tgt}), 2)"),
        ("median", f"quantile_cont({tgt}, 0.5)"),
        ("std", f"round(stddev_samp({tgt}), 2)"),
        ("min", f"min({tgt})"),
        ("max", f"max({tgt})"),
        ("skewness", f"round(skewness({tgt}), 2)"),
        ("kurtosis", f"round(kurtosis({tgt}), 2)"),
        ("q10", f"quantile_cont({tgt}, 0.1)"),
        ("q25", f"quantile_cont({tgt}, 0.25)"),
        ("q50", f"quantile_cont({tgt}, 0.5)"),
        ("q75", f"quantile_cont({tgt}, 0.75)"),
        ("q90", f"quantile_cont({tgt}, 0.9)"),
    ]:
        parts.append(row("target", tgt, m, e))
    for name, pred in [
        ("0-10", f"{tgt} <= 10"),
        ("11-20", f"{tgt} > 10 AND {tgt} <= 20"),
        ("21-30", f"{tgt} > 20 AND {tgt} <= 30"),
        ("31-40", f"{tgt} > 30 AND {tgt} <= 40"),
        ("40+", f"{tgt} > 40"),
    ]:
        parts.append(row("value_ranges", tgt, name, f"count(*) FILTER (WHERE {pred})"))
    return f"WITH t AS ({RAW_DEFECTS_SQL}) " + " UNION ALL ".join(parts)


@register("a10_profile", _profile_sql())
def a10_profile(spark, sf):
    """A1-A9 as one long table over the defect panel."""
    return round_doubles(P.profile_report(raw_with_defects(demand_view(spark, sf))))


DOW_NAMES = "['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun']"


@register(
    "a11_group_means",
    f"""WITH d AS ({DEMAND_SQL})
SELECT 'date' AS dimension, CAST(date AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS label, {r("avg(target_demand)")} AS mean_target FROM d GROUP BY date
UNION ALL SELECT 'category_id', CAST(category_id AS VARCHAR), NULL, {r("avg(target_demand)")} FROM d GROUP BY category_id
UNION ALL SELECT 'store_id', CAST(store_id AS VARCHAR), NULL, {r("avg(target_demand)")} FROM d GROUP BY store_id
UNION ALL SELECT 'day_of_week', CAST(isodow(date) - 1 AS VARCHAR), {DOW_NAMES}[isodow(date)], {r("avg(target_demand)")} FROM d GROUP BY isodow(date)""",
)
def a11_group_means(spark, sf):
    return round_doubles(X.group_means(demand_view(spark, sf)))


@register(
    "a12_counts",
    f"""SELECT CAST(count(*) AS BIGINT) AS rows, CAST(10 AS BIGINT) AS columns, min(date) AS date_min,
  max(date) AS date_max, CAST(count(DISTINCT product_id) AS BIGINT) AS products,
  CAST(count(DISTINCT store_id) AS BIGINT) AS stores, CAST(count(DISTINCT category_id) AS BIGINT) AS categories
FROM ({DEMAND_SQL})""",
)
def a12_counts(spark, sf):
    return X.overview_counts(demand_view(spark, sf))


@register(
    "a13_describe",
    _u(
        [
            f"""SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, {r(f"avg({c})")} AS mean,
  {r(f"min({c})")} AS min, {r(f"quantile_cont({c}, 0.25)")} AS p25, {r(f"quantile_cont({c}, 0.5)")} AS p50,
  {r(f"quantile_cont({c}, 0.75)")} AS p75, {r(f"max({c})")} AS max, {r(f"stddev_samp({c})")} AS std
FROM ({DEMAND_SQL})"""
            for c in NUMERIC
        ]
        + [
            f"""SELECT 'date' AS column, CAST(count(x) AS BIGINT) AS count, {r("avg(x)")} AS mean,
  {r("min(x)")} AS min, {r("quantile_cont(x, 0.25)")} AS p25, {r("quantile_cont(x, 0.5)")} AS p50,
  {r("quantile_cont(x, 0.75)")} AS p75, {r("max(x)")} AS max, {r("stddev_samp(x)")} AS std
FROM (SELECT date_diff('day', DATE '1970-01-01', date) AS x FROM ({DEMAND_SQL}))"""
        ]
    ),
)
def a13_describe(spark, sf):
    return round_doubles(P.describe(demand_view(spark, sf)))


def _hist_sql(src: str, col: str, bins: int = 50) -> str:
    return f"""WITH s AS (SELECT CAST({col} AS DOUBLE) AS x FROM ({src}) WHERE {col} IS NOT NULL),
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM s),
c AS (SELECT CAST(least(COALESCE(floor((x - lo) / NULLIF(hi - lo, 0) * {bins}), 0), {bins - 1}) AS BIGINT) AS bin,
             count(*) AS n FROM s, mm GROUP BY 1),
b AS (SELECT CAST(range AS BIGINT) AS bin FROM range({bins}))
SELECT b.bin, {r(f"lo + (hi - lo) / {float(bins)} * b.bin")} AS lower,
  {r(f"lo + (hi - lo) / {float(bins)} * (b.bin + 1)")} AS upper,
  CAST(COALESCE(n, 0) AS BIGINT) AS count
FROM b LEFT JOIN c USING (bin), mm"""


@register("a14_histogram", _hist_sql(DEMAND_SQL, "target_demand"))
def a14_histogram(spark, sf):
    return round_doubles(X.histogram(demand_view(spark, sf), "target_demand"))


@register("a14_histogram_events", _hist_sql("SELECT * FROM events", "value"))
def a14_histogram_events(spark, sf):
    return round_doubles(X.histogram(read_table(spark, sf, "events"), "value"))


def _box_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    join = f"JOIN q USING ({group})" if group else ", q"
    return f"""WITH d AS (SELECT {g}CAST(target_demand AS DOUBLE) AS x FROM ({DEMAND_SQL})),
q AS (SELECT {g}quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
      FROM d {gb}),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT {g.replace(", ", "")}{", " if group else ""}CAST(count(*) AS BIGINT) AS count, {r("min(x)")} AS min, {r("any_value(q1)")} AS q1,
  {r("any_value(median)")} AS median, {r("any_value(q3)")} AS q3, {r("max(x)")} AS max,
  {r("any_value(lf)")} AS lower_fence, {r("any_value(uf)")} AS upper_fence,
  {r("min(x) FILTER (WHERE x >= lf)")} AS whisker_low, {r("max(x) FILTER (WHERE x <= uf)")} AS whisker_high,
  CAST(count(*) FILTER (WHERE x < lf OR x > uf) AS BIGINT) AS outliers
FROM d {join.replace("q", "f") if group else ", f"} {gb}"""


@register("a15_box", _box_sql(None))
def a15_box(spark, sf):
    return round_doubles(X.box_summary(demand_view(spark, sf), "target_demand"))


@register("a15_box_by_promotion", _box_sql("promotion_flag"))
def a15_box_by_promotion(spark, sf):
    return round_doubles(X.box_summary(demand_view(spark, sf), "target_demand", ["promotion_flag"]))


@register("a15_box_by_holiday", _box_sql("holiday_flag"))
def a15_box_by_holiday(spark, sf):
    return round_doubles(X.box_summary(demand_view(spark, sf), "target_demand", ["holiday_flag"]))


@register(
    "a16_target_corr",
    f"""WITH d AS ({DEMAND_SQL}), c AS ("""
    + _u(
        [
            f"SELECT '{c}' AS column, {_corr_sql(c, 'target_demand')} AS correlation FROM d"
            for c in NUMERIC
            if c != "target_demand"
        ]
    )
    + f""")
SELECT "column", {r("correlation")} AS correlation,
  CAST(row_number() OVER (ORDER BY abs(correlation) DESC NULLS LAST, "column") AS BIGINT) AS rank
FROM c""",
)
def a16_target_corr(spark, sf):
    return round_doubles(X.target_correlations(demand_view(spark, sf)))


@register(
    "t3_head",
    f"SELECT * FROM ({DEMAND_SQL}) ORDER BY date, product_id, store_id LIMIT 10",
)
def t3_head(spark, sf):
    return X.head(demand_view(spark, sf), 10)


WIDE = ["l_extendedprice", "l_orderkey", "l_partkey"]


@register(
    "a13_many_values",
    _u(
        [
            f"""SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, {r(f"quantile_cont({c}, 0.25)")} AS p25,
  {r(f"quantile_cont({c}, 0.5)")} AS p50, {r(f"quantile_cont({c}, 0.75)")} AS p75 FROM lineitem"""
            for c in WIDE
        ]
    ),
)
def a13_many_values(spark, sf):
    """Exact quartiles of columns with about as many values as rows."""
    li = read_table(spark, sf, "lineitem").select(*WIDE)
    return round_doubles(P.describe(li, WIDE).select("column", "count", "p25", "p50", "p75"))
