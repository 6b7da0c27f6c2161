"""Catalogue: drift between the train (reference) and test (current) parts
of the panel, and between the first and the last half of the events month."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcast.operators import drift as D
from sparkcast.operators import drift_reference as DR
from sparkcast.operators import split as S
from sparkcast.plans.catalog import register
from sparkcast.plans.common import r, round_doubles
from sparkcast.session import scratch_dir
from sparkcast.sources.store import FeatureStore
from sparkcast.sources.tables import DEMAND_SQL, RAW_DEFECTS_SQL, demand_view, raw_with_defects, read_table

NUMERIC = ["product_id", "category_id", "store_id", "historical_sales", "price", "economic_index"]
CATEGORICAL = ["promotion_flag", "holiday_flag"]
EVENTS_CUT = "2024-01-16"


def demand_sides(spark, sf):
    d = demand_view(spark, sf)
    mask = S.temporal_train_mask(d, 0.2)
    return d.where(mask), d.where(~mask)


def events_sides(spark, sf):
    ev = read_table(spark, sf, "events")
    cut = F.lit(EVENTS_CUT).cast("timestamp")
    return ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)


DEMAND_SIDES_SQL = f"""
SELECT *, CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'ref' ELSE 'cur' END AS side
FROM (SELECT *, row_number() OVER (ORDER BY date, product_id, store_id) AS rn, count(*) OVER () AS n
      FROM ({DEMAND_SQL}))
"""
EVENTS_SIDES_SQL = f"""
SELECT *, CASE WHEN ts < TIMESTAMP '{EVENTS_CUT}' THEN 'ref' ELSE 'cur' END AS side FROM events
"""


def _unpivot(src: str, cols: list[str], cast: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col, side, CAST({c} AS {cast}) AS value FROM ({src}) WHERE {c} IS NOT NULL"
        for c in cols
    )


def _counts(src: str, cols: list[str], cast: str) -> str:
    return f"""u AS ({_unpivot(src, cols, cast)}),
cnt AS (SELECT col, value, count(*) FILTER (WHERE side = 'ref') AS cr, count(*) FILTER (WHERE side = 'cur') AS cc
        FROM u GROUP BY col, value),
tot AS (SELECT col, sum(cr) AS nr, sum(cc) AS nc FROM cnt GROUP BY col)"""


def numeric_sql(src: str, cols: list[str]) -> str:
    """CTEs ending in ``nd`` (col, ks, wasserstein, ref_std, wasserstein_normed)."""
    return f"""WITH {_counts(src, cols, "DOUBLE")},
run AS (SELECT cnt.col, value,
          sum(cr) OVER (PARTITION BY cnt.col ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / nr AS fr,
          sum(cc) OVER (PARTITION BY cnt.col ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / nc AS fc,
          lead(value) OVER (PARTITION BY cnt.col ORDER BY value) AS nxt
        FROM cnt JOIN tot USING (col)),
st AS (SELECT col, max(abs(fr - fc)) AS ks, sum(COALESCE(abs(fr - fc) * (nxt - value), 0)) AS w FROM run GROUP BY col),
sd AS (SELECT col, stddev_pop(value) AS ref_std FROM u WHERE side = 'ref' GROUP BY col),
nd AS (SELECT col, ks, w AS wasserstein, ref_std, w / NULLIF(ref_std, 0) AS wasserstein_normed
       FROM st LEFT JOIN sd USING (col))"""


def categorical_sql(src: str, cols: list[str]) -> str:
    """CTEs ending in ``cd`` (col, jensenshannon, chisquare)."""
    return f"""WITH {_counts(src, cols, "VARCHAR")},
pq AS (SELECT col, cc, nc, cr / nr AS p, cc / nc AS q FROM cnt JOIN tot USING (col)),
cd AS (SELECT col,
  sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                 + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END))) AS jensenshannon,
  sum(CASE WHEN nc * p > 0 THEN (cc - nc * p) * (cc - nc * p) / (nc * p) END) AS chisquare
  FROM pq GROUP BY col)"""


@register(
    "d1_ks",
    numeric_sql(DEMAND_SIDES_SQL, NUMERIC) + f" SELECT col AS column, {r('ks')} AS ks FROM nd",
)
def d1_ks(spark, sf):
    ref, cur = demand_sides(spark, sf)
    return round_doubles(D.numeric_drift(ref, cur, NUMERIC).select("column", "ks"))


@register(
    "d1_wasserstein",
    numeric_sql(DEMAND_SIDES_SQL, NUMERIC)
    + f""" SELECT col AS column, {r('wasserstein')} AS wasserstein, {r('ref_std')} AS ref_std,
  {r('wasserstein_normed')} AS wasserstein_normed FROM nd""",
)
def d1_wasserstein(spark, sf):
    ref, cur = demand_sides(spark, sf)
    return round_doubles(
        D.numeric_drift(ref, cur, NUMERIC).select("column", "wasserstein", "ref_std", "wasserstein_normed")
    )


@register(
    "d1_ks_events",
    numeric_sql(EVENTS_SIDES_SQL, ["value"])
    + f" SELECT col AS column, {r('ks')} AS ks, {r('wasserstein_normed')} AS wasserstein_normed FROM nd",
)
def d1_ks_events(spark, sf):
    ref, cur = events_sides(spark, sf)
    return round_doubles(D.numeric_drift(ref, cur, ["value"]).select("column", "ks", "wasserstein_normed"))


@register(
    "d1_js",
    categorical_sql(EVENTS_SIDES_SQL, ["event_type"])
    + f" SELECT col AS column, {r('jensenshannon')} AS jensenshannon, {r('chisquare')} AS chisquare FROM cd",
)
def d1_js(spark, sf):
    ref, cur = events_sides(spark, sf)
    return round_doubles(D.categorical_drift(ref, cur, ["event_type"]).select("column", "jensenshannon", "chisquare"))


def _columns_sql() -> str:
    num = numeric_sql(DEMAND_SIDES_SQL, NUMERIC)
    cat = categorical_sql(DEMAND_SIDES_SQL, CATEGORICAL).replace("WITH ", "", 1)
    cat = cat.replace("u AS (", "u2 AS (", 1).replace("FROM u ", "FROM u2 ").replace("cnt AS (", "cnt2 AS (", 1)
    cat = cat.replace("FROM cnt ", "FROM cnt2 ").replace("tot AS (", "tot2 AS (", 1).replace("JOIN tot ", "JOIN tot2 ")
    cat = cat.replace("FROM cnt GROUP", "FROM cnt2 GROUP")
    return f"""{num}, {cat},
cols AS (
  SELECT col AS column, 'numeric' AS kind, 'wasserstein_normed' AS stattest_name,
         wasserstein_normed AS drift_score, COALESCE(wasserstein_normed >= {D.DEFAULT_THRESHOLD}, false) AS drift_detected FROM nd
  UNION ALL
  SELECT col, 'categorical', 'jensenshannon', jensenshannon, COALESCE(jensenshannon >= {D.DEFAULT_THRESHOLD}, false) FROM cd)"""


@register(
    "d2_columns",
    _columns_sql()
    + f""" SELECT "column", kind, stattest_name, {r('drift_score')} AS drift_score, drift_detected FROM cols""",
)
def d2_columns(spark, sf):
    ref, cur = demand_sides(spark, sf)
    return round_doubles(D.column_drift(ref, cur, NUMERIC, CATEGORICAL))


@register(
    "d3_dataset",
    _columns_sql()
    + f""" SELECT CAST(count(*) AS BIGINT) AS number_of_columns,
  CAST(count(*) FILTER (WHERE drift_detected) AS BIGINT) AS number_of_drifted_columns,
  {r("count(*) FILTER (WHERE drift_detected) / count(*)")} AS share_of_drifted_columns,
  count(*) FILTER (WHERE drift_detected) / count(*) >= {D.DATASET_SHARE} AS dataset_drift,
  COALESCE(string_agg("column", ',' ORDER BY "column") FILTER (WHERE drift_detected), '') AS drifted_features
FROM cols""",
)
def d3_dataset(spark, sf):
    ref, cur = demand_sides(spark, sf)
    return round_doubles(D.dataset_drift(D.column_drift(ref, cur, NUMERIC, CATEGORICAL)))


QUALITY_COLS = NUMERIC + CATEGORICAL + ["target_demand"]


def _quality_sql(src: str, by: str) -> str:
    """A20 figures of ``src`` (columns side, col, value) per ``by``."""
    keys = f"{by}, col" if by else "col"
    names = f"{by}, col AS column" if by else "col AS column"
    return f"""SELECT {names}, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS missing,
  CAST(count(DISTINCT value) AS BIGINT) AS distinct, CAST(count(*) FILTER (WHERE value = 0) AS BIGINT) AS zeros,
  {r("min(value)")} AS min, {r("quantile_cont(value, 0.25)")} AS q25, {r("quantile_cont(value, 0.5)")} AS q50,
  {r("quantile_cont(value, 0.75)")} AS q75, {r("max(value)")} AS max,
  {r("avg(value)")} AS mean, {r("stddev_samp(value)")} AS std, {r("any_value(top)")} AS top,
  any_value(top_count) AS top_count
FROM (SELECT *, first_value(value) OVER (PARTITION BY {keys} ORDER BY (value IS NULL), n DESC, value) AS top,
             first_value(n) OVER (PARTITION BY {keys} ORDER BY (value IS NULL), n DESC, value) AS top_count
      FROM (SELECT *, count(*) OVER (PARTITION BY {keys}, value) AS n FROM ({src}))) GROUP BY {keys}"""


QUALITY_ROWS_SQL = "\nUNION ALL ".join(
    f"SELECT CASE WHEN side = 'ref' THEN 'reference' ELSE 'current' END AS side, '{c}' AS col, "
    f"CAST({c} AS DOUBLE) AS value FROM ({DEMAND_SIDES_SQL})"
    for c in QUALITY_COLS
)


@register("a20_quality", _quality_sql(QUALITY_ROWS_SQL, "side"))
def a20_quality(spark, sf):
    ref, cur = demand_sides(spark, sf)
    return round_doubles(D.quality_by_side(ref, cur, QUALITY_COLS))


DEFECT_QUALITY_SQL = "\nUNION ALL ".join(
    f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS value FROM ({RAW_DEFECTS_SQL})" for c in QUALITY_COLS
)


@register("a20_quality_one_table", _quality_sql(DEFECT_QUALITY_SQL, ""))
def a20_quality_one_table(spark, sf):
    return round_doubles(D.quality_table(raw_with_defects(demand_view(spark, sf)), QUALITY_COLS))


@register("d6_monitoring_tables", _quality_sql(QUALITY_ROWS_SQL, "side"))
def d6_monitoring_tables(spark, sf):
    """The quality table of a written run, read back."""
    ref, cur = demand_sides(spark, sf)
    run = D.monitoring_run(ref, cur, numeric=NUMERIC, categorical=CATEGORICAL, quality_cols=QUALITY_COLS)
    path = scratch_dir(spark, "monitoring")
    D.write_monitoring_run(run, path, "20240101_000000")
    return round_doubles(spark.read.parquet(f"{path}/quality_20240101_000000"))


@register(
    "d6_monitoring",
    _columns_sql()
    + f""", qs AS ({DEMAND_SIDES_SQL}),
qu AS ({" UNION ALL ".join(f"SELECT side, '{c}' AS col FROM qs" for c in QUALITY_COLS)})
SELECT CAST(count(*) AS BIGINT) AS number_of_columns,
  CAST(count(*) FILTER (WHERE drift_detected) AS BIGINT) AS number_of_drifted_columns,
  {r("count(*) FILTER (WHERE drift_detected) / count(*)")} AS share_of_drifted_columns,
  count(*) FILTER (WHERE drift_detected) / count(*) >= {D.DATASET_SHARE} AS dataset_drift,
  COALESCE(string_agg("column", ',' ORDER BY "column") FILTER (WHERE drift_detected), '') AS drifted_features,
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT side, col FROM qu)) AS quality_rows
FROM cols""",
)
def d6_monitoring(spark, sf):
    """Status row of a full run: dataset drift summary + number of quality rows."""
    ref, cur = demand_sides(spark, sf)
    run = D.monitoring_run(ref, cur, numeric=NUMERIC, categorical=CATEGORICAL, quality_cols=QUALITY_COLS)
    q = run["quality"].agg(F.count(F.lit(1)).cast("bigint").alias("quality_rows"))
    status = run["dataset"].withColumn("quality_rows", q.scalar())
    return round_doubles(status)


def _stored_reference(spark, ref):
    """Counted in two halves that are merged, saved and read back."""
    store = FeatureStore(spark, scratch_dir(spark, "drift-reference"))
    half = F.pmod("product_id", F.lit(2)) == 0
    parts = [DR.fit_reference(ref.where(c), NUMERIC, CATEGORICAL, QUALITY_COLS) for c in (half, ~half)]
    parts[0].merge(parts[1]).save(store, "demand", "v1")
    return DR.load_reference(store, "demand")


@register(
    "d2_stored_reference",
    _columns_sql()
    + f""" SELECT "column", kind, stattest_name, {r('drift_score')} AS drift_score, drift_detected FROM cols""",
)
def d2_stored_reference(spark, sf):
    ref, cur = demand_sides(spark, sf)
    return round_doubles(DR.drift_against(_stored_reference(spark, ref), cur))


@register("d6_stored_reference", _quality_sql(QUALITY_ROWS_SQL, "side"))
def d6_stored_reference(spark, sf):
    """The quality table of a run against the stored reference."""
    ref, cur = demand_sides(spark, sf)
    return round_doubles(DR.monitoring_against(_stored_reference(spark, ref), cur)["quality"])
