"""Catalogue: feature store round trips (K1-K5), written under a fresh
folder inside the shared checkpoint location."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcast.functions.calendar import time_features
from sparkcast.operators import clean
from sparkcast.plans.catalog import register
from sparkcast.plans.q_features import _sql_calendar_basic
from sparkcast.plans.common import round_doubles
from sparkcast.session import scratch_dir
from sparkcast.sources.store import FeatureStore
from sparkcast.sources.tables import DEMAND_SQL, demand_view


def _store(spark) -> FeatureStore:
    return FeatureStore(spark, scratch_dir(spark, "feature-store"))


@register(
    "k1_save_load",
    f"SELECT *, {', '.join(_sql_calendar_basic())} FROM ({DEMAND_SQL})",
)
def k1_save_load(spark, sf):
    """Save the cleaned panel, load the latest version back."""
    st = _store(spark)
    st.save_features(clean.transform_data(demand_view(spark, sf)), "demand_clean", "v1")
    return st.load_features("demand_clean")


def _three_versions(spark, sf, st):
    d = demand_view(spark, sf)
    st.save_features(d, "demand", "v1")
    st.save_features(round_doubles(d.withColumns(time_features())), "demand", "v2")
    st.save_features(clean.transform_data(d), "demand", "v3")


@register(
    "k4_versions",
    f"""WITH d AS ({DEMAND_SQL})
SELECT 'v3' AS version, CAST(count(*) AS BIGINT) AS rows, CAST(17 AS BIGINT) AS columns FROM d
UNION ALL SELECT 'v2', CAST(count(*) AS BIGINT), CAST(26 AS BIGINT) FROM d
UNION ALL SELECT 'v1', CAST(count(*) AS BIGINT), CAST(10 AS BIGINT) FROM d""",
)
def k4_versions(spark, sf):
    st = _store(spark)
    _three_versions(spark, sf, st)
    return st.list_feature_versions("demand").select("version", "rows", "columns")


@register(
    "k5_trim",
    f"""WITH d AS ({DEMAND_SQL})
SELECT v AS version, CAST(count(*) AS BIGINT) AS rows, CAST(2 AS BIGINT) AS deleted
FROM d, (VALUES ('v3'), ('v4'), ('v5')) t(v) GROUP BY v""",
)
def k5_trim(spark, sf):
    """Save five versions, keep the newest three."""
    st = _store(spark)
    d = demand_view(spark, sf)
    for i in range(1, 6):
        st.save_features(d, "demand", f"v{i}")
    n = st.delete_old_versions("demand", keep_last=3)
    return st.list_feature_versions("demand").select(
        "version", "rows", F.lit(n).cast("bigint").alias("deleted")
    )


def _k3_sql() -> str:
    import json

    from sparkcast.functions.calendar import BASIC_CALENDAR_COLUMNS
    from sparkcast.sources.tables import RAW_COLUMNS

    names = json.dumps(RAW_COLUMNS + BASIC_CALENDAR_COLUMNS)
    return f"""SELECT 'demand' AS name, 'v3' AS version, CAST(count(*) AS BIGINT) AS rows,
  CAST(17 AS BIGINT) AS columns, '{names}' AS column_names, '{{}}' AS metadata
FROM ({DEMAND_SQL})"""


@register("k3_metadata", _k3_sql())
def k3_metadata(spark, sf):
    """Metadata row of the newest version (its timestamp and sequence left out)."""
    st = _store(spark)
    _three_versions(spark, sf, st)
    return st.get_feature_metadata("demand").select(
        "name", "version", "rows", "columns", "column_names", "metadata"
    )


def _k3_dtypes_sql() -> str:
    from sparkcast.sources.tables import RAW_SCHEMA

    return "\nUNION ALL ".join(
        f"SELECT 'v2' AS version, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS dtype"
        for f in RAW_SCHEMA.fields
    )


@register("k3_dtypes", _k3_dtypes_sql())
def k3_dtypes(spark, sf):
    """Column types from the metadata of a version that was saved twice."""
    st = _store(spark)
    d = demand_view(spark, sf)
    st.save_features(d.select("date", "price"), "demand", "v2")
    st.save_features(d, "demand", "v2")
    types = F.explode(F.from_json("dtypes", "map<string, string>")).alias("column_name", "dtype")
    return st.get_feature_metadata("demand", "v2").select("version", types)
