"""Validation rules over tables.

A rule is a name, a column and a boolean ``Column`` that is true on a
violating row (X1: a user rule is just another such expression). All row
rules of a schema run in one aggregate (one scan, ``count_if`` per rule) and
come back as a long table (rule, column, violations). The key-uniqueness
rule is a ``groupBy(key)`` count, partially aggregated map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.functions.stats import NUMERIC_TYPES
from sparkcast.sources.tables import FLOAT_COLUMNS, INT_COLUMNS, KEY, RAW_COLUMNS


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    violated: Column  # true on a violating row


def _c(name: str) -> Column:
    return F.col(name)


def not_null_rules(columns: Sequence[str] = RAW_COLUMNS) -> list[Rule]:
    """V1."""
    return [Rule("not_null", c, _c(c).isNull()) for c in columns]


def _outside(c: str, lo=None, hi=None, lo_open=False) -> Column:
    x = _c(c)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | ((x <= lo) if lo_open else (x < lo))
    if hi is not None:
        bad = bad | (x > hi)
    return x.isNotNull() & bad


# The raw schema's value rules.
RANGE_RULES = [
    ("product_id", 1000, 1100, False),
    ("store_id", 1, 10, False),
    ("historical_sales", 0, None, False),
    ("price", 0, 100, True),
    ("economic_index", 0, 200, True),
    ("target_demand", 0, None, False),
]
ALLOWED_SETS = [
    ("category_id", [1, 2, 3, 4, 5]),
    ("promotion_flag", [0, 1]),
    ("holiday_flag", [0, 1]),
]


def range_rules() -> list[Rule]:
    """V2: ge/le (price and index: gt 0)."""
    return [
        Rule("greater_than" if lo_open else "in_range", c, _outside(c, lo, hi, lo_open))
        for c, lo, hi, lo_open in RANGE_RULES
    ]


def allowed_set_rules() -> list[Rule]:
    """V3."""
    return [Rule("isin", c, _c(c).isNotNull() & ~_c(c).isin(vals)) for c, vals in ALLOWED_SETS]


def raw_rules() -> list[Rule]:
    return not_null_rules() + range_rules() + allowed_set_rules()


def processed_rules(df: DataFrame) -> list[Rule]:
    """Processed schema: types and not-null only; extra columns allowed."""
    return not_null_rules([c for c in RAW_COLUMNS if c in df.columns])


def rule_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, column, violations) for row rules, all in one aggregate."""
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, column string, violations bigint")
    aggs = [F.count_if(r.violated).alias(f"_r{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    stacked = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.lit(r.column).alias("column"),
                    F.col(f"_r{i}").cast("bigint").alias("violations"),
                )
                for i, r in enumerate(rules)
            ]
        )
    )
    return wide.select(stacked.alias("v")).select("v.*")


def duplicate_key_rows(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """V4: rows that repeat an earlier (date, product_id, store_id).

    One row: rule, column, violations = sum(count - 1) over keys seen more
    than once (pandas ``duplicated`` marks all copies but the first).
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0))
        .cast("bigint")
        .alias("violations")
    ).select(
        F.lit("unique_key").alias("rule"),
        F.lit(",".join(key)).alias("column"),
        "violations",
    )


RAW_TYPES = {
    "date": T.DateType(),
    **{c: T.LongType() for c in INT_COLUMNS},
    **{c: T.DoubleType() for c in FLOAT_COLUMNS},
}


def coerce(df: DataFrame, types: dict = RAW_TYPES) -> DataFrame:
    """V6: cast to the declared types with ``try_cast`` (NULL on failure)."""
    out = []
    for f in df.schema.fields:
        t = types.get(f.name)
        if t is None or f.dataType == t:
            out.append(F.col(f.name))
        elif isinstance(t, T.DateType):
            out.append(F.try_to_date(F.col(f.name).cast("string")).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(t).alias(f.name))
    return df.select(*out)


def coercion_rules(df: DataFrame, types: dict = RAW_TYPES) -> list[Rule]:
    """V6: a value that was present but did not survive the cast."""
    rules = []
    for f in df.schema.fields:
        t = types.get(f.name)
        if t is None or f.dataType == t:
            continue
        src = F.col(f.name)
        if isinstance(t, T.DateType):
            cast = F.try_to_date(src.cast("string"))
        else:
            cast = src.try_cast(t)
        rules.append(Rule("coerce", f.name, src.isNotNull() & cast.isNull()))
    return rules


def strict_columns(df: DataFrame, expected: Sequence[str] = RAW_COLUMNS, strict: bool = True) -> list[str]:
    """V5: schema compare on the driver (no job). Returns problems found."""
    have, want = set(df.columns), set(expected)
    problems = [f"missing column {c}" for c in expected if c not in have]
    if strict:
        problems += [f"unexpected column {c}" for c in df.columns if c not in want]
    return problems


def violations(df: DataFrame, schema_type: str = "raw") -> DataFrame:
    """All violations of the raw (or processed) schema as one long table.

    Coercion failures are counted on the input; value rules run on the
    coerced values.
    """
    if schema_type not in ("raw", "processed"):
        raise ValueError(f"Unknown schema type: {schema_type}")
    cast = coerce(df)
    parts = []
    coerce_rules = coercion_rules(df)
    if coerce_rules:
        parts.append(rule_violations(df, coerce_rules))
    if schema_type == "raw":
        parts.append(rule_violations(cast, raw_rules()))
        parts.append(duplicate_key_rows(cast))
    else:
        parts.append(rule_violations(cast, processed_rules(cast)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ValidationError(ValueError):
    pass


def validate_data(df: DataFrame, schema_type: str = "raw") -> DataFrame:
    """V7: raise if any rule fails, else return the coerced frame."""
    ok, message = validate_to_result(df, schema_type, raise_error=True)
    return coerce(df)


def validate_to_result(df: DataFrame, schema_type: str = "raw", raise_error: bool = False):
    """V8: (ok, message); validates for real (Q1)."""
    problems = strict_columns(df, RAW_COLUMNS, strict=(schema_type == "raw"))
    if schema_type == "processed":
        problems = [p for p in problems if p.startswith("missing")]
    if problems:
        msg = "; ".join(problems)
        if raise_error:
            raise ValidationError(msg)
        return False, msg
    # one row per failing rule (bounded by the rule count), in a fixed order
    bad = violations(df, schema_type).where(F.col("violations") > 0).orderBy("rule", "column").collect()
    if bad:
        msg = "; ".join(f"{r['rule']}({r['column']}): {r['violations']}" for r in bad)
        if raise_error:
            raise ValidationError(msg)
        return False, msg
    return True, "Validation passed"


def validation_report(df: DataFrame) -> DataFrame:
    """V9: per column dtype, nulls, null % (2 dp), distinct non-null count,
    and for numeric columns min, max, mean, sample std."""
    from sparkcast.operators.profile import distinct_counts

    n = F.count(F.lit(1))
    aggs = [n.alias("_rows")]
    numeric = []
    for f in df.schema.fields:
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"{f.name}__nulls"))
        if isinstance(f.dataType, NUMERIC_TYPES):
            numeric.append(f.name)
            aggs += [
                F.min(c).cast("double").alias(f"{f.name}__min"),
                F.max(c).cast("double").alias(f"{f.name}__max"),
                F.avg(c).alias(f"{f.name}__mean"),
                F.stddev_samp(c).alias(f"{f.name}__std"),
            ]
    wide = df.agg(*aggs)
    dnull = F.lit(None).cast("double")
    rows = []
    for f in df.schema.fields:
        c = f.name
        is_num = c in numeric
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col(f"{c}__nulls").cast("bigint").alias("null_count"),
                F.round(F.try_divide(F.col(f"{c}__nulls") * 100.0, F.col("_rows")), 2).alias(
                    "null_percentage"
                ),
                (F.col(f"{c}__min") if is_num else dnull).alias("min"),
                (F.col(f"{c}__max") if is_num else dnull).alias("max"),
                (F.col(f"{c}__mean") if is_num else dnull).alias("mean"),
                (F.col(f"{c}__std") if is_num else dnull).alias("std"),
            )
        )
    report = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    # both sides hold one row per column
    return report.join(distinct_counts(df), "column", "left").select(
        "column",
        "dtype",
        "null_count",
        "null_percentage",
        F.coalesce("unique", F.lit(0).cast("bigint")).alias("unique_count"),
        "min",
        "max",
        "mean",
        "std",
    )


# --------------------------------------------------------------------------
# Scoring request rules
# --------------------------------------------------------------------------

REQUEST_FIELDS = [
    "prediction_date",
    "product_id",
    "category_id",
    "store_id",
    "historical_sales",
    "price",
    "promotion_flag",
    "holiday_flag",
    "economic_index",
]


def request_rule_list() -> list[tuple[str, Column]]:
    """(reason, violated) for one request row."""
    rules = [(f"{c} is required", F.col(c).isNull()) for c in REQUEST_FIELDS]
    rules += [
        ("product_id must be >= 1", F.col("product_id") < 1),
        ("category_id must be >= 1", F.col("category_id") < 1),
        ("store_id must be >= 1", F.col("store_id") < 1),
        ("historical_sales must be >= 0", F.col("historical_sales") < 0),
        ("price must be > 0", F.col("price") <= 0),
        ("promotion_flag must be 0 or 1", ~F.col("promotion_flag").between(0, 1)),
        ("holiday_flag must be 0 or 1", ~F.col("holiday_flag").between(0, 1)),
    ]
    return rules


def request_reasons(requests: DataFrame) -> DataFrame:
    """Adds ``reasons``: array of failed rule texts (empty when valid). Row-local."""
    reasons = F.filter(
        F.array(*[F.when(F.coalesce(v, F.lit(False)), F.lit(t)) for t, v in request_rule_list()]),
        lambda x: x.isNotNull(),
    )
    return requests.withColumn("reasons", reasons)


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) -- no batch size limit on a table."""
    tagged = request_reasons(requests)
    valid = tagged.where(F.size("reasons") == 0).drop("reasons")
    rejected = tagged.where(F.size("reasons") > 0)
    return valid, rejected
