"""Helpers shared by the query catalogue and its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Floating results are compared after rounding to this many places on both
# sides: double sums depend on the order rows are added in.
#
# The rounding is ``round(x * 10^dp - c) / 10^dp`` in both engines, with
# c = (sqrt(5) - 2) / 2 (sqrt is correctly rounded in both):
# * ``round(x, dp)`` on a double breaks ties on the decimal text in Spark but
#   on the binary value in DuckDB; a scaled value below 2^52 whose text ends
#   in .5 is exactly .5 in binary, so both engines agree on it.
# * means of 2-decimal prices are often exact decimals that sit right on a
#   6-place tie (or on k + 1/3, k + 2/3 for counts divisible by 3), where
#   1 ulp of summation-order noise flips the result. The offset c moves the
#   ties to x * 10^dp = k + 0.618..., a binary fraction with a 2^50-ish
#   denominator that no mean of decimals over a realistic count can hit.
#   The result stays within 0.62 * 10^-dp of x.
DP = 6


def _offset():
    return (F.sqrt(F.lit(5.0)) - F.lit(2.0)) / F.lit(2.0)


def round_doubles(df: DataFrame, dp: int = DP) -> DataFrame:
    """Round every double column (query output shape for the oracle check)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            scale = float(10**dp)
            cols.append(
                (
                    F.round(F.col(f.name) * scale - _offset(), 0) / scale
                    + F.lit(0.0)
                ).alias(f.name)
            )
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def r(expr: str, dp: int = DP) -> str:
    """DuckDB: round a double; ``+ 0.0`` turns -0.0 into 0.0 like Spark."""
    return (
        f"(ROUND(CAST({expr} AS DOUBLE) * 1e{dp} - (sqrt(CAST(5 AS DOUBLE)) - 2) / 2)"
        f" / 1e{dp} + 0.0)"
    )
