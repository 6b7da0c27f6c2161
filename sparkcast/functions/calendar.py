"""Calendar and cyclic columns (F1-F3), all JVM-side expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _flag(cond: Column) -> Column:
    return cond.cast("bigint")


BASIC_CALENDAR_COLUMNS = ["year", "month", "day", "day_of_week", "is_weekend", "week_of_year", "quarter"]


def basic_calendar(date_col: str = "date") -> dict[str, Column]:
    """year, month, day, day_of_week (0=Mon), is_weekend, ISO week, quarter."""
    d = F.col(date_col)
    dow = F.weekday(d).cast("bigint")
    return {
        "year": F.year(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "day": F.dayofmonth(d).cast("bigint"),
        "day_of_week": dow,
        "is_weekend": _flag(dow >= 5),
        "week_of_year": F.weekofyear(d).cast("bigint"),
        "quarter": F.quarter(d).cast("bigint"),
    }


def full_calendar(date_col: str = "date") -> dict[str, Column]:
    """F1 plus day_of_year and month/quarter start/end flags.

    ``trunc(d, 'QUARTER')`` is used, not ``'Q'`` (which yields NULL).
    """
    d = F.col(date_col)
    q_start = F.trunc(d, "QUARTER")
    dow = F.weekday(d).cast("bigint")
    return {
        "year": F.year(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "day": F.dayofmonth(d).cast("bigint"),
        "day_of_week": dow,
        "day_of_year": F.dayofyear(d).cast("bigint"),
        "week_of_year": F.weekofyear(d).cast("bigint"),
        "quarter": F.quarter(d).cast("bigint"),
        "is_weekend": _flag(dow >= 5),
        "is_month_start": _flag(F.dayofmonth(d) == 1),
        "is_month_end": _flag(d == F.last_day(d)),
        "is_quarter_start": _flag(d == q_start),
        "is_quarter_end": _flag(d == F.last_day(F.add_months(q_start, 2))),
    }


def cyclic(date_col: str = "date") -> dict[str, Column]:
    """sin/cos encodings of weekday (period 7) and month (period 12)."""
    d = F.col(date_col)
    dow = F.weekday(d).cast("double")
    month = F.month(d).cast("double")
    two_pi = F.lit(2 * math.pi)
    return {
        "day_of_week_sin": F.sin(two_pi * dow / 7),
        "day_of_week_cos": F.cos(two_pi * dow / 7),
        "month_sin": F.sin(two_pi * month / 12),
        "month_cos": F.cos(two_pi * month / 12),
    }


def time_features(date_col: str = "date") -> dict[str, Column]:
    """The 16 columns of ``create_time_features``."""
    out = full_calendar(date_col)
    out.update(cyclic(date_col))
    return out


# Weekday names, Monday first (index = day_of_week).
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def day_name(dow: Column) -> Column:
    """Code -> name through a literal array, no UDF."""
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), dow.cast("int") + 1)
