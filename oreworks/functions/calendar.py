"""Calendar attributes and date differences.

Whatever depends on today takes ``as_of``, so a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreworks.functions.text import _col

# Weekend days (1 = Sunday), months of each season, start of the fiscal year.
WEEKEND = (1, 7)
SEASONS = {
    "is_winter": (12, 1, 2),
    "is_spring": (3, 4, 5),
    "is_summer": (6, 7, 8),
    "is_fall": (9, 10, 11),
}
FISCAL_START_MONTH = 7


def _fiscal_year(day: Column) -> Column:
    return F.year(F.add_months(day, 13 - FISCAL_START_MONTH))


_PARTS = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "day": F.dayofmonth,
    "day_of_week": F.dayofweek,
    "week_of_year": F.weekofyear,
    "month_name": lambda day: F.date_format(day, "MMMM"),
    "day_name": lambda day: F.date_format(day, "EEEE"),
    "is_weekend": lambda day: F.dayofweek(day).isin(*WEEKEND),
    **{
        flag: lambda day, months=months: F.month(day).isin(*months)
        for flag, months in SEASONS.items()
    },
    "fiscal_year": _fiscal_year,
}

CALENDAR_COLUMNS = ("date_key", "date", *_PARTS)


def calendar_columns(day: Column | str) -> list[Column]:
    """The attributes of a calendar table, from its date column."""
    day = _col(day)
    return [
        day.alias("date_key"),
        day.alias("date"),
        *(part(day).alias(name) for name, part in _PARTS.items()),
    ]


def age_in_years(born: Column | str, as_of: Column) -> Column:
    """Difference of the calendar years, one too many before the birthday."""
    return F.year(as_of) - F.year(_col(born))


def age_exact(born: Column | str, as_of: Column) -> Column:
    """Completed years."""
    return F.floor(F.months_between(as_of, _col(born)) / 12).cast("int")


def days_since(day: Column | str, as_of: Column) -> Column:
    """Days from ``day`` to ``as_of``."""
    return F.date_diff(as_of, _col(day))
