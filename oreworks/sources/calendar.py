"""A row per day, generated on the executors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The default calendar.
FIRST_DAY = dt.date(2020, 1, 1)
LAST_DAY = dt.date(2027, 12, 31)


def calendar_days(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """Column ``date``: every day from ``first`` to ``last``."""
    bounds = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return _days(bounds)


def calendar_span(df: DataFrame, date_column: str) -> DataFrame:
    """Column ``date``: every day of the calendar years that ``date_column`` touches."""
    day = F.to_date(date_column)
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).select(
        F.trunc("first", "year").alias("first"),
        F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1).alias("last"),
    )
    return _days(bounds)


def _days(bounds: DataFrame) -> DataFrame:
    one_day = F.make_dt_interval(F.lit(1))
    return bounds.select(F.explode(F.sequence("first", "last", one_day)).alias("date"))
