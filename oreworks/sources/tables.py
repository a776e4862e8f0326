"""Reading several catalog tables at once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def read_tables(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame]:
    """Table name to its (lazy) DataFrame."""
    return {name: spark.table(name) for name in names}
