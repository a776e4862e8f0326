"""Putting sources of different shape into one table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.operators.dedup import dedup_by_key

MERGED = "merged"


def union_by_name(sources: Sequence[DataFrame]) -> DataFrame:
    """All rows of all sources; a column that a source lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def merge_sources(
    sources: Sequence[DataFrame],
    keys: Sequence[str],
    *,
    order_by: Sequence[str] = (),
    merge: Callable[[Sequence[DataFrame]], DataFrame] = union_by_name,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Union (or ``merge``) the sources, keep one row per key, mark the result as merged."""
    rows = dedup_by_key(merge(sources), keys, order_by)
    return rows.drop(*drop).withColumn("data_source", F.lit(MERGED))


def unify_orders(legacy: DataFrame, new_system: DataFrame) -> DataFrame:
    """Cleaned orders of both systems. Each is unique on its own ``order_id``, so the
    pair (``source_system``, ``order_id``) is a key without another shuffle."""
    return legacy.unionByName(new_system)
