"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """Rows that should have had different keys."""


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    *,
    keep: str = "first",
    copies: str | None = None,
) -> DataFrame:
    """Keep the first (or last) row of each key by ``order_by``, then by all other
    columns, so the same input always leaves the same rows. NULLs sort first, and
    rows whose keys are NULL count as equal.

    An aggregate rather than a window: every task first reduces its own rows to
    one per key, so a key that holds a third of the table is shuffled as one row
    per task. Only columns that can be compared may be present (no maps). ``copies``
    names a column for the number of rows that each kept row stands for.
    """
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    rest = [*order_by, *(c for c in df.columns if c not in keys and c not in order_by)]
    if not rest:
        return df.groupBy(*keys).agg(*counted) if counted else df.distinct()
    best = F.min if keep == "first" else F.max
    kept = df.groupBy(*keys).agg(best(F.struct(*rest)).alias("kept"), *counted)
    columns = [c if c in keys else F.col("kept")[c].alias(c) for c in df.columns]
    return kept.select(*columns, *([copies] if copies else []))


def require_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail if two rows share a key. NULLs in keys equal each other, as in merges.

    Runs a job that reads the key columns only and shuffles them pre-counted.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    example = repeated.first()
    if example:
        raise DuplicateKeys(f"keys {list(keys)} are not unique, for example {example}")


def unique_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, as keys and a struct ``row`` of all other columns. The query that uses them
    fails if two share a key, NULLs being equal; no job of its own is needed."""
    rest = F.struct(*[c for c in df.columns if c not in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first(rest).alias("row"))
    refused = F.raise_error(F.lit(f"keys {list(keys)} of the batch are not unique"))
    return counted.select(*keys, F.when(F.col("n") == 1, F.col("row")).otherwise(refused).alias("row"))
