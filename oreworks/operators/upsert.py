"""Merging a batch into a table by key, as joins.

NULLs in keys equal each other, as in deduplication, so a repeated merge adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after the merge: rows of ``source``, and of ``target`` where no source
    row has their key. Keys of ``source`` must be unique (``require_unique_keys``)."""
    return without_keys(target, source, keys).unionByName(source)


def without_keys(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is not among those of ``other``, which are mostly unique.

    Only the keys of ``other`` are shuffled, or broadcast when they are few. Both sides
    reach the join straight from their shuffle, which lets adaptive execution split a
    key that holds much of ``rows``.
    """
    return rows.alias("r").join(other.select(*keys).alias("o"), same_keys(keys), "left_anti")


def same_keys(keys: Sequence[str]) -> Column:
    """Do the rows aliased r and o have one key?"""
    return reduce(and_, [F.col(f"r.`{k}`").eqNullSafe(F.col(f"o.`{k}`")) for k in keys])


def only_new_keys(batch: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a batch of unique keys that a table does not hold yet.

    The table may repeat a key any number of times: its keys are made distinct, first
    within each task, then in the partitions that the join needs anyway.
    """
    return without_keys(batch, table.select(*keys).distinct(), keys)
