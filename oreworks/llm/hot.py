"""Joins of many rows with one row per key, where one key may have a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more than one in so many rows; there are fewer such keys than that.
HOT_SHARE = 4_096


def meet(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """rows.join(found, key): found has a row per key, and n, how many rows have it.

    Hot keys, fewer than HOT_SHARE, are broadcast, so that their rows stay where they are.
    All others are shuffled by the key. found is read three times: cut it before. Rows with
    a null key, or a key that found lacks, are left out.
    """
    total = found.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_SHARE > total
    near = rows.join(F.broadcast(found.where(hot)), key)
    far = rows.join(F.broadcast(found.where(hot).select(key)), key, "left_anti")
    return near.unionByName(far.join(found.where(~hot), key))
