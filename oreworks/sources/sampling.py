"""Samples for cheap looks at big tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
#: Slots of a portable sample; the other one uses all 64 bits of the hash.
SLOTS = 1 << 60


def row_sample(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Each row with the given probability. Not for counting duplicates."""
    return df.sample(fraction=fraction, seed=seed)


def key_hash_sample(
    df: DataFrame, keys: Sequence[str], fraction: float, *, portable: bool = False
) -> DataFrame:
    """All rows of a ``fraction`` of the keys.

    Copies of a key are kept or left together, so counts of duplicates scale by
    ``1 / fraction``; a sample of rows would lose most pairs. The filter runs in
    the scan's stage, without a shuffle. ``portable`` hashes with MD5, slower but
    the same in any engine.
    """
    if fraction >= 1:
        return df
    if portable:
        return df.filter(_md5_slot(keys) < int(fraction * SLOTS))
    return df.filter(F.xxhash64(*keys) < int(fraction * (1 << 64)) - (1 << 63))


def _md5_slot(keys: Sequence[str]) -> Column:
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
