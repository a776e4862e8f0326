"""Data-quality checks. Results are tables, computed where the data is."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType

from oreworks.sources.sampling import SEED, key_hash_sample, row_sample

SKEW_THRESHOLD = 2.0
TOP_PARTITIONS = 20
#: Standard errors between an estimate from a sample and its bounds.
BOUND = 4.0
# check, column, metric, aggregate
Metric = tuple[str, str, str, Column]


def null_report(df: DataFrame) -> DataFrame:
    """``column, null_count, null_pct`` of every column, in one pass."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            _nulls(c).alias("null_count"),
            _percent(_nulls(c), _rows()).alias("null_pct"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*rows).alias("report")).select(F.inline("report"))


def value_range_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, n, mean, stddev, min, max, negatives`` of numeric columns, in one pass."""
    columns = _numeric(df) if columns is None else columns
    rows = [
        F.struct(F.lit(c).alias("column"), *[agg.alias(name) for name, agg in _range(c).items()])
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("report")).select(F.inline("report"))


def exact_range_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n, min, max, total, negatives`` of whole-number and decimal columns, in one
    pass. Minimum, maximum and total are text with all digits: no value goes through a double,
    which would round 2**53 + 1. A total of more than 38 digits is an error."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    inexact = [c for c in columns if not isinstance(kinds[c], (IntegralType, DecimalType))]
    if inexact:
        raise ValueError(f"columns {inexact} hold no whole numbers or decimals")

    def wide(c: str) -> Column:
        scale = kinds[c].scale if isinstance(kinds[c], DecimalType) else 0
        return F.col(c).cast(DecimalType(38, scale))

    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.min(c).cast("string").alias("min"),
            F.max(c).cast("string").alias("max"),
            F.sum(wide(c)).cast("string").alias("total"),
            F.count_if(F.col(c) < 0).alias("negatives"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("report")).select(F.inline("report"))


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``total_rows, unique_rows, duplicate_rows, duplicate_pct``; NULL keys are equal.

    One scan of the key columns: rows are counted per key, then keys and rows.
    """
    per_key = df.groupBy(*keys).agg(_rows().alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(total.alias("total_rows"), _rows().alias("unique_rows")).select(
        "total_rows",
        "unique_rows",
        (F.col("total_rows") - F.col("unique_rows")).alias("duplicate_rows"),
        _percent(F.col("total_rows") - F.col("unique_rows"), F.col("total_rows")).alias(
            "duplicate_pct"
        ),
    )


def partition_sizes(df: DataFrame, partition: Column | str) -> DataFrame:
    """``partition, row_count`` for each value of a column."""
    value = F.col(partition) if isinstance(partition, str) else partition
    return df.groupBy(value.cast("string").alias("partition")).agg(_rows().alias("row_count"))


def largest_partitions(sizes: DataFrame, top: int = TOP_PARTITIONS) -> DataFrame:
    """The biggest partitions, biggest first."""
    return sizes.orderBy(F.desc("row_count"), "partition").limit(top)


def skew_stats(sizes: DataFrame) -> DataFrame:
    """One row about ``partition_sizes``. The exact median is held as a histogram of
    sizes; N rows have at most about sqrt(2 N) different ones."""
    stats = sizes.agg(
        _rows().alias("partitions"),
        F.max("row_count").alias("max"),
        F.min("row_count").alias("min"),
        F.avg("row_count").alias("mean"),
        F.median("row_count").alias("median"),
    )
    return stats.withColumn("skew_factor", F.try_divide("max", "median"))


def skewed_partitions(sizes: DataFrame, threshold: float = SKEW_THRESHOLD) -> DataFrame:
    """``partition, row_count, factor`` of those above ``threshold`` times the median.

    The median is a scalar subquery, so no join; it reuses the shuffle of ``sizes``.
    """
    median = sizes.agg(F.median("row_count")).scalar()
    return sizes.withColumn("factor", F.col("row_count") / median).filter(
        F.col("factor") > threshold
    )


def quality_report(
    df: DataFrame, keys: Sequence[str], partition: Column | str | None = None
) -> DataFrame:
    """``check, column, metric, value``: all checks of a table.

    NULLs and ranges share one scan; duplicates scan the keys, skew the partition.
    """
    metrics: list[Metric] = []
    for c in df.columns:
        metrics.append(("nulls", c, "null_count", _nulls(c)))
        metrics.append(("nulls", c, "null_pct", _percent(_nulls(c), _rows())))
    for c in _numeric(df):
        metrics.extend(("ranges", c, name, agg) for name, agg in _range(c).items())
    parts = [_long(df, metrics)]

    duplicates = duplicate_report(df, keys)
    parts.append(_one_row_as_long(duplicates, "duplicates", ",".join(keys)))
    if partition is not None:
        stats = skew_stats(partition_sizes(df, partition))
        name = partition if isinstance(partition, str) else "partition"
        parts.append(_one_row_as_long(stats, "skew", name))
    return reduce(DataFrame.unionByName, parts)


def quality_estimate(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = (),
    fraction: float = 0.01,
    *,
    portable: bool = False,
) -> DataFrame:
    """``metric, estimate``: duplicates, and NULLs of ``columns``, from a part of the keys."""
    per_key = (
        key_hash_sample(df, keys, fraction, portable=portable)
        .groupBy(*keys)
        .agg(_rows().alias("n"), *[_nulls(c).alias(f"nulls_{i}") for i, c in enumerate(columns)])
    )
    totals = {"duplicate_rows": F.sum("n") - _rows()}
    for i, c in enumerate(columns):
        totals[f"nulls:{c}"] = F.sum(f"nulls_{i}")
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            (F.coalesce(total, F.lit(0)) / F.lit(fraction)).alias("estimate"),
        )
        for name, total in totals.items()
    ]
    return per_key.agg(F.array(*rows).alias("report")).select(F.inline("report"))


def row_estimate(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    fraction: float = 0.01,
    seed: int = SEED,
) -> DataFrame:
    """``metric, estimate, low, high`` from a sample of rows: their number, the NULLs of
    ``columns``, and with ``keys`` how many keys there are.

    What is counted k times in the sample is there about k / fraction times. The bounds are
    four standard errors away: the square root of a count varies by half of one. Keys that the
    sample has once stand for between 1 and 1 / fraction others, of which the estimate takes
    the geometric mean; a key that it has more often is likely to have been the only one.
    """
    sample = row_sample(df, fraction, seed)
    counts = {"rows": _rows(), **{f"nulls:{c}": _nulls(c) for c in columns}}
    cells = [_estimated(F.lit(name), count, fraction) for name, count in counts.items()]
    found = sample.agg(F.array(*cells).alias("report")).select(F.inline("report"))
    if not keys:
        return found
    once = F.count_if(F.col("n") == 1)
    seen = sample.groupBy(*keys).agg(_rows().alias("n")).agg(once.alias("once"), _rows().alias("seen"))
    more = F.col("seen") - F.col("once")
    distinct = seen.select(
        F.lit(f"distinct:{','.join(keys)}").alias("metric"),
        (more + F.col("once") / F.sqrt(F.lit(fraction))).alias("estimate"),
        F.col("seen").cast("double").alias("low"),
        (more + _high(F.col("once"), fraction)).alias("high"),
    )
    return found.unionByName(distinct)


def _high(count: Column, fraction: float) -> Column:
    return F.pow(F.sqrt(count + 1) + BOUND / 2, F.lit(2.0)) / fraction


def _estimated(metric: Column, count: Column, fraction: float) -> Column:
    low = F.pow(F.greatest(F.sqrt(count) - BOUND / 2, F.lit(0.0)), F.lit(2.0)) / fraction
    return F.struct(
        metric.alias("metric"),
        (count / F.lit(fraction)).alias("estimate"),
        low.alias("low"),
        _high(count, fraction).alias("high"),
    )


def _rows() -> Column:
    return F.count(F.lit(1))


def _nulls(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def _percent(part: Column, whole: Column) -> Column:
    """Of nothing, nothing: 0 and not an error."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _range(c: str) -> dict[str, Column]:
    value = F.col(c).cast("double")
    return {
        "n": F.count(value),
        "mean": F.avg(value),
        "stddev": F.stddev_samp(value),
        "min": F.min(value),
        "max": F.max(value),
        "negatives": F.count_if(value < 0),
    }


def _cell(check: str, column: str, metric: str, value: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
    )


def _long(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    cells = F.array(*[_cell(*metric) for metric in metrics])
    return df.agg(cells.alias("report")).select(F.inline("report"))


def _one_row_as_long(row: DataFrame, check: str, column: str) -> DataFrame:
    cells = F.array(*[_cell(check, column, metric, F.col(metric)) for metric in row.columns])
    return row.select(F.inline(cells))
