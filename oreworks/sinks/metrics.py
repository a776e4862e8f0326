"""Sizes, file counts and columns of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.sources.files import list_data_files


def table_location(spark: SparkSession, name: str) -> str:
    """Directory of a session-catalog table."""
    details = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first()
    if details is None:
        raise ValueError(f"table {name} has no location")
    return details["data_type"]


def table_details(spark: SparkSession, name: str) -> DataFrame:
    """All that the catalog knows: columns, partitioning, location, size. The size is
    brought up to date first, from the listing and without reading the table; Spark also
    goes by it when it chooses how to join."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    return spark.sql(f"DESCRIBE EXTENDED {name}")


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """``column, type`` of a table."""
    described = spark.sql(f"DESCRIBE TABLE {name}")
    # Partition columns are described twice, the second time below a heading.
    return (
        described.filter("col_name NOT LIKE '#%' AND col_name <> ''")
        .select(F.col("col_name").alias("column"), F.col("data_type").alias("type"))
        .distinct()
    )


def table_file_metrics(spark: SparkSession, tables: dict[str, list[str]]) -> DataFrame:
    """``label, files, bytes`` per label, each label standing for one or more tables.

    Only directories are listed; no table is read.
    """
    listed = None
    for label, names in tables.items():
        paths = [table_location(spark, name) for name in names]
        files = list_data_files(spark, *paths).select(F.lit(label).alias("label"), "length")
        listed = files if listed is None else listed.union(files)
    return listed.groupBy("label").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def layer_comparison(spark: SparkSession, before: list[str], after: list[str]) -> DataFrame:
    """One row: files and bytes of all source tables and of the result, and how many
    percent smaller the result is."""
    metrics = table_file_metrics(spark, {"before": before, "after": after})

    def of(label: str, metric: str):
        return F.coalesce(F.max(F.when(F.col("label") == label, F.col(metric))), F.lit(0))

    wanted = [(m, label) for label in ("before", "after") for m in ("files", "bytes")]
    row = metrics.agg(*[of(label, m).alias(f"{m}_{label}") for m, label in wanted])
    saved = (F.col("bytes_before") - F.col("bytes_after")) * 100.0
    return row.withColumn(
        "size_reduction_pct",
        F.coalesce(F.try_divide(saved, F.col("bytes_before")), F.lit(0.0)),
    )
