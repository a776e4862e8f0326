"""Typed scans of raw files, and what a raw folder holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FORMATS = ("csv", "parquet", "json")


def read_typed(
    spark: SparkSession,
    path: str,
    schema: StructType,
    file_format: str = "csv",
    *,
    header: bool = True,
    strict_header: bool = False,
    corrupt_column: str | None = None,
    file_glob: str | None = None,
    recursive: bool = True,
) -> DataFrame:
    """Scan a folder, and those below it if ``recursive``, with a given schema; nothing is
    inferred.

    ``strict_header`` fails when a CSV header names other columns, or the same
    in another order. ``corrupt_column`` keeps the text of records that do not
    fit the schema next to the NULLs they leave.
    """
    if file_format not in FORMATS:
        raise ValueError(f"file format {file_format!r} is none of {FORMATS}")
    reader = spark.read.format(file_format)
    reader = reader.option("pathGlobFilter", file_glob or f"*.{file_format}")
    reader = reader.option("recursiveFileLookup", recursive)
    if file_format == "csv":
        reader = reader.option("header", header).option("enforceSchema", not strict_header)
    if corrupt_column and file_format != "parquet":
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).load(path)


def list_data_files(spark: SparkSession, *paths: str, recursive: bool = True) -> DataFrame:
    """``path, length, format`` of the data files in the paths, and below if ``recursive``.

    Only the listing is read: pruning the content column keeps files unopened.
    Names that begin with a dot or an underscore are never listed.
    """
    suffix = rf"\.({'|'.join(FORMATS)})$"
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .load(list(paths))
        .select("path", "length", F.regexp_extract("path", suffix, 1).alias("format"))
    )
    return files.filter(F.col("format") != "")


def source_file_stats(files: DataFrame) -> DataFrame:
    """Number and total size of the listed files, per format."""
    return files.groupBy("format").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
