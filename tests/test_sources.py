import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from oreworks import sources
from oreworks.operators import dim_date
from oreworks.sources import (
    calendar_days,
    calendar_span,
    list_data_files,
    read_typed,
    row_sample,
    source_file_stats,
)

AB = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder)


def test_malformed_rows_are_null_and_kept_as_text(spark, tmp_path):
    path = write(tmp_path, "x.csv", "a,b\n1,2\nx,3\n")
    rows = read_typed(spark, path, AB, corrupt_column="bad").orderBy("b").collect()
    assert [tuple(r) for r in rows] == [(1, 2, None), (None, 3, "x,3")]
    rows = read_typed(spark, path, AB).orderBy("b").collect()
    assert [tuple(r) for r in rows] == [(1, 2), (None, 3)]


def test_header_in_another_order(spark, tmp_path):
    path = write(tmp_path, "x.csv", "b,a\n1,2\n")
    assert tuple(read_typed(spark, path, AB).first()) == (1, 2)
    with pytest.raises(Exception, match="(?i)header"):
        read_typed(spark, path, AB, strict_header=True).collect()


def test_file_without_header(spark, tmp_path):
    path = write(tmp_path, "x.csv", "1,2\n3,4\n")
    assert read_typed(spark, path, AB, header=False).count() == 2


def test_json_and_parquet(spark, tmp_path):
    path = write(tmp_path, "x.json", '{"a": 1, "b": 2}\n{"b": 3}\n{"a": "no"}\n')
    rows = read_typed(spark, path, AB, "json", corrupt_column="bad").collect()
    assert sorted(map(tuple, rows), key=repr) == [
        (1, 2, None), (None, 3, None), (None, None, '{"a": "no"}'),
    ]
    spark.range(3).select(F.col("id").cast("int").alias("a"), F.lit(1).alias("b")).write.parquet(
        str(tmp_path / "p")
    )
    wide = StructType([StructField("a", LongType()), StructField("b", LongType())])
    assert read_typed(spark, str(tmp_path / "p"), wide, "parquet").groupBy().sum("a").first()[0] == 3


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        read_typed(spark, str(tmp_path), AB, "orc")


def test_only_files_of_the_format_are_read(spark, tmp_path):
    write(tmp_path, "x.csv", "a,b\n1,2\n")
    write(tmp_path, "._x.csv", "a,b\n8,8\n")
    write(tmp_path, "notes.txt", "a,b\n9,9\n")
    (tmp_path / "deep").mkdir()
    write(tmp_path / "deep", "y.json", "{}")
    assert read_typed(spark, str(tmp_path), AB).count() == 1
    stats = source_file_stats(list_data_files(spark, str(tmp_path))).collect()
    assert sorted(map(tuple, stats)) == [("csv", 1, 8), ("json", 1, 2)]


def test_listing_opens_no_file(spark, tmp_path):
    write(tmp_path, "x.csv", "a,b\n")
    plan = list_data_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_default_calendar(spark):
    days = dim_date(calendar_days(spark))
    assert days.count() == days.select("date_key").distinct().count() == 2922
    assert days.filter("month = 2 AND day = 29").count() == 2


def test_calendar_of_a_column_covers_whole_years(spark):
    df = spark.createDataFrame([(dt.date(2023, 5, 1),), (dt.date(2024, 2, 1),)], "d date")
    span = calendar_span(df, "d").agg(F.min("date"), F.max("date"), F.count("date")).first()
    assert tuple(span) == (dt.date(2023, 1, 1), dt.date(2024, 12, 31), 731)


def test_row_sample_repeats(spark):
    df = spark.range(10_000)
    first = row_sample(df, 0.1).count()
    assert 800 < first < 1200
    assert row_sample(df, 0.1).count() == first


def test_folders_below_are_listed_and_read_alike(spark, tmp_path):
    one = spark.createDataFrame([(1,), (2,)], "k int").coalesce(1)
    one.write.csv(f"{tmp_path}/2024", header=True)
    one.write.mode("append").csv(str(tmp_path), header=True)
    for recursive, files in ((True, 2), (False, 1)):
        listed = sources.list_data_files(spark, str(tmp_path), recursive=recursive)
        assert listed.count() == files
        read = sources.read_typed(spark, str(tmp_path), one.schema, recursive=recursive)
        assert read.count() == 2 * files


def test_small_fractions_of_keys(spark):
    keys = spark.range(4_000_000).toDF("k")
    found = sources.key_hash_sample(keys, ["k"], 5e-6).count()
    assert 5 <= found <= 50
    assert sources.key_hash_sample(keys, ["k"], 1.0).count() == 4_000_000
    third = sources.key_hash_sample(keys, ["k"], 1 / 3).count()
    assert abs(third - 4_000_000 / 3) < 6_000
