import uuid

import pytest
from pyspark.sql import functions as F

from oreworks import sinks
from oreworks.operators.dedup import DuplicateKeys
from oreworks.sinks import Layout
from oreworks import operators as op
from oreworks.operators.scd import CLOSES, scd2_steps
from oreworks.sinks.tables import current_layout, merge_into, merge_type1, merge_type2


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path}'")
    return name


def values(spark, name, *columns):
    return sorted((tuple(r) for r in spark.table(name).select(*columns).collect()), key=repr)


def test_replace_changes_rows_schema_and_partitions(spark, schema):
    name = f"{schema}.t"
    done = sinks.replace_table(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    assert (done.expected, done.actual) == (1, 1)
    again = spark.createDataFrame(
        [("007", 1.5, None), ("8", None, "x")], "p string, d double, q string"
    )
    sinks.replace_table(again, name, Layout(partition_by=("p", "q")))
    assert values(spark, name, "p", "d", "q") == [("007", 1.5, None), ("8", None, "x")]
    assert dict(spark.table(name).dtypes) == {"d": "double", "p": "string", "q": "string"}
    assert current_layout(spark, name).partition_by == ("p", "q")


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, schema):
    name = f"{schema}.t"
    sinks.replace_table(spark.range(5).toDF("k"), name)
    before = spark.table(name)
    sinks.replace_table(before.filter("k > 1"), name)
    assert spark.table(name).count() == 3


def test_failed_write_leaves_the_table(spark, schema):
    name = f"{schema}.t"
    sinks.replace_table(spark.range(5).toDF("k"), name)
    bad = spark.range(5).select(
        F.when(F.col("id") < 3, F.col("id"))
        .otherwise(F.raise_error(F.lit("stop")).cast("bigint"))
        .alias("k")
    )
    with pytest.raises(Exception, match="stop"):
        sinks.replace_table(bad, name)
    assert spark.table(name).count() == 5


def test_empty_table(spark, schema):
    name = f"{schema}.t"
    empty = spark.createDataFrame([], "k int, p string")
    assert sinks.replace_table(empty, name, Layout(partition_by=("p",))).actual == 0
    assert spark.table(name).columns == ["k", "p"]


def test_append_by_name_and_once_per_key(spark, schema):
    name = f"{schema}.t"
    first = spark.createDataFrame([(1, "a", "x")], "k int, v string, p string")
    more = spark.createDataFrame([("y", "b", 2), ("x", "c", 1)], "p string, v string, k int")
    sinks.replace_table(first, name, Layout(partition_by=("p",)))
    assert sinks.append_table(more, name, ["k"]).actual == 1
    assert sinks.append_table(more, name, ["k"]).actual == 0
    assert values(spark, name, "k", "v", "p") == [(1, "a", "x"), (2, "b", "y")]
    assert sinks.append_table(more, name).actual == 2
    assert spark.table(name).count() == 4


def test_append_and_upsert_need_a_table(spark, schema):
    df = spark.range(1).toDF("k")
    with pytest.raises(sinks.MissingTable):
        sinks.append_table(df, f"{schema}.none")
    with pytest.raises(sinks.MissingTable):
        sinks.upsert_table(df, f"{schema}.none", ["k"])
    with pytest.raises(ValueError):
        sinks.upsert_table(df, f"{schema}.none", [])


def test_upsert(spark, schema):
    name = f"{schema}.t"
    target = spark.createDataFrame([(1, "old", "p"), (2, "old", "p")], "k int, v string, p string")
    sinks.replace_table(target, name, Layout(partition_by=("p",)))
    source = spark.createDataFrame(
        [(2, "new", "q"), (3, "new", "p"), (None, "new", "p")], "k int, v string, p string"
    )
    for _ in range(2):
        sinks.upsert_table(source, name, ["k"])
    want = [(1, "old", "p"), (2, "new", "q"), (3, "new", "p"), (None, "new", "p")]
    assert values(spark, name, "k", "v", "p") == want
    assert current_layout(spark, name).partition_by == ("p",)
    for part in (source.na.drop(), source.filter("k IS NULL")):
        with pytest.raises(DuplicateKeys):
            sinks.upsert_table(part.unionByName(part), name, ["k"])
    assert values(spark, name, "k", "v", "p") == want


def test_clustered_files_cover_narrow_ranges(spark, schema):
    """Also when one value holds a third of the rows: it is spread over several files."""
    name = f"{schema}.t"
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 100).alias("day"), "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.replace_table(df, name, Layout(cluster_by=("day",)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = (
        spark.table(name)
        .groupBy(F.col("_metadata.file_path"))
        .agg(F.min("day").alias("low"), F.max("day").alias("high"), F.count("*").alias("n"))
        .collect()
    )
    assert len(files) > 4
    assert max(f.n for f in files) < 20_000
    assert sum(f.high - f.low + 1 for f in files) < 130


def test_rebalanced_partitions_split_the_hot_one(spark, schema):
    """The hot value gets several files; so may others that hash to the same partition."""
    name = f"{schema}.t"
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 20).cast("string"))
    text = F.md5(F.col("id").cast("string"))
    df = spark.range(0, 300_000, 1, 16).select(hot.alias("p"), text.alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        sinks.replace_table(df, name, Layout(partition_by=("p",)))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = (
        spark.table(name).select("p", "_metadata.file_path").distinct().groupBy("p").count().collect()
    )
    counts = {r.p: r["count"] for r in files}
    assert counts.pop("hot") > 3
    assert len(counts) == 20 and min(counts.values()) <= 2


def test_a_merge_is_resolved_by_names(spark, schema):
    """Parquet cannot be merged into; that it fails for this reason shows that the
    condition, with the names of table and source, was understood."""
    name = f"{schema}.t"
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    sinks.replace_table(df, name)
    with pytest.raises(Exception, match="(?i)not support"):
        merge_into(df, name, ["k"])


def test_columns_and_files(spark, schema):
    one, two = f"{schema}.one", f"{schema}.two"
    df = spark.range(100).select("id", (F.col("id") % 2).alias("p"))
    sinks.replace_table(df, one, Layout(partition_by=("p",)))
    sinks.replace_table(df.filter("id < 10"), two)
    assert values_of(sinks.table_columns(spark, one)) == [("id", "bigint"), ("p", "bigint")]
    details = {r.col_name: r.data_type for r in sinks.table_details(spark, two).collect()}
    assert details["Type"] == "EXTERNAL" and "bytes" in details["Statistics"]
    found = sinks.table_file_metrics(spark, {"a": [one, two], "b": [two]})
    metrics = {r.label: r for r in found.collect()}
    assert metrics["a"].files > metrics["b"].files > 0
    assert metrics["a"].bytes > metrics["b"].bytes > 0
    row = sinks.layer_comparison(spark, [one, two], [two]).first()
    assert row.bytes_before == metrics["a"].bytes and row.files_after == metrics["b"].files
    assert 0 < row.size_reduction_pct < 100


def values_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_managed_tables_are_replaced_and_merged(spark, schema):
    name = f"{schema}.m"
    spark.range(10).selectExpr("id AS k", "'old' AS v").write.saveAsTable(name)
    batch = spark.range(7, 14).selectExpr("id AS k", "'new' AS v")
    done = sinks.upsert_table(batch, name, ["k"])
    assert (done.expected, done.actual) == (14, 14)
    assert spark.table(name).filter("v = 'new'").count() == 7
    sinks.replace_table(spark.range(3).toDF("k"), name)
    assert values(spark, name, "k") == [(0,), (1,), (2,)]


@pytest.mark.parametrize("layout", [Layout(), Layout(partition_by=("p",))])
def test_a_replace_that_stops_before_the_swap_leaves_the_table(
    spark, schema, monkeypatch, layout
):
    name = f"{schema}.t"
    rows = spark.range(5).selectExpr("id AS k", "id % 2 AS p")
    sinks.replace_table(rows, name, layout)

    def stop(*_):
        raise RuntimeError("stop")

    monkeypatch.setattr("oreworks.sinks.tables._reconciled", stop)
    with pytest.raises(RuntimeError, match="stop"):
        sinks.replace_table(rows.limit(1), name, layout)
    assert spark.table(name).count() == 5
    monkeypatch.undo()
    sinks.replace_table(rows.limit(1), name, layout)
    assert spark.table(name).count() == 1


def test_an_old_table_set_aside_is_put_back(spark, schema):
    name = f"{schema}.t"
    sinks.replace_table(spark.range(5).toDF("k"), name, Layout(partition_by=()))
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__replaced")
    sinks.replace_table(spark.range(2).toDF("k"), name)
    assert spark.table(name).count() == 2
    assert not spark.catalog.tableExists(f"{name}__replaced")


def test_layouts_last(spark, schema):
    name = f"{schema}.t"
    rows = spark.range(50).selectExpr("id AS k", "id % 2 AS p", "id AS d")
    layout = Layout(partition_by=("p",), cluster_by=("d",), compression="gzip")
    sinks.replace_table(rows, name, layout)
    sinks.upsert_table(rows.limit(3), name, ["k"])
    assert current_layout(spark, name) == layout
    sinks.append_table(rows.selectExpr("k + 100 AS k", "p", "d"), name)
    assert current_layout(spark, name) == layout


def test_unknown_columns_and_null_keys(spark, schema):
    name = f"{schema}.t"
    rows = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    sinks.replace_table(rows.limit(0), name)
    wide = rows.withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="extra"):
        sinks.append_table(wide, name)
    sinks.append_table(wide, name, ["k"], ignore_extra=True)
    done = sinks.append_table(rows, name, ["k"])
    assert (done.expected, done.actual) == (0, 0)
    assert spark.table(name).count() == 2


def files_of(spark, name):
    """Paths of a table's files by partition."""
    found = {}
    for p, path in spark.table(name).select("p", "_metadata.file_path").distinct().collect():
        found.setdefault(p, set()).add(path)
    return found


def test_merges_write_only_the_partitions_they_change(spark, schema):
    name = f"{schema}.t"
    rows = [(k, f"a b/{k % 5}'", "old") for k in range(50)]
    columns = "k int, p string, v string"
    sinks.replace_table(
        spark.createDataFrame(rows, columns), name, Layout(partition_by=("p",))
    )
    before = files_of(spark, name)
    # One row changes in place, one moves, one comes to a new partition; one more stays.
    batch = [(0, "a b/0'", "new"), (1, "a b/2'", "moved"), (99, "é=1", "first")]
    written = sinks.upsert_table(spark.createDataFrame(batch, columns), name, ["k"])
    want = [r for r in rows if r[0] > 1] + batch
    assert values(spark, name, "k", "p", "v") == sorted(want, key=repr)
    assert written.actual == written.expected == 31
    after = files_of(spark, name)
    for p in ("a b/3'", "a b/4'"):
        assert after[p] == before[p]
    for p in ("a b/0'", "a b/1'", "a b/2'"):
        assert not after[p] & before[p]
    assert set(after) - set(before) == {"é=1"}
    assert current_layout(spark, name).partition_by == ("p",)


def test_a_merge_may_empty_a_partition(spark, schema):
    name = f"{schema}.t"
    columns = "k int, p int, v string"
    sinks.replace_table(
        spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (None, 3, "n")], columns),
        name,
        Layout(partition_by=("p",)),
    )
    batch = spark.createDataFrame([(1, 2, "c"), (None, 3, "m")], columns)
    for _ in range(2):
        sinks.upsert_table(batch, name, ["k"])
        assert values(spark, name, "k", "p", "v") == [(1, 2, "c"), (2, 2, "b"), (None, 3, "m")]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    # Rows without a partition value make the merge write the whole table.
    sinks.upsert_table(spark.createDataFrame([(7, None, "x")], columns), name, ["k"])
    assert spark.table(name).count() == 4
    sinks.upsert_table(spark.createDataFrame([], columns), name, ["k"])
    assert spark.table(name).count() == 4


def test_somebody_elses_table_is_not_dropped(spark, schema):
    name = f"{schema}.t"
    spark.range(3).toDF("k").write.saveAsTable(f"{name}__replaced")
    sinks.replace_table(spark.range(5).toDF("k"), name)
    with pytest.raises(ValueError, match="in the way"):
        sinks.replace_table(spark.range(5).toDF("other"), name)
    assert spark.table(f"{name}__replaced").count() == 3
    assert spark.table(name).columns == ["k"]


@pytest.mark.parametrize(
    "stamp,merge", [(op.scd1_stamp, merge_type1), (op.scd2_stamp, merge_type2)]
)
def test_merges_of_dimensions_are_resolved_by_names(spark, schema, stamp, merge):
    """As above: only that Parquet cannot be merged into is wrong with the statement."""
    name = f"{schema}.t"
    df = spark.createDataFrame([(1, None, "a")], "k int, `a b` int, v string")
    sinks.replace_table(stamp(df), name)
    with pytest.raises(Exception, match="(?i)not support"):
        merge(df, name, ["k", "a b"], F.current_timestamp())


def test_steps_of_a_type_2_merge_do_what_apply_does(spark):
    """The statement in small: close what matches, open the rest."""
    first = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    batch = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d"), (None, "m")], "k int, v string")
    then, now = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    dimension = op.scd2_stamp(first, then)
    steps = scd2_steps(dimension, batch, ["k"], now)
    closing = steps.filter(CLOSES).select("k", F.lit(True).alias("hit"))
    closed = dimension.alias("d").join(closing.alias("c"), F.expr("d.k <=> c.k"), "left")
    merged = closed.select(
        "d.k",
        "d.v",
        "d.valid_from",
        F.when(F.col("hit"), now).otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") & F.col("hit").isNull()).alias("is_current"),
    ).unionByName(op.scd2_stamp(steps.filter(f"NOT {CLOSES}").drop(CLOSES), now))
    want = op.scd2_apply(dimension, batch, ["k"], now)
    assert sorted(merged.collect(), key=repr) == sorted(want.collect(), key=repr)
    with pytest.raises(Exception, match="not later"):
        scd2_steps(dimension, batch, ["k"], then).collect()
