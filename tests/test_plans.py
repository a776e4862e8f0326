"""What the plans of the registered queries must and must not contain."""

import pytest
from pyspark.sql import functions as F

from oreworks import operators as op
from oreworks.catalogue.queries import queries

SF = "/root/testdata/sf0.001"
WRITES = {
    "bronze_round_trip", "clustered_layout", "lake_row_counts", "layer_comparison",
    "scan_csv_typed", "scan_json_typed", "scan_parquet_typed", "sink_append",
    "sink_merge_upsert", "sink_replace_partitioned", "source_file_stats", "star_sources",
    "table_details", "table_file_metrics", "write_reconciliation",
}
LAZY = sorted(set(queries()) - WRITES)
# A history has to be read in order, key by key: these have windows, over narrow version rows.
ORDERED = {"scd2_late_changes"}


def plan(spark, name, broadcast="-1"):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = queries()[name](spark, SF)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_python_or_forced_broadcast(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "Python"):
        assert bad not in text
    assert ("Window " in text) == (name in ORDERED)


@pytest.mark.parametrize("name", ["dedup_by_key", "clean_customers", "clean_orders_legacy"])
def test_rows_are_reduced_before_they_are_shuffled(spark, name):
    text = plan(spark, name)
    assert "partial_min(struct(" in text.split("Exchange hashpartitioning", 1)[1]


def test_exact_copies_are_dropped_by_hash(spark):
    text = plan(spark, "clean_order_items")
    assert text.count("Exchange") == 1
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2


def test_summary_needs_one_shuffle_beyond_its_input(spark):
    assert plan(spark, "fact_sales_summary").count("Exchange hash") == plan(
        spark, "clean_orders_legacy"
    ).count("Exchange hash") + 1


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan(spark, "dq_duplicates")
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan(
        spark, "clean_orders_legacy"
    )


LOADED, CHANGED = "2024-01-01", "2024-02-01"


def at(day):
    return F.lit(day).cast("timestamp")


@pytest.mark.parametrize(
    "merge",
    [
        lambda table, batch: op.upsert(table, batch, ["k"]),
        lambda table, batch: op.scd1_apply(op.scd1_stamp(table, at(LOADED)), batch, ["k"], at(CHANGED)),
        lambda table, batch: op.scd2_apply(op.scd2_stamp(table, at(LOADED)), batch, ["k"], at(CHANGED)),
    ],
    ids=["upsert", "scd1", "scd2"],
)
def test_a_key_with_a_third_of_a_table_is_split_by_the_join(spark, merge):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 300_000, 1, 16)
        key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
        table = ids.select(key.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        batch = ids.filter("id % 10 = 0").select(F.col("id").alias("k"), F.lit("new").alias("v"))
        merged = merge(table, batch)
        result = merged.agg(F.max(F.xxhash64(*merged.columns)))
        result.collect()
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
