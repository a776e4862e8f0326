"""Every registered query: name to a function of (spark, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from oreworks import functions as fn
from oreworks import operators as op
from oreworks import schemas, sinks, sources
from oreworks.catalogue.inputs import Inputs
from oreworks.catalogue.scratch import scratch_lake, scratch_root
from oreworks.lake import Lake
from oreworks.operators.clean import LEGACY, NEW_SYSTEM, tag_orders
from oreworks.operators.quality import largest_partitions
from oreworks.plans import BRONZE, SILVER, GoldSpec, build_gold, build_lake, ingest_bronze
from oreworks.plans.tables import bucket_orders, split_order_date
from oreworks.sinks import Layout, append_table, replace_table, upsert_table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2025-01-01"
LOADED = "2024-01-01"
CHANGED = "2024-06-01"
SAMPLE = 0.25
TOLERANCE = 0.25

_QUERIES: dict[str, Query] = {}


def _register(query: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _QUERIES[query.__name__] = lambda spark, sf_dir: _wall_clock(query(Inputs(spark, sf_dir)))
    return query


def _wall_clock(df: DataFrame) -> DataFrame:
    """Times as the session's clock shows them, so that results compare without time zones."""
    moments = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in moments})


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _at(day: str) -> Column:
    """Midnight, by the clock of the session."""
    return F.lit(day).cast("timestamp")


# Raw files


def write_raw(df: DataFrame, path: str, file_format: str = "csv") -> None:
    writer = df.write.format(file_format)
    if file_format == "csv":
        # Spark's CSV writer would otherwise trim the padded text.
        writer = writer.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.save(path)


def write_raw_tables(t: Inputs, lake: Lake) -> None:
    """All raw tables as CSV, at the same time; lineitem is searched for sellers once."""
    t.keep_sellers(scratch_root(t.spark))
    raw = {lake.raw_path(name): df for name, df in t.raw().items()}
    with ThreadPoolExecutor(len(raw)) as pool:
        list(pool.map(write_raw, raw.values(), raw))


def _scan(t: Inputs, file_format: str) -> DataFrame:
    path = scratch_root(t.spark)
    write_raw(t.orders(), path, file_format)
    return sources.read_typed(t.spark, path, schemas.ORDERS, file_format, strict_header=True)


@_register
def scan_csv_typed(t: Inputs) -> DataFrame:
    return _scan(t, "csv")


@_register
def scan_json_typed(t: Inputs) -> DataFrame:
    return _scan(t, "json")


@_register
def scan_parquet_typed(t: Inputs) -> DataFrame:
    return _scan(t, "parquet")


@_register
def source_file_stats(t: Inputs) -> DataFrame:
    root = scratch_root(t.spark)
    for file_format in ("csv", "json", "parquet"):
        write_raw(t.orders(), f"{root}/{file_format}", file_format)
    stats = sources.source_file_stats(sources.list_data_files(t.spark, root))
    return stats.select(
        "format",
        (F.col("files") > 0).alias("files_found"),
        (F.col("bytes") > 0).alias("bytes_positive"),
    )


@_register
def scan_row_count(t: Inputs) -> DataFrame:
    return _row_counts(t.raw(), "table")


def _row_counts(tables: dict[str, DataFrame], label: str) -> DataFrame:
    return op.union_by_name(
        [
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias(label), "n")
            for name, df in tables.items()
        ]
    )


@_register
def bronze_round_trip(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    written = []
    for name, df in t.raw().items():
        write_raw(df, lake.raw_path(name))
        report = ingest_bronze(t.spark, lake, BRONZE[name])
        written.append((name, report.written.expected, report.written.actual))
    return t.spark.createDataFrame(written, "table string, expected bigint, actual bigint")


@_register
def bronze_rejects(t: Inputs) -> DataFrame:
    """Orders of which some have no number as id, or no date: kept and rejected ones."""
    lake = scratch_lake(t.spark)
    id = F.col("order_id")
    faulty = t.orders_new().withColumns(
        {
            "order_id": F.when(id % 50 == 0, F.concat(F.lit("x"), id)).otherwise(id.cast("string")),
            "order_date": F.when(id % 60 == 0, "soon").otherwise(F.col("order_date").cast("string")),
        }
    )
    write_raw(faulty, lake.raw_path("orders_new"))
    report = ingest_bronze(t.spark, lake, replace(BRONZE["orders_new"], rejects=True))
    name = lake.table("bronze", "orders_new")
    tables = {"kept": (name, report.written), "rejected": (f"{name}_rejects", report.rejected)}
    counts = [
        t.spark.table(table)
        .groupBy(F.lit(status).alias("status"), "payment_method")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("counted", F.lit(written.actual).cast("bigint"))
        for status, (table, written) in tables.items()
    ]
    return op.union_by_name(counts)


@_register
def range_bucket(t: Inputs) -> DataFrame:
    return (
        t.order_items()
        .groupBy(fn.range_bucket("order_id", 1000).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# Cleaning


@_register
def filter_not_null(t: Inputs) -> DataFrame:
    return op.without_nulls(t.orders(), ["seller_id", "customer_id"])


@_register
def dedup_by_key(t: Inputs) -> DataFrame:
    return op.dedup_by_key(t.customers(), ["customer_id"], ["customer_name"])


@_register
def dedup_whole_rows(t: Inputs) -> DataFrame:
    return op.dedup_by_key(t.order_items(), ["order_id", "product_id"], copies="n_copies")


@_register
def mask_card(t: Inputs) -> DataFrame:
    return t.customers().select("customer_id", fn.mask_card("credit_card_no").alias("masked"))


@_register
def mask_account(t: Inputs) -> DataFrame:
    return t.customers().select("customer_id", fn.mask_account("paypal_account").alias("masked"))


@_register
def mask_account_in_documents(t: Inputs) -> DataFrame:
    return t.given("documents").select("doc_id", fn.mask_account("text").alias("masked"))


@_register
def clean_order_items(t: Inputs) -> DataFrame:
    return op.clean_order_items(t.order_items().transform(bucket_orders), "bronze.order_items")


@_register
def clean_customers(t: Inputs) -> DataFrame:
    return op.clean_customers(t.customers(), "bronze.customers")


@_register
def clean_sellers(t: Inputs) -> DataFrame:
    return op.clean_sellers(t.sellers(), "bronze.sellers")


@_register
def clean_orders_legacy(t: Inputs) -> DataFrame:
    raw = t.orders().transform(split_order_date)
    return op.clean_orders_legacy(raw, "bronze.orders")


@_register
def clean_orders_new(t: Inputs) -> DataFrame:
    raw = t.orders_new().transform(split_order_date)
    return op.clean_orders_new(raw, "bronze.orders_new")


@_register
def cast_rejects(t: Inputs) -> DataFrame:
    customers = op.reject_counts(t.customers(), {"dob": fn.as_date})
    sellers = op.reject_counts(
        t.sellers(), {"seller_rating": fn.as_double, "seller_active_date": fn.as_date}
    )
    return customers.unionByName(sellers)


# Unions


@_register
def unify_orders(t: Inputs) -> DataFrame:
    return op.unify_orders(clean_orders_legacy(t), clean_orders_new(t))


@_register
def union_by_name(t: Inputs) -> DataFrame:
    legacy = t.orders()
    new_system = t.orders_new().withColumn("order_id", F.col("order_id").cast("string"))
    return op.union_by_name([legacy, new_system.drop("order_date"), new_system.select("order_id")])


@_register
def merge_sources(t: Inputs) -> DataFrame:
    new_system = t.orders_new().withColumns(
        {
            "order_id": F.col("order_id").cast("string"),
            "order_date": F.col("order_date").cast("timestamp"),
        }
    )
    return op.merge_sources([t.orders(), new_system], ["order_id"], drop=["payment_method"])


@_register
def merge_transform(t: Inputs) -> DataFrame:
    """Both order systems put together by a function that first gives them one shape."""

    def shaped(parts: Sequence[DataFrame]) -> DataFrame:
        systems = zip(parts, (LEGACY, NEW_SYSTEM))
        return op.union_by_name([rows.transform(tag_orders(system)) for rows, system in systems])

    keys = ["source_system", "order_id"]
    return op.merge_sources([t.orders(), t.orders_new()], keys, merge=shaped)


@_register
def schema_in_use(t: Inputs) -> DataFrame:
    """A table that is written and found by its name alone, in the layer in use."""
    lake = scratch_lake(t.spark)
    before = t.spark.catalog.currentDatabase()
    lake.use(t.spark, "gold")
    try:
        replace_table(_first_feed(t).select(*_ATTRIBUTES), "customers_in_use")
    finally:
        t.spark.catalog.setCurrentDatabase(before)
    return t.spark.table(lake.table("gold", "customers_in_use"))


@_register
def source_distribution(t: Inputs) -> DataFrame:
    return op.source_distribution(unify_orders(t))


# Star schema


@_register
def dim_customers(t: Inputs) -> DataFrame:
    return op.dim_customers(clean_customers(t), _at(AS_OF))


@_register
def dim_sellers(t: Inputs) -> DataFrame:
    return op.dim_sellers(clean_sellers(t), _at(AS_OF))


@_register
def dim_date(t: Inputs) -> DataFrame:
    return op.dim_date(sources.calendar_span(t.given("orders"), "o_orderdate"))


@_register
def fact_orders(t: Inputs) -> DataFrame:
    return op.fact_orders(unify_orders(t))


@_register
def fact_sales_summary(t: Inputs) -> DataFrame:
    return op.fact_sales_summary(unify_orders(t))


@_register
def star_sources(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    cleaned = {"customers": clean_customers(t), "sellers": clean_sellers(t), "orders": unify_orders(t)}
    for name, df in cleaned.items():
        replace_table(df, lake.table("silver", name))
    names = {lake.table("silver", name): name for name in cleaned}
    tables = sources.read_tables(t.spark, names)
    return _row_counts({names[full]: df for full, df in tables.items()}, "source")


@_register
def report_customer_ltv(t: Inputs) -> DataFrame:
    return op.customer_lifetime_value(fact_orders(t), dim_customers(t))


@_register
def report_customer_ltv_by_country(t: Inputs) -> DataFrame:
    return op.customer_lifetime_value(fact_orders(t), dim_customers(t), country="NATION_7")


@_register
def report_sales_trend(t: Inputs) -> DataFrame:
    return op.sales_trend(fact_orders(t), dim_date(t))


@_register
def lake_row_counts(t: Inputs) -> DataFrame:
    """Raw files to star schema, every table of every layer written and counted."""
    lake = scratch_lake(t.spark)
    write_raw_tables(t, lake)
    build_lake(t.spark, lake, _at(AS_OF))
    tables = {f"bronze.{name}": lake.table("bronze", name) for name in BRONZE}
    silver = sorted({spec.table for spec in SILVER.values()})
    tables |= {f"silver.{name}": lake.table("silver", name) for name in silver}
    facts = ("dim_customers", "dim_sellers", "fact_orders", "fact_sales_summary")
    tables |= {f"gold.{name}": lake.table("gold", name) for name in facts}
    return _row_counts({label: t.spark.table(name) for label, name in tables.items()}, "table")


# Quality


@_register
def dq_nulls(t: Inputs) -> DataFrame:
    return op.null_report(t.customers())


@_register
def dq_duplicates(t: Inputs) -> DataFrame:
    return op.duplicate_report(t.order_items(), ["order_id", "product_id"])


@_register
def dq_value_ranges(t: Inputs) -> DataFrame:
    reports = [
        op.value_range_report(t.given(table), [column])
        for table, column in (("customer", "c_acctbal"), ("supplier", "s_acctbal"))
    ]
    return _rounded(op.union_by_name(reports), "mean", "stddev")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


def _uneven_partitions(t: Inputs) -> DataFrame:
    hot = F.when(F.col("o_custkey") % 10 < 6, "HOT").otherwise(F.col("o_orderpriority"))
    return op.partition_sizes(t.given("orders"), hot)


@_register
def dq_partition_sizes(t: Inputs) -> DataFrame:
    return largest_partitions(op.partition_sizes(t.given("orders"), F.to_date("o_orderdate")))


@_register
def dq_skew_stats(t: Inputs) -> DataFrame:
    return op.skew_stats(_uneven_partitions(t))


@_register
def dq_partition_skew(t: Inputs) -> DataFrame:
    return op.skewed_partitions(_uneven_partitions(t))


@_register
def quality_report(t: Inputs) -> DataFrame:
    report = op.quality_report(t.orders_new(), ["order_id"], "payment_method")
    return _rounded(report, "value")


@_register
def key_hash_sample(t: Inputs) -> DataFrame:
    return sources.key_hash_sample(t.orders_new(), ["order_id"], SAMPLE, portable=True)


@_register
def dq_sample_estimate(t: Inputs) -> DataFrame:
    raw = t.orders_new()
    estimates = op.quality_estimate(raw, ["order_id"], ["seller_id"], SAMPLE, portable=True)
    exact = op.quality_estimate(raw, ["order_id"], ["seller_id"], 1.0, portable=True)
    both = exact.withColumnRenamed("estimate", "exact").join(estimates, "metric")
    off = F.abs(F.col("estimate") - F.col("exact"))
    return both.withColumn("within_tolerance", off <= F.col("exact") * TOLERANCE)


@_register
def dq_row_estimate(t: Inputs) -> DataFrame:
    """Exact figures, and whether those from a sample of rows bound them."""
    raw = t.orders_new()
    estimates = op.row_estimate(raw, ["seller_id", "order_date"], ["order_id"], SAMPLE)
    figures = {
        "rows": F.count(F.lit(1)),
        "nulls:seller_id": F.count_if(F.col("seller_id").isNull()),
        "nulls:order_date": F.count_if(F.col("order_date").isNull()),
        "distinct:order_id": F.count_distinct("order_id"),
    }
    exact = raw.agg(*[figure.alias(name) for name, figure in figures.items()])
    both = exact.unpivot([], list(figures), "metric", "exact").join(estimates, "metric")
    return both.select(
        "metric",
        "exact",
        F.col("exact").between(F.col("low"), F.col("high")).alias("within_bounds"),
        F.col("estimate").between(F.col("low"), F.col("high")).alias("estimate_within_bounds"),
    )


@_register
def dq_exact_ranges(t: Inputs) -> DataFrame:
    """Numbers beyond 2^53, which doubles would round, and decimals."""
    items = t.given("lineitem").select(
        (F.col("l_orderkey") + 2**53 + 1).alias("big_key"),
        (-F.col("l_partkey")).alias("below_zero"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
    )
    return op.exact_range_report(items, items.columns)


# Sinks


@_register
def sink_replace_partitioned(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    name = lake.table("bronze", "orders")
    replace_table(t.orders(), name)
    rows = t.orders().transform(split_order_date)
    replace_table(rows, name, Layout(partition_by=("order_year", "order_month")))
    return t.spark.table(name).groupBy("order_year").agg(F.count(F.lit(1)).alias("n"))


@_register
def sink_append(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    name = lake.table("silver", "orders")
    keys = ["source_system", "order_id"]
    replace_table(clean_orders_legacy(t), name)
    append_table(clean_orders_new(t), name, keys)
    append_table(clean_orders_new(t), name, keys)  # a repeated run adds nothing
    return op.source_distribution(t.spark.table(name))


def _first_feed(t: Inputs) -> DataFrame:
    """Customers before the building segment came in."""
    return _feed(t).filter("segment <> 'building'")


def _second_feed(t: Inputs) -> DataFrame:
    """A later delivery without machinery: those who owe money have moved."""
    moved = F.when(F.col("owes"), F.concat("state", F.lit("-MOVED"))).otherwise(F.col("state"))
    return _feed(t).filter("segment <> 'machinery'").withColumn("state", moved)


def _feed(t: Inputs) -> DataFrame:
    customers = op.dedup_by_key(t.customers(), ["customer_id"], ["customer_name"])
    owing = t.given("customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        (F.col("c_acctbal") < 0).alias("owes"),
    )
    return customers.join(owing, "customer_id").select(
        "customer_id", "customer_name", "state", "owes", F.trim("state").alias("segment")
    )


_ATTRIBUTES = ("customer_id", "customer_name", "state")


@_register
def sink_merge_upsert(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    name = lake.table("gold", "customers")
    replace_table(_first_feed(t).select(*_ATTRIBUTES), name)
    upsert_table(_second_feed(t).select(*_ATTRIBUTES), name, ["customer_id"])
    return t.spark.table(name)


@_register
def sink_replace_managed(t: Inputs) -> DataFrame:
    """A table that Spark itself keeps the files of is merged, then read."""
    lake = scratch_lake(t.spark)
    name = lake.table("gold", "managed_customers")
    _first_feed(t).select(*_ATTRIBUTES).write.saveAsTable(name)
    upsert_table(_second_feed(t).select(*_ATTRIBUTES), name, ["customer_id"])
    return t.spark.table(name)


@_register
def write_reconciliation(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    written = []
    for name, df in t.raw().items():
        done = replace_table(df, lake.table("bronze", name))
        written.append((name, done.expected, done.actual, done.expected == done.actual))
    schema = "table string, expected bigint, actual bigint, ok boolean"
    return t.spark.createDataFrame(written, schema)


@_register
def clustered_layout(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    name = lake.table("gold", "fact_orders")
    replace_table(fact_orders(t), name, Layout(cluster_by=("order_date_key",)))
    return t.spark.table(name).groupBy("order_date_key").agg(F.count(F.lit(1)).alias("n"))


@_register
def table_details(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    name = lake.table("bronze", "orders")
    rows = t.orders().transform(split_order_date)
    replace_table(rows, name, Layout(partition_by=("order_year", "order_month")))
    return sinks.table_columns(t.spark, name)


@_register
def table_file_metrics(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    names = {}
    for label, df in t.raw().items():
        names[label] = [lake.table("bronze", label)]
        replace_table(df, names[label][0])
    metrics = sinks.table_file_metrics(t.spark, names)
    return metrics.select(
        F.col("label").alias("table"),
        (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") > 0).alias("has_bytes"),
    )


@_register
def layer_comparison(t: Inputs) -> DataFrame:
    lake = scratch_lake(t.spark)
    raw = {"orders": t.orders(), "orders_new": t.orders_new()}
    for name, df in raw.items():
        replace_table(df, lake.table("bronze", name))
    silver = lake.table("silver", "orders")
    replace_table(unify_orders(t), silver)
    compared = sinks.layer_comparison(t.spark, [lake.table("bronze", n) for n in raw], [silver])
    return compared.select(
        (F.col("files_before") >= len(raw)).alias("all_sources_counted"),
        (F.col("bytes_after") > 0).alias("result_counted"),
        (
            F.abs(
                F.col("size_reduction_pct")
                - (1 - F.col("bytes_after") / F.col("bytes_before")) * 100
            )
            < 1e-6
        ).alias("reduction_fits"),
    )


# Slowly changing dimensions


@_register
def scd1_apply(t: Inputs) -> DataFrame:
    dimension = op.scd1_stamp(_first_feed(t).select(*_ATTRIBUTES), _at(LOADED))
    merged = op.scd1_apply(
        dimension, _second_feed(t).select(*_ATTRIBUTES), ["customer_id"], _at(CHANGED)
    )
    return merged.select(
        *_ATTRIBUTES,
        (F.col("created_at") == _at(CHANGED)).alias("was_insert"),
        (F.col("updated_at") == _at(CHANGED)).alias("was_in_batch"),
    )


@_register
def scd2_stamp(t: Inputs) -> DataFrame:
    return _days(op.scd2_stamp(_first_feed(t).select(*_ATTRIBUTES), _at(LOADED)))


@_register
def scd2_apply(t: Inputs) -> DataFrame:
    dimension = op.scd2_stamp(_first_feed(t).select(*_ATTRIBUTES), _at(LOADED))
    batch = _second_feed(t).select(*_ATTRIBUTES)
    return _days(op.scd2_apply(dimension, batch, ["customer_id"], _at(CHANGED)))


def _merged_gold(t: Inputs, scd_type: int) -> DataFrame:
    """A dimension by state, built from the first feed and merged with the second."""
    lake = scratch_lake(t.spark)
    spec = GoldSpec(
        "customers_by_state",
        (),
        lambda sources, as_of: _first_feed(t).select(*_ATTRIBUTES),
        keys=("customer_id",),
        scd_type=scd_type,
        layout=Layout(partition_by=("state",)),
    )
    build_gold(t.spark, lake, spec, _at(LOADED))
    second = replace(
        spec, logic=lambda sources, as_of: _second_feed(t).select(*_ATTRIBUTES), mode="merge"
    )
    build_gold(t.spark, lake, second, _at(CHANGED))
    return t.spark.table(lake.table("gold", spec.table))


@_register
def gold_merge_scd1(t: Inputs) -> DataFrame:
    return _merged_gold(t, 1).select(
        *_ATTRIBUTES,
        (F.col("created_at") == _at(CHANGED)).alias("was_insert"),
        (F.col("updated_at") == _at(CHANGED)).alias("was_in_batch"),
    )


@_register
def gold_merge_scd2(t: Inputs) -> DataFrame:
    return _days(_merged_gold(t, 2))


def _without_one_key(df: DataFrame) -> DataFrame:
    """The feed, with NULL for the key of one customer."""
    return df.withColumn("customer_id", F.nullif("customer_id", F.lit("7")))


@_register
def scd1_null_key(t: Inputs) -> DataFrame:
    """The same delivery twice, with a customer whose key is NULL."""
    first, second = (_without_one_key(f(t).select(*_ATTRIBUTES)) for f in (_first_feed, _second_feed))
    dimension = op.scd1_stamp(first, _at(LOADED))
    for _ in range(2):
        dimension = op.scd1_apply(dimension, second, ["customer_id"], _at(CHANGED))
    return dimension.select(*_ATTRIBUTES, (F.col("created_at") == _at(CHANGED)).alias("was_insert"))


@_register
def scd2_null_key(t: Inputs) -> DataFrame:
    first, second = (_without_one_key(f(t).select(*_ATTRIBUTES)) for f in (_first_feed, _second_feed))
    dimension = op.scd2_stamp(first, _at(LOADED))
    for _ in range(2):
        dimension = op.scd2_apply(dimension, second, ["customer_id"], _at(CHANGED))
    return _days(dimension)


@_register
def scd2_late_changes(t: Inputs) -> DataFrame:
    """Orders as changes of a customer's way of paying, the newer delivered before the older."""
    orders = t.given("orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.to_date("o_orderdate").alias("since"),
    )
    dimension = op.scd2_stamp(orders.drop("since").limit(0), _at(LOADED))
    for part in ("since >= date'1997-01-01'", "since < date'1995-01-01'", "true"):
        dimension = op.scd2_insert(dimension, orders.filter(part), ["customer_id"], "since")
    return _days(dimension)


def _days(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.to_date(c) for c in ("valid_from", "valid_to")})
