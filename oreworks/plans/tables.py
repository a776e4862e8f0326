"""The tables of the shop lake: five bronze, five silver steps, five gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks import schemas
from oreworks.functions import range_bucket
from oreworks.lake import Lake
from oreworks.operators import star
from oreworks.operators.clean import (
    CUSTOMER_RULES,
    LEGACY,
    NEW_SYSTEM,
    SELLER_RULES,
    apply_rules,
    tag_orders,
    without_order_partitions,
)
from oreworks.plans.layers import (
    BronzeSpec,
    GoldSpec,
    LayerReport,
    SilverSpec,
    build_gold,
    ingest_bronze,
    refine_silver,
)
from oreworks.sinks.tables import Layout
from oreworks.sources.calendar import FIRST_DAY, LAST_DAY, calendar_days

# Fixed value: keys per raw order item bucket.
ORDER_BUCKET_WIDTH = 10_000_000


def bucket_orders(df: DataFrame) -> DataFrame:
    return df.withColumn("order_id_bucket", range_bucket("order_id", ORDER_BUCKET_WIDTH))


def split_order_date(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"order_year": F.year("order_date"), "order_month": F.month("order_date")}
    )


_BY_MONTH = Layout(partition_by=("order_year", "order_month"))

BRONZE = {
    spec.table: spec
    for spec in (
        BronzeSpec(
            "order_items",
            schemas.ORDER_ITEMS,
            keys=("order_id", "product_id"),
            derive=bucket_orders,
            layout=Layout(partition_by=("order_id_bucket",)),
        ),
        BronzeSpec(
            "customers",
            schemas.CUSTOMERS,
            keys=("customer_id",),
            layout=Layout(partition_by=("country", "state")),
        ),
        BronzeSpec(
            "sellers",
            schemas.SELLERS,
            keys=("seller_id",),
            layout=Layout(partition_by=("seller_country", "seller_state")),
        ),
        BronzeSpec(
            "orders",
            schemas.ORDERS,
            keys=("order_id",),
            derive=split_order_date,
            layout=_BY_MONTH,
        ),
        BronzeSpec(
            "orders_new",
            schemas.ORDERS_NEW,
            keys=("order_id",),
            derive=split_order_date,
            layout=_BY_MONTH,
        ),
    )
}

SILVER = {
    "order_items": SilverSpec(
        "order_items",
        ("order_items",),
        keys=("order_id", "product_id"),
        drop=("order_id_bucket",),
        partition="order_id_bucket",
    ),
    "customers": SilverSpec(
        "customers",
        ("customers",),
        keys=("customer_id",),
        order_by=("customer_name",),
        transform=apply_rules(CUSTOMER_RULES),
        layout=Layout(partition_by=("country",)),
    ),
    "sellers": SilverSpec(
        "sellers",
        ("sellers",),
        keys=("seller_id",),
        order_by=("seller_company_name",),
        transform=apply_rules(SELLER_RULES),
        layout=Layout(partition_by=("seller_country",)),
    ),
    "orders": SilverSpec(
        "orders",
        ("orders",),
        keys=("order_id",),
        prepare=without_order_partitions,
        transform=tag_orders(LEGACY),
    ),
    "orders_new": SilverSpec(
        "orders",
        ("orders_new",),
        keys=("order_id",),
        prepare=without_order_partitions,
        transform=tag_orders(NEW_SYSTEM),
        mode="append",
        append_keys=("source_system", "order_id"),
    ),
}


def date_dimension(first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> GoldSpec:
    """A calendar of the given days."""
    return GoldSpec(
        "dim_date",
        (),
        lambda sources, as_of: star.dim_date(calendar_days(SparkSession.active(), first, last)),
        keys=("date_key",),
        stamped=False,
        layout=Layout(cluster_by=("year", "month")),
    )


_BY_PLACE = Layout(cluster_by=("country", "state"))
_BY_DAY = Layout(cluster_by=("order_date_key",))

GOLD = {
    spec.table: spec
    for spec in (
        GoldSpec(
            "dim_customers",
            (("silver", "customers"),),
            lambda sources, as_of: star.dim_customers(sources["customers"], as_of),
            keys=("customer_key",),
            layout=_BY_PLACE,
        ),
        GoldSpec(
            "dim_sellers",
            (("silver", "sellers"),),
            lambda sources, as_of: star.dim_sellers(sources["sellers"], as_of),
            keys=("seller_key",),
            layout=_BY_PLACE,
        ),
        date_dimension(),
        GoldSpec(
            "fact_orders",
            (("silver", "orders"),),
            lambda sources, as_of: star.fact_orders(sources["orders"]),
            keys=("source_system", "order_key"),
            stamped=False,
            layout=_BY_DAY,
        ),
        GoldSpec(
            "fact_sales_summary",
            (("silver", "orders"),),
            lambda sources, as_of: star.fact_sales_summary(sources["orders"]),
            keys=("customer_key", "seller_key", "order_date_key"),
            stamped=False,
            layout=_BY_DAY,
        ),
    )
}


def build_lake(
    spark: SparkSession, lake: Lake, as_of: Column | None = None
) -> dict[str, LayerReport]:
    """All tables, layer by layer. ``as_of`` is the date and time the run counts from.

    Each table is built as soon as those that it reads, or adds to, are there, and at the same
    time as others. If one fails, those that need it fail with it.
    """
    lake.create_schemas(spark)
    made = {("bronze", spec.table): [f"bronze.{name}"] for name, spec in BRONZE.items()}
    silver = sorted(SILVER.items(), key=lambda item: item[1].mode == "append")
    steps = [
        (f"bronze.{name}", [], lambda spec=spec: ingest_bronze(spark, lake, spec))
        for name, spec in BRONZE.items()
    ]
    for name, spec in silver:
        needed = [n for source in spec.sources for n in made["bronze", source]]
        needed += made.get(("silver", spec.table), [])
        made.setdefault(("silver", spec.table), []).append(f"silver.{name}")
        steps.append(
            (f"silver.{name}", needed, lambda spec=spec: refine_silver(spark, lake, spec, as_of))
        )
    for name, spec in GOLD.items():
        needed = [n for source in spec.sources for n in made.get(source, [])]
        made["gold", spec.table] = [f"gold.{name}"]
        steps.append((f"gold.{name}", needed, lambda spec=spec: build_gold(spark, lake, spec, as_of)))

    building: dict[str, Future[LayerReport]] = {}

    def build(needed: list[str], step: Callable[[], LayerReport]) -> LayerReport:
        for name in needed:
            building[name].result()
        return step()

    # A thread for each table, so that none waits for one that has not begun.
    with ThreadPoolExecutor(len(steps)) as pool:
        for name, needed, step in steps:
            building[name] = pool.submit(build, needed, step)
        return {name: report.result() for name, report in building.items()}
