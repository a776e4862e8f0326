"""DataFrame to DataFrame operators. None of them runs a job, unless it says so."""

from oreworks.operators.clean import (
    clean_customers,
    clean_order_items,
    clean_orders_legacy,
    clean_orders_new,
    clean_sellers,
    reject_counts,
    without_nulls,
)
from oreworks.operators.dedup import dedup_by_key, require_unique_keys, unique_by_key
from oreworks.operators.quality import (
    duplicate_report,
    exact_range_report,
    null_report,
    partition_sizes,
    quality_estimate,
    quality_report,
    row_estimate,
    skew_stats,
    skewed_partitions,
    value_range_report,
)
from oreworks.operators.reports import (
    customer_lifetime_value,
    sales_trend,
    source_distribution,
)
from oreworks.operators.scd import scd1_apply, scd1_stamp, scd2_apply, scd2_insert, scd2_stamp
from oreworks.operators.star import (
    dim_customers,
    dim_date,
    dim_sellers,
    fact_orders,
    fact_sales_summary,
)
from oreworks.operators.unify import merge_sources, unify_orders, union_by_name
from oreworks.operators.upsert import only_new_keys, upsert, without_keys

__all__ = [
    "clean_customers",
    "clean_order_items",
    "clean_orders_legacy",
    "clean_orders_new",
    "clean_sellers",
    "customer_lifetime_value",
    "dedup_by_key",
    "dim_customers",
    "dim_date",
    "dim_sellers",
    "duplicate_report",
    "exact_range_report",
    "fact_orders",
    "fact_sales_summary",
    "merge_sources",
    "null_report",
    "only_new_keys",
    "partition_sizes",
    "quality_estimate",
    "quality_report",
    "reject_counts",
    "require_unique_keys",
    "row_estimate",
    "sales_trend",
    "scd1_apply",
    "scd1_stamp",
    "scd2_apply",
    "scd2_insert",
    "scd2_stamp",
    "skew_stats",
    "skewed_partitions",
    "source_distribution",
    "unify_orders",
    "union_by_name",
    "unique_by_key",
    "upsert",
    "value_range_report",
    "without_keys",
    "without_nulls",
]
