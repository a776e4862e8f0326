"""Raw rows to clean rows: drop, deduplicate, type, tidy, mask, tag."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.functions import (
    as_date,
    as_double,
    as_key,
    mask_account,
    mask_card,
    rejected,
    tidy,
    tidy_upper,
)
from oreworks.operators.dedup import dedup_by_key

Rules = Mapping[str, Callable[[str], Column]]

CUSTOMER_RULES: Rules = {
    "dob": as_date,
    "country": tidy_upper,
    "state": tidy_upper,
    "customer_name": tidy,
    "email": tidy,
    "city": tidy,
    "credit_card_no": mask_card,
    "paypal_account": mask_account,
}

SELLER_RULES: Rules = {
    "seller_rating": as_double,
    "seller_active_date": as_date,
    "seller_country": tidy_upper,
    "seller_state": tidy_upper,
    "seller_address": tidy,
    "seller_company_name": tidy,
}

ORDER_RULES: Rules = {
    "order_id": as_key,
    "customer_id": as_key,
    "seller_id": as_key,
    "order_date": lambda c: F.col(c).cast("timestamp"),
}

LEGACY = "legacy"
NEW_SYSTEM = "new_system"


def clean(
    df: DataFrame,
    keys: Sequence[str],
    *,
    source: str,
    order_by: Sequence[str] = (),
    not_null: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """The steps from raw to clean, in order: rows without NULLs in ``not_null``,
    one row per key, ``transform``, without ``drop``, with ``data_source``.

    ``prepare`` runs before the keys are compared, for keys that need tidying.
    """
    df = without_nulls(df, not_null)
    if prepare:
        df = df.transform(prepare)
    if transform is None:
        df = df.drop(*drop)  # nothing can need them, so they are not shuffled either
    df = dedup_by_key(df, keys, order_by)
    if transform:
        df = df.transform(transform)
    return df.drop(*drop).withColumn("data_source", F.lit(source))


def without_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every one of the columns. Written as plain comparisons,
    which reach the scan; ``na.drop`` would not."""
    return reduce(lambda rows, c: rows.filter(F.col(c).isNotNull()), columns, df)


def apply_rules(rules: Rules) -> Callable[[DataFrame], DataFrame]:
    """A transform that replaces each named column by its rule's result."""
    return lambda df: df.withColumns({name: rule(name) for name, rule in rules.items()})


def tag_orders(system: str) -> Callable[[DataFrame], DataFrame]:
    """Orders of one system in the shape both share; a price it lacks is NULL."""

    def shape(df: DataFrame) -> DataFrame:
        added = {"source_system": F.lit(system)}
        if "order_total_price" not in df.columns:
            added["order_total_price"] = F.lit(None).cast("double")
        return df.transform(apply_rules(ORDER_RULES)).withColumns(added)

    return shape


def without_order_partitions(df: DataFrame) -> DataFrame:
    """Orders without the columns that only served to partition the raw table."""
    return df.drop("order_year", "order_month")


def clean_order_items(raw: DataFrame, source: str) -> DataFrame:
    return clean(raw, ["order_id", "product_id"], source=source, drop=["order_id_bucket"])


def clean_customers(raw: DataFrame, source: str) -> DataFrame:
    return clean(
        raw,
        ["customer_id"],
        source=source,
        order_by=["customer_name"],
        transform=apply_rules(CUSTOMER_RULES),
    )


def clean_sellers(raw: DataFrame, source: str) -> DataFrame:
    return clean(
        raw,
        ["seller_id"],
        source=source,
        order_by=["seller_company_name"],
        transform=apply_rules(SELLER_RULES),
    )


def clean_orders_legacy(raw: DataFrame, source: str) -> DataFrame:
    return _clean_orders(raw, source, LEGACY)


def clean_orders_new(raw: DataFrame, source: str) -> DataFrame:
    return _clean_orders(raw, source, NEW_SYSTEM)


def _clean_orders(raw: DataFrame, source: str, system: str) -> DataFrame:
    return clean(
        raw,
        ["order_id"],
        source=source,
        prepare=without_order_partitions,
        transform=tag_orders(system),
    )


def reject_counts(raw: DataFrame, parsers: Rules) -> DataFrame:
    """``column, rejects``: values that are there but do not parse. One pass."""
    counts = raw.agg(
        *[F.count_if(rejected(c, parse(c))).alias(c) for c, parse in parsers.items()]
    )
    return counts.unpivot([], list(parsers), "column", "rejects")
