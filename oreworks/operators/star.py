"""Dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.functions import age_in_years, days_since, money_sum
from oreworks.functions.calendar import calendar_columns
from oreworks.operators.clean import LEGACY

# Output column = source column. Derived columns are placed by name.
DIM_CUSTOMERS = {
    "customer_key": "customer_id",
    "customer_id": "customer_id",
    "customer_name": "customer_name",
    "email": "email",
    "phone": "phone",
    "gender": "gender",
    "dob": "dob",
    "age": None,
    "nationality": "nationality",
    "city": "city",
    "state": "state",
    "country": "country",
    "zipcode": "zipcode",
    "company": "company",
    "data_source": "data_source",
}
DIM_SELLERS = {
    "seller_key": "seller_id",
    "seller_id": "seller_id",
    "company_name": "seller_company_name",
    "business_type": "seller_business_type",
    "rating": "seller_rating",
    "active_date": "seller_active_date",
    "days_active": None,
    "address": "seller_address",
    "state": "seller_state",
    "country": "seller_country",
    "zipcode": "seller_zipcode",
    "data_source": "data_source",
}
FACT_ORDERS = {
    "order_key": "order_id",
    "customer_key": "customer_id",
    "seller_key": "seller_id",
    "order_date_key": None,
    "payment_method": "payment_method",
    "source_system": "source_system",
    "order_amount": None,
    "is_amount_missing": None,
}


def _shape(
    df: DataFrame, names: Mapping[str, str | None], derived: Mapping[str, Column]
) -> DataFrame:
    return df.select(
        *[(derived[new] if old is None else F.col(old)).alias(new) for new, old in names.items()]
    )


def _day(as_of: Column | None) -> Column:
    return F.current_date() if as_of is None else as_of.cast("date")


def dim_customers(customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    return _shape(customers, DIM_CUSTOMERS, {"age": age_in_years("dob", _day(as_of))})


def dim_sellers(sellers: DataFrame, as_of: Column | None = None) -> DataFrame:
    derived = {"days_active": days_since("seller_active_date", _day(as_of))}
    return _shape(sellers, DIM_SELLERS, derived)


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes of the days in column ``date``."""
    return days.select(*calendar_columns("date"))


def fact_orders(orders: DataFrame) -> DataFrame:
    """One row per order. A missing price counts as 0.0, and is marked, since a mean
    or minimum over the filled amounts would be wrong."""
    price = F.col("order_total_price")
    derived = {
        "order_date_key": F.to_date("order_date"),
        "order_amount": F.coalesce(price, F.lit(0.0)),
        "is_amount_missing": price.isNull(),
    }
    return _shape(orders, FACT_ORDERS, derived)


def fact_sales_summary(orders: DataFrame) -> DataFrame:
    """Orders with prices per customer, seller and day.

    All five measures have fixed-width buffers, so Spark aggregates by hash on
    both sides of its one shuffle, and a hot customer arrives pre-aggregated.
    """
    priced = orders.filter(F.col("source_system") == LEGACY)
    price = F.col("order_total_price")
    total = money_sum(price)
    return priced.groupBy(
        F.col("customer_id").alias("customer_key"),
        F.col("seller_id").alias("seller_key"),
        F.to_date("order_date").alias("order_date_key"),
    ).agg(
        F.count(F.lit(1)).alias("order_count"),
        total.alias("total_revenue"),
        F.try_divide(total, F.count(price)).alias("avg_order_value"),
        F.min(price).alias("min_order_value"),
        F.max(price).alias("max_order_value"),
    )
