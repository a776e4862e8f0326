"""Questions asked of the star schema.

Facts are aggregated to the join key before they meet a dimension. A customer with
a third of all orders then reaches the join as one row, and what is joined is
bounded by the dimension, not by the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.functions import as_key, money_sum
from oreworks.operators.clean import LEGACY


def customer_lifetime_value(
    fact: DataFrame, customers: DataFrame, country: str | None = None, top: int = 10
) -> DataFrame:
    """The ``top`` customers by total amount, optionally of one country."""
    if country is not None:
        customers = customers.filter(F.col("country") == country)
    per_customer = fact.groupBy(as_key("customer_key").alias("customer_key")).agg(
        money_sum("order_amount").alias("lifetime_value"),
        F.count("order_key").alias("total_orders"),
    )
    names = customers.select(as_key("customer_key").alias("customer_key"), "customer_name", "country")
    return (
        per_customer.join(names, "customer_key")
        .select(
            "customer_key",
            "customer_name",
            "country",
            "lifetime_value",
            "total_orders",
        )
        .orderBy(F.desc("lifetime_value"), "customer_key")
        .limit(top)
    )


def sales_trend(fact: DataFrame, dates: DataFrame, source_system: str = LEGACY) -> DataFrame:
    """Orders and revenue per month of one source system."""
    per_day = (
        fact.filter(F.col("source_system") == source_system)
        .groupBy(F.col("order_date_key").alias("date_key"))
        .agg(
            F.count("order_key").alias("orders"),
            money_sum("order_amount").alias("amount"),
        )
    )
    return (
        per_day.join(dates.select("date_key", "year", "month", "month_name"), "date_key")
        .groupBy("year", "month", "month_name")
        .agg(
            F.sum("orders").alias("order_count"),
            money_sum("amount").alias("revenue"),
        )
        .orderBy("year", "month")
    )


def source_distribution(orders: DataFrame) -> DataFrame:
    """Rows per source system."""
    return (
        orders.groupBy("source_system").agg(F.count(F.lit(1)).alias("n")).orderBy("source_system")
    )
