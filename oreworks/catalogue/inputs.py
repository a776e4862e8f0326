"""The raw shop tables, derived from the given benchmark tables.

They carry the faults the lake has to cope with: padded text, dates and ratings that
are none, missing cards and sellers, repeated keys, and two order systems, the older
until the cut-over day and the newer, without prices, from then on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CUT_OVER = "2000-01-01"


class Inputs:
    """Given tables and raw views over them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._sold: DataFrame | None = None

    def given(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def order_items(self) -> DataFrame:
        return self.given("lineitem").selectExpr(
            "l_orderkey AS order_id", "l_partkey AS product_id"
        )

    def customers(self) -> DataFrame:
        rows = self.given("customer").join(
            self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return rows.withColumn("copy", _copies("c_custkey % 97 = 0")).selectExpr(
            "cast(c_custkey AS string) AS customer_id",
            "'  ' || c_name || if(copy = 1, ' v2', '') || ' ' AS customer_name",
            "'Company ' || cast(c_custkey % 50 AS string) AS company",
            "cast(c_custkey AS string) || ' Main St' AS shipping_address",
            "cast(10000 + c_custkey % 90000 AS string) AS zipcode",
            "' city ' || cast(c_nationkey AS string) AS city",
            "' ' || lower(c_mktsegment) || ' ' AS state",
            "' ' || lower(n_name) AS country",
            "if(c_custkey % 211 = 0, 'not-a-date', cast(date_add(date'1950-01-01',"
            " cast(c_custkey * 37 % 18000 AS int)) AS string)) AS dob",
            "' user' || cast(c_custkey AS string) || '@mail.example ' AS email",
            "if(c_custkey % 2 = 0, 'F', 'M') AS gender",
            "n_name AS nationality",
            "'+1-555-' || cast(1000 + c_custkey % 9000 AS string) AS phone",
            "'user' || cast(c_custkey AS string) AS username",
            "if(c_custkey % 101 = 0, NULL, cast(4000000000000000 + c_custkey * 7919 AS string))"
            " AS credit_card_no",
            "if(c_custkey % 3 = 0, 'visa', 'other') AS credit_card_type",
            "if(c_custkey % 50 = 0, 'no-at-sign', 'user' || cast(c_custkey AS string)"
            " || '@pay.example') AS paypal_account",
        )

    def sellers(self) -> DataFrame:
        rows = self.given("supplier").join(
            self.given("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        return rows.withColumn("copy", _copies("s_suppkey % 20 = 0")).selectExpr(
            "cast(s_suppkey AS string) AS seller_id",
            "' ' || cast(s_suppkey AS string) || ' Dock Rd ' AS seller_address",
            "' s' || cast(s_suppkey % 7 AS string) || ' ' AS seller_state",
            "cast(20000 + s_suppkey AS string) AS seller_zipcode",
            "' ' || lower(n_name) AS seller_country",
            "if(s_suppkey % 17 = 0, 'n/a', cast(s_suppkey % 5 + 1 AS string)) AS seller_rating",
            "if(s_suppkey % 19 = 0, '', cast(date_add(date'2010-01-01',"
            " cast(s_suppkey * 13 % 4000 AS int)) AS string)) AS seller_active_date",
            "if(s_suppkey % 2 = 0, 'retail', 'wholesale') AS seller_business_type",
            "' ' || s_name || if(copy = 1, ' v2', '') || ' ' AS seller_company_name",
        )

    def orders(self) -> DataFrame:
        before = F.col("o_orderdate") < F.lit(CUT_OVER).cast("timestamp_ntz")
        return self._with_seller(before).selectExpr(
            "md5(cast(o_orderkey AS string)) AS order_id",
            "o_custkey AS customer_id",
            "seller_id",
            "cast(o_orderdate AS timestamp) AS order_date",
            "o_totalprice AS order_total_price",
            "o_orderpriority AS payment_method",
        )

    def orders_new(self) -> DataFrame:
        after = F.col("o_orderdate") >= F.lit(CUT_OVER).cast("timestamp_ntz")
        rows = self._with_seller(after)
        return rows.withColumn("copy", _copies("o_orderkey % 3 = 0")).selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "seller_id",
            "cast(o_orderdate AS date) AS order_date",
            "o_orderpriority AS payment_method",
        )

    def keep_sellers(self, path: str) -> None:
        """Find the orders' sellers now, once for all raw tables that are made afterwards."""
        columns = "o_orderkey", "o_custkey", "seller_id", "o_orderdate", "o_totalprice", "o_orderpriority"
        self._with_seller(F.lit(True)).select(*columns).write.parquet(path)
        self._sold = self.spark.read.parquet(path)

    def _with_seller(self, chosen: Column) -> DataFrame:
        if self._sold is not None:
            return self._sold.filter(chosen)
        orders = self.given("orders").filter(chosen)
        first_seller = (
            self.given("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_suppkey").alias("seller_id"))
        )
        return orders.join(first_seller, "o_orderkey", "left")

    def raw(self) -> dict[str, DataFrame]:
        return {
            "order_items": self.order_items(),
            "customers": self.customers(),
            "sellers": self.sellers(),
            "orders": self.orders(),
            "orders_new": self.orders_new(),
        }


def _copies(twice: str) -> Column:
    """One row, or two where the condition holds, numbered 0 and 1."""
    return F.explode(F.expr(f"if({twice}, array(0, 1), array(0))"))
