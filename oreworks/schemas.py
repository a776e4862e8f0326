"""Column names and types of the raw tables.

Fixed values. Numeric ids are 64-bit: 32 bits run out at 2.1 billion orders.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "bigint": LongType(),
    "date": DateType(),
    "double": DoubleType(),
    "string": StringType(),
    "timestamp": TimestampType(),
}


def _schema(columns: str) -> StructType:
    named = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in named])


ORDER_ITEMS = _schema("order_id bigint, product_id bigint")

CUSTOMERS = _schema(
    "customer_id string, customer_name string, company string, shipping_address string,"
    " zipcode string, city string, state string, country string, dob string, email string,"
    " gender string, nationality string, phone string, username string,"
    " credit_card_no string, credit_card_type string, paypal_account string"
)

SELLERS = _schema(
    "seller_id string, seller_address string, seller_state string, seller_zipcode string,"
    " seller_country string, seller_rating string, seller_active_date string,"
    " seller_business_type string, seller_company_name string"
)

ORDERS = _schema(
    "order_id string, customer_id bigint, seller_id bigint, order_date timestamp,"
    " order_total_price double, payment_method string"
)

ORDERS_NEW = _schema(
    "order_id bigint, customer_id bigint, seller_id bigint, order_date date,"
    " payment_method string"
)
