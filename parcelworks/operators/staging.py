"""STG1-STG7: typed, trimmed, case-normalised staging tables.

Each function is a single ``select`` over a raw (text) table: narrow,
codegen'd, and column-pruned by Catalyst when a consumer reads only part of
it.  Columns a staging table does not name are dropped.  Casts:

* ids stay text;
* sequence, instalment, score and zip columns are strict integers;
* money and sizes are lenient doubles, timestamps lenient zone-less.

Raw tables normally arrive as text (CSV).  A raw column that is already
typed (a Parquet source) is cast directly: a typed value needs no lenient
parsing, and the result equals parsing its text form.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NullType, StringType

from parcelworks.functions.compat import (
    lenient_double,
    lenient_timestamp,
    normalise_lower,
    normalise_upper,
    strict_int,
)


def _is_text(raw: DataFrame, name: str) -> bool:
    return isinstance(raw.schema[name].dataType, StringType)


def _text(raw: DataFrame, name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _ts(raw: DataFrame, name: str) -> Column:
    if _is_text(raw, name):
        return lenient_timestamp(name).alias(name)
    return F.col(name).cast("timestamp_ntz").alias(name)


def _dbl(raw: DataFrame, name: str) -> Column:
    if _is_text(raw, name):
        return lenient_double(name).alias(name)
    return F.col(name).cast("double").alias(name)


def _int(raw: DataFrame, name: str) -> Column:
    if _is_text(raw, name):
        return strict_int(name, name).alias(name)
    if isinstance(raw.schema[name].dataType, (IntegralType, NullType)):
        return F.col(name).cast("int").alias(name)
    # fractional input rounds half away from zero, like decimal text
    return F.round(F.col(name), 0).cast("int").alias(name)


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text(raw, "order_id"),
        _text(raw, "customer_id"),
        normalise_lower("order_status").alias("order_status"),
        _ts(raw, "order_purchase_timestamp"),
        _ts(raw, "order_approved_at"),
        _ts(raw, "order_delivered_carrier_date"),
        _ts(raw, "order_delivered_customer_date"),
        _ts(raw, "order_estimated_delivery_date"),
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text(raw, "order_id"),
        _int(raw, "order_item_id"),
        _text(raw, "product_id"),
        _text(raw, "seller_id"),
        _ts(raw, "shipping_limit_date"),
        _dbl(raw, "price"),
        _dbl(raw, "freight_value"),
    )


def stage_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text(raw, "order_id"),
        _int(raw, "payment_sequential"),
        normalise_lower("payment_type").alias("payment_type"),
        _int(raw, "payment_installments"),
        _dbl(raw, "payment_value"),
    )


def stage_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text(raw, "review_id"),
        _text(raw, "order_id"),
        _int(raw, "review_score"),
        _ts(raw, "review_creation_date"),
        _ts(raw, "review_answer_timestamp"),
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text(raw, "customer_id"),
        _text(raw, "customer_unique_id"),
        _int(raw, "customer_zip_code_prefix"),
        normalise_lower("customer_city").alias("customer_city"),
        normalise_upper("customer_state").alias("customer_state"),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text(raw, "product_id"),
        F.nullif(normalise_lower("product_category_name"), F.lit("")).alias(
            "product_category_name"
        ),
        _dbl(raw, "product_weight_g"),
        _dbl(raw, "product_length_cm"),
        _dbl(raw, "product_height_cm"),
        _dbl(raw, "product_width_cm"),
    )


def stage_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text(raw, "seller_id"),
        _int(raw, "seller_zip_code_prefix"),
        normalise_lower("seller_city").alias("seller_city"),
        normalise_upper("seller_state").alias("seller_state"),
    )


STAGERS = {
    "orders": stage_orders,
    "order_items": stage_order_items,
    "payments": stage_payments,
    "reviews": stage_reviews,
    "customers": stage_customers,
    "products": stage_products,
    "sellers": stage_sellers,
}


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw tables keyed by logical name -> staging tables, same keys."""
    return {name: STAGERS[name](raw[name]) for name in STAGERS}
