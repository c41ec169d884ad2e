"""Raw input tables: logical names, file names and all-string schemas.

The raw stage is text: every column is ``StringType`` and typed later in
staging, so no inference pass is needed and types never depend on the data.
Columns are bound by header name; the lists below give the canonical order.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Logical table -> source file name inside a snapshot folder.
DATASET_FILES = {
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
}

# Source columns per file, in header order (the misspelt
# "lenght" headers are the source's own).
RAW_COLUMNS = {
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", "price", "freight_value",
    ],
    "payments": [
        "order_id", "payment_sequential", "payment_type",
        "payment_installments", "payment_value",
    ],
    "reviews": [
        "review_id", "order_id", "review_score", "review_comment_title",
        "review_comment_message", "review_creation_date", "review_answer_timestamp",
    ],
    "customers": [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ],
    "products": [
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "sellers": [
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
    ],
}

# Source columns staging never reads; a file may omit them.
OPTIONAL_COLUMNS = {
    "reviews": frozenset({"review_comment_title", "review_comment_message"}),
    "products": frozenset({
        "product_name_lenght", "product_description_lenght", "product_photos_qty",
    }),
}

# Tables whose free-text fields may hold quoted newlines.
MULTILINE_TABLES = frozenset({"reviews"})

LOGICAL_TABLES = tuple(DATASET_FILES)


def raw_schema(table: str) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS[table]])
