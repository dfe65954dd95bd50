"""Staging: rename and safe cast, one row in, one row out. A time that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import padded_zip, safe_date, safe_timestamp

c = F.col


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        c("order_status").alias("status"),
        safe_timestamp(c("order_purchase_timestamp")).alias("purchased_at"),
        safe_timestamp(c("order_approved_at")).alias("approved_at"),
        safe_timestamp(c("order_delivered_carrier_date")).alias("delivered_to_carrier_at"),
        safe_timestamp(c("order_delivered_customer_date")).alias("delivered_to_customer_at"),
        safe_date(c("order_estimated_delivery_date")).alias("estimated_delivery_date"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        padded_zip(c("customer_zip_code_prefix")).alias("zip_code_prefix"),
        c("customer_city").alias("city"),
        c("customer_state").alias("state"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        padded_zip(c("seller_zip_code_prefix")).alias("zip_code_prefix"),
        c("seller_city").alias("city"),
        c("seller_state").alias("state"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        c("product_category_name").alias("category_name_portuguese"),
        c("product_name_lenght").alias("product_name_length"),
        c("product_description_lenght").alias("product_description_length"),
        c("product_photos_qty").alias("photos_qty"),
        c("product_weight_g").alias("weight_g"),
        c("product_length_cm").alias("length_cm"),
        c("product_height_cm").alias("height_cm"),
        c("product_width_cm").alias("width_cm"),
    )


def stg_product_categories(raw: DataFrame) -> DataFrame:
    return raw.select(
        c("product_category_name").alias("category_name_portuguese"),
        c("product_category_name_english").alias("category_name"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        safe_timestamp(c("shipping_limit_date")).alias("shipping_limit_at"),
        "price",
        "freight_value",
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        c("review_score").alias("score"),
        c("review_comment_title").alias("comment_title"),
        c("review_comment_message").alias("comment_message"),
        safe_timestamp(c("review_creation_date")).alias("created_at"),
        safe_timestamp(c("review_answer_timestamp")).alias("answered_at"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    return raw.select(
        padded_zip(c("geolocation_zip_code_prefix")).alias("zip_code_prefix"),
        c("geolocation_lat").alias("latitude"),
        c("geolocation_lng").alias("longitude"),
        c("geolocation_city").alias("city"),
        c("geolocation_state").alias("state"),
    )
