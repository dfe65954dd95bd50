"""Star schema: four dimensions, two facts, two summaries.

Lookups are joined without a broadcast hint: Catalyst broadcasts a side whose size it knows to be small and
AQE re-plans the rest from measured sizes, splitting a hot key of the fact side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import days_between, indicator, ratio, rounded

c = F.col


def dim_geolocation(by_zip: DataFrame) -> DataFrame:
    return by_zip.select("zip_code_prefix", "city", "state")


def dim_customers(customers: DataFrame, orders: DataFrame, places: DataFrame) -> DataFrame:
    """Zip of each person's latest order; someone without an order has no row.

    A missing purchase time sorts as oldest, equal times go to the higher customer id.
    """
    bought = customers.select("customer_id", "customer_unique_id", "zip_code_prefix").join(
        orders.select("customer_id", "purchased_at"), "customer_id"
    )
    latest = bought.groupBy("customer_unique_id").agg(
        F.max_by("zip_code_prefix", F.struct("purchased_at", "customer_id", "zip_code_prefix")).alias("zip_code_prefix")
    )
    return latest.join(places, "zip_code_prefix", "left").select(
        c("customer_unique_id").alias("customer_id"), "zip_code_prefix", "city", "state"
    )


def dim_sellers(sellers: DataFrame, places: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "zip_code_prefix").join(places, "zip_code_prefix", "left").select(
        "seller_id", "zip_code_prefix", "city", "state"
    )


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    return products.join(categories, "category_name_portuguese", "left").select(
        "product_id",
        "category_name_portuguese",
        "category_name",
        "product_name_length",
        "product_description_length",
        "photos_qty",
        "weight_g",
        "length_cm",
        "height_cm",
        "width_cm",
    )


def on_time_flag():
    """Delivered by midnight at the start of the promised day (a time is compared with a date)."""
    delivered, promised = c("delivered_to_customer_at"), c("estimated_delivery_date")
    known = delivered.isNotNull() & promised.isNotNull()
    return F.when(known, delivered <= promised.cast("timestamp_ntz"))


def fct_orders(
    orders: DataFrame, customers: DataFrame, places: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Order fact. Payments, reviews and places are unique per key, so each left join leaves the plan when none of
    its columns is read downstream."""
    who = customers.select("customer_id", "customer_unique_id", c("zip_code_prefix").alias("delivery_zip_code_prefix"))
    where = places.select(
        c("zip_code_prefix").alias("delivery_zip_code_prefix"),
        c("city").alias("delivery_city"),
        c("state").alias("delivery_state"),
    )
    paid = payments.select(
        "order_id", "primary_payment_type", "installments", "total_payment_value", "has_payment_value_mismatch"
    )
    opinion = reviews.filter(~c("is_duplicate_review")).select(
        "order_id", c("score").alias("review_score"), "is_duplicate_review"
    )
    joined = (
        orders.join(who, "customer_id")
        .join(paid, "order_id", "left")
        .join(opinion, "order_id", "left")
        .join(where, "delivery_zip_code_prefix", "left")
    )
    return joined.select(
        "order_id",
        c("customer_unique_id").alias("customer_id"),
        "status",
        "purchased_at",
        "approved_at",
        "delivered_to_carrier_at",
        "delivered_to_customer_at",
        "estimated_delivery_date",
        "is_valid_delivery",
        on_time_flag().alias("is_delivered_on_time"),
        days_between(c("purchased_at"), c("delivered_to_customer_at")).alias("delivery_time_days"),
        "delivery_zip_code_prefix",
        "delivery_city",
        "delivery_state",
        "primary_payment_type",
        "installments",
        "total_payment_value",
        "has_payment_value_mismatch",
        "review_score",
        "is_duplicate_review",
    )


def order_lines(items: DataFrame) -> DataFrame:
    """Item fact before any lookup; enough for every question about money per order or seller."""
    return items.withColumn("total_item_value", c("price") + c("freight_value"))


def product_lines(items: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Order lines with what their product tells. The lookups hang on the staged tables one after the other, so the
    planner sees each real size; ``product_known`` separates an unknown product from one without attributes."""
    facts = products.select(
        "product_id", "category_name_portuguese", "weight_g", "length_cm", "height_cm", "width_cm",
        F.lit(True).alias("product_known"),
    )
    return order_lines(items).join(facts, "product_id", "left").join(categories, "category_name_portuguese", "left")


def fct_order_items(lines: DataFrame, sellers: DataFrame, places: DataFrame) -> DataFrame:
    """Item fact from order lines with their category."""
    seller_zip = sellers.select("seller_id", "zip_code_prefix")
    return lines.join(seller_zip, "seller_id", "left").join(places, "zip_code_prefix", "left").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_at",
        "price",
        "freight_value",
        "total_item_value",
        "category_name",
        c("city").alias("seller_city"),
        c("state").alias("seller_state"),
    )


def mart_customer_summary(orders: DataFrame) -> DataFrame:
    """Per person. The on-time rate divides on-time orders by orders with both delivery times, so an order without
    a carrier time can push it above 1."""
    spend = F.coalesce(c("total_payment_value"), F.lit(0))
    n = F.count("order_id")
    return orders.groupBy("customer_id").agg(
        n.alias("total_orders"),
        F.round(F.sum(spend), 2).alias("total_spend"),
        rounded(ratio(F.sum(spend), F.count(F.lit(1))), 2).alias("avg_order_value"),
        F.min("purchased_at").alias("first_order_at"),
        F.max("purchased_at").alias("last_order_at"),
        rounded(ratio(F.sum("review_score"), F.count("review_score")), 2).alias("avg_review_score"),
        rounded(ratio(F.sum(indicator(c("is_delivered_on_time"))), F.count("is_valid_delivery")), 2).alias(
            "on_time_delivery_rate"
        ),
        (n > 1).alias("is_repeat_customer"),
    )


def seller_order_lines(lines: DataFrame, *more: Column) -> DataFrame:
    """Lines summed per seller and order: the weight an order has in item-grain averages is ``line_rows``."""
    return lines.groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("line_rows"),
        F.count("order_item_id").alias("items"),
        F.sum("price").alias("price_sum"),
        F.count("price").alias("priced"),
        F.sum("freight_value").alias("freight_sum"),
        *more,
    )


def weighted_avg(value: str, weight: str):
    """Aggregate: average of ``value`` at the finer grain that ``weight`` counts; unknown values carry no weight."""
    return ratio(F.sum(c(value) * c(weight)), F.sum(F.when(c(value).isNotNull(), c(weight))))


def mart_seller_performance(lines: DataFrame, orders: DataFrame, sellers: DataFrame) -> DataFrame:
    """Per seller, item-grain averages (an order counts once per line); a seller without lines has no row.

    Lines meet their order and shrink to seller and order where they meet, so both shuffle by order once, and the
    distinct order count is a plain count.
    The distinct (seller, category) pairs enter the same final aggregation as rows of their own, instead of an
    expansion of every line or a join of two per-seller tables.
    """
    facts = orders.select("order_id", "delivery_time_days", "review_score", "is_valid_delivery", "is_delivered_on_time")
    sold = lines.select("seller_id", "order_id", "order_item_id", "price", "freight_value")
    per_order = seller_order_lines(
        sold.join(facts, "order_id", "left"),
        *[f for n in ("delivery_time_days", "review_score") for f in (F.sum(n).alias(f"{n}_sum"), F.count(n).alias(f"{n}_known"))],
        F.count_if("is_delivered_on_time").alias("on_time"),
        F.count("is_valid_delivery").alias("judged"),
    )
    kinds = lines.select("seller_id", "category_name").distinct()
    per_seller = per_order.unionByName(kinds, allowMissingColumns=True).groupBy("seller_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("items").alias("total_items_sold"),
        F.round(F.sum("price_sum"), 2).alias("total_revenue"),
        rounded(ratio(F.sum("price_sum"), F.sum("priced")), 2).alias("avg_item_price"),
        F.round(F.sum("freight_sum"), 2).alias("total_freight_charged"),
        rounded(ratio(F.sum("delivery_time_days_sum"), F.sum("delivery_time_days_known")), 1).alias("avg_delivery_time_days"),
        rounded(ratio(F.sum("on_time"), F.sum("judged")), 2).alias("on_time_delivery_rate"),
        rounded(ratio(F.sum("review_score_sum"), F.sum("review_score_known")), 2).alias("avg_review_score"),
        F.count("category_name").alias("distinct_categories"),
    )
    return per_seller.join(sellers.select("seller_id", "city", "state"), "seller_id", "left").select(
        "seller_id", "city", "state", "total_orders", "total_items_sold", "total_revenue", "avg_item_price",
        "total_freight_charged", "avg_delivery_time_days", "on_time_delivery_rate", "avg_review_score",
        "distinct_categories",
    )
