"""Intermediate tables: quality flags, review de-duplication, payment roll-up, one place per zip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import clip
from bazaarlens.operators.keep_one import least_row

c = F.col


def int_orders(orders: DataFrame) -> DataFrame:
    """Adds is_valid_delivery: customer not before carrier; NULL while either time is missing."""
    carrier, customer = c("delivered_to_carrier_at"), c("delivered_to_customer_at")
    known = carrier.isNotNull() & customer.isNotNull()
    return orders.withColumn("is_valid_delivery", F.when(known, customer >= carrier))


# --- reviews -------------------------------------------------------------------------------------------------------


def review_counts(reviews: DataFrame) -> DataFrame:
    """Rows per review id (rows, not distinct orders)."""
    return reviews.groupBy("review_id").agg(F.count(F.lit(1)).alias("review_rows"))


def review_flag(reviews: DataFrame) -> DataFrame:
    """All reviews with is_duplicate_review. Only the repeated ids travel to the join, so a hot id stays split."""
    repeated = review_counts(reviews).filter(c("review_rows") > 1).select("review_id", F.lit(True).alias("_again"))
    return reviews.join(repeated, "review_id", "left").withColumn(
        "is_duplicate_review", F.coalesce("_again", F.lit(False))
    ).drop("_again")


def review_dedup1(reviews: DataFrame) -> DataFrame:
    """One row per review id, the one with the lowest order id, flagged by the rows the id had."""
    again = (F.count(F.lit(1)) > 1).alias("is_duplicate_review")
    return least_row(reviews, "review_id", [c("order_id"), c("score")], extra=[again])


def review_dedup2(reviews: DataFrame) -> DataFrame:
    """One row per order, the highest score first, then the lowest review id."""
    return least_row(reviews, "order_id", [c("score").isNull(), -c("score"), c("review_id")])


def int_order_reviews(reviews: DataFrame) -> DataFrame:
    """Flag, then one row per review id, then one row per order among the survivors. Columns that the caller has
    left out of ``reviews`` (the comment texts, say) are not shuffled; they only settle ties beyond order and score."""
    kept = [n for n in reviews.columns if n not in ("review_id", "order_id")]
    deduplicated = review_dedup2(review_dedup1(reviews))
    return deduplicated.select("review_id", "order_id", *kept, "is_duplicate_review")


# --- payments ------------------------------------------------------------------------------------------------------


def items_total(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.round(F.sum(c("price") + c("freight_value")), 2).alias("items_total"))


def payment_totals(payments: DataFrame) -> DataFrame:
    """One pass per order: every measure that a single partial aggregation can carry."""
    largest = F.struct(c("payment_value").alias("v"), c("payment_type").alias("t"))
    return payments.groupBy("order_id").agg(
        F.max(F.when(c("payment_value").isNotNull() & c("payment_type").isNotNull(), largest))["t"].alias("primary_payment_type"),
        clip(F.max("payment_installments"), low=1).alias("installments"),
        F.round(F.sum("payment_value"), 2).alias("total_payment_value"),
        F.coalesce(F.bool_or(c("payment_type") == "not_defined"), F.lit(False)).alias("has_not_defined_payment"),
        (F.max("payment_sequential") != F.count(F.lit(1))).alias("has_incomplete_payment_sequence"),
    )


def payment_methods(payments: DataFrame) -> DataFrame:
    """All payment types of an order, sorted, repeats kept, and how many different ones.

    Counted per order and type first, so what meets in one place is one entry per type, not one per payment.
    """
    per_type = (
        payments.filter(c("payment_type").isNotNull())
        .groupBy("order_id", "payment_type")
        .agg(F.count(F.lit(1)).cast("int").alias("times"))
    )
    entry = F.struct(c("payment_type").alias("t"), c("times").alias("n"))
    per_order = per_type.groupBy("order_id").agg(F.array_sort(F.collect_list(entry)).alias("_types"))
    return per_order.select(
        "order_id",
        F.flatten(F.transform("_types", lambda e: F.array_repeat(e["t"], e["n"]))).alias("payment_types"),
        F.size("_types").cast("bigint").alias("payment_method_count"),
    )


def with_items_check(totals: DataFrame, items: DataFrame) -> DataFrame:
    """Adds has_payment_value_mismatch and payment_value_gap; both NULL when the order has no items."""
    joined = totals.join(items_total(items), "order_id", "left")
    billed, paid = c("items_total"), c("total_payment_value")
    mismatch = F.when(billed.isNotNull(), F.coalesce(paid != billed, F.lit(False)))
    return (
        joined.withColumn("has_payment_value_mismatch", mismatch)
        .withColumn("payment_value_gap", F.round(billed - paid, 2))
        .drop("items_total")
    )


def int_order_payments(payments: DataFrame, items: DataFrame) -> DataFrame:
    full = with_items_check(payment_totals(payments), items).join(payment_methods(payments), "order_id", "left")
    return full.select(
        "order_id",
        "primary_payment_type",
        F.coalesce("payment_types", F.array().cast("array<string>")).alias("payment_types"),
        "installments",
        "total_payment_value",
        F.coalesce("payment_method_count", F.lit(0)).alias("payment_method_count"),
        "has_not_defined_payment",
        "has_incomplete_payment_sequence",
        "has_payment_value_mismatch",
        "payment_value_gap",
    )


# --- places --------------------------------------------------------------------------------------------------------


def int_geolocation_by_zip(geolocation: DataFrame) -> DataFrame:
    """Most frequent city and state of each zip, chosen separately; the alphabetically first wins a tie.

    Both columns are counted in one hash aggregation of (zip, kind, value) before anything is shuffled.
    """
    values = geolocation.select(
        "zip_code_prefix", F.expr("stack(2, 'city', city, 'state', state)").alias("kind", "value")
    )
    counted = values.groupBy("zip_code_prefix", "kind", "value").agg(F.count(F.lit(1)).alias("times"))

    def most_frequent(kind: str):
        wanted = (c("kind") == kind) & c("value").isNotNull()
        return F.min(F.when(wanted, F.struct((-c("times")).alias("n"), c("value").alias("v"))))["v"].alias(kind)

    return counted.groupBy("zip_code_prefix").agg(most_frequent("city"), most_frequent("state"))
