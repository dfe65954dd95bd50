"""Delivery questions: speed, promise, and what single-item orders tell about weight and category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import clip, correlation, cut, days_between, rounded, share_true, text_label, row_count
from bazaarlens.operators.banding import gap_columns, histogram, top_rows
from bazaarlens.plans.orders import delivered, exact_avg, in_window
from bazaarlens.plans.settings import WEIGHT_EDGES, WEIGHT_LABELS, Settings
from bazaarlens.session import write_out

c = F.col


def days_early() -> Column:
    return days_between(c("delivered_to_customer_at"), c("estimated_delivery_date"))


def delivery_profile(orders: DataFrame, s: Settings) -> DataFrame:
    """Median over day counts: few distinct values, counted on the map side."""
    known = in_window(delivered(orders), s).filter(c("delivery_time_days").isNotNull())
    return known.agg(
        row_count().alias("delivered"),
        rounded(exact_avg("delivery_time_days"), 4).alias("avg_days"),
        F.median("delivery_time_days").alias("median_days"),
        rounded(share_true(c("is_delivered_on_time")), 4).alias("on_time_pct"),
    )


def delivery_clipped(orders: DataFrame, s: Settings) -> DataFrame:
    """Orders per (days capped at 40, days early held within -15..40), delivered within 0 to 200 days."""
    usual = in_window(delivered(orders), s).filter(c("delivery_time_days").between(0, 200))
    return usual.groupBy(
        clip(c("delivery_time_days"), high=40).alias("days"), clip(days_early(), low=-15, high=40).alias("days_early")
    ).agg(row_count().alias("orders"))


def delivery_histogram(orders: DataFrame, s: Settings, value: str, bins: int = 40) -> DataFrame:
    """Histogram of one clipped column. One row per day count is written, and only those few rows are binned."""
    counted = delivery_clipped(orders, s).groupBy(value).agg(F.sum("orders").alias("orders"))
    return histogram(write_out(counted, "day-counts"), value, "orders", bins)


def avg_days_early(orders: DataFrame, s: Settings) -> DataFrame:
    known = in_window(delivered(orders), s).withColumn("_early", days_early())
    return known.agg(rounded(exact_avg("_early"), 4).alias("avg_days_early"))


def state_buffer(orders: DataFrame, s: Settings) -> DataFrame:
    known = delivered(orders).filter(c("delivered_to_customer_at").isNotNull() & c("delivery_state").isNotNull())
    per_state = known.withColumn("_early", days_early()).groupBy(c("delivery_state").alias("state")).agg(
        row_count().alias("orders"),
        rounded(exact_avg("_early"), 4).alias("avg_buffer_days"),
        rounded(share_true(c("is_delivered_on_time")), 4).alias("on_time_pct"),
        rounded(exact_avg("delivery_time_days"), 4).alias("avg_delivery_days"),
    )
    tight = c("avg_buffer_days") < s.tight_buffer_days
    return per_state.filter(c("orders") >= s.min_state_orders).withColumn(
        "buffer_tier",
        text_label(tight, f"tight (<{s.tight_buffer_days}d)", f"generous (>={s.tight_buffer_days}d)"),
    )


def state_sigma(orders: DataFrame, s: Settings) -> DataFrame:
    """Spread of delivery days within each state."""
    known = delivered(orders).filter(c("delivery_time_days").isNotNull() & c("delivery_state").isNotNull())
    per_state = known.groupBy(c("delivery_state").alias("state")).agg(
        row_count().alias("orders"), rounded(F.stddev("delivery_time_days"), 4).alias("sigma_days")
    )
    return per_state.filter(c("orders") >= s.min_state_orders)


def single_item_orders(orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Delivered, reviewed orders with exactly one line, and that line's weight and category.

    The line's product comes out of the same aggregation that counts the lines.
    """
    single = (
        items.groupBy("order_id").agg(row_count().alias("_lines"), F.max("product_id").alias("product_id"))
        .filter(c("_lines") == 1).drop("_lines")
    )
    facts = delivered(orders).filter(c("review_score").isNotNull()).select(
        "order_id", "is_delivered_on_time", "review_score", "delivery_time_days"
    )
    product = products.select("product_id", "category_name_portuguese", "weight_g")
    return (
        single.join(facts, "order_id").join(product, "product_id").join(categories, "category_name_portuguese", "left")
        .select("order_id", "is_delivered_on_time", "review_score", "delivery_time_days", "weight_g", "category_name")
    )


def rounded_gap(df: DataFrame) -> DataFrame:
    return df.withColumns({n: rounded(c(n), 4) for n in ("late_score", "ontime_score", "lateness_penalty")})


def weight_profile(single: DataFrame) -> DataFrame:
    """Volume, score, speed and lateness gap per weight band in one aggregation."""
    banded = single.withColumn("weight_bucket", cut(c("weight_g"), WEIGHT_EDGES, WEIGHT_LABELS)).filter(
        c("weight_bucket").isNotNull()
    )
    per_band = banded.groupBy("weight_bucket").agg(
        row_count().alias("orders"),
        rounded(exact_avg("review_score"), 4).alias("avg_score"),
        rounded(exact_avg("delivery_time_days"), 4).alias("avg_delivery_days"),
        F.count("is_delivered_on_time").alias("_flagged"),
        *gap_columns(),
    )
    return rounded_gap(per_band.filter(c("_flagged") > 0).drop("_flagged"))


def category_gap(single: DataFrame, n: int = 8) -> DataFrame:
    """Lateness gap within the most frequent categories; frequency and gap come from one aggregation."""
    per_category = single.filter(c("category_name").isNotNull()).groupBy("category_name").agg(
        row_count().alias("orders"), F.count("is_delivered_on_time").alias("_flagged"), *gap_columns()
    )
    top = top_rows(per_category, [F.desc("orders"), F.asc("category_name")], n)
    return rounded_gap(top.filter(c("_flagged") > 0).drop("_flagged", "orders"))


def punctual_weight_corr(single: DataFrame) -> DataFrame:
    return single.filter(c("is_delivered_on_time")).agg(
        rounded(correlation(c("weight_g"), c("review_score")), 6).alias("corr_weight_score")
    )
