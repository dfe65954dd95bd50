"""Distance questions: how far an order travels and what distance does to speed and score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import (
    clip, row_count, correlation, cut, days_between, haversine_km, percent, rounded, share_true_known, text_label,
)
from bazaarlens.operators.banding import gap_table, histogram
from bazaarlens.operators.ordering import global_median
from bazaarlens.plans.delivery import rounded_gap
from bazaarlens.plans.orders import exact_avg
from bazaarlens.plans.settings import (
    DEADLINE_EDGES, DEADLINE_LABELS, DISTANCE_EDGES, DISTANCE_LABELS, SPEED_EDGES, SPEED_LABELS, Settings,
)
from bazaarlens.session import write_out

c = F.col


def zip_centroid(geolocation: DataFrame) -> DataFrame:
    return geolocation.groupBy("zip_code_prefix").agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")
    )


def order_distance(orders: DataFrame, lines: DataFrame, sellers: DataFrame, centroids: DataFrame) -> DataFrame:
    """One row per order whose delivery zip has a centroid: delivery facts, mean item weight, a category, and the
    mean distance to its distinct sellers.

    Sellers get their point before they meet the orders, lines shrink to (order, seller) pairs and to one weight row
    per order. The orders are read once: the pairs join them on the order key and are averaged on that same key, with
    no shuffle in between. The status is part of the grouping so that a filter on it still reaches the scan.
    """
    customer_point = centroids.select(
        c("zip_code_prefix").alias("delivery_zip_code_prefix"), c("latitude").alias("_clat"), c("longitude").alias("_clng")
    )
    base = orders.select(
        "order_id", "delivery_state", "status", "delivery_time_days", "is_delivered_on_time", "review_score",
        days_between(c("delivered_to_customer_at"), c("estimated_delivery_date")).alias("est_buffer_days"),
        "delivery_zip_code_prefix",
    ).join(customer_point, "delivery_zip_code_prefix").drop("delivery_zip_code_prefix")
    seller_point = sellers.select("seller_id", "zip_code_prefix").join(centroids, "zip_code_prefix").select(
        "seller_id", c("latitude").alias("_slat"), c("longitude").alias("_slng")
    )
    pairs = lines.select("order_id", "seller_id").distinct().join(seller_point, "seller_id").drop("seller_id")
    weights = lines.filter(c("product_known")).groupBy("order_id").agg(
        F.avg("weight_g").alias("weight_g"), F.max("category_name").alias("category_name")
    )
    km = haversine_km(c("_slat"), c("_slng"), c("_clat"), c("_clng"))
    of_order = ["delivery_state", "delivery_time_days", "is_delivered_on_time", "review_score", "est_buffer_days"]
    met = base.join(pairs, "order_id", "left").groupBy("order_id", "status").agg(
        *[F.first(n).alias(n) for n in of_order], F.avg(km).alias("dist_km")
    )
    return met.join(weights, "order_id", "left").select(
        "order_id", "delivery_state", "status", "delivery_time_days", "is_delivered_on_time", "review_score",
        "est_buffer_days", "weight_g", "category_name", "dist_km",
    )


def with_distance(pulled: DataFrame) -> DataFrame:
    """Delivered orders with a known distance, plus the promised window in days."""
    return pulled.filter((c("status") == "delivered") & c("dist_km").isNotNull()).withColumn(
        "est_window", c("est_buffer_days") + c("delivery_time_days")
    )


def distance_coverage(pulled: DataFrame) -> DataFrame:
    """Pulled orders, those with a distance, and the mean and exact median km. The pull is written once because
    counting and ranking both read it."""
    kept = write_out(pulled.select("order_id", "status", "dist_km", "est_buffer_days", "delivery_time_days"), "pulled")
    usable = (c("status") == "delivered") & c("dist_km").isNotNull()
    counts = kept.agg(
        row_count().alias("orders_pulled"),
        F.count_if(usable).alias("delivered_with_distance"),
        rounded(percent(F.count_if(usable), row_count()), 4).alias("coverage_pct"),
        rounded(F.avg(F.when(usable, c("dist_km"))), 4).alias("mean_km"),
    )
    median = global_median(with_distance(kept), "dist_km", "order_id").select(rounded(c("median"), 4))
    return counts.withColumn("median_km", median.scalar())


def promised_window(d: DataFrame) -> DataFrame:
    return d.select("order_id", "est_buffer_days", "delivery_time_days", "est_window")


def distance_histogram(d: DataFrame, bins: int = 40, limit_km: float = 2500.0) -> DataFrame:
    clipped = d.select(clip(c("dist_km"), high=limit_km).alias("km"), F.lit(1).alias("orders"))
    return histogram(write_out(clipped, "distances"), "km", "orders", bins)


def banded(d: DataFrame) -> DataFrame:
    return d.withColumn("dist_bucket", cut(c("dist_km"), DISTANCE_EDGES, DISTANCE_LABELS))


def by_distance(d: DataFrame) -> DataFrame:
    """Volume, speed, punctuality and score per band; a distance of exactly 0 belongs to no band."""
    return banded(d).filter(c("dist_bucket").isNotNull()).groupBy("dist_bucket").agg(
        row_count().alias("orders"),
        rounded(exact_avg("delivery_time_days"), 4).alias("avg_days"),
        rounded(share_true_known(c("is_delivered_on_time")), 4).alias("on_time_pct"),
        rounded(exact_avg("review_score"), 4).alias("avg_score"),
    )


def distance_gap(d: DataFrame) -> DataFrame:
    return rounded_gap(gap_table(banded(d), "dist_bucket"))


def deadline_gradient(d: DataFrame) -> DataFrame:
    known = d.filter(c("review_score").isNotNull() & c("est_buffer_days").isNotNull())
    band = cut(c("est_buffer_days"), DEADLINE_EDGES, DEADLINE_LABELS, right=False)
    scores = known.groupBy(band.alias("vs_estimate")).agg(rounded(exact_avg("review_score"), 4).alias("avg_score"))
    return scores.withColumn("side", text_label(c("vs_estimate").contains("late"), "late", "early"))


def punctual(d: DataFrame) -> DataFrame:
    return d.filter(c("is_delivered_on_time") & c("review_score").isNotNull())


def speed_bands(d: DataFrame) -> DataFrame:
    band = cut(c("delivery_time_days"), SPEED_EDGES, SPEED_LABELS)
    placed = punctual(d).withColumn("speed_bucket", band).filter(c("speed_bucket").isNotNull())
    return placed.groupBy("speed_bucket").agg(rounded(exact_avg("review_score"), 4).alias("avg_score"))


def speed_correlations(d: DataFrame) -> DataFrame:
    return punctual(d).agg(
        rounded(correlation(c("delivery_time_days"), c("review_score")), 6).alias("corr_days_score"),
        rounded(correlation(c("est_buffer_days"), c("review_score")), 6).alias("corr_early_score"),
    )


def window_correlations(d: DataFrame) -> DataFrame:
    return d.agg(
        rounded(correlation(c("dist_km"), c("est_window")), 6).alias("corr_distance_window"),
        rounded(correlation(c("delivery_time_days"), c("est_window")), 6).alias("corr_days_window"),
    )


def state_equity(d: DataFrame, s: Settings) -> DataFrame:
    """State means and the days by which a state is slower than a line through all states predicts. The line is
    fitted over the aggregated states, one row each."""
    per_state = d.filter(c("delivery_state").isNotNull()).groupBy("delivery_state").agg(
        row_count().alias("orders"),
        F.avg("dist_km").alias("dist_km"),
        F.avg("delivery_time_days").alias("avg_days"),
        share_true_known(c("is_delivered_on_time")).alias("on_time_pct"),
        exact_avg("review_score").alias("avg_score"),
        exact_avg("est_buffer_days").alias("buffer"),
    ).filter(c("orders") >= s.min_state_orders)
    states = Window.partitionBy()
    fitted = F.regr_intercept("avg_days", "dist_km").over(states) + F.regr_slope("avg_days", "dist_km").over(
        states
    ) * c("dist_km")
    return per_state.withColumn("slower_than_dist_predicts", c("avg_days") - fitted).select(
        "delivery_state",
        "orders",
        *[
            rounded(c(n), 4).alias(n)
            for n in ("dist_km", "avg_days", "on_time_pct", "avg_score", "buffer", "slower_than_dist_predicts")
        ],
    )


# factor name in the matrix -> column
MATRIX = {
    "dist_km": "dist_km",
    "delivery_days": "delivery_time_days",
    "days_early": "est_buffer_days",
    "weight_g": "weight_g",
    "review_score": "review_score",
    "on_time": "is_delivered_on_time",
}


def correlation_matrix(d: DataFrame) -> DataFrame:
    """All pairs of six order factors. Each order becomes one row per pair and the pairs are grouped: three aggregates
    stay inside generated code, where sixty-three in one row would not."""
    names = list(MATRIX)
    as_number = {n: c(source).cast("int") if n == "on_time" else c(source) for n, source in MATRIX.items()}
    factors = d.select(*[column.cast("double").alias(n) for n, column in as_number.items()])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), c(a).alias("x"), c(b).alias("y")) for a, b in pairs]
    found = factors.select(F.inline(F.array(*cells))).groupBy("a", "b").agg(
        rounded(correlation(c("x"), c("y")), 6).alias("corr")
    )
    once, turned = (F.struct(c(x).alias("factor"), c(y).alias("against")) for x, y in ("ab", "ba"))
    mirrored, once = F.array(once, turned), F.array(once)
    return found.select(F.explode(F.when(c("a") == c("b"), once).otherwise(mirrored)).alias("p"), "corr").select("p.*", "corr")
