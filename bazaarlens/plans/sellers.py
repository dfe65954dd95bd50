"""Seller questions: revenue concentration, speed against score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import correlation, rounded, row_count
from bazaarlens.operators.ordering import ntile_bucket, order_globally, share_of_total
from bazaarlens.plans.marts import seller_order_lines, weighted_avg
from bazaarlens.plans.orders import delivered, in_window
from bazaarlens.plans.settings import Settings

c = F.col


def seller_revenue(orders: DataFrame, lines: DataFrame, s: Settings) -> DataFrame:
    """Revenue per seller in the window; lines shrink to (seller, order) before the join."""
    per_order = lines.groupBy("seller_id", "order_id").agg(F.sum("total_item_value").alias("_value"))
    return per_order.join(in_window(orders, s).select("order_id"), "order_id").groupBy("seller_id").agg(
        F.round(F.sum("_value"), 2).alias("revenue")
    )


def seller_deciles(orders: DataFrame, lines: DataFrame, s: Settings) -> DataFrame:
    ranked = order_globally(seller_revenue(orders, lines, s), [F.desc("revenue"), F.asc("seller_id")], "by-revenue").ranked()
    per_decile = ranked.groupBy(ntile_bucket(c("rank"), c("n_rows"), 10).alias("decile")).agg(
        F.round(F.sum("revenue"), 2).alias("revenue")
    )
    return share_of_total(per_decile, "revenue", "rev_share_pct").withColumn("rev_share_pct", rounded(c("rev_share_pct"), 1))


def seller_speed(orders: DataFrame, lines: DataFrame, s: Settings) -> DataFrame:
    """Sellers with enough delivered orders: item-grain average days and score."""
    facts = delivered(in_window(orders, s)).select("order_id", "delivery_time_days", "review_score")
    per_seller = seller_order_lines(lines).join(facts, "order_id").groupBy("seller_id").agg(
        row_count().alias("total_orders"),
        weighted_avg("delivery_time_days", "line_rows").alias("avg_delivery_time_days"),
        weighted_avg("review_score", "line_rows").alias("avg_review_score"),
    )
    return per_seller.filter(c("total_orders") >= s.min_seller_orders)


def seller_speed_report(speed: DataFrame) -> DataFrame:
    return speed.withColumns({n: rounded(c(n), 4) for n in ("avg_delivery_time_days", "avg_review_score")})


def speed_score_corr(speed: DataFrame) -> DataFrame:
    return speed.agg(rounded(correlation(c("avg_delivery_time_days"), c("avg_review_score")), 6).alias("corr_days_score"))
