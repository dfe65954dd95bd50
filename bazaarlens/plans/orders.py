"""Order questions: headline figures, growth, status, payment, score and place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import percent, ratio, rounded, share_true, share_true_known, text_label, row_count
from bazaarlens.operators.banding import top_rows
from bazaarlens.operators.ordering import pct_change, share_of_total
from bazaarlens.plans.settings import DEAD_STATUSES, Settings

c = F.col


def between(df: DataFrame, start: str, end: str) -> DataFrame:
    at = c("purchased_at")
    return df.filter((at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz")))


def in_window(df: DataFrame, s: Settings) -> DataFrame:
    return between(df, s.window_start, s.window_end)


def complete_quarters(df: DataFrame, s: Settings) -> DataFrame:
    return between(df, s.window_start, s.quarters_end).filter(~c("status").isin(*DEAD_STATUSES))


def exact_avg(name: str):
    """Aggregate: average as an exact ratio."""
    return ratio(F.sum(name), F.count(name))


def delivered(df: DataFrame) -> DataFrame:
    return df.filter(c("status") == "delivered")


def kpi(orders: DataFrame) -> DataFrame:
    return orders.agg(
        row_count().alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.round(F.sum("total_payment_value"), 2).alias("revenue"),
        rounded(exact_avg("total_payment_value"), 4).alias("aov"),
        rounded(share_true(c("status") == "delivered"), 4).alias("delivered_pct"),
        rounded(exact_avg("review_score"), 4).alias("avg_review"),
    )


def on_time_pct(orders: DataFrame) -> DataFrame:
    return delivered(orders).agg(rounded(share_true_known(c("is_delivered_on_time")), 4).alias("on_time_pct"))


def coverage(orders: DataFrame, s: Settings) -> DataFrame:
    at = c("purchased_at")
    inside = (at >= F.lit(s.window_start).cast("timestamp_ntz")) & (at < F.lit(s.window_end).cast("timestamp_ntz"))
    return orders.agg(
        F.min(at).cast("date").alias("first_order"),
        F.max(at).cast("date").alias("last_order"),
        row_count().alias("orders_total"),
        F.count_if(inside).alias("orders_in_window"),
        F.count_distinct("customer_id").alias("customers_total"),
    )


def monthly(orders: DataFrame, s: Settings) -> DataFrame:
    month = F.date_trunc("month", "purchased_at").cast("date").alias("month")
    return in_window(orders, s).groupBy(month).agg(
        row_count().alias("orders"), F.round(F.sum("total_payment_value"), 2).alias("revenue")
    )


def monthly_growth(orders: DataFrame, s: Settings) -> DataFrame:
    grown = pct_change(monthly(orders, s), "month", "revenue", "mom_pct")
    return grown.withColumn("mom_pct", rounded(c("mom_pct"), 4))


def quarterly_growth(orders: DataFrame, s: Settings) -> DataFrame:
    year, quarter = F.year("purchased_at").alias("yr"), F.quarter("purchased_at").alias("qtr")
    sums = complete_quarters(orders, s).groupBy(year, quarter).agg(
        F.round(F.sum("total_payment_value"), 2).alias("revenue")
    )
    label = F.concat(F.lit("Q"), c("qtr").cast("string"), F.lit("-"), c("yr").cast("string"))
    # one sortable number per quarter
    placed = sums.withColumn("period", label).withColumn("_at", c("yr") * 4 + c("qtr"))
    grown = pct_change(placed, "_at", "revenue", "qoq_growth_pct")
    return grown.select("period", "yr", "qtr", "revenue", rounded(c("qoq_growth_pct"), 4).alias("qoq_growth_pct"))


def score_by_punctuality(orders: DataFrame) -> DataFrame:
    known = delivered(orders).filter(c("review_score").isNotNull() & c("is_delivered_on_time").isNotNull())
    return known.groupBy("is_delivered_on_time").agg(
        row_count().alias("orders"), rounded(exact_avg("review_score"), 4).alias("avg_score")
    ).withColumn("label", text_label(c("is_delivered_on_time"), "on time", "late"))


def status_mix(orders: DataFrame, s: Settings) -> DataFrame:
    counted = in_window(orders, s).groupBy("status").agg(row_count().alias("orders"))
    return share_of_total(counted, "orders", "pct").withColumn("pct", rounded(c("pct"), 2))


def payment_mix(orders: DataFrame, s: Settings) -> DataFrame:
    known = in_window(orders, s).filter(c("primary_payment_type").isNotNull() & c("total_payment_value").isNotNull())
    per_type = known.groupBy(c("primary_payment_type").alias("type")).agg(
        row_count().alias("orders"),
        rounded(exact_avg("installments"), 4).alias("avg_installments"),
        rounded(exact_avg("total_payment_value"), 4).alias("aov"),
    )
    return share_of_total(per_type, "orders", "order_share_pct").withColumn(
        "order_share_pct", rounded(c("order_share_pct"), 1)
    )


def score_mix(orders: DataFrame, s: Settings) -> DataFrame:
    counted = in_window(orders, s).filter(c("review_score").isNotNull()).groupBy("review_score").agg(row_count().alias("n"))
    return share_of_total(counted, "n", "pct").withColumn("pct", rounded(c("pct"), 1))


def top_states_in_window(orders: DataFrame, s: Settings, n: int = 10) -> DataFrame:
    """Ten largest states, a missing one included; shares are of these ten only."""
    per_state = in_window(orders, s).groupBy(c("delivery_state").alias("state")).agg(
        row_count().alias("orders"), F.round(F.sum("total_payment_value"), 2).alias("revenue")
    )
    top = top_rows(per_state, [F.desc("orders"), F.asc_nulls_first("state")], n)
    return share_of_total(top, "orders", "order_share_pct").withColumn(
        "order_share_pct", rounded(c("order_share_pct"), 1)
    )


def state_share(orders: DataFrame, n: int = 8) -> DataFrame:
    """Eight largest known states; shares are of all orders, those without a state included."""
    per_state = orders.groupBy(c("delivery_state").alias("state")).agg(row_count().alias("orders"))
    shared = share_of_total(per_state, "orders", "share").withColumn("share", rounded(c("share"), 4))
    return top_rows(shared.filter(c("state").isNotNull()), [F.desc("orders"), F.asc("state")], n)


def freight_by_quarter(orders: DataFrame, lines: DataFrame, s: Settings) -> DataFrame:
    quarter = F.date_trunc("quarter", "purchased_at").cast("date").alias("quarter")
    sold = complete_quarters(orders, s).select("order_id", "purchased_at").join(
        lines.select("order_id", "price", "freight_value"), "order_id"
    )
    sums = sold.groupBy(quarter).agg(
        F.round(F.sum("freight_value"), 2).alias("total_freight"),
        F.round(F.sum("price"), 2).alias("total_price"),
        rounded(percent(F.sum("freight_value"), F.sum("price")), 4).alias("freight_pct"),
    )
    label = F.concat(F.year("quarter").cast("string"), F.lit("Q"), F.quarter("quarter").cast("string"))
    return sums.withColumn("label", label)
