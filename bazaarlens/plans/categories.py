"""Category questions: revenue, concentration, freight burden."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import correlation, percent, ratio, rounded, text_label, row_count
from bazaarlens.operators.banding import top_rows
from bazaarlens.operators.ordering import share_of_total
from bazaarlens.plans.orders import exact_avg, in_window
from bazaarlens.plans.settings import Settings

c = F.col


def category_revenue(orders: DataFrame, lines: DataFrame, s: Settings) -> DataFrame:
    sold = lines.filter(c("category_name").isNotNull()).select(
        "order_id", "category_name", "total_item_value", "price"
    ).join(in_window(orders, s).select("order_id"), "order_id")
    per_category = sold.groupBy("category_name").agg(
        F.round(F.sum("total_item_value"), 2).alias("revenue"),
        row_count().alias("items"),
        rounded(exact_avg("price"), 4).alias("avg_price"),
    )
    return share_of_total(per_category, "revenue", "pct").withColumn("pct", rounded(c("pct"), 1))


def category_pareto(per_category: DataFrame) -> DataFrame:
    """Cumulative shares over categories, largest first. The windows see one row per category."""
    largest_first = Window.orderBy(F.desc("revenue"), F.asc("category_name"))
    everything = Window.partitionBy()
    so_far = F.sum("revenue").over(largest_first.rowsBetween(Window.unboundedPreceding, 0))
    position = F.row_number().over(largest_first)
    return per_category.select(
        "category_name",
        "revenue",
        position.alias("rank"),
        percent(so_far, F.sum("revenue").over(everything)).alias("cum_rev_pct"),
        percent(position, F.count(F.lit(1)).over(everything)).alias("cat_rank_pct"),
    )


def category_pareto_report(per_category: DataFrame) -> DataFrame:
    return category_pareto(per_category).withColumns(
        {n: rounded(c(n), 4) for n in ("cum_rev_pct", "cat_rank_pct")}
    )


def categories_to_share(per_category: DataFrame, share: int = 80) -> DataFrame:
    """Categories needed for ``share`` percent of revenue: those at or below it, plus one."""
    return category_pareto(per_category).agg(
        (F.count_if(c("cum_rev_pct") <= share) + 1).alias("n_to_share"), row_count().alias("categories")
    )


def category_economics(lines: DataFrame) -> DataFrame:
    volume = c("length_cm") * c("height_cm") * c("width_cm")
    per_category = lines.filter(c("category_name").isNotNull()).withColumn("_volume", volume).groupBy("category_name").agg(
        row_count().alias("items"),
        F.round(F.sum("total_item_value"), 2).alias("revenue"),
        exact_avg("price").alias("avg_price"),
        exact_avg("freight_value").alias("avg_freight"),
        percent(F.sum("freight_value"), F.sum("price")).alias("freight_pct"),
        exact_avg("weight_g").alias("avg_weight_g"),
        ratio(F.sum("_volume"), F.count("_volume") * 1000).alias("avg_volume_l"),
    )
    return share_of_total(per_category, "revenue", "rev_share_pct")


MEASURES = ("avg_price", "avg_freight", "freight_pct", "avg_weight_g", "avg_volume_l", "rev_share_pct")


def category_economics_report(economics: DataFrame) -> DataFrame:
    return economics.withColumns({n: rounded(c(n), 4) for n in MEASURES})


def large(economics: DataFrame, s: Settings) -> DataFrame:
    return economics.filter(c("items") >= s.min_category_items)


def category_coverage(economics: DataFrame, s: Settings) -> DataFrame:
    big = c("items") >= s.min_category_items
    return economics.agg(
        row_count().alias("categories"),
        F.count_if(big).alias("large_categories"),
        rounded(percent(F.sum(F.when(big, c("revenue"))), F.sum("revenue")), 4).alias("revenue_pct"),
    )


def freight_overall(lines: DataFrame) -> DataFrame:
    return lines.agg(rounded(percent(F.sum("freight_value"), F.sum("price")), 4).alias("freight_pct"))


def category_freight(lines: DataFrame, s: Settings, n: int = 10) -> DataFrame:
    """Freight burden of the largest categories by revenue against the platform's.

    The platform figure includes lines without a category, so all lines are grouped and its sums are taken over the
    per-category rows: one scan serves both.
    """
    everything = Window.partitionBy()
    per_category = lines.groupBy("category_name").agg(
        row_count().alias("items"),
        F.round(F.sum("total_item_value"), 2).alias("revenue"),
        F.sum("freight_value").alias("_freight"),
        F.sum("price").alias("_price"),
    )
    measured = per_category.withColumn("freight_pct", percent(c("_freight"), c("_price"))).withColumn(
        "overall_pct", percent(F.sum("_freight").over(everything), F.sum("_price").over(everything))
    )
    named = measured.filter(c("category_name").isNotNull() & (c("items") >= s.min_category_items))
    top = top_rows(named, [F.desc("revenue"), F.asc("category_name")], n)
    return top.select(
        "category_name", "items", "revenue",
        rounded(c("freight_pct"), 4).alias("freight_pct"),
        rounded(c("overall_pct"), 4).alias("overall_pct"),
        text_label(c("freight_pct") > c("overall_pct"), "above platform avg", "below platform avg").alias("burden"),
    )


def freight_ranking(economics: DataFrame, s: Settings) -> DataFrame:
    """Large categories by freight burden, heaviest first."""
    position = F.row_number().over(Window.orderBy(F.desc("freight_pct"), F.asc("category_name")))
    return large(economics, s).select("category_name", "items", rounded(c("freight_pct"), 4).alias("freight_pct"), position.alias("rank"))


def freight_range(economics: DataFrame, s: Settings) -> DataFrame:
    heaviest = F.struct((-c("freight_pct")).alias("p"), c("category_name").alias("n"))
    lightest = F.struct(c("freight_pct").alias("p"), c("category_name").alias("n"))
    return large(economics, s).agg(
        rounded(F.min("freight_pct"), 4).alias("min_pct"),
        F.min_by("category_name", lightest).alias("min_category"),
        rounded(F.max("freight_pct"), 4).alias("max_pct"),
        F.min_by("category_name", heaviest).alias("max_category"),
    )


def usual_items(lines: DataFrame, s: Settings) -> DataFrame:
    """Items of known weight without outliers, with their volume."""
    usual = lines.filter(
        c("weight_g").isNotNull() & (c("price") > 0) & c("freight_value").between(0, s.dear_freight)
        & (c("weight_g") < s.heavy_weight_g)
    )
    return usual.withColumn("volume_l", c("length_cm") * c("height_cm") * c("width_cm") / 1000)


def freight_drivers(lines: DataFrame, s: Settings) -> DataFrame:
    return usual_items(lines, s).agg(
        row_count().alias("items"),
        rounded(correlation(c("weight_g"), c("freight_value")), 6).alias("corr_weight_freight"),
        rounded(correlation(c("volume_l"), c("freight_value")), 6).alias("corr_volume_freight"),
    )


def price_burden(economics: DataFrame, s: Settings) -> DataFrame:
    return large(economics, s).agg(
        rounded(correlation(c("avg_price"), c("freight_pct")), 6).alias("corr_price_freight")
    )


def item_burden(lines: DataFrame) -> DataFrame:
    """Correlation of price and freight share over single lines."""
    priced = lines.filter(c("price") > 0).select(c("price").cast("double"), c("freight_value").cast("double"))
    return priced.agg(
        rounded(correlation(c("price"), c("freight_value") / c("price")), 6).alias("corr_price_burden")
    )


def priority_categories(lines: DataFrame, s: Settings) -> DataFrame:
    """Large categories with a freight burden above the platform's and revenue above their own median.

    Windows and median run over one row per category.
    """
    everything = Window.partitionBy()
    per_category = lines.groupBy("category_name").agg(
        row_count().alias("items"),
        F.round(F.sum("total_item_value"), 2).alias("revenue"),
        F.sum("freight_value").alias("_freight"),
        F.sum("price").alias("_price"),
        exact_avg("weight_g").alias("avg_weight_g"),
    )
    named = c("category_name").isNotNull()
    measured = per_category.select(
        "category_name", "items", "revenue", "avg_weight_g",
        percent(c("_freight"), c("_price")).alias("freight_pct"),
        percent(F.sum("_freight").over(everything), F.sum("_price").over(everything)).alias("_overall"),
        percent(c("revenue"), F.sum(F.when(named, c("revenue"))).over(everything)).alias("rev_share_pct"),
    )
    big = large(measured.filter(named), s).withColumn("_median", F.median("revenue").over(everything))
    return big.filter((c("freight_pct") > c("_overall")) & (c("revenue") > c("_median"))).select(
        "category_name", "revenue", *[rounded(c(n), 4).alias(n) for n in ("rev_share_pct", "freight_pct", "avg_weight_g")]
    )
