"""Customer questions: value, repeat purchase, concentration, ticket groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import correlation, clip, percent, ratio, rounded, share_true, row_count
from bazaarlens.operators.banding import top_per_group
from bazaarlens.operators.keep_one import keep_first
from bazaarlens.operators.kmeans import BLOCKS, Line, lloyd, start_positions
from bazaarlens.operators.ordering import Ordered, global_median, order_globally, quantile_bucket, share_of_total
from bazaarlens.plans.orders import exact_avg, in_window
from bazaarlens.plans.settings import Settings
from bazaarlens.session import write_out

c = F.col


def customer_base(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Per customer: orders, items, value and average item price.

    Lines are summed per order before they meet the order fact, so orders can be counted instead of counted distinct.
    """
    per_order = lines.groupBy("order_id").agg(
        row_count().alias("_items"),
        F.sum("total_item_value").alias("_value"),
        F.sum("price").alias("_price"),
        F.count("price").alias("_priced"),
    )
    return per_order.join(orders.select("order_id", "customer_id"), "order_id").groupBy("customer_id").agg(
        row_count().alias("n_orders"),
        F.sum("_items").alias("n_items"),
        F.round(F.sum("_value"), 2).alias("total_value"),
        ratio(F.sum("_price"), F.sum("_priced")).alias("avg_ticket"),
    )


def customer_base_report(base: DataFrame) -> DataFrame:
    return base.withColumn("avg_ticket", rounded(c("avg_ticket"), 4))


def repeat_pct(base: DataFrame) -> DataFrame:
    return base.agg(rounded(share_true(c("n_orders") >= 2), 4).alias("repeat_pct"))


def value_correlations(base: DataFrame) -> DataFrame:
    return base.agg(
        rounded(correlation(c("total_value"), c("avg_ticket")), 6).alias("corr_value_ticket"),
        rounded(correlation(c("total_value"), c("n_items")), 6).alias("corr_value_items"),
    )


def by_ticket(base: DataFrame) -> Ordered:
    """Customers from the lowest to the highest average ticket; equal tickets follow the customer id."""
    priced = base.filter(c("avg_ticket").isNotNull())
    return order_globally(priced, [F.asc("avg_ticket"), F.asc("customer_id")], "by-ticket")


def ticket_quintiles(base: DataFrame) -> DataFrame:
    """Every priced customer with its quintile 1..5."""
    ranked = by_ticket(base).ranked()
    return ranked.withColumn("quintile", quantile_bucket(c("rank"), c("n_rows"), 5)).drop("rank", "n_rows")


def quintile_summary(base: DataFrame) -> DataFrame:
    per_group = ticket_quintiles(base).groupBy("quintile").agg(
        rounded(F.min("avg_ticket"), 4).alias("lo"),
        rounded(F.max("avg_ticket"), 4).alias("hi"),
        row_count().alias("customers"),
        rounded(exact_avg("n_items"), 4).alias("avg_items"),
        F.round(F.sum("total_value"), 2).alias("revenue"),
    )
    return share_of_total(per_group, "revenue", "rev_share").select(
        F.concat(F.lit("Q"), c("quintile").cast("string")).alias("quintile"),
        "lo", "hi", "customers", "avg_items", "revenue", rounded(c("rev_share"), 4).alias("rev_share"),
    )


def quintile_category_mix(base: DataFrame, lines: DataFrame, orders: DataFrame, n: int = 6) -> DataFrame:
    """Most bought categories of the lowest and the highest ticket quintile.

    Lines shrink to counts per order and category, then per customer and category, before each join.
    """
    per_order = lines.filter(c("category_name").isNotNull()).groupBy("order_id", "category_name").agg(row_count().alias("_n"))
    per_customer = per_order.join(orders.select("order_id", "customer_id"), "order_id").groupBy(
        "customer_id", "category_name"
    ).agg(F.sum("_n").alias("_n"))
    ends = ticket_quintiles(base).filter(c("quintile").isin(1, 5)).select("customer_id", "quintile")
    mixed = per_customer.join(ends, "customer_id").groupBy("quintile", "category_name").agg(F.sum("_n").alias("items"))
    top = top_per_group(mixed, "quintile", [F.desc("items"), F.asc("category_name")], n)
    return top.withColumn("quintile", F.concat(F.lit("Q"), c("quintile").cast("string")))


def basket_size(lines: DataFrame) -> DataFrame:
    per_order = lines.groupBy("order_id").agg(row_count().alias("n_items"))
    sizes = per_order.groupBy("n_items").agg(row_count().alias("orders"))
    return share_of_total(sizes, "orders", "pct").withColumn("pct", rounded(c("pct"), 4))


def orders_per_customer_clipped(base: DataFrame, limit: int = 4) -> DataFrame:
    """Share of customers by number of orders, ``limit`` and more together."""
    counts = base.groupBy(clip(c("n_orders"), high=limit).alias("n_orders")).agg(row_count().alias("customers"))
    return share_of_total(counts, "customers", "pct").withColumn("pct", rounded(c("pct"), 4))


# --- inside the window ---------------------------------------------------------------------------------------------


def window_customers(orders: DataFrame, s: Settings) -> DataFrame:
    """Orders and spend per customer; the order id is the key of the fact, so a count is a distinct count."""
    return in_window(orders, s).groupBy("customer_id").agg(
        F.count("order_id").alias("orders"), F.round(F.sum("total_payment_value"), 2).alias("spend")
    )


def window_summary(orders: DataFrame, s: Settings) -> DataFrame:
    """Customers, repeat rate, mean and exact median spend. The customer table is written once: the counts and the
    ordering both read it."""
    per_customer = write_out(window_customers(orders, s), "window-customers")
    counts = per_customer.agg(
        row_count().alias("customers"),
        rounded(share_true(c("orders") >= 2), 4).alias("repeat_pct"),
        rounded(exact_avg("spend"), 4).alias("mean_spend"),
    )
    median = global_median(per_customer, "spend", "customer_id").select(rounded(c("median"), 4))
    return counts.withColumn("median_spend", median.scalar())


def orders_per_customer(orders: DataFrame, s: Settings) -> DataFrame:
    return window_customers(orders, s).groupBy(c("orders").alias("orders_per_customer")).agg(row_count().alias("customers"))


def customer_pareto(orders: DataFrame, s: Settings) -> DataFrame:
    """Customers by spend, largest first, with cumulative spend; no payment counts as 0."""
    spend = window_customers(orders, s).select("customer_id", F.coalesce("spend", F.lit(0)).alias("spend"))
    return order_globally(spend, [F.desc("spend"), F.asc("customer_id")], "by-spend").running("spend")


def customer_pareto_curve(orders: DataFrame, s: Settings) -> DataFrame:
    return customer_pareto(orders, s).select(
        "customer_id", "spend", "rank",
        rounded(percent(c("running_value"), c("grand_total")), 4).alias("cum_rev_pct"),
        rounded(percent(c("rank"), c("n_rows")), 4).alias("cum_cust_pct"),
    )


def customer_pareto_summary(orders: DataFrame, s: Settings) -> DataFrame:
    """Share of customers behind 80% of spend, and the spend share of the top 10% and 20%.

    The 80% point is the first customer at or above it. A top tenth that rounds to nobody reads the last row.
    """
    return concentration(customer_pareto(orders, s))


def concentration(curve: DataFrame) -> DataFrame:
    reached = c("running_value") * 100 >= c("grand_total") * 80
    share = percent(c("running_value"), c("grand_total"))

    def top_share(tenths: int) -> Column:
        last = F.floor(c("n_rows") * tenths / 10)
        return F.max(F.when(c("rank") == F.when(last == 0, c("n_rows")).otherwise(last), share))

    return curve.agg(
        row_count().alias("customers"),
        rounded(percent(F.min(F.when(reached, c("rank"))), F.max("n_rows")), 4).alias("pct_customers_for_80"),
        rounded(top_share(1), 4).alias("top10_pct"),
        rounded(top_share(2), 4).alias("top20_pct"),
    )


# --- ticket clusters -----------------------------------------------------------------------------------------------


def ticket_clusters(base: DataFrame, most: int = 6, rounds: int = 50, blocks: int = BLOCKS) -> DataFrame:
    """k, explained_pct, converged: percent of the variance of log10(ticket) that 1-D k-means explains for k = 1..most.

    ``converged`` is FALSE where the centers were still moving after ``rounds`` rounds.
    """
    x = F.log10(F.greatest(c("avg_ticket"), F.lit(1)).cast("double"))
    points = base.filter(c("avg_ticket").isNotNull()).groupBy(x.alias("x")).agg(row_count().alias("n"))
    ordered = order_globally(points, [F.asc("x")], "ticket-points")
    line = Line(ordered, blocks)
    n, s1, s2 = map(float, line.all)
    kind = "k int, explained_pct double, converged boolean"
    if not n:
        return base.sparkSession.createDataFrame([], kind)
    total = max(0.0, s2 - s1 * s1 / n)
    spots = {k: start_positions(int(n), k) for k in range(2, most + 1)}
    x_at = line.at_ranks(ordered, sorted({r for places in spots.values() for low, high, _ in places for r in (low, high)}))
    starts = {
        k: [x_at[low] + (x_at[high] - x_at[low]) * weight for low, high, weight in places] for k, places in spots.items()
    }
    within = {1: (total, True), **lloyd(line, starts, rounds)}
    explained = [(k, 100 * (1 - v / total) if total else None, done) for k, (v, done) in sorted(within.items())]
    result = base.sparkSession.createDataFrame(explained, kind)
    return result.withColumn("explained_pct", F.round("explained_pct", 4))


# --- repeat purchase -----------------------------------------------------------------------------------------------


def order_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.count("order_id").alias("_n"))


def consumable_buyers(orders: DataFrame, lines: DataFrame, s: Settings) -> DataFrame:
    """First consumable purchase per customer; orders with such a line are found once, then summed up."""
    bought = lines.filter(c("category_name").isin(*s.consumables)).select("order_id").distinct()
    return orders.select("order_id", "customer_id", "purchased_at").join(bought, "order_id", "left_semi").groupBy(
        "customer_id"
    ).agg(F.min("purchased_at").alias("first_at"))


def consumable_repeat(orders: DataFrame, lines: DataFrame, s: Settings) -> DataFrame:
    return consumable_buyers(orders, lines, s).join(order_counts(orders), "customer_id").agg(
        rounded(share_true(c("_n") >= 2), 4).alias("repeat_pct")
    )


def runway_repeat(orders: DataFrame, lines: DataFrame, s: Settings) -> DataFrame:
    """Repeat rate of consumable buyers whose first purchase lies more or less than the runway before the last order."""
    last = orders.agg(F.max("purchased_at")).scalar()
    early = c("first_at") < last - F.make_interval(months=F.lit(s.runway_months))
    months = s.runway_months
    cohort = F.when(early, f"early (>{months}mo runway)").otherwise(f"late (<{months}mo runway)")
    counted = consumable_buyers(orders, lines, s).withColumn("cohort", cohort).join(order_counts(orders), "customer_id")
    return counted.groupBy("cohort").agg(rounded(share_true(c("_n") >= 2), 4).alias("repeat_pct"))


def repeat_bars(orders: DataFrame, lines: DataFrame, s: Settings) -> DataFrame:
    """Repeat rate of all customers with lines, of consumable buyers, and of these with a longer and a shorter runway.

    Lines and orders are read once: a written row per customer has the counts that all four bars need.
    """
    sold = lines.groupBy("order_id").agg(F.max(F.coalesce(c("category_name").isin(*s.consumables), F.lit(False))).alias("consumable"))
    bought = orders.select("order_id", "customer_id", "purchased_at").join(sold, "order_id", "left")
    people = bought.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        F.count("consumable").alias("with_lines"),
        F.max("consumable").alias("buyer"),
        F.min(F.when(c("consumable"), c("purchased_at"))).alias("first_at"),
        F.max("purchased_at").alias("last_at"),
    )
    people = write_out(people, "customer-runways")
    early = c("first_at") < people.agg(F.max("last_at")).scalar() - F.make_interval(months=F.lit(s.runway_months))
    runway = F.when(early, f"Consumable (>{s.runway_months}mo runway)").otherwise(f"Consumable (<{s.runway_months}mo runway)")
    buys = c("buyer") & c("customer_id").isNotNull()
    bar = lambda when, group, repeat: F.when(when, F.struct(group.alias("group"), repeat.alias("repeat")))
    bars = F.array(
        bar(c("with_lines") > 0, F.lit("All customers"), c("with_lines") >= 2),
        bar(buys, F.lit("Consumable buyers"), c("orders") >= 2),
        bar(buys, runway, c("orders") >= 2),
    )
    counted = people.select(F.inline(bars)).filter(c("group").isNotNull())
    return counted.groupBy("group").agg(rounded(share_true(c("repeat")), 4).alias("repeat_pct"))


def return_gap(orders: DataFrame) -> DataFrame:
    """Median days from a customer's first order to the next. Only two rows per customer leave each task."""
    two = keep_first(
        orders.select("customer_id", "order_id", "purchased_at").filter(c("purchased_at").isNotNull()),
        ["customer_id"], [F.asc("purchased_at"), F.asc("order_id")], rows=2,
    )
    gaps = two.groupBy("customer_id").agg(
        row_count().alias("_n"), F.datediff(F.max("purchased_at"), F.min("purchased_at")).alias("days")
    )
    return gaps.filter(c("_n") == 2).agg(row_count().alias("returning"), F.median("days").alias("median_days"))


def big_ticket_tail(base: DataFrame, s: Settings) -> DataFrame:
    big = c("avg_ticket") > s.big_ticket
    return base.agg(
        rounded(share_true(big), 4).alias("customer_pct"),
        rounded(percent(F.sum(F.when(big, c("total_value"))), F.sum("total_value")), 4).alias("revenue_pct"),
    )


def zip_movers(customers: DataFrame) -> DataFrame:
    """Persons seen with more than one zip: the smallest and largest differ, no set has to be kept."""
    per_person = customers.groupBy("customer_unique_id").agg(
        (F.min("zip_code_prefix") != F.max("zip_code_prefix")).alias("moved")
    )
    return per_person.agg(F.count_if("moved").alias("movers"), row_count().alias("persons"))


def zip_density(geolocation: DataFrame) -> DataFrame:
    per_zip = geolocation.groupBy("zip_code_prefix").agg(row_count().alias("_n"))
    return per_zip.agg(
        row_count().alias("zips"), rounded(exact_avg("_n"), 4).alias("mean_rows"), F.max("_n").alias("max_rows")
    )
