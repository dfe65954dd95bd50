"""Questions over time: trailing features, cohorts, category momentum, season, seller periods, routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import days_between, indicator, percent, ratio, rounded, row_count
from bazaarlens.plans.marts import seller_order_lines
from bazaarlens.plans.orders import delivered, in_window
from bazaarlens.plans.settings import Settings

c = F.col


def month_no(at: Column | str) -> Column:
    """Months since year 0."""
    return F.year(at) * 12 + F.month(at) - 1


def month_of(no: Column) -> Column:
    return F.make_date(F.floor(no / 12).cast("int"), (no % 12 + 1).cast("int"), F.lit(1))


def at_key(entries: Column | str, key: Column) -> Column:
    """The value of a key in a map, NULL without it."""
    return F.try_element_at(entries, key)


# --- trailing features ---------------------------------------------------------------------------------------------


def trailing(orders: DataFrame, as_of: tuple[str, ...]) -> DataFrame:
    """What was known of each customer at the end of each date: orders and spend of the last 12 months and before.

    A span of months reaches back to the same day of the month, that day included. Customers without an order by then
    have no row. Orders shrink to days of customers, each date is a day without orders on a customer's axis, and RANGE
    frames look back from it: the number of dates multiplies neither scans nor shuffles.
    """
    known = orders.filter(c("purchased_at").isNotNull() & c("customer_id").isNotNull())
    daily = known.groupBy("customer_id", c("purchased_at").cast("date").alias("day")).agg(
        row_count().alias("n"), F.sum(F.coalesce("total_payment_value", F.lit(0))).cast("decimal(38,6)").alias("spend")
    )
    by_day = Window.partitionBy("customer_id").orderBy("day")
    own = F.struct("day", "n", "spend", F.lit(None).cast("date").alias("as_of"))
    dates = [
        F.struct(F.lit(d).cast("date").alias("day"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("decimal(38,6)").alias("spend"), F.lit(d).cast("date").alias("as_of"))
        for d in as_of
    ]
    first = daily.withColumn("_first", F.row_number().over(by_day) == 1)
    axis = first.select("customer_id", F.inline(F.when(c("_first"), F.array(own, *dates)).otherwise(F.array(own))))

    def back(what: str, months: int | None) -> Column:
        span = f"interval '{months}' month preceding" if months else "unbounded preceding"
        return F.expr(f"{what} over (partition by customer_id order by day range between {span} and current row)")

    told = axis.select(
        "as_of",
        "customer_id",
        back("sum(n)", None).alias("total_orders"),
        back("sum(n)", 12).alias("total_orders_last_12m"),
        F.round(back("sum(spend)", 12), 2).alias("total_spend_last_12m"),
        (back("sum(n)", 3) > 0).alias("has_order_in_last_quarter"),
        (back("sum(n)", 12) > 0).alias("has_order_in_last_year"),
        days_between(back("max(case when n > 0 then day end)", None), c("day")).alias("days_since_last_order"),
    )
    return told.filter(c("as_of").isNotNull() & (c("total_orders") > 0))


# --- cohorts -------------------------------------------------------------------------------------------------------


def cohorts(orders: DataFrame) -> DataFrame:
    """cohort (first month), month_offset, customers, active, retention_pct: every cell of months x offsets.

    A month in which nobody of a cohort buys has 0 active customers; one past the end of the data is unknown, not 0.
    Activity is one row per customer and month; what is gathered is at most one number per cell, months squared.
    """
    active = orders.filter(c("purchased_at").isNotNull() & c("customer_id").isNotNull()).select(
        "customer_id", month_no("purchased_at").alias("month")
    ).distinct()
    cohort = F.min("month").over(Window.partitionBy("customer_id"))
    cells = active.withColumn("cohort", cohort).groupBy("cohort", (c("month") - c("cohort")).alias("month_offset")).agg(row_count().alias("n"))
    spot = c("cohort").cast("bigint") * 100_000 + c("month_offset")
    whole = cells.agg(
        F.map_from_entries(F.collect_list(F.struct(spot, "n"))).alias("cells"),
        F.min("cohort").alias("first"),
        F.max(c("cohort") + c("month_offset")).alias("last"),
    ).filter(c("first").isNotNull())
    grid = whole.select("*", F.explode(F.sequence("first", "last")).alias("cohort"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(0), c("last") - c("first"))).alias("month_offset"))
    size = F.coalesce(at_key("cells", c("cohort").cast("bigint") * 100_000), F.lit(0))
    known = c("cohort") + c("month_offset") <= c("last")
    seen = F.when(known, F.coalesce(at_key("cells", spot), F.lit(0)))
    return grid.select(
        month_of(c("cohort")).alias("cohort"),
        "month_offset",
        size.alias("customers"),
        seen.alias("active"),
        rounded(percent(seen, size), 4).alias("retention_pct"),
    )


# --- momentum and season -------------------------------------------------------------------------------------------


def momentum(orders: DataFrame, lines: DataFrame, s: Settings, points: int = 24, flat_pct: float = 1.0) -> DataFrame:
    """Each category's revenue over the last ``points`` months of the window, and its trend.

    Months without sales count as 0. The slope is the median of the slopes between all pairs of months, so single months
    don't decide it; growing or declining is a slope beyond ``flat_pct`` percent of the mean month. A category that sold
    nothing in these months has level 0 and is flat.
    """
    months = in_window(orders, s).select("order_id", month_no("purchased_at").alias("month"))
    sums = lines.filter(c("category_name").isNotNull()).groupBy("order_id", "category_name").agg(F.sum("total_item_value").alias("v"))
    monthly = sums.join(months, "order_id").groupBy("category_name", "month").agg(F.round(F.sum("v"), 2).alias("v"))
    series = monthly.groupBy("category_name").agg(F.map_from_entries(F.collect_list(F.struct("month", "v"))).alias("of"))
    last = month_no(F.date_sub(F.lit(s.window_end).cast("date"), 1))
    first = F.greatest(last - (points - 1), month_no(F.lit(s.window_start).cast("date")))
    y = F.transform(F.sequence(first, last), lambda m: F.coalesce(at_key("of", m).cast("double"), F.lit(0.0)))
    filled = series.select("category_name", y.alias("y")).withColumn("n", F.size("y"))
    slopes = F.expr("""array_sort(flatten(transform(sequence(0, n - 2), i -> transform(sequence(i + 1, n - 1),
        j -> (y[j] - y[i]) / (j - i)))))""")
    sloped = filled.filter("n > 1").withColumn("slopes", slopes)
    middle = F.expr("(slopes[cast((size(slopes) - 1) / 2 as int)] + slopes[cast(size(slopes) / 2 as int)]) / 2")
    level = F.aggregate("y", F.lit(0.0), lambda a, v: a + v) / c("n")
    told = sloped.select(
        "category_name", c("n").alias("months"), F.size(F.filter("y", lambda v: v != 0)).alias("months_with_sales"),
        level.alias("level"), middle.alias("slope"),
    )
    pct = F.try_divide(100 * c("slope"), c("level"))
    return told.select(
        "category_name",
        "months",
        "months_with_sales",
        rounded(c("level"), 4).alias("level"),
        rounded(c("slope"), 4).alias("slope"),
        rounded(pct, 4).alias("pct_per_month"),
        F.when(pct > flat_pct, "growing").when(pct < -flat_pct, "declining").otherwise("flat").alias("trend"),
    )


def season(orders: DataFrame, s: Settings) -> DataFrame:
    """month_of_year, years, season_index: orders of a month against the year around it, 100 on average.

    The trend is the centred moving mean over 12 months, its two outer months counted by half; a month's index is its
    mean ratio to the trend over the years. Months of the year that no full window reaches have no index.
    """
    monthly = in_window(orders, s).groupBy(month_no("purchased_at").alias("month")).agg(row_count().alias("n"))
    whole = monthly.agg(F.map_from_entries(F.collect_list(F.struct("month", "n"))).alias("of"), F.min("month").alias("first"), F.max("month").alias("last"))
    y = F.transform(F.sequence("first", "last"), lambda m: F.coalesce(at_key("of", m), F.lit(0)))
    series = whole.filter(c("first").isNotNull()).select("first", y.alias("y"))
    centred = series.filter(F.size("y") > 12).select("first", "y", F.explode(F.sequence(F.lit(6), F.size("y") - 7)).alias("t"))
    around = F.aggregate(F.slice("y", c("t") - 4, 11), F.lit(0).cast("bigint"), lambda a, v: a + v)
    twice = c("y")[c("t") - 6] + 2 * around + c("y")[c("t") + 6]  # 24 times the moving mean
    ratios = centred.select(((c("first") + c("t")) % 12 + 1).alias("month_of_year"), ratio(24 * c("y")[c("t")], twice).alias("r"))
    means = ratios.groupBy("month_of_year").agg(F.count("r").alias("years"), ratio(F.sum("r"), F.count("r")).alias("mean"))
    gathered = means.agg(F.map_from_entries(F.collect_list(F.struct("month_of_year", F.struct("years", "mean")))).alias("of"), F.avg(c("mean").cast("double")).alias("all"))
    twelve = gathered.select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month_of_year"))
    own = at_key("of", c("month_of_year"))
    return twelve.filter(F.size("of") > 0).select(
        "month_of_year",
        F.coalesce(own["years"], F.lit(0)).alias("years"),
        rounded(100 * own["mean"].cast("double") / c("all"), 4).alias("season_index"),
    )


# --- sellers and routes --------------------------------------------------------------------------------------------


def seller_periods(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """seller_id, level (month, quarter, all), period, orders, items, revenue, avg_review, on_time_pct.

    One pass over the lines: they shrink to one row per seller and order, which makes a distinct order a row on every
    level, and the three levels are grouping sets of these rows. Orders without a purchase time are in a period of NULL.
    """
    facts = orders.select("order_id", "purchased_at", "review_score", "is_delivered_on_time")
    sold = seller_order_lines(lines).join(facts, "order_id").select(
        "seller_id",
        F.trunc("purchased_at", "month").alias("month"),
        F.trunc("purchased_at", "quarter").alias("quarter"),
        "items", "price_sum", "review_score", "is_delivered_on_time",
    )
    sets = [[c("seller_id"), c("month")], [c("seller_id"), c("quarter")], [c("seller_id")]]
    told = sold.groupingSets(sets, "seller_id", "month", "quarter").agg(
        F.grouping_id().alias("g"),
        row_count().alias("orders"),
        F.sum("items").alias("items"),
        F.round(F.sum("price_sum"), 2).alias("revenue"),
        rounded(ratio(F.sum("review_score"), F.count("review_score")), 4).alias("avg_review"),
        rounded(percent(F.sum(indicator(c("is_delivered_on_time"))), F.count("is_delivered_on_time")), 4).alias("on_time_pct"),
    )
    # of (seller_id, month, quarter) the bit of a column that is summed over is set
    level = F.when(c("g") == 1, "month").when(c("g") == 2, "quarter").otherwise("all")
    period = F.when(c("g") == 1, c("month")).when(c("g") == 2, c("quarter"))
    return told.select("seller_id", level.alias("level"), period.alias("period"), "orders", "items", "revenue", "avg_review", "on_time_pct")


def routes(orders: DataFrame, lines: DataFrame, sellers: DataFrame) -> DataFrame:
    """Promised against actual days of delivered orders from a seller's state to the customer's.

    An order counts once for each state it is sent from. Days are counted first, one row per route, measure and day, and
    the quantiles are read off the running counts: the least day that the share of orders has reached.
    """
    states = sellers.select("seller_id", c("state").alias("seller_state"))
    sent = lines.select("order_id", "seller_id").distinct().join(states, "seller_id").select("order_id", "seller_state").distinct()
    promised = days_between(c("purchased_at"), c("estimated_delivery_date"))
    known = delivered(orders).select("order_id", "delivery_state", c("delivery_time_days").alias("actual"), promised.alias("promised"))
    known = known.dropna(subset=["delivery_state", "actual", "promised"])
    measured = sent.filter(c("seller_state").isNotNull()).join(known, "order_id")
    cells = [F.struct(F.lit(m).alias("measure"), v.alias("day")) for m, v in (("actual", c("actual")), ("promised", c("promised")), ("early", c("promised") - c("actual")))]
    counted = measured.select("seller_state", "delivery_state", F.inline(F.array(*cells)))
    route = ["seller_state", "delivery_state"]
    counted = counted.groupBy(*route, "measure", "day").agg(row_count().alias("n"))
    by_day = Window.partitionBy(*route, "measure").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    all_days = Window.partitionBy(*route, "measure")
    running = counted.withColumns({"upto": F.sum("n").over(by_day), "all": F.sum("n").over(all_days)})

    def of(measure: str, value: Column) -> Column:
        return F.when(c("measure") == measure, value)

    def quantile(measure: str, tenths: int) -> Column:
        return F.min(F.when((c("measure") == measure) & (c("upto") * 10 >= c("all") * tenths), c("day")))

    return running.groupBy(*route).agg(
        F.max(of("actual", c("all"))).alias("orders"),
        quantile("promised", 5).alias("promised_median"),
        quantile("actual", 5).alias("actual_median"),
        quantile("actual", 9).alias("actual_p90"),
        rounded(ratio(F.sum(of("early", c("day") * c("n"))), F.max(of("early", c("all")))), 4).alias("avg_days_early"),
        rounded(percent(F.coalesce(F.sum(F.when((c("measure") == "early") & (c("day") < 0), c("n"))), F.lit(0)), F.max(of("early", c("all")))), 4).alias("late_pct"),
    )
