"""Every query by name, over the benchmark parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.functions.columns import percent, rounded, row_count
from bazaarlens.operators.banding import display_sample, gap_table
from bazaarlens.operators.keep_one import keep_first
from bazaarlens.operators.ordering import global_running_sum, ntile_bucket, order_globally, pct_change, share_of_total
from bazaarlens.plans import categories, checks, customers, delivery, distance, intermediate, orders, periods, sellers
from bazaarlens.plans.settings import BENCHMARK as S
from bazaarlens.plans.star import INTERMEDIATES, MARTS, STAGED, Star
from bazaarlens.session import passing_database, prefer_skew_handling, scratch_path
from bazaarlens.sources import catalog, csv_files
from bazaarlens.sources.parquet_tables import as_text
from bazaarlens.sources.schemas import FILE_ENDINGS
from bazaarlens.streaming import incremental

c = F.col
Query = Callable[[Star], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Plain result types: decimals (already rounded) as double, all integers as bigint, arrays as text."""

    def plain(f: T.StructField) -> Column:
        column = c(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return column.cast("double").alias(f.name)
        if isinstance(f.dataType, T.IntegerType):
            return column.cast("bigint").alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.array_join(column, ",").alias(f.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


# --- sources and sinks ---------------------------------------------------------------------------------------------


def csv_drop(star: Star, *tables: str) -> str:
    """Raw tables as CSV, as a shop would deliver them; each file of the drop is a folder of parts."""
    folder = None
    for name in tables or FILE_ENDINGS:
        df = as_text(star.raw(name))
        folder = folder or scratch_path(df.sparkSession, "csv-drop")
        writer = df.write.option("header", True).option("escape", '"').option("emptyValue", "")
        writer.csv(f"{folder}/shop_{FILE_ENDINGS[name]}")
    return folder


def read_back_csv(star: Star) -> DataFrame:
    spark = star.raw("order_reviews").sparkSession
    return Star.from_csv(spark, csv_drop(star, "order_reviews")).table("stg_order_reviews")


def loaded_namespace(star: Star, *tables: str) -> tuple[SparkSession, str, dict[str, csv_files.Loaded]]:
    folder = csv_drop(star, *tables)
    spark = star.raw("orders").sparkSession
    namespace = passing_database(spark, "raw")
    return spark, namespace, csv_files.load_raw(spark, folder, namespace)


def raw_load(star: Star) -> DataFrame:
    spark, namespace, loaded = loaded_namespace(star)
    spark.sql(f"DROP DATABASE {namespace} CASCADE")
    return spark.createDataFrame([(t, n.written) for t, n in loaded.items()], "table_name string, rows_written bigint")


def raw_profile(star: Star) -> DataFrame:
    """Every column of the nine raw tables after the way through CSV files and the catalog: known values and their sum
    (of a text's length)."""
    spark, namespace, _ = loaded_namespace(star)
    profiles = []
    for name in FILE_ENDINGS:
        raw = catalog.scan(spark, namespace, name)
        cells = []
        for field in raw.schema:
            value = F.length(c(field.name)) if isinstance(field.dataType, T.StringType) else c(field.name)
            total = F.coalesce(F.sum(value.cast("decimal(38,6)")), F.lit(0)).cast("decimal(38,4)")
            cells += [row_count().alias(f"rows:{field.name}"), F.count(field.name).alias(f"known:{field.name}"), total.alias(f"total:{field.name}")]
        lines = [F.struct(F.lit(n).alias("column_name"), *[c(f"`{k}:{n}`").alias(k) for k in ("rows", "known", "total")]) for n in raw.columns]
        profiles.append(raw.agg(*cells).select(F.lit(name).alias("table_name"), F.inline(F.array(*lines))))
    return reduce(DataFrame.unionByName, profiles)


def namespace_tables(star: Star) -> DataFrame:
    spark, namespace, _ = loaded_namespace(star, "orders")
    catalog.ensure_namespace(spark, namespace)
    shown = spark.sql(f"SHOW TABLES IN {namespace}").filter(~c("isTemporary"))  # run at once; views of the session are no tables
    listed = shown.select(c("tableName").alias("table_name"))
    spark.sql(f"DROP DATABASE {namespace} CASCADE")
    return listed


def source_scan(star: Star) -> DataFrame:
    spark, namespace, _ = loaded_namespace(star, "orders")
    return Star.from_catalog(spark, namespace).table("stg_orders").select("order_id", "status", "purchased_at")


def view(star: Star) -> DataFrame:
    name = f"stg_orders_{uuid4().hex}"
    seen = catalog.publish_view(star.table("stg_orders"), name)
    counted = seen.agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("customer_id").alias("customers"))
    counted.sparkSession.catalog.dropTempView(name)  # the plan above is resolved already
    return counted


def table(star: Star) -> DataFrame:
    df = star.table("dim_geolocation")
    spark = df.sparkSession
    namespace = passing_database(spark, "marts")
    catalog.write_table(df, f"{namespace}.dim_geolocation")
    return catalog.scan(spark, namespace, "dim_geolocation")


def built_counts(star: Star) -> DataFrame:
    spark = star.raw("orders").sparkSession
    namespace = passing_database(spark, "marts")

    def store(name: str, df: DataFrame) -> DataFrame:
        catalog.write_table(df, f"{namespace}.{name}")
        return catalog.scan(spark, namespace, name)

    star.write_marts(store)
    return catalog.catalog_counts(spark, namespace)


# --- small compositions --------------------------------------------------------------------------------------------


def staged_from_text(name: str) -> Query:
    """Staging over times and dates that arrive as text, so that the safe casts do their work."""
    make, source = STAGED[name]
    return lambda star: make(as_text(star.raw(source)))


def payment(*columns: str) -> Query:
    """Columns of the payment roll-up that one pass per order can give."""

    def run(star: Star) -> DataFrame:
        totals = intermediate.payment_totals(star.table("stg_order_payments"))
        return intermediate.with_items_check(totals, star.table("stg_order_items")).select("order_id", *columns)

    return run


def placed(star: Star) -> DataFrame:
    """Order fact with places; the zip lookup is written first, so that its size is known to the join."""
    return star.write_lookup("dim_geolocation").table("fct_orders")


def far(star: Star) -> DataFrame:
    return distance.with_distance(pulled(star))


def pulled(star: Star) -> DataFrame:
    return star.write_lookup("zip_centroid").table("order_distance")


def far_with_state(star: Star) -> DataFrame:
    star.write_lookup("dim_geolocation")
    return far(star)


def single(star: Star) -> DataFrame:
    return delivery.single_item_orders(
        star.table("fct_orders"), star.table("stg_order_items"), star.table("stg_products"),
        star.table("stg_product_categories"),
    )


def seller_money(star: Star) -> DataFrame:
    return star.table("order_lines").groupBy("seller_id").agg(F.round(F.sum("total_item_value"), 2).alias("revenue"))


def seller_order() -> list[Column]:
    return [F.desc("revenue"), F.asc("seller_id")]


def seller_ntile(star: Star) -> DataFrame:
    ranked = order_globally(seller_money(star), seller_order()).ranked()
    return ranked.select("seller_id", "revenue", ntile_bucket(c("rank"), c("n_rows"), 10).alias("decile"))


def seller_running(star: Star) -> DataFrame:
    return global_running_sum(seller_money(star), seller_order(), "revenue")


def latest_address(star: Star) -> DataFrame:
    bought = star.table("stg_customers").join(star.table("stg_orders").select("customer_id", "purchased_at"), "customer_id")
    first = keep_first(bought, ["customer_unique_id"], [F.desc_nulls_last("purchased_at"), F.desc("customer_id")])
    return first.select("customer_unique_id", "zip_code_prefix")


def month_changes(star: Star) -> DataFrame:
    changed = pct_change(orders.monthly(in_window(star).table("fct_orders"), S), "month", "orders", "change_pct")
    return changed.select("month", "orders", rounded(c("change_pct"), 4).alias("change_pct"))


def category_share(star: Star) -> DataFrame:
    sums = star.table("product_lines").groupBy("category_name").agg(F.round(F.sum("total_item_value"), 2).alias("revenue"))
    return share_of_total(sums, "revenue", "share_pct").withColumn("share_pct", rounded(c("share_pct"), 4))


def window_category_money(star: Star) -> DataFrame:
    return categories.category_revenue(in_window(star).table("fct_orders"), star.table("product_lines"), S)


def thresholds(star: Star) -> DataFrame:
    curve = categories.category_pareto(window_category_money(star))
    return curve.agg(
        (F.count_if(c("cum_rev_pct") <= 80) + 1).alias("by_count"),
        F.min(F.when(c("cum_rev_pct") >= 80, c("rank"))).alias("by_first"),
    )


def gap_by_state(star: Star) -> DataFrame:
    return delivery.rounded_gap(gap_table(far_with_state(star), "delivery_state"))


def composite_keys(star: Star) -> DataFrame:
    rows = star.raw("order_items").count()  # off the footers; an order has hardly more payments than items
    found = [
        checks.check_unique(star.table(model), *key, rows=rows).select(
            F.lit(model).alias("model"), "order_id", c(key[1]).alias("position"), "n"
        )
        for model, *key in checks.COMPOSITE
    ]
    return reduce(DataFrame.unionByName, found)


def unaccepted(star: Star) -> DataFrame:
    """Values outside the accepted lists with their rows, for each list."""
    found = [
        checks.check_accepted(star.table(model), name, values)
        .groupBy(c(name).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(model).alias("model"), F.lit(name).alias("column"), "value", "n")
        for model, name, values in checks.ACCEPTED
    ]
    return reduce(DataFrame.unionByName, found)


def report(star: Star) -> DataFrame:
    # the intermediates that several checks read are written along with the marts
    return checks.dq_report(star.write_marts(also=("int_order_payments", "int_order_reviews")))


def orders_query(fn) -> Query:
    return lambda star: fn(star.table("fct_orders"))


def in_window(star: Star) -> Star:
    """The star of the analysis window, whose orders are pruned at the scan."""
    return star.bought_between(S.window_start, S.window_end)


def windowed_query(fn) -> Query:
    return lambda star: fn(in_window(star).table("fct_orders"), S)


def base_query(fn) -> Query:
    return lambda star: fn(star.table("customer_base"))


def economics(star: Star) -> DataFrame:
    return categories.category_economics(star.table("product_lines"))


# --- loads that go on ----------------------------------------------------------------------------------------------

AS_OF = ("1996-12-31", "1999-06-30", "2001-08-01")
#: The benchmark's line numbers repeat within an order; a line is told apart by all of these.
LINE_KEY = ("order_id", "order_item_id", "product_id", "seller_id", "price")
SECOND_DROP = "1999-01-01"  # orders bought from here on come with the second drop


LINES_PER_BUCKET = 1_000_000  # a task sorts a bucket in memory


def order_drop(star: Star) -> DataFrame:
    person = star.table("stg_customers").select("customer_id", c("customer_unique_id").alias("person"))
    bought = star.table("stg_orders").join(person, "customer_id")
    text = [c("order_id").cast("string"), c("person").cast("string").alias("customer_id"), "status"]
    return bought.select(*text, c("purchased_at").cast("timestamp").alias("purchased_at"))


def item_drop(star: Star) -> DataFrame:
    at = star.table("stg_orders").select("order_id", c("purchased_at").cast("timestamp").alias("purchased_at"))
    kinds = T.StructType.fromDDL(incremental.ITEMS)
    return star.table("stg_order_items").join(at, "order_id").select(*[c(f.name).cast(f.dataType).alias(f.name) for f in kinds])


def deliver(df: DataFrame, folder: str, name: str) -> None:
    df.write.option("compression", "zstd").parquet(f"{folder}/{name}")


def two_drops(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    early = c("purchased_at") < F.lit(SECOND_DROP).cast("timestamp")
    return df.filter(early), df.filter(~early)


def incremental_summaries(star: Star) -> DataFrame:
    """Customer and seller summary after two drops of orders and items."""
    spark = star.raw("orders").sparkSession
    folder = scratch_path(spark, "drops")
    buckets = max(16, star.raw("order_items").count() // LINES_PER_BUCKET)
    shop = incremental.Shop(spark, scratch_path(spark, "shop"), buckets=buckets, item_key=LINE_KEY)
    for n, (some, items) in enumerate(zip(two_drops(order_drop(star)), two_drops(item_drop(star)), strict=True)):
        deliver(some, f"{folder}/orders", f"drop-{n}")
        deliver(items, f"{folder}/items", f"drop-{n}")
        shop.load_new(folder)
    bought, sold = shop.customers.rows(), shop.sellers.rows()
    of_customers = bought.select(
        F.lit("customer").alias("kind"), c("customer_id").alias("id"), "total_orders", F.round("total_value", 2).alias("value"),
        *[c(n).cast("timestamp_ntz").alias(n) for n in ("first_order_at", "last_order_at")],
    )
    of_sellers = sold.select(
        F.lit("seller").alias("kind"), c("seller_id").alias("id"), "total_orders", "items", F.round("revenue", 2).alias("value"),
        F.round("freight", 2).alias("freight"),
    )
    return of_customers.unionByName(of_sellers, allowMissingColumns=True)


def incremental_months(star: Star) -> DataFrame:
    """Monthly totals of three drops; the third holds orders of 1999 and before, whose days are closed by then."""
    paid = star.table("fct_orders").select(
        *[c(n).cast("string").alias(n) for n in ("order_id", "customer_id", "status")],
        c("purchased_at").cast("timestamp").alias("purchased_at"),
        c("total_payment_value").cast(incremental.MONEY).alias("order_value"),
    )
    withheld = (c("order_id").cast("long") % 97 == 0) & (c("purchased_at") < F.lit("2000-01-01").cast("timestamp"))
    folder = scratch_path(paid.sparkSession, "drops")
    totals = incremental.MonthlyTotals(paid.sparkSession, scratch_path(paid.sparkSession, "months"))
    for n, drop in enumerate((*two_drops(paid.filter(~withheld)), paid.filter(withheld))):
        deliver(drop, folder, f"drop-{n}")
        totals.load_new(folder)
    return totals.report(folder).withColumns({n: F.round(n, 2) for n in ("revenue", "late_revenue")})


def redelivered_items(star: Star) -> DataFrame:
    """Items and revenue by seller, of two drops of which the first is delivered again after the second.

    Lines meet their orders once, in a written table that every drop is read off.
    """
    spark = star.raw("orders").sparkSession
    told = scratch_path(spark, "told")
    deliver(item_drop(star), told, "items")
    items = spark.read.schema(incremental.ITEMS).parquet(f"{told}/items")
    folder, path = scratch_path(spark, "drops"), scratch_path(spark, "items-once")
    first, second = two_drops(items)
    for n, drop in enumerate((first, second, first)):
        deliver(drop, folder, f"drop-{n}")
        incremental.load_once(spark, folder, path, key=LINE_KEY)
    taken = spark.read.schema(incremental.ITEMS).parquet(path)
    return taken.groupBy("seller_id").agg(row_count().alias("items"), F.round(F.sum("price"), 2).alias("revenue"))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "src_csv": read_back_csv,
    "sink_raw": raw_load,
    "sink_raw_profile": raw_profile,
    "src_ns": namespace_tables,
    "src_scan": source_scan,
    "sink_view": view,
    "sink_table": table,
    "catalog_counts": built_counts,
    # staging
    **{name: staged_from_text(name) for name in STAGED},
    # intermediate
    **{name: (lambda star, name=name: star.table(name)) for name in INTERMEDIATES},
    "review_counts": lambda s: intermediate.review_counts(s.table("stg_order_reviews")),
    "review_flag": lambda s: intermediate.review_flag(s.table("stg_order_reviews")),
    "review_dedup1": lambda s: intermediate.review_dedup1(s.table("stg_order_reviews")),
    "review_dedup2": lambda s: intermediate.review_dedup2(
        intermediate.review_dedup1(s.table("stg_order_reviews").select("review_id", "order_id", "score"))
    ).select("order_id", "review_id", "score"),
    "items_total": lambda s: intermediate.items_total(s.table("stg_order_items")),
    "pay_primary": payment("primary_payment_type"),
    "pay_types": lambda s: intermediate.payment_methods(s.table("stg_order_payments")).select("order_id", "payment_types"),
    "pay_installments": payment("installments"),
    "pay_total": payment("total_payment_value"),
    "pay_methods": lambda s: intermediate.payment_methods(s.table("stg_order_payments")).select(
        "order_id", "payment_method_count"
    ),
    "pay_undefined": payment("has_not_defined_payment"),
    "pay_seq_gap": payment("has_incomplete_payment_sequence"),
    "pay_mismatch": payment("has_payment_value_mismatch"),
    "pay_gap": payment("payment_value_gap"),
    # marts
    **{
        name: (lambda star, name=name: star.write_lookup("dim_geolocation").table(name))
        for name in MARTS
        if name in ("dim_customers", "dim_sellers", "fct_orders", "fct_order_items")
    },
    "dim_geolocation": lambda s: s.table("dim_geolocation"),
    "dim_products": lambda s: s.table("dim_products"),
    "mart_customer_summary": lambda s: s.table("mart_customer_summary"),
    "mart_seller_performance": lambda s: s.table("mart_seller_performance"),
    "on_time_flag": lambda s: s.table("fct_orders").select("order_id", "is_delivered_on_time"),
    "delivery_time_days": lambda s: s.table("fct_orders").select("order_id", "delivery_time_days"),
    # ordered analytics
    "win_dedup": latest_address,
    "win_ntile": seller_ntile,
    "win_pct_change": month_changes,
    "win_cumsum": lambda s: seller_running(s).select(
        "seller_id", "revenue", "rank", F.round("running_value", 2).alias("running_value"),
        rounded(percent(c("running_value"), c("grand_total")), 4).alias("cum_pct"),
    ),
    "win_threshold": thresholds,
    "win_share": category_share,
    "win_topshare": lambda s: customers.concentration(seller_running(s)).select(
        c("customers").alias("sellers"), "top10_pct", "top20_pct"
    ),
    "win_qcut": lambda s: customers.ticket_quintiles(s.table("customer_base")).select(
        "customer_id", rounded(c("avg_ticket"), 4).alias("avg_ticket"), "quintile"
    ),
    "display_sample": lambda s: display_sample(
        customers.customer_base_report(s.table("customer_base")), ["customer_id"], 600
    ),
    "display_sample_items": lambda s: display_sample(
        categories.usual_items(s.table("product_lines"), S).select(
            "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "weight_g", "volume_l"
        ),
        list(LINE_KEY), 8000,
    ),
    # orders
    "an_kpi": orders_query(orders.kpi),
    "an_on_time_pct": orders_query(orders.on_time_pct),
    "an_coverage": lambda s: orders.coverage(s.table("fct_orders"), S),
    "an_monthly": windowed_query(orders.monthly),
    "an_mom": windowed_query(orders.monthly_growth),
    "an_qoq": windowed_query(orders.quarterly_growth),
    "an_ontime_score": orders_query(orders.score_by_punctuality),
    "an_ontime_score_window": lambda s: orders.score_by_punctuality(orders.in_window(in_window(s).table("fct_orders"), S)),
    "an_status": windowed_query(orders.status_mix),
    "an_payment_mix": windowed_query(orders.payment_mix),
    "an_score_dist": windowed_query(orders.score_mix),
    "an_geo_top": lambda s: orders.top_states_in_window(placed(in_window(s)), S),
    "an_state_share": lambda s: orders.state_share(placed(s)),
    "an_freight_quarter": lambda s: orders.freight_by_quarter(in_window(s).table("fct_orders"), s.table("order_lines"), S),
    # delivery
    "an_delivery_profile": windowed_query(delivery.delivery_profile),
    "an_delivery_hist": lambda s: hist(delivery.delivery_histogram(in_window(s).table("fct_orders"), S, "days")),
    "an_early_hist": lambda s: hist(delivery.delivery_histogram(in_window(s).table("fct_orders"), S, "days_early")),
    "an_avg_early": windowed_query(delivery.avg_days_early),
    "an_state_buffer": lambda s: delivery.state_buffer(placed(s), S),
    "an_single_item": single,
    "an_weight_profile": lambda s: delivery.weight_profile(single(s)),
    "an_gap_category": lambda s: delivery.category_gap(single(s)),
    # distance
    "an_zip_centroid": lambda s: s.table("zip_centroid").withColumns(
        {n: rounded(c(n), 4) for n in ("latitude", "longitude")}
    ),
    "an_order_distance": lambda s: pulled(s.write_lookup("dim_geolocation")).withColumns(
        {n: rounded(c(n), 4) for n in ("weight_g", "dist_km")}
    ),
    "an_distance_cov": lambda s: distance.distance_coverage(pulled(s)),
    "an_est_window": lambda s: distance.promised_window(far(s)),
    "an_distance_hist": lambda s: hist(distance.distance_histogram(far(s))),
    "an_by_distance": lambda s: distance.by_distance(far(s)),
    "an_gap": gap_by_state,
    "an_gap_distance": lambda s: distance.distance_gap(far(s)),
    "an_deadline_gradient": lambda s: distance.deadline_gradient(far(s)),
    "an_speed_bands": lambda s: distance.speed_bands(far(s)),
    "an_speed_corr": lambda s: distance.speed_correlations(far(s)),
    "an_window_corr": lambda s: distance.window_correlations(far(s)),
    "an_state_equity": lambda s: distance.state_equity(far_with_state(s), S),
    "an_corr_matrix": lambda s: distance.correlation_matrix(far(s)),
    # customers
    "an_customer_base": base_query(customers.customer_base_report),
    "an_repeat_pct": base_query(customers.repeat_pct),
    "an_value_corr": base_query(customers.value_correlations),
    "an_quintile": base_query(customers.quintile_summary),
    "an_quintile_mix": lambda s: customers.quintile_category_mix(
        s.table("customer_base"), s.table("product_lines"), s.table("fct_orders")
    ),
    "an_ticket_kmeans": base_query(customers.ticket_clusters),
    "an_basket_size": lambda s: customers.basket_size(s.table("order_lines")),
    "an_frequency": base_query(customers.orders_per_customer_clipped),
    "an_customer_window": windowed_query(customers.window_summary),
    "an_orders_per_customer": windowed_query(customers.orders_per_customer),
    "an_customer_pareto": windowed_query(customers.customer_pareto_summary),
    "an_customer_curve": windowed_query(customers.customer_pareto_curve),
    "an_consumable_repeat": lambda s: customers.consumable_repeat(s.table("fct_orders"), s.table("product_lines"), S),
    "an_runway": lambda s: customers.runway_repeat(s.table("fct_orders"), s.table("product_lines"), S),
    "an_repeat_bars": lambda s: customers.repeat_bars(s.table("fct_orders"), s.table("product_lines"), S),
    # categories
    "an_category_rev": window_category_money,
    "an_category_pareto": lambda s: categories.category_pareto_report(window_category_money(s)),
    "an_category_to_80": lambda s: categories.categories_to_share(window_category_money(s)),
    "an_category_econ": lambda s: categories.category_economics_report(economics(s)),
    "an_category_cov": lambda s: categories.category_coverage(economics(s), S),
    "an_freight_overall": lambda s: categories.freight_overall(s.table("order_lines")),
    "an_freight_cat": lambda s: categories.category_freight(s.table("product_lines"), S),
    "an_freight_rank": lambda s: categories.freight_ranking(economics(s), S),
    "an_freight_range": lambda s: categories.freight_range(economics(s), S),
    "an_freight_driver": lambda s: categories.freight_drivers(s.table("product_lines"), S),
    "an_price_burden": lambda s: categories.price_burden(economics(s), S),
    "an_priority": lambda s: categories.priority_categories(s.table("product_lines"), S),
    # sellers
    "an_seller_decile": lambda s: sellers.seller_deciles(in_window(s).table("fct_orders"), s.table("order_lines"), S),
    "an_seller_speed": lambda s: sellers.seller_speed_report(
        sellers.seller_speed(in_window(s).table("fct_orders"), s.table("order_lines"), S)
    ),
    "an_seller_speed_corr": lambda s: sellers.speed_score_corr(
        sellers.seller_speed(in_window(s).table("fct_orders"), s.table("order_lines"), S)
    ),
    # figures named in the text
    "ex_return_gap": orders_query(customers.return_gap),
    "ex_state_sigma": lambda s: delivery.state_sigma(placed(s), S),
    "ex_item_burden_corr": lambda s: categories.item_burden(s.table("order_lines")),
    "ex_ontime_weight_corr": lambda s: delivery.punctual_weight_corr(single(s)),
    "ex_tail_500": lambda s: customers.big_ticket_tail(s.table("customer_base"), S),
    "ex_zip_movers": lambda s: customers.zip_movers(s.table("stg_customers")),
    "ex_zip_density": lambda s: customers.zip_density(s.table("stg_geolocation")),
    # over time
    "fu_trailing": lambda s: periods.trailing(s.table("fct_orders"), AS_OF),
    "fu_cohort": orders_query(periods.cohorts),
    "fu_momentum": lambda s: periods.momentum(in_window(s).table("fct_orders"), s.table("product_lines"), S),
    "fu_season": windowed_query(periods.season),
    "fu_seller_period": lambda s: periods.seller_periods(s.table("order_lines"), s.table("fct_orders")),
    "fu_sla_route": lambda s: periods.routes(placed(s), s.table("order_lines"), s.table("stg_sellers")),
    "fu_incremental": incremental_summaries,
    "fu_incremental_months": incremental_months,
    "fu_incremental_redelivered": redelivered_items,
    # data quality
    "dq_unique": lambda s: checks.check_unique(s.table("stg_order_reviews"), "review_id"),
    "dq_not_null": lambda s: checks.check_not_null(s.table("stg_products"), "weight_g").select("product_id", "weight_g"),
    "dq_accepted": unaccepted,
    "dq_relationship": lambda s: checks.check_relationship(
        s.table("stg_order_reviews"), "order_id", s.table("stg_orders"), "order_id"
    ).select("review_id", "order_id"),
    "dq_composite_key": composite_keys,
    "dq_item_values": lambda s: checks.check_rule(s.table("stg_order_items"), checks.item_values_wrong).select(
        "order_id", "order_item_id", "price", "freight_value"
    ),
    "dq_installments": lambda s: checks.check_rule(s.table("stg_order_payments"), checks.installments_wrong).select(
        "order_id", "payment_sequential", "payment_installments"
    ),
    "dq_pay_seq": lambda s: checks.incomplete_sequences(s.table("stg_order_payments")),
    "dq_one_review": lambda s: checks.several_reviews(s.table("stg_order_reviews")),
    "dq_review_order": lambda s: checks.shared_review_ids(s.table("stg_order_reviews")),
    "dq_approved": lambda s: checks.check_rule(s.table("stg_orders"), checks.approved_too_early).select(
        "order_id", "purchased_at", "approved_at"
    ),
    "dq_delivery_seq": lambda s: checks.check_rule(s.table("stg_orders"), checks.delivered_before_carrier).select(
        "order_id", "delivered_to_carrier_at", "delivered_to_customer_at"
    ),
    "dq_has_payment": lambda s: checks.unpaid_orders(s.table("stg_orders"), s.table("stg_order_payments")).select(
        "order_id", "status"
    ),
    "dq_answered": lambda s: checks.check_rule(s.table("stg_order_reviews"), checks.answered_too_early).select(
        "review_id", "order_id", "created_at", "answered_at"
    ),
    "dq_pay_match": lambda s: payment("total_payment_value", "payment_value_gap", "has_payment_value_mismatch")(s).filter(
        checks.payment_differs
    ).drop("has_payment_value_mismatch"),
    "dq_rate_range": lambda s: checks.both_summaries(s, checks.rate_out_of_range, "on_time_delivery_rate"),
    "dq_score_range": lambda s: checks.both_summaries(s, checks.score_out_of_range, "avg_review_score"),
    "dq_orders_pos": lambda s: checks.both_summaries(s, checks.no_orders, "total_orders"),
    "dq_spend": lambda s: checks.check_rule(s.table("mart_customer_summary"), checks.negative_spend).select(
        "customer_id", "total_spend"
    ),
    "dq_report": report,
}


def hist(df: DataFrame) -> DataFrame:
    return df.select("bin", rounded(c("low"), 4).alias("low"), rounded(c("high"), 4).alias("high"), "rows")


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    prefer_skew_handling(spark)
    return present(QUERIES[name](Star.from_parquet(spark, sf_dir)))
