"""One statement per registered query. Money and averages leave as doubles that were rounded as decimals."""

from __future__ import annotations

import re

from bazaarlens.plans.checks import ACCEPTED, COMPOSITE, NOT_NULL, RELATIONSHIPS, UNIQUE
from bazaarlens.sources.schemas import RAW_SCHEMAS
from oracle.tables import with_tables


def d(x: str, n: int) -> str:
    return f"cast(round(cast({x} as decimal(38,8)), {n}) as double)"


def pct(cond: str) -> str:
    return f"100.0 * sum(case when {cond} then 1 else 0 end) / count(*)"


def cols(spec: str) -> str:
    """``name`` as it is, ``name:i`` as bigint, ``name:m`` as double."""
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        out.append(
            f"cast({name} as bigint) as {name}" if kind == "i" else f"cast({name} as double) as {name}" if kind == "m" else name
        )
    return ", ".join(out)


def whole(table: str, spec: str) -> str:
    return f"select {cols(spec)} from {table}"


def profiled(raw: str, table: str) -> str:
    """Rows, known values and their sum (of a text's length) for each column of a raw table."""
    lines = []
    staged = [spec.split(":")[0] for spec in LEVELS[table].split()]
    for declared, column in zip(re.sub(r"\(.*?\)", "", RAW_SCHEMAS[raw]).split(","), staged, strict=True):
        name, kind = declared.split()
        value = f"length(cast({column} as varchar))" if kind == "string" else column
        lines.append(
            f"""select '{raw}' as table_name, '{name}' as column_name, cast(count(*) as bigint) as "rows",
            cast(count({column}) as bigint) as known,
            cast(cast(coalesce(sum(cast({value} as decimal(24,6))), 0) as decimal(38,4)) as double) as total from {table}"""
        )
    return " union all ".join(lines)


def corr(x: str, y: str) -> str:
    """NULL where a side is constant (the engine says NaN): the promised window of these tables always is."""
    return d(f"case when not isnan(corr({x}, {y})) then corr({x}, {y}) end", 6)


LEVELS = {
    "stg_orders": "order_id customer_id status purchased_at approved_at delivered_to_carrier_at delivered_to_customer_at "
    "estimated_delivery_date",
    "stg_customers": "customer_id customer_unique_id zip_code_prefix city state",
    "stg_sellers": "seller_id zip_code_prefix city state",
    "stg_products": "product_id category_name_portuguese product_name_length:i product_description_length:i photos_qty:i "
    "weight_g:i length_cm:i height_cm:i width_cm:i",
    "stg_product_categories": "category_name_portuguese category_name",
    "stg_order_items": "order_id order_item_id:i product_id seller_id shipping_limit_at price:m freight_value:m",
    "stg_order_payments": "order_id payment_sequential:i payment_type payment_installments:i payment_value:m",
    "stg_order_reviews": "review_id order_id score:i comment_title comment_message created_at answered_at",
    "stg_geolocation": "zip_code_prefix latitude longitude city state",
    "int_orders": "order_id customer_id status purchased_at approved_at delivered_to_carrier_at delivered_to_customer_at "
    "estimated_delivery_date is_valid_delivery",
    "int_order_reviews": "review_id order_id score:i comment_title comment_message created_at answered_at is_duplicate_review",
    "int_order_payments": "order_id primary_payment_type payment_types installments:i total_payment_value:m "
    "payment_method_count:i has_not_defined_payment has_incomplete_payment_sequence has_payment_value_mismatch "
    "payment_value_gap:m",
    "int_geolocation_by_zip": "zip_code_prefix city state",
    "dim_geolocation": "zip_code_prefix city state",
    "dim_customers": "customer_id zip_code_prefix city state",
    "dim_sellers": "seller_id zip_code_prefix city state",
    "dim_products": "product_id category_name_portuguese category_name product_name_length:i product_description_length:i "
    "photos_qty:i weight_g:i length_cm:i height_cm:i width_cm:i",
    "fct_orders": "order_id customer_id status purchased_at approved_at delivered_to_carrier_at delivered_to_customer_at "
    "estimated_delivery_date is_valid_delivery is_delivered_on_time delivery_time_days:i delivery_zip_code_prefix "
    "delivery_city delivery_state primary_payment_type installments:i total_payment_value:m has_payment_value_mismatch "
    "review_score:i is_duplicate_review",
    "fct_order_items": "order_id order_item_id:i product_id seller_id shipping_limit_at price:m freight_value:m "
    "total_item_value:m category_name seller_city seller_state",
    "mart_customer_summary": "customer_id total_orders:i total_spend:m avg_order_value:m first_order_at last_order_at "
    "avg_review_score:m on_time_delivery_rate:m is_repeat_customer",
    "mart_seller_performance": "seller_id city state total_orders:i total_items_sold:i total_revenue:m avg_item_price:m "
    "total_freight_charged:m avg_delivery_time_days:m on_time_delivery_rate:m avg_review_score:m distinct_categories:i",
}

S: dict[str, str] = {name: whole(name, spec) for name, spec in LEVELS.items()}

MARTS = """fct_orders fct_order_items dim_customers dim_sellers dim_products dim_geolocation mart_customer_summary
    mart_seller_performance""".split()
GRAINS = {
    "fct_orders": ("one order", "status, delivery, payment, review"),
    "fct_order_items": ("one line item", "product/seller economics: price, freight"),
    "dim_customers": ("one customer (person)", "customer location"),
    "dim_sellers": ("one seller", "seller location"),
    "dim_products": ("one product", "category, weight, dimensions"),
    "dim_geolocation": ("one zip prefix", "city / state lookup"),
    "mart_customer_summary": ("one customer", "pre-aggregated spend / behaviour"),
    "mart_seller_performance": ("one seller", "pre-aggregated revenue / quality"),
}
RAW = {
    "orders": "stg_orders", "order_items": "stg_order_items", "order_payments": "stg_order_payments",
    "order_reviews": "stg_order_reviews", "customers": "stg_customers", "sellers": "stg_sellers",
    "products": "stg_products", "geolocation": "stg_geolocation",
    "product_category_name_translation": "stg_product_categories",
}
counts = " union all ".join(f"select '{m}' as mart, count(*) as n from {m}" for m in MARTS)

S |= {
    # sources and sinks
    "src_csv": """select cast(review_id as varchar) as review_id, cast(order_id as varchar) as order_id,
        cast(score as bigint) as score, comment_title, comment_message, created_at, answered_at from stg_order_reviews""",
    "sink_raw": " union all ".join(
        f"select '{raw}' as table_name, cast(count(*) as bigint) as rows_written from {t}" for raw, t in RAW.items()
    ),
    "sink_raw_profile": " union all ".join(profiled(raw, t) for raw, t in RAW.items()),
    "src_ns": "select 'orders' as table_name",
    "src_scan": "select cast(order_id as varchar) as order_id, status, purchased_at from stg_orders",
    "sink_view": "select cast(count(*) as bigint) as orders, cast(count(distinct customer_id) as bigint) as customers from stg_orders",
    "sink_table": whole("dim_geolocation", LEVELS["dim_geolocation"]),
    "catalog_counts": f"""select g.mart, g.grain, g.use, cast(n.n as bigint) as rows from (values """
    + ", ".join(f"('{m}', '{g}', '{u}')" for m, (g, u) in GRAINS.items())
    + f") g(mart, grain, use) left join ({counts}) n on g.mart = n.mart",
    # intermediate, step by step
    "review_counts": whole("review_counted", "review_id review_rows:i"),
    "review_flag": whole("review_flagged", LEVELS["int_order_reviews"]),
    "review_dedup1": whole("review_step1", LEVELS["int_order_reviews"]),
    "review_dedup2": """select order_id, review_id, cast(score as bigint) as score from (
        select *, row_number() over (partition by order_id order by score desc nulls last, review_id) as rn
        from review_step1) where rn = 1""",
    "items_total": whole("items_billed", "order_id items_total:m"),
    "pay_primary": whole("int_order_payments", "order_id primary_payment_type"),
    "pay_types": whole("int_order_payments", "order_id payment_types"),
    "pay_installments": whole("int_order_payments", "order_id installments:i"),
    "pay_total": whole("int_order_payments", "order_id total_payment_value:m"),
    "pay_methods": whole("int_order_payments", "order_id payment_method_count:i"),
    "pay_undefined": whole("int_order_payments", "order_id has_not_defined_payment"),
    "pay_seq_gap": whole("int_order_payments", "order_id has_incomplete_payment_sequence"),
    "pay_mismatch": whole("int_order_payments", "order_id has_payment_value_mismatch"),
    "pay_gap": whole("int_order_payments", "order_id payment_value_gap:m"),
    "on_time_flag": whole("fct_orders", "order_id is_delivered_on_time"),
    "delivery_time_days": whole("fct_orders", "order_id delivery_time_days:i"),
    # ordered analytics
    "win_dedup": "select customer_unique_id, zip_code_prefix from latest_customer",
    "win_ntile": """select seller_id, cast(revenue as double) as revenue,
        cast(ntile(10) over (order by revenue desc, seller_id) as bigint) as decile from seller_money""",
    "win_pct_change": f"""select month, cast(orders as bigint) as orders,
        {d("100.0 * (orders - lag(orders) over (order by month)) / lag(orders) over (order by month)", 4)} as change_pct
        from (select cast(date_trunc('month', purchased_at) as date) as month, count(*) as orders from windowed group by 1)""",
    "win_cumsum": f"""select seller_id, cast(revenue as double) as revenue, cast(rank as bigint) as rank,
        cast(running_value as double) as running_value,
        {d("100 * running_value / total_value", 4)} as cum_pct from seller_curve""",
    "win_threshold": """select cast(count(*) filter (cum_rev_pct <= 80) + 1 as bigint) as by_count,
        cast(min(rank) filter (cum_rev_pct >= 80) as bigint) as by_first from category_curve""",
    "win_share": f"""select category_name, cast(revenue as double) as revenue,
        {d("100 * revenue / sum(revenue) over ()", 4)} as share_pct
        from (select category_name, round(sum(total_item_value), 2) as revenue from fct_order_items group by category_name)""",
    "win_topshare": f"""select cast(count(*) as bigint) as sellers,
        {d("100 * max(case when rank = case when n_rows // 10 = 0 then n_rows else n_rows // 10 end then running_value end) / max(total_value)", 4)} as top10_pct,
        {d("100 * max(case when rank = case when n_rows // 5 = 0 then n_rows else n_rows // 5 end then running_value end) / max(total_value)", 4)} as top20_pct
        from seller_curve""",
    "win_qcut": f"select customer_id, {d('avg_ticket', 4)} as avg_ticket, cast(q as bigint) as quintile from customer_quintile",
    "display_sample": f"""select customer_id, cast(n_orders as bigint) as n_orders, cast(n_items as bigint) as n_items,
        cast(total_value as double) as total_value, {d('avg_ticket', 4)} as avg_ticket from customer_base
        order by md5(concat(cast(customer_id as varchar), '|', '1')), customer_id limit 600""",
    "display_sample_items": """select i.order_id, cast(i.order_item_id as bigint) as order_item_id, i.product_id, i.seller_id,
        cast(i.price as double) as price, cast(i.freight_value as double) as freight_value, cast(p.weight_g as bigint) as weight_g,
        p.length_cm * p.height_cm * p.width_cm / 1000.0 as volume_l
        from fct_order_items i join dim_products p on i.product_id = p.product_id
        where p.weight_g is not null and i.price > 0 and i.freight_value between 0 and 2500 and p.weight_g < 12000
        order by md5(concat_ws('|', cast(i.order_id as varchar), cast(i.order_item_id as varchar), cast(i.product_id as varchar),
                               cast(i.seller_id as varchar), cast(i.price as varchar), '1')), i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price
        limit 8000""",
    # orders
    "an_kpi": f"""select cast(count(*) as bigint) as orders, cast(count(distinct customer_id) as bigint) as customers,
        cast(round(sum(total_payment_value), 2) as double) as revenue, {d("sum(total_payment_value) / count(total_payment_value)", 4)} as aov,
        {d(pct("status = 'delivered'"), 4)} as delivered_pct, {d("avg(review_score)", 4)} as avg_review from fct_orders""",
    "an_on_time_pct": f"""select {d(pct("is_delivered_on_time"), 4)} as on_time_pct from fct_orders
        where status = 'delivered' and is_delivered_on_time is not null""",
    "an_coverage": """select cast(min(purchased_at) as date) as first_order, cast(max(purchased_at) as date) as last_order,
        cast(count(*) as bigint) as orders_total,
        cast(count(*) filter (purchased_at >= timestamp '1996-01-01' and purchased_at < timestamp '2001-07-01') as bigint)
          as orders_in_window, cast(count(distinct customer_id) as bigint) as customers_total from fct_orders""",
    "an_monthly": """select cast(date_trunc('month', purchased_at) as date) as month, cast(count(*) as bigint) as orders,
        cast(round(sum(total_payment_value), 2) as double) as revenue from windowed group by 1""",
    "an_mom": f"""select month, cast(orders as bigint) as orders, cast(revenue as double) as revenue,
        {d("100 * (revenue - lag(revenue) over (order by month)) / lag(revenue) over (order by month)", 4)} as mom_pct from (
        select cast(date_trunc('month', purchased_at) as date) as month, count(*) as orders,
               round(sum(total_payment_value), 2) as revenue from windowed group by 1)""",
    "an_qoq": f"""select concat('Q', qtr, '-', yr) as period, cast(yr as bigint) as yr, cast(qtr as bigint) as qtr,
        cast(revenue as double) as revenue,
        {d("100 * (revenue - lag(revenue) over (order by yr, qtr)) / lag(revenue) over (order by yr, qtr)", 4)} as qoq_growth_pct from (
        select year(purchased_at) as yr, quarter(purchased_at) as qtr, round(sum(total_payment_value), 2) as revenue
        from quartered group by 1, 2)""",
    "an_ontime_score": f"""select is_delivered_on_time, cast(count(*) as bigint) as orders, {d("avg(review_score)", 4)} as avg_score,
        case when is_delivered_on_time then 'on time' else 'late' end as label from fct_orders
        where status = 'delivered' and review_score is not null and is_delivered_on_time is not null group by 1""",
    "an_ontime_score_window": f"""select is_delivered_on_time, cast(count(*) as bigint) as orders, {d("avg(review_score)", 4)} as avg_score,
        case when is_delivered_on_time then 'on time' else 'late' end as label from windowed
        where status = 'delivered' and review_score is not null and is_delivered_on_time is not null group by 1""",
    "an_status": f"""select status, cast(count(*) as bigint) as orders, {d("100.0 * count(*) / sum(count(*)) over ()", 2)} as pct
        from windowed group by status""",
    "an_payment_mix": f"""select primary_payment_type as type, cast(count(*) as bigint) as orders,
        {d("avg(installments)", 4)} as avg_installments, {d("sum(total_payment_value) / count(*)", 4)} as aov,
        {d("100.0 * count(*) / sum(count(*)) over ()", 1)} as order_share_pct from windowed
        where primary_payment_type is not null and total_payment_value is not null group by 1""",
    "an_score_dist": f"""select cast(review_score as bigint) as review_score, cast(count(*) as bigint) as n,
        {d("100.0 * count(*) / sum(count(*)) over ()", 1)} as pct from windowed where review_score is not null
        group by review_score""",
    "an_geo_top": f"""select state, cast(orders as bigint) as orders, cast(revenue as double) as revenue,
        {d("100.0 * orders / sum(orders) over ()", 1)} as order_share_pct from (
        select delivery_state as state, count(*) as orders, round(sum(total_payment_value), 2) as revenue
        from windowed group by 1 order by 2 desc, 1 nulls first limit 10)""",
    "an_state_share": f"""select delivery_state as state, cast(count(*) as bigint) as orders,
        {d("100.0 * count(*) / (select count(*) from fct_orders)", 4)} as share from fct_orders
        where delivery_state is not null group by 1 order by 2 desc, 1 limit 8""",
    "an_freight_quarter": f"""select cast(date_trunc('quarter', o.purchased_at) as date) as quarter,
        cast(round(sum(i.freight_value), 2) as double) as total_freight, cast(round(sum(i.price), 2) as double) as total_price,
        {d("100 * sum(i.freight_value) / sum(i.price)", 4)} as freight_pct,
        concat(year(date_trunc('quarter', o.purchased_at)), 'Q', quarter(date_trunc('quarter', o.purchased_at))) as label
        from quartered o join fct_order_items i on o.order_id = i.order_id
        group by date_trunc('quarter', o.purchased_at)""",
    # delivery
    "an_delivery_profile": f"""select cast(count(*) as bigint) as delivered, {d("avg(delivery_time_days)", 4)} as avg_days,
        cast(median(delivery_time_days) as double) as median_days, {d(pct("is_delivered_on_time"), 4)} as on_time_pct
        from windowed where status = 'delivered' and delivery_time_days is not null""",
    "an_avg_early": f"""select {d("avg(date_diff('day', delivered_to_customer_at, cast(estimated_delivery_date as timestamp)))", 4)} as avg_days_early
        from windowed where status = 'delivered' and delivered_to_customer_at is not null""",
    "an_state_buffer": f"""select *, case when avg_buffer_days < 11 then 'tight (<11d)' else 'generous (>=11d)' end as buffer_tier from (
        select delivery_state as state, cast(count(*) as bigint) as orders,
        {d("avg(date_diff('day', delivered_to_customer_at, cast(estimated_delivery_date as timestamp)))", 4)} as avg_buffer_days,
        {d(pct("is_delivered_on_time"), 4)} as on_time_pct, {d("avg(delivery_time_days)", 4)} as avg_delivery_days
        from fct_orders where status = 'delivered' and delivered_to_customer_at is not null and delivery_state is not null
        group by 1 having count(*) >= 200)""",
    "an_single_item": whole(
        "single_item", "order_id is_delivered_on_time review_score:i delivery_time_days:i weight_g:i category_name"
    ),
    "an_weight_profile": f"""select weight_bucket, cast(count(*) as bigint) as orders, {d("avg(review_score)", 4)} as avg_score,
        {d("avg(delivery_time_days)", 4)} as avg_delivery_days,
        {d("avg(review_score) filter (not is_delivered_on_time)", 4)} as late_score,
        {d("avg(review_score) filter (is_delivered_on_time)", 4)} as ontime_score,
        {d("avg(review_score) filter (is_delivered_on_time) - avg(review_score) filter (not is_delivered_on_time)", 4)} as lateness_penalty
        from single_banded where weight_bucket is not null group by weight_bucket having count(is_delivered_on_time) > 0""",
    "an_gap_category": f"""select category_name,
        {d("avg(review_score) filter (not is_delivered_on_time)", 4)} as late_score,
        {d("avg(review_score) filter (is_delivered_on_time)", 4)} as ontime_score,
        {d("avg(review_score) filter (is_delivered_on_time) - avg(review_score) filter (not is_delivered_on_time)", 4)} as lateness_penalty
        from single_item where is_delivered_on_time is not null and category_name in (
            select category_name from single_item where category_name is not null group by 1
            order by count(*) desc, category_name limit 8) group by category_name""",
    # distance
    "an_zip_centroid": f"select zip_code_prefix, {d('degrees(phi)', 4)} as latitude, {d('degrees("lambda")', 4)} as longitude from zip_point",
    "an_order_distance": f"""select order_id, delivery_state, status, cast(delivery_time_days as bigint) as delivery_time_days,
        is_delivered_on_time, cast(review_score as bigint) as review_score, cast(est_buffer_days as bigint) as est_buffer_days,
        {d('weight_g', 4)} as weight_g, category_name, {d('dist_km', 4)} as dist_km from order_distance""",
    "an_distance_cov": f"""select cast(count(*) as bigint) as orders_pulled,
        cast(count(*) filter (status = 'delivered' and dist_km is not null) as bigint) as delivered_with_distance,
        {d("100.0 * count(*) filter (status = 'delivered' and dist_km is not null) / count(*)", 4)} as coverage_pct,
        {d("avg(dist_km) filter (status = 'delivered' and dist_km is not null)", 4)} as mean_km,
        {d("median(dist_km) filter (status = 'delivered' and dist_km is not null)", 4)} as median_km from order_distance""",
    "an_est_window": whole("far", "order_id est_buffer_days:i delivery_time_days:i est_window:i"),
    "an_by_distance": f"""select dist_bucket, cast(count(*) as bigint) as orders, {d("avg(delivery_time_days)", 4)} as avg_days,
        {d("100.0 * count(*) filter (is_delivered_on_time) / count(is_delivered_on_time)", 4)} as on_time_pct,
        {d("avg(review_score)", 4)} as avg_score from far_banded where dist_bucket is not null group by 1""",
    "an_deadline_gradient": f"""select vs_estimate, {d("avg(review_score)", 4)} as avg_score,
        case when vs_estimate like '%late%' then 'late' else 'early' end as side from (
        select review_score, case when est_buffer_days < -15 then '15+ late' when est_buffer_days < -7 then '7-15 late'
            when est_buffer_days < 0 then '1-7 late' when est_buffer_days < 5 then '0-5 early'
            when est_buffer_days < 10 then '5-10 early' when est_buffer_days < 20 then '10-20 early' else '20+ early'
            end as vs_estimate from far where review_score is not null and est_buffer_days is not null) group by 1""",
    "an_speed_bands": f"""select speed_bucket, {d("avg(review_score)", 4)} as avg_score from (
        select review_score, case when delivery_time_days > 0 and delivery_time_days <= 7 then '<7 days'
            when delivery_time_days > 7 and delivery_time_days <= 14 then '7-14'
            when delivery_time_days > 14 and delivery_time_days <= 21 then '14-21'
            when delivery_time_days > 21 then '21+' end as speed_bucket
        from far where is_delivered_on_time and review_score is not null) where speed_bucket is not null group by 1""",
    "an_speed_corr": f"""select {corr("delivery_time_days", "review_score")} as corr_days_score,
        {corr("est_buffer_days", "review_score")} as corr_early_score from far
        where is_delivered_on_time and review_score is not null""",
    "an_window_corr": f"""select {corr("dist_km", "est_window")} as corr_distance_window,
        {corr("delivery_time_days", "est_window")} as corr_days_window from far""",
    "an_state_equity": f"""select delivery_state, cast(orders as bigint) as orders, {d("dist_km", 4)} as dist_km,
        {d("avg_days", 4)} as avg_days, {d("on_time_pct", 4)} as on_time_pct, {d("avg_score", 4)} as avg_score,
        {d("buffer", 4)} as buffer,
        {d("avg_days - (regr_intercept(avg_days, dist_km) over () + regr_slope(avg_days, dist_km) over () * dist_km)", 4)}
          as slower_than_dist_predicts from (
        select delivery_state, count(*) as orders, avg(dist_km) as dist_km, avg(delivery_time_days) as avg_days,
            100.0 * count(*) filter (is_delivered_on_time) / count(is_delivered_on_time) as on_time_pct,
            avg(review_score) as avg_score, avg(est_buffer_days) as buffer from far
        where delivery_state is not null group by 1 having count(*) >= 200)""",
    # customers
    "an_customer_base": f"""select customer_id, cast(n_orders as bigint) as n_orders, cast(n_items as bigint) as n_items,
        cast(total_value as double) as total_value, {d('avg_ticket', 4)} as avg_ticket from customer_base""",
    "an_repeat_pct": f"select {d(pct('n_orders >= 2'), 4)} as repeat_pct from customer_base",
    "an_value_corr": f"""select {corr("total_value", "avg_ticket")} as corr_value_ticket,
        {corr("total_value", "n_items")} as corr_value_items from customer_base""",
    "an_quintile": f"""select concat('Q', q) as quintile, {d("min(avg_ticket)", 4)} as lo, {d("max(avg_ticket)", 4)} as hi,
        cast(count(*) as bigint) as customers, {d("avg(n_items)", 4)} as avg_items,
        cast(sum(total_value) as double) as revenue, {d("100 * sum(total_value) / sum(sum(total_value)) over ()", 4)} as rev_share
        from customer_quintile group by q""",
    "an_quintile_mix": """select concat('Q', q) as quintile, category_name, cast(n as bigint) as items from (
        select c.q, i.category_name, count(*) as n,
               row_number() over (partition by c.q order by count(*) desc, i.category_name) as rn
        from fct_order_items i join fct_orders o on i.order_id = o.order_id
        join customer_quintile c on o.customer_id = c.customer_id
        where i.category_name is not null and c.q in (1, 5) group by 1, 2) where rn <= 6""",
    "an_basket_size": f"""select cast(n_items as bigint) as n_items, cast(count(*) as bigint) as orders,
        {d("100.0 * count(*) / sum(count(*)) over ()", 4)} as pct
        from (select order_id, count(*) as n_items from fct_order_items group by 1) group by n_items""",
    "an_frequency": f"""select cast(least(n_orders, 4) as bigint) as n_orders, cast(count(*) as bigint) as customers,
        {d("100.0 * count(*) / sum(count(*)) over ()", 4)} as pct from customer_base group by least(n_orders, 4)""",
    "an_customer_window": f"""select cast(count(*) as bigint) as customers, {d(pct("orders >= 2"), 4)} as repeat_pct,
        {d("sum(spend) / count(spend)", 4)} as mean_spend, {d("median(spend)", 4)} as median_spend from window_customers""",
    "an_orders_per_customer": """select cast(orders as bigint) as orders_per_customer, cast(count(*) as bigint) as customers
        from window_customers group by orders""",
    "an_customer_pareto": f"""select cast(count(*) as bigint) as customers,
        {d("100.0 * min(case when running_value * 100 >= total_value * 80 then rank end) / max(n_rows)", 4)} as pct_customers_for_80,
        {d("100 * max(case when rank = case when n_rows // 10 = 0 then n_rows else n_rows // 10 end then running_value end) / max(total_value)", 4)} as top10_pct,
        {d("100 * max(case when rank = case when n_rows // 5 = 0 then n_rows else n_rows // 5 end then running_value end) / max(total_value)", 4)} as top20_pct
        from customer_curve""",
    "an_customer_curve": f"""select customer_id, cast(spend as double) as spend, cast(rank as bigint) as rank,
        {d("100 * running_value / total_value", 4)} as cum_rev_pct, {d("100.0 * rank / n_rows", 4)} as cum_cust_pct
        from customer_curve""",
    "an_consumable_repeat": f"""select {d(pct("e.n >= 2"), 4)} as repeat_pct
        from buyers b join orders_each e on b.customer_id = e.customer_id""",
    "an_runway": f"""select case when b.first_at < (select max(purchased_at) from fct_orders) - interval 12 month
            then 'early (>12mo runway)' else 'late (<12mo runway)' end as cohort, {d(pct("e.n >= 2"), 4)} as repeat_pct
        from buyers b join orders_each e on b.customer_id = e.customer_id group by 1""",
    "an_repeat_bars": f"""select 'All customers' as "group", {d(pct('n_orders >= 2'), 4)} as repeat_pct from customer_base
        union all select 'Consumable buyers', {d(pct("e.n >= 2"), 4)}
        from buyers b join orders_each e on b.customer_id = e.customer_id
        union all select case when b.first_at < (select max(purchased_at) from fct_orders) - interval 12 month
            then 'Consumable (>12mo runway)' else 'Consumable (<12mo runway)' end, {d(pct("e.n >= 2"), 4)}
        from buyers b join orders_each e on b.customer_id = e.customer_id group by 1""",
    # categories
    "an_category_rev": f"""select category_name, cast(revenue as double) as revenue, cast(items as bigint) as items,
        {d("avg_price", 4)} as avg_price, {d("100 * revenue / sum(revenue) over ()", 1)} as pct from category_money""",
    "an_category_pareto": f"""select category_name, cast(revenue as double) as revenue, cast(rank as bigint) as rank,
        {d("cum_rev_pct", 4)} as cum_rev_pct, {d("cat_rank_pct", 4)} as cat_rank_pct from category_curve""",
    "an_category_to_80": """select cast(count(*) filter (cum_rev_pct <= 80) + 1 as bigint) as n_to_share,
        cast(count(*) as bigint) as categories from category_curve""",
    "an_category_econ": f"""select category_name, cast(items as bigint) as items, cast(revenue as double) as revenue,
        {d("avg_price", 4)} as avg_price, {d("avg_freight", 4)} as avg_freight, {d("freight_pct", 4)} as freight_pct,
        {d("avg_weight_g", 4)} as avg_weight_g, {d("avg_volume_l", 4)} as avg_volume_l,
        {d("100 * revenue / sum(revenue) over ()", 4)} as rev_share_pct from economics""",
    "an_category_cov": f"""select cast(count(*) as bigint) as categories,
        cast(count(*) filter (items >= 300) as bigint) as large_categories,
        {d("100 * sum(revenue) filter (items >= 300) / sum(revenue)", 4)} as revenue_pct from economics""",
    "an_freight_overall": f"select {d('p', 4)} as freight_pct from overall_freight",
    "an_freight_cat": f"""select category_name, cast(items as bigint) as items, cast(revenue as double) as revenue,
        {d("freight_pct", 4)} as freight_pct, {d("p", 4)} as overall_pct,
        case when freight_pct > p then 'above platform avg' else 'below platform avg' end as burden
        from economics, overall_freight where items >= 300 order by economics.revenue desc, category_name limit 10""".replace(
        "from economics, overall_freight", "from economics join overall_freight on true"
    ),
    "an_freight_rank": f"""select category_name, cast(items as bigint) as items, {d("freight_pct", 4)} as freight_pct,
        cast(row_number() over (order by cast(economics.freight_pct as decimal(38,8)) desc, category_name) as bigint) as rank
        from economics where economics.items >= 300""",
    "an_freight_range": f"""select {d("min(freight_pct)", 4)} as min_pct,
        first(category_name order by cast(freight_pct as decimal(38,8)), category_name) as min_category,
        {d("max(freight_pct)", 4)} as max_pct,
        first(category_name order by cast(freight_pct as decimal(38,8)) desc, category_name) as max_category
        from economics where items >= 300""",
    "an_freight_driver": f"""select cast(count(*) as bigint) as items, {corr("p.weight_g", "i.freight_value")} as corr_weight_freight,
        {corr("p.length_cm * p.height_cm * p.width_cm / 1000.0", "i.freight_value")} as corr_volume_freight
        from fct_order_items i join dim_products p on i.product_id = p.product_id
        where p.weight_g is not null and i.price > 0 and i.freight_value between 0 and 2500 and p.weight_g < 12000""",
    "an_price_burden": f"""select {corr("cast(avg_price as decimal(38,8))", "cast(freight_pct as decimal(38,8))")} as corr_price_freight
        from economics where items >= 300""",
    "an_priority": f"""select category_name, cast(revenue as double) as revenue, {d("rev_share_pct", 4)} as rev_share_pct,
        {d("freight_pct", 4)} as freight_pct, {d("avg_weight_g", 4)} as avg_weight_g from (
        select *, median(revenue) over () as mid from (
            select *, 100 * revenue / sum(revenue) over () as rev_share_pct from economics) where items >= 300)
        where freight_pct > (select p from overall_freight) and revenue > mid""",
    # sellers
    "an_seller_decile": f"""select cast(decile as bigint) as decile, cast(sum(revenue) as double) as revenue,
        {d("100 * sum(revenue) / sum(sum(revenue)) over ()", 1)} as rev_share_pct from (
        select revenue, ntile(10) over (order by revenue desc, seller_id) as decile from seller_window_money) group by decile""",
    "an_seller_speed": f"""select seller_id, cast(total_orders as bigint) as total_orders, {d("days", 4)} as avg_delivery_time_days,
        {d("score", 4)} as avg_review_score from seller_tempo""",
    "an_seller_speed_corr": f"""select {corr("cast(days as decimal(38,8))", "cast(score as decimal(38,8))")} as corr_days_score from seller_tempo""",
    # figures named in the text
    "ex_return_gap": """select cast(count(*) as bigint) as returning, cast(median(days) as double) as median_days from (
        select customer_id, date_diff('day', min(purchased_at), max(purchased_at)) as days from (
            select customer_id, purchased_at,
                   row_number() over (partition by customer_id order by purchased_at, order_id) as rn
            from fct_orders) where rn <= 2 group by customer_id having count(*) = 2)""",
    "ex_state_sigma": f"""select delivery_state as state, cast(count(*) as bigint) as orders,
        {d("stddev_samp(delivery_time_days)", 4)} as sigma_days from fct_orders
        where status = 'delivered' and delivery_time_days is not null and delivery_state is not null
        group by 1 having count(*) >= 200""",
    "ex_item_burden_corr": f"""select {corr("cast(price as double)", "cast(freight_value as double) / cast(price as double)")} as corr_price_burden
        from fct_order_items where price > 0""",
    "ex_ontime_weight_corr": f"""select {corr("weight_g", "review_score")} as corr_weight_score from single_item
        where is_delivered_on_time""",
    "ex_tail_500": f"""select {d(pct("avg_ticket > 30000"), 4)} as customer_pct,
        {d("100 * sum(total_value) filter (avg_ticket > 30000) / sum(total_value)", 4)} as revenue_pct from customer_base""",
    "ex_zip_movers": """select cast(count(*) filter (zips > 1) as bigint) as movers, cast(count(*) as bigint) as persons from (
        select customer_unique_id, count(distinct zip_code_prefix) as zips from stg_customers group by 1)""",
    "ex_zip_density": f"""select cast(count(*) as bigint) as zips, {d("avg(n)", 4)} as mean_rows, cast(max(n) as bigint) as max_rows
        from (select zip_code_prefix, count(*) as n from stg_geolocation group by 1)""",
}

GAP = f"""{d("avg(review_score) filter (not is_delivered_on_time)", 4)} as late_score,
    {d("avg(review_score) filter (is_delivered_on_time)", 4)} as ontime_score,
    {d("avg(review_score) filter (is_delivered_on_time) - avg(review_score) filter (not is_delivered_on_time)", 4)} as lateness_penalty"""
S["an_gap"] = f"""select delivery_state, {GAP} from far where review_score is not null and is_delivered_on_time is not null
    and delivery_state is not null group by delivery_state"""
S["an_gap_distance"] = f"""select dist_bucket, {GAP} from far_banded where review_score is not null
    and is_delivered_on_time is not null and dist_bucket is not null group by dist_bucket"""

FACTORS = {
    "dist_km": "dist_km", "delivery_days": "delivery_time_days", "days_early": "est_buffer_days", "weight_g": "weight_g",
    "review_score": "review_score", "on_time": "cast(is_delivered_on_time as int)",
}
S["an_corr_matrix"] = " union all ".join(
    f"select '{a}' as factor, '{b}' as against, {corr(x, y)} as corr from far"
    for a, x in FACTORS.items() for b, y in FACTORS.items()
)


def binned(values: str) -> str:
    """``values`` gives rows (v, w); 40 equal-width bins from the smallest to the largest v, the last one closed."""
    return f"""select cast(b.bin as bigint) as bin, {d("m.lo + (b.bin - 1) * (m.hi - m.lo) / 40", 4)} as low,
        {d("m.lo + b.bin * (m.hi - m.lo) / 40", 4)} as high, cast(coalesce(k.n, 0) as bigint) as rows
        from (select unnest(range(1, 41)) as bin) b
        join (select cast(min(v) as double) as lo, cast(max(v) as double) as hi from ({values})) m on true
        left join (select least(floor(40 * (x.v - y.lo) / (y.hi - y.lo)) + 1, 40) as bin, count(*) as n
                   from ({values}) x join (select cast(min(v) as double) as lo, cast(max(v) as double) as hi from ({values})) y on true
                   group by 1) k on b.bin = k.bin"""


USUAL = "from windowed where status = 'delivered' and delivery_time_days between 0 and 200"
EARLY = "date_diff('day', delivered_to_customer_at, cast(estimated_delivery_date as timestamp))"
S["an_delivery_hist"] = binned(f"select least(delivery_time_days, 40) as v {USUAL}")
S["an_early_hist"] = binned(f"select greatest(least({EARLY}, 40), -15) as v {USUAL}")
S["an_distance_hist"] = binned("select least(dist_km, 2500.0) as v from far")

# --- checks ---------------------------------------------------------------------------------------------------------


def text_list(values) -> str:
    return "(" + ", ".join(repr(v) for v in values) + ")"


S |= {
    "dq_unique": """select review_id, cast(count(*) as bigint) as n from stg_order_reviews where review_id is not null
        group by review_id having count(*) > 1""",
    "dq_not_null": "select product_id, weight_g from stg_products where weight_g is null",
    "dq_accepted": """select model, "column", value, cast(count(*) as bigint) as n from (
            select 'stg_orders' as model, 'status' as "column", status as value from stg_orders
            union all select 'stg_order_payments', 'payment_type', payment_type from stg_order_payments
            union all select 'stg_order_reviews', 'score', cast(score as varchar) from stg_order_reviews
            union all select 'int_order_reviews', 'score', cast(score as varchar) from int_order_reviews)
        where value not in ('delivered', 'shipped', 'canceled', 'unavailable', 'invoiced', 'processing', 'created', 'approved',
            'credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined', '1', '2', '3', '4', '5') group by all""",
    "dq_relationship": """select review_id, order_id from stg_order_reviews r where order_id is not null
        and not exists (select 1 from stg_orders o where o.order_id = r.order_id)""",
    "dq_composite_key": """select 'stg_order_items' as model, order_id, cast(order_item_id as bigint) as position,
            cast(count(*) as bigint) as n from stg_order_items group by order_id, order_item_id having count(*) > 1
        union all select 'stg_order_payments', order_id, cast(payment_sequential as bigint), cast(count(*) as bigint)
            from stg_order_payments group by order_id, payment_sequential having count(*) > 1""",
    "dq_item_values": """select order_id, cast(order_item_id as bigint) as order_item_id, cast(price as double) as price,
        cast(freight_value as double) as freight_value from stg_order_items where price <= 0 or freight_value < 0""",
    "dq_installments": """select order_id, cast(payment_sequential as bigint) as payment_sequential,
        cast(payment_installments as bigint) as payment_installments from stg_order_payments where payment_installments < 1""",
    "dq_pay_seq": """select order_id, cast(max(payment_sequential) as bigint) as max_sequential,
        cast(count(*) as bigint) as payment_rows from stg_order_payments group by 1 having max(payment_sequential) <> count(*)""",
    "dq_one_review": """select order_id, cast(count(*) as bigint) as review_rows from stg_order_reviews group by 1
        having count(*) > 1""",
    "dq_review_order": """select review_id, cast(count(distinct order_id) as bigint) as orders from stg_order_reviews group by 1
        having count(distinct order_id) > 1""",
    "dq_approved": "select order_id, purchased_at, approved_at from stg_orders where approved_at < purchased_at",
    "dq_delivery_seq": """select order_id, delivered_to_carrier_at, delivered_to_customer_at from stg_orders
        where delivered_to_customer_at < delivered_to_carrier_at""",
    "dq_has_payment": """select o.order_id, o.status from stg_orders o left join stg_order_payments p on o.order_id = p.order_id
        where p.order_id is null""",
    "dq_answered": "select review_id, order_id, created_at, answered_at from stg_order_reviews where answered_at < created_at",
    "dq_pay_match": """select order_id, cast(total_payment_value as double) as total_payment_value,
        cast(payment_value_gap as double) as payment_value_gap from int_order_payments where has_payment_value_mismatch""",
    "dq_rate_range": """select 'mart_customer_summary' as model, customer_id as id, cast(on_time_delivery_rate as double) as on_time_delivery_rate
            from mart_customer_summary where on_time_delivery_rate < 0 or on_time_delivery_rate > 1
        union all select 'mart_seller_performance', seller_id, cast(on_time_delivery_rate as double)
            from mart_seller_performance where on_time_delivery_rate < 0 or on_time_delivery_rate > 1""",
    "dq_score_range": """select 'mart_customer_summary' as model, customer_id as id, cast(avg_review_score as double) as avg_review_score
            from mart_customer_summary where avg_review_score < 1 or avg_review_score > 5
        union all select 'mart_seller_performance', seller_id, cast(avg_review_score as double)
            from mart_seller_performance where avg_review_score < 1 or avg_review_score > 5""",
    "dq_orders_pos": """select 'mart_customer_summary' as model, customer_id as id, cast(total_orders as bigint) as total_orders
            from mart_customer_summary where total_orders <= 0
        union all select 'mart_seller_performance', seller_id, cast(total_orders as bigint)
            from mart_seller_performance where total_orders <= 0""",
    "dq_spend": "select customer_id, cast(total_spend as double) as total_spend from mart_customer_summary where total_spend < 0",
}

RULES = [
    ("item_values", "stg_order_items", "price", "error", "price <= 0 or freight_value < 0"),
    ("installments", "stg_order_payments", "payment_installments", "warn", "payment_installments < 1"),
    ("approved", "stg_orders", "approved_at", "error", "approved_at < purchased_at"),
    ("delivery_seq", "stg_orders", "delivered_to_customer_at", "warn", "delivered_to_customer_at < delivered_to_carrier_at"),
    ("answered", "stg_order_reviews", "answered_at", "error", "answered_at < created_at"),
    ("pay_match", "int_order_payments", "has_payment_value_mismatch", "warn", "has_payment_value_mismatch"),
    ("rate_range", "mart_customer_summary", "on_time_delivery_rate", "error", "on_time_delivery_rate not between 0 and 1"),
    ("rate_range", "mart_seller_performance", "on_time_delivery_rate", "error", "on_time_delivery_rate not between 0 and 1"),
    ("score_range", "mart_customer_summary", "avg_review_score", "error", "avg_review_score not between 1 and 5"),
    ("score_range", "mart_seller_performance", "avg_review_score", "error", "avg_review_score not between 1 and 5"),
    ("orders_pos", "mart_customer_summary", "total_orders", "error", "total_orders <= 0"),
    ("orders_pos", "mart_seller_performance", "total_orders", "error", "total_orders <= 0"),
    ("spend", "mart_customer_summary", "total_spend", "error", "total_spend < 0"),
]


def report() -> str:
    lines = [("not_null", m, n, "error", f"from {m} where {n} is null") for m, names in NOT_NULL.items() for n in names]
    lines += [("accepted_values", m, n, "error", f"from {m} where {n} not in {text_list(v)}") for m, n, v in ACCEPTED]
    lines += [(k, m, n, sev, f"from {m} where {cond}") for k, m, n, sev, cond in RULES]
    lines += [
        ("unique", m, n, "error", f"from (select {n} from {m} where {n} is not null group by {n} having count(*) > 1)")
        for m, n in UNIQUE
    ]
    lines += [
        ("composite_key", m, "+".join(key), "error", f"from (select 1 from {m} group by {', '.join(key)} having count(*) > 1)")
        for m, *key in COMPOSITE
    ]
    lines += [
        ("relationships", m, n, "error", f"from {m} where {n} is not null and {n} not in (select {f} from {ref} where {f} is not null)")
        for m, n, ref, f in RELATIONSHIPS
    ]
    lines += [
        ("pay_seq", "stg_order_payments", "payment_sequential", "warn",
         "from (select order_id from stg_order_payments group by 1 having max(payment_sequential) <> count(*))"),
        ("one_review", "stg_order_reviews", "order_id", "warn",
         "from (select order_id from stg_order_reviews group by 1 having count(*) > 1)"),
        ("review_order", "stg_order_reviews", "review_id", "warn",
         "from (select review_id from stg_order_reviews group by 1 having count(distinct order_id) > 1)"),
        ("has_payment", "stg_orders", "order_id", "warn",
         "from stg_orders where order_id not in (select order_id from stg_order_payments)"),
    ]
    parts = " union all ".join(
        f"""select '{k}' as "check", '{m}' as model, '{n}' as "column", '{sev}' as severity, cast(count(*) as bigint) as failing_rows {src}"""
        for k, m, n, sev, src in lines
    )
    return f"select *, case when failing_rows = 0 then 'pass' else severity end as status from ({parts})"


S["dq_report"] = report()

S |= {
    # over time
    "fu_trailing": """
        select * from (with dates as (select unnest([date '1996-12-31', date '1999-06-30', date '2001-08-01']) as as_of),
        known as (select as_of, customer_id, cast(purchased_at as date) as day, coalesce(total_payment_value, 0) as v
                  from fct_orders join dates on cast(purchased_at as date) <= as_of where customer_id is not null)
        select as_of, customer_id, cast(count(*) as bigint) as total_orders,
               cast(count(*) filter (day >= as_of - interval 12 month) as bigint) as total_orders_last_12m,
               cast(round(coalesce(sum(v) filter (day >= as_of - interval 12 month), 0), 2) as double) as total_spend_last_12m,
               max(day) >= as_of - interval 3 month as has_order_in_last_quarter,
               max(day) >= as_of - interval 12 month as has_order_in_last_year,
               cast(as_of - max(day) as bigint) as days_since_last_order
        from known group by as_of, customer_id)""",
    "fu_cohort": f"""
        select * from (with seen as (select distinct customer_id, date_trunc('month', purchased_at) as month from fct_orders
                      where customer_id is not null and purchased_at is not null),
        firsts as (select customer_id, min(month) as cohort from seen group by 1),
        sizes as (select cohort, count(*) as customers from firsts group by 1),
        cells as (select cohort, datediff('month', cohort, month) as month_offset, count(*) as n from seen join firsts using (customer_id) group by 1, 2),
        span as (select min(month) as low, max(month) as high from seen),
        months as (select unnest(generate_series(low, high, interval 1 month)) as cohort, high, datediff('month', low, high) as most from span),
        grid as (select cohort, high, unnest(generate_series(0, most)) as month_offset from months),
        told as (select grid.cohort, grid.month_offset, coalesce(customers, 0) as customers,
                        case when datediff('month', grid.cohort, high) >= grid.month_offset then coalesce(n, 0) end as active
                 from grid left join sizes on sizes.cohort = grid.cohort
                 left join cells on cells.cohort = grid.cohort and cells.month_offset = grid.month_offset)
        select cast(cohort as date) as cohort, cast(month_offset as bigint) as month_offset, cast(customers as bigint) as customers,
               cast(active as bigint) as active, {d("case when customers > 0 then 100.0 * active / customers end", 4)} as retention_pct from told)""",
    "fu_momentum": f"""
        select * from (with months as (select cast(range as date) as month, row_number() over (order by range) as t
                        from range(date '1999-07-01', date '2001-07-01', interval 1 month)),
        sold as (select category_name, date_trunc('month', purchased_at) as month, round(sum(total_item_value), 2) as v
                 from fct_order_items join windowed on windowed.order_id = fct_order_items.order_id where category_name is not null group by 1, 2),
        filled as (select category_name, t, cast(coalesce(v, 0) as double) as y from (select distinct category_name from sold) names
                   join months on true left join sold using (category_name, month)),
        slopes as (select a.category_name, median((b.y - a.y) / (b.t - a.t)) as slope from filled a
                   join filled b on a.category_name = b.category_name and a.t < b.t group by 1),
        levels as (select category_name, count(*) as months, count(*) filter (y <> 0) as sold, avg(y) as level from filled group by 1),
        told as (select *, case when level <> 0 then 100 * slope / level end as pct from levels join slopes using (category_name))
        select category_name, cast(months as bigint) as months, cast(sold as bigint) as months_with_sales, {d("level", 4)} as level,
               {d("slope", 4)} as slope, {d("pct", 4)} as pct_per_month,
               case when pct > 1 then 'growing' when pct < -1 then 'declining' else 'flat' end as trend from told)""",
    "fu_season": f"""
        select * from (with counted as (select date_trunc('month', purchased_at) as month, count(*) as n from windowed group by 1),
        axis as (select unnest(generate_series(min(month), max(month), interval 1 month)) as month from counted),
        series as (select month, coalesce(n, 0) as y, row_number() over (order by month) as t, count(*) over () as many
                   from axis left join counted using (month)),
        trended as (select month, y, t, many, (sum(y) over near + sum(y) over nearer) / 24.0 as trend from series
                    window near as (order by t rows between 6 preceding and 6 following),
                           nearer as (order by t rows between 5 preceding and 5 following)),
        ratios as (select month(month) as m, y / trend as r from trended where t > 6 and t <= many - 6),
        means as (select m, count(*) as years, avg(r) as mean from ratios group by 1)
        select cast(w.m as bigint) as month_of_year, cast(coalesce(years, 0) as bigint) as years,
               {d("100 * mean / (select avg(mean) from means)", 4)} as season_index
        from range(1, 13) w(m) left join means on means.m = w.m)""",
    "fu_seller_period": f"""
        select * from (with sold as (select i.seller_id, i.order_id, i.price, date_trunc('month', o.purchased_at) as month, date_trunc('quarter', o.purchased_at) as quarter
                      from fct_order_items i join fct_orders o on o.order_id = i.order_id),
        leveled as (select *, 'month' as level, month as period from sold union all select *, 'quarter', quarter from sold
                    union all select *, 'all', null from sold),
        money as (select seller_id, level, period, count(distinct order_id) as orders, count(*) as items, sum(price) as revenue from leveled group by all),
        told as (select seller_id, level, period, avg(review_score) as review, 100.0 * count(*) filter (is_delivered_on_time) / nullif(count(is_delivered_on_time), 0) as pct
                 from (select distinct seller_id, level, period, order_id from leveled) x join fct_orders using (order_id) group by all)
        select money.seller_id, money.level, cast(money.period as date) as period, cast(orders as bigint) as orders, cast(items as bigint) as items,
               cast(round(revenue, 2) as double) as revenue, {d("review", 4)} as avg_review, {d("pct", 4)} as on_time_pct
        from money join told on told.seller_id = money.seller_id and told.level = money.level and told.period is not distinct from money.period)""",
    "fu_sla_route": f"""
        select * from (with sent as (select distinct i.order_id, s.state as seller_state from fct_order_items i join stg_sellers s on s.seller_id = i.seller_id
                      where s.state is not null),
        legs as (select seller_state, delivery_state, delivery_time_days as actual, datediff('day', purchased_at, estimated_delivery_date) as promised
                 from sent join fct_orders on fct_orders.order_id = sent.order_id
                 where status = 'delivered' and delivery_state is not null and delivery_time_days is not null and estimated_delivery_date is not null),
        ranked as (select *, count(*) over route as n, row_number() over (partition by seller_state, delivery_state order by actual) as ra,
                          row_number() over (partition by seller_state, delivery_state order by promised) as rp
                   from legs window route as (partition by seller_state, delivery_state))
        select seller_state, delivery_state, cast(count(*) as bigint) as orders,
               cast(min(promised) filter (2 * rp >= n) as bigint) as promised_median, cast(min(actual) filter (2 * ra >= n) as bigint) as actual_median,
               cast(min(actual) filter (10 * ra >= 9 * n) as bigint) as actual_p90, {d("avg(promised - actual)", 4)} as avg_days_early,
               {d("100.0 * count(*) filter (actual > promised) / count(*)", 4)} as late_pct
        from ranked group by 1, 2)""",
    "fu_incremental": """
        select * from (with worth as (select order_id, sum(price + freight_value) as v from stg_order_items group by 1),
        per_customer as (select customer_unique_id as id, count(*) as total_orders, sum(coalesce(v, 0)) as value, min(purchased_at) as first_order_at,
                                max(purchased_at) as last_order_at
                         from stg_orders join stg_customers on stg_customers.customer_id = stg_orders.customer_id
                         left join worth on worth.order_id = stg_orders.order_id group by 1),
        per_seller as (select seller_id as id, count(distinct stg_order_items.order_id) as total_orders, count(*) as items, sum(price) as value, sum(freight_value) as freight
                       from stg_order_items join stg_orders on stg_orders.order_id = stg_order_items.order_id group by 1)
        select 'customer' as kind, cast(id as varchar) as id, cast(total_orders as bigint) as total_orders, cast(round(value, 2) as double) as value,
               first_order_at, last_order_at, cast(null as bigint) as items, cast(null as double) as freight from per_customer
        union all
        select 'seller', cast(id as varchar), total_orders, cast(round(value, 2) as double), null, null, items, cast(round(freight, 2) as double) from per_seller)""",
    "fu_incremental_months": """
        select * from (with delivered as (select cast(date_trunc('month', purchased_at) as date) as month, coalesce(total_payment_value, 0) as v,
                                  order_id % 97 = 0 and purchased_at < timestamp '2000-01-01' as late from fct_orders)
        select month, cast(count(*) filter (not late) as bigint) as orders, cast(round(coalesce(sum(v) filter (not late), 0), 2) as double) as revenue,
               cast(count(*) filter (late) as bigint) as late_orders, cast(round(coalesce(sum(v) filter (late), 0), 2) as double) as late_revenue
        from delivered group by 1)""",
    "fu_incremental_redelivered": """
        select cast(seller_id as varchar) as seller_id, cast(count(*) as bigint) as items, cast(round(sum(price), 2) as double) as revenue
        from stg_order_items join stg_orders on stg_orders.order_id = stg_order_items.order_id group by 1""",
}


def ticket_clusters(most: int = 6, rounds: int = 50) -> str:
    """Lloyd's rounds written out one after the other, every point compared with every center."""
    starts = ", ".join(f"({k}, {j}, {0.1 + 0.8 * j / (k - 1)})" for k in range(2, most + 1) for j in range(k))
    parts = [
        """points as materialized (select customer_id, log10(greatest(cast(avg_ticket as double), 1)) as x from customer_base where avg_ticket is not null),
        weighed as materialized (select x, count(*) as n from points group by 1)""",
        f"r0 as (select * from (values {starts}) v(k, j, q))",
    ]
    spots = """select k, j, lo.x + (hi.x - lo.x) * (h - floor(h)) as c from (select *, (n - 1) * q as h from r0, (select count(*) as n from points))
        join ranks lo on lo.r = floor(h) join ranks hi on hi.r = least(floor(h) + 1, n - 1)"""
    parts += ["ranks as materialized (select x, row_number() over (order by x) - 1 as r from points)", f"c0 as materialized (select k, j, c, false as done from ({spots}))"]
    for i in range(rounds):
        parts += [
            f"a{i} as materialized (select x, n, k, arg_min(j, (abs(x - c), j)) as j from weighed, c{i} where not done group by x, n, k)",
            f"m{i} as materialized (select k, j, sum(n * x) / sum(n) as m from a{i} group by 1, 2)",
            f"s{i} as (select k, bool_and(abs(coalesce(m, c) - c) <= 1e-8 + 1e-5 * abs(c)) as rest from c{i} left join m{i} using (k, j) where not done group by 1)",
            f"""c{i + 1} as materialized (select k, j, case when done or rest then c else coalesce(m, c) end as c, done or rest as done
                from c{i} left join m{i} using (k, j) left join s{i} using (k))""",
        ]
    last = f"c{rounds}"
    # a k that is still moving is labelled by the centers before its last move
    parts += [
        f"label as materialized (select l.k, l.j, case when f.done then f.c else l.c end as was, f.c, f.done from c{rounds - 1} l join {last} f using (k, j))",
        "told as (select x, n, k, arg_min(j, (abs(x - was), j)) as j from weighed, label group by x, n, k)",
        "within as (select k, sum(n * power(x - c, 2)) as v, bool_and(done) as done from told join label using (k, j) group by k)",
        "spread as (select sum(n * power(x - (select avg(x) from points), 2)) as total from weighed)",
    ]
    return f"""select * from (with {", ".join(parts)}
        select cast(1 as bigint) as k, case when total > 0 then 0.0 end as explained_pct, true as converged from spread where total is not null
        union all select cast(k as bigint), round(100 * (1 - v / total), 4), done from within, spread)"""


S["an_ticket_kmeans"] = ticket_clusters()

STATEMENTS = {name: with_tables(sql) for name, sql in S.items()}
