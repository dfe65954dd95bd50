import pytest
from pyspark.sql import functions as F

from bazaarlens.plans import marts
from bazaarlens.plans.star import Star
from bazaarlens.sources.parquet_tables import MAPPINGS
from tests.helpers import frame, table



@pytest.fixture(scope="module")
def star(spark):
    def sql(text):
        return spark.sql(text)

    return Star.from_frames({
        "orders": sql("""select * from values
            ('o1','c1','delivered','2018-01-01 10:00:00','2018-01-01 11:00:00','2018-01-02 00:00:00','2018-01-10 00:00:00','2018-01-10'),
            ('o2','c2','delivered','2018-02-01 23:59:00','','2018-02-02 00:00:00','2018-02-02 00:01:00','2018-02-01'),
            ('o3','c3','delivered','2018-03-01 10:00:00','',null,'2018-03-05 08:00:00','2018-03-06 00:00:00'),
            ('o4','c4','shipped','2018-03-01 10:00:00','garbage',null,null,'2018-03-05'),
            ('o5','c5','delivered','2018-03-01 10:00:00','','2018-03-01 12:00:00','2018-03-05 08:00:00','2018-03-05')
            as t(order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
            order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date)"""),
        "customers": sql("""select * from values ('c1','p1','1001','x','X'), ('c2','p1','2002','x','X'), ('c3','p2','3003','y','Y'),
            ('c4','p3','1001','x','X'), ('c5','p3','2002','x','X'), ('c9','p9','1001','x','X')
            as t(customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state)"""),
        "geolocation": sql("""select * from values ('1001', 0.0D, 0.0D, 'uno', 'SP'), ('2002', 0.0D, 1.0D, 'dos', 'RJ')
            as t(geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state)"""),
        "sellers": sql("""select * from values ('s1','1001','x','X'), ('s2','9009','y','Y')
            as t(seller_id, seller_zip_code_prefix, seller_city, seller_state)"""),
        "products": sql("""select product_id, product_category_name, 1D as product_name_lenght, 1D as product_description_lenght,
            1D as product_photos_qty, w as product_weight_g, 10D as product_length_cm, 10D as product_height_cm, 10D as product_width_cm
            from values ('k1','beleza',100D), ('k2','sem_traducao',null), ('k3',null,300D) as t(product_id, product_category_name, w)"""),
        "product_category_name_translation": sql("""select 'beleza' as product_category_name, 'beauty' as product_category_name_english"""),
        "order_items": sql("""select order_id, order_item_id, product_id, seller_id, '2018-01-01 00:00:00' as shipping_limit_date,
            price, freight_value from values ('o1',1,'k1','s1',10.00BD,1.00BD), ('o1',2,'k2','s1',20.00BD,2.00BD), ('o1',3,'k1','s2',5.00BD,0.50BD),
            ('o2',1,'k3','s1',30.00BD,3.00BD), ('o3',1,'zz','s2',7.00BD,0.70BD)
            as t(order_id, order_item_id, product_id, seller_id, price, freight_value)"""),
        "order_payments": sql("""select * from values ('o1',1,'boleto',1,38.50BD), ('o2',1,'voucher',1,30.00BD), ('o3',1,'boleto',0,7.70BD)
            as t(order_id, payment_sequential, payment_type, payment_installments, payment_value)"""),
        "order_reviews": sql("""select review_id, order_id, review_score, null as review_comment_title, null as review_comment_message,
            '2018-01-01' as review_creation_date, '2018-01-02' as review_answer_timestamp
            from values ('r1','o1',5), ('r2','o2',1), ('r2','o3',4) as t(review_id, order_id, review_score)"""),
    })


def test_order_fact(star):
    got = {r.order_id: r for r in star.table("fct_orders").collect()}
    assert got["o1"].is_delivered_on_time is True  # midnight of the promised day
    assert got["o5"].is_delivered_on_time is False  # 08:00 of the promised day is late
    assert got["o4"].is_delivered_on_time is None and got["o4"].approved_at is None
    assert got["o2"].delivery_time_days == 1 and got["o4"].delivery_time_days is None
    assert got["o3"].is_valid_delivery is None and got["o2"].is_valid_delivery is True
    assert got["o1"].customer_id == "p1" and got["o1"].delivery_zip_code_prefix == "01001" and got["o1"].delivery_city == "uno"
    assert got["o3"].delivery_city is None  # zip not in the lookup
    assert got["o2"].review_score is None and got["o2"].is_duplicate_review is None  # a repeated review does not count
    assert got["o3"].review_score is None and got["o1"].is_duplicate_review is False
    assert got["o2"].has_payment_value_mismatch is True and got["o1"].has_payment_value_mismatch is False


def test_dimensions(star):
    assert table(star.table("dim_customers")) == [
        ("p1", "02002", "dos", "RJ"), ("p2", "03003", None, None), ("p3", "02002", "dos", "RJ")
    ]  # p3: equal times, higher customer id; p9 has no order
    assert table(star.table("dim_sellers")) == [("s1", "01001", "uno", "SP"), ("s2", "09009", None, None)]
    assert table(star.table("dim_products"), "product_id", "category_name") == [("k1", "beauty"), ("k2", None), ("k3", None)]


def test_item_fact(star):
    rows = table(star.table("fct_order_items"), "order_id", "order_item_id", "total_item_value", "category_name", "seller_city")
    assert rows[0] == ("o1", 1, 11.0, "beauty", "uno") and rows[2] == ("o1", 3, 5.5, "beauty", None)
    assert rows[4] == ("o3", 1, 7.7, None, None) and len(rows) == 5


def test_customer_summary(star):
    got = {r.customer_id: r for r in star.table("mart_customer_summary").collect()}
    assert got["p1"].total_orders == 2 and float(got["p1"].total_spend) == 68.5 and float(got["p1"].avg_order_value) == 34.25
    assert got["p1"].is_repeat_customer and float(got["p1"].on_time_delivery_rate) == 0.5 and float(got["p1"].avg_review_score) == 5
    assert got["p2"].on_time_delivery_rate is None  # on time, but no carrier time
    assert float(got["p3"].total_spend) == 0 and got["p3"].avg_review_score is None


def test_on_time_rate_can_exceed_one(spark):
    orders = frame(
        spark, "customer_id string, order_id string, total_payment_value decimal(12,2), purchased_at date, review_score int, "
        "is_delivered_on_time boolean, is_valid_delivery boolean",
        ("p", "a", None, None, None, True, None), ("p", "b", None, None, None, True, True),
    )
    assert float(marts.mart_customer_summary(orders).first().on_time_delivery_rate) == 2.0


def test_seller_performance_weighs_by_line(star):
    got = {r.seller_id: r for r in star.table("mart_seller_performance").collect()}
    s1 = got["s1"]
    assert (s1.total_orders, s1.total_items_sold, float(s1.total_revenue), float(s1.avg_item_price)) == (2, 3, 60.0, 20.0)
    assert float(s1.avg_delivery_time_days) == 6.3 and float(s1.on_time_delivery_rate) == 0.67  # 9, 9, 1 days; two of three lines
    assert s1.distinct_categories == 1 and s1.city == "uno" and float(s1.avg_review_score) == 5
    assert got["s2"].state is None and got["s2"].distinct_categories == 1 and got["s2"].total_orders == 2


def test_unused_lookups_leave_the_plan(star):
    plan = star.table("fct_orders").groupBy("status").agg(F.count("order_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "payment_value" not in plan and "review" not in plan and "geolocation" not in plan


def test_written_marts_equal_composed_ones(star, spark):
    written = Star(star._raw).write_marts()
    for name in ("fct_orders", "mart_seller_performance", "mart_customer_summary", "dim_customers"):
        assert table(written.table(name)) == table(star.table(name))


def test_sellers_read_the_written_item_fact(spark):
    star = Star.from_parquet(spark, "/root/testdata/sf0.001")
    composed = table(star.table("mart_seller_performance"))
    star = Star.from_parquet(spark, "/root/testdata/sf0.001")
    plans = {}

    def sink(name, df):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return df.localCheckpoint()

    star.write_marts(sink)
    assert table(star.table("mart_seller_performance")) == composed and composed
    assert "l_orderkey" in plans["fct_order_items"] and "l_orderkey" not in plans["mart_seller_performance"]


def test_payments_of_lines_are_hashed_and_follow_the_least_flag(spark):
    lines = spark.createDataFrame(
        [(1, f, n) for n, flags in enumerate(("NA", "RN", "R", "NB", "0A", (None, "N"), (None,), ("A", "A"))) for f in flags],
        "l_orderkey long, l_returnflag string, l_linenumber int",
    ).selectExpr("*", "1d as l_quantity", "10d as l_extendedprice", "0.1d as l_tax")
    paid = spark.sql(MAPPINGS["order_payments"], lineitem=lines)
    kinds = ["credit_card", "boleto", "voucher", "voucher", "voucher", "boleto", "voucher", "credit_card"]
    assert table(paid, "payment_sequential", "payment_type") == list(enumerate(kinds))
    assert "SortAggregate" not in paid._jdf.queryExecution().executedPlan().toString()
