from pyspark.sql import functions as F

from bazaarlens.plans import intermediate as im
from tests.helpers import frame, table

REVIEW = "review_id string, order_id string, score int, comment_title string"


def test_valid_delivery(spark):
    df = frame(
        spark, "order_id int, delivered_to_carrier_at string, delivered_to_customer_at string",
        (1, None, None), (2, "2018-01-02", None), (3, "2018-01-02", "2018-01-02"), (4, "2018-01-03", "2018-01-02"),
    )
    assert table(im.int_orders(df), "order_id", "is_valid_delivery") == [(1, None), (2, None), (3, True), (4, False)]


def test_reviews(spark):
    df = frame(
        spark, REVIEW,
        ("a", "o1", 3, None), ("a", "o2", 5, None),  # id on two orders
        ("b", "o1", 4, None),  # o1 keeps the better of a and b
        ("c", "o3", 2, None), ("d", "o3", 2, None),  # equal scores: lower review id
        ("e", "o4", 1, "x"), ("e", "o4", 1, "y"),  # repeated on the same order: duplicate by row count
        ("f", "o5", None, None), ("g", "o5", 1, None),  # unknown score loses
    )
    assert table(im.review_flag(df), "review_id", "order_id", "is_duplicate_review")[:2] == [("a", "o1", True), ("a", "o2", True)]
    assert table(im.review_counts(df)) == [("a", 2), ("b", 1), ("c", 1), ("d", 1), ("e", 2), ("f", 1), ("g", 1)]
    first = table(im.review_dedup1(df), "review_id", "order_id", "is_duplicate_review")
    assert ("a", "o1", True) in first and ("e", "o4", True) in first and len(first) == 7
    final = table(im.int_order_reviews(df), "order_id", "review_id", "score", "comment_title", "is_duplicate_review")
    assert final == [
        ("o1", "b", 4, None, False), ("o3", "c", 2, None, False), ("o4", "e", 1, "x", True), ("o5", "g", 1, None, False)
    ]
    narrow = im.int_order_reviews(df.select("review_id", "order_id", "score"))
    assert table(narrow, "order_id", "review_id", "score", "is_duplicate_review") == [
        (o, r, s, f) for o, r, s, _, f in final
    ]


def test_payments(spark):
    pay = frame(
        spark, "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(12,2)",
    )
    pay = pay.union(
        spark.sql("""select * from values
            ('one', 1, 'boleto', 0, 10.00), ('tie', 1, 'voucher', 2, 5.00), ('tie', 2, 'boleto', 3, 5.00),
            ('tie', 3, 'voucher', 1, 1.00), ('gap', 1, 'credit_card', 1, 1.00), ('gap', 3, 'not_defined', 1, 2.00),
            ('first', 2, 'boleto', 1, 1.00), ('empty', 1, null, null, null) as t(a, b, c, d, e)""")
    )
    items = spark.sql("""select * from values ('one', 9.00BD, 1.00BD), ('tie', 8.00BD, 2.50BD), ('gap', 1.00BD, 1.00BD)
        as t(order_id, price, freight_value)""")
    got = {r.order_id: r for r in im.int_order_payments(pay, items).collect()}
    assert got["one"].installments == 1 and got["one"].has_payment_value_mismatch is False
    tie = got["tie"]
    assert tie.primary_payment_type == "voucher" and tie.payment_types == ["boleto", "voucher", "voucher"]
    assert tie.payment_method_count == 2 and tie.installments == 3 and float(tie.total_payment_value) == 11.0
    assert float(tie.payment_value_gap) == -0.5 and tie.has_payment_value_mismatch is True
    assert got["gap"].has_incomplete_payment_sequence and got["gap"].has_not_defined_payment
    assert float(got["gap"].payment_value_gap) == -1.0
    assert got["first"].has_incomplete_payment_sequence and got["first"].has_payment_value_mismatch is None
    empty = got["empty"]
    assert empty.primary_payment_type is None and empty.payment_types == [] and empty.installments is None
    assert empty.total_payment_value is None and empty.payment_method_count == 0 and empty.has_not_defined_payment is False


def test_zip_modes(spark):
    df = frame(
        spark, "zip_code_prefix string, city string, state string",
        ("1", "b", "X"), ("1", "a", "Y"), ("1", None, "Y"),  # tie between cities; modes from different rows
        ("2", None, "Z"), ("2", None, "Z"), ("2", "c", "W"),
    )
    assert table(im.int_geolocation_by_zip(df)) == [("1", "a", "Y"), ("2", "c", "Z")]


def test_hot_review_id_is_not_gathered(spark):
    """A third of all rows under one id: still one partial row per task reaches the shuffle."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("review_id"),
        F.col("id").cast("string").alias("order_id"), (F.col("id") % 5).cast("int").alias("score"),
    )
    plan = im.int_order_reviews(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan
    hot = im.review_dedup1(df).filter("review_id = 'hot'").collect()
    assert len(hot) == 1 and hot[0].order_id == "0" and hot[0].is_duplicate_review
