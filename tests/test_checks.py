from bazaarlens.plans import checks as dq
from tests.helpers import frame, table


def test_generic_checks_ignore_null_where_they_should(spark):
    df = frame(spark, "a string, b int", ("x", 1), ("x", 1), ("y", 2), (None, 3), (None, 3))
    assert table(dq.check_unique(df, "a")) == [("x", 2)]
    assert table(dq.check_unique(df, "a", "b")) == [("x", 1, 2)]
    assert dq.check_not_null(df, "a").count() == 2
    assert table(dq.check_accepted(df, "a", ["x"])) == [("y", 2)]
    assert table(dq.check_relationship(df, "a", frame(spark, "k string", ("x",), (None,)), "k")) == [("y", 2)]


def test_rules_do_not_fire_on_null(spark):
    items = frame(spark, "price double, freight_value double", (0.0, 1.0), (1.0, -1.0), (1.0, 0.0), (None, None))
    assert dq.check_rule(items, dq.item_values_wrong).count() == 2


def failing(spark, schema, violation, *rows):
    """Places of the rows that a rule reports."""
    df = frame(spark, f"at int, {schema}", *[(i, *row) for i, row in enumerate(rows)])
    return sorted(r["at"] for r in dq.check_rule(df, violation).collect())


def test_row_rules_report_violations_only(spark):
    assert failing(spark, "payment_installments int", dq.installments_wrong, (0,), (1,), (None,), (-2,)) == [0, 3]
    early = ("2018-01-02", "2018-01-01"), ("2018-01-01", "2018-01-01"), (None, "2018-01-01"), ("2018-01-01", "2018-01-02")
    assert failing(spark, "purchased_at string, approved_at string", dq.approved_too_early, *early) == [0]
    assert failing(spark, "created_at string, answered_at string", dq.answered_too_early, *early) == [0]
    places = "delivered_to_carrier_at string, delivered_to_customer_at string"
    assert failing(spark, places, dq.delivered_before_carrier, *early) == [0]
    assert failing(spark, "has_payment_value_mismatch boolean", dq.payment_differs, (True,), (False,), (None,)) == [0]
    assert failing(spark, "on_time_delivery_rate double", dq.rate_out_of_range, (-0.01,), (0.0,), (1.0,), (1.5,), (None,)) == [0, 3]
    assert failing(spark, "avg_review_score double", dq.score_out_of_range, (0.9,), (1.0,), (5.0,), (5.1,), (None,)) == [0, 3]
    assert failing(spark, "total_orders int", dq.no_orders, (0,), (1,), (-1,)) == [0, 2]
    assert failing(spark, "total_spend double", dq.negative_spend, (-0.01,), (0.0,), (None,)) == [0]


def test_rules_over_several_rows(spark):
    paid = frame(spark, "order_id int, payment_sequential int", (1, 1), (1, 2), (2, 2), (3, 1), (3, 1))
    assert table(dq.incomplete_sequences(paid)) == [(2, 2, 1), (3, 1, 2)]
    reviews = frame(spark, "review_id int, order_id int", (1, 1), (2, 1), (3, 2), (3, 3), (4, 4), (4, 4))
    assert table(dq.several_reviews(reviews)) == [(1, 2), (4, 2)]
    assert table(dq.shared_review_ids(reviews)) == [(3, 2)]
    assert table(dq.unpaid_orders(frame(spark, "order_id int", (1,), (9,), (None,)), paid)) == [(9,)]


def test_every_column_check_is_configured():
    assert sum(map(len, dq.NOT_NULL.values())) == 96
    assert len(dq.UNIQUE) == 16 and len(dq.ACCEPTED) == 4 and len(dq.RELATIONSHIPS) == 10


def test_report_counts_what_the_single_checks_find(spark):
    """A small shop with a fault of every kind; each line of the report against the check it stands for."""
    from pyspark.sql import functions as F

    from bazaarlens.plans.star import Star

    star = Star.from_parquet(spark, "/root/testdata/sf0.001")
    faults = {
        "stg_orders": lambda df: df.limit(300).unionByName(df.limit(3)).withColumn("status", F.when(F.col("order_id") % 50 == 0, "lost").otherwise(F.col("status"))),
        "stg_sellers": lambda df: df.limit(5).withColumn("city", F.lit(None).cast("string")),
        "stg_products": lambda df: df.filter("product_id % 7 <> 0"),
        "stg_order_payments": lambda df: df.filter("payment_sequential <> 1 or order_id % 3 = 0").withColumn("order_id", F.when(F.col("order_id") % 11 > 0, F.col("order_id"))),
    }
    for name, spoil in faults.items():
        star.replace(name, spoil(star.table(name)))
    report = {(r.check, r.model, r.column): (r.severity, r.failing_rows, r.status) for r in dq.dq_report(star).collect()}
    t, want = star.table, {}
    for model in dq.NOT_NULL:
        for rule in dq.all_row_rules(model):
            violation = F.expr(rule.violation) if isinstance(rule.violation, str) else rule.violation
            want[rule.check, model, rule.column] = t(model).filter(violation).count() if model in (*faults, "stg_order_reviews", "stg_order_items") else None
    for m, n in dq.UNIQUE:
        want["unique", m, n] = dq.check_unique(t(m), n).count() if m.startswith("stg_") else None
    for m, *key in dq.COMPOSITE:
        want["composite_key", m, "+".join(key)] = dq.check_unique(t(m), *key).count()
    for m, n, ref, field in dq.RELATIONSHIPS:
        want["relationships", m, n] = dq.check_relationship(t(m), n, t(ref), field).count() if m.startswith("stg_") else None
    want["pay_seq", "stg_order_payments", "payment_sequential"] = dq.incomplete_sequences(t("stg_order_payments")).count()
    want["one_review", "stg_order_reviews", "order_id"] = dq.several_reviews(t("stg_order_reviews")).count()
    want["review_order", "stg_order_reviews", "review_id"] = dq.shared_review_ids(t("stg_order_reviews")).count()
    want["has_payment", "stg_orders", "order_id"] = dq.unpaid_orders(t("stg_orders"), t("stg_order_payments")).count()
    assert set(report) == set(want) and len(report) == 145
    assert {k: report[k][1] for k, v in want.items() if v is not None} == {k: v for k, v in want.items() if v is not None}
    assert sum(bool(v) for v in want.values()) >= 14
    assert all(status == ("pass" if n == 0 else severity) for severity, n, status in report.values())


def test_report_scans_each_table_once(spark):
    from bazaarlens.plans.star import Star
    from bazaarlens.session import write_out

    star = Star.from_parquet(spark, "/root/testdata/sf0.001")
    for model in dq.NOT_NULL:
        star.replace(model, write_out(star.table(model).limit(5), model))
    plan = dq.dq_report(star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") == len(dq.NOT_NULL)


def test_key_check_takes_more_tasks_for_more_rows(spark):
    df = frame(spark, "a int, b int", (1, 1), (1, 1), (2, 1), (None, 1), (None, 1))
    found = dq.check_unique(df, "a", "b", rows=20 * dq.KEYS_PER_TASK)
    assert table(found) == [(1, 1, 2)]
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString() and found.rdd.getNumPartitions() == 21


def test_report_sorts_no_entries(spark):
    from bazaarlens.plans.star import Star
    from bazaarlens.session import write_out

    star = Star.from_parquet(spark, "/root/testdata/sf0.001")
    for model in dq.NOT_NULL:
        star.replace(model, write_out(star.table(model).limit(5), model))
    schema = star.table("stg_order_reviews").schema
    rows = [(n, o, 5, None, None, None, None) for n, o in ((1, 1), (1, 2), (2, 3), (2, 3), (None, 4), (None, 5), (3, None), (3, 7))]
    star.replace("stg_order_reviews", spark.createDataFrame(rows, schema))
    report = dq.dq_report(star)
    assert "SortAggregate" not in report._jdf.queryExecution().executedPlan().toString()
    (found,) = report.where("check = 'review_order'").collect()
    assert found.failing_rows == dq.shared_review_ids(star.table("stg_order_reviews")).count() == 2
