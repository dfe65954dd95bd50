"""Questions over time on small hand-made tables."""

from datetime import date, datetime
from decimal import Decimal

from bazaarlens.plans import periods
from bazaarlens.plans.settings import Settings
from tests.helpers import frame, table

ORDER = "order_id string, customer_id string, purchased_at timestamp_ntz, total_payment_value decimal(12,2)"


def bought(spark, *rows):
    return frame(spark, ORDER, *[(f"o{n}", who, when and datetime(*when), v and Decimal(v)) for n, (who, when, v) in enumerate(rows)])


def test_trailing_features_at_each_date(spark):
    orders = bought(
        spark, ("a", (2016, 6, 30, 23), "1"), ("a", (2017, 6, 30, 1), "2"), ("a", (2017, 6, 30, 2), "4"), ("a", (2017, 12, 1), None),
        ("b", (2018, 1, 1), "8"), ("c", None, "16"), (None, (2017, 1, 1), "32"),
    )
    made = periods.trailing(orders, ("2017-06-30", "2018-06-30", "2015-01-01"))
    assert table(made) == [
        (date(2017, 6, 30), "a", 3, 3, 7.0, True, True, 0),
        (date(2018, 6, 30), "a", 4, 3, 6.0, False, True, 211),
        (date(2018, 6, 30), "b", 1, 1, 8.0, False, True, 180),
    ]
    assert periods.trailing(orders.limit(0), ("2018-01-01",)).collect() == []


def test_trailing_shuffles_do_not_follow_the_dates(spark):
    orders = bought(spark, ("a", (2016, 6, 30), "1"))

    def exchanges(*dates):
        return periods.trailing(orders, dates)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges("2017-01-01") == exchanges(*[f"2017-{m:02}-01" for m in range(1, 13)]) == 2


def test_cohort_triangle_is_dense_and_ends_with_the_data(spark):
    orders = bought(spark, ("a", (2017, 11, 5), "1"), ("a", (2017, 11, 9), "1"), ("a", (2018, 2, 1), "1"), ("b", (2017, 11, 1), "1"), ("c", (2018, 1, 1), "1"), ("d", None, "1"))
    cells = {(str(r.cohort), r.month_offset): (r.customers, r.active, r.retention_pct and float(r.retention_pct)) for r in periods.cohorts(orders).collect()}
    assert len(cells) == 16
    assert [cells["2017-11-01", k] for k in range(4)] == [(2, 2, 100.0), (2, 0, 0.0), (2, 0, 0.0), (2, 1, 50.0)]
    assert [cells["2017-12-01", k] for k in range(4)] == [(0, 0, None), (0, 0, None), (0, 0, None), (0, None, None)]
    assert [cells["2018-01-01", k][1] for k in range(4)] == [1, 0, None, None]
    assert periods.cohorts(orders.limit(0)).collect() == []


def test_momentum_is_not_decided_by_single_months(spark):
    settings = Settings(window_start="2017-01-01", window_end="2017-07-01")
    months = bought(spark, *[("a", (2017, m, 15), "1") for m in range(1, 8)])  # o6, in July, is outside
    sales = {
        "up": [10, 20, 30, 900, 50, 60, 5000],
        "down": [60, 50, 40, 30, 20, 10, 0],
        "flat": [7, 7, 0, 7, 7, 7, 7],
        "gaps": [None, None, 12, None, None, None, None],
    }
    rows = [(f"o{m}", name, Decimal(v)) for name, values in sales.items() for m, v in enumerate(values) if v is not None]
    lines = frame(spark, "order_id string, category_name string, total_item_value decimal(12,2)", *rows, ("o1", None, Decimal(5)))
    made = {r.category_name: r for r in periods.momentum(months, lines, settings).collect()}
    assert set(made) == set(sales) and all(r.months == 6 for r in made.values())
    assert [(made[n].trend, float(made[n].slope)) for n in ("up", "down", "flat", "gaps")] == [("growing", 10.0), ("declining", -10.0), ("flat", 0.0), ("flat", 0.0)]
    assert made["gaps"].months_with_sales == 1 and float(made["gaps"].level) == 2.0
    short = periods.momentum(months, lines, settings, points=2)
    assert {r.category_name: (r.months, float(r.slope)) for r in short.collect()} == {"up": (2, 10.0), "down": (2, -10.0), "flat": (2, 0.0), "gaps": (2, 0.0)}


def test_season_around_a_rising_trend(spark):
    """Orders rise by 12 a month; in December they are doubled."""
    settings = Settings(window_start="2015-01-01", window_end="2019-01-01")
    counts = [(100 + 2 * t) * (2 if t % 12 == 11 else 1) for t in range(48)]
    rows = [(f"o{t}-{k}", "a", datetime(2015 + t // 12, t % 12 + 1, 3), None) for t, n in enumerate(counts) for k in range(n)]
    made = {r.month_of_year: r for r in periods.season(frame(spark, ORDER, *rows), settings).collect()}
    assert sorted(made) == list(range(1, 13)) and all(r.years == 3 for r in made.values())
    assert abs(sum(float(r.season_index) for r in made.values()) - 1200) < 0.01
    assert 180 < float(made[12].season_index) < 190 and all(90 < float(made[m].season_index) < 95 for m in range(1, 12))
    few = periods.season(frame(spark, ORDER, *rows[:900]), settings)
    assert few.collect() == []  # no month has a full year around it


def test_seller_periods_count_an_order_once_on_each_level(spark):
    orders = frame(
        spark, "order_id string, purchased_at timestamp_ntz, review_score int, is_delivered_on_time boolean",
        ("o1", datetime(2018, 1, 5), 5, True), ("o2", datetime(2018, 2, 5), 2, False), ("o3", datetime(2018, 4, 1), None, None), ("o4", None, 4, True),
    )
    line = "order_id string, order_item_id int, seller_id string, price decimal(12,2), freight_value decimal(12,2)"
    lines = frame(spark, line, *[(o, n, s, Decimal(p), Decimal(1)) for o, n, s, p in (
        ("o1", 1, "s", "10"), ("o1", 2, "s", "5"), ("o2", 1, "s", "1"), ("o3", 1, "s", "2"), ("o1", 3, "t", "3"), ("o4", 1, "t", "4"),
    )])
    made = {(r.seller_id, r.level, r.period and str(r.period)): tuple(r)[3:] for r in periods.seller_periods(lines, orders).collect()}
    assert made == {
        ("s", "month", "2018-01-01"): (1, 2, Decimal(15), Decimal(5), Decimal(100)), ("s", "month", "2018-02-01"): (1, 1, Decimal(1), Decimal(2), Decimal(0)),
        ("s", "month", "2018-04-01"): (1, 1, Decimal(2), None, None), ("s", "quarter", "2018-01-01"): (2, 3, Decimal(16), Decimal("3.5"), Decimal(50)),
        ("s", "quarter", "2018-04-01"): (1, 1, Decimal(2), None, None), ("s", "all", None): (3, 4, Decimal(18), Decimal("3.5"), Decimal(50)),
        ("t", "month", "2018-01-01"): (1, 1, Decimal(3), Decimal(5), Decimal(100)), ("t", "month", None): (1, 1, Decimal(4), Decimal(4), Decimal(100)),
        ("t", "quarter", "2018-01-01"): (1, 1, Decimal(3), Decimal(5), Decimal(100)), ("t", "quarter", None): (1, 1, Decimal(4), Decimal(4), Decimal(100)),
        ("t", "all", None): (2, 2, Decimal(7), Decimal("4.5"), Decimal(100)),
    }


def test_routes_read_quantiles_off_day_counts(spark):
    orders = frame(
        spark, "order_id string, status string, purchased_at timestamp_ntz, estimated_delivery_date date, delivery_time_days int, delivery_state string",
        *[(f"o{n}", "delivered", datetime(2018, 1, 1, 5), date(2018, 1, 21), days, "RJ") for n, days in enumerate((1, 2, 2, 3, 30))],
        ("x1", "shipped", datetime(2018, 1, 1), date(2018, 1, 21), 9, "RJ"), ("x2", "delivered", datetime(2018, 1, 1), date(2018, 1, 21), None, "RJ"),
        ("x3", "delivered", datetime(2018, 1, 1), date(2018, 1, 11), 4, None),
    )
    lines = frame(spark, "order_id string, seller_id string", *[(f"o{n}", s) for n in range(5) for s in ("s1", "s2", "s3")], ("x1", "s1"), ("x2", "s1"), ("x3", "s1"))
    sellers = frame(spark, "seller_id string, state string", ("s1", "SP"), ("s2", "SP"), ("s3", None))
    assert table(periods.routes(orders, lines, sellers)) == [("SP", "RJ", 5, 20, 2, 30, 12.4, 20.0)]
