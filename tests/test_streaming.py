"""Drops in runs against one load of everything: raw tables, summaries, monthly totals, redelivered rows."""

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

from bazaarlens.plans import registry
from bazaarlens.plans.star import Star
from bazaarlens.streaming import incremental
from bazaarlens.streaming.keyed_table import KeyedTable
from tests.helpers import table

DAY = datetime(2018, 1, 1)


def at(month, day=1):
    return datetime(2018, month, day, 10)


def order(n, customer, when, status="delivered"):
    return (f"o{n}", customer, status, when)


def item(n, line, seller, price, when, freight="1"):
    return (f"o{n}", line, "p", seller, Decimal(price), None if freight is None else Decimal(freight), when)


ORDERS = [order(1, "a", at(1)), order(2, "b", at(1, 9)), order(3, "a", at(2)), order(4, "c", at(3)), order(5, None, at(3))]
ITEMS = [item(1, 1, "s", "10", at(1)), item(1, 2, "t", "5", at(1)), item(2, 1, "s", "7.25", at(1, 9), None), item(4, 1, "u", "2", at(3)), item(9, 1, "u", "50", at(4))]


@pytest.fixture
def deliver(spark, tmp_path):
    def put(name, rows, schema, n):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/drops/{name}/drop-{n}")

    return put


def shop_rows(shop):
    return {name: table(getattr(shop, name).rows()) for name in ("orders", "lines", "customers", "sellers", "customer_orders", "seller_orders")}


def test_runs_of_drops_give_the_tables_of_one_load(spark, tmp_path, deliver):
    folder = f"{tmp_path}/drops"
    parts = incremental.Shop(spark, f"{tmp_path}/parts", buckets=4)
    for n, (orders, items) in enumerate(((ORDERS[:3], ITEMS[1:]), (ORDERS[3:], ITEMS[:1]))):
        deliver("orders", orders, incremental.ORDERS, n)
        deliver("items", items, incremental.ITEMS, n)
        parts.load_new(folder)
    parts.load_new(folder)  # nothing new
    whole = incremental.Shop(spark, f"{tmp_path}/whole", buckets=4)
    whole.load_new(folder)
    assert shop_rows(parts) == shop_rows(whole)
    assert [r[:3] for r in table(whole.customers.rows())] == [("a", 2, 17.0), ("b", 1, 7.25), ("c", 1, 3.0)]
    assert table(whole.sellers.rows()) == [("s", 2, 2, 17.25, 1.0), ("t", 1, 1, 5.0, 1.0), ("u", 2, 2, 52.0, 2.0)]
    assert table(parts.raw("orders").drop("batch")) == table(whole.raw("orders").drop("batch")) == sorted(ORDERS, key=repr)
    assert {r.batch for r in parts.raw("items").collect()} == {0, 1}


@pytest.mark.parametrize("broken", ["orders", "sellers"])
def test_a_batch_that_broke_off_is_taken_once(spark, tmp_path, deliver, monkeypatch, broken):
    """The run ends after a table was written and before the batch was committed; the next run repeats it."""
    folder = f"{tmp_path}/drops"
    deliver("orders", ORDERS, incremental.ORDERS, 0)
    deliver("items", ITEMS, incremental.ITEMS, 0)
    shop = incremental.Shop(spark, f"{tmp_path}/shop", buckets=2)
    own = getattr(shop, broken)
    replace = own.replace

    def breaks(*args):
        replace(*args)
        raise RuntimeError("lost")

    own.replace = breaks
    with pytest.raises(Exception, match="lost"):
        shop.load_new(folder)
    own.replace = replace
    shop.load_new(folder)
    whole = incremental.Shop(spark, f"{tmp_path}/whole", buckets=2)
    whole.load_new(folder)
    assert shop_rows(shop) == shop_rows(whole)
    assert shop.raw("orders").count() == len(ORDERS) and shop.raw("items").count() == len(ITEMS)


def test_only_touched_buckets_are_rewritten(spark, tmp_path, deliver):
    folder = f"{tmp_path}/drops"
    many = [order(n, f"c{n % 40}", at(1 + n % 12)) for n in range(200)]
    deliver("orders", many, incremental.ORDERS, 0)
    deliver("items", [item(n, 1, f"s{n % 30}", str(n), at(1 + n % 12)) for n in range(200)], incremental.ITEMS, 0)
    shop = incremental.Shop(spark, f"{tmp_path}/shop", buckets=8)
    shop.load_new(folder)
    stores = (shop.orders, shop.lines, shop.customers, shop.sellers, shop.customer_orders, shop.seller_orders)
    before = [s.manifest() for s in stores]
    files = {p for p in Path(tmp_path, "shop").rglob("*.parquet") if "/data/" in str(p)}
    # one order changes its customer, another comes anew
    deliver("orders", [order(7, "c8", at(8)), order(500, "c9", at(12))], incremental.ORDERS, 1)
    deliver("items", [item(500, 1, "s1", "1000", at(12))], incremental.ITEMS, 1)
    shop.load_new(folder)
    assert files <= set(Path(tmp_path, "shop").rglob("*.parquet"))
    for store, was, most in zip(stores, before, (2, 1, 3, 2, 3, 2), strict=True):
        now = store.manifest()
        assert 0 < sum(now[b] != f for b, f in was.items()) <= most, store.path
    bought = [o for o in many if o[0] != "o7"] + [order(7, "c8", at(8)), order(500, "c9", at(12))]
    counts = {}
    for o in bought:
        counts[o[1]] = counts.get(o[1], 0) + 1
    assert {r.customer_id: r.total_orders for r in shop.customers.rows().collect()} == counts
    (seller,) = shop.sellers.rows().where("seller_id = 's1'").collect()
    assert (seller.total_orders, seller["items"], seller.revenue) == (8, 8, sum(n for n in range(200) if n % 30 == 1) + 1000)


def test_keyed_table_takes_back_and_empties(spark, tmp_path):
    held = KeyedTable(spark, f"{tmp_path}/t", "k long, v string", ["k"], buckets=3)
    assert held.rows().collect() == [] and held.manifest() == {}
    held.merge(spark.createDataFrame([(1, "a"), (2, None), (1, "b")], "k long, v string"), 0)
    assert table(held.rows()) == [(1, "b"), (2, None)]  # of one key the largest row
    held.merge(spark.createDataFrame([(1, "x", True), (3, "c", False)], "k long, v string, gone boolean"), 4)
    assert table(held.rows()) == [(2, None), (3, "c")] and table(held.read(before=4).drop("bucket")) == [(1, "b"), (2, None)]
    held.merge(spark.createDataFrame([(3, "d")], "k long, v string"), 4)  # the same version again, from the one before it
    assert table(held.rows()) == [(1, "b"), (2, None), (3, "d")]
    held.merge(spark.createDataFrame([(k, "", True) for k in (1, 2, 3)], "k long, v string, gone boolean"), 5)
    assert held.rows().collect() == [] and table(held.read(before=5).drop("bucket")) == [(1, "b"), (2, None), (3, "d")]
    held.merge(spark.createDataFrame([], "k long, v string"), 6)
    assert held.rows().collect() == []


def valued(n, when, value="10"):
    return (*order(n, "a", when), None if value is None else Decimal(value))


def test_months_count_late_orders_apart(spark, tmp_path, deliver):
    totals = incremental.MonthlyTotals(spark, f"{tmp_path}/months", delay="10 days")
    runs = [
        [valued(1, at(1, 3)), valued(2, at(1, 30)), valued(3, at(2, 2), "2.5")],
        [valued(4, at(2, 3)), valued(5, at(1, 29), None), valued(6, at(4, 20))],  # o5: before the watermark has passed its day
        [valued(7, at(1, 3), "99"), valued(8, at(4, 12), "3"), valued(9, at(4, 1), "7")],  # o7 and o9 are late
    ]
    dropped = []
    for n, rows in enumerate(runs):
        deliver("valued", rows, totals.SCHEMA, n)
        progress = totals.load_new(f"{tmp_path}/drops/valued")
        dropped.append(sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]))
    assert dropped[:2] == [0, 0] and dropped[2] >= 2
    report = table(totals.report(f"{tmp_path}/drops/valued"))
    months = [(str(m), *rest) for m, *rest in report]
    assert months == [("2018-01-01", 3, 20.0, 1, 99.0), ("2018-02-01", 2, 12.5, 0, 0.0), ("2018-04-01", 2, 13.0, 1, 7.0)]


def test_items_delivered_twice_count_once(spark, tmp_path, deliver):
    path, folder = f"{tmp_path}/once", f"{tmp_path}/drops/items"
    dropped = 0
    for n, rows in enumerate((ITEMS[:3], ITEMS[:3], ITEMS[2:] + ITEMS[3:], [item(1, 3, "s", "1", at(1))])):
        deliver("items", rows, incremental.ITEMS, n)
        progress = incremental.load_once(spark, folder, path, "30 days")
        dropped += sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    taken = spark.read.schema(incremental.ITEMS).parquet(path)
    assert table(taken.drop("batch")) == sorted([tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in ITEMS], key=repr)
    assert dropped >= 1  # the last one came more than 30 days late


def test_a_merge_shuffles_rows_once_and_sorts_them_once(spark, tmp_path, monkeypatch):
    held = KeyedTable(spark, f"{tmp_path}/t", "k string, v string, w string", ["k"], buckets=3)
    held.merge(spark.createDataFrame([(str(k), "a", "b") for k in range(50)], "k string, v string, w string"), 0)
    plans = []
    replace = held.replace
    monkeypatch.setattr(held, "replace", lambda buckets, rows, *rest: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), replace(buckets, rows, *rest)))
    changes = spark.createDataFrame([("7", "x", None), ("99", None, None)], "k string, v string, w string")
    assert len(held.merge(changes, 1)) == 2 or len(held.manifest()) == 3
    assert plans[0].count("Exchange") == 1 and plans[0].count("Sort [") == 1
    rows = {r.k: (r.v, r.w) for r in held.rows().collect()}
    assert len(rows) == 51 and rows["7"] == ("x", None) and rows["99"] == (None, None) and rows["8"] == ("a", "b")


def test_redelivered_lines_meet_their_orders_once(spark, monkeypatch):
    plans = []
    deliver = registry.deliver
    monkeypatch.setattr(registry, "deliver", lambda df, *where: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), deliver(df, *where)))
    sold = registry.redelivered_items(Star.from_parquet(spark, "/root/testdata/sf0.001"))
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert sum(r["items"] for r in sold.collect()) == lines.count()
    assert sum("Join" in p for p in plans) == 1 and sum("Join" not in p for p in plans) == 3
