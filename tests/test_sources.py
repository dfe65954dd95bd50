import pytest
from pyspark.sql import functions as F

from bazaarlens.plans.star import MARTS, Star, build
from bazaarlens.session import scratch_path
from bazaarlens.sources import catalog, csv_files
from tests.helpers import table

DATA = "/root/testdata/sf0.001"


def test_csv_with_hard_text_and_missing_files(spark, tmp_path, capsys):
    (tmp_path / "shop_order_reviews_dataset.csv").write_text(
        '"review_id","order_id","review_score","review_comment_title","review_comment_message","review_creation_date","review_answer_timestamp"\n'
        '"r1","o1",5,"a, b","she said ""fine""\nand left","2018-01-01 00:00:00","2018-01-02 10:00:00"\n'
        '"r2","o2",1,,,"2018-01-01 00:00:00","not a time"\n'
    )
    (tmp_path / "shop_sellers_dataset.csv").write_text(
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01037,sao paulo,SP\ns2,1037,x,SP\n"
    )
    star = Star.from_csv(spark, str(tmp_path))
    first, second = star.table("stg_order_reviews").orderBy("review_id").collect()
    assert first.comment_title == "a, b" and first.comment_message == 'she said "fine"\nand left' and first.score == 5
    assert second.comment_title is None and second.answered_at is None and str(second.created_at) == "2018-01-01 00:00:00"
    assert {r.zip_code_prefix for r in star.table("stg_sellers").collect()} == {"01037"}
    assert "skip orders" in capsys.readouterr().out


def test_load_replaces_tables(spark, tmp_path):
    path = tmp_path / "sellers_dataset.csv"
    namespace, place = "raw_test", scratch_path(spark, "raw-test")
    for n in (3, 2):
        path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + "".join(f"s{i},1,c,S\n" for i in range(n)))
        assert csv_files.load_raw(spark, str(tmp_path), namespace, place) == {"sellers": (n, 0)}
        assert catalog.scan(spark, namespace, "sellers").count() == n


def test_every_file_is_read_and_columns_follow_their_header(spark, tmp_path):
    (tmp_path / "2017_sellers_dataset.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\na,01037,x,SP\nb,2,y,RJ\n")
    (tmp_path / "2018_sellers_dataset.csv").write_text("seller_state,seller_id,seller_city,seller_zip_code_prefix\nMG,c,z,3\n")
    (tmp_path / "my_resellers_dataset.csv").write_text("no,table\n1,2\n")
    found = csv_files.read_csv_folder(spark, str(tmp_path))
    assert table(found["sellers"]) == [("a", "01037", "x", "SP"), ("b", "2", "y", "RJ"), ("c", "3", "z", "MG")]
    (tmp_path / "2019_sellers_dataset.csv").write_text("seller_id,city\nd,x\n")
    with pytest.raises(ValueError, match="2019"):
        csv_files.read_csv_folder(spark, str(tmp_path))


def test_rows_that_do_not_fit_are_kept_apart(spark, tmp_path):
    head = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    good = ["o1,1,p,s,2018-01-01 00:00:00,12.50,1\n", "o2,2,p,s,,,\n", "o7,1,p,s,,1.005,1891.7505\n"]
    bad = ["o3,1,p,s,,12x,1\n", "o4,abc,p,s,,1,1\n", "o5,1,p,s,,1e40,1\n", "o6,1,p\n"]
    (tmp_path / "order_items_dataset.csv").write_text(head + "".join(good + bad))
    loaded = csv_files.load_raw(spark, str(tmp_path), "raw_bad", scratch_path(spark, "raw-bad"))
    assert loaded == {"order_items": (3, 4)}
    assert table(spark.table("raw_bad.order_items"), "order_id") == [("o1",), ("o2",), ("o7",)]
    assert table(spark.table("raw_bad.order_items").where("order_id = 'o7'"), "price", "freight_value") == [(1.005, 1891.7505)]
    refused = [r for (r,) in table(spark.table("raw_bad.order_items_refused"), "_refused")]
    assert refused == ["o6,1,p", "order_item_id=abc", "price=12x", "price=1e40"]
    with pytest.raises(Exception, match="row does not fit"):
        csv_files.read_csv_folder(spark, str(tmp_path))["order_items"].collect()


def test_build_and_catalog(spark):
    place = scratch_path(spark, "marts-test")
    catalog.ensure_namespace(spark, "marts_test", place)
    empty = catalog.catalog_counts(spark, "marts_test")
    assert empty.filter(F.col("rows").isNull()).count() == len(MARTS)
    written = build(spark, Star.from_parquet(spark, DATA), "marts_test")
    counted = dict(table(catalog.catalog_counts(spark, "marts_test"), "mart", "rows"))
    assert counted == written and set(written) == set(MARTS)
    assert spark.table("stg_orders").count() == spark.table("marts_test.fct_orders").count()


def test_window_reaches_the_scan_of_orders(spark):
    """Windowed questions push bounds on the order date into the scan."""
    from bazaarlens.plans import registry

    for name in ("an_monthly", "an_category_rev"):
        plan = registry.run(name, spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "o_orderdate" in line]
        assert any("GreaterThan(o_orderdate" in line and "LessThan(o_orderdate" in line for line in pushed), name


def test_a_load_writes_the_text_once(spark, tmp_path, monkeypatch):
    """A drop without refused rows is parsed once and written once; every column of a short row is looked at."""
    head = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    (tmp_path / "sellers_dataset.csv").write_text(head + "a,1,x,SP\nb,2,y,RJ\n")
    written, write_table = [], csv_files.write_table
    monkeypatch.setattr(csv_files, "write_table", lambda df, name: (written.append(df), write_table(df, name))[1])
    place = scratch_path(spark, "raw-once")
    assert csv_files.load_raw(spark, str(tmp_path), "raw_once", place) == {"sellers": (2, 0)}
    assert len(written) == 1 and all(p.endswith("sellers_dataset.csv") for p in written[0].inputFiles())
    (tmp_path / "sellers_dataset.csv").write_text(head + "a,1,x,SP\nb,2\n")
    assert csv_files.load_raw(spark, str(tmp_path), "raw_once", place) == {"sellers": (1, 1)}
    assert len(written) == 3 and spark.table("raw_once.sellers_refused").count() == 1
