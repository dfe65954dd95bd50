"""All tables of the warehouse over one set of raw tables, composed lazily or read back once written."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.plans import customers, distance, intermediate, marts, staging
from bazaarlens.session import write_out
from bazaarlens.sources import catalog
from bazaarlens.sources.csv_files import read_csv_folder
from bazaarlens.sources.parquet_tables import MAPPINGS, raw_tables

STAGED = {
    "stg_orders": (staging.stg_orders, "orders"),
    "stg_customers": (staging.stg_customers, "customers"),
    "stg_sellers": (staging.stg_sellers, "sellers"),
    "stg_products": (staging.stg_products, "products"),
    "stg_product_categories": (staging.stg_product_categories, "product_category_name_translation"),
    "stg_order_items": (staging.stg_order_items, "order_items"),
    "stg_order_payments": (staging.stg_order_payments, "order_payments"),
    "stg_order_reviews": (staging.stg_order_reviews, "order_reviews"),
    "stg_geolocation": (staging.stg_geolocation, "geolocation"),
}

MARTS = (
    "dim_geolocation",
    "dim_customers",
    "dim_sellers",
    "dim_products",
    "fct_orders",
    "fct_order_items",
    "mart_customer_summary",
    "mart_seller_performance",
)
INTERMEDIATES = ("int_orders", "int_order_reviews", "int_order_payments", "int_geolocation_by_zip")


class Star:
    """``star.table("fct_orders")`` gives a frame. Nothing runs until a frame is used, unless ``write_lookup`` or
    ``write_marts`` has put a table on disk."""

    def __init__(self, raw: Callable[[str], DataFrame], narrowed: Callable[[str, str], Star] | None = None):
        self._raw = raw
        self._narrowed = narrowed
        self._tables: dict[str, DataFrame] = {}
        self._written: set[str] = set()

    @classmethod
    def from_parquet(cls, spark: SparkSession, sf_dir: str) -> Star:
        return cls(raw_tables(spark, sf_dir), lambda start, end: cls(raw_tables(spark, sf_dir, (start, end))))

    def bought_between(self, start: str, end: str) -> Star:
        """A star whose source may leave out orders not bought from start until before end; all others are in it.

        Only for questions that filter the order fact on this span themselves and read nothing of other orders.
        """
        return self._narrowed(start, end) if self._narrowed else self

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> Star:
        return cls(frames.__getitem__)

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str) -> Star:
        return cls.from_frames(read_csv_folder(spark, folder))

    @classmethod
    def from_catalog(cls, spark: SparkSession, namespace: str) -> Star:
        return cls(lambda name: catalog.scan(spark, namespace, name))

    def raw(self, name: str) -> DataFrame:
        if name not in MAPPINGS:
            raise KeyError(name)
        return self._raw(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._compose(name)
        return self._tables[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Read a table off ``df``, a scan of what was written, from here on."""
        self._tables[name] = df
        self._written.add(name)

    def write_lookup(self, *names: str) -> Star:
        """Put small lookups on disk, so that their file size decides whether a fact has to be shuffled for them."""
        for name in names:
            self.replace(name, write_out(self.table(name), name))
        return self

    def write_marts(self, sink: Callable[[str, DataFrame], DataFrame] | None = None, also: tuple[str, ...] = ()) -> Star:
        """Build every mart once, each from the ones already written. ``sink`` stores a frame and returns its scan."""
        sink = sink or (lambda name, df: write_out(df, name))
        for name in (*also, *MARTS):
            self.replace(name, sink(name, self.table(name)))
        return self

    def publish(self) -> None:
        """View materialization of the staging and intermediate tables."""
        for name in (*STAGED, *INTERMEDIATES):
            catalog.publish_view(self.table(name), name)

    def _compose(self, name: str) -> DataFrame:
        t = self.table
        if name in STAGED:
            make, source = STAGED[name]
            return make(self.raw(source))
        match name:
            case "int_orders":
                return intermediate.int_orders(t("stg_orders"))
            case "int_order_reviews":
                return intermediate.int_order_reviews(t("stg_order_reviews"))
            case "int_order_payments":
                return intermediate.int_order_payments(t("stg_order_payments"), t("stg_order_items"))
            case "int_geolocation_by_zip":
                return intermediate.int_geolocation_by_zip(t("stg_geolocation"))
            case "dim_geolocation":
                return marts.dim_geolocation(t("int_geolocation_by_zip"))
            case "dim_customers":
                return marts.dim_customers(t("stg_customers"), t("stg_orders"), t("dim_geolocation"))
            case "dim_sellers":
                return marts.dim_sellers(t("stg_sellers"), t("dim_geolocation"))
            case "dim_products":
                return marts.dim_products(t("stg_products"), t("stg_product_categories"))
            case "fct_orders":
                # the order fact reads neither the payment types nor the comment texts
                paid = intermediate.with_items_check(
                    intermediate.payment_totals(t("stg_order_payments")), t("stg_order_items")
                )
                scored = intermediate.int_order_reviews(t("stg_order_reviews").select("review_id", "order_id", "score"))
                return marts.fct_orders(
                    t("int_orders"), t("stg_customers"), t("dim_geolocation"), paid, scored
                )
            case "order_lines":
                return marts.order_lines(t("stg_order_items"))
            case "product_lines":
                return marts.product_lines(t("stg_order_items"), t("stg_products"), t("stg_product_categories"))
            case "fct_order_items":
                return marts.fct_order_items(t("product_lines"), t("stg_sellers"), t("dim_geolocation"))
            case "mart_customer_summary":
                return marts.mart_customer_summary(t("fct_orders"))
            case "mart_seller_performance":
                # a written item fact spares the lines another join with their products
                lines = t("fct_order_items" if "fct_order_items" in self._written else "product_lines")
                return marts.mart_seller_performance(lines, t("fct_orders"), t("dim_sellers"))
            case "customer_base":
                return customers.customer_base(t("order_lines"), t("fct_orders"))
            case "zip_centroid":
                return distance.zip_centroid(t("stg_geolocation"))
            case "order_distance":
                return distance.order_distance(t("fct_orders"), t("product_lines"), t("stg_sellers"), t("zip_centroid"))
        raise KeyError(name)


def build(spark: SparkSession, star: Star, namespace: str, location: str | None = None) -> dict[str, int]:
    """The whole build: staging and intermediate views, marts as replaced tables. Returns rows per mart."""
    catalog.ensure_namespace(spark, namespace, location)
    star.publish()
    counts = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        # nearly every analysis filters the order fact on its purchase time
        range_by = "purchased_at" if name == "fct_orders" else None
        counts[name] = catalog.write_table(df, f"{namespace}.{name}", range_by)
        return catalog.scan(spark, namespace, name)

    star.write_marts(store)
    return counts
