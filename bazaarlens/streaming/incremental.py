"""Incremental load of order and item drops: raw tables, touched summaries, monthly totals, redelivered rows.

Drops are files that appear below ``orders`` and ``items`` of a folder. Each run takes what is new (``availableNow``) and
ends; its checkpoint says what was taken. A batch that was interrupted runs again under its number, and everything a
batch writes is filed under that number, so a repeat replaces what the first attempt left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions.columns import row_count
from bazaarlens.session import write_out
from bazaarlens.streaming.keyed_table import GONE, KeyedTable

c = F.col
ORDERS = "order_id string, customer_id string, status string, purchased_at timestamp"
ITEMS = (
    "order_id string, order_item_id int, product_id string, seller_id string, price decimal(20,6), "
    "freight_value decimal(20,6), purchased_at timestamp"
)
ITEM_KEY = ("order_id", "order_item_id")
MONEY = "decimal(38,6)"


def drops(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", files: int | None = None) -> DataFrame:
    """The files of a folder, which must be there, as a stream; at most ``files`` of them in a batch.

    A file counts as new by its name, however old it is: by default a stream passes over one that is a week older than
    the latest.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFileAge", "3650d").option("pathGlobFilter", f"*.{kind}*")
    reader = reader.option("header", True) if kind == "csv" else reader
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    return reader.format(kind).load(folder)


def run_new(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> list[dict]:
    """Give every batch of what is new to ``each`` and end; the progress of each batch."""
    query = stream.writeStream.foreachBatch(each).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    try:
        query.awaitTermination()
        return [p if isinstance(p, dict) else p.jsonValue() if hasattr(p, "jsonValue") else p for p in query.recentProgress]
    finally:
        query.stop()


def write_batch(rows: DataFrame, path: str, batch: int) -> None:
    """File the rows of a batch under its number; once more, if it runs once more."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch={batch}")


class Shop:
    """Tables of a shop below ``path``, kept up to date by drops.

    ``raw/orders`` and ``raw/items`` have every delivered row with its batch. Orders and lines are stored by order, and
    what the summaries need of them once more by customer and by seller; ``customers`` and ``sellers`` are the
    summaries. A batch rewrites the buckets of its orders, then those of their customers and sellers.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, files: int = 1, item_key: tuple[str, ...] = ITEM_KEY):
        self.spark, self.path, self.item_key = spark, path.rstrip("/"), list(item_key)

        def table(name: str, schema: str, key: list[str], by: list[str]) -> KeyedTable:
            return KeyedTable(spark, f"{self.path}/{name}", schema, key, by, buckets, files)

        self.orders = table("orders", ORDERS, ["order_id"], ["order_id"])
        self.lines = table("lines", ITEMS, self.item_key, ["order_id"])
        bought = f"customer_id string, order_id string, purchased_at timestamp, order_value {MONEY}"
        self.customer_orders = table("customer_orders", bought, ["customer_id", "order_id"], ["customer_id"])
        sold = f"seller_id string, order_id string, items long, revenue {MONEY}, freight {MONEY}"
        self.seller_orders = table("seller_orders", sold, ["seller_id", "order_id"], ["seller_id"])
        spent = f"customer_id string, total_orders long, total_value {MONEY}, first_order_at timestamp, last_order_at timestamp"
        self.customers = table("customers", spent, ["customer_id"], ["customer_id"])
        earned = f"seller_id string, total_orders long, items long, revenue {MONEY}, freight {MONEY}"
        self.sellers = table("sellers", earned, ["seller_id"], ["seller_id"])

    def load_new(self, folder: str, kind: str = "parquet") -> list[dict]:
        """Take the new drops below ``folder``; the progress of the batches."""
        one = drops(self.spark, f"{folder}/orders", ORDERS, kind).withColumn("kind", F.lit("order"))
        two = drops(self.spark, f"{folder}/items", ITEMS, kind).withColumn("kind", F.lit("item"))
        return run_new(one.unionByName(two, allowMissingColumns=True), self.take, f"{self.path}/checkpoint")

    def take(self, rows: DataFrame, batch: int) -> None:
        """One batch: the raw tables, then the stores by order, then both summaries."""
        orders = rows.where("kind = 'order'").select(*self.orders.columns)
        items = rows.where("kind = 'item'").select(*self.lines.columns)
        write_batch(orders, f"{self.path}/raw/orders", batch)
        write_batch(items, f"{self.path}/raw/items", batch)
        orders, items = (self.raw(name).where(c("batch") == batch).drop("batch") for name in ("orders", "items"))
        orders, items = orders.where("order_id is not null"), items.dropna(subset=[*self.item_key, "seller_id"])

        begun = bool(self.orders.manifest(batch) or self.lines.manifest(batch))  # else all that is stored comes with this batch
        self.lines.merge(items, batch)
        self.orders.merge(orders, batch)
        ids = orders.select("order_id").unionByName(items.select("order_id")).distinct()
        held = self.orders.touched(ids) if begun else None

        def of_batch(table: KeyedTable, before: int | None = None) -> DataFrame:
            rows = table.read(before, held)
            return rows.join(ids, "order_id", "left_semi") if begun else rows

        per_seller = of_batch(self.lines).groupBy("seller_id", "order_id").agg(
            row_count().alias("items"),
            F.sum("price").cast(MONEY).alias("revenue"),
            F.sum("freight_value").cast(MONEY).alias("freight"),
        )
        per_seller = write_out(per_seller, "batch-lines")  # an order's rows lie in one file, so they are summed below the shuffle
        value = per_seller.groupBy("order_id").agg(
            F.sum(F.coalesce("revenue", F.lit(0)) + F.coalesce("freight", F.lit(0))).cast(MONEY).alias("order_value")
        )
        bought = of_batch(self.orders).drop("bucket", "status").join(value, "order_id", "left")
        bought = bought.withColumn("order_value", F.coalesce("order_value", F.lit(0).cast(MONEY)))
        # an order that has come to another customer leaves the one it was with
        if begun:
            bought = bought.join(of_batch(self.orders, batch).select("order_id", c("customer_id").alias("was")), "order_id", "left")
        else:
            bought = bought.withColumn("was", F.lit(None).cast("string"))
        bought = write_out(bought, "batch-orders")
        moved = bought.where("was <> customer_id or customer_id is null and was is not null")
        moved = moved.select(c("was").alias("customer_id"), "order_id", "purchased_at", "order_value", F.lit(True).alias(GONE))
        bought = bought.where("customer_id is not null").select(*self.customer_orders.columns, F.lit(False).alias(GONE))
        self._summed(self.customer_orders, bought.unionByName(moved), self.customers, batch, [
            row_count().alias("total_orders"),
            F.sum("order_value").cast(MONEY).alias("total_value"),
            F.min("purchased_at").alias("first_order_at"),
            F.max("purchased_at").alias("last_order_at"),
        ])
        self._summed(self.seller_orders, per_seller, self.sellers, batch, [
            row_count().alias("total_orders"),
            F.sum("items").alias("items"),
            F.sum("revenue").cast(MONEY).alias("revenue"),
            F.sum("freight").cast(MONEY).alias("freight"),
        ])

    def _summed(self, store: KeyedTable, changes: DataFrame, summary: KeyedTable, batch: int, sums: list[Column]) -> None:
        """Merge the changes and sum up the touched buckets anew; both tables have the same buckets."""
        touched = store.merge(changes, batch)
        if touched:
            summary.replace(touched, store.read(buckets=touched).groupBy(*summary.key).agg(*sums), batch)

    def raw(self, name: str) -> DataFrame:
        schema = f"{ORDERS if name == 'orders' else ITEMS}, batch long"
        return self.spark.read.schema(schema).parquet(f"{self.path}/raw/{name}")


class MonthlyTotals:
    """Orders and value by month from a stream of orders with ``order_value``, without reading old orders again.

    Days are event-time windows with a watermark: a day is summed in state until the watermark, ``delay`` behind the
    latest purchase seen, has passed its end. Each batch hands on the days it changed, filed by month. A row that comes
    after its day was closed is in no total. It is still in the delivered files, and ``report`` tells what is missing.
    """

    SCHEMA = f"{ORDERS}, order_value {MONEY}"

    def __init__(self, spark: SparkSession, path: str, delay: str = "30 days"):
        self.spark, self.path, self.delay = spark, path.rstrip("/"), delay
        self.days = KeyedTable(spark, f"{self.path}/days", f"month date, day date, orders long, revenue {MONEY}", ["month", "day"], ["month"])

    def load_new(self, folder: str, kind: str = "parquet") -> list[dict]:
        stream = drops(self.spark, folder, self.SCHEMA, kind).withWatermark("purchased_at", self.delay)
        summed = stream.groupBy(F.window("purchased_at", "1 day").alias("w")).agg(
            row_count().alias("orders"), F.sum("order_value").cast(MONEY).alias("revenue")
        )
        day = c("w.start").cast("date")
        days = summed.select(F.trunc(day, "month").alias("month"), day.alias("day"), "orders", "revenue")
        return run_new(days, lambda rows, batch: self.days.merge(rows, batch) and None, f"{self.path}/checkpoint", "update")

    def totals(self) -> DataFrame:
        """month, orders, revenue of the days as the stream has summed them."""
        return self.days.rows().groupBy("month").agg(F.sum("orders").alias("orders"), F.sum("revenue").cast(MONEY).alias("revenue"))

    def report(self, folder: str, kind: str = "parquet") -> DataFrame:
        """month, orders, revenue as summed, and late_orders, late_revenue: what was delivered too late to be in them."""
        delivered = self.spark.read.schema(self.SCHEMA).option("recursiveFileLookup", True).option("header", True).format(kind).load(folder)
        all_ = delivered.where("purchased_at is not null").groupBy(F.trunc("purchased_at", "month").alias("month")).agg(
            row_count().alias("all_orders"), F.sum("order_value").cast(MONEY).alias("all_revenue")
        )
        summed = all_.join(self.totals(), "month", "left")
        zero = F.lit(0).cast(MONEY)
        orders, revenue = F.coalesce("orders", F.lit(0)), F.coalesce("revenue", zero)
        return summed.select(
            "month",
            orders.alias("orders"),
            revenue.alias("revenue"),
            (c("all_orders") - orders).alias("late_orders"),
            (F.coalesce("all_revenue", zero) - revenue).cast(MONEY).alias("late_revenue"),
        )


def load_once(
    spark: SparkSession, folder: str, path: str, delay: str = "30 days", kind: str = "parquet", key: tuple[str, ...] = ITEM_KEY
) -> list[dict]:
    """Append the items of new drops to ``path``, each ``key`` once, however often it is delivered.

    A row's key is remembered until the watermark, ``delay`` behind the latest purchase seen, has passed it by
    ``delay``: the state holds the keys of that span, not of all time. A row that comes later than that is left out and
    counted in the progress (``numRowsDroppedByWatermark``).
    """
    stream = drops(spark, folder, ITEMS, kind).withWatermark("purchased_at", delay).dropDuplicatesWithinWatermark(list(key))
    return run_new(stream, lambda rows, batch: write_batch(rows, path, batch), f"{path}-checkpoint")
