"""Namespaces, tables and views of the session catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# What one row of each mart stands for and what the mart is used for.
MART_GRAINS = [
    ("fct_orders", "one order", "status, delivery, payment, review"),
    ("fct_order_items", "one line item", "product/seller economics: price, freight"),
    ("dim_customers", "one customer (person)", "customer location"),
    ("dim_sellers", "one seller", "seller location"),
    ("dim_products", "one product", "category, weight, dimensions"),
    ("dim_geolocation", "one zip prefix", "city / state lookup"),
    ("mart_customer_summary", "one customer", "pre-aggregated spend / behaviour"),
    ("mart_seller_performance", "one seller", "pre-aggregated revenue / quality"),
]


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}{place}")


def scan(spark: SparkSession, namespace: str, table: str) -> DataFrame:
    """Whole source table by name."""
    return spark.table(f"{namespace}.{table}")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """View materialization: nothing is stored, readers compose on the plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_table(df: DataFrame, name: str, range_by: str | None = None) -> int:
    """Table materialization: replace the table, return its row count (counted during the write).

    ``range_by`` lays the rows out by ranges of a column, so that a filter on it skips whole files and row groups.
    """
    if range_by:
        df = df.repartitionByRange(range_by).sortWithinPartitions(range_by)
    # counted above the repartitioning, whose sampling pass reads the rows below it once more
    seen = Observation(f"rows of {name}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet").saveAsTable(name)
    return seen.get["rows"]


def catalog_counts(spark: SparkSession, namespace: str) -> DataFrame:
    """Every known mart with its grain, its use and its rows; a mart that is not in the catalog has NULL rows."""
    present = {t.name for t in spark.catalog.listTables(namespace)}
    counts = [
        scan(spark, namespace, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("mart"), "rows")
        for name, _, _ in MART_GRAINS
        if name in present
    ]
    known = spark.createDataFrame(MART_GRAINS, "mart string, grain string, `use` string")
    if not counts:
        return known.withColumn("rows", F.lit(None).cast("bigint"))
    return known.join(reduce(DataFrame.unionByName, counts), "mart", "left")
