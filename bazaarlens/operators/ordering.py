"""Ranks, running sums, buckets and medians over a whole table, without a single-task window.

``order_globally`` range-partitions on the full sort key (which must end in a unique column, so equal values still
split), sorts each range and numbers its rows, and writes the outcome once. The write matters: range bounds are
sampled, and a recomputed stage could draw other bounds between two passes. What crosses to every task afterwards is
one small row per range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import EXACT, percent
from bazaarlens.session import write_out

# monotonically_increasing_id keeps the partition number above bit 33 and the row number inside it below
ROW_BITS = 33


@dataclass(frozen=True)
class Ordered:
    """A written table in global order; ``_slot`` is the range, ``_pos`` the row number within it (from 0)."""

    rows: DataFrame

    def _ranges(self, value: str | None = None) -> DataFrame:
        """Per range: rows and value before it, plus the totals. One row per range, at most as many as shuffle
        partitions, which also bounds the windows below and makes the broadcast safe."""
        parts = self.rows.groupBy("_slot").agg(
            F.count(F.lit(1)).alias("_rows"),
            (F.sum(value) if value else F.lit(0)).cast(EXACT).alias("_value"),
        )
        before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        everything = Window.partitionBy()
        return parts.select(
            "_slot",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_value").over(before), F.lit(0)).cast(EXACT).alias("_value_before"),
            F.sum("_rows").over(everything).alias("n_rows"),
            F.sum("_value").over(everything).cast(EXACT).alias("grand_total"),
        )

    def ranked(self) -> DataFrame:
        """Adds ``rank`` (from 1) and ``n_rows``."""
        return (
            self.rows.join(F.broadcast(self._ranges()), "_slot")
            .withColumn("rank", F.col("_rows_before") + F.col("_pos") + 1)
            .drop("_slot", "_pos", "_rows_before", "_value_before", "grand_total")
        )

    def running(self, value: str) -> DataFrame:
        """Adds ``rank``, ``n_rows``, ``running_value`` and ``grand_total``; the windows stay inside one range."""
        within = Window.partitionBy("_slot").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
        local = self.rows.withColumn("_local", F.sum(value).over(within).cast(EXACT))
        return (
            local.join(F.broadcast(self._ranges(value)), "_slot")
            .withColumn("rank", F.col("_rows_before") + F.col("_pos") + 1)
            .withColumn("running_value", (F.col("_value_before") + F.col("_local")).cast(EXACT))
            .drop("_slot", "_pos", "_local", "_rows_before", "_value_before")
        )


def order_globally(df: DataFrame, order: list[Column], label: str = "ordered") -> Ordered:
    """``order`` must end in a unique column."""
    lined_up = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = lined_up.withColumn("_id", F.monotonically_increasing_id())
    placed = numbered.withColumn("_slot", F.shiftright("_id", ROW_BITS)).withColumn(
        "_pos", F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    )
    return Ordered(write_out(placed.drop("_id"), label))


def global_rank(df: DataFrame, order: list[Column]) -> DataFrame:
    return order_globally(df, order).ranked()


def global_running_sum(df: DataFrame, order: list[Column], value: str) -> DataFrame:
    return order_globally(df, order).running(value)


def quantile_bucket(rank: Column, n: Column, k: int) -> Column:
    """Bucket of k equal-width quantile groups over ranks 1..n (linear-interpolation edges, right-closed)."""
    n, rank = n.cast("bigint"), rank.cast("bigint")
    spot = F.floor((F.lit(k) * (rank - 1) + n - 2) / F.greatest(n - 1, F.lit(1)))
    return F.when(n == 1, 1).otherwise(F.greatest(F.lit(1), spot)).cast("int")


def ntile_bucket(rank: Column, n: Column, k: int) -> Column:
    """Bucket of ntile(k): the first n mod k groups hold one row more."""
    n, rank = n.cast("bigint"), rank.cast("bigint")
    small, larger_groups = F.floor(n / k), n % k
    in_larger = larger_groups * (small + 1)
    return (
        F.when(rank <= in_larger, F.floor((rank - 1) / (small + 1)) + 1)
        .otherwise(F.floor((rank - 1 - in_larger) / F.greatest(small, F.lit(1))) + 1 + larger_groups)
        .cast("int")
    )


def global_median(df: DataFrame, value: str, key: str) -> DataFrame:
    """Exact median of a column with unboundedly many values: one row ``n_rows, median``; NULLs are left out."""
    known = df.select(value, key).filter(F.col(value).isNotNull())
    ranked = global_rank(known, [F.asc(value), F.asc(key)])
    middle = ranked.filter((2 * F.col("rank")).between(F.col("n_rows"), F.col("n_rows") + 2))
    return middle.agg(F.max("n_rows").alias("n_rows"), F.avg(value).alias("median"))


def pct_change(df: DataFrame, order_col: str, value: str, name: str) -> DataFrame:
    """Percent change against the previous row, NULL on the first row and after a zero.

    Meant for aggregated periods: the unpartitioned window sees one row per month or quarter.
    """
    previous = F.lag(value).over(Window.orderBy(order_col))
    return df.withColumn(name, percent(F.col(value) - previous, previous))


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percentage of the column total, for aggregated rows of a bounded domain (states, categories, statuses)."""
    return df.withColumn(name, percent(F.col(value), F.sum(value).over(Window.partitionBy())))
