"""Choosing one row per key without ever gathering the key's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column], rows: int = 1) -> DataFrame:
    """First ``rows`` rows of each key in the given order.

    A filter on row_number lets Catalyst place a group limit below the shuffle, so each task sends at most ``rows``
    rows per key, however hot the key is.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") <= rows).drop("_rn")


def least_row(df: DataFrame, key: str, order: list[Column], extra: list[Column] | None = None) -> DataFrame:
    """The row of each key whose ``order`` tuple is smallest, ties settled by the remaining columns.

    Same answer as keep_first, but as a minimum over structs: partially aggregated before the shuffle, and Catalyst
    knows the key is unique afterwards, so a left join to it is dropped where none of its columns is read. ``extra``
    holds further aggregates over the key's rows.
    """
    payload = [c for c in df.columns if c != key]
    sort_names = [f"_o{i}" for i in range(len(order))]
    row = F.struct(*[o.alias(n) for o, n in zip(order, sort_names)], *payload)
    best = df.groupBy(key).agg(F.min(row).alias("_row"), *(extra or []))
    kept = [c for c in best.columns if c not in (key, "_row")]
    return best.select(key, *[F.col("_row")[c].alias(c) for c in payload], *kept)
