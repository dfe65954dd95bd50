"""Score gap between late and punctual orders, and equal-width histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gap_columns(score: str = "review_score", on_time: str = "is_delivered_on_time") -> list[Column]:
    """Aggregates: average score of late and of punctual rows and the difference, as exact ratios."""
    late = F.avg(F.when(~F.col(on_time), F.col(score)))
    punctual = F.avg(F.when(F.col(on_time), F.col(score)))
    return [late.alias("late_score"), punctual.alias("ontime_score"), (punctual - late).alias("lateness_penalty")]


def gap_table(df: DataFrame, by: str) -> DataFrame:
    """Late versus punctual score within each value of ``by``; rows with an unknown flag, score or group drop out."""
    known = df.filter(F.col(by).isNotNull() & F.col("review_score").isNotNull() & F.col("is_delivered_on_time").isNotNull())
    return known.groupBy(by).agg(*gap_columns())


def histogram(counted: DataFrame, value: str, count: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last one closed; empty bins have 0.

    ``counted`` holds values with their counts and is read more than once: pass a written table.
    """
    limits = counted.agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    edges = limits.select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"),
        "_lo",
        ((F.col("_hi") - F.col("_lo")) / bins).alias("_width"),
    ).select(
        "bin",
        (F.col("_lo") + (F.col("bin") - 1) * F.col("_width")).alias("low"),
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("high"),
    )
    low = counted.select(F.min(value).cast("double")).scalar()
    high = counted.select(F.max(value).cast("double")).scalar()
    spread = high - low
    place = F.floor(bins * (F.col(value).cast("double") - low) / F.when(spread == 0, 1.0).otherwise(spread)) + 1
    filled = (
        counted.filter(F.col(value).isNotNull())
        .groupBy(F.least(place, F.lit(bins)).cast("int").alias("bin"))
        .agg(F.sum(count).alias("rows"))
    )
    return edges.join(filled, "bin", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Top-k report (TakeOrderedAndProject: each task keeps k rows)."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col("_rn") <= n).drop("_rn")


def display_sample(df: DataFrame, key: list[str], n: int, seed: int = 1) -> DataFrame:
    """Fixed-seed random sample for plots; the draw depends on the keys only, not on how the data is laid out."""
    draw = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return df.orderBy(draw, *key).limit(n)
