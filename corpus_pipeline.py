"""The corpus pipeline: language ID, exact dedup, near dedup, substring dedup, packing.

Each stage but the last returns documents with the columns of its input. ``run`` writes what a stage returns and hands
the next one a scan of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm import bottom_k, byte_gru, chunk_recipes, pattern_packing, recompression
from bazaarlens.llm.queries import vocabulary
from bazaarlens.llm.shipping import ship
from bazaarlens.session import write_out

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id, which may be NULL, is among the kept ones."""
    return docs.join(kept.withColumnRenamed("doc_id", "kept_id"), F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; texts that are NULL or have no letter go. ``lang`` becomes the language told
    from the text, by which packing deals documents to sequences. Documents without a column ``lang`` have nothing to
    learn from: then only texts without a letter go."""
    ship(spark)
    return byte_gru.accepted(docs, byte_gru.fit(docs), relabel=True)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space; of rows that repeat it one stays."""
    kept = write_out(chunk_recipes.dedup(docs).where("kept").select("doc_id", "text_sha256"), "kept-texts")
    wanted = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha256"))
    own = docs.withColumn("own_sha256", F.sha2(chunk_recipes.normalised(F.col("text")), 256))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("own_sha256") == F.col("kept_sha256"))
    rest = own.join(wanted.distinct(), same, "left_semi")
    # rows that repeat a doc_id and a text: the one with the longest text stays
    repeated = kept.groupBy("doc_id", "text_sha256").count().where("count > 1").drop("count")
    if repeated.isEmpty():
        return rest.drop("own_sha256")
    twice = repeated.select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha256"))
    few = rest.join(twice, same, "left_semi")
    place = Window.partitionBy("doc_id", "own_sha256").orderBy(F.desc(F.length(F.coalesce("text", F.lit("")))), F.col("text").desc_nulls_last())
    again = few.withColumn("own_place", F.row_number().over(place)).where("own_place = 1").drop("own_place")
    return rest.join(twice, same, "left_anti").unionByName(again).drop("own_sha256")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near copies."""
    ship(spark)
    return _only(docs, bottom_k.near_dedup(docs).where("kept").select("doc_id").distinct())


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of windows that a document with a smaller doc_id has; n_chars follows the text."""
    ship(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    out = recompression.remove_repeats(docs, carry=others, layout=True)
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[made.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids, each of documents of one language where language ID has told it."""
    ship(spark)
    return pattern_packing.pack(docs, vocabulary("byte_bpe_50k.json"), by="lang" if "lang" in docs.columns else None)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]

#: SQL can't run the network or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
