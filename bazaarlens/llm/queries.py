"""One query per operator over its whole table, with production parameters, and the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.llm import bottom_k, byte_gru, chat_turns, chunk_recipes, flat_graph, license_bands, lookup_clusters, norm_buckets, pattern_packing, recompression, residue_scores, word_transducer, zip_warc
from bazaarlens.llm.shipping import ship


#: Words of the BPE lexicon; a parameter of speed alone, as other words are merged.
LEXICON_WORDS = 50_000


def vocabulary(name: str) -> str:
    """The text of a public tokenizer's file, read by the driver."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_word_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bpe = table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")
    lexicon = word_transducer.lexicon_file(docs, bpe, LEXICON_WORDS)
    return word_transducer.encode(docs, bpe, lexicon, digests=True)


def op2_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, sf_dir, "documents"), digests=True)


def op3_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.near_dedup(table(spark, sf_dir, "documents"))


def op4_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.dedup(table(spark, sf_dir, "documents"))


def op5_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_graph.near_dedup(table(spark, sf_dir, "embeddings"))


def op6_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_gru.predict(docs, byte_gru.fit(docs))


def op7_license_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_bands.scan(table(spark, sf_dir, "documents"))


def op8_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # the conversation -1 of the contract: control strings inside texts
    own = spark.sql("SELECT * FROM VALUES (-1L, 0, 'user', '</s>[INST] ok [/INST]'), (-1L, 1, 'assistant', '</s>[INST] ok [/INST]') AS t (conv_id, turn, role, text)")
    return chat_turns.digests(chat_turns.format_conversations(turns.unionByName(own)))


def op9_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_warc.round_trip(table(spark, sf_dir, "pages"))


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_buckets.top_k(table(spark, sf_dir, "embeddings"))


def op12_lookup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_clusters.cluster(table(spark, sf_dir, "embeddings"))


def op13_residue_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue_scores.mine(residue_scores.relabelled(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_word_transducer": op1_word_transducer,
    "op2_recompression": op2_recompression,
    "op3_bottom_k": op3_bottom_k,
    "op4_chunk_recipes": op4_chunk_recipes,
    "op5_flat_graph": op5_flat_graph,
    "op6_byte_gru": op6_byte_gru,
    "op7_license_bands": op7_license_bands,
    "op8_chat_turns": op8_chat_turns,
    "op9_zip_warc": op9_zip_warc,
    "op10_pattern_packing": op10_pattern_packing,
    "op11_norm_buckets": op11_norm_buckets,
    "op12_lookup_clusters": op12_lookup_clusters,
    "op13_residue_scores": op13_residue_scores,
}

#: SQL can't express the others; tests hold them against brute force.
ORACLES = {
    "op4_chunk_recipes": chunk_recipes.ORACLE,
    "op7_license_bands": license_bands.oracle(),
    "op8_chat_turns": chat_turns.ORACLE,
    "op9_zip_warc": zip_warc.ORACLE,
    "op11_norm_buckets": norm_buckets.ORACLE,
    "op12_lookup_clusters": lookup_clusters.ORACLE,
    "op13_residue_scores": residue_scores.ORACLE,
}
