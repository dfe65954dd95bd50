"""Exact dedup by content-defined chunk recipes.

A text without its white space is cut where its own characters say so, and each distinct chunk is known by a
fingerprint that is verified once over the whole corpus: the smallest and the largest text behind a fingerprint must be
the same, else every chunk behind it is spelled out in full. A document is then the ordered list of its chunk
identifiers, and equal documents are equal lists. Chunk texts move once, reduced to one per task before the shuffle;
what is grouped and joined afterwards is identifiers. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import prefer_skew_handling, write_out

WHITE = " \t\n\u000b\f\r"


def normalised(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def chunked(text: Column, least: int, most: int) -> Column:
    """Chunks of ``least`` to ``most`` characters that end behind one of a few pairs of characters.

    A boundary depends on nothing but the characters near it, so a shift upstream moves no later boundary for long.
    About one place in a few hundred is a boundary in running text.
    """
    pattern = rf"(?s).{{{least},{most}}}?(?:[aeiou][.,;:!?]|$)|.{{{most}}}|.+"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 256, most: int = 4096
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the most code points in the original text, then with the smallest doc_id, stays. NULL and empty texts
    form one group. A NULL doc_id is never preferred to a known one of equal length, and a row with one is kept only
    when its whole group has none. Rows that repeat a doc_id count as rows of their group; if such a row stays, all
    rows with this doc_id and text are marked kept. An empty table gives an empty result; other columns are ignored.
    """
    prefer_skew_handling(docs.sparkSession)
    plain = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.length(F.col(text)), F.lit(0)).cast("long").alias("points"),
        normalised(F.col(text)).alias("norm"),
    )
    cut = plain.withColumn("chunk_list", chunked("norm", least, most))
    chunks = cut.select(F.explode("chunk_list").alias("chunk"))
    known = chunks.groupBy(F.unhex(F.md5("chunk")).alias("print")).agg(
        F.min("chunk").alias("low"), F.max("chunk").alias("high")
    )
    # fingerprints that stand for more than one text: none, unless somebody builds such texts
    clashing = known.where("low <> high").select("print")
    recipes = write_out(
        cut.select(
            "doc_id",
            "points",
            F.sha2("norm", 256).alias("text_sha256"),
            F.transform("chunk_list", lambda c: F.unhex(F.md5(c))).alias("recipe"),
        ),
        "chunk-recipes",
    )
    if not clashing.isEmpty():
        recipes = _spelled_out(cut, clashing)
    groups = recipes.groupBy("recipe").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id"))["doc_id"].alias("keep_id"),
    )
    # written, so that the join has exchanges of its own and a list that many documents share can be split
    shared = write_out(groups.where("group_size > 1"), "chunk-groups")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return recipes.join(shared, "recipe", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def _spelled_out(cut: DataFrame, clashing: DataFrame) -> DataFrame:
    """Recipes in which a chunk behind a clashing fingerprint carries its own text."""
    numbered = cut.withColumn("row_no", F.monotonically_increasing_id())  # before the rows multiply
    at = numbered.select(
        "doc_id",
        "points",
        F.sha2("norm", 256).alias("text_sha256"),
        "row_no",
        F.posexplode_outer("chunk_list").alias("place", "chunk"),
    )
    at = write_out(at, "chunk-places")
    marked = at.withColumn("print", F.unhex(F.md5("chunk"))).join(clashing.withColumn("clash", F.lit(True)), "print", "left")
    name = F.when(F.col("clash"), F.concat("print", F.col("chunk").cast("binary"))).otherwise(F.col("print"))
    listed = marked.groupBy("row_no", "doc_id", "points", "text_sha256").agg(
        F.sort_array(F.collect_list(F.struct("place", name.alias("name")))).alias("places")
    )
    named = F.transform(F.filter("places", lambda p: p["name"].isNotNull()), lambda p: p["name"])
    return listed.select("doc_id", "points", "text_sha256", named.alias("recipe"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT norm, count(*) AS group_size, arg_min(doc_id, (-points, doc_id)) AS keep_id FROM t GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
