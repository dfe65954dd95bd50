"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A conversation is written once as marked turns. Every assistant turn becomes an example of its own: its context is the
written conversation up to that turn, and only the reply is trainable. The contexts of one conversation are prefixes of
each other, so an example holds positions in the written conversation and n turns take n texts, not n * n, however long
a conversation is. ``with_context`` explodes the examples and spells them out for a trainer; ``digests`` takes the
trainable texts from these rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: the markers of the template; an escaped text holds no bare "<" or "[", so none of them can occur in it
BEGIN, BODY, END = "<s>[ROLE]", "[TEXT]", "</s>"


def escaped(text: Column) -> Column:
    """Texts with no marker in them; NULL counts as empty. The inverse is ``unescaped``."""
    out = F.coalesce(text, F.lit(""))
    for plain, code in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b")):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescaped(text: Column) -> Column:
    """The text before ``escaped``. Escapes are taken from left to right: an escaped backslash begins no other escape."""
    pairs = F.regexp_extract_all(text, F.lit(r"(?s)\\.|[^\\]+"), F.lit(0))

    def plain(p: Column) -> Column:
        return F.when(p == "\\l", "<").when(p == "\\b", "[").when(p == "\\\\", "\\").otherwise(p)

    return F.when(F.instr(text, "\\") == 0, text).otherwise(F.array_join(F.transform(pairs, plain), ""))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, examples.

    ``examples`` has turn_no (from 0), turn_start, target_start and target_end (code points in ``formatted``) for each
    assistant turn, in order. Input rows are (conv_id, turn, role, text), ordered by turn; equal turns by role, then
    text; NULLs come first. NULL roles and texts count as empty, rows with a NULL conv_id form one conversation,
    repeated rows are turns of their own, other columns are ignored, an empty table gives no rows. A conversation
    without an assistant turn has no examples but is formatted all the same.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    piece = F.concat(F.lit(BEGIN), escaped(F.col("role")), F.lit(BODY), escaped(F.col("text")), F.lit(END))
    placed = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = placed.withColumn("piece", piece).select(
        "conv_id",
        "role",
        "piece",
        (F.row_number().over(order) - 1).alias("turn_no"),
        F.length(escaped(F.col("text"))).alias("body"),
        F.length("piece").alias("long"),
        F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("to"),
    )
    example = F.struct(
        "turn_no",
        (F.col("to") - F.col("long")).alias("turn_start"),
        (F.col("to") - len(END) - F.col("body")).alias("target_start"),
        (F.col("to") - len(END)).alias("target_end"),
    )
    pieces = F.sort_array(F.collect_list(F.struct("turn_no", "piece")))
    return placed.groupBy("conv_id").agg(
        F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("role") == "assistant", example))).alias("examples"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """The turns read back from what ``format_conversations`` wrote: conv_id, formatted, turns, replies.

    ``turns`` lists (role, text), ``replies`` the unescaped texts under the loss mask of the examples.
    """
    pieces = F.filter(F.split("formatted", END), lambda p: p != "")
    inner = lambda p: F.split(F.substr(p, F.lit(len(BEGIN) + 1)), r"\[TEXT\]", 2)
    turn = lambda p: F.struct(
        unescaped(inner(p)[0]).alias("role"), unescaped(inner(p)[1]).alias("text")
    )

    def reply(e: Column) -> Column:
        own = F.get("pieces", e["turn_no"])
        return unescaped(F.substr(own, (e["target_start"] - e["turn_start"] + 1).cast("int"), (e["target_end"] - e["target_start"]).cast("int")))

    cut = formatted.select("conv_id", "formatted", "examples", pieces.alias("pieces"))
    return cut.select(
        "conv_id", "formatted", F.transform("pieces", turn).alias("turns"), F.transform("examples", reply).alias("replies")
    )


def with_context(formatted: DataFrame) -> DataFrame:
    """One row per example with its texts: conv_id, turn_no, context (all before the reply), target (the reply, escaped)."""
    each = formatted.select("conv_id", "formatted", F.explode("examples").alias("e"))
    return each.select(
        "conv_id",
        "e.turn_no",
        F.substr("formatted", F.lit(1), F.col("e.target_start").cast("int")).alias("context"),
        F.substr("formatted", (F.col("e.target_start") + 1).cast("int"), (F.col("e.target_end") - F.col("e.target_start")).cast("int")).alias("target"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples, read back from the output.

    A conversation is a row with its turns and a row for each of its examples, and they meet by conv_id: what is under
    the loss mask is put together from the targets of the exploded examples.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    whole = read_turns(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    targets = with_context(formatted).select("conv_id", F.struct("turn_no", unescaped(F.col("target")).alias("text")).alias("example"))
    met = whole.unionByName(targets, allowMissingColumns=True).groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.max("formatted_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list("example")).alias("examples"),
    )
    met = met.withColumn("loss", F.array_join(F.transform("examples", lambda e: e["text"]), ""))
    return met.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        F.size("examples").cast("long").alias("n_examples"),
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, length(role) + length(text)
    + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')) + length('<s>[ROLE][TEXT]</s>') AS long
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(long)::BIGINT AS formatted_chars,
  count(*) FILTER (WHERE role = 'assistant') AS n_examples
FROM m GROUP BY conv_id
"""
