"""Packing by shortest-pack-first over the length histogram.

Each document is encoded in a task, ends with one end id and is cut at multiples of the sequence length, so all pieces
but its last fill a sequence. Only the histogram of the last pieces, one count per length from 1 to 2048, reaches the
driver. There whole counts are placed, longest length first, each into the fullest open pattern it fits, and patterns
(lists of lengths with a count) come out. Pieces of one length are numbered over all tasks, and a range of these
numbers is joined to a slot of a pattern: no piece is ever sorted or gathered with others of its length.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.session import write_out

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long, part string"
MEMO = 400_000  # remembered words of a Python worker; a full memo is emptied
# fixed value: white space of the pattern below (Unicode White_Space)
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG = 1000  # a longer run of white space is cut without the pattern, which goes back over a run character by character


def byte_level_encoding(tokenizer_json: str):
    """A tiktoken encoding with the vocabulary, pattern and special strings of a byte-level BPE file."""
    import tiktoken

    made = json.loads(tokenizer_json)
    special = {t["content"]: t["id"] for t in made["added_tokens"]}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    as_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(as_byte[c] for c in token): i for token, i in made["model"]["vocab"].items() if token not in special}
    # fixed value: the pre-tokenizer's pattern, which the file names only as "use_regex"
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


class WordCoder:
    """Ids of a text as little-endian unsigned 32-bit bytes; words seen before are looked up.

    A single space between two other characters always begins a new pre-token, so the text is cut there. A text with a
    special string, or with a space next to other white space, is cut more carefully. Of a long run of white space all
    but the last character are one pre-token, and all of them at the end of a text.
    """

    def __init__(self, tokenizer_json: str):
        self.bpe = byte_level_encoding(tokenizer_json)
        self.special = list(self.bpe.special_tokens_set)
        self.memo: dict[str, bytes] = {}
        self.near_space = re.compile(r"^ | $|\s | \s")
        self.lone_space = re.compile(r"(?<=\S) (?=\S)")
        self.long_space = re.compile(f"[{SPACE}]{{{LONG},}}")
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def encode(self, text: str) -> bytes:
        if len(text) >= LONG and self.long_space.search(text):
            parts = self.cut_special.split(text) if self.cut_special else [text]
            return b"".join([self._exactly(p) if i % 2 else self._long_runs(p) for i, p in enumerate(parts)])
        return self._cut(text)

    def _long_runs(self, text: str) -> bytes:
        """Ids of a text without special strings."""
        out, at = [], 0
        for run in self.long_space.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += [self._cut(text[at : run.start()]), self._bytes(self.bpe._encode_single_piece(text[run.start() : end]))]
            at = end
        return b"".join([*out, self._cut(text[at:])])

    def _cut(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self._exactly(text)
        parts = (self.lone_space.split if self.near_space.search(text) else lambda t: t.split(" "))(text)
        memo, first = self.memo, parts[0]
        out = [self._exactly(first)] if first else []
        for part in parts[1:]:
            known = memo.get(part)
            if known is None:
                if len(memo) >= MEMO:
                    memo.clear()
                known = memo[part] = self._exactly(" " + part)
            out.append(known)
        return b"".join(out)

    def _exactly(self, text: str) -> bytes:
        return self._bytes(self.bpe.encode(text, allowed_special="all"))

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in ids])


_coders: dict[int, WordCoder] = {}


def pieces(docs: DataFrame, tokenizer_json: str, size: int, end_id: int, by: str | None = None) -> DataFrame:
    """One row per piece with its number among the pieces of its part (value of ``by``) and length in the same task."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary file, about 2 MB
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value)
        coder = _coders.get(key) or _coders.setdefault(key, WordCoder(shared.value))
        task, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows: list[list] = [[] for _ in range(8)]
            for doc_id, text, part in zip(batch["doc_id"].to_pylist(), batch["text"], batch["part"].to_pylist(), strict=True):
                ids = coder.encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, size):
                    own = ids[4 * start : 4 * (start + size)]
                    n = len(own) // 4
                    for column, value in zip(rows, (doc_id, start, n, zlib.crc32(own), total, task, seen[part, n], part), strict=True):
                        column.append(value)
                    seen[part, n] += 1
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.string()]
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

    part = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
    return docs.select(F.col("doc_id").cast("long"), "text", part.alias("part")).mapInArrow(cut, PIECES)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths that share a sequence, longest first) with their counts, from length -> count.

    Lengths are taken from the longest. Each goes to the shortest open pattern, the one with most room, a whole count
    at a time; when fewer pieces are left than the pattern has copies, the rest of the copies stay as they were. A new
    pattern is opened only when no open one has room. At most one pattern is split for a length, so there are at most
    about three patterns per length, however many pieces there are.
    """
    by_room: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(size + 1)]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for room in range(size - 1, length - 1, -1):
            while left and by_room[room]:
                pattern, copies = by_room[room].pop()
                used = min(copies, left)
                by_room[room - length].append(((*pattern, length), used))
                left -= used
                if used < copies:
                    by_room[room].append((pattern, copies - used))
        each = size // length
        for n, copies in ((each, left // each), (left % each, 1)):
            if n and copies:
                by_room[size - n * length].append(((length,) * n, copies))
    return [entry for entries in by_room for entry in entries]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, behind the last rank, sequence of the first rank, offset) for each slot of each pattern."""
    placed: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, copies in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, placed[length], placed[length] + copies, sequence, offset))
            placed[length] += copies
            offset += length
        sequence += copies
    return rows


def pack(docs: DataFrame, tokenizer_json: str, size: int = 2048, end_id: int = 1, by: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``by`` if it is given.

    Sequences are numbered from 0 without gaps; a trainer pads each to ``size``, except where its length is a power of
    two. NULL and empty texts are one end id. Rows with a NULL or a repeated doc_id are packed like any other, other
    columns are ignored, an empty table gives no rows. Which of two pieces of one length comes first depends on the
    order of tasks and rows, nothing else does. A sequence holds documents of one value of the column ``by`` only, which
    should have few; NULL counts as empty text.
    """
    spark = docs.sparkSession
    cut = write_out(pieces(docs, tokenizer_json, size, end_id, by), "packing-pieces")
    per_task = cut.groupBy("part", "length", "task").agg((F.max("nth") + 1).alias("n"))
    order = Window.partitionBy("part", "length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = write_out(per_task.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))), "packing-bases")
    histograms: dict[str, dict[int, int]] = defaultdict(dict)
    for r in bases.groupBy("part", "length").agg(F.sum("n").alias("n")).collect():  # <= size rows for each part
        histograms[r["part"]][r["length"]] = r["n"]
    placed = []
    begun = 0  # sequences of the parts before
    for part, histogram in sorted(histograms.items()):
        patterns = shortest_pack_first(histogram, size)
        placed += [(part, length, low, high, begun + sequence, offset) for length, low, high, sequence, offset in slots(patterns)]
        begun += sum(copies for _, copies in patterns)
    placed = spark.createDataFrame(placed, "part string, length long, low long, high long, sequence long, offset long")
    # ranks grow with the tasks: they are merged in, not broadcast; a key holds pieces of one task
    ranked = cut.join(bases.drop("n").hint("merge"), ["part", "length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    same = (ranked["part"] == placed["part"]) & (ranked["length"] == placed["length"])
    inside = same & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    # slots depend on the sequence length and the parts, not on the number of documents
    return ranked.join(F.broadcast(placed), inside).select(
        "doc_id",
        "start",
        ranked["length"],
        "ids_crc32",
        "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"),
        "offset",
        *([ranked["part"].alias(by)] if by else []),
    )
