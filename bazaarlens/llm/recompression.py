"""Substring dedup by recompression.

A window is ``WINDOW`` consecutive words. Words get numbers, and in each of two rounds all texts are rewritten alike:
runs of one symbol become one symbol, then each pair of a left symbol and a right symbol does, left and right being a
bit of the symbol's name. A name is a 64-bit fingerprint of what it stands for, so every task of the cluster gives the
same name to the same run or pair without asking, and equal stretches of words get equal symbols except near their ends:
``reach`` of a symbol is the stretch of words that decides it. A window of 13 words always holds the reach of a symbol,
if no word repeats right behind itself; it is filed under one of those, the one with the least hashed name. Windows
that hold none are filed under themselves.

1. Consecutive windows filed under one symbol occurrence form a span. Its (reach, span) fingerprints go to a bucket by
   reach; a task sends each (reach, span) once, with the least document it has for it.
2. A bucket tells each document which of its spans also stand in a smaller document: these are repeats as a whole. Where
   one reach stands in different spans, one document for each span is asked for the single windows.
3. Those windows are compared by 128-bit fingerprints in the same way, and what they cover goes too.

Buckets hold packed arrays, and answers go back packed, so that rows don't multiply; the number of buckets follows
``spark.sql.shuffle.partitions``. No step collects the occurrences of a passage: after the first step it is one entry a
task, however many documents share it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm.words import U, Words, combine, mix, parts
from bazaarlens.session import prefer_skew_handling, write_out

WINDOW = 13
ROUNDS = 2  # the most after which a window of 13 different words must hold a symbol's reach


class Symbols:
    """Symbols of many texts after some rounds; positions count words of the batch."""

    def __init__(self, numbers: np.ndarray, owner: np.ndarray):
        n = np.arange(len(numbers))
        self.name, self.owner = numbers, owner
        self.start, self.end = n, n + 1
        self.low, self.high = n, n + 1  # the reach

    def round(self, salt: int) -> None:
        """Name all runs, then all left-right pairs."""
        if not len(self.name):
            return
        same_text = self.owner[1:] == self.owner[:-1]
        first = np.flatnonzero(np.r_[True, (self.name[1:] != self.name[:-1]) | ~same_text])
        last = np.r_[first[1:], len(self.name)] - 1
        base, owner, long = self.name[first], self.owner[first], last - first + 1
        run = np.where(long > 1, combine(base, long.astype(U)), base)
        start, end = self.start[first], self.end[last]
        # a run ends where its neighbours differ: they belong to its reach, and so does the edge of the text
        inner = np.r_[False, owner[1:] == owner[:-1]]
        low = np.where(inner, self.low[np.maximum(first - 1, 0)], start - 1)
        inner = np.r_[owner[1:] == owner[:-1], False]
        high = np.where(inner, self.high[np.minimum(last + 1, len(self.high) - 1)], end + 1)

        right = (mix(base ^ U(salt)) & U(1)).astype(bool)
        pair = np.r_[~right[:-1] & right[1:] & (owner[1:] == owner[:-1]), False]
        keep = ~np.r_[False, pair[:-1]]
        to = np.arange(len(run)) + pair
        self.name = np.where(pair, combine(run, run[np.minimum(to, len(run) - 1)]), run)[keep]
        self.owner, self.start, self.low = owner[keep], start[keep], low[keep]
        self.end, self.high = end[to][keep], high[to][keep]


class Stretches:
    """Fingerprints of stretches of words: of 1, 2, 4, ... words by combining halves, of others by two that cover them."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        size, out = high - low, np.zeros(len(low), U)
        names, width, longest = self.numbers, 1, int(size.max(initial=0))
        while width <= longest:
            own = np.flatnonzero((size >= width) & (size < 2 * width))
            covers = combine(names[low[own]], names[high[own] - width])
            out[own] = combine(covers, size[own].astype(U))
            names = combine(names[:-width], names[width:])
            width *= 2
        return out


class Spans:
    """All windows of a batch of texts, filed; ``reach`` and ``span`` are the fingerprints of each span."""

    def __init__(self, words: Words):
        numbers, owner = words.numbers(), words.owners()
        self.words = words
        left = np.repeat(words.first + words.counts, words.counts) - np.arange(len(numbers))
        at = np.flatnonzero(left >= WINDOW)  # where windows begin
        symbols = Symbols(numbers, owner)
        for k in range(ROUNDS):
            symbols.round(0x5851F42D4C957F2D * (k + 1) % (1 << 64))
        self.first, self.second = Stretches(numbers), Stretches(words.numbers(seed=2))
        anchor = self._anchors(symbols, at)
        cut = np.r_[True, (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (owner[at[1:]] != owner[at[:-1]])][: len(at)]
        begin = np.flatnonzero(cut)
        end = np.r_[begin[1:], len(at)][: len(begin)]
        self.begin, self.end = at[begin], at[end - 1] + 1  # windows begin in [begin, end)
        of = anchor[begin]
        low = np.where(of >= 0, symbols.low[of] if len(symbols.low) else 0, self.begin)
        high = np.where(of >= 0, symbols.high[of] if len(symbols.high) else 0, self.begin + WINDOW)
        self.reach = self.first.of(low, high)
        self.span = self.second.of(self.begin, self.end + WINDOW - 1)
        self.owner = owner[self.begin]
        self.mark = combine(self.reach, self.span)

    @staticmethod
    def _anchors(symbols: Symbols, at: np.ndarray) -> np.ndarray:
        """For each window the symbol with the least hashed name (the first of equals) whose reach it holds; -1: none."""
        if not len(symbols.name) or not len(at):
            return np.full(len(at), -1)
        low = np.searchsorted(symbols.low, at, "left")
        high = np.searchsorted(symbols.high, at + WINDOW, "right")
        count = high - low
        rank = mix(symbols.name)
        best = [np.arange(len(rank))]
        for k in range(4):  # a window holds at most 13 symbols
            one = best[-1]
            two = np.r_[one[1 << k :], np.full(min(1 << k, len(one)), len(rank) - 1)]
            best.append(np.where(rank[one] <= rank[two], one, two))
        out = np.full(len(at), -1)
        for k in range(4):
            own = np.flatnonzero((count >= 1 << k) & (count < 2 << k))
            one, two = best[k][low[own]], best[k][high[own] - (1 << k)]
            out[own] = np.where(rank[one] <= rank[two], one, two)
        return out

    def windows(self, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and both fingerprints of each window of the given spans."""
        size = self.end[spans] - self.begin[spans]
        at = np.repeat(self.begin[spans] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return at, self.first.of(at, at + WINDOW), self.second.of(at, at + WINDOW)


def _member(owner: np.ndarray, mark: np.ndarray, told: list[bytes | None]) -> np.ndarray:
    """Whether each mark is among those told to its text."""
    lists = [np.frombuffer(t or b"", U) for t in told]
    keys = np.concatenate([*lists, np.zeros(0, U)])
    if not len(keys):
        return np.zeros(len(mark), bool)
    texts = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return np.isin(combine(mark, owner.astype(U)), combine(keys, texts.astype(U)))


_ENTRIES = "bucket int, part long, docs binary, first binary, second binary"
_ANSWERS = "part long, docs binary, marks binary, ask boolean"


def _entries(buckets: int, part: int, docs: np.ndarray, first: np.ndarray, second: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket and part: packed entries. The least document of equal entries stands for the part; the
    others are answered at once, in a row of a bucket below 0."""
    mark = combine(first, second)
    order = np.lexsort((docs, mark))
    docs, first, second, mark = docs[order], first[order], second[order], mark[order]
    new = np.r_[True, mark[1:] != mark[:-1]][: len(mark)]
    least = docs[np.flatnonzero(new)][np.cumsum(new) - 1] if len(mark) else docs
    late = docs > least
    rows = [(-1 - part % buckets, part, docs[late].tobytes(), mark[late].tobytes(), b"")] if late.any() else []
    docs, first, second = docs[new], first[new], second[new]
    place = ((first >> U(20)) % U(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    bounds = np.searchsorted(place[order], np.arange(buckets + 1))
    docs, first, second = docs[order], first[order], second[order]
    for bucket in np.flatnonzero(np.diff(bounds)).tolist():
        a, b = bounds[bucket], bounds[bucket + 1]
        rows.append((bucket, part, docs[a:b].tobytes(), first[a:b].tobytes(), second[a:b].tobytes()))
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    names = ["bucket", "part", "docs", "first", "second"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _compared(whole: bool):
    """What a bucket answers to each part. ``whole``: also which spans are to be compared by windows (``ask``)."""

    def bucket(table: pa.Table) -> pa.Table:
        part, docs, first, second = (table[c].to_pylist() for c in ("part", "docs", "first", "second"))
        if table["bucket"][0].as_py() < 0:
            rows = [(p, d, f, False) for p, d, f in zip(part, docs, first, strict=True)]
        else:
            sizes = [len(d) // 8 for d in docs]
            owner = np.repeat(np.arange(len(part)), sizes)
            doc = np.frombuffer(b"".join(docs), np.int64)
            one, two = np.frombuffer(b"".join(first), U), np.frombuffer(b"".join(second), U)
            order = np.argsort(one, kind="stable")
            same = one[order][1:] == one[order][:-1]
            order = order[np.r_[False, same][: len(order)] | np.r_[same, False][: len(order)]]  # met more than once
            order = order[np.lexsort((doc[order], two[order], one[order]))]
            owner, doc, one, two = owner[order], doc[order], one[order], two[order]
            new_one = np.r_[True, one[1:] != one[:-1]][: len(one)]
            new = new_one | np.r_[True, two[1:] != two[:-1]][: len(one)]
            at, at_one = np.flatnonzero(new), np.flatnonzero(new_one)
            least = doc[at][np.cumsum(new) - 1] if len(one) else doc
            late = doc > least
            rows = _told(part, owner[late], doc[late], combine(one[late], two[late]), False)
            if whole and len(one):
                kinds = np.add.reduceat(new.astype(np.int64), at_one)
                several = kinds > 1
                several &= np.minimum.reduceat(doc, at_one) != np.maximum.reduceat(doc, at_one)
                asked = np.repeat(several, np.diff(np.r_[at_one, len(one)])) & (doc == least)
                rows += _told(part, owner[asked], doc[asked], combine(one[asked], two[asked]), True)
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "docs", "marks", "ask"])

    return bucket


def _told(part: list[int], owner: np.ndarray, doc: np.ndarray, mark: np.ndarray, ask: bool) -> list[tuple]:
    order = np.argsort(owner, kind="stable")
    owner, doc, mark = owner[order], doc[order], mark[order]
    cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(owner)])
    ends = np.r_[cut[1:], len(owner)]
    return [(part[owner[a]], doc[a:b].tobytes(), mark[a:b].tobytes(), ask) for a, b in zip(cut.tolist(), ends.tolist(), strict=False)]


def _by_document(table: pa.Table) -> pa.Table:
    """A part's answers, one row for each document: doc_id, marks, asked."""
    found: dict[bool, list] = {}
    for ask in (False, True):
        own = table.filter(pa.compute.equal(table["ask"], ask))
        doc = np.frombuffer(b"".join(own["docs"].to_pylist()), np.int64)
        mark = np.frombuffer(b"".join(own["marks"].to_pylist()), U)
        order = np.argsort(doc, kind="stable")
        found[ask] = [doc[order], mark[order]]
    ids = np.union1d(found[False][0], found[True][0])
    columns = [pa.array(ids, pa.int64())]
    for ask in (False, True):
        doc, mark = found[ask]
        a, b = np.searchsorted(doc, ids, "left").tolist(), np.searchsorted(doc, ids, "right").tolist()
        columns.append(pa.array([mark[x:y].tobytes() for x, y in zip(a, b, strict=True)], pa.binary()))
    return pa.Table.from_arrays(columns, ["doc_id", "marks", "asked"])


def _answers(entries: DataFrame, whole: bool, label: str) -> DataFrame:
    """One row for each document with an answer: doc_id, marks and asked (lists of packed marks)."""
    told = entries.groupBy("bucket").applyInArrow(_compared(whole), _ANSWERS)
    per_doc = told.groupBy("part").applyInArrow(_by_document, "doc_id long, marks binary, asked binary")
    return write_out(per_doc.groupBy("doc_id").agg(F.collect_list("marks").alias("marks"), F.collect_list("asked").alias("asked")), label)


def _part_no(n: int) -> int:
    return TaskContext.get().partitionId() << 32 | n


def remove_repeats(docs: DataFrame, digests: bool = False, carry: list[str] | None = None, layout: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, and kept; with ``digests`` kept_sha256 in place of it.

    ``carry`` names columns that come along, as one struct ``carried``. With ``layout`` a text that loses nothing keeps
    its white space.

    A word goes when a window covers it whose words also stand, in this order, in a document with a smaller doc_id;
    ``kept`` joins the others by one space. NULL and empty texts have no words. A row with a NULL doc_id loses nothing
    and is no source. Rows that repeat a doc_id are one document to each other, so neither removes from the other.
    Texts of fewer than 13 words lose nothing. Other columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    prefer_skew_handling(spark)
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long"), "text", *([F.struct(*carry).alias("carried")] if carry else []))
    also = [docs.schema["carried"]] if carry else []

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for part in parts(batch):
                own = Spans(Words(part["text"]))
                ids = np.asarray(part["doc_id"])[own.owner]
                yield _entries(buckets, _part_no(n), ids, own.reach, own.span)
                n += 1

    known = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    told = _answers(known.mapInArrow(spans, _ENTRIES), True, "repeat-spans")
    kept = "kept_sha256" if digests else "kept"
    last = T.StructType.fromDDL(f"doc_id long, n_words long, n_removed long, {kept} string")
    state = T.StructType([*last, *also, *T.StructType.fromDDL("text string, marks binary")])

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows without a question are done; the others keep their text and what is known."""
        for batch in batches:
            for part in parts(batch):
                marks, asked = (_joined(part[c]) for c in ("marks", "asked"))
                yield _result(part, marks, [None] * len(marks), digests, layout, asked)

    first = write_out(docs.join(told, "doc_id", "left").mapInArrow(settled, state), "repeats-settled")
    open_rows = first.where("text is not null").select("doc_id", "text", "marks", F.col(kept).alias("asked"), *[a.name for a in also])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for part in parts(batch):
                own = Spans(Words(part["text"]))
                asked = [bytes.fromhex(a) for a in part["asked"].to_pylist()]
                hit = np.flatnonzero(_member(own.owner, own.mark, asked))
                at, one, two = own.windows(hit)
                ids = np.asarray(part["doc_id"])[np.repeat(own.owner[hit], own.end[hit] - own.begin[hit])]
                yield _entries(buckets, _part_no(n), ids, one, two)
                n += 1

    told = _answers(open_rows.select("doc_id", "text", "asked").mapInArrow(windows, _ENTRIES), False, "repeat-windows")
    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                own = _result(part, part["marks"].to_pylist(), _joined(part["windows"]), digests, layout, None)
                yield own.select(own.schema.names[:-2])

    rest = open_rows.join(told.select("doc_id", F.col("marks").alias("windows")), "doc_id", "left").drop("asked").mapInArrow(finished, T.StructType([*last, *also]))
    return first.where("text is null").drop("text", "marks").unionByName(rest)


def _joined(column: pa.Array) -> list[bytes]:
    return [b"".join(x or []) for x in column.to_pylist()]


def _result(
    part: pa.RecordBatch, marks: list[bytes], windows: list[bytes | None], digests: bool, layout: bool, asked: list[bytes] | None
) -> pa.RecordBatch:
    """Counts and kept words of each text; of one that is asked for windows, the text, its marks and (as ``kept``) the question."""
    words = Words(part["text"])
    gone = np.zeros(len(words.starts) + 1, np.int64)
    told = np.flatnonzero([bool(m) or bool(w) for m, w in zip(marks, windows, strict=True)])
    if len(told):
        own = Words(part["text"].take(pa.array(told)))
        filed = Spans(own)
        hit = np.flatnonzero(_member(filed.owner, filed.mark, [marks[i] for i in told]))
        begin, end = filed.begin[hit], filed.end[hit] + WINDOW - 1
        if any(windows[i] for i in told):
            at, one, two = filed.windows(np.arange(len(filed.begin)))
            text = np.repeat(filed.owner, filed.end - filed.begin)
            at = at[_member(text, combine(one, two), [windows[i] for i in told])]
            begin, end = np.r_[begin, at], np.r_[end, at + WINDOW]
        cover = np.zeros(len(own.starts) + 1, np.int64)
        np.add.at(cover, begin, 1)
        np.add.at(cover, end, -1)
        place = np.repeat(words.first[told] - own.first, own.counts) + np.arange(len(own.starts))
        gone[place] = np.cumsum(cover)[:-1] > 0
    gone = gone[:-1] > 0
    before = np.r_[0, np.cumsum(gone)]
    removed = before[words.first + words.counts] - before[words.first]
    out: list[list] = [[], [], []]  # kept, text, marks
    flat = words.flat.tobytes() if len(words.flat) else b""
    starts, ends = words.starts.tolist(), words.ends.tolist()
    for i, (a, n) in enumerate(zip(words.first.tolist(), words.counts.tolist(), strict=True)):
        if asked is not None and asked[i]:
            row = (asked[i].hex(), part["text"][i].as_py(), marks[i])
        else:
            if layout and not removed[i]:
                kept = (part["text"][i].as_py() or "").encode()
            elif removed[i] == n:
                kept = b""
            elif removed[i]:
                kept = b" ".join([flat[starts[k] : ends[k]] for k in (np.flatnonzero(~gone[a : a + n]) + a).tolist()])
            else:
                kept = b" ".join(flat[starts[a] : ends[a + n - 1]].split())
            row = (hashlib.sha256(kept).hexdigest() if digests else kept.decode(), None, None)
        for column, value in zip(out, row, strict=True):
            column.append(value)
    arrays = [part["doc_id"], pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64())]
    arrays.append(pa.array(out[0], pa.string()))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256" if digests else "kept"]
    if "carried" in part.schema.names:
        arrays.append(part["carried"])
        names.append("carried")
    arrays += [pa.array(out[1], pa.string()), pa.array(out[2], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, [*names, "text", "marks"])
