"""Exact top-k inner products over buckets of vectors of similar length.

Rows are laid out by falling length in cells. Every query first meets the cell of the longest vectors; its k-th score
there is a bound that any better row must reach. The length of a cell's longest vector then tells which other cells can
reach it at all, and only those are asked.

A task cuts its cell into buckets of similar length. With l the largest length in a bucket, a row of the bucket reaches a
query's bound only if its cosine is at least bound / (|query| * l), the local threshold. Above 1 the whole bucket is
skipped. Otherwise each bucket chooses by local thresholds: from the level on where the feasible ranges of a query's
largest coordinate are narrow, rows must lie in the feasible ranges of the query's focus coordinates; below it, rows are
cut off by length alone. What is left is verified by its exact integer product, which also raises the bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.vectors import in_blocks, in_cells, matrix, meet, whole_numbers
from bazaarlens.session import prefer_skew_handling, write_out

BUCKET = 2048  # most rows of a bucket
FEW = 64  # a bucket is not cut for length before it has so many
SHORTER = 0.9  # rows shorter than this share of a bucket's longest begin another
FOCUS = 3  # coordinates whose ranges a row must lie in
NARROW = 0.125  # share of a bucket that a range may hold to be worth looking up
COSINE = 0.7  # below this local threshold no range is narrow
SLACK = 1e-9  # for what floating point loses in bounds; products are exact
LEAST = np.iinfo(np.int64).min


def buckets(norms: np.ndarray) -> list[tuple[int, int]]:
    """Runs of rows, in order of falling length, that are of similar length."""
    cuts, at = [], 0
    while at < len(norms):
        similar = int(np.searchsorted(-norms, -SHORTER * norms[at], "right"))
        upto = min(len(norms), at + BUCKET, max(similar, at + FEW))
        cuts.append((at, upto))
        at = upto
    return cuts


def feasible(coordinate: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest coordinate of a unit vector within ``cosine`` of one that has ``coordinate`` there."""
    angle, reach = np.arccos(np.clip(coordinate, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    return np.cos(np.minimum(np.pi, angle + reach)) - SLACK, np.cos(np.maximum(0, angle - reach)) + SLACK


class Bucket:
    """Rows of similar length; their unit vectors' coordinates are sorted once a query needs ranges of them."""

    def __init__(self, q: np.ndarray, norms: np.ndarray, rows: np.ndarray, ids: np.ndarray):
        self.q, self.norms, self.rows, self.ids = q, norms, rows, ids
        self._sorted: tuple[np.ndarray, np.ndarray] | None = None

    def coordinates(self) -> tuple[np.ndarray, np.ndarray]:
        """For each coordinate the rows' values in order, and whose they are."""
        if self._sorted is None:
            unit = (self.q / np.maximum(self.norms, 1e-300)[:, None]).T
            order = np.argsort(unit, axis=1)
            self._sorted = np.take_along_axis(unit, order, 1), order
        return self._sorted

    def level(self, unit: np.ndarray, local: np.ndarray) -> float:
        """The local threshold from which on ranges are used: most queries above it have a narrow one."""
        close = np.flatnonzero(local >= COSINE)
        if not len(close):
            return np.inf
        values, _ = self.coordinates()
        largest = np.abs(unit[close]).argmax(1)
        low, high = feasible(unit[close, largest], local[close])
        held = np.empty(len(close), np.int64)
        for f in np.unique(largest):
            own = largest == f
            held[own] = np.searchsorted(values[f], high[own], "right") - np.searchsorted(values[f], low[own])
        order = np.argsort(-local[close], kind="stable")
        share = np.cumsum(held[order] <= NARROW * len(self.rows)) / np.arange(1, len(close) + 1)
        good = np.flatnonzero(share >= 0.75)
        return float(local[close][order[good[-1]]]) if len(good) else np.inf

    def within(self, unit: np.ndarray, local: float) -> np.ndarray:
        """Rows in the feasible ranges of a query's focus coordinates."""
        values, order = self.coordinates()
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        low, high = feasible(unit[focus], np.full(len(focus), local))
        ranges = [order[f, np.searchsorted(values[f], a) : np.searchsorted(values[f], b, "right")] for f, a, b in zip(focus, low, high, strict=True)]
        ranges.sort(key=len)
        hits = ranges[0]
        if len(ranges) > 1 and len(hits):
            seen = np.zeros(len(self.rows), np.int8)
            for r in ranges:
                seen[r] += 1
            hits = hits[seen[hits] == len(ranges)]
        return hits


class Best:
    """The k best rows of each query, by score and then by smaller id, and the bound that others must reach."""

    def __init__(self, bound: np.ndarray, k: int):
        self.bound, self.k = bound, k
        self.kept: tuple[np.ndarray, np.ndarray, np.ndarray] = (np.zeros(0, np.int64),) * 3  # query, score, id

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(query):
            return
        query, score, ids = (np.concatenate(x) for x in zip(self.kept, (query, score, ids), strict=True))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        few = place < self.k
        self.kept = query[few], score[few], ids[few]
        full = place == self.k - 1
        self.bound[query[full]] = np.maximum(self.bound[query[full]], score[full])


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Integer products of all rows of both; in doubles if all of them and their parts are exact there."""
    if exact:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def search(cell: pa.Table, asks: pa.Table, k: int) -> pa.Table:
    """query, vec_id, score: the k best rows of a cell for each asking row, as far as they reach its bound."""
    dim = asks["dim"][0].as_py()
    norms = cell["norm"].to_numpy()
    order = np.argsort(-norms, kind="stable")
    norms, rows, ids = norms[order], cell["row"].to_numpy()[order], cell["vec_id"].to_numpy()[order]
    q, asked = matrix(cell["q"], dim)[order], matrix(asks["q"], dim)
    lengths, own = asks["norm"].to_numpy(), asks["row"].to_numpy()
    unit = asked / np.maximum(lengths, 1e-300)[:, None]
    best = Best(asks["bound"].fill_null(LEAST).to_numpy().copy(), k)
    exact = bool(len(norms)) and norms[0] * lengths.max() < 2.0**52
    for at, upto in buckets(norms):
        bucket = Bucket(q[at:upto], norms[at:upto], rows[at:upto], ids[at:upto])
        bound = best.bound.astype(np.float64)
        reach = lengths * norms[at]
        local = np.where(bound > 0, bound / np.maximum(reach, 1e-300), -1.0) * (1 - SLACK)
        alive = local <= 1
        level = bucket.level(unit, np.where(alive, local, -1.0))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i in np.flatnonzero(alive & (local >= level)).tolist():
            hits = bucket.within(unit[i], local[i])
            hits = hits[bucket.rows[hits] != own[i]]
            score = products(bucket.q[hits], asked[i : i + 1], exact)[:, 0]
            good = score >= best.bound[i]
            found.append((np.full(int(good.sum()), i), score[good], bucket.ids[hits[good]]))
        by_length = np.flatnonzero(alive & (local < level))
        for some in np.array_split(by_length, max(1, len(by_length) // 256)):
            if not len(some):
                continue
            # rows are in order of length: the shortest that can still reach a bound of these queries ends the bucket
            needed = np.where(bound[some] > 0, bound[some] / np.maximum(lengths[some], 1e-300), 0).min() * (1 - SLACK)
            n = int(np.searchsorted(-bucket.norms, -needed, "right"))
            score = products(asked[some], bucket.q[:n], exact)
            score[bucket.rows[:n] == own[some][:, None]] = LEAST
            least = best.bound[some]
            if n > k:  # no row under the k-th score of this bucket is among the k best
                least = np.maximum(least, np.partition(score, n - k, 1)[:, n - k])
            i, j = np.nonzero((score >= least[:, None]) & (score > LEAST))
            found.append((some[i], score[i, j], bucket.ids[j]))
        if found:
            best.add(*(np.concatenate(x) for x in zip(*found, strict=True)))
    query, score, ids = best.kept
    return pa.table({"query": own[query], "vec_id": ids, "score": score})


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id ``every`` divides, its k best other rows.

    The score is the inner product of the components floor(scale * x). Of equal scores the smaller vec_id is first; with
    fewer than k other rows, all are returned. Rows with a NULL vec_id, or a vector that is NULL or holds a NULL or
    non-finite component, take no part; rows are compared if they have equally many components. A row that repeats a
    vec_id is a row of its own, as a query and as a candidate of the other. Zero and empty vectors have score 0 with
    all. Other columns are ignored, an empty table gives no rows.
    """
    prefer_skew_handling(vectors.sparkSession)
    cells = in_cells(whole_numbers(vectors, scale), "dim", F.desc("norm"))
    tops = write_out(cells.groupBy("dim", "cell").agg(F.max("norm").alias("top")), "cell-lengths")
    longest = write_out(tops.groupBy("dim").agg(F.min("cell").alias("first")), "longest-cells")
    asks = in_blocks(cells.where(F.col("vec_id") % every == 0)).drop("cell")
    task, kind = (lambda cell, asks: search(cell, asks, k)), "query long, vec_id long, score long"

    near = asks.join(longest, "dim").withColumnRenamed("first", "cell").withColumn("bound", F.lit(None).cast("long"))
    found = write_out(meet(cells.join(longest.select(F.col("first").alias("cell")).distinct(), "cell", "left_semi"), near, task, kind), "nearest-first")
    bound = found.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
    bounded = asks.join(bound, F.col("row") == F.col("query"), "left").drop("query").join(tops, "dim").join(longest, "dim")
    reach = F.col("norm") * F.col("top") * (1 + SLACK)
    rest = bounded.where((F.col("cell") != F.col("first")) & (F.col("bound").isNull() | (reach >= F.col("bound"))))
    more = meet(cells, rest.drop("top", "first"), task, kind)

    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    ranked = found.unionByName(more).withColumn("rank", place).where(F.col("rank") <= k)
    named = asks.select("row", F.col("vec_id").alias("query_id"))
    return ranked.join(named, F.col("query") == F.col("row")).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.r, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM rows a JOIN rows b ON a.r <> b.r AND len(a.q) = len(b.q)
    WHERE a.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
